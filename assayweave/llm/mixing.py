"""Mixing sources to target weights by Sainte-Lague apportionment, with DataFrame operations only.

A source's words form a stream per shard, documents in seeded order, cut into blocks of equal words. Blocks
of the mix go to sources by the highest quotients ``target / (2 s + 1)``; a source's blocks go to its shards
in the same way, by their words. A shard takes all its blocks as often as its quota covers them whole, and
the rest of the quota goes to blocks picked evenly over the stream from a seeded start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD

#: Sources' weights in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Words of a block; where texts are cut, of a longer one.
BLOCK, TEXT_BLOCK = 16, 256
ROWS_PER_SHARD = 4096
#: A source has so many shards at most, for they are ranked together; beyond that its shards grow.
MAX_SHARDS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``target`` to (source, source_size): weights repeat in code point order of the sources, NULL last.

    Targets share ``share`` of all words by weight and stop at ``most`` times their source's words; the
    excess is shared anew until none is above. In the order of ``source_size / weight`` the stopped sources
    come first, so running sums find the level of the others. One row per source: numbered without a shuffle
    of documents.
    """
    place = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int")
    )
    weighed = sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_level = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    rest = weighed.withColumns(
        {
            "total": F.sum("source_size").over(whole) * F.lit(float(share)),
            "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "w_left": F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    level = (F.col("total") - F.col("caps_before")) / F.col("w_left")
    # The first source that its cap does not stop sets the level of all after it; theirs are lower.
    free = F.max(F.when(level * F.col("w") <= F.col("cap"), level)).over(whole)
    return rest.withColumn("target", F.least("cap", F.coalesce(F.col("w") * free, F.col("cap")))).select(
        "source", "source_size", "target"
    )


def sainte_lague(parties: DataFrame, votes: str, seats: Column, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: seats by highest quotients ``votes / (2 s + 1)`` among the parties of a group; ties by ``order``.

    Rounding each party's exact share misses the number of seats by a gap of at most half the parties. The
    quotients next above (or below) the rounded shares are then ranked and the gap filled (or freed). A party
    of share ``p`` can move by ``p (gap + parties) + 1`` seats at most, so about three quotients per party are
    ranked and the outcome is that of ranking all of them. A group holds sources or shards, never documents.
    """
    of_group = Window.partitionBy(*(groups or [F.lit(0)]))
    base = parties.withColumns(
        {"_n": seats.cast("bigint"), "_all": F.sum(votes).over(of_group), "_of": F.count(F.lit(1)).over(of_group)}
    )
    part = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(F.lit(0.0))
    base = base.withColumn("_part", part).withColumn("_round", F.floor(F.col("_part") * F.col("_n") + 0.5))
    base = base.withColumn("_gap", F.when(F.col("_all") > 0, F.col("_n") - F.sum("_round").over(of_group)).otherwise(F.lit(0)))
    moves = F.ceil(F.col("_part") * (F.abs("_gap") + F.col("_of"))) + 1
    steps = F.explode_outer(F.when(F.col("_gap") != 0, F.sequence(F.lit(0).cast("bigint"), moves)))
    next_up = F.col(votes) / (2 * (F.col("_round") + F.col("_step")) + 1)
    next_down = F.when(F.col("_step") < F.col("_round"), F.col(votes) / (2 * (F.col("_round") - F.col("_step")) - 1))
    # Ascending: the highest quotients are gained first, the lowest are freed first.
    worth = F.when(F.col("_gap") > 0, -next_up).otherwise(next_down)
    ranked = base.withColumn("_step", steps).withColumn("_worth", worth)
    by_worth = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(F.col("_worth").asc_nulls_last(), F.col("_place"))
    forward = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    place = F.dense_rank().over(forward)
    ranked = ranked.withColumn("_place", F.when(F.col("_gap") > 0, place).otherwise(-place))
    moved = ranked.withColumn("_moved", (F.row_number().over(by_worth) <= F.abs("_gap")) & F.col("_worth").isNotNull())
    return (
        moved.groupBy(*parties.columns, "_round", "_gap")
        .agg(F.sum(F.col("_moved").cast("bigint")).alias("_change"))
        .withColumn(name, (F.col("_round") + F.signum("_gap") * F.col("_change")).cast("bigint"))
        .select(*parties.columns, name)
    )


def seeded(seed: int, *columns: str) -> Column:
    """60 bits of the md5 of the seed and the columns' texts (NULL: empty), which any SQL engine can repeat."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


class Plan:
    """Quotas of sources and shards for a table of (doc_id, source, size); sums only, written to the shared folder."""

    def __init__(self, sizes: DataFrame, weights: Sequence[float], share: float, most: int, block: int, rows_per_shard: int, seed: int):
        self.most, self.block, self.seed = most, block, seed
        sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
        sources = materialize(sources, "sources")
        aimed = targets(sources.select("source", "source_size"), weights, share, most)
        shards_of = F.least(F.ceil(F.col("n_rows") / F.lit(rows_per_shard)), F.lit(MAX_SHARDS)).cast("bigint").alias("shards")
        counts = sources.select(F.col("source").alias("_s"), shards_of)
        aimed = aimed.join(counts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        total = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / F.lit(block))
        self.sources = materialize(sainte_lague(aimed, "target", total, [], ["source"], "quota"), "quotas")
        shards = self._dealt(sizes).groupBy("source", "quota", "shard").agg(F.sum("size").alias("words"))
        shards = sainte_lague(shards, "words", F.col("quota"), ["source"], ["shard"], "blocks")
        self.shards = materialize(shards.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "words", "blocks"), "shards")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        of_source = self.sources.select(F.col("source").alias("_s"), "source_size", "target", "shards", "quota")
        dealt = rows.join(of_source, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        return dealt.withColumn("shard", F.pmod(seeded(self.seed, "doc_id"), F.col("shards")))

    def place(self, rows: DataFrame) -> DataFrame:
        """Add to each row (doc_id, source, size, ...) its place in its shard's stream and the words taken of it.

        ``whole``: how often all of it is taken; ``begin``: words of the stream before it; ``picked`` takes the
        rest of the quota from there on.
        """
        placed = self._dealt(rows).join(self.shards, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
        stream = Window.partitionBy("source", "shard").orderBy(seeded(self.seed + 1, "doc_id"), "doc_id", "size")
        end = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        n = F.ceil(F.col("words") / F.lit(self.block)).cast("bigint")
        placed = placed.withColumns({"end": end, "n": n}).withColumn("q", F.least("blocks", F.lit(self.most) * F.col("n")))
        some = F.col("n") > 0
        placed = placed.withColumns(
            {
                "begin": F.col("end") - F.col("size"),
                "whole": F.when(some, F.floor(F.col("q") / F.col("n"))).otherwise(F.lit(0)).cast("bigint"),
                "offset": F.when(some, F.pmod(seeded(self.seed + 2, "source", "shard"), F.col("n"))),
            }
        ).withColumn("rest", F.col("q") - F.col("whole") * F.col("n"))
        return placed.withColumn("extra", F.when(F.col("size") > 0, self._words("end") - self._words("begin")).otherwise(F.lit(0)))

    def picked(self, blocks: Column) -> Column:
        """Blocks of the rest among the first ``blocks`` of the stream: evenly far from each other."""
        return F.floor((blocks * F.col("rest") + F.col("offset")) / F.col("n"))

    def _words(self, at: str) -> Column:
        """Words of picked blocks among the first words of the stream."""
        whole = F.floor(F.col(at) / F.lit(self.block))
        return self.picked(whole) * self.block + (F.col(at) - whole * self.block) * (self.picked(whole + 1) - self.picked(whole))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), *more
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    block: int = BLOCK,
    rows_per_shard: int = ROWS_PER_SHARD,
    seed: int = 0,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): the words of each row that the mix takes, repeats counted.

    Text is read once, for its number of words (NULL: 0); only sizes are shuffled. A source's rows are dealt
    to shards of about ``rows_per_shard`` by a hash of the id, so a source of a third of all rows is as many
    groups as it needs. No block, hence no document, is taken more than ``most`` times. Rows without words
    take nothing; repeated rows are rows of their own; a NULL source is a source. Reruns agree.
    """
    sizes = materialize(_sized(docs), "sizes")
    placed = Plan(sizes, weights, share, most, block, rows_per_shard, seed).place(sizes)
    taken = (F.col("whole") * F.col("size") + F.col("extra")).cast("bigint")
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    block: int = TEXT_BLOCK,
    rows_per_shard: int = ROWS_PER_SHARD,
    seed: int = 0,
) -> DataFrame:
    """The mix as documents, with all columns of ``docs``: a row for each time a text is taken whole, and a row with
    the words of its picked blocks, joined by one space, where only a part is taken once more.

    ``n_chars``, if there is such a column, follows the text. Rows that nothing is taken of are left out. Texts
    are shuffled once, to their shards; see ``mix`` for NULLs and ties.
    """
    plan = Plan(materialize(_sized(docs), "sizes"), weights, share, most, block, rows_per_shard, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    placed = plan.place(_sized(docs, row))
    words = F.regexp_extract_all(F.col("row.text"), F.lit(WORD), F.lit(0))

    def taken(word: Column, i: Column) -> Column:
        at = F.floor((F.col("begin") + i) / F.lit(block))
        return plan.picked(at + 1) > plan.picked(at)

    cut = F.when(F.col("extra") == F.col("size"), F.col("row.text")).otherwise(F.array_join(F.filter(words, taken), " "))
    texts = F.array_repeat(F.col("row.text"), F.col("whole").cast("int"))
    texts = F.when(F.col("extra") > 0, F.concat(texts, F.array(cut))).otherwise(texts)
    rows = placed.where("size > 0").select("row", F.explode(texts).alias("text"))
    out = []
    for c in docs.columns:
        value = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
        out.append(value.get(c, F.col(f"row.`{c}`")).alias(c))
    return rows.select(*out)

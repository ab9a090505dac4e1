"""Token output round trips, the mix against plain apportionment, queries with SQL, and the pipeline's stages."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from assayweave.llm import mixing, queries, rangecoder, token_output
from assayweave.session import materialize, scratch_dir
from tests.oracle import connection, difference

from . import odd

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


# --- range coder -----------------------------------------------------------------------


@given(
    st.lists(st.integers(0, 50), max_size=400) | st.lists(st.integers(0, 2**32 - 1), max_size=60) | st.lists(st.sampled_from([7, 8]), max_size=600),
    st.sampled_from([1, 3, 16, 100, 2048]),
)
@settings(max_examples=120, deadline=None)
def test_ids_come_back(ids, block):
    ids = np.array(ids, np.uint32)
    dictionary, blocks = rangecoder.encode(ids, block)
    assert len(blocks) == -(-len(ids) // block)
    assert (rangecoder.decode(dictionary, blocks, len(ids), block) == ids).all()


def test_blocks_are_independent_checked_and_small():
    rng = np.random.default_rng(0)
    words = [rng.integers(0, 3000, rng.integers(2, 6)) for _ in range(300)]
    ids = np.concatenate([words[i] for i in np.minimum(rng.zipf(1.3, 8000) - 1, 299)]).astype(np.uint32)
    dictionary, blocks = rangecoder.encode(ids, 2048)
    _, times = np.unique(ids, return_counts=True)
    entropy = -(times / len(ids) * np.log2(times / len(ids))).sum()
    assert 8 * sum(map(len, blocks)) / len(ids) < 0.8 * entropy  # contexts pay
    for i in (1, 4):
        assert (rangecoder.decode(dictionary, [blocks[i]], 2048) == ids[2048 * i : 2048 * (i + 1)]).all()
    for at in (0, 10, len(blocks[2]) // 2):
        broken = bytearray(blocks[2])
        broken[at] ^= 5
        with pytest.raises(ValueError):
            rangecoder.decode(dictionary, [*blocks[:2], bytes(broken), *blocks[3:]], len(ids))


# --- token files -----------------------------------------------------------------------


def whole(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_whole_texts(name):
    from tokenizers import Tokenizer

    texts = [t or "" for _, t, *_ in odd.rows()]
    texts += ["  two  blanks\n\n lines \t tabs  ", "it's we'll I'd can't", "a<|endoftext|>b", "1,234.5 €uro…", "   x", "'s", "\r\n\r\n"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in token_output.Encoder(public_tokenizers.path(name))(texts)] == want


def test_pieces_of_texts_before_are_known():
    encode = token_output.Encoder(TOKENIZER)
    texts = ["  two  blanks", " one", "one", "a\tb \tc", " \nd  e ", " ", "", "one one.\nOne  ", "x\x1c y", "née à\u00a0b"] * 3
    assert [x.tolist() for x in encode(texts)] == [whole(t) for t in texts]
    known = len(encode.known)
    assert [x.tolist() for x in encode(texts[::-1])] == [whole(t) for t in texts[::-1]]
    assert len(encode.known) == known > 0


def test_the_most_frequent_pieces_stay_known(monkeypatch):
    monkeypatch.setattr(token_output, "KNOWN", 8)
    encode = token_output.Encoder(TOKENIZER)
    texts = ["now often, often; rare! often: it's x,y\n often née? \u0663\u0664, a\u00a0b,", "so often; 'tis one. two three. four five six seven"]
    for t in texts * 2:
        assert [x.tolist() for x in encode([t])] == [whole(t)]
        assert " often" in encode.known
    encode._forget()
    assert " often" in encode.known and len(encode.known) == 4


def test_a_worker_keeps_its_tokenizer():
    shipped = cloudpickle.loads(cloudpickle.dumps(token_output.encoder))
    assert shipped(TOKENIZER) is token_output.encoder(TOKENIZER)


def test_more_ids_than_places_are_refused():
    with pytest.raises(ValueError):
        rangecoder.encode(np.arange(600_000, dtype=np.uint32), 2**16)


@pytest.mark.parametrize(("segment", "block"), [(4_000_000, 2048), (50, 8)])
def test_files_round_trip(spark, segment, block):
    path = scratch_dir(spark, "tokens-test")
    token_output.write(odd.docs(spark), path, TOKENIZER, segment=segment, block=block)
    order = sorted(odd.rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for i, t, *_ in order:
        ids = [*whole(t), 2]
        want.append((i, start, ids))
        start += len(ids)
    got = sorted(token_output.documents(spark, path, block).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.ids) for r in got] == want
    digests = sorted(token_output.digests(spark, path, block).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in digests] == [
        (i, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, ids in want
    ]


def test_an_empty_table_writes_no_ids(spark):
    path = scratch_dir(spark, "tokens-test")
    token_output.write(odd.empty(spark), path, TOKENIZER)
    assert token_output.documents(spark, path).count() == 0


def test_token_query_over_the_table(spark):
    got = sorted(queries.op8_tokens(spark, SF).collect(), key=lambda r: r.doc_id)
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    start = 0
    for r, d in zip(got, docs, strict=True):
        ids = [*whole(d.text), 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# --- mixing ----------------------------------------------------------------------------


def by_quotients(votes, seats):
    """Sainte-Lague, seat by seat; ties to the party that comes first."""
    got = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (Fraction(votes[i]) / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12), st.integers(0, 60))
@settings(max_examples=25, deadline=None)
def test_seats_by_highest_quotients(spark_session, votes, seats):
    df = spark_session.createDataFrame([(i, v) for i, v in enumerate(votes)], "party int, votes bigint")
    got = mixing.sainte_lague(df, "votes", F.lit(seats), [], ["party"], "seats").orderBy("party").collect()
    assert [r.seats for r in got] == (by_quotients(votes, seats) if sum(votes) else [0] * len(votes))


@pytest.fixture(scope="module")
def spark_session(spark):
    return spark


def plain_targets(sizes, weights, share, most):
    total, stopped = share * sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in stopped)
        level = left / max(1e-12, sum(w for i, w in enumerate(weights) if i not in stopped))
        above = {i for i in range(len(sizes)) if i not in stopped and level * weights[i] > most * sizes[i]}
        if not above:
            return [most * s if i in stopped else level * weights[i] for i, s in enumerate(sizes)]
        stopped |= above


@pytest.mark.parametrize("sizes", [[100, 10, 300], [5, 5, 5, 5, 5, 5, 5], [1, 1000, 1, 1000], [0, 10], [7]])
def test_targets_are_shared_anew_until_none_is_above(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size bigint")
    got = [r.target for r in mixing.targets(df, (3, 1, 2), 1.5, 2).orderBy("source").collect()]
    assert got == pytest.approx(plain_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5, 2))


@pytest.mark.parametrize("rows_per_shard", [3, 7, 4096])
def test_the_mix_equals_one_made_block_by_block(spark, rows_per_shard):
    rows = [(i, " ".join(["w"] * ((i * 37) % 90)), f"s{i % 4}" if i % 9 else None) for i in range(80)]
    rows += [(5, "w w w", "s1"), (5, "w w w", "s1"), (90, None, "s2"), (None, "w " * 40, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, source string, size int, shard string")
    got = mixing.mix(df, block=8, rows_per_shard=rows_per_shard, seed=3)
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix(df.repartition(5), block=8, rows_per_shard=rows_per_shard, seed=3).collect()))

    def seeded(seed, *values):
        text = "|".join([str(seed), *["" if v is None else str(v) for v in values]])
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sized = [(i, s, len((t or "").split())) for i, t, s in rows]
    sizes = [sum(n for _, s, n in sized if s == source) for source in sources]
    targets = plain_targets(sizes, [(3, 1, 2)[k % 3] for k in range(len(sources))], 1.5, 2)
    quotas = by_quotients([Fraction(t) for t in targets], round(sum(targets) / 8))
    want = Counter()
    for source, size, target, quota in zip(sources, sizes, targets, quotas):
        own = [(i, n) for i, s, n in sized if s == source]
        shards = -(-len(own) // rows_per_shard)
        names = sorted({seeded(3, i) % shards for i, _ in own})
        words = [sum(n for i, n in own if seeded(3, i) % shards == h) for h in names]
        for h, total, blocks in zip(names, words, by_quotients(words, quota)):
            docs = sorted(((seeded(4, i), -1 if i is None else i, n, i) for i, n in own if seeded(3, i) % shards == h))
            n_blocks = -(-total // 8)
            blocks = min(blocks, 2 * n_blocks)
            stream = [k for k, d in enumerate(docs) for _ in range(d[2])]
            taken = Counter()
            for b in range(n_blocks):
                rest = blocks % n_blocks
                at = seeded(5, source, h) % n_blocks
                times = blocks // n_blocks + ((b + 1) * rest + at) // n_blocks - (b * rest + at) // n_blocks
                for k in stream[8 * b : 8 * b + 8]:
                    taken[k] += times
            for k, d in enumerate(docs):
                want[d[3], source, d[2], size, round(target, 6), taken[k]] += 1
    assert Counter((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect()) == want


def test_mixed_documents_hold_the_words_taken(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit(1))
    mixed = mixing.mixed_documents(df, block=32)
    assert mixed.columns == df.columns and mixed.where("n_chars <> length(text)").count() == 0
    words = mixed.groupBy("doc_id").agg(F.sum(mixing.n_words(F.col("text"))).alias("n"))
    taken = mixing.mix(df, block=32).where("taken > 0")
    assert taken.join(words, "doc_id").where("n <> taken").count() == 0 and taken.count() == words.count()
    assert mixing.mix(odd.empty(spark)).count() == 0 and mixing.mixed_documents(odd.empty(spark)).count() == 0
    odd_mix = mixing.mixed_documents(odd.docs(spark), block=4)
    assert odd_mix.columns == odd.docs(spark).columns and odd_mix.where("text is null").count() == 0


# --- queries with SQL, and the pipeline ------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connection(SF), queries.SQL[name]) is None


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontaminate", "mix", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept.append(docs)
    first, second, third, mixed = kept
    insults = "(?i)\\b(idiot|moron|scum|loser|stupid|pathetic|worthless|disgusting|trash|clown)\\b"
    assert first.where(F.col("text").rlike(insults)).count() <= 1
    assert 0 < second.count() == second.select("text").distinct().count()
    from assayweave.llm import decontaminate

    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.contained_items(third, items).count() == 0
    assert second.count() - third.count() == decontaminate.contained_items(second, items).select("doc_id").distinct().count()
    last = corpus_pipeline.STAGES[-1][1](spark, mixed, SF)
    order = sorted(mixed.select("doc_id", "text").collect(), key=lambda r: (r.doc_id, r.text))
    got = sorted(last.collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens) for r in got] == [(r.doc_id, len(whole(r.text)) + 1) for r in order]


def test_pipeline_stages_take_odd_tables(spark, tmp_path):
    items = spark.createDataFrame([(1, "an item that is in no document at all")], "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (8, 0, 1)], "doc_id bigint, quality int, toxic int")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd.docs(spark), odd.empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()

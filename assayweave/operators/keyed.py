"""A loaded table in files that never change, with sketches of their keys: loads cost what a release changes.

Rows lie in buckets of their key's hash, a file for each bucket and load. Beside every load are Bloom sketches of its
files, and a version is a list of files with a success marker, so a load becomes visible in one step, and what a run
that broke off has left is not seen by anyone.

A release asks the sketches first: a key can only be in files of its bucket whose sketch holds its bits. Only the
keys of those files are read, to tell real hits from false ones. An append writes the unseen rows; an upsert also
replaces the files that really hold one of its keys, and no others.

    <path>/rows/load=<n>/_bucket=<b>/…    rows
    <path>/sketches/load=<n>/…            file, block, bits
    <path>/versions/v<n>/…                the files of the version, with what is needed to read them
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .staging import dedupe

#: Bits of a sketch block: what one bitmap of Spark's bitmap functions holds.
BLOCK_BITS = 1 << 15
_FILES = "file string, bucket int, n_rows bigint, blocks bigint, load bigint, buckets int, hashes int, schema string"
_SKETCH = "file string, block bigint, bits binary"


@dataclass(frozen=True)
class Load:
    """What a load did: its version, rows written, files whose keys were read, files replaced."""

    version: int
    rows: int
    files_read: int
    files_replaced: int


def finished_versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """Numbered folders ``v<n>`` below ``root``, and whether each was written to its end."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    top = path(root)
    files = top.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(top):
        return {}
    named = [(e.getPath(), e.getPath().getName()) for e in files.listStatus(top)]
    return {int(name[1:]): files.exists(path(p, "_SUCCESS")) for p, name in named if re.fullmatch(r"v[0-9]+", name)}


class KeyedTable:
    """Rows by a key that is unique and not NULL; see the module.

    ``bits_per_key`` of 24 with 8 hashes lets about one in ten thousand absent keys through a file's sketch; a key
    meets one file for each load. ``buckets`` and ``hashes`` are those of the first load, whatever is given later: give a
    large table so many buckets that a bucket of a load is a file of useful size.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64, bits_per_key: int = 24, hashes: int = 8):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets, self.bits_per_key, self.hashes = buckets, bits_per_key, hashes
        known = self.files().select("buckets", "hashes").limit(1).collect()
        if known:
            self.buckets, self.hashes = known[0]

    # --- versions ----------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        return sorted(v for v, done in finished_versions(self.spark, f"{self.path}/versions").items() if done)

    def files(self, version: int | None = None) -> DataFrame:
        """A line for each file of a version, by default the last."""
        known = self.versions()
        if version is None and not known:
            return self.spark.createDataFrame([], _FILES)
        if version is not None and version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        number = known[-1] if version is None else version
        return self.spark.read.schema(_FILES).parquet(f"{self.path}/versions/v{number}")

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version; columns a file does not have are NULL. None before the first load."""
        return self._rows(self.files(version))

    def _rows(self, files: DataFrame, schema: T.StructType | None = None) -> DataFrame | None:
        listed = files.select("file", "load", "schema").collect()  # a line for each file, as every read of them has
        if not listed:
            return None
        schema = schema or T.StructType.fromJson(json.loads(max(listed, key=lambda r: r.load).schema))
        return self.spark.read.schema(schema).parquet(*[r.file for r in listed])

    # --- sketches ----------------------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _block(self) -> Column:
        return F.pmod(F.shiftrightunsigned(F.xxhash64(self.key), 32), F.col("blocks"))

    def _bits(self) -> list[Column]:
        """Places of a key in its block, by double hashing."""
        h = F.xxhash64(F.lit(1), self.key)
        first = h.bitwiseAND(F.lit(BLOCK_BITS - 1))
        step = F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(BLOCK_BITS - 1)).bitwiseOR(F.lit(1))
        return [(first + step * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(self.hashes)]

    def _sketch(self, rows: DataFrame) -> DataFrame:
        """(file, block, bits) over rows with file and blocks; a bitmap grows map-side and has a fixed size."""
        placed = rows.select("file", self._block().alias("block"), F.explode(F.array(*self._bits())).alias("bit"))
        return placed.groupBy("file", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def may_hold(self, keys: DataFrame) -> DataFrame:
        """(key, file): for every key the files that may hold it; never misses one that does."""
        files = self.files().select("file", "bucket", "blocks", "load")
        loads = sorted(r.load for r in files.select("load").distinct().collect())
        own = keys.select(self.key)
        if not loads:
            return own.withColumn("file", F.lit("")).limit(0)
        asked = own.withColumn("bucket", self._bucket()).join(files.drop("load"), "bucket")
        asked = asked.withColumn("block", self._block()).withColumns({f"_b{i}": b for i, b in enumerate(self._bits())})
        sketches = self.spark.read.schema(_SKETCH).parquet(*[f"{self.path}/sketches/load={n}" for n in loads])

        def held(i: int) -> Column:
            place = F.col(f"_b{i}")
            byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, (place % 8).cast("int")) == 1

        met = asked.join(sketches, ["file", "block"])
        for i in range(self.hashes):
            met = met.where(held(i))
        return met.select(self.key, "file")

    def held(self, keys: DataFrame) -> tuple[DataFrame, int]:
        """(key, file) of the keys that are loaded, and the number of files whose keys were read to know it."""
        maybe = materialize(self.may_hold(keys), "maybe")
        named = maybe.select("file").distinct()
        files = materialize(self.files().join(named, "file", "left_semi"), "asked")
        only = T.StructType([f for f in keys.schema if f.name == self.key])
        loaded = self._rows(files, only)
        if loaded is None:
            return maybe.limit(0), 0
        real = loaded.select(self.key, F.col("_metadata.file_path").alias("file")).join(maybe, [self.key, "file"], "left_semi")
        return materialize(real, "held"), files.count()

    # --- loads -------------------------------------------------------------------------------

    def _fresh(self, batch: DataFrame) -> DataFrame:
        return materialize(dedupe(batch.where(F.col(self.key).isNotNull()), [self.key]), "fresh")

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose key is not loaded, one for each key; rows with a NULL key are rejected."""
        fresh = self._fresh(batch)
        return fresh.join(self.held(fresh)[0].select(self.key), self.key, "left_anti").select(*batch.columns)

    def append(self, batch: DataFrame, version: int | None = None) -> Load:
        """Load the batch's unseen keys. A version that is there already is not loaded again, so a replay is safe."""
        if (done := self._done(version)) is not None:
            return done
        fresh = self._fresh(batch)
        held, read = self.held(fresh)
        rows = fresh.join(held.select(self.key), self.key, "left_anti").select(*fresh.columns)
        return self._write(rows, self.files().limit(0), read, version)

    def append_unseen(self, rows: DataFrame, version: int | None = None) -> Load:
        """Load rows that ``unseen`` has given, or some of them, without asking again."""
        return self._done(version) or self._write(rows, self.files().limit(0), 0, version)

    def upsert(self, batch: DataFrame, version: int | None = None) -> Load:
        """Load the batch's rows in place of those with their keys. Files that hold none of them stay as they are."""
        if (done := self._done(version)) is not None:
            return done
        fresh = self._fresh(batch)
        held, read = self.held(fresh)
        replaced = materialize(self.files().join(held.select("file").distinct(), "file", "left_semi"), "replaced")
        old = self._rows(replaced)
        if old is None:
            return self._write(fresh, replaced, read, version)
        kept = old.join(fresh.select(self.key), self.key, "left_anti").select(*old.columns)
        return self._write(kept.unionByName(fresh, allowMissingColumns=True), replaced, read, version)

    def _done(self, version: int | None) -> Load | None:
        return Load(version, 0, 0, 0) if version is not None and version in self.versions() else None

    def _write(self, rows: DataFrame, replaced: DataFrame, read: int, version: int | None) -> Load:
        tried = finished_versions(self.spark, f"{self.path}/versions")
        number = version if version is not None else max(tried, default=0) + 1
        before = self.files()
        last = before.orderBy(F.desc("load")).limit(1).select("schema").collect()
        known = T.StructType.fromJson(json.loads(last[0].schema)) if last else T.StructType()
        schema = _merged(known, rows.schema)
        folder = f"{self.path}/rows/load={number}"
        # A version that is not finished may have left rows; they are in no list of files.
        rows.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").mode("overwrite").parquet(folder)
        key = T.StructType([f for f in rows.schema if f.name == self.key])
        written = self.spark.read.schema(key).parquet(folder).select(self.key, F.col("_metadata.file_path").alias("file"))
        blocks = F.ceil(F.count(F.lit(1)) * self.bits_per_key / BLOCK_BITS).cast("bigint")
        counts = written.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), blocks.alias("blocks"), F.first(self._bucket()).alias("bucket"))
        counts = materialize(counts, "files")
        self._sketch(written.join(counts.select("file", "blocks"), "file")).write.mode("overwrite").parquet(f"{self.path}/sketches/load={number}")
        same = {"load": F.lit(number).cast("bigint"), "buckets": F.lit(self.buckets), "hashes": F.lit(self.hashes), "schema": F.lit(schema.json())}
        new = counts.select("file", "bucket", "n_rows", "blocks", *[c.alias(n) for n, c in same.items()])
        kept = before.join(replaced.select("file"), "file", "left_anti").select(*before.columns)
        listed = kept.unionByName(new)
        # The list is the commit: two loads of one number do not both get there.
        mode = "overwrite" if number in tried else "errorifexists"
        listed.coalesce(1).write.mode(mode).parquet(f"{self.path}/versions/v{number}")
        total = counts.agg(F.sum("n_rows")).first()[0] or 0
        return Load(number, total, read, replaced.count())


def _merged(known: T.StructType, new: T.StructType) -> T.StructType:
    """All columns of both; a column whose type changes is refused."""
    types = {f.name: f.dataType for f in known}
    clashes = [f.name for f in new if types.get(f.name, f.dataType) != f.dataType]
    if clashes:
        raise ValueError(f"the load changes the type of {', '.join(clashes)}")
    fields: Sequence[T.StructField] = [*known, *[f for f in new if f.name not in types]]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])

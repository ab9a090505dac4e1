"""Loads that cost what a release changes: keyed files with sketches, and the split history."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assayweave.operators import history, quality
from assayweave.operators.history_store import HistoryStore
from assayweave.operators.keyed import KeyedTable
from assayweave.streaming import keyed_stream


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def scattered(spark, low, high, value="a"):
    """Keys all over the number range, the same for the same number."""
    return spark.range(low, high).select(F.xxhash64("id").alias("k"), F.lit(value).alias("v"))


def test_a_release_of_random_keys_reads_few_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k", buckets=40)
    assert table.read() is None and table.versions() == []
    first = table.append(scattered(spark, 0, 20_000))
    assert first.rows == 20_000 and first.files_read == 0
    new = scattered(spark, 50_000, 50_300, "b")
    old = scattered(spark, 7, 9, "b")
    second = table.append(new.union(old))
    assert second.rows == 300 and 1 <= second.files_read <= 4  # of 40 files: those of the two loaded keys and false hits
    assert table.append(new.union(old)).rows == 0
    assert table.read().count() == 20_300 and table.read().where("v = 'b'").count() == 300
    assert table.read(1).count() == 20_000  # an old version stays readable


def test_sketches_never_miss_and_seldom_err(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k", buckets=5, bits_per_key=24)
    table.append(scattered(spark, 0, 9000))
    asked = scattered(spark, 0, 9000)
    assert table.may_hold(asked).select("k").distinct().count() == 9000
    absent = scattered(spark, 100_000, 130_000)
    assert table.may_hold(absent).count() < 30_000 / 500
    coarse = KeyedTable(spark, f"{tmp_path}/coarse", "k", buckets=5, bits_per_key=1)
    coarse.append(scattered(spark, 0, 90_000))
    false_hits = coarse.may_hold(absent)
    assert false_hits.count() > 1000  # so that false positives are met, and nothing of them shows
    load = coarse.append(absent)
    assert load.rows == 30_000 and load.files_read == 5 and coarse.read().count() == 120_000


def test_an_upsert_replaces_only_files_that_hold_a_key(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k", buckets=20)
    table.append(scattered(spark, 0, 2000))
    before = {r.file for r in table.files().collect()}
    batch = scattered(spark, 5, 6, "new").union(scattered(spark, 9000, 9001, "new"))
    load = table.upsert(batch)
    after = {r.file for r in table.files().collect()}
    assert load.files_replaced == 1 and len(before & after) == len(before) - 1
    assert table.read().count() == 2001 and table.read().where("v = 'new'").count() == 2
    assert table.read(1).where("v = 'new'").count() == 0


def test_null_and_repeated_keys_new_columns_and_types(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "id", buckets=3)
    one = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (2, None)], "id bigint, v string")
    assert table.append(one).rows == 2
    two = spark.createDataFrame([(2, "B", 9), (3, "c", 8)], "id bigint, v string, file int")
    table.append(two)
    assert rows_of(table.read(), "id", "v", "file") == [(1, "a", None), (2, None, None), (3, "c", 8)]
    table.upsert(two)
    assert rows_of(table.read(), "id", "v", "file") == [(1, "a", None), (2, "B", 9), (3, "c", 8)]
    with pytest.raises(ValueError, match="type"):
        table.append(spark.createDataFrame([(5, 1)], "id bigint, v int"))
    assert table.append(one.limit(0)).rows == 0 and table.read().count() == 3
    assert KeyedTable(spark, str(tmp_path), "id", buckets=99, hashes=3).buckets == 3  # the first load's
    with pytest.raises(ValueError, match="no version"):
        table.read(77)


def test_a_broken_load_is_not_seen_and_its_number_can_be_taken_again(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k", buckets=4)
    table.append(scattered(spark, 0, 50))
    table.append(scattered(spark, 40, 80))
    (tmp_path / "versions" / "v2" / "_SUCCESS").unlink()  # as if the list had not been finished
    assert table.versions() == [1] and table.read().count() == 50
    assert table.append(scattered(spark, 40, 90), version=2).rows == 40
    assert table.append(scattered(spark, 40, 90), version=2).rows == 0  # a replay
    assert table.versions() == [1, 2] and table.read().count() == 90 == table.read().select("k").distinct().count()
    shutil.rmtree(tmp_path / "versions" / "v2")
    assert table.append(scattered(spark, 60, 100)).version == 2 and table.read().count() == 90


def test_the_stream_loads_each_batch_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id bigint, v string"
    table = KeyedTable(spark, out, "id", buckets=4)
    for n, rows in enumerate([[(1, "a"), (2, "b"), (2, "b2")], [(2, "B"), (3, "c"), (None, "x")]]):
        frame = spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.mode("append").parquet(source)
        keyed_stream(spark, source, frame.schema, table, str(tmp_path / "cp"), upsert=n == 1).awaitTermination()
    assert rows_of(table.read(), "id", "v") == [(1, "a"), (2, "B"), (3, "c")] and table.versions() == [1, 2]


# --- history -----------------------------------------------------------------------------


def at(day):
    return F.lit(f"2024-01-{day:02d}").cast("timestamp")


def release(spark, n, changed=(), gone=(), added=()):
    rows = [(i, 1.0 + (i in changed), None if i % 5 else "x") for i in range(n) if i not in gone]
    return spark.createDataFrame([*rows, *[(i, 0.0, "n") for i in added]], "id bigint, phase double, name string")


RELEASES = [
    {},
    {"changed": (3, 4)},
    {"changed": (3, 4), "gone": (7,), "added": (900,)},
    {"changed": (3,), "gone": (9,)},
    {"changed": (3,), "gone": (9,)},
]


def test_the_split_history_equals_the_plain_one(spark, tmp_path):
    store, plain = HistoryStore(spark, str(tmp_path), "id", ["phase", "name"]), None
    assert store.read() is None and store.open_windows() is None and store.compact() is None
    for day, r in enumerate(RELEASES, 1):
        current = release(spark, 200, **r)
        store.apply(current, at(day))
        if plain is None:
            plain = history.scd2_initial(current, "id", at(day))
        else:
            plain = history.scd2_apply(plain, current, "id", ["phase", "name"], at(day))
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        columns = plain.columns
        assert rows_of(store.read(), *columns) == rows_of(plain, *columns)
        assert rows_of(store.open_windows(), *columns) == rows_of(plain.where("valid_to is null"), *columns)
        if day == 2:
            store.compact()
            assert rows_of(store.read(), *columns) == rows_of(plain, *columns)
    assert quality.check_one_open_window(store.read(), "id").count() == 0
    assert rows_of(store.read(2), "window_id") == rows_of(store.read(3), "window_id")  # version 3 is the compaction


def test_versions_write_what_they_change(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path), "id", ["phase", "name"])
    store.apply(release(spark, 5000), at(1))
    written = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    store.apply(release(spark, 5000, changed=(1,), gone=(2,)), at(2))
    store.apply(release(spark, 5000, changed=(1,), gone=(2,)), at(3))
    assert all(p.stat().st_mtime_ns == t for p, t in written.items())
    counts = {n: spark.read.parquet(*map(str, Path(tmp_path).glob(f"changes/load={n}/*"))).count() for n in (1, 2)}
    assert counts == {1: 5000, 2: 3} and not list(Path(tmp_path).glob("changes/load=3/*=*"))


def test_a_run_that_breaks_between_the_writes_leaves_the_last_version(spark, tmp_path, monkeypatch):
    store = HistoryStore(spark, str(tmp_path), "id", ["phase", "name"])
    store.apply(release(spark, 20), at(1))

    def broken(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", broken)
        with pytest.raises(OSError):
            store.apply(release(spark, 20, changed=range(20)), at(2))
    assert store.versions() == [1] and store.read().count() == 20 and store.read().where("valid_to is not null").count() == 0
    assert store.apply(release(spark, 20, changed=(5,)), at(3)) == 2  # the number is taken again, its files replaced
    assert store.read().count() == 21 and store.open_windows().count() == 20
    half = tmp_path / "versions" / "v3"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half a file")
    assert store.versions() == [1, 2] and store.apply(release(spark, 20), at(4)) == 4
    assert store.read().count() == 22


def test_expired_versions_and_null_keys(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path), "id", ["phase", "name"])
    for day, r in enumerate(RELEASES[:3], 1):
        store.apply(release(spark, 30, **r).union(spark.createDataFrame([(None, 1.0, "x")], "id bigint, phase double, name string")), at(day))
    want = rows_of(store.read(), "window_id", "valid_to")
    assert store.compact() == 4 and store.expire(keep=1) == [1, 2, 3]
    assert rows_of(store.read(), "window_id", "valid_to") == want and store.versions() == [4]
    assert not list(Path(tmp_path).glob("changes/*/_change=opened"))
    store.apply(release(spark, 30), at(9))
    assert quality.check_one_open_window(store.read(), "id").count() == 0

"""Change over time: incremental loads and Type-2 history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import dedupe


def new_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch whose key is not loaded yet (what an append must write).

    Rows with a NULL key cannot be identified on a re-run and are rejected; of batch rows that
    share a key the first by all other columns is loaded. The anti join uses no NOT IN, so it
    neither fails on NULLs nor forces a broadcast.
    """
    fresh = batch.where(F.col(key).isNotNull()).join(target.select(key), key, "left_anti").select(*batch.columns)
    return dedupe(fresh, [key])


def key_range(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The part of the target between the batch's smallest and largest key.

    Two numbers are computed from the batch; as literals they reach the target's scan, which
    skips the row groups of keys a release with growing ids cannot touch.
    """
    low, high = batch.agg(F.min(key), F.max(key)).first()
    return target.where(F.col(key).between(F.lit(low), F.lit(high))) if low is not None else target.limit(0)


def incremental_append(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target plus the batch's unseen keys; running it twice changes nothing."""
    return target.unionByName(new_rows(target, batch, key), allowMissingColumns=True)


def incremental_upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Replace matching keys by the batch's rows (one each) and keep the others."""
    fresh = dedupe(batch.where(F.col(key).isNotNull()), [key])
    kept = target.join(fresh.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(fresh, allowMissingColumns=True)


def _window_id(key: str, valid_from: Column) -> Column:
    return F.sha2(F.concat_ws("\t", F.col(key).cast("string"), valid_from.cast("string")), 256)


def scd2_initial(current: DataFrame, key: str, now: Column) -> DataFrame:
    """First load: one open window per key."""
    return current.select(
        "*",
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        _window_id(key, now).alias("window_id"),
    )


def scd2_apply(
    history: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], now: Column
) -> DataFrame:
    """Next version of a Type-2 history.

    Closed windows pass through untouched. Open ones meet the current rows in one full
    outer join: equal (null-safe) check columns keep the window, a difference or a missing
    key closes it at ``now``, and a new or changed key opens a window at ``now``.
    """
    attributes = [c for c in current.columns if c != key]
    closed = history.where(F.col("valid_to").isNotNull())
    opened = history.where(F.col("valid_to").isNull())
    old = opened.select(F.col(key), F.struct(*opened.columns).alias("old"))
    new = current.select(F.col(key), F.struct(*current.columns).alias("new"))
    joined = old.join(new, key, "full_outer")

    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    unchanged = has_old & has_new & same

    end = F.when(unchanged, F.lit(None).cast("timestamp")).otherwise(now)
    window = [F.col("_w.valid_from"), F.col("_w.valid_to"), F.col("_w.window_id")]
    from_old = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in (key, *attributes, "valid_from")],
        end.alias("valid_to"),
        F.col("old.window_id").alias("window_id"),
    )
    from_new = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in (key, *attributes)],
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        _window_id(key, now).alias("window_id"),
    )
    # One or two output rows per joined row, so the join runs once.
    rows = F.array_compact(F.array(F.when(has_old, from_old), F.when(has_new & ~unchanged, from_new)))
    merged = joined.select(F.explode(rows).alias("_w")).select(
        *[F.col(f"_w.{c}").alias(c) for c in (key, *attributes)], *window
    )
    return closed.select(*merged.columns).unionByName(merged)


def scd2_changes(
    opened: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], now: Column
) -> DataFrame:
    """What the next version changes: windows closed and windows opened at ``now`` (``_change``: closed or opened).

    ``opened`` are the open windows. Check columns are compared null-safe; a key that is gone closes its window, a
    new one opens a window, a changed one does both. Unchanged keys give no row.
    """
    attributes = [c for c in current.columns if c != key]
    old = opened.select(F.col(key), F.struct(*opened.columns).alias("old"))
    new = current.select(F.col(key), F.struct(*current.columns).alias("new"))
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()

    def window(change: str, side: str, valid_from: Column, valid_to: Column, name: Column) -> Column:
        own = [F.col(f"{side}.{c}").alias(c) for c in (key, *attributes)]
        return F.struct(
            F.lit(change).alias("_change"), *own, valid_from.alias("valid_from"), valid_to.alias("valid_to"), name.alias("window_id")
        )

    closed = window("closed", "old", F.col("old.valid_from"), now, F.col("old.window_id"))
    begun = window("opened", "new", now, F.lit(None).cast("timestamp"), _window_id(key, now))
    changed = ~(has_old & has_new & same)
    rows = F.array_compact(F.array(F.when(has_old, closed), F.when(has_new, begun)))
    joined = old.join(new, key, "full_outer").where(changed)
    return joined.select(F.explode(rows).alias("_w")).select("_w.*")


def scd2_as_of(history: DataFrame, instant: Column) -> DataFrame:
    """Windows valid at an instant."""
    return history.where(
        (F.col("valid_from") <= instant) & (F.col("valid_to").isNull() | (instant < F.col("valid_to")))
    )

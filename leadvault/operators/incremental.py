"""Incremental loads: high-water marks, lookback windows, current state and merge by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadvault.operators.windows import _as_list, latest_of


def max_of(target: DataFrame, col: str, floor: str | None = None, name: str = "high_water") -> DataFrame:
    """One row: the greatest value of the column, or the floor where the target is empty."""
    top = F.max(col)
    if floor is not None:
        top = F.coalesce(top, F.lit(floor).cast(target.schema[col].dataType))
    return target.agg(top.alias(name))


def newer_than(source: DataFrame, target: DataFrame | None, col: str, floor: str | None = "1900-01-01",
               target_col: str | None = None) -> DataFrame:
    """Source rows beyond the target's high-water mark.

    The mark is a scalar subquery: one aggregated value that Spark computes first and can push
    into the scan of the source. Without a target there is nothing to compare with."""
    if target is None:
        return source
    mark = max_of(target, target_col or col, floor)
    return source.filter(F.col(col) > mark.scalar())


def incremental_append(new: DataFrame, target: DataFrame, cursor: str, floor: str = "1900-01-01") -> DataFrame:
    """Append log after one sync: the old rows plus the rows beyond the cursor."""
    return target.unionByName(newer_than(new, target, cursor, floor), allowMissingColumns=True)


def latest_by_key(df: DataFrame, pk, order) -> DataFrame:
    """Current state of an append log: the newest row per primary key."""
    return latest_of(df, pk, order)


def lookback_replace(target: DataFrame, new: DataFrame, date_col: str, days: int, pk, as_of: str) -> DataFrame:
    """Replace, by key, what was re-read for the last ``days`` days.

    Target rows inside the window give way to re-read rows of the same key; rows before the
    window are passed through without a join. Rows without a date count as inside, on both sides.
    Rows of ``new`` from before the window are no part of the re-read and left out; of several
    re-read rows per key the newest counts."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    keys = _as_list(pk)
    inside_window = F.coalesce(F.col(date_col) >= since, F.lit(True))
    reread = latest_of(new.filter(inside_window), keys, date_col)
    before = target.filter(~inside_window)
    inside = target.filter(inside_window).join(reread.select(*keys).distinct(), keys, "left_anti")
    return before.unionByName(inside).unionByName(reread, allowMissingColumns=True)


def merge_upsert(target: DataFrame | None, source: DataFrame, keys, order_by, update: bool = True) -> DataFrame:
    """State after merging a batch by key: matched rows updated, the others inserted.

    Several source rows per key are first reduced to the newest. With ``update=False`` matched
    target rows win and only new keys are added."""
    keys = _as_list(keys)
    batch = latest_of(source, keys, order_by)
    if target is None:
        return batch
    if update:
        kept = target.join(batch.select(*keys), keys, "left_anti")
        return kept.unionByName(batch, allowMissingColumns=True)
    return target.unionByName(new_keys(batch, target, keys), allowMissingColumns=True)


def new_keys(batch: DataFrame, target: DataFrame | None, keys) -> DataFrame:
    """Batch rows whose key the target lacks. Only the target's key columns are read."""
    keys = _as_list(keys)
    return batch if target is None else batch.join(target.select(*keys), keys, "left_anti")

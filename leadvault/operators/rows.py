"""Projections, filters and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadvault.functions import as_timestamp


def tag(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def compute_once(df: DataFrame, columns: dict) -> DataFrame:
    """Add expensive columns that later filters and projections read instead of re-evaluating.

    Spark moves a filter below the projection it tests and repeats the projected expressions in
    it, once per mention. A one-row generator is a border such filters do not cross."""
    packed = F.array(F.struct(*[expr.alias(name) for name, expr in columns.items()]))
    return df.select("*", F.inline(packed))


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.dropna(how="any", subset=list(cols))


def rows_where(df: DataFrame, where: str | None) -> DataFrame:
    """Optional SQL predicate, as passed to a maintenance job."""
    return df.filter(F.expr(where)) if where else df


def date_bounds(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; an open end sets no bound."""
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start).cast(df.schema[col].dataType))
    if end is not None:
        df = df.filter(F.col(col) <= F.lit(end).cast(df.schema[col].dataType))
    return df


def time_range(df: DataFrame, col: str, as_of: str, days: int) -> DataFrame:
    """The last ``days`` days before ``as_of``. The bounds are literals, so the filter reaches the scan."""
    end = as_timestamp(as_of)
    return df.filter((F.col(col) >= end - F.expr(f"interval {int(days)} days")) & (F.col(col) < end))


def dashboard_filter(df: DataFrame, ts: str | None = None, as_of: str | None = None,
                     days: int | None = None, **selected) -> DataFrame:
    """Relative time range plus value selections; a selection of ``None`` means all values."""
    if days is not None:
        df = time_range(df, ts, as_of, days)
    for col, value in selected.items():
        if value is not None:
            values = [value] if isinstance(value, str) else list(value)
            df = df.filter(F.col(col).isin(values))
    return df


def exclude_deleted(df: DataFrame, col: str = "deleted") -> DataFrame:
    """Drop rows flagged as deleted at the source; no flag means not deleted."""
    return df.filter(~F.coalesce(F.col(col).cast("boolean"), F.lit(False)))


def rank_one(df: DataFrame, rn: str = "rn") -> DataFrame:
    """Rows ranked first, without the rank column."""
    return df.filter(F.col(rn) == 1).drop(rn)


def union_aligned(*dfs: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append under additive schema evolution: old columns keep their place, new ones follow."""
    extra = [c for c in new.columns if c not in old.columns]
    return old.unionByName(new, allowMissingColumns=True).select(*old.columns, *extra)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_aligned(*dfs).distinct()



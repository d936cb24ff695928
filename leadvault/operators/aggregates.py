"""Grouped and global aggregates. All are partial-aggregated before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadvault.functions import exact_avg, ratio


def metric_totals(df: DataFrame, keys, sums: dict, avgs: dict | None = None) -> DataFrame:
    """Sums and averages of metrics with NULL counted as 0; dicts map output name to column."""
    aggs = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(name) for name, c in sums.items()]
    aggs += [exact_avg(F.coalesce(F.col(c), F.lit(0))).alias(name) for name, c in (avgs or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def ratio_of_sums(num: str, den: str, scale: float = 1.0) -> Column:
    """Aggregate: sum(num) * scale / sum(den), 0 where sum(den) is not positive."""
    return ratio(F.sum(num), F.sum(den), scale)


def activity_period(date: str, *stamps: str, folded: bool = False) -> list[Column]:
    """Aggregates for first day, last day, number of active days and the newest audit stamps. ``folded``: there is one row
    per day, so days are counted without a further shuffle that tells them apart."""
    return [
        F.min(date).alias("start_date"), F.max(date).alias("end_date"),
        (F.count(date) if folded else F.countDistinct(date)).alias("days_active"),
        *[F.max(s).alias(s) for s in stamps],
    ]


def first_seen(df: DataFrame, key: str, date: str = "load_date", source: str = "record_source") -> DataFrame:
    """Smallest date and smallest source per key, each taken on its own."""
    return df.groupBy(key).agg(F.min(date).alias(date), F.min(source).alias(source))


def earliest_row(df: DataFrame, keys, order, carry=()) -> DataFrame:
    """One row per key: the least (order, carry) tuple. Unlike ``first_seen`` the values belong
    to one and the same input row. Repeats are folded on the map side."""
    cols = [*order, *carry]
    best = df.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in cols])


def count_by(df: DataFrame, *dims, name: str = "count") -> DataFrame:
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias(name))


def count_by_grain(df: DataFrame, ts: str, grain: str = "day", name: str = "count") -> DataFrame:
    """Rows per day, hour, week or month."""
    return count_by(df, F.date_trunc(grain, F.col(ts)).cast("timestamp_ntz").alias(ts), name=name)


def hour_weekday_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per hour of day and day of week (1 = Sunday)."""
    stamp = F.col(ts)
    return count_by(df, F.hour(stamp).alias("hour"), F.dayofweek(stamp).alias("day_of_week"))


def cost_per(df: DataFrame, cost: str, *dims: str) -> DataFrame:
    """Total cost over number of rows, and that number, per dimension."""
    n = F.count(F.lit(1))
    return df.groupBy(*dims).agg(
        (F.sum(F.col(cost)).cast("double") / n).alias("cost_per_lead"), n.alias("total_leads"))


def size_summary(df: DataFrame, size: str, small: int, large: int, prefix: str = "file") -> DataFrame:
    """Count, total, average, least, greatest, and how many lie below / above the bounds."""
    s = F.col(size)
    return df.agg(
        F.count(F.lit(1)).alias(f"total_{prefix}s"),
        F.sum(s).alias("total_size_bytes"),
        F.avg(s).alias(f"avg_{prefix}_size_bytes"),
        F.min(s).alias(f"min_{prefix}_size_bytes"),
        F.max(s).alias(f"max_{prefix}_size_bytes"),
        F.count_if(s < small).alias(f"small_{prefix}s_count"),
        F.count_if(s > large).alias(f"large_{prefix}s_count"),
    )


def span(df: DataFrame, ts: str, count_name: str = "n", first: str = "first_ts", last: str = "last_ts") -> DataFrame:
    """Number of rows, first and last time."""
    return df.agg(F.count(F.lit(1)).alias(count_name), F.min(ts).alias(first), F.max(ts).alias(last))


def row_counts(**dfs: DataFrame) -> DataFrame:
    """One row per named frame with its number of rows."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("relation"), "row_count")
              for name, df in dfs.items()]
    return reduce(DataFrame.union, counts)


def insights_rollup(df: DataFrame, keys, sums=("impressions", "clicks", "spend", "reach")) -> DataFrame:
    """Sums of the base metrics per key, and the ratios derived from the sums."""
    return with_ratios(df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]))


def insights_levels(df: DataFrame, levels, date: str, sums=("impressions", "clicks", "spend", "reach")) -> DataFrame:
    """The roll-up at every level (each level's keys include those above it) in one pass."""
    cols = [date, *levels]
    sets = [[F.col(c) for c in [date, *levels[: i + 1]]] for i in range(len(levels))]
    grouped = df.groupingSets(sets, *[F.col(c) for c in cols])
    depth = reduce(lambda a, b: a + b, [(F.grouping(c) == 0).cast("int") for c in levels])
    rolled = grouped.agg(depth.alias("depth"), *[F.sum(c).alias(c) for c in sums])
    return with_ratios(rolled)


def with_ratios(df: DataFrame) -> DataFrame:
    """frequency, cpm, cpc and ctr from summed impressions, clicks, spend and reach."""
    return df.withColumns({
        "frequency": ratio("impressions", "reach"),
        "cpm": ratio("spend", "impressions", 1000),
        "cpc": ratio("spend", "clicks"),
        "ctr": ratio("clicks", "impressions", 100),
    })

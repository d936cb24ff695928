"""Newest / first row per key and neighbouring rows per key.

A key may hold a large part of all rows, so no operator here puts a whole key into one task:

* newest and first rows filter on ``row_number() = 1``, which Spark turns into a group limit
  before the shuffle: each input task forwards one row per key;
* neighbours are looked up inside (key, bucket) groups, where the bucket is a slice of the
  order column or a range of rows, and across buckets on a summary with one row per (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadvault.session import scratch_dir


def _one_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Rows of equal order are told apart by a hash of the whole row, so a task that runs again picks the same one."""
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*[F.col(f"`{c}`") for c in hashable]))
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def _as_list(cols):
    return [cols] if isinstance(cols, str) else list(cols)


def latest_of(df: DataFrame, keys, order) -> DataFrame:
    """Newest row per key: greatest order columns, NULLs counted as oldest."""
    return _one_per_key(df, _as_list(keys), [F.desc_nulls_last(c) for c in _as_list(order)])


def first_of(df: DataFrame, keys, order) -> DataFrame:
    """Oldest row per key: smallest order columns, NULLs counted as newest."""
    return _one_per_key(df, _as_list(keys), [F.asc_nulls_last(c) for c in _as_list(order)])


#: Rows of a bucket, about, where the data tell the buckets.
BUCKET_ROWS = 500_000


def in_ranges(df: DataFrame, keys, order, rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``_bucket``: ranges of (keys, order) of about ``rows`` rows each, cut where the data tell.

    Spark samples the rows and cuts them into ranges of equal size. A key with many rows spans several ranges, and so does
    one slice of its order column: cuts fall between rows, not between days. As cuts from a sample may be drawn otherwise
    when a task runs again, the ranges are stored."""
    count = max(1, -(-df.count() // rows))
    if count == 1:
        return df.withColumn("_bucket", F.lit(0))
    cut = df.repartitionByRange(count, *_as_list(keys), *_as_list(order)).withColumn("_bucket", F.spark_partition_id())
    path = scratch_dir(df.sparkSession, "ranges")
    cut.write.parquet(path)
    return df.sparkSession.read.schema(cut.schema).parquet(path)


def with_neighbour(df: DataFrame, keys, order, value: str, name: str, following: bool,
                   bucket: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add the value of the previous (or following) row of the same key.

    ``order`` must be unique within a key and keys must not be NULL. Rows meet their neighbours inside (key, bucket).
    ``bucket`` is a slice that rises with the first order column (its day or month, say), or None: then buckets are
    ranges of rows cut where the data tell, see ``in_ranges``, which bounds them whatever the
    data. The summary that crosses bucket borders holds one row per (key, bucket), so its groups are bounded by the number of
    buckets."""
    keys, order = _as_list(keys), _as_list(order)
    cut = in_ranges(df, keys, order, bucket_rows) if bucket is None else df.withColumn("_bucket", bucket)
    group = keys + ["_bucket"]

    # Boxed in a struct, so that a neighbour holding NULL differs from no neighbour.
    box = F.struct(F.col(value).alias("v"))
    shift = F.lead if following else F.lag
    near = shift(box).over(Window.partitionBy(*group).orderBy(*order))
    inside = cut.withColumn("_near", near)

    edge = F.min_by if following else F.max_by
    edges = cut.groupBy(*group).agg(edge(box, F.struct(*order)).alias("_edge"))
    across = edges.withColumn("_far", shift("_edge").over(Window.partitionBy(*keys).orderBy("_bucket")))

    joined = inside.join(across.drop("_edge"), group, "left")
    return joined.select(*df.columns, F.coalesce("_near", "_far")["v"].alias(name))


def close_versions(df: DataFrame, keys, order, end_col: str, bucket: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add the start of the key's following version as the end of this one; NULL while open."""
    first = _as_list(order)[0]
    return with_neighbour(df, keys, order, first, end_col, True, bucket, bucket_rows)


def changed_rows(df: DataFrame, keys, order, value: str, bucket: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows whose value differs from the key's previous row; the first row always counts."""
    marked = df.withColumn("_box", F.struct(F.col(value).alias("v")))
    linked = with_neighbour(marked, keys, order, "_box", "_before", False, bucket, bucket_rows)
    return linked.filter(~F.col("_before").eqNullSafe(F.col("_box"))).select(*df.columns)

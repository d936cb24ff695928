"""Stored type-2 snapshots: open versions by key, closed versions appended to, nothing closed ever read by a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.operators.aggregates import earliest_row
from leadvault.operators.windows import _as_list, close_versions
from leadvault.sources import partitions as P
from leadvault.sources.writes import write_table


def load_snapshot(spark: SparkSession, source: DataFrame, path: str, keys, updated_at: str, digits: int = 2) -> None:
    """Load a batch of states into the snapshot at ``path``.

    ``open`` holds the version in force per key, in partitions by key hash; ``closed`` the others. A load reads the open
    versions of the partitions its keys are in, chains them with the batch, appends what is closed and replaces those
    partitions. A state older than the open version of its key is late: where it belongs among the closed ones is not looked up,
    but its key is noted in ``late``, and ``read_snapshot`` puts the chain of such keys right. Batches may come in any order
    and more than once. Versions of one key and time are one: the least by their other columns."""
    keys = _as_list(keys)
    rest = [c for c in source.columns if c not in [*keys, updated_at]]
    batch = P._kept_aside(earliest_row(source, [*keys, updated_at], rest).select(source.columns).withColumn(
        P.PART, P.key_part(keys, digits)), "batch")
    touched = P.partition_values(batch, P.PART)
    if not touched:
        return
    old = P.stored_or_none(spark, f"{path}/open")
    rows = batch.drop(P.PART)
    if old is not None:
        held = old.filter(P.within(P.PART, touched)).join(rows.select(*keys).distinct(), keys, "left_semi")
        held = P._kept_aside(held.drop(P.PART), "open")
        late = rows.join(held.select(*keys, F.col(updated_at).alias("_open")), keys).filter(F.col(updated_at) <= F.col("_open"))
        late = P._kept_aside(late.select(*keys).distinct(), "late")
        rows = earliest_row(held.unionByName(rows, allowMissingColumns=True), [*keys, updated_at], rest).select(source.columns)
        if not late.isEmpty():
            late.write.mode("append").parquet(f"{path}/late")
    chained = P._kept_aside(close_versions(rows, keys, [updated_at], "valid_to"), "chained")
    write_table(chained.filter("valid_to IS NOT NULL"), f"{path}/closed", layer="snapshot", mode="append")
    newest = chained.filter("valid_to IS NULL").drop("valid_to")
    P.merge_partitions(spark, newest, f"{path}/open", keys, updated_at, digits=digits, layer="snapshot")


def read_snapshot(spark: SparkSession, path: str, keys, updated_at: str) -> DataFrame:
    """All versions with ``valid_from`` and ``valid_to``, NULL while in force. Only keys that once had a late state are chained
    anew; the others are read as they are stored."""
    keys = _as_list(keys)
    open_ = spark.read.parquet(f"{path}/open").drop(P.PART).withColumn("valid_to", F.lit(None).cast(
        spark.read.parquet(f"{path}/closed").schema["valid_to"].dataType))
    every = spark.read.parquet(f"{path}/closed").unionByName(open_).withColumn("valid_from", F.col(updated_at))
    late = P.stored_or_none(spark, f"{path}/late")
    if late is None:
        return every
    late = late.distinct()
    states = every.join(late, keys, "left_semi").drop("valid_from", "valid_to")
    versions = earliest_row(states, [*keys, updated_at], [c for c in states.columns if c not in [*keys, updated_at]])
    anew = close_versions(versions, keys, [updated_at], "valid_to").withColumn("valid_from", F.col(updated_at))
    return every.join(late, keys, "left_anti").unionByName(anew)

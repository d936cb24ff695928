"""Datasets kept as full versions, so that a job never overwrites what it reads.

``<root>/version=<n>`` holds the data of version n and ``<root>/load_log`` one row per finished
version. A version counts once its log row is written, so a job that dies half-way leaves the
newest finished version in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.sources.partitions import stored_or_none
from leadvault.sources.writes import write_table

LOG_SCHEMA = "version bigint, committed_at timestamp_ntz, path string"


def load_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished version; empty for a dataset that does not exist yet."""
    log = stored_or_none(spark, f"{root}/load_log", LOG_SCHEMA)
    return spark.createDataFrame([], LOG_SCHEMA) if log is None else log


def newest_version(spark: SparkSession, root: str) -> int:
    return load_log(spark, root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest finished version, or None."""
    version = newest_version(spark, root)
    return spark.read.parquet(f"{root}/version={version}") if version else None


def publish(df: DataFrame, root: str, as_of: str, version: int | None = None, layer: str = "bronze") -> DataFrame:
    """Write the next version and log it; returns it read back, cut off from its lineage.

    A caller that numbers its versions publishes each number once: a number already logged is left
    as it is."""
    spark = df.sparkSession
    newest = newest_version(spark, root)
    number = newest + 1 if version is None else version
    path = f"{root}/version={number}"
    if number > newest:
        write_table(df, path, layer=layer)
        entry = spark.range(1).select(
            F.lit(number).cast("bigint").alias("version"),
            F.lit(as_of).cast("timestamp_ntz").alias("committed_at"), F.lit(path).alias("path"))
        entry.write.mode("append").parquet(f"{root}/load_log")
    return spark.read.parquet(path)

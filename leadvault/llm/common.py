"""What several operators share: input columns, stored intermediate tables, prefix sums, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadvault.session import scratch_dir

#: A word: no space and none of tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_GIVE_BACK = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_code(spark: SparkSession) -> SparkSession:
    """Gives this package to the executors' Python workers through Spark, once per application, so that they
    need no copy of it on their path."""
    context = spark.sparkContext
    if getattr(context, "_leadvault_shipped", False):
        return spark
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="leadvault-code-"), "leadvault_code.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._leadvault_shipped = True
    return spark


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Writes `df` to the folder all executors share and reads it back: lineage ends here, so a
    lost executor repeats only the tasks that read this table, never what came before. The shuffle files
    that went into it are no longer needed and given back."""
    path = scratch_dir(spark, label)
    before = spark.conf.get(_GIVE_BACK, "false")
    spark.conf.set(_GIVE_BACK, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_GIVE_BACK, before)
    return spark.read.schema(df.schema).parquet(path)


def by_place(df: DataFrame) -> DataFrame:
    """`df` with its columns named by their places: Arrow maps look names up, and a dot in one would be taken for a field."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def with_running_total(spark: SparkSession, df: DataFrame, key: str, order: str, value: str, name: str, slices: int) -> DataFrame:
    """Adds `name`: the sum of `value` over the rows of the same `key` with a smaller `order`.

    `order` holds longs from 0 to 2**62 that are spread evenly and differ inside a key. A key may hold
    any share of the rows: rows are dealt into `slices` ranges of `order`, the totals of the ranges
    (keys x slices rows) give each range its offset, and only rows of one range meet in a task."""
    width = max(1, 2**62 // slices)
    cut = df.withColumn("_slice", F.expr(f"{order} div {width}"))
    totals = cut.groupBy(key, "_slice").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(key).alias("_key"), F.col("_slice").alias("_at"),
                            F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(key, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (cut.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_at")))
            .withColumn(name, F.col("_offset") + F.col("_inside"))
            .drop("_slice", "_key", "_at", "_offset", "_inside"))


def connected(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of `edges` (a long, b long): (node, root), root the smallest node reachable.
    Nodes without an edge are absent. Alternates large-star and small-star rounds, each written to the
    shared folder; every step is a minimum (combined before the shuffle) or an equi join, so a node
    with very many neighbours is no single task's work."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(spark, edges, "edges")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(spark, small, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                roots.withColumn("root", F.col("node")))
        seen = now
    raise RuntimeError(f"components not settled after {rounds} rounds")


def all_of(conditions):
    """One condition that holds where all of them hold."""
    return reduce(lambda a, b: a & b, conditions)

"""Upkeep of parquet datasets: compaction, sorted rewrites, file health, versions to expire."""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadvault.functions import as_timestamp
from leadvault.operators.aggregates import size_summary, span
from leadvault.operators.joins import side_by_side
from leadvault.operators.rows import rows_where
from leadvault.sources.reads import list_files
from leadvault.sources.writes import LAYER_OPTIONS

MB = 1024 * 1024
SMALL_FILE = 16 * MB
LARGE_FILE = 256 * MB


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of a dataset, from the file listing."""
    return list_files(spark, path).agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]


def files_for(size_bytes: int, target_mb: int) -> int:
    return max(1, math.ceil(size_bytes / (target_mb * MB)))


#: A file is well-sized between these parts of the target size.
SMALL, LARGE = 0.5, 1.5
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Files of one folder that are packed together; a folder of more is packed in slices.
PACK_FILES = 10_000


def first_fit_decreasing(sizes: np.ndarray, room: int) -> np.ndarray:
    """The bin of each size: largest first, each into the first bin that has room for it."""
    bins, free = np.empty(len(sizes), np.int64), np.full(len(sizes), room, np.int64)
    for k in np.argsort(-sizes, kind="stable"):
        bins[k] = np.argmax(free >= sizes[k])
        free[bins[k]] -= sizes[k]
    return bins


def compaction_plan(files: DataFrame, target_bytes: int) -> DataFrame:
    """(folder, file_path, file_size, grp, parts) of the files to rewrite, from a listing (file_path, file_size).

    Small files of a folder are packed by size into groups of at most the target, first-fit decreasing, each to become
    one file; a group of one is left alone. Each large file is to become ``parts`` files. Others don't occur: they stay."""
    near = files.withColumn("folder", F.regexp_replace("file_path", "/[^/]*$", ""))
    small = near.filter(F.col("file_size") < SMALL * target_bytes)
    slices = small.groupBy("folder").agg(F.ceil(F.count("*") / PACK_FILES).alias("slices"))
    dealt = small.join(slices, "folder").withColumn("slice", F.pmod(F.xxhash64("file_path"), F.col("slices")))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("file_path", ignore_index=True)
        grp = pd.Series(first_fit_decreasing(part["file_size"].to_numpy(np.int64), target_bytes))
        part["grp"] = "s" + part["slice"].astype(str) + "_" + grp.astype(str)
        return part.assign(parts=1)[grp.map(grp.value_counts()) > 1][["folder", "file_path", "file_size", "grp", "parts"]]

    packed = dealt.groupBy("folder", "slice").applyInPandas(
        pack, "folder string, file_path string, file_size long, grp string, parts int")
    large = near.filter(F.col("file_size") > LARGE * target_bytes).select(
        "folder", "file_path", "file_size", F.concat(F.lit("l"), F.md5("file_path")).alias("grp"),
        F.ceil(F.col("file_size") / target_bytes).cast("int").alias("parts"))
    return packed.unionByName(large)


def _hadoop_path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _finish(spark: SparkSession, work: str) -> None:
    """Move the files of a finished rewrite to their folders and delete those they stand for. Can be repeated."""
    for row in spark.read.parquet(f"{work}/moves").collect():
        (old, fs), (new, _) = _hadoop_path(spark, row["old"]), _hadoop_path(spark, row["new"] or row["old"])
        if row["new"] is None:
            fs.delete(old, False)
        elif fs.exists(old) and not fs.rename(old, new):
            raise RuntimeError(f"{row['old']} could not be moved to {row['new']}")
    at, fs = _hadoop_path(spark, work)
    fs.delete(at, True)


def compact_files(spark: SparkSession, root: str, target_mb: float | None = None, layer: str = "bronze", where: str | None = None) -> DataFrame:
    """Bring the files of a dataset near its layer's size, in place; returns the new listing.

    Only files that are too small or too large are read and rewritten (see ``compaction_plan``); well-sized ones keep their names.
    ``where`` is a condition on the listing (file_path, file_size, modified_at). Rewritten files are written to a folder
    that readers don't look into. Once all are there, a list of moves is written; then they are moved and the old ones deleted. A run that dies
    before the list leaves the dataset as it was, one that dies later is finished by the next."""
    work, target = f"{root.rstrip('/')}/_compacting", int((target_mb or LAYER_OPTIONS[layer].target_mb) * MB)
    at, fs = _hadoop_path(spark, work)
    if fs.exists(at):
        if fs.exists(_hadoop_path(spark, f"{work}/moves/_SUCCESS")[0]):
            _finish(spark, work)
        else:
            fs.delete(at, True)
    plan = rows_where(list_files(spark, root), where)
    plan = compaction_plan(plan, target).cache()
    groups, count = [], 0  # the number of each group's first file
    for r in plan.select("folder", "grp", "parts").distinct().collect():
        groups.append((r["folder"], r["grp"], count))
        count += r["parts"]
    old = [r["file_path"] for r in plan.select("file_path").collect()]  # as many as Spark's own file listing holds
    if not old:
        plan.unpersist()
        return list_files(spark, root)
    rows = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*old).withColumn("_file", F.col("_metadata.file_path"))
    below = old[0].partition(root.rstrip("/"))[2]  # listed paths begin with a scheme
    partitions = [folder.split("=")[0] for folder in below.split("/")[1:-1]]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    first = spark.createDataFrame(groups, "folder string, grp string, _first int")
    folders = plan.join(first, ["folder", "grp"]).select(F.col("file_path").alias("_file"), "folder", "grp", "parts", "_first")
    share = F.pmod("_row", "parts")
    grouped = numbered.join(folders, "_file").withColumn(
        "_grp", F.concat_ws("_", "grp", share, F.substring(F.md5("folder"), 1, 12)))
    # A task writes one file, row by row as they come: with a concurrent writer it need not sort them by folder first.
    named = grouped.withColumn("_to", (F.col("_first") + share).cast("int")).drop("_file", "_row", "folder", "grp", "parts", "_first")
    dealt = named.repartitionById(count, "_to").drop("_to")
    opts, before = LAYER_OPTIONS[layer], spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, "2")
    try:
        (dealt.write.option("compression", opts.codec).option("parquet.page.size", opts.page_bytes)
         .partitionBy(*partitions, "_grp").parquet(f"{work}/files"))
    finally:
        spark.conf.unset(_WRITERS) if before is None else spark.conf.set(_WRITERS, before)
    written = list_files(spark, f"{work}/files").select("file_path").collect()
    # Files of several groups may have one name.
    moves = [(r["file_path"], re.sub(r"/_compacting/files(/.*)?/_grp=([^/]*)/part-", r"\1/part-\2-", r["file_path"])) for r in written]
    spark.createDataFrame(moves + [(f, None) for f in old], "old string, new string").write.parquet(f"{work}/moves")
    plan.unpersist()
    _finish(spark, work)
    return list_files(spark, root)


def compact(spark: SparkSession, src: str, dst: str, where: str | None = None, target_mb: int = 128,
            partition_by=()) -> DataFrame:
    """Rewrite small files to about the target size. Every row is kept; a predicate picks the rows that are
    gathered into large files, the others are carried over as they lie.

    The number of output files follows from the stored size. Partitioned data is gathered by
    partition and dealt over enough tasks that a heavy partition is not one task's work."""
    n = files_for(total_bytes(spark, src), target_mb)
    whole = spark.read.parquet(src)
    df = rows_where(whole, where)
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(dst)
    else:
        df.repartition(n).write.mode("overwrite").parquet(dst)
    if where is not None:
        rest = whole.filter(~F.coalesce(F.expr(where), F.lit(False)))
        rest.write.mode("append").partitionBy(*partition_by).parquet(dst)
    return spark.read.parquet(dst)


def rewrite_sorted(spark: SparkSession, src: str, dst: str, sort_cols, target_mb: int = 128,
                   layer: str = "bronze") -> DataFrame:
    """Rewrite ordered by the sort columns, so that their min / max statistics skip files."""
    n = files_for(total_bytes(spark, src), target_mb)
    df = spark.read.parquet(src).repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    df.write.mode("overwrite").option("compression", LAYER_OPTIONS[layer].codec).parquet(dst)
    return spark.read.parquet(dst)


def expiry_candidates(versions: DataFrame, as_of: str, days: int = 7, keep: int = 5,
                      dataset: str | None = None) -> DataFrame:
    """Versions older than ``days`` that are not among the newest ``keep`` of their dataset.
    Deletes nothing.

    The newest ``keep`` are found with a ranked filter, which Spark cuts down before the shuffle,
    so a dataset with very many versions is not one task's work."""
    keys = [dataset] if dataset else []
    by_age = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(F.desc("committed_at"), F.desc("version"))
    kept = versions.withColumn("_rn", F.row_number().over(by_age)).filter(F.col("_rn") <= keep)
    old = versions.filter(F.col("committed_at") < as_timestamp(as_of) - F.expr(f"interval {int(days)} days"))
    return old.join(kept.select(*keys, "version"), [*keys, "version"], "left_anti")


def orphan_candidates(files: DataFrame, live: DataFrame, as_of: str, days: int = 3) -> DataFrame:
    """Files that no live version names and that are older than ``days``. Deletes nothing."""
    old = files.filter(F.col("modified_at") < as_timestamp(as_of) - F.expr(f"interval {int(days)} days"))
    return old.join(live.select("file_path"), "file_path", "left_anti")


def file_health(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """File count, total / average / least / greatest size, and how many are too small or large."""
    summary = size_summary(list_files(spark, path), "file_size", SMALL_FILE, LARGE_FILE)
    return summary.select(F.lit(name or path).alias("table_name"), *summary.columns)


def dataset_report(spark: SparkSession, root: str, load_log: DataFrame, as_of: str) -> DataFrame:
    """Version and file statistics of a dataset in one row."""
    versions = span(load_log, "committed_at", "total_versions", "first_commit", "last_commit")
    files = size_summary(list_files(spark, root), "file_size", SMALL_FILE, LARGE_FILE).select(
        "total_files", "total_size_bytes", "avg_file_size_bytes")
    return side_by_side(versions, files).withColumn("check_timestamp", as_timestamp(as_of))

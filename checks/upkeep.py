"""Dataset maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import table
from checks.registry import check
from leadvault.operators import maintenance as M
from leadvault.session import scratch_dir
from leadvault.sources import catalog
from leadvault.sources.reads import list_files
from leadvault.sources.versions import load_log, publish


@check("compact", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def compact(spark, sf):
    """Many small files become one; the predicate picks the rows to gather, all others stay too."""
    src, dst = scratch_dir(spark, "small"), scratch_dir(spark, "compacted")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").repartition(16).write.parquet(src)
    return M.compact(spark, src, dst, "o_orderstatus <> 'P'")


@check("compact_partitioned", "SELECT o_orderkey, o_orderstatus FROM orders")
def compact_partitioned(spark, sf):
    src, dst = scratch_dir(spark, "small"), scratch_dir(spark, "compacted")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").repartition(8).write.partitionBy(
        "o_orderstatus").parquet(src)
    return M.compact(spark, src, dst, partition_by=["o_orderstatus"])


#: Order lines per file of each kind and flag, about.
FILE_LINES = 1_000_000


@check("compact_files", """SELECT l_returnflag, COUNT(*) AS n_rows, CAST(SUM(l_orderkey) AS BIGINT) AS keys,
  TRUE AS in_bounds, TRUE AS fewer_files, TRUE AS well_sized_kept FROM lineitem GROUP BY l_returnflag""")
def compact_files(spark, sf):
    """Order lines by return flag: every fourth in small files, half in large files, the rest in files of the target size, which keep
    their names. After two runs no folder has a large file, nor two small ones that would fit into one."""
    root = scratch_dir(spark, "files")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag")
    each = -(-lines.count() // FILE_LINES)  # files grow in number, not in size
    parts = {"large": (lines.filter("l_orderkey % 4 < 2"), each), "well": (lines.filter("l_orderkey % 4 = 2"), each),
             "small": (lines.filter("l_orderkey % 4 = 3"), 12 * each)}
    written, files = {}, set()
    for name, (rows, count) in parts.items():
        rows.repartition(count).write.mode("append").partitionBy("l_returnflag").parquet(root)
        now = {r["file_path"]: r["file_size"] for r in list_files(spark, root).collect()}
        written[name], files = {f: now[f] for f in now if f not in files}, set(now)
    target = max(written["well"].values())
    for _ in range(2):
        after = M.compact_files(spark, root, target / M.MB)
    well = [f for f, size in written["well"].items() if M.SMALL * target <= size <= M.LARGE * target]
    folder = F.regexp_extract("file_path", "l_returnflag=([^/]*)", 1)
    least = F.sort_array(F.collect_list(F.when(F.col("file_size") < M.SMALL * target, F.col("file_size"))))
    two = F.coalesce(F.get(least, F.lit(0)) + F.get(least, F.lit(1)), F.lit(target + 1))
    before = spark.createDataFrame([(f,) for f in files], "file_path string").groupBy(folder.alias("l_returnflag")).agg(
        F.count("*").alias("n_before"), F.collect_list(F.when(F.col("file_path").isin(well), F.col("file_path"))).alias("well"))
    state = after.groupBy(folder.alias("l_returnflag")).agg(
        ((F.max("file_size") <= M.LARGE * target) & (two > target)).alias("in_bounds"),
        F.count("*").alias("n_after"), F.collect_set("file_path").alias("files")).join(before, "l_returnflag")
    rows = spark.read.parquet(root).groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("keys"))
    return rows.join(state, "l_returnflag").select(
        *rows.columns, "in_bounds", (F.col("n_after") < F.col("n_before")).alias("fewer_files"),
        (F.size(F.array_except("well", "files")) == 0).alias("well_sized_kept"))


@check("rewrite_sorted", "SELECT o_orderkey, o_custkey FROM orders")
def rewrite_sorted(spark, sf):
    src, dst = scratch_dir(spark, "unsorted"), scratch_dir(spark, "sorted")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey").repartition(8).write.parquet(src)
    return M.rewrite_sorted(spark, src, dst, ["o_custkey", "o_orderkey"])


@check("file_health")
def file_health(spark, sf):
    """File sizes depend on the writer, so there is nothing in SQL to compare with."""
    out = scratch_dir(spark, "health")
    table(spark, sf, "lineitem").repartition(8).write.parquet(out)
    return M.file_health(spark, out, "lineitem")


@check("dataset_report")
def dataset_report(spark, sf):
    root = scratch_dir(spark, "reported")
    orders = table(spark, sf, "orders")
    for day in ("2024-01-01", "2024-01-02"):
        publish(orders, root, day)
    return M.dataset_report(spark, root, load_log(spark, root), "2024-01-03")


@check("analyze_table", """SELECT CAST(COUNT(*) AS BIGINT) AS row_count FROM lineitem""")
def analyze_table(spark, sf):
    """The row count the optimizer recorded."""
    name = f"lines_{uuid.uuid4().hex[:8]}"
    table(spark, sf, "lineitem").write.option("path", scratch_dir(spark, "lines")).saveAsTable(name)
    recorded = catalog.analyze(spark, name)
    return recorded.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"))


# Orders stand for versions: one dataset per customer, committed at the order date.


@check("expiry_candidates", """SELECT version, committed_at, dataset FROM (SELECT o_orderkey AS version,
  o_orderdate AS committed_at, o_custkey AS dataset, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn > 5 AND committed_at < TIMESTAMP '1998-06-01' - INTERVAL 7 DAY""")
def expiry_candidates(spark, sf):
    versions = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS version", "o_orderdate AS committed_at", "o_custkey AS dataset")
    return M.expiry_candidates(versions, "1998-06-01", 7, 5, "dataset").select("version", "committed_at", "dataset")


@check("orphan_candidates", """SELECT file_path, modified_at FROM (SELECT 'part-' || o_orderkey AS file_path,
  o_orderdate AS modified_at FROM orders) WHERE modified_at < TIMESTAMP '1998-06-01' - INTERVAL 3 DAY
  AND file_path NOT IN (SELECT 'part-' || l_orderkey FROM lineitem)""")
def orphan_candidates(spark, sf):
    """Orders stand for files; those with line items are named by a live version."""
    files = table(spark, sf, "orders").selectExpr("'part-' || o_orderkey AS file_path", "o_orderdate AS modified_at")
    live = table(spark, sf, "lineitem").selectExpr("'part-' || l_orderkey AS file_path")
    return M.orphan_candidates(files, live, "1998-06-01", 3)

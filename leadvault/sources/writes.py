"""Writers. Layer settings give each layer's codec and file size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1024 * 1024


@dataclass(frozen=True)
class LayerOptions:
    codec: str
    target_mb: int
    page_bytes: int = MB


# Codec, file size and page size per layer. A write sets codec, page and row-group size; files are brought to
# their size by ``maintenance.compact_files``.
LAYER_OPTIONS = {
    "raw": LayerOptions("gzip", 128),
    "bronze": LayerOptions("zstd", 128),
    "hub": LayerOptions("zstd", 32, 512 * 1024),
    "link": LayerOptions("zstd", 64, 512 * 1024),
    "satellite": LayerOptions("zstd", 128, 512 * 1024),
    "mart": LayerOptions("zstd", 256, 2 * MB),
    "seed": LayerOptions("snappy", 16),
    "snapshot": LayerOptions("zstd", 128),
}


def _writer(df: DataFrame, layer: str, mode: str):
    opts = LAYER_OPTIONS[layer]
    return (df.write.mode(mode).option("compression", opts.codec)
            .option("parquet.page.size", opts.page_bytes)
            .option("parquet.block.size", opts.target_mb * MB))


def append_raw(df: DataFrame, path: str, as_of: str) -> None:
    """Put one extract under its dated folder (year / month / day), gzip parquet. An extract of the same day that was run
    again replaces the first one; other days stay.

    One extract has one date, so rows need no shuffle to reach their partition."""
    day = F.lit(as_of).cast("date")
    dated = df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.day(day)})
    _writer(dated, "raw", "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day").parquet(path)


def full_refresh(df: DataFrame, path: str, layer: str = "bronze", partition_by=()) -> None:
    """Rebuild a dataset. With partitions only those present in the frame are replaced."""
    writer = _writer(df, layer, "overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def write_table(df: DataFrame, path: str, partition_by=(), sort_by=(), distribution: str = "hash",
                distribute_by=(), layer: str = "bronze", mode: str = "overwrite") -> None:
    """Partitioned write, sorted inside each file.

    ``hash`` gathers rows by the distribution columns with a rebalance, which adaptive execution
    splits where one value is heavy and merges where values are small; ``range`` orders the files
    by range, with the sort columns breaking up heavy values; ``none`` writes as the plan left
    the rows."""
    cols = [*(distribute_by or partition_by)]
    if distribution == "hash" and cols:
        df = df.hint("rebalance", *cols)
    elif distribution == "range" and cols:
        df = df.repartitionByRange(*cols, *[c for c in sort_by if c not in cols])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *[c for c in sort_by if c not in partition_by])
    writer = _writer(df, layer, mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, n: int, col: str, path: str) -> None:
    """Table bucketed and sorted by a column; joins and groupings on it need no shuffle.

    Rows are first gathered by bucket, or every task would write a file per bucket."""
    (df.repartition(n, col).write.mode("overwrite").bucketBy(n, col).sortBy(col)
     .option("path", path).saveAsTable(table))


def export_csv(df: DataFrame, path: str) -> None:
    """A chart's data as CSV with header."""
    df.write.mode("overwrite").csv(path, header=True)


def mirror_table(spark: SparkSession, src: str, dst: str, partition_by=(), layer: str = "bronze") -> DataFrame:
    """Copy a dataset, partitioning kept, and read the copy against the original; returns the copy.

    Rows are gathered by partition first, or every task would write a file per partition. A copy with other rows is an
    error, which says how many key ranges differ."""
    from leadvault.operators.quality import differing_ranges

    df = spark.read.parquet(src)
    writer = _writer(df.hint("rebalance", *partition_by) if partition_by else df, layer, "overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(dst)
    copy = spark.read.schema(df.schema).parquet(dst)
    if ranges := differing_ranges(df, copy, df.columns):
        raise RuntimeError(f"the copy of {src} at {dst} differs in {len(ranges)} ranges of rows")
    return copy

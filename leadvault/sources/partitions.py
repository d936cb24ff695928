"""Datasets that a load changes partition by partition: files of the partitions it does not touch stay as they are."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadvault.operators.incremental import merge_upsert
from leadvault.operators.windows import _as_list, latest_of
from leadvault.session import remove_folder, scratch_dir
from leadvault.sources.writes import _writer

#: Partition column of datasets that are kept by key.
PART = "part"


def stored_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A stored dataset, or None where nothing was ever written: no folder, or one without a file. Whatever else is wrong
    with it is an error."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _stored_like(spark: SparkSession, path: str, batch: DataFrame, column: str) -> DataFrame | None:
    """A stored dataset whose partition column has the batch's type, not the one its values look like."""
    old = stored_or_none(spark, path)
    if old is None or old.schema[column].dataType == batch.schema[column].dataType:
        return old
    fields = [batch.schema[column] if f.name == column else f for f in old.schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def key_part(keys, digits: int = 2) -> Column:
    """The partition of a key: ``p`` and the first hex digits of its hash, 16 ** digits partitions of about equal size."""
    text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in _as_list(keys)]
    return F.concat(F.lit("p"), F.substring(F.md5(F.concat_ws("|", *text)), 1, digits))


def partition_values(df: DataFrame, column: str) -> list:
    """The values of a partition column that occur: no more than the dataset has partitions."""
    return [r[0] for r in df.select(column).distinct().collect()]


def within(column: str, values: list) -> Column:
    """Rows of some partitions; literals, so that only their files are listed and read."""
    some = [v for v in values if v is not None]
    inside = F.col(column).isin(some) if some else F.lit(False)
    return inside | F.col(column).isNull() if len(some) < len(values) else inside


def replace_partitions(df: DataFrame, path: str, partition_by, sort_by=(), layer: str = "bronze") -> None:
    """Replace those partitions of a dataset that the frame has rows of. The frame must not read them."""
    cols = _as_list(partition_by)
    df = df.hint("rebalance", *cols)
    if sort_by:
        df = df.sortWithinPartitions(*cols, *[c for c in sort_by if c not in cols])
    _writer(df, layer, "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def _kept_aside(df: DataFrame, label: str, paths: list | None = None) -> DataFrame:
    """The frame written to a fresh scratch folder and read back; ``paths`` notes the folder."""
    path = scratch_dir(df.sparkSession, label)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_partitions(spark: SparkSession, batch: DataFrame, path: str, keys, order_by, partition: str | None = None,
                     digits: int = 2, mode: str = "update", layer: str = "hub") -> list:
    """Merge a batch by key into a stored dataset; returns the partitions it touched.

    The dataset is partitioned by ``partition``, a column that is a function of the key, or by the key's hash. The
    batch is reduced to the newest row per key and tells the partitions; only these are read, merged and replaced, and a
    partition without a row of the batch keeps its files. ``update``: rows of the batch win, ``insert``: stored rows
    win, ``newest``: the greater order columns win, so that batches may come in any order. The merged partitions are
    written aside before they replace the old ones, so they are never read and overwritten by one job, and merging the same
    batch again gives the same. What was written aside goes once it is in its place; after a failure it stays."""
    keys, by, aside = _as_list(keys), partition or PART, []
    newest = latest_of(batch, keys, order_by)
    newest = _kept_aside(newest if partition else newest.withColumn(PART, key_part(keys, digits)), "batch", aside)
    touched = partition_values(newest, by)
    old = _stored_like(spark, path, newest, by)
    if old is not None and touched:
        old = old.filter(within(by, touched))
        if mode == "newest":
            merged = latest_of(old.unionByName(newest, allowMissingColumns=True), keys, order_by)
        else:
            merged = merge_upsert(old, newest, keys, order_by, mode == "update")
        newest = _kept_aside(merged, "merged", aside)
    if touched:
        replace_partitions(newest, path, by, keys, layer)
    for folder in aside:
        remove_folder(spark, folder)
    return touched


def lookback_partitions(spark: SparkSession, new: DataFrame, path: str, date_col: str, days: int, keys, as_of: str,
                        layer: str = "bronze") -> list:
    """Replace, by key, what was re-read for the last ``days`` days in a dataset partitioned by ``date_col`` (a date);
    returns the partitions replaced.

    Partitions before the window keep their files. A stored row of the window that was not read again stays; one
    whose key was read again gives way, also where the new row has another date. Rows of ``new`` from before the window
    are no part of the re-read; of several per key the newest counts."""
    keys, since = _as_list(keys), F.date_sub(F.lit(as_of).cast("date"), days)
    reread = _kept_aside(latest_of(new.filter(F.col(date_col) >= since), keys, date_col), "reread")
    old = stored_or_none(spark, path)
    if old is None:
        replace_partitions(reread, path, date_col, keys, layer)
        return partition_values(reread, date_col)
    window = old.filter(F.col(date_col) >= since)
    moved = window.join(reread.select(*keys), keys, "left_semi").select(date_col)
    touched = partition_values(moved.unionByName(reread.select(date_col)), date_col)
    carried = window.filter(within(date_col, touched)).join(reread.select(*keys), keys, "left_anti")
    replaced = _kept_aside(carried.unionByName(reread, allowMissingColumns=True), "replaced")
    left = partition_values(replaced, date_col)
    replace_partitions(replaced, path, date_col, keys, layer)
    emptied = [d for d in touched if d not in left]
    if emptied:  # all of a day's rows moved to other days
        drop_partitions(spark, path, date_col, emptied)
    return touched


def drop_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Empty whole partitions: each is overwritten by no row, through a table over the dataset."""
    name, schema = f"emptied_{uuid.uuid4().hex[:12]}", spark.read.parquet(path).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in schema if f.name != column)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{path}'")
    try:
        for value in values:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`{column}` = '{value}')")
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{column}` = '{value}') SELECT {nothing} WHERE false")
    finally:
        spark.sql(f"DROP TABLE {name}")

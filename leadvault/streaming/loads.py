"""Incremental loads as streams over parquet folders. Each call takes what is there and stops
(``availableNow``); the checkpoint remembers the files seen, so the next call goes on from it."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadvault.operators.incremental import latest_by_key


def read_stream(spark: SparkSession, src: str, schema, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream, each file once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(src)


def ingest_stream(stream: DataFrame, out: str, checkpoint: str, partition_by=()) -> None:
    """Append new rows to a parquet folder, exactly once."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(out).awaitTermination()


def upsert_stream(stream: DataFrame, root: str, checkpoint: str, keys, order_by, mode: str = "append") -> None:
    """Merge a stream by key, merge-on-read: each batch stores its newest row per key below
    ``<root>/batch=<id>``, and ``read_upserts`` resolves the batches.

    A batch costs what it holds, not what the target holds. A batch that is run again after a
    failure replaces its own folder, so nothing is counted twice."""
    def store(batch: DataFrame, batch_id: int) -> None:
        newest = latest_by_key(batch, keys, order_by)
        newest.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    (stream.writeStream.foreachBatch(store).outputMode(mode).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_upserts(spark: SparkSession, root: str, keys, order_by, schema) -> DataFrame:
    """Current state of an upserted dataset: the newest row per key; at a tie the later batch wins."""
    batches = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(root)
    return latest_by_key(batches, keys, [*order_by, "batch"]).drop("batch")


def fold_upserts(spark: SparkSession, root: str, dst: str, keys, order_by, schema, last_batch: int) -> DataFrame:
    """Fold the batches up to ``last_batch`` into one under a new root, as upkeep when there are many; later
    batches are carried over. Returns the current state of the new root."""
    batches = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(root)
    old = batches.filter(F.col("batch") <= last_batch)
    latest_by_key(old, keys, [*order_by, "batch"]).drop("batch").write.mode("overwrite").parquet(
        f"{dst}/batch={last_batch}")
    batches.filter(F.col("batch") > last_batch).write.mode("append").partitionBy("batch").parquet(dst)
    return read_upserts(spark, dst, keys, order_by, schema)


def _watermarked(stream: DataFrame, event_col: str, lateness: str) -> DataFrame:
    """Stream with a watermark; event times without zone are read in the session's zone, because
    watermarks exist on zoned times only."""
    return stream.withColumn(event_col, F.col(event_col).cast("timestamp")).withWatermark(event_col, lateness)


def dedupe_stream(stream: DataFrame, pk, event_col: str, lateness: str = "28 days") -> DataFrame:
    """Drop repeats of a key that arrive within the allowed lateness; the first row wins. Rows that come
    later than that are dropped."""
    deduped = _watermarked(stream, event_col, lateness).dropDuplicatesWithinWatermark([pk] if isinstance(pk, str) else list(pk))
    return deduped.withColumn(event_col, F.col(event_col).cast(stream.schema[event_col].dataType))


def windowed_counts(stream: DataFrame, ts: str, width: str, *dims: str, lateness: str = "1 day") -> DataFrame:
    """Rows per tumbling window (and dimension); run in update mode, counts refresh as rows come.
    Rows more than ``lateness`` late are dropped."""
    counted = (_watermarked(stream, ts, lateness).groupBy(F.window(ts, width), *dims)
               .agg(F.count(F.lit(1)).alias("n")))
    start = F.col("window.start").cast(stream.schema[ts].dataType)
    return counted.select(start.alias("window_start"), *dims, "n")


#: Keys of a stream are dealt into so many buckets, each with one state.
STATE_BUCKETS = 1024


def _key_text(stream: DataFrame, key: str) -> Column:
    """A key column as text that tells its values apart; NULL stays NULL."""
    kind = stream.schema[key].dataType
    if isinstance(kind, T.BinaryType):
        return F.hex(key)
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(F.struct(key))
    return (F.col(key) + F.lit(0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(key)).cast("string")


def _superseded(rows: pd.DataFrame, order: list) -> pd.Series:
    """Whether a row's order columns are no greater than those of the state beside it (``_was_<column>``)."""
    less, same = pd.Series(False, rows.index), pd.Series(True, rows.index)
    for c in order:
        less |= same & (rows[c] < rows[f"_was_{c}"])
        same &= rows[c] == rows[f"_was_{c}"]
    return less | same


def corrections_stream(stream: DataFrame, pk, event_col: str, order_by, lateness: str = "28 days", buckets: int = STATE_BUCKETS) -> DataFrame:
    """Rows that are the newest of their key so far: the first one of a key, and each later one that ``order_by`` puts above all
    before it. Copies and superseded rows are dropped, in whatever batch and order they arrive.

    The state of a key is the order columns of its newest row, kept until the watermark passes the row's event time by
    ``lateness``; rows of event times that are older than the watermark are dropped. Run in update mode into
    ``upsert_stream``, whose newest row per key is then that of all rows. Order columns must not be NULL.

    Keys are dealt into ``buckets`` by hash, and a bucket's keys are compared at once: one call per bucket and batch, not one per key.
    The number of buckets is part of the checkpoint."""
    keys, order = ([pk] if isinstance(pk, str) else list(pk)), ([order_by] if isinstance(order_by, str) else list(order_by))
    rows = _watermarked(stream, event_col, lateness)
    wait = int(stream.sparkSession.sql(f"SELECT INTERVAL {lateness} AS i").select(
        (F.lit("1970-01-01").cast("timestamp_ntz") + F.col("i")).cast("timestamp").cast("long")).first()[0]) * 1000
    columns, ids = rows.columns, [f"_id_{k}" for k in keys]
    was = {c: f"_was_{c}" for c in order}

    def newest(key, parts, state):
        mark = state.getCurrentWatermarkMs()
        known = pa.ipc.open_stream(bytes(state.get[0])).read_pandas() if state.exists else None
        touched = None
        if not state.hasTimedOut:
            best = None
            for part in parts:
                part = part if best is None else pd.concat([best, part], ignore_index=True)
                best = part.sort_values(order, kind="stable").drop_duplicates(ids, keep="last")
            if known is not None:
                both = best.merge(known, "left", ids, indicator=True)
                touched = both.loc[both["_merge"] == "both", ids]
                best = best[~((both["_merge"] == "both") & _superseded(both, order)).to_numpy()]
            seen = best[event_col].map(lambda t: mark if pd.isna(t) else max(int(t.timestamp() * 1000), mark))
            fresh = best[[*ids, *order]].rename(columns=was).assign(_until=seen.astype("int64") + wait)
            if known is None:
                known = fresh
            elif len(fresh):
                known = pd.concat([known, fresh], ignore_index=True).drop_duplicates(ids, keep="last", ignore_index=True)
        stays = known["_until"] >= mark
        if touched is not None and not stays.all():  # a key that was heard of in this batch ends with a later one
            stays |= known[ids].merge(touched, "left", ids, indicator=True)["_merge"].eq("both").to_numpy()
        known = known[stays].reset_index(drop=True)
        if len(known):
            sink = pa.BufferOutputStream()
            table = pa.Table.from_pandas(known, preserve_index=False)
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            state.update((sink.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(max(int(known["_until"].min()), mark + 1))
        elif state.exists:
            state.remove()
        if not state.hasTimedOut and len(best):
            yield best[columns]

    named = rows.withColumns({i: _key_text(rows, k) for i, k in zip(ids, keys)}).withColumn("_state", F.pmod(F.xxhash64(*ids), F.lit(buckets)))
    found = named.groupBy("_state").applyInPandasWithState(
        newest, rows.schema, "known binary", "update", "EventTimeTimeout")
    return found.withColumn(event_col, F.col(event_col).cast(stream.schema[event_col].dataType))

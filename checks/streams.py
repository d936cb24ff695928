"""Streams over files of the events table, run until nothing is left and compared to the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import table
from checks.registry import check
from leadvault import streaming as ST
from leadvault.session import scratch_dir


def _events_in_files(spark, sf, files=4, copies=1):
    """Events in several files, ordered by time, so that the stream takes several batches."""
    src = scratch_dir(spark, "events")
    events = table(spark, sf, "events")
    if copies > 1:
        events = events.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    events.repartitionByRange(files, "ts").write.parquet(src)
    return src, table(spark, sf, "events").schema


@check("ingest_stream", "SELECT * FROM events")
def ingest_stream(spark, sf):
    """Run twice over the same folder: the second run finds nothing new."""
    src, schema = _events_in_files(spark, sf)
    out, checkpoint = scratch_dir(spark, "ingested"), scratch_dir(spark, "checkpoint")
    for _ in range(2):
        ST.ingest_stream(ST.read_stream(spark, src, schema, files_per_batch=2), out, checkpoint)
    return spark.read.schema(schema).parquet(out)


@check("upsert_stream", "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def upsert_stream(spark, sf):
    """Newest event per user, merged batch by batch."""
    src, schema = _events_in_files(spark, sf)
    root = scratch_dir(spark, "upserted")
    stream = ST.read_stream(spark, src, schema, files_per_batch=2)
    ST.upsert_stream(stream, root, scratch_dir(spark, "checkpoint"), ["user_id"], ["ts", "event_id"])
    return ST.read_upserts(spark, root, ["user_id"], ["ts", "event_id"], schema)


@check("fold_upserts", "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def fold_upserts(spark, sf):
    """The stored batches folded into one."""
    src, schema = _events_in_files(spark, sf)
    root = scratch_dir(spark, "upserted")
    ST.upsert_stream(ST.read_stream(spark, src, schema, files_per_batch=1), root, scratch_dir(spark, "checkpoint"),
                     ["user_id"], ["ts", "event_id"])
    return ST.fold_upserts(spark, root, scratch_dir(spark, "folded"), ["user_id"], ["ts", "event_id"], schema, 99)


@check("dedupe_stream", "SELECT * FROM events")
def dedupe_stream(spark, sf):
    """Every event delivered three times."""
    src, schema = _events_in_files(spark, sf, copies=3)
    out = scratch_dir(spark, "deduped")
    deduped = ST.dedupe_stream(ST.read_stream(spark, src, schema, files_per_batch=2), ["event_id"], "ts")
    ST.ingest_stream(deduped, out, scratch_dir(spark, "checkpoint"))
    return spark.read.schema(schema).parquet(out)


@check("corrections_stream", """SELECT event_id, user_id, event_type, ts, CASE WHEN event_id % 3 = 0 THEN CAST(value + 2 AS DOUBLE)
    WHEN event_id % 3 = 1 THEN CAST(value + 1 AS DOUBLE) ELSE CAST(value AS DOUBLE) END AS value,
  CASE WHEN event_id % 3 = 0 THEN 2 WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS load FROM events""")
def corrections_stream(spark, sf):
    """Events delivered twice each, and up to two corrections, dealt to files at random: corrections come in other batches than
    what they correct, before it or after it."""
    src = scratch_dir(spark, "events")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", F.col("value").cast("double").alias("value"))
    loads = F.when(F.col("event_id") % 3 == 0, F.array(*map(F.lit, (0, 1, 2)))).when(
        F.col("event_id") % 3 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = events.withColumn("load", F.explode(F.concat(loads, loads))).withColumn("value", F.col("value") + F.col("load"))
    sent.repartition(6, F.xxhash64("event_id", "load", F.monotonically_increasing_id())).write.parquet(src)
    newest = ST.corrections_stream(ST.read_stream(spark, src, sent.schema, files_per_batch=2), "event_id", "ts", "load", "60 days")
    root = scratch_dir(spark, "corrected")
    ST.upsert_stream(newest, root, scratch_dir(spark, "checkpoint"), ["event_id"], ["load"], "update")
    return ST.read_upserts(spark, root, ["event_id"], ["load"], sent.schema)


@check("windowed_counts", """SELECT date_trunc('day', ts) AS window_start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def windowed_counts(spark, sf):
    """Daily counts, refreshed by each batch and merged by window."""
    src, schema = _events_in_files(spark, sf)
    root = scratch_dir(spark, "counts")
    counts = ST.windowed_counts(ST.read_stream(spark, src, schema, files_per_batch=2), "ts", "1 day", "event_type")
    ST.upsert_stream(counts, root, scratch_dir(spark, "checkpoint"), ["window_start", "event_type"], ["n"], "update")
    return ST.read_upserts(spark, root, ["window_start", "event_type"], ["n"], counts.schema)

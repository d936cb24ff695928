"""State of streams."""

import datetime as dt
import random

from leadvault.session import scratch_dir
from leadvault.streaming import loads as ST

SCHEMA = "k string, at timestamp_ntz, load int, note string"


def _run(spark, batches, lateness, **options):
    """The rows that `corrections_stream` passes on, by batch, and the rows its state holds after each."""
    src, seen, checkpoint = scratch_dir(spark, "sent"), [], scratch_dir(spark, "checkpoint")
    held = []
    for rows in batches:  # one file a batch, each taken by a query that goes on from the checkpoint
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = ST.corrections_stream(ST.read_stream(spark, src, spark.createDataFrame([], SCHEMA).schema), "k", "at", "load", lateness, **options)
        found = []
        query = (stream.writeStream.foreachBatch(lambda df, _: found.extend(map(tuple, df.collect()))).outputMode("update")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        seen.append(sorted(found, key=repr))
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    return seen, held


def test_corrections_by_bucket_equal_corrections_by_key(spark):
    """Also keys that are NULL, copies inside a batch and across, corrections before what they correct. A bucket of keys is one state."""
    deal, now = random.Random(3), dt.datetime(2024, 1, 1)
    batches = [[(deal.choice([None, "", *map(str, range(60))]), now + dt.timedelta(minutes=deal.randrange(60)), deal.randrange(4), f"n{b}")
                for _ in range(150)] for b in range(3)]
    seen, held = _run(spark, batches, "28 days", buckets=4)
    best = {}
    for rows, passed in zip(batches, seen):
        want = {}
        for r in rows:
            if r[0] not in best or r[2] > best[r[0]]:
                best[r[0]], want[r[0]] = r[2], r[2]
        assert len(passed) == len(want) and {r[0]: r[2] for r in passed} == want
        assert {r for r in passed} <= set(rows)
    assert max(held) <= 4


def test_corrections_forget_keys_by_the_watermark(spark):
    """An hour after a key's event time, by the watermark, its state is gone, and with its last key a bucket's."""
    day = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    seen, held = _run(spark, [[("a", day[0], 5, "x"), ("b", day[0], 5, "x")], [("a", day[0], 4, "late"), ("b", day[0], 6, "y")],
                              [("c", day[3], 1, "z")], [("c", day[3], 2, "z")], [("c", day[4], 1, "z")]], "1 hour", buckets=256)
    assert [[r[0] for r in s] for s in seen] == [["a", "b"], ["b"], ["c"], ["c"], []]
    assert held[1] == 2 and held[-1] == 0

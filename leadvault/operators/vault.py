"""Hubs, links, satellites, snapshots and change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadvault.functions import hash_diff, hash_key
from leadvault.operators.aggregates import earliest_row
from leadvault.operators.incremental import new_keys
from leadvault.operators.rows import require
from leadvault.operators.windows import _as_list, close_versions


def load_hub(source: DataFrame, key: str, target: DataFrame | None = None,
             load_date: str = "load_date", record_source: str = "record_source") -> DataFrame:
    """Rows to append to a hub: business keys it does not hold, each with its earliest sighting.

    The batch is reduced to one row per key before it meets the hub, of which only the key
    column is read. Appending the result, rather than rewriting the hub, is the load."""
    batch = earliest_row(require(source, key), [key], [load_date, record_source])
    return new_keys(batch, target, key)


def load_link(pairs: DataFrame, left: str, right: str, key: str, target: DataFrame | None = None,
              load_date: str = "load_date", record_source: str = "record_source") -> DataFrame:
    """Rows to append to a link between two hubs: new pairs with their earliest sighting."""
    batch = earliest_row(require(pairs, left, right), [left, right], [load_date, record_source])
    keyed = batch.select(hash_key(left, right).alias(key), left, right, load_date, record_source)
    return new_keys(keyed, target, key)


def version_history(rows: DataFrame, key: str, load_date: str, diff: str, end_col: str = "load_end_date",
                    mode: str = "consecutive") -> DataFrame:
    """Type-2 history: one row per version with the load date that ended it.

    ``consecutive`` drops a row that repeats the key's previous version, so A, B, A keeps three
    versions; ``first_seen`` keeps each distinct version once, at its first load. Rows of one
    key and load date are ordered by change hash.

    Only a summary with one row per (key, load date) is ordered per key, so the rows of a hot
    key are spread over its load dates and no task holds them all: within a date, hashes are
    distinct, so just the date's least hash can repeat the previous version, and just its
    greatest hash lives on to the next date. Repeats are dropped by the join with that summary,
    before whole rows are grouped."""
    rest = [c for c in rows.columns if c not in (key, load_date, diff)]
    if mode == "first_seen":
        rows = earliest_row(rows, [key, diff], [load_date, *rest])

    dates = rows.groupBy(key, load_date).agg(F.min(diff).alias("_lo"), F.max(diff).alias("_hi"))
    in_order = Window.partitionBy(key).orderBy(load_date)
    if mode == "first_seen":
        dates = dates.withColumn("_repeat", F.lit(None).cast("string"))
    else:
        dates = dates.withColumn("_before", F.lag("_hi").over(in_order)).withColumn(
            "_repeat", F.when(F.col("_lo") == F.col("_before"), F.col("_lo")))
    # A date whose only row is a repeat ends no version.
    alive = dates.filter(F.col("_repeat").isNull() | (F.col("_lo") != F.col("_hi")))
    alive = alive.withColumn("_next", F.lead(load_date).over(in_order)).select(
        key, load_date, "_repeat", "_hi", "_next")

    end = F.when(F.col(diff) == F.col("_hi"), F.col("_next")).otherwise(F.col(load_date))
    alive = alive.withColumnsRenamed({key: "_key", load_date: "_at"})  # a load date may be NULL: the oldest
    versions = (rows.join(alive, (F.col(key) == F.col("_key")) & F.col(load_date).eqNullSafe(F.col("_at")))
                .filter(F.col("_repeat").isNull() | (F.col(diff) != F.col("_repeat")))
                .select(*rows.columns, end.alias(end_col)))
    if mode == "first_seen":
        return versions
    return earliest_row(versions, [key, load_date, diff], [*rest, end_col]).select(versions.columns)


def load_satellite(batch: DataFrame, key: str, load_date: str, diff: str, target: DataFrame | None = None,
                   end_col: str = "load_end_date", mode: str = "consecutive") -> DataFrame:
    """Satellite state after a batch: the history of every key in the batch is rebuilt from its
    stored versions and the new rows, so versions left open earlier are closed; other keys pass
    through. Loading the same batch again changes nothing."""
    if target is None:
        return version_history(batch, key, load_date, diff, end_col, mode)
    touched = batch.select(key).distinct()
    stored = target.join(touched, key, "left_semi").drop(end_col)
    rebuilt = version_history(stored.unionByName(batch, allowMissingColumns=True), key, load_date, diff, end_col, mode)
    return target.join(touched, key, "left_anti").unionByName(rebuilt, allowMissingColumns=True)


def earlier_rows(batch: DataFrame, target: DataFrame | None, keys, order) -> DataFrame:
    """Rows of a batch (one per key) that an insert-only table lacks, or has with greater ``order`` columns only.

    Appending them keeps the load insert-only and makes it independent of the order in which batches arrive: readers take
    the least row per key. Only the keys and order columns of the target are read, and only for keys of the batch."""
    if target is None:
        return batch
    keys, order = _as_list(keys), _as_list(order)
    known = target.select(*keys, *order).join(batch.select(*keys), keys, "left_semi").groupBy(*keys).agg(
        F.min(F.struct(*order)).alias("_known"))
    return batch.join(known, keys, "left").filter(
        F.col("_known").isNull() | (F.struct(*order) < F.col("_known"))).select(batch.columns)


def _same(left: DataFrame, right: DataFrame, cols, how: str) -> DataFrame:
    """Semi or anti join on columns that may hold NULL."""
    named = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols])
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols]
    return left.join(named, on, how)


def new_versions(batch: DataFrame, stored: DataFrame | None, key: str, load_date: str, diff: str) -> DataFrame:
    """Rows of a batch to append to a satellite that is only ever appended to: versions it lacks.

    What is in force before and after a row follows from the stored versions of the batch's keys, of which only key, date
    and change hash are read. A row that repeats the version before it is none; it becomes one when a late row is loaded
    between them, so a late batch brings the rows of its keys since then along (see ``layers``). Versions that
    a late row turns into repeats stay stored and are left out by ``satellite_history``."""
    slim, rest = [key, load_date, diff], [c for c in batch.columns if c not in (key, load_date, diff)]
    seen = batch.select(*slim)
    known = None
    if stored is not None:
        known = stored.select(*slim).join(batch.select(key).distinct(), key, "left_semi")
        seen = seen.unionByName(known)
    versions = version_history(seen.distinct(), key, load_date, diff).select(*slim)
    fresh = versions if known is None else _same(versions, known, slim, "left_anti")
    return earliest_row(_same(batch, fresh, slim, "left_semi"), slim, rest).select(batch.columns)


def satellite_history(stored: DataFrame, key: str, load_date: str, diff: str, end_col: str = "load_end_date") -> DataFrame:
    """An appended satellite as its readers see it: each version with the date that ended it, NULL while it is in force.

    Ends are not stored, so closing a version rewrites nothing; they follow from a summary with one row per key and
    date."""
    return version_history(stored, key, load_date, diff, end_col)


def snapshot_scd2(source: DataFrame, keys, updated_at: str, target: DataFrame | None = None,
                  bucket: Column | None = None) -> DataFrame:
    """Type-2 snapshot by timestamp: a version per (key, updated_at), valid until the next one.

    ``bucket`` is the slice of ``updated_at`` that bounds a task's share of one key; its month by
    default."""
    keys = _as_list(keys)
    rows = source
    if target is not None:
        rows = target.drop("valid_from", "valid_to").unionByName(source, allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in [*keys, updated_at]]
    versions = earliest_row(rows, [*keys, updated_at], rest)
    slice_of = bucket if bucket is not None else F.trunc(F.col(updated_at), "month")
    closed = close_versions(versions, keys, [updated_at], "valid_to", slice_of)
    return closed.withColumn("valid_from", F.col(updated_at))


def changelog(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Row changes between two states that are unique on their keys: ``insert``, ``delete``, and
    ``update_before`` / ``update_after`` for rows whose other columns differ (NULL is a value of its own)."""
    keys = _as_list(keys)
    rest = [c for c in new.columns if c not in keys]
    pack = F.struct(*rest)

    def side(df, name):
        return df.select(*keys, pack.alias(name), F.lit(True).alias(f"in_{name}"))

    both = side(old, "before").join(side(new, "after"), keys, "full")
    same = F.col("in_before").isNotNull() & F.col("in_after").isNotNull() & F.col("before").eqNullSafe(F.col("after"))
    both = both.filter(~same)
    step = lambda name, row: F.struct(F.lit(name).alias("change_type"), row.alias("row"))
    before, after = F.col("before"), F.col("after")
    steps = (F.when(F.col("in_before").isNull(), F.array(step("insert", after)))
             .when(F.col("in_after").isNull(), F.array(step("delete", before)))
             .otherwise(F.array(step("update_before", before), step("update_after", after))))
    out = both.select(*keys, F.explode(steps).alias("s"))
    return out.select("s.change_type", *keys, *[F.col(f"s.row.{c}").alias(c) for c in rest])


def with_ghost_record(hub: DataFrame, key: str, load_date: str = "load_date",
                      record_source: str = "record_source", kinds=("ghost", "error")) -> DataFrame:
    """Hub plus one placeholder row per kind, for facts whose key is missing or broken."""
    spark = hub.sparkSession
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"))
    ghosts = rows.select(
        F.md5("kind").alias(key),
        F.lit("1900-01-01").cast(hub.schema[load_date].dataType).alias(load_date),
        F.col("kind").alias(record_source))
    return hub.unionByName(ghosts, allowMissingColumns=True)

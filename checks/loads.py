"""Sources, loads and sinks. What is written goes to a fresh scratch folder and is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import cte, frame, table
from checks.registry import check
from leadvault.operators import incremental as I
from leadvault.operators import rows as R
from leadvault.operators.aggregates import count_by
from leadvault.session import scratch_dir
from leadvault.sources import catalog, reads, schemas, writes
from leadvault.sources import partitions as P
from leadvault.sources.versions import current, publish


def _stamp(text):
    return F.lit(text).cast("timestamp_ntz")


@check("scan_bronze", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def scan_bronze(spark, sf):
    schema = table(spark, sf, "orders").select("o_orderkey", "o_orderdate").schema
    return reads.scan_bronze(spark, f"{sf}/orders.parquet", schema, "1998-01-01", "o_orderdate")


@check("with_audit", """SELECT o_orderkey, TIMESTAMP '2024-03-05 06:00:00' AS _extraction_timestamp, 'crm' AS _source_system,
  DATE '2024-03-05' AS _load_date, 'crm' AS record_source FROM orders""")
def with_audit(spark, sf):
    return reads.with_audit(table(spark, sf, "orders").select("o_orderkey"), "crm", "2024-03-05 06:00:00")


@check("append_raw", """SELECT *, 2024 AS year, 3 AS month, 5 AS day FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT *, 2024, 3, 6 FROM customer""")
def append_raw(spark, sf):
    out, customers = scratch_dir(spark, "append"), table(spark, sf, "customer")
    writes.append_raw(customers.filter("c_custkey % 2 = 0"), out, "2024-03-05")
    for _ in range(2):  # a day that is run again
        writes.append_raw(customers, out, "2024-03-06")
    return spark.read.parquet(out)


@check("full_refresh", """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 2 = 0""")
def full_refresh(spark, sf):
    """A rebuild of everything, then one of a single partition, which leaves the others alone."""
    out = scratch_dir(spark, "refresh")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    writes.full_refresh(orders, out, partition_by=["o_orderstatus"])
    writes.full_refresh(orders.filter("o_orderstatus = 'P' AND o_orderkey % 2 = 0"), out, partition_by=["o_orderstatus"])
    return reads.read_table(spark, out)


@check("incremental_append", """SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-15'
  OR ts > (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')""")
def incremental_append(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return I.incremental_append(events, events.filter(F.col("ts") < _stamp("2024-01-15")), "ts")


@check("latest_by_key", """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def latest_by_key(spark, sf):
    """Composite key."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_suppkey")
    return I.latest_by_key(df, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).drop("l_suppkey")


@check("lookback_replace", """SELECT event_id, user_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-03' AND event_id % 2 = 0
  THEN value + 1 ELSE value END AS value FROM events WHERE event_id % 5 <> 0 OR (ts >= TIMESTAMP '2024-01-03' AND event_id % 2 = 0)""")
def lookback_replace(spark, sf):
    """The target misses every fifth event; even events are re-read with a corrected value."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    reread = events.filter("event_id % 2 = 0").withColumn("value", F.col("value") + 1)
    target = events.filter("event_id % 5 <> 0")
    return I.lookback_replace(target, reread, "ts", 28, ["event_id", "user_id"], "2024-01-31")


def _files_by(spark, path, column):
    """Which files each partition has."""
    part = F.regexp_extract("file_path", f"{column}=([^/]*)", 1)
    return {r[0]: r[1] for r in reads.list_files(spark, path).groupBy(part).agg(F.array_sort(F.collect_list("file_path"))).collect()}


def _with_kept(df, column, before, after):
    """Adds whether the partition still has the very files it had."""
    kept = [k for k, files in before.items() if after.get(k) == files]
    return df.withColumn("files_kept", F.col(column).cast("string").isin(kept))


@check("merge_partitions", """WITH parts AS (
    SELECT c_custkey, c_name, c_acctbal, 'p' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 1) AS part FROM customer),
  state AS (
    SELECT part, CASE WHEN part IN ('p0', 'p7', 'pc') AND c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance
    FROM parts WHERE c_custkey % 10 <> 0 OR part IN ('p0', 'p7', 'pc'))
  SELECT part, COUNT(*) AS n_rows, CAST(SUM(CAST(round(balance * 100) AS BIGINT)) AS BIGINT) AS cents,
    part NOT IN ('p0', 'p7', 'pc') AS files_kept FROM state GROUP BY part""")
def merge_partitions(spark, sf):
    """A batch of changed and new customers in three of sixteen key partitions, merged twice."""
    root = scratch_dir(spark, "merged")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.lit(0).alias("seen"))
    P.merge_partitions(spark, customers.filter("c_custkey % 10 <> 0"), root, "c_custkey", "seen", digits=1)
    before = _files_by(spark, root, P.PART)
    batch = customers.filter("c_custkey % 2 = 0").filter(P.key_part("c_custkey", 1).isin("p0", "p7", "pc")).select(
        "c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"), F.lit(1).alias("seen"))
    older = batch.withColumns({"seen": F.lit(0), "c_acctbal": F.lit(0.0).cast(batch.schema["c_acctbal"].dataType)})
    for _ in range(2):
        P.merge_partitions(spark, batch.unionByName(older), root, "c_custkey", "seen", digits=1)
    cents = F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("cents")
    state = spark.read.parquet(root).groupBy("part").agg(F.count("*").alias("n_rows"), cents)
    return _with_kept(state, "part", before, _files_by(spark, root, P.PART))


@check("lookback_partitions", """WITH moved AS (
    SELECT event_id, CAST(ts AS DATE) AS day, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
  state AS (
    SELECT event_id, CASE WHEN event_id % 7 = 0 AND day >= DATE '2024-01-20' THEN DATE '2024-01-31' ELSE day END AS day,
      CASE WHEN day >= DATE '2024-01-20' AND (event_id % 2 = 0 OR event_id % 7 = 0) THEN cents + 1 ELSE cents END AS cents
    FROM moved WHERE event_id % 5 <> 0 OR (day >= DATE '2024-01-20' AND (event_id % 2 = 0 OR event_id % 7 = 0)))
  SELECT day, COUNT(*) AS n_rows, CAST(SUM(cents) AS BIGINT) AS cents, day < DATE '2024-01-20' AS files_kept
  FROM state GROUP BY day""")
def lookback_partitions(spark, sf):
    """Events by day, every fifth missing; of the last days some are read again, corrected, some of them under another day."""
    root = scratch_dir(spark, "lookback")
    cents = F.round(F.col("value") * 100).cast("bigint").alias("cents")
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("day"), cents)
    P.replace_partitions(events.filter("event_id % 5 <> 0"), root, "day")
    before = _files_by(spark, root, "day")
    again = events.filter("event_id % 2 = 0 OR event_id % 7 = 0").withColumn("cents", F.col("cents") + 1)
    late = F.to_date(F.lit("2024-01-31"))
    moved = F.when((F.col("event_id") % 7 == 0) & (F.col("day") >= "2024-01-20"), late).otherwise(F.col("day"))
    P.lookback_partitions(spark, again.withColumn("day", moved), root, "day", 11, "event_id", "2024-01-31")
    state = spark.read.parquet(root).groupBy("day").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("cents"))
    return _with_kept(state, "day", before, _files_by(spark, root, "day"))


@check("date_bounds", """SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'""")
def date_bounds(spark, sf):
    return R.date_bounds(table(spark, sf, "orders"), "o_orderdate", "1996-01-01", "1997-12-31").select("o_orderkey")


@check("exclude_deleted", cte("contacts") + "SELECT id, anonymized FROM contacts WHERE deleted <> '1'")
def exclude_deleted(spark, sf):
    return R.exclude_deleted(frame(spark, sf, "contacts")).select("id", "anonymized")


@check("unpack_answers", cte("leads") + """SELECT id, json_extract_string(field_data, '$[0].values[0]') AS full_name,
  json_extract_string(field_data, '$[1].values[0]') AS email, json_extract_string(field_data, '$[2].values[0]') AS phone
  FROM leads""")
def unpack_answers(spark, sf):
    leads = frame(spark, sf, "leads").select("id", "field_data")
    return reads.unpack_answers(leads, {"full_name": "full_name", "email": "email", "phone": "phone_number"})


@check("read_nested", cte("contacts") + """SELECT id, json_extract_string(fields, '$.utm_source') AS utm_source,
  json_extract_string(fields, '$.lead_source') AS lead_source FROM contacts""")
def read_nested(spark, sf):
    contacts = frame(spark, sf, "contacts").select("id", "fields")
    nested = reads.read_nested(contacts, "fields", "utm_source string, lead_source string",
                               {"utm_source": "utm_source", "lead_source": "lead_source"})
    return nested.drop("fields")


# Rejects: which stream, why, and the text. Of every stream some objects are cut, some hold a word where a number or a date belongs.
_STREAMS = {
    "crm_campaigns": (schemas.CRM_CAMPAIGNS, "region", "r_regionkey", {"sdate": "date", "opens": "bigint"}),
    "crm_lists": (schemas.CRM_LISTS, "nation", "n_nationkey", {"cdate": "date"}),
    "crm_deals": (schemas.CRM_DEALS, "supplier", "s_suppkey", {"cdate": "date", "value": "bigint"}),
    "ad_sets": (schemas.AD_SETS, "customer", "c_custkey", {"created_time": "date", "daily_budget": None}),
    "ads": (schemas.ADS, "part", "p_partkey", {"created_time": "date"}),
}


def _object(key, day, number):
    """A JSON object of a source with all the fields the streams below look at."""
    text = f"""'{{"id":"' || CAST({key} AS STRING) || '","{day}":"' || CASE WHEN {key} % 7 = 3 THEN 'soon' ELSE '2024-01-0' || CAST(1 + {key} % 9 AS STRING) END || '"'"""
    if number:
        quoted = "" if number == "daily_budget" else '"'
        text += f""" || ',"{number}":' || CASE WHEN {key} % 5 = 2 THEN '"many"' ELSE '{quoted}' || CAST({key} AS STRING) || '{quoted}' END"""
    return text + f""" || CASE WHEN {key} % 11 = 4 THEN '' ELSE '}}' END"""


def _stream_sql():
    parts = []
    for name, (_, source, key, casts) in _STREAMS.items():
        day, *number = casts
        broken, soon = f"{key} % 11 = 4", f"{key} % 7 = 3"
        if number and casts[number[0]] is None:  # declared as a number: the object itself does not fit
            broken, number = f"({key} % 11 = 4 OR {key} % 5 = 2)", []
        parts += [f"SELECT '{name}' AS stream, NULL AS column_name, COUNT(*) FILTER (NOT {broken}) AS accepted, COUNT(*) FILTER ({broken}) AS rejected FROM {source}",
                  f"SELECT '{name}', '{day}', COUNT(*) FILTER (NOT {broken} AND NOT {soon}), COUNT(*) FILTER (NOT {broken} AND {soon}) FROM {source}"]
        parts += [f"SELECT '{name}', '{n}', COUNT(*) FILTER (NOT {broken} AND {key} % 5 <> 2), COUNT(*) FILTER (NOT {broken} AND {key} % 5 = 2) FROM {source}" for n in number]
    return " UNION ALL ".join(parts)


@check("declared_streams", _stream_sql())
def declared_streams(spark, sf):
    """Five streams from JSON by their declared schemas: objects that don't fit, and values a cast loses, are kept as rejects."""
    found = []
    for name, (stream, source, key, casts) in _STREAMS.items():
        folder = scratch_dir(spark, name)
        day, *number = casts
        table(spark, sf, source).selectExpr(f"{_object(key, day, number[0] if number else None)} AS value").write.text(folder)
        rows, rejects = reads.read_declared(spark, folder, stream)
        counts = rows.agg(F.count("*").alias("accepted")).select(F.lit(None).cast("string").alias("column_name"), "accepted")
        lost = rejects.groupBy("column_name").agg(F.count("*").alias("rejected"))
        typed, uncast = reads.cast_declared(rows, {c: t for c, t in casts.items() if t}, ["id"])
        for column in (c for c, t in casts.items() if t):
            counts = counts.unionByName(typed.agg(F.count(column).alias("accepted")).select(F.lit(column).alias("column_name"), "accepted"))
        lost = lost.unionByName(uncast.groupBy("column_name").agg(F.count("*").alias("rejected"))).withColumnRenamed("column_name", "c")
        both = counts.join(lost, F.col("c").eqNullSafe(F.col("column_name")), "left")
        found.append(both.select(F.lit(name).alias("stream"), "column_name", "accepted", F.coalesce("rejected", F.lit(0)).alias("rejected")))
    return R.union_aligned(*found)


@check("write_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def write_table(spark, sf):
    """Hash-distributed, partitioned and sorted."""
    out = scratch_dir(spark, "table")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    writes.write_table(orders, out, ["o_orderstatus"], ["o_custkey", "o_orderkey"], "hash", layer="hub")
    return spark.read.parquet(out)


@check("write_table_range", "SELECT l_suppkey, COUNT(*) AS n, CAST(SUM(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1")
def write_table_range(spark, sf):
    """Range-distributed; the reader aggregates what was written."""
    out = scratch_dir(spark, "ranged")
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    writes.write_table(lines, out, (), ["l_suppkey", "l_orderkey"], "range", ["l_suppkey"], layer="mart")
    return spark.read.parquet(out).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@check("bucketed_table", """SELECT o_custkey, COUNT(*) AS n_orders, MAX(c_name) AS c_name FROM orders
  JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey""")
def bucketed_table(spark, sf):
    """Both sides bucketed on the join key: joined and grouped without a shuffle."""
    run = uuid.uuid4().hex[:8]
    names = {}
    for name, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        names[name] = f"{name}_{run}"
        writes.write_bucketed(table(spark, sf, name), names[name], 10, key, scratch_dir(spark, name))
    joined = spark.table(names["orders"]).join(spark.table(names["customer"]), F.expr("o_custkey = c_custkey"))
    return joined.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("c_name").alias("c_name"))


@check("ensure_table", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer""")
def ensure_table(spark, sf):
    """Create if absent, twice; set a property; insert; read back through another registration."""
    name, out = f"people_{uuid.uuid4().hex[:8]}", scratch_dir(spark, "people")
    for _ in range(2):
        catalog.ensure_table(spark, name, "id bigint, name string, segment string", ["segment"], ["id"],
                             {"source": "crm"}, out)
    catalog.set_properties(spark, name, {"layer": "hub"})
    rows = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    rows.write.mode("append").insertInto(name)
    return catalog.register_path(spark, f"{name}_again", out).select("id", "name", "segment")


@check("alter_columns", """SELECT c_custkey AS id, c_name, c_nationkey, c_mktsegment, CAST(NULL AS VARCHAR) AS note FROM customer""")
def alter_columns(spark, sf):
    customers = table(spark, sf, "customer")
    return catalog.alter_columns(customers, {"note": "string"}, ["c_acctbal"], {"c_custkey": "id"})


@check("alter_table", """SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS note FROM nation""")
def alter_table(spark, sf):
    """Columns added in place and a table renamed; files are not rewritten."""
    name = f"lands_{uuid.uuid4().hex[:8]}"
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    nations.write.option("path", scratch_dir(spark, "lands")).saveAsTable(name)
    catalog.add_columns(spark, name, "note string")
    catalog.rename_table(spark, name, f"{name}_renamed")
    return spark.table(f"{name}_renamed")


@check("ensure_layers", """SELECT layer, COUNT(*) AS n_rows FROM region CROSS JOIN (SELECT unnest(['bronze', 'gold', 'seeds',
  'silver', 'snapshots', 'test_failures']) AS layer) GROUP BY layer""")
def ensure_layers(spark, sf):
    """One table per layer database; the result counts each layer's rows."""
    env = f"dev{uuid.uuid4().hex[:6]}"
    names = catalog.ensure_layers(spark, env, scratch_dir(spark, "layerdbs"))
    catalog.ensure_layers(spark, env)
    parts = []
    for name in names:
        table(spark, sf, "region").write.saveAsTable(f"{name}.region")
        listed = catalog.list_tables(spark, name).count()
        if listed != 1:
            raise AssertionError(f"{name} lists {listed} tables")
        layer = F.lit(name.removeprefix(f"{env}_")).alias("layer")
        parts.append(spark.table(f"{name}.region").groupBy(layer).agg(F.count(F.lit(1)).alias("n_rows")))
    return R.union_aligned(*parts)


@check("seed_load", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def seed_load(spark, sf):
    out, nations = scratch_dir(spark, "seed"), table(spark, sf, "nation")
    writes.export_csv(nations, out)
    return reads.load_seed(spark, out, nations.schema)


@check("export_csv", "SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1")
def export_csv(spark, sf):
    out, chart = scratch_dir(spark, "csv"), count_by(table(spark, sf, "orders"), "o_orderpriority")
    writes.export_csv(chart, out)
    return spark.read.schema(chart.schema).csv(out, header=True)


@check("materialize", cte("contact_versions") + """SELECT 'view' AS mode, COUNT(*) AS n FROM contact_versions
  UNION ALL SELECT 'table', COUNT(*) FROM contact_versions
  UNION ALL SELECT 'incremental', COUNT(DISTINCT id) FROM contact_versions""")
def materialize(spark, sf):
    rows = frame(spark, sf, "contact_versions")
    name = f"contacts_{uuid.uuid4().hex[:8]}"
    built = {"view": catalog.materialize(rows, "view", name),
             "table": catalog.materialize(rows, "table", name, scratch_dir(spark, "model"))}
    root = scratch_dir(spark, "merged")
    for day in ("2023-01-01", "2023-02-01", "2023-03-01"):
        batch = rows.filter(F.col("load_date") == F.lit(day).cast("date"))
        built["incremental"] = catalog.materialize(batch, "incremental", name, root, ["id"], ["load_date"])
    return R.union_aligned(*[df.groupBy(F.lit(m).alias("mode")).agg(F.count(F.lit(1)).alias("n"))
                             for m, df in built.items()])


@check("versioned_dataset", """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'""")
def versioned_dataset(spark, sf):
    """Three versions, the second written again under its number; readers see the third."""
    root = scratch_dir(spark, "versions")
    orders = table(spark, sf, "orders")
    for version, end in ((1, "1996-01-01"), (2, "1997-01-01"), (2, "1999-01-01"), (3, "1998-01-01")):
        rows = orders.filter(F.col("o_orderdate") < _stamp(end)).select("o_orderkey", "o_orderstatus")
        publish(rows, root, end, version)
    return current(spark, root)


@check("evolve_union", """SELECT c_custkey, c_name, NULL AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer WHERE c_custkey % 2 = 1""")
def evolve_union(spark, sf):
    customers = table(spark, sf, "customer")
    return R.evolve_union(customers.filter("c_custkey % 2 = 0").select("c_custkey", "c_name"),
                          customers.filter("c_custkey % 2 = 1").select("c_mktsegment", "c_custkey"))


@check("mirror_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def mirror_table(spark, sf):
    src, dst = scratch_dir(spark, "mirror-src"), scratch_dir(spark, "mirror-dst")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    writes.write_table(orders, src, ["o_orderstatus"])
    return writes.mirror_table(spark, src, dst, ["o_orderstatus"])


@check("read_catalog_and_views", """SELECT 'parquet' AS source, COUNT(*) AS n FROM supplier UNION ALL SELECT 'view', COUNT(*) FROM supplier""")
def read_catalog_and_views(spark, sf):
    view = f"suppliers_{uuid.uuid4().hex[:8]}"
    table(spark, sf, "supplier").createOrReplaceTempView(view)
    sources = {"parquet": f"{sf}/supplier.parquet", "view": view}
    return R.union_aligned(*[reads.read_table(spark, at).groupBy(F.lit(n).alias("source")).agg(
        F.count(F.lit(1)).alias("n")) for n, at in sources.items()])

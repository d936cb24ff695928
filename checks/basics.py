"""Each small operator alone, on the plain test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import table
from checks.registry import check
from leadvault.functions import (
    all_present, any_positive, as_date, band, clean_lower, clean_upper, days_between, digits, first_usable, flag,
    flag01, hash_key, is_current, is_recent, json_fields, non_blank, not_sentinel, partition_expr, ratio, score,
    tagged_name,
)
from leadvault.functions.text import concat_all
from leadvault.operators import aggregates as A
from leadvault.operators import joins as J
from leadvault.operators import rows as R
from leadvault.operators import windows as W
from leadvault.operators.incremental import max_of, newer_than

# ---- projections ----


@check("project_rename", "SELECT p_partkey AS campaign_id, p_name AS nome, p_type AS objetivo FROM part")
def project_rename(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("campaign_id"), F.col("p_name").alias("nome"), F.col("p_type").alias("objetivo"))


@check("project_literal_tag", "SELECT p_partkey, 'ads' AS plataforma, 'run-7' AS run_id FROM part")
def project_literal_tag(spark, sf):
    return R.tag(table(spark, sf, "part").select("p_partkey"), plataforma="ads", run_id="run-7")


@check("project_lateral_alias", """SELECT l_returnflag, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total,
  CAST(SUM(CAST(l_quantity AS BIGINT)) > 100000 AS BOOLEAN) AS is_large FROM lineitem GROUP BY l_returnflag""")
def project_lateral_alias(spark, sf):
    totals = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"))
    return totals.withColumn("is_large", F.col("total") > 100000)


# ---- filters ----

_CUSTOMER_FLAGS = """SELECT c_custkey, c_custkey % 29 = 0 AS is_deleted, c_custkey % 31 = 0 AS is_anonymized,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal > 0 END AS has_contact_info FROM customer"""


def _customer_flags(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey", (key % 29 == 0).alias("is_deleted"), (key % 31 == 0).alias("is_anonymized"),
        F.when(key % 3 != 0, F.col("c_acctbal") > 0).alias("has_contact_info"))


@check("filter_flags", f"""SELECT c_custkey FROM ({_CUSTOMER_FLAGS})
  WHERE NOT is_deleted AND NOT is_anonymized AND coalesce(has_contact_info, FALSE)""")
def filter_flags(spark, sf):
    df = R.exclude_deleted(R.exclude_deleted(_customer_flags(spark, sf), "is_deleted"), "is_anonymized")
    return df.filter(flag(F.col("has_contact_info"))).select("c_custkey")


@check("filter_activity", """SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE l_linenumber - 6 > 0 OR l_discount > 0.09 OR l_tax > 0.07""")
def filter_activity(spark, sf):
    df = table(spark, sf, "lineitem")
    active = any_positive(F.col("l_linenumber") - 6, F.col("l_discount") - 0.09, F.col("l_tax") - 0.07)
    return df.filter(active).select("l_orderkey", "l_linenumber")


@check("filter_valid", """SELECT c_custkey FROM customer
  WHERE nullif(c_mktsegment, 'BUILDING') IS NOT NULL AND nullif(c_nationkey, 3) IS NOT NULL""")
def filter_valid(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("name"),
        F.nullif("c_nationkey", F.lit(3)).alias("id"))
    return R.require(df, "name", "id").select("c_custkey")


_SEGMENT = """CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'unknown' ELSE c_mktsegment END"""


@check("filter_sentinel", f"SELECT c_custkey FROM customer WHERE coalesce({_SEGMENT}, '') NOT IN ('', 'unknown')")
def filter_sentinel(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.expr(_SEGMENT).alias("tag"))
    return df.filter(not_sentinel("tag")).select("c_custkey")


@check("filter_non_blank", f"SELECT c_custkey FROM customer WHERE length(coalesce({_SEGMENT}, '')) > 0")
def filter_non_blank(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.expr(_SEGMENT).alias("tag"))
    return df.filter(non_blank("tag")).select("c_custkey")


@check("filter_current", """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'
  OR o_orderdate > TIMESTAMP '1998-06-01'""")
def filter_current(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("end_date"))
    return df.filter(is_current("end_date", "1998-06-01")).select("o_orderkey")


@check("filter_time_range", """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-05-02'
  AND o_orderdate < TIMESTAMP '1998-06-01' AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def filter_time_range(spark, sf):
    df = R.dashboard_filter(table(spark, sf, "orders"), "o_orderdate", "1998-06-01", 30,
                            o_orderpriority=["1-URGENT", "5-LOW"], o_orderstatus=None)
    return df.select("o_orderkey", "o_orderpriority")


@check("filter_optional_predicate", "SELECT COUNT(*) AS n FROM orders WHERE o_totalprice > 100000")
def filter_optional_predicate(spark, sf):
    kept = R.rows_where(table(spark, sf, "orders"), "o_totalprice > 100000")
    return R.rows_where(kept, None).agg(F.count(F.lit(1)).alias("n"))


@check("predicate_parts", """SELECT c_custkey FROM customer WHERE (c_nationkey <> 3 AND c_nationkey >= 2 AND c_nationkey < 20
  OR c_mktsegment LIKE 'B%') AND c_nationkey NOT IN (5, 7) AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
  AND c_name IS NOT NULL""")
def predicate_parts(spark, sf):
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")
    return table(spark, sf, "customer").filter(
        (((nation != 3) & (nation >= 2) & (nation < 20)) | segment.like("B%")) & ~nation.isin(5, 7)
        & segment.isin("BUILDING", "MACHINERY", "HOUSEHOLD") & F.col("c_name").isNotNull()).select("c_custkey")


# ---- joins ----


@check("join_left_right_predicate", """SELECT p_partkey, COUNT(l_orderkey) AS n_lines,
  CAST(coalesce(SUM(CAST(l_quantity AS BIGINT)), 0) AS BIGINT) AS qty
  FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY p_partkey""")
def join_left_right_predicate(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    recent = F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    joined = J.left_with_predicate(table(spark, sf, "part"), lines, "p_partkey", recent)
    return joined.groupBy("p_partkey").agg(
        F.count("l_orderkey").alias("n_lines"),
        F.coalesce(F.sum(F.col("l_quantity").cast("bigint")), F.lit(0).cast("bigint")).alias("qty"))


@check("join_left_composite", """WITH m AS (SELECT l_partkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT p_partkey, flag, coalesce(n, 0) AS n FROM (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N'
  ELSE 'X' END AS flag FROM part) p LEFT JOIN m ON m.l_partkey = p.p_partkey AND m.l_returnflag = p.flag""")
def join_left_composite(spark, sf):
    flagged = table(spark, sf, "part").select("p_partkey", F.expr(
        "CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'X' END").alias("flag"))
    counts = A.count_by(table(spark, sf, "lineitem"), F.col("l_partkey").alias("p_partkey"),
                        F.col("l_returnflag").alias("flag"), name="n")
    return flagged.join(counts, ["p_partkey", "flag"], "left").fillna(0, ["n"])


@check("join_rank_one", """SELECT c_custkey, o_orderkey, o_orderdate FROM customer JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o
  ON o_custkey = c_custkey""")
def join_rank_one(spark, sf):
    newest = W.latest_of(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])
    joined = table(spark, sf, "customer").join(newest, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_custkey", "o_orderkey", "o_orderdate")


@check("rank_filter", """SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def rank_filter(spark, sf):
    from pyspark.sql import Window
    rn = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return R.rank_one(table(spark, sf, "orders").withColumn("rn", rn)).select("o_orderkey", "o_custkey")


def _people(spark, sf):
    """Customers with a tag that is an id, a name, or nothing known, and a source alias."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS person",
        "CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 40 AS STRING) "
        "WHEN 1 THEN 'NATION_' || CAST(c_custkey % 30 AS STRING) ELSE 'none' END AS tag",
        "CASE c_custkey % 4 WHEN 0 THEN 'fb' WHEN 1 THEN 'google' WHEN 2 THEN 'adwords' ELSE 'news' END AS source")


_PEOPLE = """WITH people AS (SELECT c_custkey AS person, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 40 AS STRING)
  WHEN 1 THEN 'NATION_' || CAST(c_custkey % 30 AS STRING) ELSE 'none' END AS tag,
  CASE c_custkey % 4 WHEN 0 THEN 'fb' WHEN 1 THEN 'google' WHEN 2 THEN 'adwords' ELSE 'news' END AS source FROM customer),
camps AS (SELECT CAST(n_nationkey AS STRING) AS campaign_id, lower(n_name) AS campaign_name,
  CASE n_nationkey % 2 WHEN 0 THEN 'facebook_ads' ELSE 'google_ads' END AS platform FROM nation)
"""


def _campaigns(spark, sf):
    return table(spark, sf, "nation").selectExpr(
        "CAST(n_nationkey AS STRING) AS campaign_id", "lower(n_name) AS campaign_name",
        "CASE n_nationkey % 2 WHEN 0 THEN 'facebook_ads' ELSE 'google_ads' END AS platform")


@check("join_equi_id", _PEOPLE + "SELECT person, campaign_id, platform FROM people JOIN camps ON tag = campaign_id")
def join_equi_id(spark, sf):
    return J.match_by_id(_people(spark, sf), _campaigns(spark, sf), "tag", "campaign_id").select(
        "person", "campaign_id", "platform")


@check("join_lower_name", _PEOPLE + """SELECT person, campaign_id, platform FROM people
  JOIN camps ON lower(tag) = lower(campaign_name)""")
def join_lower_name(spark, sf):
    return J.match_by_name(_people(spark, sf), _campaigns(spark, sf), "tag", "campaign_name").select(
        "person", "campaign_id", "platform")


@check("join_alias_map", _PEOPLE + """SELECT person, campaign_id, platform FROM people JOIN camps
  ON (source = 'facebook' AND platform = 'facebook_ads') OR (source = 'google' AND platform = 'google_ads')
  OR (source = 'fb' AND platform = 'facebook_ads') OR (source = 'adwords' AND platform = 'google_ads')""")
def join_alias_map(spark, sf):
    from leadvault.plans.vault import SOURCE_ALIASES
    return J.match_by_alias(_people(spark, sf), _campaigns(spark, sf), "source", "platform", SOURCE_ALIASES).select(
        "person", "campaign_id", "platform")


@check("anti_unmatched", _PEOPLE + """SELECT person, tag FROM people
  WHERE person NOT IN (SELECT person FROM people JOIN camps ON tag = campaign_id
                       UNION SELECT person FROM people JOIN camps ON lower(tag) = campaign_name)""")
def anti_unmatched(spark, sf):
    people, campaigns = _people(spark, sf), _campaigns(spark, sf)
    return J.unmatched(people, "person", J.match_by_id(people, campaigns, "tag", "campaign_id"),
                       J.match_by_name(people, campaigns, "tag", "campaign_name")).select("person", "tag")


@check("cross_stats", """SELECT (SELECT COUNT(*) FROM orders) AS n_orders, (SELECT MIN(o_orderdate) FROM orders) AS first_order,
  (SELECT MAX(o_orderdate) FROM orders) AS last_order, (SELECT COUNT(*) FROM part) AS n_parts,
  (SELECT CAST(SUM(p_size) AS BIGINT) FROM part) AS total_size""")
def cross_stats(spark, sf):
    orders = A.span(table(spark, sf, "orders"), "o_orderdate", "n_orders", "first_order", "last_order")
    parts = table(spark, sf, "part").agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum("p_size").alias("total_size"))
    return J.side_by_side(orders, parts)


@check("watermark_scalar", """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >
  (SELECT coalesce(MAX(o_orderdate), TIMESTAMP '1900-01-01') FROM orders WHERE o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01')""")
def watermark_scalar(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    target = orders.filter((F.col("o_orderstatus") == "P")
                           & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return newer_than(orders, target, "o_orderdate").drop("o_orderstatus")


@check("watermark_floor", """SELECT TIMESTAMP '1900-01-01' AS empty_mark, (SELECT MAX(o_orderdate) FROM orders) AS full_mark""")
def watermark_floor(spark, sf):
    orders = table(spark, sf, "orders")
    empty = max_of(orders.filter("o_orderkey < 0"), "o_orderdate", "1900-01-01", "empty_mark")
    return J.side_by_side(empty, max_of(orders, "o_orderdate", "1900-01-01", "full_mark"))


# ---- aggregates ----


@check("agg_many_keys", """SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
  CAST(SUM(CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS even_qty,
  round(CAST(SUM(CAST(l_tax AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*), 6) AS avg_tax
  FROM lineitem GROUP BY 1, 2, 3, 4""")
def agg_many_keys(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({
        "q": F.col("l_quantity").cast("bigint"),
        "even": F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("bigint"))})
    out = A.metric_totals(df, ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"],
                          {"qty": "q", "even_qty": "even"}, {"avg_tax": "l_tax"})
    return out.withColumn("avg_tax", F.round("avg_tax", 6))


@check("agg_ratio_guarded", """SELECT l_partkey, CASE WHEN SUM(c) > 0 THEN round(SUM(q) / SUM(c), 6) ELSE 0 END AS cpc,
  round(SUM(c) * 100 / SUM(q), 6) AS ctr FROM (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS q,
  CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_linenumber - 1 END AS c FROM lineitem) GROUP BY l_partkey""")
def agg_ratio_guarded(spark, sf):
    df = table(spark, sf, "lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("q"), F.when(
        F.col("l_partkey") % 3 == 0, 0).otherwise(F.col("l_linenumber") - 1).alias("c"))
    return df.groupBy("l_partkey").agg(F.round(A.ratio_of_sums("q", "c"), 6).alias("cpc"),
                                       F.round(A.ratio_of_sums("c", "q", 100), 6).alias("ctr"))


@check("agg_period", """SELECT l_suppkey, MIN(l_shipdate) AS start_date, MAX(l_shipdate) AS end_date,
  COUNT(DISTINCT l_shipdate) AS days_active, MAX(l_orderkey) AS l_orderkey FROM lineitem GROUP BY l_suppkey""")
def agg_period(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*A.activity_period("l_shipdate", "l_orderkey"))


@check("agg_first_seen", """SELECT o_custkey, MIN(o_orderdate) AS load_date, MIN(o_orderpriority) AS record_source
  FROM orders GROUP BY o_custkey""")
def agg_first_seen(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("load_date"), F.col("o_orderpriority").alias("record_source"))
    return A.first_seen(df, "o_custkey")


@check("agg_earliest_row", """SELECT o_custkey, o_orderdate, o_orderkey FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def agg_earliest_row(spark, sf):
    return A.earliest_row(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@check("agg_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def agg_distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@check("agg_count_by", "SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1")
def agg_count_by(spark, sf):
    return A.count_by(table(spark, sf, "orders"), "o_orderpriority")


@check("agg_time_grain", """SELECT date_trunc('hour', ts) AS ts, COUNT(*) AS n FROM events GROUP BY 1""")
def agg_time_grain(spark, sf):
    return A.count_by_grain(table(spark, sf, "events"), "ts", "hour", "n")


@check("agg_hour_weekday", """SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
  COUNT(*) AS count FROM events GROUP BY 1, 2""")
def agg_hour_weekday(spark, sf):
    return A.hour_weekday_counts(table(spark, sf, "events"), "ts")


@check("agg_conditional_counts", """SELECT COUNT(*) AS total_parts, CAST(SUM(p_size) AS BIGINT) AS total_size_bytes,
  AVG(p_size) AS avg_part_size_bytes, MIN(p_size) AS min_part_size_bytes, MAX(p_size) AS max_part_size_bytes,
  COUNT(*) FILTER (p_size < 10) AS small_parts_count, COUNT(*) FILTER (p_size > 40) AS large_parts_count FROM part""")
def agg_conditional_counts(spark, sf):
    return A.size_summary(table(spark, sf, "part"), "p_size", 10, 40, "part")


@check("agg_global_span", "SELECT COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events")
def agg_global_span(spark, sf):
    return A.span(table(spark, sf, "events"), "ts")


@check("row_counts", """SELECT 'orders' AS relation, COUNT(*) AS row_count FROM orders
  UNION ALL SELECT 'customer', COUNT(*) FROM customer""")
def row_counts(spark, sf):
    return A.row_counts(orders=table(spark, sf, "orders"), customer=table(spark, sf, "customer"))


# ---- windows ----


@check("win_first_of_version", """SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) = 1""")
def win_first_of_version(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    return W.first_of(df, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])


@check("win_latest", """SELECT o_custkey, o_orderkey, o_orderdate FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def win_latest(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return W.latest_of(df, "o_custkey", ["o_orderdate", "o_orderkey"])


@check("win_lead_close", """SELECT o_custkey, o_orderdate, o_orderkey,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS end_date FROM orders""")
def win_lead_close(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return W.close_versions(df, "o_custkey", ["o_orderdate", "o_orderkey"], "end_date",
                            F.trunc("o_orderdate", "month"))


@check("win_lag_change", """SELECT event_id, user_id, event_type FROM events
  QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_lag_change(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    changed = W.changed_rows(df, "user_id", ["ts", "event_id"], "event_type", F.to_date("ts"))
    return changed.drop("ts")


_HOT_EVENTS = """SELECT event_id, if(event_id % 3 = 0, 0, user_id) AS user_id, event_type,
  CAST(if(event_id % 3 = 0, TIMESTAMP '2024-01-10 00:00:00', ts) AS DATE) AS day FROM events"""


@check("win_neighbours_of_hot_keys", f"""WITH hot AS ({_HOT_EVENTS.replace("if(", "IF(")})
  SELECT event_id, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after FROM hot
  WINDOW w AS (PARTITION BY user_id ORDER BY day, event_id)""")
def win_neighbours_of_hot_keys(spark, sf):
    """A third of the rows under one key on one day: buckets are cut where the data tell, inside the day too."""
    events = table(spark, sf, "events")
    hot, bound = spark.sql(_HOT_EVENTS.replace("FROM events", "FROM {events}"), events=events), max(50, events.count() // 20)
    before = W.with_neighbour(hot, "user_id", ["day", "event_id"], "event_type", "before", False, bucket_rows=bound)
    return W.with_neighbour(before, "user_id", ["day", "event_id"], "event_type", "after", True, bucket_rows=bound).select("event_id", "before", "after")


# ---- set operations ----


@check("union_all_aligned", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS balance FROM customer
  UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_all_aligned(spark, sf):
    people = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    return R.union_aligned(people, table(spark, sf, "supplier").selectExpr(
        "s_acctbal AS balance", "s_name AS name", "s_suppkey AS id"))


@check("union_distinct_anti", """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders UNION SELECT s_suppkey FROM supplier)""")
def union_distinct_anti(spark, sf):
    """Customers whose number neither an order nor a supplier has."""
    used = R.union_distinct(table(spark, sf, "orders").selectExpr("o_custkey AS c_custkey"),
                            table(spark, sf, "supplier").selectExpr("s_suppkey AS c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(used, "c_custkey", "left_anti")


# ---- scalar functions ----


@check("fn_text", """SELECT c_custkey, upper(trim(coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '  ' || c_mktsegment || ' ' END, '')))
  AS up, lower(trim(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '  ' || c_mktsegment || ' ' END)) AS low,
  length(c_name) > 5 AS is_long FROM customer""")
def fn_text(spark, sf):
    padded = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))
    return table(spark, sf, "customer").select(
        "c_custkey", clean_upper(padded).alias("up"), clean_lower(padded).alias("low"),
        (F.length("c_name") > 5).alias("is_long"))


@check("fn_regex", """SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS number,
  regexp_extract('a,Customer_x' || c_custkey || ',b', 'Customer_([a-zA-Z0-9_]+)', 1) AS tagged FROM customer""")
def fn_regex(spark, sf):
    tags = F.concat(F.lit("a,Customer_x"), F.col("c_custkey").cast("string"), F.lit(",b"))
    return table(spark, sf, "customer").select(
        "c_custkey", digits("c_name").alias("number"), tagged_name(tags, "Customer").alias("tagged"))


@check("fn_like", """SELECT p_partkey, p_name LIKE '%ring%' AS has_ring, p_name LIKE '_e%' AS second_e,
  p_brand LIKE 'Brand#1_' AS teens FROM part""")
def fn_like(spark, sf):
    name = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey", name.contains("ring").alias("has_ring"), name.like("_e%").alias("second_e"),
        F.col("p_brand").like("Brand#1_").alias("teens"))


@check("fn_concat_null", """SELECT o_orderkey, o_orderpriority || '-' || nullif(o_orderstatus, 'P') AS joined FROM orders""")
def fn_concat_null(spark, sf):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey", concat_all("o_orderpriority", F.lit("-"), status).alias("joined"))


@check("fn_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  coalesce(json_extract_string(props, '$.none'), 'unknown') AS missing FROM events""")
def fn_json(spark, sf):
    member = json_fields("props", ["k", "none"])
    return table(spark, sf, "events").withColumn("p", member).select(
        "event_id", F.col("p.k").cast("bigint").alias("k"), F.coalesce("p.none", F.lit("unknown")).alias("missing"))


@check("fn_casts", """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS s, CAST(CAST(o_orderkey % 2 AS VARCHAR) AS BOOLEAN) AS b,
  CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS t, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS d,
  TRY_CAST(o_orderpriority AS BIGINT) AS bad, CAST(CAST(o_custkey AS DECIMAL(15,2)) AS DOUBLE) / 100 AS units FROM orders""")
def fn_casts(spark, sf):
    day = F.col("o_orderdate").cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("s"),
        (F.col("o_orderkey") % 2).cast("string").cast("boolean").alias("b"),
        day.cast("timestamp_ntz").alias("t"), F.substring(day, 1, 10).cast("date").alias("d"),
        F.col("o_orderpriority").try_cast("bigint").alias("bad"),
        (F.col("o_custkey").cast("decimal(15,2)").cast("double") / 100).alias("units"))


@check("fn_flags", f"""SELECT c_custkey, coalesce({_SEGMENT} LIKE 'B%', FALSE) AS is_b,
  CAST(coalesce({_SEGMENT} <> '', FALSE) AS INTEGER) AS present,
  CAST(coalesce({_SEGMENT} LIKE 'B%', FALSE) AS INTEGER) + CAST(c_acctbal > 0 AS INTEGER) AS points,
  {_SEGMENT} IS NOT NULL AS complete FROM customer""")
def fn_flags(spark, sf):
    df = table(spark, sf, "customer").withColumn("seg", F.expr(_SEGMENT))
    is_b = F.col("seg").like("B%")
    return df.select("c_custkey", flag(is_b).alias("is_b"), flag01(F.col("seg") != "").alias("present"),
                     score(is_b, F.col("c_acctbal") > 0).alias("points"),
                     all_present("seg", "c_name").alias("complete"))


@check("fn_bands", """SELECT p_partkey, CASE WHEN p_size >= 40 THEN 'Alto' WHEN p_size >= 20 THEN 'Médio'
  WHEN p_size > 5 THEN 'Baixo' ELSE 'Sem Dados' END AS banda FROM part""")
def fn_bands(spark, sf):
    bounds = [(">=", 40, "Alto"), (">=", 20, "Médio"), (">", 5, "Baixo")]
    return table(spark, sf, "part").select("p_partkey", band("p_size", bounds, "Sem Dados").alias("banda"))


@check("fn_priority", f"""SELECT c_custkey, CASE WHEN coalesce({_SEGMENT}, '') NOT IN ('', 'unknown') THEN {_SEGMENT}
  WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'direct' END AS origin FROM customer""")
def fn_priority(spark, sf):
    df = table(spark, sf, "customer").withColumns({
        "seg": F.expr(_SEGMENT), "parity": F.when(F.col("c_nationkey") % 2 == 0, "even").otherwise("")})
    return df.select("c_custkey", first_usable("seg", "parity", default="direct").alias("origin"))


@check("fn_ratios", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber > 1
  THEN round(l_quantity / (l_linenumber - 1), 6) ELSE 0 END AS cpc,
  CASE WHEN l_suppkey > 0 THEN round(l_quantity * 1000 / l_suppkey, 6) ELSE 0 END AS cpm FROM lineitem""")
def fn_ratios(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select("l_orderkey", "l_linenumber", "l_partkey",
                     F.round(ratio("l_quantity", F.col("l_linenumber") - 1), 6).alias("cpc"),
                     F.round(ratio("l_quantity", "l_suppkey", 1000), 6).alias("cpm"))


@check("fn_day_diff", "SELECT event_id, datesub('day', ts, TIMESTAMP '2024-02-01 12:00:00') AS days FROM events")
def fn_day_diff(spark, sf):
    return table(spark, sf, "events").select("event_id", days_between("ts", "2024-02-01 12:00:00").alias("days"))


@check("fn_recent", """SELECT event_id, ts >= TIMESTAMP '2024-01-25' - INTERVAL 10 DAY AS recent,
  ts < DATE '2024-01-10' AS early FROM events""")
def fn_recent(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", is_recent("ts", "2024-01-25", 10).alias("recent"), (F.col("ts") < as_date("2024-01-10")).alias("early"))


_TRUNC = """SELECT event_id, date_trunc('day', ts) AS daily, CAST(date_trunc('week', ts) AS TIMESTAMP) AS weekly,
  CAST(date_trunc('month', ts) AS TIMESTAMP) AS monthly, ts AS as_is FROM events"""


def _partitions(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", partition_expr("ts", "daily").alias("daily"), partition_expr("ts", "weekly").alias("weekly"),
        partition_expr("ts", "monthly").alias("monthly"), partition_expr("ts", "none").alias("as_is"))


@check("fn_trunc", _TRUNC)
def fn_trunc(spark, sf):
    return _partitions(spark, sf)


@check("partition_expr", f"SELECT daily, weekly, monthly, COUNT(*) AS n FROM ({_TRUNC}) GROUP BY 1, 2, 3")
def partition_expr_(spark, sf):
    return A.count_by(_partitions(spark, sf), "daily", "weekly", "monthly", name="n")


@check("fn_isin", """SELECT c_custkey, upper(lower(c_mktsegment)) IN ('BUILDING', 'MACHINERY') AS is_active FROM customer""")
def fn_isin(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.upper(F.lower("c_mktsegment")).isin("BUILDING", "MACHINERY").alias("is_active"))


@check("fn_md5", """SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '|' || nullif(o_orderstatus, 'P')) AS business_key,
  md5(upper(trim(' ' || o_orderpriority))) AS upper_key FROM orders""")
def fn_md5(spark, sf):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey", hash_key("o_orderkey", status).alias("business_key"),
        hash_key(F.concat(F.lit(" "), "o_orderpriority"), upper=True).alias("upper_key"))

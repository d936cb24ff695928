"""Column tests, freshness and relation comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import cte, frame, table
from checks.registry import check
from checks.staging import STG_CONTACTS, STG_LEADS, STG_SEARCH, staged_contacts, staged_leads
from leadvault.operators import quality as Q
from leadvault.plans import staging as S
from leadvault.plans.layers import source_tests, staging_tests


def _rows(table_name, *tests):
    return [f"SELECT '{kind}' AS test, '{col}' AS column_name, COUNT(*) FILTER ({bad}) AS failures FROM {table_name}"
            for kind, col, bad in tests]


def _dupes(table_name, col):
    return (f"SELECT 'unique' AS test, '{col}' AS column_name, COUNT(*) AS failures FROM "
            f"(SELECT {col} FROM {table_name} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1)")


@check("dq_not_null", cte("contacts") + " UNION ALL ".join(_rows(
    "contacts", ("not_null", "id", "id IS NULL"), ("not_null", "email", "email IS NULL"),
    ("not_null", "cdate", "cdate IS NULL"), ("not_null", "phone", "phone IS NULL"))))
def dq_not_null(spark, sf):
    return Q.check_not_null(frame(spark, sf, "contacts"), "id", "email", "cdate", "phone")


@check("dq_unique", " UNION ALL ".join([_dupes("orders", "o_orderkey"), _dupes("orders", "o_custkey"),
                                        _dupes("orders", "o_orderdate")]))
def dq_unique(spark, sf):
    return Q.check_unique(table(spark, sf, "orders"), "o_orderkey", "o_custkey", "o_orderdate")


@check("dq_accepted_values", """SELECT 'accepted_values' AS test, 'o_orderstatus' AS column_name,
  COUNT(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS failures FROM orders""")
def dq_accepted_values(spark, sf):
    return Q.check_accepted(table(spark, sf, "orders"), "o_orderstatus", ["O", "F"])


_LABELS = "('Completo', 'Parcial', 'Mínimo', 'Incompleto')"


def _report(name, tests, dupes=()):
    parts = _rows(name, *tests) + [_dupes(name, d) for d in dupes]
    return [f"SELECT '{name}' AS table_name, t.*, CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM ({p}) t"
            for p in parts]


def _nulls(*cols):
    return [("not_null", c, f"{c} IS NULL") for c in cols]


@check("dq_report", cte("contacts", "leads", "search_rows") + STG_CONTACTS + STG_LEADS + STG_SEARCH
       + """, stg_search_rows AS (SELECT *, cost_micros / 1000000 AS cost_brl, 'google_ads' AS origem,
  (impressions > 0 OR clicks > 0 OR cost_micros > 0) AS has_activity FROM typed) """ + " UNION ALL ".join([
        *_report("stg_contacts", [*_nulls("contact_id", "email", "origem", "qualidade_lead", "has_contact_info"),
                                  ("accepted_values", "origem", "origem <> 'activecampaign'"),
                                  ("accepted_values", "qualidade_lead", f"qualidade_lead NOT IN {_LABELS}"),
                                  ("accepted_values", "has_contact_info", "FALSE")], ["contact_id"]),
        *_report("stg_leads", [*_nulls("lead_id", "email", "origem", "has_contact_info", "has_valid_email"),
                               ("accepted_values", "origem", "origem <> 'facebook_ads'"),
                               ("accepted_values", "has_contact_info", "FALSE"),
                               ("accepted_values", "has_valid_email", "FALSE")], ["lead_id"]),
        *_report("stg_search_rows", [*_nulls("customer_id", "campaign_id", "campaign_date", "impressions", "clicks",
                                             "cost_brl", "origem", "has_activity"),
                                     ("accepted_values", "origem", "origem <> 'google_ads'"),
                                     ("accepted_values", "has_activity", "FALSE")])]))
def dq_report(spark, sf):
    """All 28 declared tests of the staging models."""
    frames = {"stg_contacts": staged_contacts(spark, sf), "stg_leads": staged_leads(spark, sf),
              "stg_search_rows": S.stg_search_rows(frame(spark, sf, "search_rows"))}
    return Q.dq_report({name: (frames[name], tests) for name, tests in staging_tests().items()})


@check("dq_report_sources", cte("contacts", "leads", "search_rows") + " UNION ALL ".join([
    *_report("leads", [*_nulls("id", "created_time", "_load_date", "_extraction_timestamp", "_source_system"),
                       ("accepted_values", "_source_system", "_source_system <> 'facebook_ads'")], ["id"]),
    *_report("search_rows", [*_nulls("customer_id", "campaign_id", "date", "_extraction_timestamp", "_source_system"),
                             ("accepted_values", "_source_system", "_source_system <> 'google_ads'")]),
    *_report("contacts", [*_nulls("id", "email", "cdate", "_extraction_timestamp", "_source_system"),
                          ("accepted_values", "_source_system", "_source_system <> 'activecampaign'")], ["id"])]))
def dq_report_sources(spark, sf):
    """All 20 declared tests of the raw sources."""
    return Q.dq_report({name: (frame(spark, sf, name), tests) for name, tests in source_tests().items()})


@check("dq_failing_rows", cte("contacts") + "SELECT id, phone FROM contacts WHERE email IS NULL")
def dq_failing_rows(spark, sf):
    """What store-failures keeps for one test, read back from where it was stored."""
    from leadvault.session import scratch_dir
    store = scratch_dir(spark, "failures")
    contacts = frame(spark, sf, "contacts")
    Q.dq_report({"contacts": (contacts, Q.not_null("email") + Q.unique("id"))}, store)
    return spark.read.parquet(f"{store}/contacts").filter("test = 'not_null_email'").select("id", "phone")


def _failing(source, key, tests):
    """Rows of a test table that fail, named by the test."""
    return " UNION ALL ".join(f"SELECT CAST({key} AS BIGINT) AS id, '{name}' AS test FROM {source} WHERE {bad}" for name, bad in tests)


@check("dq_failing_tests", _failing("orders", "o_orderkey", [
    ("not_null_o_orderpriority", "o_orderkey % 5 = 0"), ("accepted_values_o_orderstatus", "o_orderstatus = 'P'"),
    ("unique_o_custkey", "o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1)")]))
def dq_failing_tests(spark, sf):
    """The failing rows of all tests of a table, stored in one write; a row that fails several tests is kept for each."""
    from leadvault.session import scratch_dir
    store = scratch_dir(spark, "failures")
    orders = table(spark, sf, "orders").withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, if(o_orderkey % 5 = 0, o_orderpriority, ''))"))
    tests = Q.not_null("o_orderkey", "o_orderpriority") + Q.accepted("o_orderstatus", "O", "F") + Q.unique("o_orderkey", "o_custkey")
    Q.store_failing_rows(orders, tests, store)
    return spark.read.parquet(store).select(F.col("o_orderkey").cast("bigint").alias("id"), "test")


@check("freshness", """SELECT MAX(ts) AS max_loaded_at, datesub('hour', MAX(ts), TIMESTAMP '2024-02-01') AS age_hours,
  CASE WHEN datesub('hour', MAX(ts), TIMESTAMP '2024-02-01') > 24 THEN 'warn' ELSE 'pass' END AS status FROM events""")
def freshness(spark, sf):
    return Q.freshness(table(spark, sf, "events"), "ts", "2024-02-01")


@check("compare_relations", """WITH a AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 1),
shared AS (SELECT COUNT(*) AS n FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b))
SELECT n AS in_both, (SELECT COUNT(*) FROM a) - n AS only_left, (SELECT COUNT(*) FROM b) - n AS only_right FROM shared""")
def compare_relations(spark, sf):
    orders = table(spark, sf, "orders")
    cols = ["o_custkey", "o_orderpriority"]
    return Q.compare_relations(orders.filter("o_orderkey % 3 <> 0").select(cols),
                               orders.filter("o_orderkey % 3 <> 1").select(cols))


_RIGHT = """SELECT CASE WHEN o_custkey % 24 = 0 THEN NULL WHEN o_custkey % 23 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS customer,
    CASE WHEN o_custkey % 22 = 0 OR o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS status,
    CASE WHEN o_custkey % 22 = 0 OR o_custkey % 25 = 0 THEN CAST(o_orderkey + 1 AS BIGINT) ELSE o_orderkey END AS number
  FROM {} WHERE o_custkey % 20 <> 0 AND o_orderkey % 89 <> 0"""


@check("compare_by_key", f"""WITH a AS (
    SELECT CASE WHEN o_custkey % 24 = 0 THEN NULL ELSE o_custkey END AS customer, o_orderstatus AS status, o_orderkey AS number FROM orders),
  b AS ({_RIGHT.format("orders")}),
  l AS (SELECT customer, COUNT(*) AS n, list_sort(list(status || number)) AS rows_, list_sort(list(status)) AS s, list_sort(list(number)) AS k
        FROM a GROUP BY customer),
  r AS (SELECT customer, COUNT(*) AS n, list_sort(list(status || number)) AS rows_, list_sort(list(status)) AS s, list_sort(list(number)) AS k
        FROM b GROUP BY customer),
  both_ AS (
    SELECT coalesce(l.customer, r.customer) AS customer, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right,
      CASE WHEN r.n IS NULL THEN 'only_left' WHEN l.n IS NULL THEN 'only_right' WHEN l.rows_ <> r.rows_ THEN 'changed' END AS difference,
      l.s <> r.s AS other_status, l.k <> r.k AS other_number
    FROM l FULL JOIN r ON l.customer IS NOT DISTINCT FROM r.customer)
  SELECT customer, difference, n_left, n_right, CASE WHEN difference = 'changed' THEN array_to_string(
    list_filter([CASE WHEN other_status THEN 'status' END, CASE WHEN other_number THEN 'number' END], lambda x: x IS NOT NULL), ',')
    END AS changed_columns
  FROM both_ WHERE difference IS NOT NULL""")
def compare_by_key(spark, sf):
    """Keys with several rows each, a NULL key among them; rows dropped, changed, added and moved to other keys."""
    orders = table(spark, sf, "orders")
    left = orders.select(F.expr("CASE WHEN o_custkey % 24 = 0 THEN NULL ELSE o_custkey END").alias("customer"),
                         F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("number"))
    return Q.compare_by_key(left, spark.sql(_RIGHT.format("{orders}"), orders=orders), "customer")

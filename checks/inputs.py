"""Marketing-shaped inputs derived from the test tables.

Each input is a projection of a test table, kept as expression texts that Spark and DuckDB both
understand, so that a query and its SQL counterpart see the same rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from leadvault.session import configure, scratch_dir, shuffles_given_back, size_tasks
from leadvault.sources.writes import write_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return size_tasks(configure(spark), path).read.parquet(path)


@dataclass(frozen=True)
class Derived:
    table: str
    columns: tuple
    where: str | None = None
    join: tuple | None = None  # (table, condition)
    versions: int = 0  # repeat every row with n = 1 .. versions


CONTACTS = Derived("customer", (
    "CAST(c_custkey AS STRING) AS id",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '  ' || lower(c_mktsegment) END AS firstName",
    "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'Fam' || CAST(c_custkey % 40 AS STRING) || ' ' END AS lastName",
    """CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'no-at-sign'
       WHEN c_custkey % 37 = 0 THEN 'at@nodot'
       ELSE ' User' || CAST(c_custkey % 100 AS STRING) || '@Example.com' END AS email""",
    """CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '12-34'
       ELSE '(11) 9' || lpad(CAST(c_custkey % 100 AS STRING), 4, '0') || '-0000' END AS phone""",
    "CASE WHEN c_custkey % 29 = 0 THEN '1' ELSE '0' END AS deleted",
    "CASE WHEN c_custkey % 31 = 0 THEN '1' ELSE '0' END AS anonymized",
    """CASE WHEN c_custkey % 4 = 0 THEN 'vip,produtor_p' || CAST(c_nationkey AS STRING) || ',x'
       WHEN c_custkey % 4 = 1 THEN '' WHEN c_custkey % 8 = 2 THEN 'produtorx' ELSE NULL END AS tags""",
    """'{"lead_source":"src' || CAST(c_nationkey % 3 AS STRING)
       || '","utm_source":"' || CASE c_custkey % 4 WHEN 0 THEN 'fb' WHEN 1 THEN 'google' WHEN 2 THEN '' ELSE 'news' END
       || '","utm_campaign":"' || CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 20 AS STRING)
            WHEN 1 THEN 'SMALL RING' ELSE 'none' END
       || '"}' AS fields""",
    "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'Org' || CAST(c_nationkey AS STRING) END AS organization",
    "'2023-0' || CAST(1 + c_custkey % 4 AS STRING) || '-15 10:00:00' AS cdate",
    "'2023-04-20 08:30:00' AS udate",
    """CASE WHEN c_custkey % 2 = 0 THEN '2023-03-01 02:00:00' ELSE '2023-04-01 02:00:00' END
       AS _extraction_timestamp""",
    "'activecampaign' AS _source_system",
    "CASE WHEN c_custkey % 2 = 0 THEN '2023-03-01' ELSE '2023-04-01' END AS _load_date",
))

CONTACT_VERSIONS = Derived("customer", (
    "CAST(c_custkey AS STRING) AS id",
    "c_name AS nome",
    "lower(c_name) || '@example.com' AS email",
    """CASE WHEN n = 2 AND c_custkey % 3 = 0 THEN '11900000000'
       WHEN n = 3 AND c_custkey % 3 = 0 AND c_custkey % 6 <> 0 THEN '11911111111'
       ELSE '11922222222' END AS telefone""",
    """CASE n WHEN 1 THEN DATE '2023-01-01' WHEN 2 THEN DATE '2023-02-01' ELSE DATE '2023-03-01' END
       AS load_date""",
), versions=3)

_BUDGET = """CASE WHEN p_size % 4 = 0 THEN CAST(0 AS BIGINT) WHEN p_size % 4 = 1 THEN NULL
       ELSE CAST(p_size * 50 AS BIGINT) END"""
_STATUS = "CASE p_size % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' ELSE 'Enabled' END AS status"
_STOP = """CASE WHEN p_partkey % 6 = 0 THEN DATE '2023-06-30' WHEN p_partkey % 6 = 2 THEN DATE '2030-01-01'
       ELSE NULL END"""

AD_CAMPAIGNS = Derived("part", (
    "CAST(p_partkey AS STRING) AS id", "p_name AS name", "p_type AS objective", _STATUS,
    "'acc' || CAST(p_size % 5 AS STRING) AS account_id",
    "CAST(p_size * 1000 AS BIGINT) AS daily_budget",
    "CASE WHEN p_size % 2 = 0 THEN CAST(p_size * 30000 AS BIGINT) ELSE NULL END AS lifetime_budget",
    f"{_BUDGET} AS budget_remaining",
    "'2023-01-05 00:00:00' AS created_time", "'2023-02-05 00:00:00' AS updated_time",
    "'2023-01-10 00:00:00' AS start_time", f"{_STOP} AS stop_time",
    "'2023-03-01 02:00:00' AS _extraction_timestamp", "'2023-03-01' AS _load_date",
), where="p_partkey % 2 = 0")

# The two unified-campaign inputs, one per platform.
ADS_DIM = Derived("part", (
    "CAST(p_partkey AS STRING) AS campaign_id", "p_name AS campaign_name", "p_type AS objective", _STATUS,
    "TIMESTAMP '2023-01-05 00:00:00' AS created_time", "TIMESTAMP '2023-02-05 00:00:00' AS updated_time",
    "DATE '2023-01-10' AS start_time", f"{_STOP} AS stop_time",
    "CAST(p_size * 1000 AS BIGINT) AS daily_budget", "CAST(p_size * 30000 AS BIGINT) AS lifetime_budget",
    f"{_BUDGET} AS budget_remaining", "'acc' || CAST(p_size % 5 AS STRING) AS account_id",
), where="p_partkey % 2 = 0")

SEARCH_DIM = Derived("part", (
    "CAST(p_partkey AS STRING) AS campaign_id", "p_name AS campaign_name", "p_brand AS campaign_type", _STATUS,
    "TIMESTAMP '2023-01-05 00:00:00' AS created_time", "TIMESTAMP '2023-02-05 00:00:00' AS updated_time",
    "DATE '2023-01-10' AS start_date",
    "CASE WHEN p_partkey % 6 = 1 THEN DATE '2023-06-30' ELSE NULL END AS end_date",
    "CAST(p_size * 1000 AS BIGINT) AS daily_budget", "CAST(p_size * 30000 AS BIGINT) AS total_budget",
    f"{_BUDGET} AS remaining_budget", "'cust' || CAST(p_size % 4 AS STRING) AS account_id",
), where="p_partkey % 2 = 1")

INSIGHTS = Derived("lineitem", (
    "CAST(l_partkey AS STRING) AS campaign_id", "CAST(l_shipdate AS DATE) AS date_start",
    "l_returnflag AS age", "l_linestatus AS gender", "CAST(l_suppkey % 3 AS STRING) AS country",
    "CAST(l_suppkey AS STRING) AS adset_id", "CAST(l_orderkey AS STRING) AS ad_id",
    "CAST(l_quantity * 100 AS BIGINT) AS impressions",
    "CAST(l_quantity AS BIGINT) * (l_linenumber - 1) AS clicks",
    "CAST(l_extendedprice AS DECIMAL(15,2)) AS spend",
    "CAST(l_quantity * 60 AS BIGINT) AS reach",
), where="l_partkey % 2 = 0")

SEARCH_ROWS = Derived("lineitem", (
    "'cust' || CAST(l_suppkey % 4 AS STRING) AS customer_id", "CAST(l_partkey AS STRING) AS campaign_id",
    "p_name AS campaign_name", "CAST(l_orderkey AS STRING) AS ad_group_id",
    "'word ' || CAST(l_linenumber AS STRING) AS keyword", "'EXACT' AS match_type",
    "CAST(CAST(l_quantity * 100 AS BIGINT) AS STRING) AS impressions",
    "CAST(CAST(l_quantity AS BIGINT) * (l_linenumber - 1) AS STRING) AS clicks",
    """CAST(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * 100 AS BIGINT) * 10000 AS STRING) AS cost_micros""",
    "CAST(l_linenumber - 1 AS STRING) AS conversions",
    """CASE WHEN l_orderkey % 2 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) ELSE '0.00' END
       AS conversion_value""",
    "CAST(CAST(l_shipdate AS DATE) AS STRING) AS date",
    "'2023-03-01 02:00:00' AS _extraction_timestamp", "'google_ads' AS _source_system", "'2023-03-01' AS _load_date",
), where="l_partkey % 2 = 1", join=("part", "l_partkey = p_partkey"))

LEADS = Derived("orders", (
    "CAST(o_orderkey AS STRING) AS id", "o_orderdate AS created_time",
    "CAST(o_custkey % 50 AS STRING) AS campaign_id",
    """'[{"name":"full_name","values":["Lead ' || CAST(o_custkey AS STRING)
       || '"]},{"name":"email","values":["L' || CAST(o_custkey AS STRING) || '@Example.com"]}'
       || CASE WHEN o_orderkey % 3 = 0 THEN ''
          ELSE ',{"name":"phone_number","values":["+55 11 9' || lpad(CAST(o_custkey AS STRING), 8, '0') || '"]}' END
       || ']' AS field_data""",
    "CAST(o_orderdate AS DATE) AS load_date",
    "o_orderdate AS _extraction_timestamp", "'facebook_ads' AS _source_system",
    "CAST(o_orderdate AS DATE) AS _load_date",
))

# The leads as a log of few load dates: one a quarter.
LEADS_BY_QUARTER = Derived("orders", tuple(
    c.replace("CAST(o_orderdate AS DATE)", "CAST(date_trunc('quarter', o_orderdate) AS DATE)") for c in LEADS.columns))

INPUTS = {
    "contacts": CONTACTS, "contact_versions": CONTACT_VERSIONS, "ad_campaigns": AD_CAMPAIGNS, "ads_dim": ADS_DIM,
    "search_dim": SEARCH_DIM, "insights": INSIGHTS, "search_rows": SEARCH_ROWS, "leads": LEADS,
    "leads_by_quarter": LEADS_BY_QUARTER,
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame."""
    d = INPUTS[name]
    df = table(spark, sf_dir, d.table)
    if d.where:
        df = df.filter(d.where)
    if d.join:
        from pyspark.sql import functions as F
        other, condition = d.join
        df = df.join(table(spark, sf_dir, other), F.expr(condition))
    if d.versions:
        df = df.selectExpr("*", f"explode(sequence(1, {d.versions})) AS n")
    return df.selectExpr(*d.columns)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to a fresh scratch folder and read back, as between two layers."""
    out = scratch_dir(df.sparkSession, label)
    with shuffles_given_back(df.sparkSession):
        write_table(df, out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def cte(*names: str) -> str:
    """The derived inputs as the head of a DuckDB query; ``a=b`` is the input b under the name a."""
    parts = []
    for name, _, of in (n.partition("=") for n in names):
        d = INPUTS[of or name]
        source = d.table + (f" JOIN {d.join[0]} ON {d.join[1]}" if d.join else "")
        if d.versions:
            source += f" CROSS JOIN (SELECT unnest(range(1, {d.versions + 1})) AS n) v"
        where = f" WHERE {d.where}" if d.where else ""
        parts.append(f"{name} AS (SELECT {', '.join(d.columns)} FROM {source}{where})")
    return "WITH " + ",\n".join(parts) + "\n"

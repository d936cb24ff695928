"""Lead mart and dashboard datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import cte, frame, stored, table
from checks.registry import check
from checks.staging import (
    CAMPAIGN_DAYS, CAMPAIGNS, METRICS, STG_AD_CAMPAIGNS, STG_CONTACTS, STG_LEADS, STG_SEARCH, insights_log, nth_label,
    rounded, search_log, staged_contacts, staged_leads, unified_campaigns,
)
from checks.vault import DETAILS, HITS, LEAD_PEOPLE, PEOPLE, PRODUCERS, SAT
from leadvault.plans import marts as M
from leadvault.plans import vault as V
from leadvault.plans.layers import run_layers
from leadvault.session import scratch_dir
from leadvault.sources.writes import export_csv

AS_OF = "2000-01-01"

_MART = """, hub AS (
  SELECT pessoa_hash_key, MIN(load_date) AS hub_load_date FROM (
    SELECT pessoa_hash_key, load_date FROM people UNION ALL SELECT pessoa_hash_key, load_date FROM lead_people)
  WHERE pessoa_hash_key IS NOT NULL GROUP BY pessoa_hash_key),
newest AS (
  SELECT * FROM sat WHERE load_end_date IS NULL OR load_end_date > DATE '2000-01-01'
  QUALIFY row_number() OVER (PARTITION BY pessoa_hash_key ORDER BY load_date DESC, hash_diff DESC) = 1),
mart AS (
  SELECT h.pessoa_hash_key, s.nome, s.email, s.telefone, s.origem, s.cliente_origem, s.lead_id, s.campaign_id,
    s.created_time AS lead_created_time, s.completude_score, s.has_nome, s.has_valid_email, s.has_valid_telefone,
    c.nome AS campaign_name, c.plataforma, c.objetivo, c.status AS campaign_status, c.spend AS campaign_spend,
    c.impressions, c.clicks, c.ctr, c.cpc, c.performance_ctr, c.categoria_cpc,
    """ + nth_label(("Incompleto", "Parcial", "Completo"), "s.completude_score > 1", "s.completude_score > 2") + """ AS qualidade_dados,
    datesub('day', s.created_time, TIMESTAMP '2000-01-01') AS dias_desde_lead,
    """ + nth_label(("Recente", "Médio", "Antigo"), *[f"datesub('day', s.created_time, TIMESTAMP '2000-01-01') > {n}" for n in (7, 30)]) + """ AS categoria_tempo,
    CAST(s.origem = 'facebook_ads' AS INTEGER) AS is_facebook_lead, CAST(s.origem = 'google_ads' AS INTEGER) AS is_google_lead,
    CAST(s.origem IN ('crm', 'activecampaign') AS INTEGER) AS is_crm_lead, h.hub_load_date,
    s.load_date AS sat_load_date, md5(h.pessoa_hash_key) AS lead_key
  FROM hub h JOIN newest s ON s.pessoa_hash_key = h.pessoa_hash_key
  LEFT JOIN campaigns c ON c.campaign_id = s.campaign_id AND c.plataforma = s.origem)
"""

_INPUTS = (cte("contacts", "leads", "ads_dim", "search_dim", "insights", "search_rows") + STG_CONTACTS + PEOPLE
           + STG_LEADS + LEAD_PEOPLE + DETAILS + SAT + METRICS + CAMPAIGNS + _MART)


def mart(spark, sf):
    leads, contacts = stored(staged_leads(spark, sf), "leads"), stored(staged_contacts(spark, sf), "contacts")
    return M.mart_leads(V.hub_person_multi(leads, contacts), V.sat_person(leads, contacts),
                        unified_campaigns(spark, sf), AS_OF)


@check("mart_leads", _INPUTS + """SELECT * EXCLUDE (campaign_spend, ctr, cpc), round(campaign_spend, 6) AS campaign_spend,
  round(ctr, 6) AS ctr, round(cpc, 6) AS cpc FROM mart""")
def mart_leads(spark, sf):
    return rounded(mart(spark, sf), 6, "campaign_spend", "ctr", "cpc")


def _dashboard(spark, sf, name, **filters):
    return M.dashboard(mart(spark, sf), AS_OF, filters.pop("days", None), **filters)[name]


@check("leads_by_origin", _INPUTS + "SELECT origem, COUNT(*) AS count FROM mart GROUP BY origem")
def leads_by_origin(spark, sf):
    return _dashboard(spark, sf, "leads_by_origin")


@check("leads_by_day", _INPUTS + """SELECT date_trunc('day', lead_created_time) AS lead_created_time,
  COUNT(*) AS count_leads FROM mart WHERE lead_created_time >= TIMESTAMP '1999-12-02'
  AND lead_created_time < TIMESTAMP '2000-01-01' GROUP BY 1""")
def leads_by_day(spark, sf):
    return _dashboard(spark, sf, "leads_by_day", days=30)


@check("leads_by_quality", _INPUTS + "SELECT qualidade_dados, COUNT(*) AS count FROM mart GROUP BY 1")
def leads_by_quality(spark, sf):
    return _dashboard(spark, sf, "leads_by_quality")


@check("platform_performance", _INPUTS + """SELECT plataforma, COUNT(*) AS total_leads,
  round(CAST(SUM(CAST(campaign_spend AS DECIMAL(18,6))) AS DOUBLE), 4) AS total_spend,
  round(CAST(SUM(CAST(cpc AS DECIMAL(18,6))) AS DOUBLE) / COUNT(cpc), 4) AS avg_cpc,
  round(CAST(SUM(CAST(ctr AS DECIMAL(18,6))) AS DOUBLE) / COUNT(ctr), 4) AS avg_ctr FROM mart GROUP BY plataforma""")
def platform_performance(spark, sf):
    df = _dashboard(spark, sf, "platform_performance")
    return rounded(df, 4, "total_spend", "avg_cpc", "avg_ctr")


@check("leads_by_client", _INPUTS + """SELECT cliente_origem, COUNT(*) AS count FROM mart
  WHERE cliente_origem = 'facebook_ads' GROUP BY 1""")
def leads_by_client(spark, sf):
    return _dashboard(spark, sf, "leads_by_client", cliente_origem="facebook_ads")


@check("completeness_funnel", _INPUTS + """SELECT COUNT(*) AS total_leads, CAST(SUM(has_nome) AS BIGINT) AS leads_com_nome,
  CAST(SUM(has_valid_email) AS BIGINT) AS leads_com_email, CAST(SUM(has_valid_telefone) AS BIGINT) AS leads_com_telefone
  FROM mart""")
def completeness_funnel(spark, sf):
    return _dashboard(spark, sf, "completeness_funnel")


@check("cost_per_lead", _INPUTS + """SELECT campaign_name,
  round(CAST(SUM(CAST(campaign_spend AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*), 4) AS cost_per_lead,
  COUNT(*) AS total_leads FROM mart WHERE plataforma = 'facebook_ads' GROUP BY campaign_name""")
def cost_per_lead(spark, sf):
    return rounded(_dashboard(spark, sf, "cost_per_lead", plataforma="facebook_ads"), 4, "cost_per_lead")


@check("lead_heatmap", _INPUTS + """SELECT CAST(hour(lead_created_time) AS INTEGER) AS hour,
  CAST(dayofweek(lead_created_time) + 1 AS INTEGER) AS day_of_week, COUNT(*) AS count FROM mart GROUP BY 1, 2""")
def lead_heatmap(spark, sf):
    return _dashboard(spark, sf, "lead_heatmap")


_ARRIVED = {  # what of each log the three runs see; the last sees everything
    "contacts": ("_load_date = '2023-04-01'", "_load_date = '2023-04-01'"),
    "leads": ("_load_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'", "_load_date >= DATE '1995-01-01'"),
    "insights": ("_load_date = '2023-03-01'", "_load_date <> '2023-02-01'"),
    "search_rows": ("_load_date = '2023-03-01'", "true"),
    "ad_campaigns": ("true", "true"),
}

_TESTED = {  # declared tests of which a row can fail, by table
    "leads": ("created_time IS NULL", "_load_date IS NULL"),
    "contacts": ("email IS NULL", "cdate IS NULL"),
    "stg_contacts": ("email IS NULL",),
    "stg_leads": ("email IS NULL",),
}


def _counted(layer, **models):
    return [f"SELECT '{layer}' AS layer, '{name}' AS step, CAST(({sql if sql.startswith('SELECT') else f'SELECT COUNT(*) FROM {sql}'}) AS BIGINT) AS n_rows"
            for name, sql in models.items()]


_LAYER_ROWS = (
    _counted("window", load_dates="""SELECT COUNT(DISTINCT _load_date) + 2 FROM leads WHERE _load_date < DATE '1995-01-01'""")
    + _counted("seeds", nation="nation")
    + _counted(
        "staging", stg_contacts="stg_contacts", stg_leads="stg_leads",
        stg_search_rows="SELECT COUNT(*) + COUNT(*) FILTER (day(campaign_date) % 2 = 0) FROM typed",
        ad_campaign_rows="ad_campaigns", insight_rows="rolled WHERE day(date_start) % 10 <> 1", search_current="typed",
        insight_days="(SELECT DISTINCT campaign_id, date_start FROM rolled WHERE day(date_start) % 10 <> 1)",
        search_days="(SELECT DISTINCT customer_id, campaign_id, campaign_name, campaign_date FROM typed)",
        stg_ad_campaigns="stg_ad_campaigns", stg_search_campaigns="stg_search_campaigns")
    + _counted(
        "silver", hub_person="hub",
        hub_campaign="SELECT (SELECT COUNT(*) FROM stg_ad_campaigns) + COUNT(DISTINCT campaign_id) FROM stg_search_campaigns",
        hub_producer="(SELECT DISTINCT upper(trim(producer)) FROM named WHERE producer IS NOT NULL)",
        link_person_producer="""(SELECT DISTINCT pessoa_hash_key, upper(trim(producer)) FROM named
          WHERE producer IS NOT NULL AND pessoa_hash_key IS NOT NULL)""",
        campaign_match_keys="(SELECT DISTINCT ck, rule, match_key FROM camp_keys)",
        contact_offers="(SELECT DISTINCT pk, rule, match_key FROM offers)",
        campaign_offers="(SELECT DISTINCT pk, rule, match_key FROM offers SEMI JOIN camp_keys USING (rule, match_key))",
        person_campaign_matches="(SELECT DISTINCT pk, rule, match_key FROM matched)", sat_person="sat")
    + _counted(
        "gold", campaign_metrics="metrics", campaigns="campaigns", mart_leads="mart",
        leads_by_origin="SELECT COUNT(DISTINCT origem) FROM mart",
        leads_by_day="(SELECT DISTINCT CAST(lead_created_time AS DATE) FROM mart)",
        leads_by_quality="SELECT COUNT(DISTINCT qualidade_dados) FROM mart",
        platform_performance="(SELECT DISTINCT plataforma FROM mart)",
        leads_by_client="SELECT COUNT(DISTINCT cliente_origem) FROM mart", completeness_funnel="SELECT 1",
        cost_per_lead="(SELECT DISTINCT campaign_name FROM mart)",
        lead_heatmap="(SELECT DISTINCT hour(lead_created_time), dayofweek(lead_created_time) FROM mart)")
    + _counted("test", dq_report="SELECT 48", failing_rows="SELECT " + " + ".join(
        f"(SELECT COUNT(*) FROM {name} WHERE {bad})" for name, tests in _TESTED.items() for bad in tests)))


@check("run_layers", cte("contacts", "leads=leads_by_quarter", "ads_dim", "search_dim", "insights", "search_rows", "ad_campaigns")
       + STG_CONTACTS + PEOPLE + STG_LEADS + LEAD_PEOPLE + DETAILS + SAT + METRICS + CAMPAIGNS + _MART + CAMPAIGN_DAYS
       + STG_AD_CAMPAIGNS + STG_SEARCH + HITS + PRODUCERS
       + "SELECT layer, step, 'success' AS status, n_rows FROM (" + "\n UNION ALL ".join(_LAYER_ROWS) + ")")
def run_layers_(spark, sf):
    """Three runs over what has arrived so far, load dates out of order, the first two up to the silver layer. The result is the status of the last
    one, with the rows of every model, which are those of one load of everything."""
    inputs = {n: frame(spark, sf, n) for n in ("contacts", "ad_campaigns", "ads_dim", "search_dim")}
    inputs |= {"leads": frame(spark, sf, "leads_by_quarter"), "insights": insights_log(spark, sf), "search_rows": search_log(spark, sf)}
    inputs = {n: stored(df, n) for n, df in inputs.items()}
    nations, seed = table(spark, sf, "nation"), scratch_dir(spark, "seed")
    export_csv(nations, seed)
    root = scratch_dir(spark, "layers")
    for k in range(3):
        arrived = {n: df.filter(_ARRIVED[n][k]) if k < 2 and n in _ARRIVED else df for n, df in inputs.items()}
        status = run_layers(spark, arrived, root, AS_OF, dashboard_days=None, seeds={"nation": (seed, nations.schema)}, gold=k == 2)
    return status.select("layer", "step", "status", "n_rows")

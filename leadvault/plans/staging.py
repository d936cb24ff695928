"""Staging: raw rows cleaned, typed and flagged. Lazy frames, nothing is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadvault.functions import (
    all_present, any_positive, band, clean_lower, clean_upper, digits, flag, is_recent, json_fields, non_blank, ratio,
    strip,
)
from leadvault.operators.aggregates import activity_period, ratio_of_sums
from leadvault.operators.incremental import latest_by_key
from leadvault.sources.reads import unpack_answers
from leadvault.sources.schemas import AD_INSIGHTS, SEARCH_CAMPAIGNS

# Platform names and labels.
CRM, ADS, SEARCH = "activecampaign", "facebook_ads", "google_ads"
START_DATE = "2023-01-01"
CTR_BANDS = [(">=", 2.0, "Alto"), (">=", 1.0, "Médio"), (">", 0.0, "Baixo")]
COST_BANDS = [("<=", 2.0, "Baixo Custo"), ("<=", 5.0, "Custo Médio")]


def _loaded_since(df: DataFrame, start_date: str) -> DataFrame:
    """Rows loaded from the start date on; a frame without `_load_date` is an error."""
    return df.filter(F.col("_load_date") >= F.lit(start_date))


def _stamp(name: str) -> Column:
    """Malformed times are NULL; they do not end the run."""
    return F.col(name).try_cast("timestamp_ntz")


def _cents(name: str) -> Column:
    return F.col(name).try_cast("decimal(15,2)").cast("double") / 100


def stg_contacts(bronze: DataFrame, as_of: str, start_date: str = START_DATE) -> DataFrame:
    """CRM contacts that can be reached: cleaned, with quality band, origin and recency."""
    custom = F.col("fields")
    if isinstance(bronze.schema["fields"].dataType, T.StringType):
        custom = json_fields("fields", ["lead_source", "utm_campaign", "utm_source", "utm_medium", "utm_content"])
    raw = _loaded_since(bronze, start_date).withColumn("_f", custom)
    or_blank = lambda member: F.coalesce(F.col("_f")[member], F.lit(""))
    both_names = F.concat(F.coalesce("firstName", F.lit("")), F.lit(" "), F.coalesce("lastName", F.lit("")))
    cleaned = raw.select(
        F.col("id").cast("string").alias("contact_id"),
        clean_upper("firstName").alias("primeiro_nome"),
        clean_upper("lastName").alias("ultimo_nome"),
        clean_upper(both_names).alias("nome_completo"),
        clean_lower("email").alias("email"),
        digits(F.coalesce("phone", F.lit(""))).alias("telefone"),
        "organization",
        F.col("deleted").cast("boolean").alias("is_deleted"),
        F.col("anonymized").cast("boolean").alias("is_anonymized"),
        "tags",
        _stamp("cdate").alias("created_timestamp"),
        _stamp("udate").alias("updated_timestamp"),
        _stamp("_extraction_timestamp").alias("extraction_timestamp"),
        F.col("_load_date").try_cast("date").alias("load_date"),
        F.coalesce(F.col("_f")["lead_source"], F.lit("unknown")).alias("lead_source"),
        or_blank("utm_campaign").alias("utm_campaign"),
        or_blank("utm_source").alias("utm_source"),
        or_blank("utm_medium").alias("utm_medium"),
        or_blank("utm_content").alias("utm_content"),
    )
    has_at = F.col("email").contains("@")
    long_phone = F.length("telefone") >= 10
    long_name = F.length(strip("nome_completo")) > 2
    flagged = cleaned.withColumns({
        "has_valid_email": flag(has_at & F.col("email").contains(".")),
        "has_valid_phone": flag(long_phone),
        "has_valid_name": flag(long_name),
        "qualidade_lead": F.when(has_at & long_phone & long_name, "Completo")
        .when(has_at & long_name, "Parcial").when(has_at, "Mínimo").otherwise("Incompleto"),
        "origem_lead": F.when(F.col("utm_source") != "", F.col("utm_source"))
        .when(F.col("lead_source") != "unknown", F.col("lead_source")).otherwise("activecampaign_direct"),
        "origem": F.lit(CRM),
        "record_source": F.lit(CRM),
        "is_recent_contact": is_recent("created_timestamp", as_of),
        "has_tags": non_blank("tags"),
    })
    reachable = flagged.withColumn("has_contact_info", F.col("has_valid_email") | F.col("has_valid_phone"))
    return reachable.filter(~F.col("is_deleted") & ~F.col("is_anonymized") & F.col("has_contact_info"))


def stg_leads(bronze: DataFrame, start_date: str | None = None) -> DataFrame:
    """Ad-platform leads: form answers unpacked and cleaned."""
    rows = bronze if start_date is None else bronze.filter(F.col("load_date") >= F.lit(start_date).cast("date"))
    answers = unpack_answers(rows, {"_name": "full_name", "_email": "email", "_phone": "phone_number"})
    cleaned = answers.select(
        F.col("id").alias("lead_id"),
        strip(F.upper("_name")).alias("nome"),
        clean_lower("_email").alias("email"),
        digits("_phone").alias("telefone"),
        "campaign_id",
        _stamp("created_time").alias("created_timestamp"),
        "load_date",
        F.lit(ADS).alias("origem"),
        F.lit(ADS).alias("record_source"),
    )
    flagged = cleaned.withColumns({
        "has_valid_email": flag(F.col("email").contains("@") & F.col("email").contains(".")),
        "has_valid_phone": flag(F.length("telefone") >= 10),
    })
    return flagged.withColumn("has_contact_info", F.col("has_valid_email") | F.col("has_valid_phone"))


#: Of several loads of a row the newest counts.
LOAD_ORDER = ["_load_date", "_extraction_timestamp"]


def current_insights(insights: DataFrame, start_date: str = START_DATE) -> DataFrame:
    """An insights append log from the start date on without superseded rows: the newest load per primary key."""
    return latest_by_key(_loaded_since(insights, start_date), AD_INSIGHTS.key, LOAD_ORDER)


def current_search_rows(rows: DataFrame, start_date: str = START_DATE) -> DataFrame:
    """A search append log from the start date on without superseded rows: the newest load per primary key."""
    return latest_by_key(_loaded_since(rows, start_date), SEARCH_CAMPAIGNS.key, LOAD_ORDER)


def current_campaigns(campaigns: DataFrame, start_date: str = START_DATE) -> DataFrame:
    """The newest row per ad campaign, from a log."""
    return latest_by_key(_loaded_since(campaigns, start_date), "id", CAMPAIGN_ORDER)


CAMPAIGN_ORDER = ["updated_time", "_load_date"]
_SUMS = {"impressions": "total_impressions", "clicks": "total_clicks", "spend": "total_spend_brl", "reach": "total_reach"}
_AVERAGES = ("frequency", "cpm", "cpc", "ctr")


def insight_days(current: DataFrame) -> DataFrame:
    """Current insights folded to one row per campaign and day: sums, and what averages need. Sums of days add up to the
    sums of rows, so a load computes only the days it touches."""
    value = lambda c: F.coalesce(F.col(c), F.lit(0))
    return current.groupBy("campaign_id", "date_start").agg(
        *[F.sum(value(c)).alias(c) for c in _SUMS],
        *[F.sum(value(c).cast("decimal(18,6)")).alias(f"{c}_sum") for c in _AVERAGES], F.count(F.lit(1)).alias("n_rows"))


def stg_ad_campaigns(campaigns: DataFrame, insights: DataFrame, start_date: str = START_DATE) -> DataFrame:
    """Ad campaigns with their insight totals and averages.

    Both are append logs, of which the newest rows count: per campaign, and per campaign, day and breakdown."""
    return ad_campaigns_of(current_campaigns(campaigns, start_date), insight_days(current_insights(insights, start_date)))


def ad_campaigns_of(newest: DataFrame, days: DataFrame) -> DataFrame:
    """Ad campaigns, one row each, with the totals of their days. Days are folded to one row per campaign before the
    join, so the join adds no rows and a campaign with most of the insights is folded on the map side."""
    cleaned = newest.filter(all_present("name", "id")).select(
        F.col("id").alias("campaign_id"), "account_id", F.col("name").alias("campaign_name"),
        "objective", "status",
        _stamp("created_time").alias("created_timestamp"), _stamp("updated_time").alias("updated_timestamp"),
        _stamp("start_time").alias("start_timestamp"), _stamp("stop_time").alias("stop_timestamp"),
        _cents("daily_budget").alias("daily_budget_brl"), _cents("lifetime_budget").alias("lifetime_budget_brl"),
        _cents("budget_remaining").alias("budget_remaining_brl"),
        _stamp("_extraction_timestamp").alias("extraction_timestamp"),
        F.col("_load_date").try_cast("date").alias("load_date"),
    )
    totals = days.groupBy("campaign_id").agg(
        *[F.sum(c).alias(out) for c, out in _SUMS.items()],
        *[(F.sum(f"{c}_sum").cast("double") / F.sum("n_rows")).alias(f"avg_{c}") for c in _AVERAGES])
    joined = cleaned.join(totals, "campaign_id", "left").fillna(
        0, [*_SUMS.values(), *[f"avg_{c}" for c in _AVERAGES]])
    return joined.withColumns({
        "origem": F.lit(ADS),
        "record_source": F.concat(F.lit("facebook_ads_"), F.col("account_id")),
        "is_valid_campaign": F.lit(True),
        "is_active": flag(F.col("status") == "ACTIVE"),
        "has_activity": any_positive("total_impressions", "total_clicks", "total_spend_brl"),
        "performance_ctr": band("avg_ctr", CTR_BANDS, "Sem Dados"),
        "categoria_custo": band("avg_cpc", COST_BANDS, "Alto Custo"),
    })


def stg_search_rows(rows: DataFrame, start_date: str = START_DATE) -> DataFrame:
    """Search-ad rows, typed: one per campaign and day (and whatever the source splits by)."""
    typed = _loaded_since(rows, start_date).select(
        "customer_id", "campaign_id", "campaign_name",
        F.col("impressions").try_cast("bigint").alias("impressions"),
        F.col("clicks").try_cast("bigint").alias("clicks"),
        F.col("cost_micros").try_cast("bigint").alias("cost_micros"),
        F.col("conversions").try_cast("decimal(10,2)").alias("conversions"),
        F.col("conversion_value").try_cast("decimal(10,2)").alias("conversion_value"),
        F.col("date").try_cast("date").alias("campaign_date"),
        _stamp("_extraction_timestamp").alias("extraction_timestamp"),
        F.col("_load_date").try_cast("date").alias("load_date"),
    )
    return typed.withColumns({
        "cost_brl": F.col("cost_micros").cast("double") / 1_000_000,
        "origem": F.lit(SEARCH),
        "has_activity": any_positive("impressions", "clicks", "cost_micros"),
    })


def search_days(typed: DataFrame) -> DataFrame:
    """Typed current search rows folded to one row per campaign, name and day."""
    return typed.groupBy("customer_id", "campaign_id", "campaign_name", "campaign_date").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost_micros", "conversions", "conversion_value")],
        F.max("extraction_timestamp").alias("extraction_timestamp"), F.max("load_date").alias("load_date"))


def stg_search_campaigns(rows: DataFrame, start_date: str = START_DATE) -> DataFrame:
    """Search campaigns with activity, from an append log of which the newest load per row counts."""
    return search_campaigns_of(search_days(stg_search_rows(current_search_rows(rows, start_date), start_date)))


def search_campaigns_of(days: DataFrame) -> DataFrame:
    """Search campaigns with activity: totals of their days, cost per click, click rate and return on spend. Days are as
    ``search_days`` gives them, one row per campaign, name and day."""
    totals = days.groupBy("customer_id", "campaign_id", "campaign_name").agg(
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("cost_micros").alias("total_cost_micros"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("conversion_value").alias("total_conversion_value"),
        ratio_of_sums("clicks", "impressions", 100).alias("avg_ctr"),
        *activity_period("campaign_date", "extraction_timestamp", "load_date", folded=True),
    )
    cost = F.col("total_cost_micros").cast("double") / 1_000_000
    priced = totals.withColumns({"avg_cpc": ratio(cost, "total_clicks"), "total_cost_brl": cost})
    profit = F.col("total_conversion_value").cast("double") - F.col("total_cost_brl")
    return priced.withColumns({
        "origem": F.lit(SEARCH),
        "record_source": F.concat(F.lit("google_ads_"), F.col("customer_id")),
        "has_activity": any_positive("total_impressions", "total_clicks", "total_cost_micros"),
        "performance_categoria": band("avg_ctr", CTR_BANDS, "Sem Dados"),
        "roi_percent": F.when(F.col("total_cost_brl") > 0, profit / F.col("total_cost_brl") * 100).otherwise(0.0),
    }).filter("has_activity")

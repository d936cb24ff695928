"""Declared schemas of the raw streams, with their keys and cursors. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Stream:
    """A raw append log: its schema, primary key and incremental cursor."""

    schema: T.StructType
    key: tuple
    cursor: str


def _fields(names: str, data_type: T.DataType | None = None) -> list[T.StructField]:
    return [T.StructField(n, data_type or T.StringType()) for n in names.split()]


# Audit columns every load adds.
AUDIT = T.StructType(_fields("_extraction_timestamp _source_system _load_date"))


def _stream(fields: list[T.StructField], key: str, cursor: str) -> Stream:
    return Stream(T.StructType([*fields, *AUDIT.fields]), tuple(key.split()), cursor)


# Fixed values below: column names and types as the sources declare them. Objects whose members
# are not declared stay JSON text.
CUSTOM_FIELDS = T.StructType(_fields(
    "lead_source utm_campaign utm_source utm_medium utm_content utm_term company position website notes"))

CRM_CONTACTS = _stream([
    *_fields("""id email firstName lastName phone orgid orgname segmentio_id bounced_hard bounced_soft bounced_date ip
             ua hash socialdata_lastcheck email_local email_domain sentcnt rating_tstamp gravatar deleted anonymized
             adate udate cdate edate deleted_at created_utc_timestamp updated_utc_timestamp created_timestamp
             updated_timestamp created_by updated_by links id_check organization tags"""),
    T.StructField("fields", CUSTOM_FIELDS)], "id", "updated_timestamp")

CRM_CAMPAIGNS = _stream(_fields(
    """id type userid segmentid bounceid realcid sendid threadid seriesid formid basetemplateid basemessageid addressid
    source name cdate mdate sdate ldate send_amt total_amt opens uniqueopens linkclicks uniquelinkclicks
    subscriberclicks forwards uniqueforwards hardbounces softbounces unsubscribes unsubreasons updates socialshares
    replies uniquereplies status public mail_transfer mail_send mail_cleanup mailer_log_file tracklinks
    tracklinksanalytics trackreads trackreadsanalytics analytics_campaign_name tweet facebook survey embed_images
    htmlunsub textunsub htmlunsubdata textunsubdata recurring willrecur split_type split_content split_offset
    split_offset_type split_winner_messageid split_winner_awaiting responder_offset responder_type responder_existing
    reminder_field reminder_format reminder_type reminder_offset reminder_offset_type reminder_offset_sign
    reminder_last_cron_run activerss_interval activerss_url activerss_items ip4 laststep managetext schedule
    scheduleddate waitpreview deletestamp replysys created_timestamp updated_timestamp created_by updated_by links"""),
    "id", "updated_timestamp")

CRM_LISTS = _stream(_fields(
    """id name cdate p_use_tracking p_use_analytics_read p_use_analytics_link p_use_twitter p_use_facebook p_embed_image
    p_use_captcha send_last_broadcast private analytics_domains analytics_source analytics_ua twitter_token
    twitter_token_secret facebook_session carboncopy subscription_notify unsubscription_notify require_name
    get_unsubscribe_reason to_name optinoptout sender_name sender_addr1 sender_addr2 sender_city sender_state sender_zip
    sender_country sender_phone fulladdress optinmessageid optoutconf deletestamp udate created_timestamp
    updated_timestamp created_by updated_by links"""), "id", "updated_timestamp")

CRM_DEALS = _stream(_fields(
    """id hash owner contact organization group stage title description percent cdate mdate nextdate nexttaskid value
    currency winProbability winProbabilityMdate status activitycount nextdealid edate created_timestamp
    updated_timestamp created_by updated_by links"""), "id", "updated_timestamp")

_BUDGETS = _fields("daily_budget lifetime_budget budget_remaining", T.DoubleType())

AD_CAMPAIGNS = _stream([
    *_fields("id name objective status created_time updated_time start_time stop_time account_id"), *_BUDGETS],
    "id", "updated_time")

AD_SETS = _stream([
    *_fields("""id name campaign_id status created_time updated_time start_time end_time targeting optimization_goal
             billing_event"""), *_BUDGETS], "id", "updated_time")

ADS = _stream([
    *_fields("id name adset_id campaign_id status created_time updated_time creative"),
    T.StructField("tracking_specs", T.ArrayType(T.StringType()))], "id", "updated_time")

ANSWERS = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("values", T.ArrayType(T.StringType()))]))

AD_LEADS = _stream([
    *_fields("id created_time ad_id adset_id campaign_id form_id partner_name"),
    T.StructField("is_organic", T.BooleanType()), T.StructField("field_data", ANSWERS)], "id", "created_time")

AD_INSIGHTS = _stream([
    *_fields("campaign_id campaign_name objective status age gender country"),
    *_fields("""impressions clicks spend reach frequency cpm cpc ctr cost_per_unique_click unique_clicks
             unique_ctr""", T.DoubleType()),
    *_fields("date_start date_stop", T.DateType())], "campaign_id date_start age gender country", "date_start")

SEARCH_CAMPAIGNS = _stream(_fields(
    """customer_id campaign_id ad_group_id campaign_name ad_group_name keyword match_type impressions clicks cost_micros
    conversions conversion_value date"""), "customer_id campaign_id ad_group_id keyword match_type date", "date")

"""Vault loads: person, campaign and producer hubs, their links, and the person satellite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadvault.functions import (
    first_usable, flag, flag01, hash_diff, hash_key, non_blank, not_sentinel, person_hash, score,
    strip, tagged_name,
)
from leadvault.operators.aggregates import earliest_row, first_seen
from leadvault.operators.incremental import new_keys, newer_than
from leadvault.operators.joins import alias_column, spread_join
from leadvault.operators.rows import compute_once
from leadvault.operators.vault import load_hub, load_link, load_satellite
from leadvault.plans.staging import ADS, CRM, SEARCH

PERSON, CAMPAIGN, PRODUCER = "pessoa_hash_key", "campanha_hash_key", "produtor_hash_key"
PERSON_CAMPAIGN, PERSON_PRODUCER = "pessoa_campanha_hash_key", "pessoa_produtor_hash_key"

# Which source tag stands for which platform, and the order of the match rules.
SOURCE_ALIASES = {"facebook": ADS, "fb": ADS, "google": SEARCH, "adwords": SEARCH}
MATCH_RULES = ("match_by_id", "match_by_name", "match_by_source")


def with_person(df: DataFrame, name: str) -> DataFrame:
    """Staged rows with their identity hash; those without an identity are left out. Staging has
    stripped the texts, so absent ones are empty."""
    present = [F.nullif(c, F.lit("")) for c in (name, "email", "telefone")]
    return compute_once(df, {PERSON: person_hash(*present)}).filter(F.col(PERSON).isNotNull())


def contact_person(contacts: DataFrame) -> DataFrame:
    return with_person(contacts, "nome_completo")


def lead_person(leads: DataFrame) -> DataFrame:
    return with_person(leads, "nome")


def hub_person(contacts: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """New people from the CRM, dated by extraction; only extracts newer than the hub are read."""
    fresh = newer_than(contacts, target, "extraction_timestamp", target_col="load_date")
    rows = contact_person(fresh).select(PERSON, F.col("extraction_timestamp").alias("load_date"), "record_source")
    return load_hub(rows, PERSON, target)


def hub_person_multi(leads: DataFrame, contacts: DataFrame, target: DataFrame | None = None,
                     use_mark: bool = True) -> DataFrame:
    """New people from leads and CRM: least load date and least source, each on its own.

    The high-water mark spans both sources, so a source that lags behind the other would lose
    rows to it; without the mark every row is tried, and known people are still left out."""
    cols = [PERSON, "load_date", "record_source"]
    rows = lead_person(leads).select(cols).unionByName(contact_person(contacts).select(cols))
    fresh = newer_than(rows, target, "load_date") if use_mark else rows
    return new_keys(first_seen(fresh, PERSON), target, PERSON)


def campaign_key(platform: str) -> Column:
    return hash_key("campaign_id", F.lit(platform))


def hub_campaign(ads: DataFrame, search: DataFrame, target: DataFrame | None = None,
                 use_mark: bool = True) -> DataFrame:
    """New campaigns of both platforms; ``use_mark`` as for ``hub_person_multi``."""
    def rows(df, platform):
        fresh = newer_than(df, target, "load_date") if use_mark else df
        return fresh.select(campaign_key(platform).alias(CAMPAIGN), "load_date", "record_source")
    return load_hub(rows(ads, ADS).unionByName(rows(search, SEARCH)), CAMPAIGN, target)


def producer_name() -> Column:
    """Producer of a contact: its producer tag, else its lead source, else its UTM source."""
    return first_usable(tagged_name("tags", "produtor"), "lead_source", "utm_source")


def hub_producer(contacts: DataFrame, as_of: str, target: DataFrame | None = None) -> DataFrame:
    """New producers, stamped ``as_of``; known producers keep their first stamp."""
    names = contacts.select(producer_name().alias("_producer")).filter(not_sentinel("_producer"))
    rows = names.select(hash_key("_producer", upper=True).alias(PRODUCER)).distinct().select(
        PRODUCER, F.lit(as_of).cast("timestamp_ntz").alias("load_date"), F.lit(CRM).alias("record_source"))
    return new_keys(rows, target, PRODUCER)


def link_person_producer(contacts: DataFrame, target: DataFrame | None = None,
                         use_mark: bool = True) -> DataFrame:
    """New person-producer links. The mark loses contacts that arrive late or on the day of the mark;
    without it every row is tried, and known links are still left out."""
    fresh = newer_than(contacts, target, "load_date") if use_mark else contacts
    rows = contact_person(fresh).withColumn("_producer", producer_name())
    pairs = rows.filter(not_sentinel("_producer")).select(
        PERSON, hash_key("_producer", upper=True).alias(PRODUCER), "load_date", "record_source")
    return load_link(pairs, PERSON, PRODUCER, PERSON_PRODUCER, target)


def campaign_match_keys(ads: DataFrame, search: DataFrame) -> DataFrame:
    """What a contact's tags are matched against: per campaign its id, its name and its platform.

    One row per (rule, match_key, campaign); rules are numbered in the order they are tried."""
    def campaigns(df, platform):
        return df.select(campaign_key(platform).alias(CAMPAIGN), "campaign_id", "campaign_name",
                         F.lit(platform).alias("platform"))
    both = campaigns(ads, ADS).unionByName(campaigns(search, SEARCH))
    key = lambda rule, col: F.struct(F.lit(rule).alias("rule"), col.alias("match_key"))
    keys = F.array(key(1, F.col("campaign_id")), key(2, F.lower("campaign_name")), key(3, F.col("platform")))
    return both.select(CAMPAIGN, F.inline(keys)).filter(F.col("match_key").isNotNull()).distinct()


def contact_offers(contacts: DataFrame) -> DataFrame:
    """Every key a person's tags offer: one row per (person, rule, match_key) with its earliest load. Offers are
    folded on the map side, so the many rows of one person or tag shrink before they are shuffled."""
    tagged = contact_person(contacts).filter(non_blank("utm_campaign"))
    offer = lambda rule, col: F.struct(F.lit(rule).alias("rule"), col.alias("match_key"))
    offers = F.array(offer(1, F.col("utm_campaign")), offer(2, F.lower("utm_campaign")),
                     offer(3, alias_column("utm_source", SOURCE_ALIASES)))
    offered = tagged.select(PERSON, "load_date", "record_source", F.inline(offers)).filter(
        F.col("match_key").isNotNull())
    return earliest_row(offered, [PERSON, "rule", "match_key"], ["load_date", "record_source"])


def known_offers(offers: DataFrame, keys: DataFrame) -> DataFrame:
    """Offers that some campaign has."""
    return offers.join(keys.select("rule", "match_key").distinct(), ["rule", "match_key"], "left_semi")


def campaign_offers(contacts: DataFrame, keys: DataFrame) -> DataFrame:
    return known_offers(contact_offers(contacts), keys)


def best_matches(offers: DataFrame) -> DataFrame:
    """Each person's offers under the first rule that found anything.

    That equals trying the rules one after the other on the people still unmatched, without reading the contacts once
    per rule. Ranked rows are cut down before the shuffle; a person has at most as many offers as there are campaign ids,
    names and platforms, so the group is bounded by the campaigns, however many contacts the person has."""
    first = Window.partitionBy(PERSON).orderBy("rule")
    return offers.withColumn("_rank", F.rank().over(first)).filter("_rank = 1").select(
        PERSON, "rule", "match_key", "load_date", "record_source")


def person_campaign_matches(contacts: DataFrame, keys: DataFrame) -> DataFrame:
    """How each person is matched: the first rule that finds a campaign, and the keys it found.

    One row per (person, rule, match_key). This is the link table in short form: the campaigns
    behind a row are those with the same rule and key, so a person matched to a whole platform
    is one row here, not one per campaign."""
    return best_matches(campaign_offers(contacts, keys))


def expand_matches(matches: DataFrame, keys: DataFrame, target: DataFrame | None = None,
                   spread: int | None = None) -> DataFrame:
    """The link table in full: one row per person and campaign.

    A platform match stands for every campaign of the platform: two keys, and an output far
    larger than the input, so that join is spread over many tasks. Ids and names are many keys
    with few campaigns each: plain equi joins. Id and platform rows are unique as they come; only
    a campaign that had several names can repeat, so only the name rule's part is folded."""
    def pairs(rule, join):
        side = keys.filter(F.col("rule") == rule).select(CAMPAIGN, F.col("match_key").alias("_key"))
        found = join(matches.filter(F.col("rule") == rule), side)
        return found.select(PERSON, CAMPAIGN, "load_date", "record_source")

    plain = lambda people, side: people.join(side, F.col("match_key") == F.col("_key"))
    spread_out = lambda people, side: spread_join(people, side, {"match_key": "_key"}, spread)
    named = earliest_row(pairs(2, plain), [PERSON, CAMPAIGN], ["load_date", "record_source"])
    links = pairs(1, plain).unionByName(named).unionByName(pairs(3, spread_out))
    keyed = links.select(hash_key(PERSON, CAMPAIGN).alias(PERSON_CAMPAIGN), *links.columns)
    return new_keys(keyed, target, PERSON_CAMPAIGN)


def link_person_campaign(contacts: DataFrame, ads: DataFrame, search: DataFrame,
                         target: DataFrame | None = None, spread: int | None = None) -> DataFrame:
    """New person-campaign links: by campaign id, else by name, else by source platform."""
    keys = campaign_match_keys(ads, search)
    fresh = newer_than(contacts, target, "load_date")
    return expand_matches(person_campaign_matches(fresh, keys), keys, target, spread)


def person_details(leads: DataFrame, contacts: DataFrame) -> DataFrame:
    """Leads and contacts as one feed of person attributes with identity and change hash."""
    diff = lambda name, source_id: hash_diff(name, "email", "telefone", "origem", source_id)
    from_leads = lead_person(leads).select(
        PERSON, "load_date", diff("nome", "lead_id").alias("hash_diff"), "nome", "email", "telefone", "origem",
        F.lit(ADS).alias("cliente_origem"), "lead_id", "campaign_id",
        F.col("created_timestamp").alias("created_time"), "record_source")
    from_contacts = contact_person(contacts).select(
        PERSON, "load_date", diff("nome_completo", "contact_id").alias("hash_diff"),
        F.col("nome_completo").alias("nome"), "email", "telefone", "origem",
        F.lit(CRM).alias("cliente_origem"), F.col("contact_id").alias("lead_id"),
        F.col("origem_lead").alias("campaign_id"), F.col("created_timestamp").alias("created_time"), "record_source")
    return from_leads.unionByName(from_contacts)


def with_completeness(details: DataFrame) -> DataFrame:
    """Clean attributes, 0/1 flags, and the completeness score 0-3."""
    has_name = flag(strip("nome") != "")
    has_email = flag((strip("email") != "") & F.col("email").contains("@"))
    has_phone = flag(F.length(strip("telefone")) >= 8)
    return details.withColumns({
        "has_nome": flag01(has_name), "has_valid_email": flag01(has_email), "has_valid_telefone": flag01(has_phone),
        "completude_score": score(has_name, has_email, has_phone),
        "nome": F.coalesce(strip("nome"), F.lit("")),
        "email": F.coalesce(F.lower(strip("email")), F.lit("")),
        "telefone": F.coalesce(strip("telefone"), F.lit("")),
    })


def person_batch(leads: DataFrame, contacts: DataFrame) -> DataFrame:
    """What a batch of staged rows says about people, as rows of the satellite."""
    return with_completeness(person_details(leads, contacts))


def sat_person(leads: DataFrame, contacts: DataFrame, target: DataFrame | None = None,
               mode: str = "consecutive") -> DataFrame:
    """Person satellite after a batch: versioned attributes with flags and score."""
    batch = person_batch(leads, contacts)
    return load_satellite(batch, PERSON, "load_date", "hash_diff", target, mode=mode)

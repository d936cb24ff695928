"""Histories, loads and matches against brute force, also where one key holds a third of all rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.inputs import frame, table
from checks.staging import staged_ads, staged_contacts, staged_leads, staged_search
from leadvault.operators import vault as dv
from leadvault.operators import windows as W
from leadvault.operators.joins import spread_join
from leadvault.plans import staging as S
from leadvault.plans import vault as V


def random_rows(seed, n=600, hashes=3):
    """(key, day, hash): a third of the rows belong to one key; equal days and copies occur."""
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.34 else f"k{rnd.randrange(60)}", f"2024-01-{rnd.randrange(1, 20):02d}",
             f"h{rnd.randrange(hashes)}") for _ in range(n)]


def brute_history(rows, mode):
    """Sort each key's distinct rows, drop repeats, close each version with its successor."""
    out = []
    by_key = defaultdict(set)
    for key, day, diff in rows:
        by_key[key].add((day, diff))
    for key, versions in by_key.items():
        kept, seen = [], set()
        for day, diff in sorted(versions):
            repeat = diff in seen if mode == "first_seen" else kept and kept[-1][1] == diff
            if not repeat:
                kept.append((day, diff))
            seen.add(diff)
        for i, (day, diff) in enumerate(kept):
            out.append((key, day, diff, kept[i + 1][0] if i + 1 < len(kept) else None))
    return sorted(out, key=str)


def history(df):
    return sorted([tuple(r) for r in df.select("key", "day", "diff", "load_end_date").collect()], key=str)


@pytest.mark.parametrize("mode", ["consecutive", "first_seen"])
@pytest.mark.parametrize("hashes", [2, 6])
def test_version_history(spark, mode, hashes):
    rows = random_rows(hashes, hashes=hashes)
    df = spark.createDataFrame(rows, "key string, day string, diff string").withColumn("note", F.lit("n"))
    assert history(dv.version_history(df, "key", "day", "diff", mode=mode)) == brute_history(rows, mode)


def test_satellite_in_batches_equals_one_load(spark):
    rows = random_rows(5)
    frame = lambda part: spark.createDataFrame(part, "key string, day string, diff string")
    target = None
    for lo, hi in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-02-01")):
        target = dv.load_satellite(frame([r for r in rows if lo <= r[1] < hi]), "key", "day", "diff", target)
    assert history(target) == brute_history(rows, "consecutive")
    again = dv.load_satellite(frame([r for r in rows if r[1] >= "2024-01-15"]), "key", "day", "diff", target)
    assert history(again) == brute_history(rows, "consecutive")
    open_versions = target.filter("load_end_date is null").groupBy("key").count()
    assert open_versions.filter("count <> 1").count() == 0
    assert open_versions.count() == len({r[0] for r in rows})


@pytest.mark.parametrize("following", [False, True])
def test_neighbours(spark, following):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.34 else f"k{rnd.randrange(40)}", rnd.randrange(200), i,
             rnd.choice([None, "a", "b"])) for i in range(500)]
    df = spark.createDataFrame(rows, "key string, at int, id int, value string")
    got = W.with_neighbour(df, "key", ["at", "id"], "value", "near", following, F.floor(F.col("at") / 10))
    want = []
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[0]].append(r)
    for group in by_key.values():
        group.sort(key=lambda r: (r[1], r[2]))
        for i, r in enumerate(group):
            j = i + 1 if following else i - 1
            want.append((r[2], group[j][3] if 0 <= j < len(group) else None))
    assert sorted((r["id"], r["near"]) for r in got.collect()) == sorted(want)


def test_no_task_gets_a_whole_hot_key(spark):
    """Neighbours of a hot key are looked up in groups of one bucket, latest rows after a group limit."""
    df = spark.range(1000).selectExpr("id % 3 AS key", "id AS at")
    plan = W.with_neighbour(df, "key", ["at"], "at", "near", False, F.floor(F.col("at") / 10))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in text and "_bucket" in text
    latest = W.latest_of(df, "key", "at")._jdf.queryExecution().executedPlan().toString()
    assert latest.count("WindowGroupLimit") == 2 and "Partial" in latest


def test_spread_join_is_complete_and_spread(spark):
    big = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS key")
    side = spark.createDataFrame([("hot", 1), ("hot", 2), ("k7", 3)], "name string, c int")
    got = spread_join(big, side, {"key": "name"}, 16)
    want = big.join(side, big["key"] == side["name"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    slots = big.filter("key = 'hot'").withColumn("slot", F.pmod(F.xxhash64("id", "key"), F.lit(16)))
    assert slots.groupBy("slot").count().agg(F.max("count")).first()[0] < 2 * 1000 / 16


def test_skew_join_splits_the_mart_join(spark):
    """A campaign with a third of the leads is split by adaptive execution."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        leads = spark.range(0, 60000, 1, 8).selectExpr(
            "id", "CASE WHEN id % 3 = 0 THEN 'c0' ELSE concat('c', id % 997) END AS campaign", "md5(CAST(id AS STRING)) AS payload")
        campaigns = spark.range(997).selectExpr("concat('c', id) AS campaign", "id AS spend")
        joined = leads.join(campaigns, "campaign", "left")
        assert joined.filter("spend is null").count() == 0
        rows = joined.collect()
        assert len(rows) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hub_and_links(spark, sf):
    contacts, leads = staged_contacts(spark, sf), staged_leads(spark, sf)
    ads, search = staged_ads(spark, sf), staged_search(spark, sf)
    people = V.hub_person(contacts)
    assert people.count() == people.select(V.PERSON).distinct().count() > 0
    assert V.hub_person(contacts, people).count() == 0
    assert V.hub_person_multi(leads, contacts).join(people, V.PERSON, "right").filter(F.col(V.PERSON).isNull()).count() == 0

    campaigns = V.hub_campaign(ads, search)
    links = V.link_person_campaign(contacts, ads, search)
    assert links.count() == links.select(V.PERSON_CAMPAIGN).distinct().count() > 0
    assert links.join(people, V.PERSON, "left_anti").count() == 0
    assert links.join(campaigns, V.CAMPAIGN, "left_anti").count() == 0
    producers = V.link_person_producer(contacts)
    assert producers.join(V.hub_producer(contacts, "2024-01-01"), V.PRODUCER, "left_anti").count() == 0
    assert V.link_person_producer(contacts, producers).count() == 0


def test_match_rules_are_disjoint_by_person(spark, sf):
    keys = V.campaign_match_keys(staged_ads(spark, sf), staged_search(spark, sf))
    matches = V.person_campaign_matches(staged_contacts(spark, sf), keys)
    assert matches.groupBy(V.PERSON).agg(F.countDistinct("rule").alias("n")).filter("n > 1").count() == 0
    assert {r["rule"] for r in matches.select("rule").distinct().collect()} == {1, 2, 3}


def test_spread_does_not_change_links(spark, sf):
    contacts, ads, search = staged_contacts(spark, sf), staged_ads(spark, sf), staged_search(spark, sf)
    one, many = (V.link_person_campaign(contacts, ads, search, spread=s) for s in (1, 13))
    assert one.exceptAll(many).count() == 0 and one.count() == many.count()


def test_campaign_with_two_names_links_once(spark):
    contact = spark.createDataFrame(
        [("p1", "one@x.com", "spring", "news", "2024-01-01"), ("p1", "one@x.com", "SUMMER", "news", "2024-01-02")],
        "nome_completo string, email string, utm_campaign string, utm_source string, load_date string"
    ).withColumns({"telefone": F.lit(""), "record_source": F.lit("crm"), "load_date": F.to_date("load_date")})
    ads = spark.createDataFrame([("7", "Spring"), ("7", "Summer")], "campaign_id string, campaign_name string")
    links = V.link_person_campaign(contact, ads, ads.limit(0)).collect()
    assert [str(r["load_date"]) for r in links] == ["2024-01-01"]


def test_changelog_compares_values(spark):
    old = spark.createDataFrame([(1, None, "c"), (2, "a|b", "c"), (3, "x", "y")], "id int, p string, q string")
    new = spark.createDataFrame([(1, "", "c"), (2, "a", "b|c"), (3, "x", "y")], "id int, p string, q string")
    got = sorted((r["id"], r["change_type"]) for r in dv.changelog(old, new, "id").collect())
    assert got == [(1, "update_after"), (1, "update_before"), (2, "update_after"), (2, "update_before")]


def test_history_keeps_rows_without_load_date(spark):
    rows = spark.createDataFrame([("k", None, "a"), ("k", "2024-01-02", "b")], "key string, load_date string, diff string")
    got = sorted((r["diff"], r["load_end_date"]) for r in dv.version_history(rows, "key", "load_date", "diff").collect())
    assert got == [("a", "2024-01-02"), ("b", None)]


def test_changelog_of_nulls(spark):
    schema = "id int, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "z", 3)], schema)
    new = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (4, None, None)], schema)
    got = sorted(tuple(r) for r in dv.changelog(old, new, "id").collect())
    assert got == [("delete", 3, "z", 3), ("insert", 4, None, None), ("update_after", 2, "y", 2),
                   ("update_before", 2, None, 2)]


def test_malformed_times_and_numbers_become_null_and_keep_their_rows(spark):
    sf = "/root/testdata/sf0.001"
    contacts = frame(spark, sf, "contacts")
    broken = contacts.withColumn("cdate", F.when(F.col("id") == "1", F.lit("0000-00-00 00:00:00")).otherwise(F.col("cdate")))
    assert S.stg_contacts(broken, "2023-05-01").count() == S.stg_contacts(contacts, "2023-05-01").count()
    assert S.stg_contacts(broken, "2023-05-01").where("contact_id = '1' AND created_timestamp IS NOT NULL").count() == 0
    rows = frame(spark, sf, "search_rows").withColumns({"clicks": F.lit("n/a"), "date": F.lit("yesterday")})
    typed = S.stg_search_rows(rows)
    assert typed.where("clicks IS NULL AND campaign_date IS NULL").count() == rows.count()


def test_late_and_same_day_contacts_find_their_producer_link(spark):
    contacts = staged_contacts(spark, "/root/testdata/sf0.001")
    whole = {r[0] for r in V.link_person_producer(contacts).select(V.PERSON_PRODUCER).collect()}
    early = V.link_person_producer(contacts.where("load_date = DATE '2023-04-01'"))
    late = V.link_person_producer(contacts, early, False)
    first, then = ({r[0] for r in df.select(V.PERSON_PRODUCER).collect()} for df in (early, late))
    assert then and not first & then and first | then == whole


def test_matches_read_contacts_once(spark, sf):
    """The best rule per person needs no second pass over the contacts."""
    from checks import QUERIES
    plan = QUERIES["person_campaign_matches"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    customer = table(spark, sf, "customer").schema.names
    scans = [line for line in plan.splitlines() if "Relation [" in line and f"{customer[0]}#" in line]
    assert len(scans) == 1 and "WindowGroupLimit" in plan

"""Large models are loaded in parts: the same rows, and nothing but tables left on disk."""

import os

from pyspark.sql import functions as F

from checks.inputs import stored
from leadvault.operators.vault import satellite_history
from leadvault.plans import layers
from leadvault.plans.staging import search_campaigns_of
from leadvault.plans.vault import PERSON
from leadvault.session import scratch_dir, shuffles_given_back
from tests.test_loads import layer_inputs

ASIDE = ("batch-", "merged-", "gathered-")


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (blocks.apply(k).getName() for k in range(blocks.size()))
    return {name for name in names if name.startswith("shuffle_")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_parts_store_what_one_load_does(spark, sf, monkeypatch):
    """Two runs in parts, the second with late dates, end in what one run in one part gives. Shuffle files and what was
    written aside are gone."""
    inputs = {n: stored(df, n) for n, df in layer_inputs(spark, sf).items()}
    some = {n: df.filter("_load_date > '1996-01-01'") if n == "leads" else df.filter("_load_date <> '2023-02-20'") if n == "search_rows"
            else df for n, df in inputs.items()}
    roots = [scratch_dir(spark, name) for name in ("whole", "parts")]
    shared, shuffles = os.path.dirname(roots[0]), shuffle_files(spark)
    aside = {f for f in os.listdir(shared) if f.startswith(ASIDE)}
    whole = layers.run_layers(spark, inputs, roots[0], "2000-01-01")
    monkeypatch.setattr(layers, "PART_ROWS", 1500)
    monkeypatch.setattr(layers, "LARGE_ROWS", 2000)
    seen = []
    monkeypatch.setattr(layers.Run, "parts", lambda run, step, whole=False, parts=layers.Run.parts: (
        seen.append((step.name, len(found := parts(run, step, whole)))), found)[1])
    layers.run_layers(spark, some, roots[1], "2000-01-01", gold=False)
    parts = layers.run_layers(spark, inputs, roots[1], "2000-01-01")
    assert {f for f in os.listdir(shared) if f.startswith(ASIDE)} == aside and shuffle_files(spark) <= shuffles

    many = {name for name, n in seen if n > 1}
    assert many >= {"insight_rows", "search_current", "insight_days", "search_days", "stg_ad_campaigns", "stg_search_campaigns",
                    "sat_person", "campaign_metrics", "mart_leads"}
    counts = [{r["step"]: (r["status"], r["n_rows"]) for r in df.collect() if r["step"] != "load_dates"} for df in (whole, parts)]
    assert counts[0] == counts[1] and {status for status, _ in counts[0].values()} == {"success"}
    for model in ("staging/insight_rows", "staging/search_current", "staging/insight_days", "staging/search_days",
                  "staging/stg_ad_campaigns", "staging/stg_search_campaigns", "gold/campaign_metrics", "gold/mart_leads"):
        first = spark.read.parquet(f"{roots[0]}/{model}")
        assert rows_of(first) == rows_of(spark.read.parquet(f"{roots[1]}/{model}").select(first.columns)), model
    histories = [satellite_history(spark.read.parquet(f"{root}/silver/sat_person"), PERSON, "load_date", "hash_diff") for root in roots]
    assert rows_of(histories[0]) == rows_of(histories[1].select(histories[0].columns))


def test_shuffle_files_go_when_a_query_ends(spark, tmp_path):
    before = shuffle_files(spark)
    with shuffles_given_back(spark):
        spark.range(10_000).groupBy(F.col("id") % 100).count().write.parquet(str(tmp_path / "t"))
    assert shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_parts_deal_every_row_once(spark):
    """Also rows without a key or date; ranges of a hash and their numbers agree."""
    rows = spark.createDataFrame([(f"{k:08x}", f"2024-{1 + k % 12:02d}-01" if k % 5 else None) for k in range(0, 16 ** 8, 16 ** 8 // 997)],
                                 "k string, d string")
    for n in (1, 2, 3, 7, 16):
        runs = [layers.Run(spark, "", "", {}, part=(k, n)) for k in range(n)]
        ranged = [run.ranged(rows, "k") for run in runs]
        assert sum(df.count() for df in ranged) == rows.count()
        assert [[r[0] for r in df.select(layers._range_of("k", n)).distinct().collect()] for df in ranged] == [[k] for k in range(n)]
        for number in (layers._month_number("d"), layers._dealt("d")):
            assert sum(run.cut(rows, number).count() for run in runs) == rows.count()


def test_days_of_a_campaign_are_counted_without_a_second_shuffle(spark):
    days = spark.createDataFrame(
        [("c", "1", "n", d, 5, 1, 10) for d in ("2024-01-01", "2024-01-02", None)],
        "customer_id string, campaign_id string, campaign_name string, d string, impressions long, clicks long, cost_micros long")
    days = days.select("*", F.to_date("d").alias("campaign_date"), F.lit(1).cast("decimal(10,2)").alias("conversions"),
                       F.lit(1).cast("decimal(10,2)").alias("conversion_value"), F.lit(None).cast("timestamp_ntz").alias("extraction_timestamp"),
                       F.lit(None).cast("date").alias("load_date"))
    found = search_campaigns_of(days)
    assert found.first()["days_active"] == 2
    assert found._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") <= 2

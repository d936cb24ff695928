"""All layers in order, as one Spark application that loads what is new since the run before.

A run reads the load dates of the sources that its marks don't hold, or hold with another number of rows, whichever
dates these are: late ones too. Staging replaces those date partitions. Insights and search rows are merged into
monthly partitions, and campaign days recomputed for the months they touch. Hubs, links and offers are appended to, and so is
the satellite: ends of versions are worked out on reading. Gold tables are rebuilt from stored tables.

Large models are loaded in parts, one after the other, and a query's shuffle files go when it ends: what a run needs on
disk besides its tables is the shuffle of one part."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field, replace
from threading import Lock
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.operators.aggregates import earliest_row, first_seen
from leadvault.operators.quality import accepted, dq_report, not_null, store_failing_rows, unique
from leadvault.operators.vault import earlier_rows, new_versions, satellite_history
from leadvault.plans import campaigns as C
from leadvault.plans import marts as M
from leadvault.plans import staging as S
from leadvault.plans import vault as V
from leadvault.session import remove_folder, scratch_dir, shuffles_given_back
from leadvault.sources import partitions as P
from leadvault.sources.reads import load_seed
from leadvault.sources.schemas import AD_INSIGHTS, SEARCH_CAMPAIGNS
from leadvault.sources.writes import write_table

STATUS_SCHEMA = "layer string, step string, status string, error string, n_rows bigint, seconds double"
MARKS_SCHEMA = "run bigint, source string, load_date string, n_rows bigint"

#: Append logs by load date; every other input is a small table that is read whole.
LOGS = ("contacts", "leads", "ad_campaigns", "insights", "search_rows")

#: Rows of the logs that a part of a load is about, and the most parts there are: each reads its model's sources once more,
#: or a range of a key by which they are sorted.
PART_ROWS = 1_000_000
MOST_PARTS, MOST_RANGES = 8, 16
#: Loads about more rows than this fill a cluster and run one at a time.
LARGE_ROWS = 4 * PART_ROWS


@dataclass
class Run:
    """What a step sees: the inputs, the models stored so far, and of both the rows of this run's window."""

    spark: SparkSession
    root: str
    as_of: str
    tables: dict
    window: dict = field(default_factory=dict)  # source -> its load dates in the window
    loaded: dict = field(default_factory=dict)  # source -> load dates of earlier runs
    touched: dict = field(default_factory=dict)  # model -> partitions this run replaced
    rows: dict = field(default_factory=dict)  # source -> its load dates and the rows they have
    part: tuple = (0, 1)  # the part of a model at hand, and how many there are
    large: Lock = field(default_factory=Lock)  # held by the large load that runs
    gathered: DataFrame | None = None  # rows that a step gathered for its parts

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def new(self, source: str) -> DataFrame:
        """Rows of a source that this run loads; the dates are literals, so only their partitions are read."""
        return self[source].filter(P.within("_load_date", self.window[source]))

    def dates(self, *sources: str) -> list:
        return sorted({str(d)[:10] for s in sources for d in self.window[s]})

    def staged(self, model: str, source: str) -> DataFrame:
        """Staged rows of the window."""
        return self[model].filter(F.col("load_date").isin([_day(d) for d in self.dates(source)]))

    def fresh(self, model: str) -> DataFrame:
        """Rows of the months of a model that this run replaced; of these, the part at hand."""
        return self.cut(self[model].filter(P.within("month", self.touched[model])), _month_number("month"))

    def cut(self, df: DataFrame, number: Column) -> DataFrame:
        """Rows of the part at hand: parts are dealt by a whole number, of which NULL is 0."""
        k, n = self.part
        return df if n == 1 else df.filter(F.coalesce(F.pmod(number, F.lit(n)), F.lit(0)) == k)

    def ranged(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of the part at hand, a range of a hash key: where rows are sorted by it, only their pages are read."""
        k, n = self.part
        bound = lambda k: F.lit(f"{-(-k * _PREFIXES // n):04x}")
        df = df.filter(F.col(key) >= bound(k)) if k else df
        return df.filter(F.col(key) < bound(k + 1)) if k < n - 1 else df

    def weight(self, step: Step, whole: bool = False) -> int:
        """Rows that a load is about: those of its logs, since the window's first date where it loads the window only."""
        logs = step.cut or step.logs
        since = "" if whole or step.load in ("rebuild", "days") else min(self.dates(*logs), default="")
        return sum(n for log in logs for day, n in self.rows[log].items() if day[:10] >= since)

    def parts(self, step: Step, whole: bool = False) -> list[Run]:
        """This run once per part of what it loads of a model, or of the whole model."""
        n = min(step.most, -(-self.weight(step, whole) // PART_ROWS)) if step.cut else 1
        if step.of is not None:  # parts are months
            n = min(n, len(self.touched[step.of]))
        return [replace(self, part=(k, max(n, 1))) for k in range(max(n, 1))]

    def turn(self, rows: int):
        """Small loads share the cluster, of the large ones, which fill it, one runs at a time."""
        return self.large if rows > LARGE_ROWS else nullcontext()


def _day(text: str):
    return F.lit(text).cast("date")


def _month_number(date: str) -> Column:
    day = F.col(date).try_cast("date")
    return F.year(day) * 12 + F.month(day)


def _dealt(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


_PREFIXES = 16 ** 4


def _range_of(key: str, n: int) -> Column:
    """The range (of ``n``) that a hash key lies in, by its first four hex digits."""
    return F.floor(F.conv(F.substring(key, 1, 4), 16, 10).cast("bigint") * n / _PREFIXES).cast("int")


@dataclass(frozen=True)
class Step:
    """One stored model.

    ``load`` says how the result of ``build`` is stored: ``rebuild`` replaces the table, ``append`` adds the rows,
    ``dates`` replaces the window's partitions, ``merge`` and ``days`` replace the partitions (``by``) that the rows
    touch, by key or as they are. ``read`` turns what is stored into what later steps see. A model that rests on ``logs`` only
    stays as it is in a run whose window has no date of them. With ``cut``, ``build`` gives the part of the model that its run
    has at hand, and the rows of the logs in ``cut`` tell how many parts there are: ``most`` at most, and no more than months of
    the model ``of`` were replaced, where those are dealt. Rows that ``gather`` finds are computed once and kept aside by
    range of their key, the first of ``sort_by``, for ``build`` to find those of its part."""

    layer: str
    name: str
    build: Callable[[Run, DataFrame | None], DataFrame]
    options: str = "mart"
    load: str = "rebuild"
    sort_by: tuple = ()
    by: str | None = None
    logs: tuple = ()
    keys: tuple = ()
    order: tuple = ()
    read: Callable[[DataFrame], DataFrame] | None = None
    cut: tuple = ()
    most: int = MOST_PARTS
    of: str | None = None
    gather: Callable[[Run], DataFrame] | None = None


# A failure in these layers ends the run; elsewhere it is recorded and the run goes on.
CRITICAL = ("window", "staging", "silver")

#: Models that are loaded at the same time, where they don't rest on each other.
AT_ONCE = 8

BOOLEANS = (True, False)


def staging_tests() -> dict:
    """Declared column tests of the staging models."""
    return {
        "stg_contacts": [*not_null("contact_id", "email", "origem", "qualidade_lead", "has_contact_info"),
                         *unique("contact_id"), *accepted("origem", S.CRM),
                         *accepted("qualidade_lead", "Completo", "Parcial", "Mínimo", "Incompleto"),
                         *accepted("has_contact_info", *BOOLEANS)],
        "stg_leads": [*not_null("lead_id", "email", "origem", "has_contact_info", "has_valid_email"),
                      *unique("lead_id"), *accepted("origem", S.ADS), *accepted("has_contact_info", *BOOLEANS),
                      *accepted("has_valid_email", *BOOLEANS)],
        "stg_search_rows": [*not_null("customer_id", "campaign_id", "campaign_date", "impressions", "clicks",
                                      "cost_brl", "origem", "has_activity"),
                            *accepted("origem", S.SEARCH), *accepted("has_activity", *BOOLEANS)],
    }


def source_tests() -> dict:
    """Declared column tests of the raw sources."""
    audit = ("_extraction_timestamp", "_source_system")
    return {
        "leads": [*not_null("id", "created_time", "_load_date", *audit), *unique("id"),
                  *accepted("_source_system", S.ADS)],
        "search_rows": [*not_null("customer_id", "campaign_id", "date", *audit),
                        *accepted("_source_system", S.SEARCH)],
        "contacts": [*not_null("id", "email", "cdate", *audit), *unique("id"), *accepted("_source_system", S.CRM)],
    }


def _is_late(run: Run) -> bool:
    """Whether later dates of leads or contacts were loaded before the window's first."""
    dates = run.dates("leads", "contacts")
    return bool(dates) and any(day > dates[0] for source in ("leads", "contacts") for day in run.loaded[source])


def _person_rows(run: Run) -> DataFrame:
    """Staged rows of the window about people; a late window's with everything staged since its first date, of which ``_new``
    tells the rows of the window."""
    if not _is_late(run):
        return V.person_batch(run.staged("stg_leads", "leads"), run.staged("stg_contacts", "contacts"))
    since = F.col("load_date") >= _day(run.dates("leads", "contacts")[0])
    rows = V.person_batch(run["stg_leads"].filter(since), run["stg_contacts"].filter(since))
    of = lambda feed, source: (F.col("cliente_origem") == feed) & F.col("load_date").isin([_day(d) for d in run.dates(source)])
    return rows.withColumn("_new", of(S.ADS, "leads") | of(S.CRM, "contacts"))


def _bearing(run: Run) -> DataFrame:
    """Of the rows gathered those that bear on the satellite: the window's, and of their people all of the later ones, because
    a late row decides what later rows change."""
    rows = run.gathered
    if not _is_late(run):
        return rows
    return rows.join(rows.filter("_new").select(V.PERSON).distinct(), V.PERSON, "left_semi").drop("_new")


def _by_month(df: DataFrame, date: str) -> DataFrame:
    """Rows that are read again for some weeks lie in monthly partitions: a load replaces one or two of them."""
    return df.withColumn("month", F.trunc(F.col(date).try_cast("date"), "month"))


_SEEN = ("load_date", "record_source")
_OFFER = (V.PERSON, "rule", "match_key")
DASHBOARD = ("leads_by_origin", "leads_by_day", "leads_by_quality", "platform_performance", "leads_by_client",
             "completeness_funnel", "cost_per_lead", "lead_heatmap")


def steps(dashboard_days: int | None = 30) -> list[list[Step]]:
    """The models in dependency order; those of one list do not rest on each other."""
    def dashboard(name):
        return Step("gold", name, lambda r, old: M.dashboard(r["mart_leads"], r.as_of, dashboard_days)[name])

    def first_sighting(keys, order):
        return lambda df: earliest_row(df, keys, order, [c for c in df.columns if c not in (*keys, *order)]).select(df.columns)

    def appended(name, build, options, keys, order=_SEEN, read=None, logs=()):
        """An insert-only table: of the batch's rows those it lacks, or has with a later sighting only."""
        return Step("silver", name, lambda r, old: earlier_rows(build(r), old, keys, order), options, "append",
                    sort_by=tuple(keys), read=read or first_sighting(keys, order), logs=logs)

    contacts = lambda r: r.staged("stg_contacts", "contacts")
    leads = lambda r: r.staged("stg_leads", "leads")
    return [
        [
            Step("staging", "stg_contacts", lambda r, old: S.stg_contacts(r.new("contacts"), r.as_of), "bronze", "dates",
                 by="load_date", logs=("contacts",)),
            Step("staging", "stg_leads", lambda r, old: S.stg_leads(r.new("leads")), "bronze", "dates", by="load_date",
                 logs=("leads",)),
            Step("staging", "stg_search_rows", lambda r, old: S.stg_search_rows(r.new("search_rows")), "bronze", "dates",
                 by="load_date", logs=("search_rows",)),
            Step("staging", "ad_campaign_rows", lambda r, old: S.current_campaigns(r.new("ad_campaigns")), "bronze", "merge",
                 keys=("id",), order=tuple(S.CAMPAIGN_ORDER), logs=("ad_campaigns",)),
            Step("staging", "insight_rows", lambda r, old: _by_month(S.current_insights(
                r.cut(r.new("insights"), _month_number("date_start"))), "date_start"),
                "bronze", "merge", by="month", keys=AD_INSIGHTS.key, order=tuple(S.LOAD_ORDER), logs=("insights",), cut=("insights",)),
            Step("staging", "search_current", lambda r, old: _by_month(S.current_search_rows(
                r.cut(r.new("search_rows"), _month_number("date"))), "date"),
                "bronze", "merge", by="month", keys=SEARCH_CAMPAIGNS.key, order=tuple(S.LOAD_ORDER), logs=("search_rows",),
                cut=("search_rows",)),
        ],
        [
            Step("staging", "insight_days", lambda r, old: _by_month(S.insight_days(r.fresh("insight_rows")), "date_start"),
                 "bronze", "days", by="month", logs=("insights",), cut=("insights",), of="insight_rows"),
            Step("staging", "search_days", lambda r, old: _by_month(
                S.search_days(S.stg_search_rows(r.fresh("search_current"))), "campaign_date"), "bronze", "days", by="month",
                logs=("search_rows",), cut=("search_rows",), of="search_current"),
        ],
        [
            Step("staging", "stg_ad_campaigns", lambda r, old: S.ad_campaigns_of(
                r.cut(r["ad_campaign_rows"], _dealt("id")), r.cut(r["insight_days"], _dealt("campaign_id"))),
                "bronze", logs=("ad_campaigns", "insights"), cut=("ad_campaigns", "insights")),
            Step("staging", "stg_search_campaigns", lambda r, old: S.search_campaigns_of(r.cut(r["search_days"], _dealt("campaign_id"))),
                 "bronze", logs=("search_rows",), cut=("search_rows",)),
        ],
        [
            appended("hub_person", lambda r: V.hub_person_multi(leads(r), contacts(r), None, False), "hub", (V.PERSON,),
                     logs=("contacts", "leads"), read=lambda df: first_seen(df, V.PERSON)),
            appended("hub_campaign", lambda r: V.hub_campaign(r["stg_ad_campaigns"], r["stg_search_campaigns"], None, False),
                     "hub", (V.CAMPAIGN,), logs=("ad_campaigns", "insights", "search_rows")),
            Step("silver", "hub_producer", lambda r, old: V.hub_producer(contacts(r), r.as_of, old),
                 "hub", "append", sort_by=(V.PRODUCER,), logs=("contacts",)),
            appended("link_person_producer", lambda r: V.link_person_producer(contacts(r), None, False),
                     "link", (V.PERSON_PRODUCER,), logs=("contacts",)),
            Step("silver", "campaign_match_keys",
                 lambda r, old: V.campaign_match_keys(r["stg_ad_campaigns"], r["stg_search_campaigns"]), "link",
                 logs=("ad_campaigns", "insights", "search_rows")),
            appended("contact_offers", lambda r: V.contact_offers(contacts(r)), "link", _OFFER, logs=("contacts",)),
            Step("silver", "sat_person", lambda r, old: new_versions(
                _bearing(r), None if old is None else r.ranged(old, V.PERSON), V.PERSON, "load_date", "hash_diff"),
                "satellite", "append", sort_by=(V.PERSON, "load_date"), logs=("contacts", "leads"),
                read=lambda df: satellite_history(df, V.PERSON, "load_date", "hash_diff"), cut=("contacts", "leads"),
                most=MOST_RANGES, gather=_person_rows),
        ],
        [Step("silver", "campaign_offers", lambda r, old: V.known_offers(r["contact_offers"], r["campaign_match_keys"]), "link")],
        [Step("silver", "person_campaign_matches", lambda r, old: V.best_matches(r["campaign_offers"]), "link",
              sort_by=(V.PERSON,))],
        [Step("gold", "campaign_metrics", lambda r, old: C.metrics_of(
            *[r.cut(r[days], _dealt("campaign_id")) for days in ("insight_days", "search_days")]), cut=("insights", "search_rows"))],
        [Step("gold", "campaigns", lambda r, old: C.campaigns_unified(r["ads_dim"], r["search_dim"], r["campaign_metrics"], r.as_of))],
        [Step("gold", "mart_leads", lambda r, old: M.mart_leads(
            *[r.ranged(r[model], V.PERSON) for model in ("hub_person", "sat_person")], r["campaigns"], r.as_of),
            sort_by=("lead_key",), cut=("contacts", "leads"), most=MOST_RANGES)],
        [*map(dashboard, DASHBOARD)],
    ]


def window(spark: SparkSession, logs: dict, root: str) -> tuple[dict, dict, dict, DataFrame]:
    """Per log the load dates that are new, or have another number of rows than when they were loaded; the dates
    loaded before; all dates with their rows; and the marks to keep once the new ones are. No data column is read: row counts come from file footers, dates from partitions
    (or from that one column)."""
    marks = P.stored_or_none(spark, f"{root}/marks", MARKS_SCHEMA)
    known = {} if marks is None else {
        (r["source"], r["load_date"]): r["n_rows"]
        for r in marks.groupBy("source", "load_date").agg(F.max_by("n_rows", "run").alias("n_rows")).collect()}
    run = 1 if marks is None else marks.agg(F.max("run")).first()[0] + 1
    dates, counts, rows = {}, {}, []
    for name, df in logs.items():
        dates[name], counts[name] = [], {}
        for day, count, valid in df.filter("_load_date IS NOT NULL").groupBy("_load_date").agg(
                F.count(F.lit(1)), F.first(F.col("_load_date").try_cast("date")).isNotNull()).collect():
            if not valid:
                raise ValueError(f"{name} has the load date {day!r}, which is none")
            counts[name][str(day)] = count
            if known.get((name, str(day))) != count:
                dates[name].append(day)
                rows.append((run, name, str(day), count))
    loaded = {name: [day for source, day in known if source == name] for name in logs}
    return dates, loaded, counts, spark.createDataFrame(rows, MARKS_SCHEMA)


def _gathered(run: Run, step: Step, path: str) -> list[Run]:
    """The parts of a step, each with its range of the rows that the step gathers, which are kept at ``path``."""
    parts = run.parts(step)
    rows = step.gather(run)
    rows = rows.withColumn("_range", _range_of(step.sort_by[0], len(parts)))
    rows.write.partitionBy("_range").parquet(path)
    kept = run.spark.read.schema(rows.schema).parquet(path)
    return [replace(part, gathered=kept.filter(F.col("_range") == part.part[0]).drop("_range")) for part in parts]


def load_step(run: Run, step: Step) -> DataFrame:
    """Build one model, store it, and return it read back."""
    spark, path = run.spark, f"{run.root}/{step.layer}/{step.name}"
    old = P.stored_or_none(spark, path)
    if old is not None and step.logs and not run.dates(*step.logs):
        run.touched[step.name] = []
        return old if step.read is None else step.read(old)
    touched, aside = [], scratch_dir(spark, "gathered")
    for k, part in enumerate(run.parts(step) if step.gather is None else _gathered(run, step, aside)):
        df = step.build(part, old)
        if step.load in ("rebuild", "append"):
            try:
                write_table(df, path, sort_by=step.sort_by, distribute_by=step.sort_by[:1], layer=step.options,
                            mode="append" if step.load == "append" or k else "overwrite")
            except Exception:
                if step.load == "rebuild" and k:  # no table rather than some parts of it
                    remove_folder(spark, path)
                raise
        elif step.load == "merge":
            touched += P.merge_partitions(spark, df, path, step.keys, step.order, step.by, mode="newest", layer=step.options)
            run.touched[step.name] = touched
        else:
            P.replace_partitions(df, path, step.by, layer=step.options)
            if step.load == "dates" and old is not None:  # a date that was loaded again and has no row now
                some = old.filter(F.col(step.by).isin([_day(d) for d in run.dates(*step.logs)]))
                gone = set(P.partition_values(some, step.by)) - set(P.partition_values(df, step.by))
                P.drop_partitions(spark, path, step.by, sorted(gone))
    if step.gather is not None:
        remove_folder(spark, aside)
    result = P.stored_or_none(spark, path)
    if result is None:  # nothing was ever written
        result = spark.createDataFrame([], df.schema)
    return result if step.read is None else step.read(result)


def run_layers(spark: SparkSession, inputs: dict, root: str, as_of: str, extra_steps=(), dashboard_days: int | None = 30,
               seeds: dict | None = None, gold: bool = True) -> DataFrame:
    """Load every layer below ``root`` and return one status row per step, with the rows its model has.

    ``inputs`` maps names to frames; of the logs (``LOGS``) a run loads only the load dates that are new or have changed
    since the runs before, in whatever order dates arrive: runs over parts end in what one run over all gives. Dates are kept in
    ``marks`` once the layers that must not fail are loaded, so a run that died loads its window again; every load can be
    repeated. ``seeds`` maps names to (CSV path, schema). Without ``gold`` a run ends with the silver layer, as for
    loads that come more often than the dashboard is read.

    Each model is written as a table and read back, so a later step starts from files instead of recomputing what
    came before, and a lost executor costs only its own tasks. Models that do not rest on each other are loaded at the same
    time.

    The full person-campaign link is left to its readers (``vault.expand_matches`` over the stored tables), since it can
    be far larger than all its inputs."""
    run, status, marks = Run(spark, root, as_of, dict(inputs)), [], None

    def attempt(layer: str, name: str, work: Callable[[], int]) -> tuple:
        began, error, rows = time.monotonic(), None, None
        try:
            rows = work()
        except Exception as failure:  # recorded per step, raised for the layers others rest on
            if layer in CRITICAL:
                raise
            error = str(failure).strip().splitlines()[0][:500]
        return layer, name, "failed" if error else "success", error, rows, round(time.monotonic() - began, 3)

    def open_window() -> int:
        nonlocal marks
        run.window, run.loaded, run.rows, marks = window(spark, {name: run[name] for name in LOGS}, root)
        return sum(map(len, run.window.values()))

    def load(step: Step) -> int:
        with run.turn(run.weight(step)):
            run.tables[step.name] = found = load_step(run, step)
            if step.read is None or not step.cut:
                return found.count()
            return sum(part.ranged(found, step.sort_by[0]).count() for part in run.parts(step, whole=True))

    def seed(name: str) -> int:
        write_table(load_seed(spark, *seeds[name]), f"{root}/seeds/{name}", layer="seed")
        run.tables[name] = spark.read.parquet(f"{root}/seeds/{name}")
        return run.tables[name].count()

    def declared() -> dict:
        return {name: (run[name], tests) for name, tests in {**source_tests(), **staging_tests()}.items()}

    def report() -> int:
        with run.turn(sum(sum(days.values()) for days in run.rows.values())):
            write_table(dq_report(declared()), f"{root}/test_failures/report", layer="seed")
        return spark.read.parquet(f"{root}/test_failures/report").count()

    def failing() -> int:
        with run.turn(sum(sum(days.values()) for days in run.rows.values())):
            return sum(store_failing_rows(df, tests, f"{root}/test_failures/rows/{name}") for name, (df, tests) in declared().items())

    kept = False
    with shuffles_given_back(spark), ThreadPoolExecutor(AT_ONCE) as pool:  # small tables leave most of a cluster idle
        status.append(attempt("window", "load_dates", open_window))
        status += pool.map(lambda name: attempt("seeds", name, lambda: seed(name)), seeds or {})
        for wave in [*steps(dashboard_days), *[[step] for step in extra_steps]]:
            if wave[0].layer not in CRITICAL:
                if not gold:
                    continue
                if not kept:
                    marks.write.mode("append").parquet(f"{root}/marks")
                    kept = True
            status += pool.map(lambda step: attempt(step.layer, step.name, lambda: load(step)), wave)
        if not kept:
            marks.write.mode("append").parquet(f"{root}/marks")
        if gold:
            status += pool.map(lambda test: attempt("test", *test), (("dq_report", report), ("failing_rows", failing)))
    return spark.createDataFrame(status, STATUS_SCHEMA)

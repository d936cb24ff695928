"""Files on disk: layouts, pushdown, versions, incremental runs."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.inputs import frame, stored, table
from checks.staging import insights_log, search_log
from leadvault.operators import maintenance as M
from leadvault.operators import quality as Q
from leadvault.operators import vault as dv
from leadvault.operators import windows as W
from leadvault.streaming import loads as ST
from leadvault.operators.incremental import lookback_replace, merge_upsert, newer_than
from leadvault.plans import layers
from leadvault.session import scratch_dir
from leadvault.sources import catalog, reads, schemas, snapshots, writes
from leadvault.sources import partitions as P
from leadvault.sources.reads import list_files
from leadvault.sources.versions import current, load_log, publish


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_the_date(spark, sf):
    df = reads.scan_bronze(spark, f"{sf}/orders.parquet", None, "1998-01-01", "o_orderdate").select("o_orderkey")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_dated_folders_and_partition_pruning(spark, sf):
    out = scratch_dir(spark, "raw")
    writes.append_raw(table(spark, sf, "customer"), out, "2024-03-05")
    assert os.path.isdir(f"{out}/year=2024/month=3/day=5")
    assert all(f.endswith((".gz.parquet", ".crc")) for f in os.listdir(f"{out}/year=2024/month=3/day=5"))
    plan = plan_of(spark.read.parquet(out).filter("day = 5"))
    assert "PartitionFilters: [isnotnull(day" in plan


def test_bucketed_join_needs_no_shuffle(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
            writes.write_bucketed(table(spark, sf, name), f"b_{name}", 10, key, scratch_dir(spark, name))
        joined = spark.table("b_orders").join(spark.table("b_customer"), F.expr("o_custkey = c_custkey"))
        assert "Exchange" not in plan_of(joined.groupBy("o_custkey").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("orders", "customer"):
            spark.sql(f"DROP TABLE IF EXISTS b_{name}")


def test_sorted_files(spark, sf):
    src, dst = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    table(spark, sf, "orders").select("o_custkey", "o_orderkey").repartition(6).write.parquet(src)
    out = M.rewrite_sorted(spark, src, dst, ["o_custkey", "o_orderkey"])
    numbered = out.withColumn("_at", F.monotonically_increasing_id())
    keys = [(r[0], r[1]) for r in numbered.orderBy("_at").select("o_custkey", "o_orderkey").collect()]
    assert keys == sorted(keys)


def test_compaction_leaves_one_file(spark, sf):
    src, dst = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    table(spark, sf, "orders").repartition(12).write.parquet(src)
    M.compact(spark, src, dst)
    assert reads.list_files(spark, src).count() == 12 and reads.list_files(spark, dst).count() == 1
    health = M.file_health(spark, src).first()
    assert health["total_files"] == health["small_files_count"] == 12 and health["large_files_count"] == 0


def test_versions_survive_a_half_written_one(spark, sf):
    root = scratch_dir(spark, "v")
    assert current(spark, root) is None
    orders = table(spark, sf, "orders").select("o_orderkey")
    publish(orders.filter("o_orderkey < 10"), root, "2024-01-01")
    orders.write.parquet(f"{root}/version=2")  # a job that died before its log entry
    assert current(spark, root).agg(F.max("o_orderkey")).first()[0] < 10
    publish(orders.filter("o_orderkey < 20"), root, "2024-01-02")
    assert 10 <= current(spark, root).agg(F.max("o_orderkey")).first()[0] < 20
    assert load_log(spark, root).count() == 2


def test_newer_than(spark):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], "id int, d string")
    assert newer_than(rows, None, "d").count() == 3
    assert newer_than(rows, rows.limit(0), "d").count() == 3
    assert [r["id"] for r in newer_than(rows, rows.filter("id = 2"), "d").collect()] == [3]


def test_merge_reduces_repeated_source_rows(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "keep", 1)], "id int, v string, at int")
    batch = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (3, "c", 2)], "id int, v string, at int")
    merged = sorted(tuple(r) for r in merge_upsert(target, batch, "id", ["at"]).collect())
    assert merged == [(1, "b", 3), (2, "keep", 1), (3, "c", 2)]
    assert sorted(r["v"] for r in merge_upsert(target, batch, "id", ["at"], update=False).collect()) == ["c", "keep", "old"]
    once = merge_upsert(target, batch, "id", ["at"])
    twice = merge_upsert(once, batch, "id", ["at"])
    assert once.exceptAll(twice).count() == 0 and once.count() == twice.count()


def test_lookback_keeps_what_was_not_reread(spark):
    rows = [(1, "2024-01-01", "a"), (2, "2024-01-20", "a"), (3, "2024-01-20", "a")]
    target = spark.createDataFrame(rows, "id int, d string, v string").withColumn("d", F.to_date("d"))
    new = spark.createDataFrame([(1, "2024-01-01", "b"), (2, "2024-01-20", "b")], "id int, d string, v string"
                                ).withColumn("d", F.to_date("d"))
    got = {r["id"]: r["v"] for r in lookback_replace(target, new, "d", 28, "id", "2024-01-31").collect()}
    assert got == {1: "a", 2: "b", 3: "a"}


def test_lookback_keeps_undated_rows(spark):
    target = spark.createDataFrame([(1, None, "a"), (2, None, "a")], "id int, d date, v string")
    new = spark.createDataFrame([(2, None, "b"), (2, None, "b")], "id int, d date, v string")
    got = sorted((r["id"], r["v"]) for r in lookback_replace(target, new, "d", 28, "id", "2024-01-31").collect())
    assert got == [(1, "a"), (2, "b")]


def test_compaction_with_predicate_keeps_every_row(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, s string").repartition(3).write.parquet(src)
    assert sorted(r["id"] for r in M.compact(spark, src, dst, "s = 'x'").collect()) == [1, 2, 3]


def test_fold_keeps_later_batches(spark, tmp_path):
    root, dst = str(tmp_path / "root"), str(tmp_path / "dst")
    for batch, rows in enumerate([[(1, 1)], [(2, 1), (1, 2)], [(3, 1), (2, 5)]]):
        spark.createDataFrame(rows, "k int, v int").write.parquet(f"{root}/batch={batch}")
    schema = spark.createDataFrame([], "k int, v int").schema
    got = ST.fold_upserts(spark, root, dst, ["k"], ["v"], schema, 1)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2), (2, 5), (3, 1)]


def layer_inputs(spark, sf, *leave_out):
    names = {"contacts", "ad_campaigns", "ads_dim", "search_dim"} - set(leave_out)
    inputs = {n: frame(spark, sf, n) for n in names}
    return inputs | {"leads": frame(spark, sf, "leads_by_quarter"), "insights": insights_log(spark, sf), "search_rows": search_log(spark, sf)}


def files_of(spark, path):
    return {r["file_path"] for r in list_files(spark, path).collect()}


def test_a_run_loads_what_is_new(spark, sf):
    """A second run with one more load date replaces that partition only, and appends; a third finds nothing to do."""
    inputs = {n: stored(df, n) for n, df in layer_inputs(spark, sf).items()}
    root = scratch_dir(spark, "daily")
    day = inputs["leads"].agg(F.max("_load_date")).first()[0]
    last = F.lit(day)
    first = {**inputs, "leads": inputs["leads"].filter(F.col("_load_date") < last)}
    found = []
    for given in (first, inputs, inputs):
        before = {m: files_of(spark, f"{root}/{m}") for m in ("staging/stg_leads", "staging/stg_contacts", "silver/sat_person",
                                                              "silver/hub_person", "staging/insight_rows")} if found else {}
        status = {r["step"]: r for r in layers.run_layers(spark, given, root, "2000-01-01").collect()}
        assert {r["status"] for r in status.values()} == {"success"}
        found.append({s: r["n_rows"] for s, r in status.items()})
        for model, files in before.items():
            assert files <= files_of(spark, f"{root}/{model}")
        if before and given is inputs and len(found) == 2:
            new = files_of(spark, f"{root}/staging/stg_leads") - before["staging/stg_leads"]
            assert new and all(f"load_date={day}" in f for f in new)
            assert files_of(spark, f"{root}/staging/insight_rows") == before["staging/insight_rows"]
            # Nothing but new versions is appended to the satellite.
            added = spark.read.parquet(*(files_of(spark, f"{root}/silver/sat_person") - before["silver/sat_person"]))
            assert added.count() == found[1]["sat_person"] - found[0]["sat_person"] and added.filter(F.col("load_date") < last).isEmpty()
    assert found[1]["load_dates"] == 1 and found[2]["load_dates"] == 0
    assert {s: n for s, n in found[1].items() if s != "load_dates"} == {s: n for s, n in found[2].items() if s != "load_dates"}
    assert spark.read.parquet(f"{root}/test_failures/report").count() == 48


def test_a_date_that_is_loaded_again(spark, sf):
    """A load date with other rows than before replaces what was staged of it, also where nothing is left to stage."""
    inputs, root = layer_inputs(spark, sf), scratch_dir(spark, "again")
    contacts = stored(inputs["contacts"], "contacts")
    layers.run_layers(spark, {**inputs, "contacts": contacts}, root, "2000-01-01")
    staged = spark.read.parquet(f"{root}/staging/stg_contacts").groupBy("load_date").count()
    assert staged.count() == 2
    fewer = contacts.filter("_load_date <> '2023-03-01' OR (id % 4 = 0 AND deleted = '1')")
    assert fewer.filter("_load_date = '2023-03-01'").count() > 0
    layers.run_layers(spark, {**inputs, "contacts": fewer}, root, "2000-01-01")
    assert [str(r[0]) for r in spark.read.parquet(f"{root}/staging/stg_contacts").select("load_date").distinct().collect()] == ["2023-04-01"]
    with pytest.raises(ValueError, match="yesterday"):
        layers.run_layers(spark, {**inputs, "contacts": fewer.withColumn("_load_date", F.lit("yesterday"))}, root, "2000-01-01")


def test_failing_steps(spark, sf):
    """Gold failures are recorded, silver failures end the run."""
    inputs = layer_inputs(spark, sf, "ads_dim")
    status = {r["step"]: r for r in layers.run_layers(spark, inputs, scratch_dir(spark, "x"), "2000-01-01").collect()}
    assert status["campaigns"]["status"] == status["mart_leads"]["status"] == status["lead_heatmap"]["status"] == "failed"
    assert "ads_dim" in status["campaigns"]["error"] and status["dq_report"]["status"] == "success"
    broken = layers.Step("silver", "broken", lambda t, old: t["nothing"])
    with pytest.raises(KeyError):
        layers.run_layers(spark, inputs, scratch_dir(spark, "y"), "2000-01-01", [broken])


@pytest.mark.parametrize("seed", range(3))
def test_satellite_in_any_order(spark, seed):
    """Load dates in any order, each with what was staged since for its keys, end in the history of one load. A value that
    was dropped as a repeat is a version of its own once a late row comes between."""
    rng = random.Random(seed)
    rows = [("a", 1, "x", 1), ("a", 3, "x", 2), ("a", 2, "y", 3)]
    rows += [(k, d, rng.choice("xyz"), rng.randint(1, 3)) for k in "bcd" for d in range(1, 7) for _ in range(rng.randint(0, 2))]
    table = spark.createDataFrame(rows, "k string, d int, h string, v int")
    dates, appended, done = [1, 3, 2, *rng.sample([4, 5, 6], 3)] if seed == 0 else rng.sample(range(1, 7), 6), None, []
    for day in dates:
        batch = table.filter(F.col("d") == day)
        if any(d > day for d in done):
            staged = table.filter((F.col("d") >= day) & F.col("d").isin([*done, day]))
            batch = staged.join(batch.select("k").distinct(), "k", "left_semi")
        fresh = spark.createDataFrame(dv.new_versions(batch, appended, "k", "d", "h").collect(), table.schema)
        appended, done = fresh if appended is None else appended.unionByName(fresh), [*done, day]
    got = sorted(map(tuple, dv.satellite_history(appended, "k", "d", "h", "e").collect()), key=repr)
    assert got == sorted(map(tuple, dv.version_history(table, "k", "d", "h", "e").collect()), key=repr)


def test_partitions(spark, tmp_path):
    """Partition types, null keys and dates, modes, emptied partitions, and folders that were never written."""
    path = str(tmp_path / "t")
    assert P.stored_or_none(spark, path) is None
    rows = lambda *r: spark.createDataFrame(r, "day string, k int, v int")
    assert P.merge_partitions(spark, rows(), path, "k", "v", "day") == []
    assert P.merge_partitions(spark, rows(("2024-01-01", 1, 1), ("2024-01-02", 2, 5), (None, None, 1)), path, ["day", "k"], "v", "day", mode="newest")
    P.merge_partitions(spark, rows(("2024-01-02", 2, 4), ("2024-01-02", 3, 1), (None, None, 2)), path, ["day", "k"], "v", "day", mode="newest")
    state = lambda: sorted(((str(r.day), r.k, r.v) for r in spark.read.parquet(path).collect()), key=repr)
    assert state() == [("2024-01-01", 1, 1), ("2024-01-02", 2, 5), ("2024-01-02", 3, 1), ("None", None, 2)]
    P.drop_partitions(spark, path, "day", ["2024-01-02"])
    assert [r for r in state() if r[0] == "2024-01-02"] == []
    other = str(tmp_path / "u")
    for mode, want in (("update", 1), ("insert", 1), ("update", 7), ("insert", 7)):
        P.merge_partitions(spark, spark.createDataFrame([(1, want)], "k int, v int"), other, "k", "v", mode=mode)
        assert [r.v for r in spark.read.parquet(other).collect()] == [want]
    P.merge_partitions(spark, spark.createDataFrame([(1, 9)], "k int, v int"), other, "k", "v", mode="insert")
    assert [r.v for r in spark.read.parquet(other).collect()] == [7]


def test_declared_tests_count():
    count = lambda tests, kind: sum(t.kind == kind for ts in tests.values() for t in ts)
    sources, models = layers.source_tests(), layers.staging_tests()
    kinds = ("not_null", "unique", "accepted_values")
    assert [count(sources, k) for k in kinds] == [15, 2, 3]
    assert [count(models, k) for k in kinds] == [18, 2, 8]


def test_accepted_values_ignore_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert Q.check_accepted(df, "x", ["a"]).first()["failures"] == 1
    assert Q.failing_rows(df, Q.accepted("x", "a")[0]).count() == 1


def test_declared_schemas():
    """Column counts without the three audit columns."""
    sizes = {"CRM_CONTACTS": 38, "CRM_CAMPAIGNS": 89, "CRM_LISTS": 43, "CRM_DEALS": 27, "AD_CAMPAIGNS": 12,
             "AD_SETS": 14, "ADS": 9, "AD_LEADS": 9, "AD_INSIGHTS": 20}
    for name, size in sizes.items():
        stream = getattr(schemas, name)
        assert len(stream.schema) - 3 == size, name
        assert {*stream.key, stream.cursor} <= set(stream.schema.names)


def test_contacts_with_nested_fields(spark, sf):
    """Custom fields declared as a struct give the same staging as JSON text."""
    from leadvault.plans import staging as S
    raw = frame(spark, sf, "contacts")
    nested = raw.withColumn("fields", F.from_json("fields", schemas.CUSTOM_FIELDS))
    a, b = S.stg_contacts(raw, "2023-05-01"), S.stg_contacts(nested, "2023-05-01")
    assert a.count() > 0 and a.exceptAll(b).count() == 0


def test_catalog_ddl(spark):
    catalog.ensure_table(spark, "t_ddl", "id bigint, name string", sort_by=["id"], properties={"layer": "hub"},
                         path=scratch_dir(spark, "ddl"))
    spark.sql("INSERT INTO t_ddl VALUES (1, 'Test Record')")
    props = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES t_ddl").collect()}
    assert props["sort_by"] == "id" and props["layer"] == "hub"
    assert [tuple(r) for r in spark.table("t_ddl").collect()] == [(1, "Test Record")]
    catalog.rename_table(spark, "t_ddl", "t_ddl2")
    catalog.drop_table(spark, "t_ddl2")
    assert not spark.catalog.tableExists("t_ddl2")


def test_configure_a_plain_session(spark):
    """Settings nobody made are applied, settings the cluster made are kept."""
    from leadvault.session import RECOMMENDED, configure
    plain = spark.newSession()
    for key in RECOMMENDED:
        plain.conf.unset(key)
    plain.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    configure(plain)
    assert plain.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    assert plain.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_first_fit_decreasing():
    rng = random.Random(3)
    for room in (10, 100):
        sizes = [rng.randint(1, room) for _ in range(60)]
        bins, free = {}, []
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            at = next((b for b, f in enumerate(free) if f >= sizes[k]), len(free))
            free += [room] * (at == len(free))
            free[at] -= sizes[k]
            bins[k] = at
        assert M.first_fit_decreasing(np.array(sizes), room).tolist() == [bins[k] for k in range(len(sizes))]


def small_files(spark, root, n=9):
    df = spark.createDataFrame([(k, f"d{k % 2}") for k in range(90)], "v int, d string")
    df.repartition(n).write.partitionBy("d").parquet(root)
    return df


def rows_of(spark, root):
    return sorted(map(tuple, spark.read.parquet(root).select("v", "d").collect()))


@pytest.mark.parametrize("dies", ["before the list", "while moving"])
def test_a_compaction_that_died_is_finished(spark, tmp_path, monkeypatch, dies):
    root = str(tmp_path / "t")
    want = sorted(map(tuple, small_files(spark, root).collect()))
    target = max(r["file_size"] for r in list_files(spark, root).collect()) * 5 / M.MB
    if dies == "before the list":
        monkeypatch.setattr(M, "list_files", lambda s, path, real=list_files: 1 / 0 if path.endswith("/files") else real(s, path))
    else:
        real, calls = M._hadoop_path, []

        def path(s, at):
            calls.append(at)
            if at.count("part-") and len([c for c in calls if "part-" in c]) > 2:
                raise ZeroDivisionError
            return real(s, at)
        monkeypatch.setattr(M, "_hadoop_path", path)
    with pytest.raises(ZeroDivisionError):
        M.compact_files(spark, root, target)
    monkeypatch.undo()
    after = M.compact_files(spark, root, target).collect()
    assert rows_of(spark, root) == want and len(after) < 18
    assert not os.path.exists(f"{root}/_compacting")


def test_compaction_leaves_what_fits(spark, tmp_path):
    root = str(tmp_path / "t")
    want = sorted(map(tuple, small_files(spark, root, 4).collect()))
    files = {r["file_path"]: r["file_size"] for r in list_files(spark, root).collect()}
    assert {r["file_path"] for r in M.compact_files(spark, root, max(files.values()) / M.MB).collect()} == set(files)
    # A condition on the listing picks the files.
    M.compact_files(spark, root, 1, where="file_path LIKE '%d=d1/%'")
    after = {r["file_path"] for r in list_files(spark, root).collect()}
    assert {f for f in files if "d=d0" in f} <= after and sum("d=d1" in f for f in after) == 1
    assert rows_of(spark, root) == want


def test_compare_by_key_reads_only_what_differs(spark, tmp_path):
    hot = [(1, k, None if k % 7 == 0 else "x") for k in range(3000)] + [(k, 0, "y") for k in range(2, 900)] + [(None, 1, "z")] * 3
    left = spark.createDataFrame(hot, "k int, a int, b string")
    assert Q.compare_by_key(left, left.select("b", "k", "a").repartition(7), "k").count() == 0
    assert Q.differing_ranges(left, left.repartition(3), "k") == []
    right = spark.createDataFrame([*hot[1:], (5000, 1, None)], "k int, a int, b string")
    assert len(Q.differing_ranges(left, right, "k")) <= 2
    got = {r["k"]: (r["difference"], r["n_left"], r["n_right"], r["changed_columns"]) for r in Q.compare_by_key(left, right, "k").collect()}
    assert set(got) == {1, 5000} and got[5000] == ("only_right", 0, 1, None)
    assert got[1][:3] == ("changed", 3000, 2999) and "b" in got[1][3]
    swapped = spark.createDataFrame([(1, 1, "p"), (1, 2, "q")], "k int, a int, b string")
    other = spark.createDataFrame([(1, 1, "q"), (1, 2, "p")], "k int, a int, b string")
    assert [tuple(r) for r in Q.compare_by_key(swapped, other, "k").collect()] == [(1, "changed", 2, 2, "")]
    with pytest.raises(ValueError):
        Q.compare_by_key(left, right.drop("b"), "k")


def test_a_copy_that_differs_is_an_error(spark, tmp_path, monkeypatch):
    src, dst = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(50).write.parquet(src)
    assert writes.mirror_table(spark, src, dst).count() == 50
    monkeypatch.setattr(Q, "differing_ranges", lambda a, b, keys: ["p00"])
    with pytest.raises(RuntimeError, match="1 ranges"):
        writes.mirror_table(spark, src, dst)


@pytest.mark.parametrize("seed", range(2))
def test_snapshot_batches_in_any_order(spark, tmp_path, seed):
    """Late states, states of one time, repeated batches; a load reads no closed version."""
    rng, path = random.Random(seed), str(tmp_path / "s")
    rows = [(k, t, rng.randint(1, 3)) for k in range(6) for t in range(1, 9) for _ in range(rng.choice([0, 1, 1, 2]))]
    schema, batches = "k int, t int, v int", [rows[k::4] for k in range(4)]
    for k in [rng.randrange(4) for _ in range(3)] + [0, 1, 2, 3]:
        snapshots.load_snapshot(spark, spark.createDataFrame(batches[k], schema), path, "k", "t", digits=1)
    got = sorted(map(tuple, snapshots.read_snapshot(spark, path, "k", "t").select("k", "t", "v", "valid_from", "valid_to").collect()), key=repr)
    best = {}
    for k, t, v in rows:
        best[k, t] = min(v, best.get((k, t), v))
    want = [(k, t, v, t, min((u for j, u in best if j == k and u > t), default=None)) for (k, t), v in best.items()]
    assert got == sorted(want, key=repr)


def test_ranges_bound_hot_keys(spark):
    """Half of the rows under one key and one day: no bucket is much larger than asked for."""
    df = spark.range(20_000).selectExpr("if(id % 2 = 0, 0, id % 50) AS k", "if(id % 2 = 0, 1, id % 7) AS day", "id")
    cut = W.in_ranges(df, "k", ["day", "id"], 1000)
    sizes = [r["count"] for r in cut.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 2000
    got = W.with_neighbour(df, "k", ["day", "id"], "id", "before", False, bucket_rows=1000)
    frame = df.toPandas().sort_values(["k", "day", "id"])
    want = frame.assign(before=frame.groupby("k")["id"].shift())
    assert {r["id"]: r["before"] for r in got.collect()} == {i: None if np.isnan(b) else int(b) for i, b in zip(want["id"], want["before"])}


def test_compaction_writes_one_file_per_task(spark):
    """However many groups there are for the shuffle partitions: a task holds no second file, and has nothing to sort."""
    root = scratch_dir(spark, "files")
    spark.range(4000).withColumn("d", F.col("id") % 9).repartition(8, F.col("id") % 8).write.partitionBy("d").parquet(root)
    sizes = [r["file_size"] for r in list_files(spark, root).collect()]
    after = M.compact_files(spark, root, 3.5 * max(sizes) / M.MB)
    new = [r["file_path"].rsplit("/", 1)[1] for r in after.collect() if "/part-s" in r["file_path"]]
    tasks = [name.split("-")[2] for name in new]
    assert len(new) == 9 and len(set(tasks)) == len(tasks)
    assert [tuple(r) for r in spark.read.parquet(root).agg(F.count("*"), F.sum("id")).collect()] == [(4000, 3999 * 2000)]


def test_shuffles_follow_the_size_of_the_input(spark):
    from leadvault import session
    name, before = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", {}
    for key in (name, *session.TASK_SETTINGS):
        before[key] = spark.conf.get(key, None)
        spark.conf.unset(key)
    try:
        seen = []
        for rows in (10, 2_000_000, 10):
            path = scratch_dir(spark, "input")
            spark.range(rows).select("id", F.xxhash64("id").alias("x")).write.parquet(path)
            session.size_tasks(spark, path)
            seen.append(int(spark.conf.get(name, "4")))
        assert seen[0] == 4 and seen[1] > 4 and seen[2] == seen[1]
        spark.conf.set(name, "3")  # somebody else's
        assert session.size_tasks(spark, path).conf.get(name) == "3"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

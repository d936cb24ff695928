"""Column functions on edge rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from leadvault import functions as L
from leadvault.functions.text import concat_all

md5 = lambda s: hashlib.md5(s.encode()).hexdigest()


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_person_hash_branches(spark):
    rows = [
        ("João Silva", "joao@email.com", "11999999999"), ("João Silva", "joao@email.com", None),
        (None, "joao@email.com", "11999999999"), ("João Silva", None, "(11) 99999-9999"),
        (None, " Joao@Email.com ", None), ("João Silva", None, None), (None, None, "11999999999"), (None, None, None),
    ]
    got = [v for (v,) in values(spark, rows, "n string, e string, p string", L.person_hash("n", "e", "p"))]
    assert got == [
        md5("joão silva|joao@email.com|11999999999"), md5("joão silva|joao@email.com"),
        md5("joao@email.com|11999999999"), md5("joão silva|11999999999"), md5("joao@email.com"), None, None, None]


def test_hashes_and_null(spark):
    got = values(spark, [("a", None)], "x string, y string", L.hash_key("x", "y"), L.hash_diff("x", "y"),
                 L.surrogate_key("x", "y"), L.hash_key(F.lit(" a "), upper=True), concat_all("x", "y"))[0]
    assert got == (None, md5("a|"), md5("a-_dbt_utils_surrogate_key_null_"), md5("A"), None)


def test_text(spark):
    rows = [("\t Ab \n",), ("",), ("   ",), (None,)]
    got = values(spark, rows, "x string", L.strip("x"), L.clean_upper("x"), L.clean_lower("x"), L.blank_to_null("x"),
                 L.non_blank("x"))
    assert got == [("Ab", "AB", "ab", "Ab", True), ("", "", "", None, False), ("", "", "", None, True),
                   (None, "", None, None, False)]


def test_sentinels_and_priority(spark):
    rows = [("unknown", "", "z"), (None, "y", "z"), ("x", "y", "z"), ("", None, "unknown")]
    got = values(spark, rows, "a string, b string, c string", L.not_sentinel("a"), L.first_usable("a", "b", "c"),
                 L.first_usable("a", "b", "c", default="direct"))
    assert got == [(False, "z", "z"), (False, "y", "y"), (True, "x", "x"), (False, None, "direct")]


def test_producer_tag(spark):
    rows = [("vip,produtor_ana_1,x",), ("produtorx",), ("",), (None,)]
    assert values(spark, rows, "t string", L.tagged_name("t", "produtor")) == [("ana_1",), ("",), ("",), (None,)]


def test_digits_of_phones(spark):
    rows = [("(11) 9 8765-4321",), ("12-34",), ("none",), (None,)]
    assert values(spark, rows, "p string", L.digits("p")) == [("11987654321",), ("1234",), ("",), (None,)]


def test_ratio_band_flags(spark):
    rows = [(10, 4), (10, 0), (10, None), (None, 4)]
    got = values(spark, rows, "n int, d int", L.ratio("n", "d"), L.flag01(F.col("d") > 0), L.any_positive("n", "d"),
                 L.score(F.col("n") > 5, F.col("d") > 5), L.all_present("n", "d"))
    assert got == [(2.5, 1, True, 1, True), (0.0, 0, True, 1, True), (0.0, 0, True, 1, False), (None, 1, True, 0, False)]
    bounds = [(">=", 2.0, "Alto"), (">=", 1.0, "Médio"), (">", 0.0, "Baixo")]
    got = values(spark, [(2.0,), (1.99,), (0.01,), (0.0,), (None,)], "x double", L.band("x", bounds, "Sem dados"))
    assert [v for (v,) in got] == ["Alto", "Médio", "Baixo", "Sem dados", "Sem dados"]


@pytest.mark.parametrize("created, days", [
    ("2000-01-31 00:00:00", 0), ("2000-01-24 00:00:00", 7), ("2000-01-23 12:00:00", 7), ("2000-01-23 00:00:00", 8),
    ("2000-01-01 00:00:00", 30), ("1999-12-31 00:00:00", 31)])
def test_complete_days(spark, created, days):
    got = values(spark, [(created,)], "t string", L.days_between("t", "2000-01-31"))
    assert got == [(days,)]


def test_open_versions(spark):
    rows = [(None,), ("2024-01-02 00:00:00",), ("2024-01-01 00:00:00",)]
    end = F.col("t").cast("timestamp_ntz")
    assert values(spark, rows, "t string", L.is_current(end, "2024-01-01")) == [(True,), (True,), (False,)]


def test_partition_strategies(spark):
    stamp = F.col("t").cast("timestamp_ntz")
    cols = [L.partition_expr(stamp, s).cast("string") for s in ("daily", "weekly", "monthly", "other")]
    assert values(spark, [("2024-02-29 13:14:15",)], "t string", *cols) == [
        ("2024-02-29 00:00:00", "2024-02-26 00:00:00", "2024-02-01 00:00:00", "2024-02-29 13:14:15")]

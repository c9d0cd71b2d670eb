"""Scalar functions S1-S25 and name sanitising (PRJ6, PRJ7) on hand-written rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmix.functions import exprs as X
from gridmix.operators.ingest import flatten_columns, sanitize, sanitize_columns

NAME_CASES = [
    ("Actual Generation/MW", "actual_generation_mw"),
    ("Production.Total", "production_total"),
    ("Fossil Gas/Actual Aggregated", "fossil_gas_actual_aggregated"),
    ("__a--b__", "a_b"),
    ("Hydro Run-of-river and poundage", "hydro_run_of_river_and_poundage"),
]


@pytest.mark.parametrize("raw,clean", NAME_CASES)
def test_sanitize_python(raw, clean):
    assert sanitize(raw) == clean


def test_sanitize_column_matches_python(spark):
    df = spark.createDataFrame([(r,) for r, _ in NAME_CASES], "raw string")
    got = {r.raw: r.clean for r in df.select("raw", X.sanitize_name("raw").alias("clean")).collect()}
    assert got == {r: c for r, c in NAME_CASES}


def test_sanitize_columns_renames_and_detects_clash(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`Fossil Gas/Actual Aggregated` double, `Nuclear` double")
    assert sanitize_columns(df).columns == ["fossil_gas_actual_aggregated", "nuclear"]
    clash = spark.createDataFrame([(1, 2)], "`A.B` int, `A/B` int")
    with pytest.raises(ValueError, match="A.B.*A/B"):
        sanitize_columns(clash)


def test_flatten_two_level_names(spark):
    df = spark.sql("SELECT named_struct('Actual Aggregated', 1.0D, 'Actual Consumption', 2.0D) AS `Fossil Oil`, "
                   "3.0D AS Solar")
    flat = sanitize_columns(flatten_columns(df))
    assert flat.columns == ["fossil_oil_actual_aggregated", "fossil_oil_actual_consumption", "solar"]
    assert flat.first() == (1.0, 2.0, 3.0)


def test_share_zero_and_null_totals(spark):
    df = spark.createDataFrame([(1.0, 3.0), (0.0, 0.0), (None, None), (2.0, 3.0)], "part double, total double")
    got = [r.s for r in df.select(X.share("part", "total").alias("s")).collect()]
    assert got == [33.33, None, None, 66.67]


def test_zero_filled_total_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([(None, 2.5, None)], "a double, b double, c double")
    assert df.select(X.zero_filled_total(["a", "b", "c"]).alias("t")).first().t == 2.5


def test_total_sum_exact_and_null_semantics(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", None)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(X.total_sum("v", 2).alias("s")).collect()}
    assert got == {"a": 0.3, "b": None}
    plain = {r.k: r.s for r in df.groupBy("k").agg(X.total_sum("v").alias("s")).collect()}
    assert plain["b"] is None and abs(plain["a"] - 0.3) < 1e-12


def test_psr_mapping_and_renewable_flag(spark):
    df = spark.createDataFrame([("B14",), ("B25",), (None,), ("B01",), ("B21",)], "psr string")
    rows = df.select("psr", X.psr_energy_type("psr").alias("t"), X.psr_is_renewable("psr").alias("r")).collect()
    got = [(r.psr, r.t, r.r) for r in rows]
    assert got == [("B14", "Nuclear", False), ("B25", "Unknown (B25)", False), (None, "Unknown (None)", False),
                   ("B01", "Biomass", True), ("B21", "AC Link", False)]


def test_country_name_default_is_code(spark):
    df = spark.createDataFrame([("FR",), ("UK",), ("CH",)], "c string")
    assert [r.n for r in df.select(X.country_name("c").alias("n")).collect()] == ["France", "UK", "CH"]


def test_parse_iso_instant_without_seconds(spark):
    df = spark.createDataFrame([("2025-07-01T22:00Z",), ("2025-07-01T22:00:30Z",), ("bad",), (None,),
                                ("2025-07-02T00:00+02:00",), ("2025-07-01T22:00:00.250Z",), ("2025-07-01T22:00",)],
                               "s string")
    got = [r.t for r in df.select(X.parse_iso_instant("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2025, 7, 1, 22, 0)
    assert got[1] == dt.datetime(2025, 7, 1, 22, 0, 30)
    assert got[2] is None and got[3] is None
    assert got[4] == dt.datetime(2025, 7, 1, 22, 0)          # offset applied
    assert got[5] == dt.datetime(2025, 7, 1, 22, 0, 0, 250000)
    assert got[6] == dt.datetime(2025, 7, 1, 22, 0)          # no zone: session zone, UTC


def test_table_names_and_extract_kinds(spark):
    from gridmix.operators.ingest import extract_kind

    df = spark.createDataFrame([("A75",), ("A73",), ("A68",), ("A65",)], "d string")
    rows = df.select(X.bronze_table_name("d").alias("t"), extract_kind(F.col("d")).alias("k")).collect()
    assert [tuple(r) for r in rows] == [
        ("bronze_entsoe_a75_actual_generation", "generation"),
        ("bronze_entsoe_a73_generation_forecast", "generation_per_plant"),
        ("bronze_entsoe_a68_installed_capacity", "installed_generation_capacity"),
        ("bronze_entsoe_a65", None),
    ]


def test_response_class(spark):
    df = spark.createDataFrame([
        ("<GL_MarketDocument/>", 200), ("<Acknowledgement_MarketDocument/>", 200),
        ("<html/>", 200), ("<GL_MarketDocument/>", 503), (None, 200)], "body string, status int")
    got = [r.c for r in df.select(X.response_class("body", "status").alias("c")).collect()]
    assert got == ["data", "no_data", "unknown", "failed", "unknown"]


def test_market_time_to_utc_winter_and_summer(spark):
    df = spark.createDataFrame([("2025-01-15",), ("2025-07-15",)], "d string")
    rows = df.select(X.market_time_to_utc(F.to_timestamp("d")).alias("u"),
                     X.api_time(F.to_timestamp("d")).alias("p")).collect()
    assert rows[0].u == dt.datetime(2025, 1, 14, 23, 0) and rows[1].u == dt.datetime(2025, 7, 14, 22, 0)
    assert rows[0].p == "202501150000"

"""Ingestion operators: windows (ING1-ING3), high-water marks (AGG7/AGG8), load and outcomes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridmix.operators import ingest as I

KEYS_SCHEMA = "country_code string, document_type string"
MARKS_SCHEMA = "document_type string, country_code string, last_date date"


def plan_rows(spark, marks, window, countries=("FR", "BE", "DE"), docs=("A75",)):
    keys = I.plan_keys(spark.createDataFrame([(c,) for c in countries], "country_code string"), list(docs))
    m = spark.createDataFrame(marks, MARKS_SCHEMA)
    return {r.country_code: r for r in I.window_plan(keys, m, window).collect()}


def test_incremental_window_cases(spark):
    w = I.IngestWindow(end="2025-07-10", default_start="2025-06-01")
    plan = plan_rows(spark, [("A75", "BE", dt.date(2025, 7, 7)), ("A75", "DE", dt.date(2025, 7, 10))], w)
    assert plan["FR"].start_date == dt.date(2025, 6, 1) and plan["FR"].action == "fetch"
    assert plan["BE"].start_date == dt.date(2025, 7, 8) and plan["BE"].action == "fetch"
    assert plan["DE"].start_date == dt.date(2025, 7, 11) and plan["DE"].action == "skip"
    assert plan["FR"].mode == "incremental" and plan["FR"].table_name == "bronze_entsoe_a75_actual_generation"
    assert plan["FR"].request_start_utc == dt.datetime(2025, 5, 31, 22, 0)
    assert plan["FR"].period_start_param == "202506010000" and plan["FR"].period_end_param == "202507100000"


def test_explicit_window_ignores_marks(spark):
    w = I.IngestWindow(start="2025-01-01", end="2025-01-31")
    plan = plan_rows(spark, [("A75", "FR", dt.date(2025, 7, 7))], w)
    assert all(r.start_date == dt.date(2025, 1, 1) and r.mode == "explicit" for r in plan.values())


def test_plan_keys_every_country_every_document(spark):
    countries = spark.createDataFrame([("FR",), ("FR",), ("BE",)], "country_code string")
    keys = sorted(tuple(r) for r in I.plan_keys(countries, ["A75", "A68"]).collect())
    assert keys == [("BE", "A68"), ("BE", "A75"), ("FR", "A68"), ("FR", "A75")]


def test_per_unit_window_needs_both_dates():
    assert I.per_unit_window("2025-01-01", "2025-02-01", "2026-03-13") == ("2025-01-01", "2025-02-01")
    assert I.per_unit_window("2025-01-01", None, "2026-03-13 10:00") == ("2026-01-01", "2026-03-13 10:00")


def test_high_water_marks(spark):
    df = spark.createDataFrame([("FR", dt.datetime(2025, 7, 1, 23)), ("FR", dt.datetime(2025, 7, 3, 0)),
                                ("BE", dt.datetime(2025, 6, 1, 5))], "country_code string, index timestamp")
    got = {r.country_code: r.last_date for r in I.high_water_marks(df).collect()}
    assert got == {"FR": dt.date(2025, 7, 3), "BE": dt.date(2025, 6, 1)}
    assert I.high_water_marks(df, by_country=False).first().last_date == dt.date(2025, 7, 3)
    empty = spark.createDataFrame([], "country_code string, index timestamp")
    assert I.high_water_marks(empty).count() == 0
    assert I.high_water_marks(empty, by_country=False).first().last_date is None


def test_high_water_marks_per_unit(spark):
    df = spark.createDataFrame([("FR", "2025-07-01T22:00Z"), ("FR", "2025-01-01T00:00Z")],
                               "country_code string, period_start string")
    assert I.high_water_marks_per_unit(df).first().last_date == dt.date(2025, 7, 1)


def _landed(spark):
    rows = [("FR", "A75", dt.datetime(2025, 6, 30, 21), 1.0, 2.0),
            ("FR", "A75", dt.datetime(2025, 6, 30, 22), 3.0, 4.0),   # 2025-07-01 00:00 Brussels
            ("FR", "A75", dt.datetime(2025, 7, 2, 21, 59), 5.0, 6.0),
            ("FR", "A75", dt.datetime(2025, 7, 2, 22), 7.0, 8.0),    # end bound, excluded
            ("BE", "A75", dt.datetime(2025, 7, 1, 10), 9.0, None)]
    return spark.createDataFrame(rows, "country_code string, document_type string, index timestamp, "
                                       "`Solar/Actual Aggregated` double, `Nuclear/Actual Aggregated` double")


def test_load_batch_filters_window_sanitises_and_stamps(spark):
    landed = _landed(spark)
    keys = I.plan_keys(spark.createDataFrame([("FR",)], "country_code string"), ["A75"])
    plan = I.window_plan(keys, None, I.IngestWindow(start="2025-07-01", end="2025-07-03"))
    batch = I.load_batch(landed, plan, "2026-01-01 00:00:00")
    assert batch.columns == ["country_code", "document_type", "index", "solar_actual_aggregated",
                             "nuclear_actual_aggregated", "ingestion_timestamp"]
    assert sorted(r.solar_actual_aggregated for r in batch.collect()) == [3.0, 5.0]


def test_append_grows_schema_with_nulls(spark):
    old = spark.createDataFrame([("FR", 1.0)], "country_code string, solar double")
    new = spark.createDataFrame([("FR", 2.0, 3.0)], "country_code string, solar double, lignite double")
    rows = sorted(I.append(old, new).collect(), key=lambda r: r.solar)
    assert [tuple(r) for r in rows] == [("FR", 1.0, None), ("FR", 2.0, 3.0)]


def test_outcomes_and_summary(spark):
    landed = _landed(spark)
    keys = I.plan_keys(spark.createDataFrame([("FR",), ("BE",), ("DE",)], "country_code string"), ["A75", "A99"])
    marks = spark.createDataFrame([("A75", "DE", dt.date(2025, 7, 5))], MARKS_SCHEMA)
    plan = I.window_plan(keys, marks, I.IngestWindow(end="2025-07-03", default_start="2025-07-01"))
    batch = I.load_batch(landed, plan, "2026-01-01 00:00:00")
    out = {(r.country_code, r.document_type): (r.status, r.rows) for r in I.load_outcomes(plan, [batch]).collect()}
    assert out[("FR", "A75")] == ("updated", 2)
    assert out[("BE", "A75")] == ("updated", 1)
    assert out[("DE", "A75")] == ("skipped", 0)
    assert out[("FR", "A99")] == ("failed", 0)  # unsupported document type
    summary = {r.status: (r.n_keys, r.n_rows) for r in I.summary(I.load_outcomes(plan, [batch])).collect()}
    assert summary == {"updated": (2, 3), "skipped": (1, 0), "failed": (3, 0)}


def test_add_lineage(spark):
    df = spark.createDataFrame([(1,)], "x int")
    r = I.add_lineage(df, "2026-01-01 00:00:00", "FR", "A75").first()
    assert (r.country_code, r.document_type, r.ingestion_timestamp) == ("FR", "A75", dt.datetime(2026, 1, 1))
    assert I.add_lineage(df, None).where(F.col("ingestion_timestamp").isNotNull()).count() == 1


def test_incremental_without_marks_starts_at_default(spark):
    keys = I.plan_keys(spark.createDataFrame([("FR",)], "country_code string"), ["A75"])
    r = I.window_plan(keys, None, I.IngestWindow(end="2025-07-10", default_start="2025-06-01")).first()
    assert r.start_date == dt.date(2025, 6, 1) and r.last_date is None and r.action == "fetch"


def test_high_water_marks_read_only_latest_month(spark, tmp_path):
    df = spark.createDataFrame([("FR", dt.datetime(2025, m, d, 5)) for m in (5, 6, 7) for d in (1, 20)]
                               + [("BE", dt.datetime(2024, 12, 31, 23))], "country_code string, index timestamp")
    path = str(tmp_path / "b")
    df.withColumn("index_month", F.date_format("index", "yyyy-MM")).write.partitionBy(
        "country_code", "index_month").parquet(path)
    bronze = spark.read.parquet(path)
    marks = I.high_water_marks(bronze)
    assert {r.country_code: r.last_date for r in marks.collect()} == {"FR": dt.date(2025, 7, 20),
                                                                      "BE": dt.date(2024, 12, 31)}
    text = marks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "index_month" in text.split("PartitionFilters: [")[1].split("]")[0]

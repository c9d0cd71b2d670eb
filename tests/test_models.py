"""Models M1-M9 on hand-written rows, one test per quirk of SURVEY section 1.6."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridmix.contracts import BRONZE_A68, BRONZE_A71, BRONZE_A75
from gridmix.operators import marts, staging

TS = dt.datetime(2026, 3, 13, 6, 0)


def a75(spark, rows):
    """rows: (country, index, {raw column: MW})."""
    data = []
    for country, index, values in rows:
        rec = {f.name: None for f in BRONZE_A75.fields}
        rec.update(country_code=country, document_type="A75", ingestion_timestamp=TS, index=index, **values)
        data.append(tuple(rec[f.name] for f in BRONZE_A75.fields))
    return spark.createDataFrame(data, BRONZE_A75)


def a68(spark, rows):
    data = []
    for country, index, values, ingested in rows:
        rec = {f.name: None for f in BRONZE_A68.fields}
        rec.update(country_code=country, document_type="A68", ingestion_timestamp=ingested, index=index, **values)
        data.append(tuple(rec[f.name] for f in BRONZE_A68.fields))
    return spark.createDataFrame(data, BRONZE_A68)


def a71(spark, rows):
    """rows: (country, unit, psr, energy_type, renewable, mw, start, end)."""
    data = [(c, u, f"name {u}", p, s, e, mw, None, None, t, r, "A71", TS) for c, u, p, t, r, mw, s, e in rows]
    return spark.createDataFrame(data, BRONZE_A71)


def daily(spark, rows, exact=None):
    return marts.generation_daily(staging.stg_generation(a75(spark, rows)), exact)


def test_day_energy_is_sum_of_hourly_mw(spark):
    rows = [("FR", dt.datetime(2025, 7, 1, h), {"solar_actual_aggregated": 100.0}) for h in range(24)]
    r = daily(spark, rows).first()
    assert r.solar_mwh == 2400.0 and r.hourly_records_count == 24 and r.nuclear_mwh == 0.0


def test_day_is_utc_day(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    one = dt.datetime(2025, 7, 1, 22, 30)  # 2025-07-02T00:30+02:00 is the same instant
    r = daily(spark, [("FR", one, {"solar_actual_aggregated": 1.0}), ("FR", one, {"solar_actual_aggregated": 2.0})])
    rows = r.collect()
    assert len(rows) == 1 and rows[0].generation_date == dt.date(2025, 7, 1) and rows[0].solar_mwh == 3.0


def test_no_dedup_overlapping_loads_double_the_day(spark):
    row = ("FR", dt.datetime(2025, 7, 1, 1), {"nuclear_actual_aggregated": 10.0})
    assert daily(spark, [row, row]).first().nuclear_mwh == 20.0


def test_missing_fuel_column_reads_as_null(spark):
    bronze = a75(spark, [("FR", dt.datetime(2025, 7, 1, 1), {"solar_actual_aggregated": 5.0})]).drop(
        "fossil_brown_coal_lignite_actual_aggregated", "waste_actual_aggregated")
    stg = staging.stg_generation(bronze)
    assert stg.first().waste_mw is None
    assert marts.generation_daily(stg).first().waste_mwh == 0.0


def test_zero_production_gives_null_shares(spark):
    mix = marts.energy_mix(daily(spark, [("FR", dt.datetime(2025, 7, 1, 1), {})])).first()
    assert mix.total_production_mwh == 0.0
    assert (mix.renewable_percentage, mix.fossil_percentage, mix.nuclear_percentage, mix.other_percentage) == \
        (None, None, None, None)


def test_energy_mix_categories_and_shares(spark):
    vals = {"solar_actual_aggregated": 30.0, "fossil_gas_actual_aggregated": 20.0,
            "nuclear_actual_aggregated": 40.0, "waste_actual_aggregated": 10.0,
            "fossil_brown_coal_lignite_actual_aggregated": 999.0}  # not part of any category (quirk 6)
    mix = marts.energy_mix(daily(spark, [("FR", dt.datetime(2025, 7, 1, 1), vals)])).first()
    assert mix.total_production_mwh == 100.0
    assert (mix.renewable_percentage, mix.fossil_percentage, mix.nuclear_percentage, mix.other_percentage) == \
        (30.0, 20.0, 40.0, 10.0)


def test_shares_sum_to_100_property(spark):
    from gridmix.plans.catalog import _gen_daily

    mix = marts.energy_mix(_gen_daily(spark, "/root/testdata/sf0.001"))
    pct = F.col("renewable_percentage") + F.col("fossil_percentage") + F.col("nuclear_percentage") + \
        F.col("other_percentage")
    bad = mix.where(F.col("renewable_percentage").isNotNull() & (F.abs(pct - 100) > 0.021)).count()
    assert bad == 0
    mixed_null = mix.where(F.col("renewable_percentage").isNull() & F.col("fossil_percentage").isNotNull()).count()
    assert mixed_null == 0


def test_daily_totals_equal_raw_totals(spark):
    from gridmix.sources import fixtures as fx

    bronze = fx.bronze_a75(spark, "/root/testdata/sf0.001")
    raw = bronze.agg(F.sum(F.coalesce("solar_actual_aggregated", F.lit(0.0))).alias("s")).first().s
    rolled = marts.generation_daily(staging.stg_generation(bronze), 2).agg(F.sum("solar_mwh").alias("s")).first().s
    assert abs(raw - rolled) < 1e-6


def test_dim_countries_names_and_uk_unnamed(spark):
    rows = [(c, dt.datetime(2025, 7, 1, 1), {}) for c in ["UK", "FR", "FR", "PT"]]
    got = [tuple(r) for r in marts.dim_countries(daily(spark, rows)).collect()]
    assert got == [("FR", "France"), ("PT", "Portugal"), ("UK", "UK")]


def test_forecast_passes_plant_columns_through(spark):
    df = spark.createDataFrame([("FR", "A73", TS, dt.datetime(2025, 7, 1, 1), 1.0, 2.0)],
                               "country_code string, document_type string, ingestion_timestamp timestamp, "
                               "index timestamp, plant_a double, plant_b double")
    out = staging.stg_forecast(df)
    assert out.columns == ["country_code", "document_type", "ingestion_timestamp", "forecast_datetime",
                           "plant_a", "plant_b"]


def test_capacity_per_unit_reappend_multiplies_sum_not_units(spark):
    row = ("FR", "U1", "B16", "Solar", True, 10.0, "2025-01-01T00:00Z", "2025-12-31T23:00Z")
    other = ("FR", "U2", "B16", "Solar", True, 5.0, "2025-02-01T00:00Z", "2025-12-31T23:00Z")
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(a71(spark, [row, row, other])), 2).first()
    assert cpu.total_capacity_mw == 25.0 and cpu.number_of_units == 2
    assert cpu.latest_period_start == "2025-02-01T00:00Z"


def test_capacity_per_unit_string_max_is_lexicographic(spark):
    rows = [("FR", "U1", "B16", "Solar", True, 1.0, "2025-07-01T22:00Z", "x"),
            ("FR", "U1", "B16", "Solar", True, 1.0, "2025-07-01 23:00", "x")]
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(a71(spark, rows))).first()
    assert cpu.latest_period_start == "2025-07-01T22:00Z"  # 'T' sorts after ' '


def test_capacity_sum_is_null_when_all_inputs_null(spark):
    row = ("FR", "U1", "B16", "Solar", True, None, "2025-01-01T00:00Z", "e")
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(a71(spark, [row]))).first()
    assert cpu.total_capacity_mw is None and cpu.number_of_units == 1


def _m9(spark, snapshots, units, dim_codes):
    dim = spark.createDataFrame([(c,) for c in dim_codes], "country_code string")
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(a71(spark, units)), ordered=False)
    return {r.country_code: r for r in marts.renewable_capacity(
        staging.stg_capacity(a68(spark, snapshots)), cpu, dim).collect()}


def test_renewable_capacity_latest_snapshot_and_arms(spark):
    snaps = [("PT", dt.datetime(2024, 1, 1), {"solar": 1.0}, TS),
             ("PT", dt.datetime(2025, 1, 1), {"solar": 3.0, "fossil_gas": 1.0}, TS),
             ("PT", dt.datetime(2023, 1, 1), {"solar": 9.0}, TS),
             ("CH", dt.datetime(2025, 1, 1), {"nuclear": 2.0}, TS),       # kept though not in the dimension
             ("FR", dt.datetime(2025, 1, 1), {"nuclear": 50.0}, TS)]      # per-unit country: not from snapshots
    units = [("FR", "U1", "B14", "Nuclear", False, 60.0, "2025-01-01T00:00Z", "e"),
             ("FR", "U2", "B16", "Solar", True, 20.0, "2025-03-01T00:00Z", "e"),
             ("FR", "U3", "B04", "Fossil Gas", False, 10.0, "2025-02-01T00:00Z", "e"),
             ("FR", "U4", "B21", "AC Link", False, 10.0, "2025-02-01T00:00Z", "e"),
             ("PT", "U5", "B16", "Solar", True, 99.0, "2025-01-01T00:00Z", "e"),   # PT excluded from per-unit arm
             ("ZZ", "U6", "B16", "Solar", True, 99.0, "2025-01-01T00:00Z", "e")]   # not in the dimension
    out = _m9(spark, snaps, units, ["FR", "PT"])
    assert set(out) == {"PT", "CH", "FR"}
    pt = out["PT"]
    assert pt.capacity_date == dt.date(2025, 1, 1) and pt.total_renewable_capacity_mw == 3.0
    assert pt.renewable_capacity_percentage == 75.0
    fr = out["FR"]
    assert (fr.total_renewable_capacity_mw, fr.total_fossil_capacity_mw, fr.total_nuclear_capacity_mw,
            fr.total_other_capacity_mw) == (20.0, 10.0, 60.0, 10.0)
    assert fr.capacity_date == dt.date(2025, 3, 1) and fr.total_installed_capacity_mw == 100.0


def test_renewable_capacity_snapshot_tie_takes_latest_ingestion(spark):
    snaps = [("PT", dt.datetime(2025, 1, 1), {"solar": 1.0}, dt.datetime(2026, 1, 1)),
             ("PT", dt.datetime(2025, 1, 1), {"solar": 2.0}, dt.datetime(2026, 2, 1))]
    out = _m9(spark, snaps, [("FR", "U1", "B14", "Nuclear", False, 1.0, "2025-01-01T00:00Z", "e")], ["FR"])
    assert out["PT"].total_renewable_capacity_mw == 2.0

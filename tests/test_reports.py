"""Reports RPT1-RPT7 on hand-written gold rows."""

from __future__ import annotations

import datetime as dt

from gridmix.operators import reports

MIX_SCHEMA = ("country_code string, generation_date date, total_renewable_mwh double, total_fossil_mwh double, "
              "total_nuclear_mwh double, total_other_mwh double, total_production_mwh double")


def mix(spark, rows):
    full = [(c, d, r, f, n, o, r + f + n + o) for c, d, r, f, n, o in rows]
    return spark.createDataFrame(full, MIX_SCHEMA)


D1, D2 = dt.date(2025, 7, 1), dt.date(2025, 8, 1)


def test_overview_recomputes_shares_from_sums(spark):
    # FR: 100% renewable on 10 MWh; BE: 0% renewable on 90 MWh -> overall 10%, not the mean 50%
    df = mix(spark, [("FR", D1, 10.0, 0.0, 0.0, 0.0), ("BE", D1, 0.0, 90.0, 0.0, 0.0)])
    r = reports.overview(df, exact_scale=2).first()
    assert (r.countries, r.total_production_mwh, r.renewable_percentage, r.fossil_percentage) == (2, 100.0, 10.0, 90.0)


def test_country_mix_period_and_monthly_trend(spark):
    df = mix(spark, [("FR", D1, 1.0, 1.0, 0.0, 0.0), ("FR", D2, 3.0, 0.0, 0.0, 1.0)])
    whole = reports.country_mix(df).first()
    assert (whole.days, whole.renewable_percentage, whole.other_percentage) == (2, 66.67, 16.67)
    july = reports.country_mix(df, start="2025-07-01", end="2025-07-31").first()
    assert (july.days, july.renewable_percentage) == (1, 50.0)
    months = {r.month: r.renewable_percentage for r in reports.monthly_trend(df).collect()}
    assert months == {dt.date(2025, 7, 1): 50.0, dt.date(2025, 8, 1): 75.0}


def test_ranking_ties_and_null_last(spark):
    df = mix(spark, [("FR", D1, 5.0, 5.0, 0.0, 0.0), ("BE", D1, 1.0, 1.0, 0.0, 0.0),
                     ("PT", D1, 9.0, 1.0, 0.0, 0.0), ("UK", D1, 0.0, 0.0, 0.0, 0.0)])
    got = {r.country_code: r.renewable_rank for r in reports.ranking(df).collect()}
    assert got == {"PT": 1, "FR": 2, "BE": 2, "UK": 4}


def test_capacity_share_of_country_total(spark):
    cap = spark.createDataFrame(
        [("FR", "Solar", True, 30.0, 2), ("FR", "Nuclear", False, 70.0, 1), ("BE", "Waste", False, 0.0, 1)],
        "country_code string, energy_type string, is_renewable boolean, total_capacity_mw double, number_of_units bigint")
    got = {(r.country_code, r.energy_type): (r.country_total_capacity_mw, r.capacity_share_percentage)
           for r in reports.capacity_share(cap, exact_scale=2).collect()}
    assert got == {("FR", "Solar"): (100.0, 30.0), ("FR", "Nuclear"): (100.0, 70.0), ("BE", "Waste"): (0.0, None)}


def test_capacity_vs_production_inner_join(spark):
    cap = spark.createDataFrame([("FR", D1, 100.0, 40.0), ("CH", D1, 50.0, 10.0)],
                                "country_code string, capacity_date date, total_installed_capacity_mw double, "
                                "renewable_capacity_percentage double")
    prod = reports.country_mix(mix(spark, [("FR", D1, 25.0, 75.0, 0.0, 0.0)]))
    rows = reports.capacity_vs_production(cap, prod).collect()
    assert [(r.country_code, r.renewable_percentage, r.renewable_gap_points) for r in rows] == [("FR", 25.0, -15.0)]


def test_country_detail_filters_and_orders(spark):
    df = mix(spark, [("FR", D2, 1.0, 0.0, 0.0, 0.0), ("FR", D1, 1.0, 0.0, 0.0, 0.0), ("BE", D1, 1.0, 0.0, 0.0, 0.0)])
    rows = reports.country_detail(df, "FR", start="2025-07-01").collect()
    assert [r.generation_date for r in rows] == [D1, D2]

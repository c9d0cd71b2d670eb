"""Property tests with generated hourly rows."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmix.contracts import GENERATION_RENAMES
from gridmix.operators import marts, staging

from .test_models import TS, a68, a71, a75

FUELS = list(GENERATION_RENAMES)[:13]
mw = st.one_of(st.none(), st.integers(min_value=0, max_value=500_000).map(lambda c: c / 100))
row = st.tuples(st.sampled_from(["FR", "BE", "PT"]), st.integers(0, 47),
                st.lists(mw, min_size=len(FUELS), max_size=len(FUELS)))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_rollup_and_mix_properties(spark, rows):
    base = dt.datetime(2025, 7, 1)
    data = [(c, base + dt.timedelta(hours=h), dict(zip(FUELS, vals))) for c, h, vals in rows]
    stg = staging.stg_generation(a75(spark, data))
    daily = marts.generation_daily(stg, exact_scale=2)
    # sum of daily energy = sum of raw hourly power (exact)
    raw = sum(v for _, _, vals in rows for v in vals if v is not None)
    per_day = sum(F.col(c) for c in daily.columns if c.endswith("_mwh"))
    rolled = daily.select(per_day.alias("e")).agg(F.sum("e")).first()[0]
    assert round(rolled, 2) == round(raw, 2)
    assert daily.agg(F.sum("hourly_records_count")).first()[0] == len(rows)
    for m in marts.energy_mix(daily).collect():
        cats = m.total_renewable_mwh + m.total_fossil_mwh + m.total_nuclear_mwh + m.total_other_mwh
        assert cats == m.total_production_mwh
        shares = [m.renewable_percentage, m.fossil_percentage, m.nuclear_percentage, m.other_percentage]
        if m.total_production_mwh == 0:
            assert shares == [None] * 4
        else:
            assert abs(sum(shares) - 100) <= 0.021


def test_null_country_is_dropped_by_not_in(spark):
    snaps = [(None, dt.datetime(2025, 1, 1), {"solar": 1.0}, TS), ("PT", dt.datetime(2025, 1, 1), {"solar": 2.0}, TS)]
    dim = spark.createDataFrame([("FR",)], "country_code string")
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(
        a71(spark, [("FR", "U1", "B14", "Nuclear", False, 1.0, "2025-01-01T00:00Z", "e")])), ordered=False)
    out = marts.renewable_capacity(staging.stg_capacity(a68(spark, snaps)), cpu, dim).collect()
    assert sorted(r.country_code for r in out) == ["FR", "PT"]


def test_per_unit_arm_is_subset_of_dimension(spark):
    from gridmix.plans.catalog import _gen_daily
    from gridmix.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    dim = marts.dim_countries(_gen_daily(spark, sf), ordered=False)
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(fx.bronze_a71(spark, sf)), 2, ordered=False)
    mix = marts.renewable_capacity(staging.stg_capacity(fx.bronze_a68(spark, sf)), cpu, dim, 2)
    dim_codes = {r.country_code for r in dim.collect()}
    per_unit_codes = {r.country_code for r in mix.where(~F.col("country_code").isin("PT", "CH")).collect()}
    assert per_unit_codes <= dim_codes

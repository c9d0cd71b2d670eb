"""DQ1-DQ5: every check can fail (one seeded violation each); NULL passes where it should."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmix.operators import quality as Q


def test_not_null_finds_seeded_null(spark):
    df = spark.createDataFrame([("FR",), (None,)], "country_code string")
    assert Q.not_null(df, "country_code").count() == 1


def test_unique_finds_duplicate_and_ignores_null(spark):
    df = spark.createDataFrame([("FR",), ("FR",), (None,), (None,), ("BE",)], "country_code string")
    rows = Q.unique(df, "country_code").collect()
    assert [(r.unique_field, r.n_records) for r in rows] == [("FR", 2)]


def test_accepted_values_reports_outsider_and_null_passes(spark):
    df = spark.createDataFrame([("FR",), ("CH",), ("CH",), (None,)], "country_code string")
    rows = Q.accepted_values(df, "country_code", ["FR", "BE"]).collect()
    assert [(r.value_field, r.n_records) for r in rows] == [("CH", 2)]


def test_relationships_reports_orphans_and_null_passes(spark):
    child = spark.createDataFrame([("FR",), ("CH",), (None,)], "country_code string")
    parent = spark.createDataFrame([("FR",), (None,)], "country_code string")
    rows = Q.relationships(child, "country_code", parent, "country_code").collect()
    assert [r.from_field for r in rows] == ["CH"]


def _models(spark, seed: str | None = None):
    daily = spark.createDataFrame([("FR", "2025-07-01"), ("BE", "2025-07-01")], "country_code string, generation_date string")
    dim = spark.createDataFrame([("FR", "France"), ("BE", "Belgium")], "country_code string, country_name string")
    mix = spark.createDataFrame([("FR", "2025-07-01", 1.0)], "country_code string, generation_date string, "
                                                             "total_production_mwh double")
    cap = spark.createDataFrame([("FR", "2025-07-01", 1.0)], "country_code string, capacity_date string, "
                                                             "total_installed_capacity_mw double")
    if seed == "unique":
        dim = dim.unionByName(spark.createDataFrame([("FR", "France")], dim.schema))
    if seed == "accepted":
        dim = dim.unionByName(spark.createDataFrame([("ZZ", "ZZ")], dim.schema))
    if seed == "not_null":
        mix = mix.unionByName(spark.createDataFrame([("BE", "2025-07-01", None)], mix.schema))
    if seed == "relationships":
        cap = cap.unionByName(spark.createDataFrame([("CH", "2025-07-01", 2.0)], cap.schema))
    return {"int_generation_daily": daily, "dim_countries": dim, "fct_energy_mix": mix,
            "fct_renewable_capacity": cap}


def test_report_has_fourteen_checks_all_passing(spark):
    rows = Q.report(_models(spark)).collect()
    assert len(rows) == 14
    assert sum(r.failures for r in rows) == 0
    kinds = sorted(r.test for r in rows)
    assert kinds.count("not_null") == 10 and kinds.count("relationships") == 2


def test_report_counts_each_seeded_violation(spark):
    expected = {
        "unique": "unique_dim_countries_country_code",
        "accepted": "accepted_values_dim_countries_country_code",
        "not_null": "not_null_fct_energy_mix_total_production_mwh",
        "relationships": "relationships_fct_renewable_capacity_country_code",
    }
    for seed, test_id in expected.items():
        failing = {r.test_id: r.failures for r in Q.report(_models(spark, seed)).collect() if r.failures}
        assert failing == {test_id: 1}, seed


def test_failing_keys_of_relationships(spark):
    rows = Q.failing_keys(_models(spark, "relationships"), "relationships").collect()
    assert [(r.test_id, r.value) for r in rows] == [("relationships_fct_renewable_capacity_country_code", "CH")]


def test_nulls_counted_while_writing(spark, scratch):
    """The write counts the failures; the report then reads none of the models for them."""
    checks = [Q.Check("not_null", "m", "a"), Q.Check("not_null", "m", "b"), Q.Check("not_null", "other", "a")]
    rows = [(None, i) if i % 3 == 0 else (str(i), None if i == 1 else i) for i in range(100)]
    for n, expected in ((100, {"not_null_m_a": 34, "not_null_m_b": 1}), (0, {"not_null_m_a": 0, "not_null_m_b": 0})):
        df = spark.createDataFrame(rows[:n], "a string, b long").repartition(7)
        observed, seen = Q.observe_nulls(df, "m", checks)
        observed.write.parquet(f"{scratch}/observed{n}")
        assert seen.get == expected
        report = Q.report({"m": spark.read.parquet(f"{scratch}/observed{n}"), "other": spark.range(0).withColumn("a", F.lit("x"))}, checks, seen.get)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert f"observed{n}" not in plan
        assert {r.test_id: r.failures for r in report.collect()} == {**expected, "not_null_other_a": 0}
    assert Q.observe_nulls(df, "unchecked", checks) == (df, None)

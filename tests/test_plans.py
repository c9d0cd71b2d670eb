"""Plan shapes: no Python UDF anywhere, the per-group limit and the broadcast semi-join in M9."""

from __future__ import annotations

import pytest

from gridmix.plans.catalog import QUERIES

from .conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "stream_append"))
def test_no_python_in_any_plan(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert not any(node in text for node in PY_NODES)


def test_renewable_capacity_plan(spark):
    df = QUERIES["renewable_capacity"](spark, SF_SMALL)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_xml_parsing_has_no_keyed_shuffle(spark):
    text = plan_text(QUERIES["a71_parse"](spark, SF_SMALL))
    # the only exchange spreads the single-row-group test table round-robin before parsing
    assert "hashpartitioning" not in text and "Generate" in text
    assert text.count("Exchange") == text.count("RoundRobinPartitioning")


def test_spread_only_when_too_few_partitions(spark):
    from gridmix.operators.joins import spread

    few = spark.range(10).coalesce(1)
    assert spread(few, 4).rdd.getNumPartitions() == 4
    many = spark.range(10).repartition(6)
    assert spread(many, 4) is many


def test_country_filter_reaches_scan(spark):
    from gridmix.operators import marts, staging
    from gridmix.sources.warehouse import Warehouse
    from pyspark.sql import functions as F

    wh = Warehouse(spark)
    bronze = spark.createDataFrame([("FR", "A75")], "country_code string, document_type string")
    path = wh.path("bronze", "plan_probe")
    bronze.write.mode("overwrite").parquet(path)
    b = spark.read.parquet(path)
    mix = marts.energy_mix(marts.generation_daily(staging.stg_generation(b)))
    text = mix.where(F.col("country_code") == "FR")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(country_code), EqualTo(country_code,FR)]" in text


def test_partial_aggregation_before_every_shuffle(spark, tmp_path):
    """A hot country must reach the shuffle pre-aggregated: each hash exchange of the
    daily rollup and the per-unit collapse sits above a partial aggregate."""
    import datetime as dt

    from gridmix.contracts import BRONZE_A71, BRONZE_A75
    from gridmix.operators import marts, staging

    gen = spark.createDataFrame([("FR", dt.datetime(2025, 7, 1, h), 1.0) for h in range(3)],
                                "country_code string, index timestamp, solar_actual_aggregated double")
    gen.write.parquet(str(tmp_path / "a75"))
    spark.createDataFrame([], BRONZE_A71).write.parquet(str(tmp_path / "a71"))
    daily = marts.generation_daily(staging.stg_generation(spark.read.schema(BRONZE_A75).parquet(str(tmp_path / "a75"))))
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(spark.read.parquet(str(tmp_path / "a71"))),
                                  ordered=False)
    for df in (daily, cpu):
        text = df._jdf.queryExecution().executedPlan().toString()
        lines = text.splitlines()
        exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert exchanges, text
        for i in exchanges:
            below = "\n".join(lines[i + 1:i + 3])
            assert "partial_" in below or "merge_" in below, text

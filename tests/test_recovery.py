"""Incremental rollup and table rebuild after runs that died, and high-water marks over partitions."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest

from gridmix.functions import taxonomy as tx
from gridmix.operators import ingest, marts, staging
from gridmix.operators.ingest import IngestWindow
from gridmix.plans import layers
from gridmix.sources.warehouse import MONTH_COL, Warehouse

from .test_warehouse import _land_generation

A75 = tx.BRONZE_TABLES["A75"]


def _ingest(spark, wh, root, days, month, now):
    _land_generation(spark, root, [("A75", "FR", dt.datetime(2025, m, d, 6), float(10 * m + d), 1.0) for m, d in days])
    last = dt.date(2025 + (month == 12), month % 12 + 1, 1)
    layers.ingest_extracts(spark, wh, root, ["FR"], ["A75"], IngestWindow(start=f"2025-{days[0][0]:02}-01", end=str(last)), now=now)


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def _full(spark, wh):
    return _rows(marts.generation_daily(staging.stg_generation(wh.read_bronze(A75, layers.BRONZE_A75)), 2))


def test_a_run_that_died_before_the_build_is_made_up_for(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    _ingest(spark, wh, f"{scratch}/l1", [(6, 15)], 6, "2026-01-01 00:00:00")
    layers.build_models(spark, wh, exact_scale=2)
    _ingest(spark, wh, f"{scratch}/l2", [(6, 20), (7, 15), (8, 15)], 8, "2026-01-02 00:00:00")  # dies here
    _ingest(spark, wh, f"{scratch}/l3", [(9, 15)], 9, "2026-01-03 00:00:00")
    assert len(wh.pending(A75)) == 2
    daily = layers.build_models(spark, wh, exact_scale=2, incremental=True)["int_generation_daily"]
    assert _rows(daily) == _full(spark, wh) and daily.count() == 5
    assert wh.pending(A75) == []


def test_a_rebuild_that_died_leaves_the_last_version(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    _ingest(spark, wh, f"{scratch}/l1", [(6, 15)], 6, "2026-01-01 00:00:00")
    first = _rows(layers.build_models(spark, wh, exact_scale=2)["int_generation_daily"])
    top = wh.path("silver", layers.DAILY_TABLE)
    os.makedirs(f"{top}/version-99999999999999999999-dead")  # no commit marker
    assert _rows(spark.table(wh.name("silver", layers.DAILY_TABLE))) == first
    _ingest(spark, wh, f"{scratch}/l2", [(6, 15), (6, 16)], 6, "2026-01-02 00:00:00")
    assert _rows(layers.build_models(spark, wh, exact_scale=2, incremental=True)["int_generation_daily"]) == _full(spark, wh)


def test_without_a_valid_version_the_table_is_rebuilt(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    _ingest(spark, wh, f"{scratch}/l1", [(6, 15), (7, 1)], 7, "2026-01-01 00:00:00")
    layers.build_models(spark, wh, exact_scale=2)
    shutil.rmtree(wh.path("silver", layers.DAILY_TABLE))
    os.makedirs(wh.path("silver", layers.DAILY_TABLE))
    assert _rows(layers.build_models(spark, wh, exact_scale=2, incremental=True)["int_generation_daily"]) == _full(spark, wh)


def test_old_versions_are_deleted(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    for i in range(4):
        wh.save_table(spark.range(i + 1), "gold", "versioned")
        assert spark.table(wh.name("gold", "versioned")).count() == i + 1
    assert len([d for d in os.listdir(wh.path("gold", "versioned")) if d.startswith("version-")]) == 2


def test_null_keys_are_refreshed(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    kind = "country_code string, index timestamp, solar_actual_aggregated double"
    wh.append_bronze(spark.createDataFrame([("FR", dt.datetime(2025, 1, 1), 1.0), ("FR", None, 7.0), (None, dt.datetime(2025, 1, 2), 5.0)], kind), A75, month_of="index")
    layers.build_models(spark, wh, exact_scale=2)
    wh.append_bronze(spark.createDataFrame([("FR", None, 3.0), ("FR", dt.datetime(2025, 2, 1), 2.0), (None, None, 1.0)], kind), A75, month_of="index")
    touched = spark.createDataFrame([("FR", "2025-02")], f"country_code string, {MONTH_COL} string")
    assert _rows(layers.build_models(spark, wh, exact_scale=2, touched=touched)["int_generation_daily"]) == _full(spark, wh)


@pytest.mark.parametrize("by_country", [True, False])
def test_marks_do_not_depend_on_partitioning(spark, scratch, by_country):
    rows = [("FR", dt.datetime(2025, 7, 1)), ("FR", dt.datetime(2025, 6, 30)), (None, dt.datetime(2025, 7, 5)), ("BE", None), ("DE", dt.datetime(2024, 12, 31)), ("DE", None)]
    df = spark.createDataFrame(rows, "country_code string, index timestamp")
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.append_bronze(df, "marks_probe", month_of="index")
    stored = wh.read_bronze("marks_probe")
    assert MONTH_COL in stored.columns
    assert _rows(ingest.high_water_marks(stored, by_country)) == _rows(ingest.high_water_marks(df, by_country))


def test_refresh_reads_the_touched_partitions_only(spark, scratch):
    from gridmix.operators.joins import in_partitions

    wh = Warehouse(spark, f"{scratch}/wh")
    wh.append_bronze(spark.createDataFrame([("FR", dt.datetime(2025, m, 1)) for m in (1, 2, 3)], "country_code string, index timestamp"), "prune_probe", month_of="index")
    touched = spark.createDataFrame([("FR", "2025-02")], f"country_code string, {MONTH_COL} string")
    plan = in_partitions(wh.read_bronze("prune_probe"), touched, ["country_code", MONTH_COL])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_unreadable_countries_do_not_stop_the_others(spark, scratch):
    root = f"{scratch}/landing"
    _land_generation(spark, root, [("A75", "FR", dt.datetime(2025, 6, 1, 6), 5.0, 1.0)])
    os.makedirs(f"{root}/document_type=A75/country_code=BE")
    with open(f"{root}/document_type=A75/country_code=BE/part-0.parquet", "wb") as f:
        f.write(b"not a parquet file")
    spark.createDataFrame([(dt.datetime(2025, 6, 1, 6), 1.0, 2.0)], "index timestamp, `Solar x` double, `Solar_X` double").write.parquet(
        f"{root}/document_type=A75/country_code=DE")
    wh = Warehouse(spark, f"{scratch}/wh")
    res = layers.ingest_extracts(spark, wh, root, ["FR", "BE", "DE"], ["A75"], IngestWindow(start="2025-06-01", end="2025-07-01"), now="2026-01-01 00:00:00")
    assert {r.country_code: (r.status, r.rows) for r in res.outcomes.collect()} == {"FR": ("updated", 1), "BE": ("failed", 0), "DE": ("failed", 0)}
    assert set(res.unreadable) == {("A75", "BE"), ("A75", "DE")} and "sanitise" in res.unreadable["A75", "DE"]

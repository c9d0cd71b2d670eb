"""STR1: the landed folder streamed into bronze exactly once per file."""

from __future__ import annotations

import datetime as dt

from gridmix.sources import landing
from gridmix.streaming import bronze_stream


def _landed(spark, day: int):
    return spark.createDataFrame(
        [("A75", c, dt.datetime(2025, 7, day, h), float(h)) for c in ("FR", "BE") for h in range(3)],
        "document_type string, country_code string, index timestamp, `Solar/Actual Aggregated` double")


def test_stream_rerun_appends_nothing_and_new_files_once(spark, scratch):
    root, out, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    landing.land_extract(_landed(spark, 1), root)
    schema = spark.read.parquet(root).schema
    run = lambda: bronze_stream.stream_to_bronze(spark, root, schema, out, ckpt,
                                                 ingestion_ts="2026-01-01 00:00:00")
    run()
    first = bronze_stream.read_stream_output(spark, out)
    assert first.count() == 6 and "solar_actual_aggregated" in first.columns
    run()
    assert bronze_stream.read_stream_output(spark, out).count() == 6
    landing.land_extract(_landed(spark, 2), root)
    run()
    assert bronze_stream.read_stream_output(spark, out).count() == 12


def test_stream_partitions_time_series_by_month(spark, scratch):
    from gridmix.plans import layers

    root, out, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    landing.land_extract(_landed(spark, 1), root)
    schema = spark.read.parquet(root).schema
    bronze_stream.stream_to_bronze(spark, root, schema, out, ckpt, ingestion_ts="2026-01-01 00:00:00",
                                   month_of="index")
    bronze = spark.read.parquet(out)
    assert {r.index_month for r in bronze.select("index_month").collect()} == {"2025-07"}
    touched = layers.touched_from_stamp(bronze, "2026-01-01 00:00:00")
    assert sorted(tuple(r) for r in touched.collect()) == [("BE", "2025-07"), ("FR", "2025-07")]


def test_stream_keeps_columns_that_differ_per_country(spark, scratch):
    import pytest

    root, out, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    for country, plants in (("FR", ["Plant A"]), ("BE", ["Plant B", "Plant C"])):
        columns = ", ".join(f"`{p}` double" for p in plants)
        landing.land_extract(spark.createDataFrame([("A73", country, dt.datetime(2025, 7, 1), *[1.0] * len(plants))],
                                                   f"document_type string, country_code string, index timestamp, {columns}"), root)
    schema = bronze_stream.landed_schema(spark, root)
    bronze_stream.stream_to_bronze(spark, root, schema, out, ckpt)
    got = {r.country_code: (r.plant_a, r.plant_b, r.plant_c) for r in bronze_stream.read_stream_output(spark, out).collect()}
    assert got == {"FR": (1.0, None, None), "BE": (None, 1.0, 1.0)}
    landing.land_extract(spark.createDataFrame([("A73", "FR", dt.datetime(2025, 7, 2), 2.0)],
                                               "document_type string, country_code string, index timestamp, `Plant D` double"), root)
    with pytest.raises(ValueError, match="Plant D"):
        bronze_stream.stream_to_bronze(spark, root, schema, out, ckpt)
    bronze_stream.stream_to_bronze(spark, root, bronze_stream.landed_schema(spark, root), out, ckpt)
    rows = bronze_stream.read_stream_output(spark, out).collect()
    assert len(rows) == 3 and {r.plant_d for r in rows} == {None, 2.0}


def _warehouse_rows(wh):
    from gridmix.functions import taxonomy as tx

    return wh.read_bronze(tx.BRONZE_TABLES["A75"])


def test_stream_and_batch_loads_share_a_bronze_table(spark, scratch):
    from gridmix.functions import taxonomy as tx
    from gridmix.operators.ingest import IngestWindow
    from gridmix.plans import layers
    from gridmix.sources.warehouse import Warehouse

    wh = Warehouse(spark, f"{scratch}/wh")
    landing.land_extract(_landed(spark, 1), f"{scratch}/batch")
    layers.ingest_extracts(spark, wh, f"{scratch}/batch", ["FR", "BE"], ["A75"], IngestWindow(start="2025-06-01", end="2025-08-01"), "2026-01-01 00:00:00")
    layers.build_daily(spark, wh)
    landing.land_extract(_landed(spark, 2), f"{scratch}/stream")
    run = lambda stamp: bronze_stream.stream_to_warehouse(wh, f"{scratch}/stream", "A75", f"{scratch}/ckpt", ingestion_ts=stamp)
    run("2026-01-02 00:00:00")
    assert _warehouse_rows(wh).count() == 12
    assert len(wh.pending(tx.BRONZE_TABLES["A75"])) == 1
    bronze_stream.forget_last_commit(spark, f"{scratch}/ckpt")  # died after the append: the batch runs again
    run("2026-01-03 00:00:00")
    rows = _warehouse_rows(wh)
    assert rows.count() == 12 and rows.where("ingestion_timestamp = '2026-01-02 00:00:00'").count() == 0
    run("2026-01-04 00:00:00")  # no new file
    assert _warehouse_rows(wh).count() == 12
    daily = layers.build_daily(spark, wh, incremental=True).select("country_code", "generation_date", "hourly_records_count").collect()
    assert sorted((r.country_code, r.generation_date.day, r.hourly_records_count) for r in daily) == [
        ("BE", 1, 3), ("BE", 2, 3), ("FR", 1, 3), ("FR", 2, 3)]


def test_the_file_sink_refuses_a_folder_of_batch_loads(spark, scratch):
    import pytest

    from gridmix.sources.warehouse import Warehouse

    wh = Warehouse(spark, f"{scratch}/wh")
    wh.append_bronze(_landed(spark, 1), "t")
    landing.land_extract(_landed(spark, 2), f"{scratch}/landing")
    with pytest.raises(ValueError, match="stream_to_warehouse"):
        bronze_stream.stream_to_bronze(spark, f"{scratch}/landing", bronze_stream.landed_schema(spark, f"{scratch}/landing"),
                                       wh.path("bronze", "t"), f"{scratch}/ckpt")
    assert wh.read_bronze("t").count() == 6


def test_an_append_repeated_under_its_id_replaces_its_own_rows(spark, scratch):
    from gridmix.sources.warehouse import Warehouse

    wh = Warehouse(spark, f"{scratch}/wh")
    rows = spark.createDataFrame([("FR", 1), ("BE", 2)], "country_code string, x int")
    wh.append_bronze(rows, "t")
    wh.append_bronze(rows, "t")
    for _ in range(2):
        wh.append_bronze(rows.where("x = 1"), "t", load_id="stream-a-0")
    assert wh.read_bronze("t").count() == 5 and "load_id" not in wh.read_bronze("t").columns
    assert [tuple(r) for r in wh.read_bronze("t", load_id="stream-a-0").select("country_code", "x").collect()] == [("FR", 1)]

"""SRC3: extracts landed as CSV with their own header rows per file."""

from __future__ import annotations

import datetime as dt

from gridmix.functions import taxonomy as tx
from gridmix.operators.ingest import IngestWindow
from gridmix.plans import layers
from gridmix.sources import landing
from gridmix.sources.warehouse import Warehouse


def _put(root, country, name, text):
    folder = root / "document_type=A75" / f"country_code={country}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


def test_each_file_has_its_own_columns_and_bad_lines_are_kept_apart(spark, tmp_path):
    _put(tmp_path, "FR", "a.csv", '﻿,Solar,"Wind ""big"", far",Solar\n,Actual Aggregated,,Actual Consumption\n'
         "2024-01-01 00:00:00+01:00,1.5,,2\r\n2024-01-01 01:00:00,1,2\n\nnever,1,2,3\n2024-01-01 02:00:00,x,2,3\n")
    _put(tmp_path, "FR", "b.csv", "index,Solar\n,Actual Consumption\n2024-01-02,7\n")
    _put(tmp_path, "DE", "one_header.csv", "index,Solar\n2024-01-02,7\n")
    _put(tmp_path, "ES", "collide.csv", ",Solar,solar\n,A,a\n2024-01-02,7,8\n")
    rows, rejected = landing.read_csv_extracts(spark, str(tmp_path), "A75")
    assert rows.columns == ["country_code", "document_type", "index", "solar_a", "solar_actual_aggregated", "solar_actual_consumption", "wind_big_far"]
    got = sorted((r.country_code, r["index"], r.solar_actual_aggregated, r.solar_actual_consumption, r.wind_big_far) for r in rows.collect())
    assert got == [("FR", dt.datetime(2023, 12, 31, 23), 1.5, 2.0, None), ("FR", dt.datetime(2024, 1, 2), None, 7.0, None)]
    bad = sorted((r.file_path.rsplit("/", 1)[1], r.reason, r.line) for r in rejected.collect())
    assert bad == [
        ("a.csv", "no timestamp", "never,1,2,3"), ("a.csv", "not a number", "2024-01-01 02:00:00,x,2,3"), ("a.csv", "wrong number of cells", "2024-01-01 01:00:00,1,2"),
        ("collide.csv", "columns collide", "2024-01-02,7,8"), ("one_header.csv", "no header", "2024-01-02,7"), ("one_header.csv", "no header", "index,Solar")]


def test_one_header_row_and_files_split_between_tasks(spark, tmp_path):
    lines = "".join(f"2024-01-{1 + i % 28:02d} 00:00:00,{i}\n" for i in range(2000))
    _put(tmp_path, "FR", "a.csv", "time,Solar power\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows, rejected = landing.read_csv_extracts(spark, str(tmp_path), "A75", header_rows=1)
        assert rows.rdd.getNumPartitions() > 3
        assert sorted(r.solar_power for r in rows.collect()) == [float(i) for i in range(2000)]
        assert rejected.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_nothing_landed_and_headers_alone(spark, tmp_path):
    assert landing.read_csv_extracts(spark, str(tmp_path), "A75") == (None, None)
    _put(tmp_path, "FR", "a.csv", ",Solar\n,Actual Aggregated\n")
    rows, rejected = landing.read_csv_extracts(spark, str(tmp_path), "A75")
    assert rows.columns[3:] == ["solar_actual_aggregated"] and rows.count() == 0 and rejected.count() == 0


def test_csv_and_parquet_load_together(spark, tmp_path):
    _put(tmp_path / "csv", "FR", "a.csv", ",Solar\n,Actual Aggregated\n2025-07-01 05:00:00,3\n2025-07-01 06:00:00,x\n")
    landing.land_extract(spark.createDataFrame([("A75", "PT", dt.datetime(2025, 7, 1, 5), 4.0)],
                                               "document_type string, country_code string, index timestamp, `Solar/Actual Aggregated` double"), f"{tmp_path}/landing")
    wh = Warehouse(spark, f"{tmp_path}/wh")
    result = layers.ingest_extracts(spark, wh, f"{tmp_path}/landing", ["FR", "PT"], ["A75"], IngestWindow(start="2025-06-01", end="2025-07-03"),
                                    now="2026-01-01 00:00:00", csv_root=f"{tmp_path}/csv")
    assert {r.country_code: r.solar_actual_aggregated for r in wh.read_bronze(tx.BRONZE_TABLES["A75"]).collect()} == {"FR": 3.0, "PT": 4.0}
    assert [(r.country_code, r.reason) for r in result.rejected.collect()] == [("FR", "not a number")]
    assert result.broken_files == {} and result.unreadable == {}

"""Sources and sinks in a scratch warehouse: SRC1, SRC3, SRC4, SNK1-SNK7, ING4-ING7, the model graph."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridmix.functions import taxonomy as tx
from gridmix.operators import quality
from gridmix.operators.ingest import IngestWindow
from gridmix.plans import layers
from gridmix.sources import landing
from gridmix.sources.warehouse import Warehouse, qualified_name

from .test_per_unit import doc, period, ts


def test_qualified_name():
    assert qualified_name("analytics_gold", "fct_energy_mix") == "analytics_gold.fct_energy_mix"
    assert qualified_name(None, "x") == "analytics.x"


def _land_generation(spark, root, rows):
    df = spark.createDataFrame(rows, "document_type string, country_code string, index timestamp, "
                                     "`Solar/Actual Aggregated` double, `Fossil Gas/Actual Aggregated` double")
    landing.land_extract(df, root)


def test_ingest_extracts_end_to_end_and_rerun(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    root = f"{scratch}/landing"
    rows = [("A75", c, dt.datetime(2025, 7, d, h), 10.0, 5.0) for c in ("FR", "BE") for d in (1, 2) for h in (0, 12)]
    _land_generation(spark, root, rows)
    window = IngestWindow(end="2025-07-03", default_start="2025-07-01")
    res = layers.ingest_extracts(spark, wh, root, ["FR", "BE", "DE"], ["A75", "A68"], window,
                                 now="2026-01-01 00:00:00")
    summary = {r.status: (r.n_keys, r.n_rows) for r in res.summary.collect()}
    # the window starts at Brussels midnight (22:00 UTC the day before): all 8 landed rows are inside
    assert summary == {"updated": (2, 8), "failed": (4, 0)}
    bronze = wh.read_bronze(tx.BRONZE_TABLES["A75"])
    assert bronze.count() == 8
    assert "solar_actual_aggregated" in bronze.columns and "ingestion_timestamp" in bronze.columns
    # second run: marks are now 2025-07-02, so the next start is 07-03 (<= end): nothing new lands
    res2 = layers.ingest_extracts(spark, wh, root, ["FR", "BE"], ["A75"], IngestWindow(end="2025-07-02"),
                                  now="2026-01-02 00:00:00")
    assert {r.status for r in res2.outcomes.collect()} == {"skipped"}
    assert wh.read_bronze(tx.BRONZE_TABLES["A75"]).count() == 8


def test_append_additive_schema(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    t = "bronze_test"
    wh.append_bronze(spark.createDataFrame([("FR", 1.0)], "country_code string, solar double"), t)
    wh.append_bronze(spark.createDataFrame([("BE", 2.0, 3.0)], "country_code string, solar double, lignite double"), t)
    wh.append_bronze(None, t)
    rows = {r.country_code: r for r in wh.read_bronze(t).collect()}
    assert rows["FR"].lignite is None and rows["BE"].lignite == 3.0


def test_missing_bronze_reads_empty_with_contract(spark, scratch):
    from gridmix.contracts import BRONZE_A75

    wh = Warehouse(spark, f"{scratch}/wh")
    df = wh.read_bronze("nothing_here", BRONZE_A75)
    assert df.count() == 0 and df.columns == [f.name for f in BRONZE_A75.fields]


def test_read_responses_with_manifest(spark, scratch):
    root = f"{scratch}/responses"
    for country, name, body in [("FR", "a.xml", doc(ts())), ("FR", "b.xml", doc(ts())),
                                ("BE", "c.xml", "<Acknowledgement_MarketDocument/>")]:
        os.makedirs(f"{root}/country_code={country}", exist_ok=True)
        with open(f"{root}/country_code={country}/{name}", "w") as fh:
            fh.write(body)
    manifest = spark.createDataFrame([("b.xml", 503)], "file_name string, http_status int")
    got = sorted((r.country_code, r.file_name, r.http_status) for r in
                 landing.read_responses(spark, root, manifest).collect())
    assert got == [("BE", "c.xml", 200), ("FR", "a.xml", 200), ("FR", "b.xml", 503)]
    wh = Warehouse(spark, f"{scratch}/wh")
    summary = {r.status: (r.n_responses, r.n_rows) for r in
               layers.ingest_per_unit(spark, wh, root, manifest, now="2026-01-01 00:00:00").collect()}
    assert summary == {"success": (1, 1), "failed": (2, 0)}
    bronze = wh.read_bronze(tx.A71_TABLE)
    assert bronze.count() == 1
    assert dict(bronze.dtypes)["is_renewable"] == "boolean"


def test_build_models_and_checks(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    root = f"{scratch}/landing"
    rows = [("A75", c, dt.datetime(2025, 7, 1, h), 10.0, 5.0) for c in ("FR", "PT") for h in range(24)]
    rows += [("A68", "PT", dt.datetime(2025, 7, 1), None, None)]
    df = spark.createDataFrame(rows, "document_type string, country_code string, index timestamp, "
                                     "`Solar/Actual Aggregated` double, `Fossil Gas/Actual Aggregated` double")
    landing.land_extract(df.where("document_type = 'A75'"), root)
    cap = spark.createDataFrame([("A68", "PT", dt.datetime(2025, 7, 1), 100.0, 50.0)],
                                "document_type string, country_code string, index timestamp, Solar double, "
                                "`Fossil Gas` double")
    landing.land_extract(cap, root)
    layers.ingest_extracts(spark, wh, root, ["FR", "PT"], ["A75", "A68"],
                           IngestWindow(start="2025-06-01", end="2025-07-03"), now="2026-01-01 00:00:00")
    units = f"{scratch}/responses/country_code=FR"
    os.makedirs(units)
    with open(f"{units}/r.xml", "w") as fh:
        fh.write(doc(ts(psr="B14", periods=[period(points=("600",))])))
    layers.ingest_per_unit(spark, wh, f"{scratch}/responses", now="2026-01-01 00:00:00")
    nulls = {}
    models = layers.build_models(spark, wh, exact_scale=2, nulls=nulls)
    mix = {r.country_code: r for r in models["fct_energy_mix"].collect()}
    assert mix["FR"].total_production_mwh == 240.0 + 120.0 and mix["FR"].renewable_percentage == 66.67
    capm = {r.country_code: r for r in models["fct_renewable_capacity"].collect()}
    assert capm["PT"].total_installed_capacity_mw == 150.0 and capm["FR"].nuclear_capacity_percentage == 100.0
    assert spark.catalog.tableExists("analytics_gold.fct_energy_mix")
    report = layers.run_checks(models, nulls=nulls)
    assert report.count() == 14
    assert sorted(nulls) == sorted(c.test_id for c in quality.CHECKS if c.test == "not_null" and c.model != "int_generation_daily")
    assert sorted(map(tuple, layers.run_checks(models).collect())) == sorted(map(tuple, report.collect()))


def test_run_checks_raises_on_failure(spark):
    from .test_quality import _models

    with pytest.raises(layers.QualityCheckFailed, match="relationships_fct_renewable_capacity_country_code=1"):
        layers.run_checks(_models(spark, "relationships"))
    assert layers.run_checks(_models(spark, "relationships"), fail=False).where(F.col("failures") > 0).count() == 1


def test_incremental_daily_refresh_equals_full_rebuild(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    root1, root2 = f"{scratch}/landing1", f"{scratch}/landing2"
    first = [("A75", c, dt.datetime(2025, m, d, h), float(m + d + h), 1.0)
             for c in ("FR", "BE") for m in (5, 6) for d in (1, 15) for h in (3, 9)]
    _land_generation(spark, root1, first)
    layers.ingest_extracts(spark, wh, root1, ["FR", "BE"], ["A75"],
                           IngestWindow(start="2025-05-01", end="2025-07-01"), now="2026-01-01 00:00:00")
    layers.build_models(spark, wh, exact_scale=2)
    # second run: new July days for FR, and a June day again for BE (no dedup: June 15 doubles for BE)
    second = [("A75", "FR", dt.datetime(2025, 7, 2, h), 5.0, 2.0) for h in range(4)]
    second += [("A75", "BE", dt.datetime(2025, 6, 15, 3), 7.0, 3.0)]
    _land_generation(spark, root2, second)
    res = layers.ingest_extracts(spark, wh, root2, ["FR", "BE"], ["A75"],
                                 IngestWindow(start="2025-06-15", end="2025-07-03"), now="2026-01-02 00:00:00")
    touched = layers.touched_from_plan(res.plan)
    assert sorted(tuple(r) for r in touched.collect()) == [
        ("BE", "2025-06"), ("BE", "2025-07"), ("FR", "2025-06"), ("FR", "2025-07")]
    stamp_touched = sorted(tuple(r) for r in layers.touched_from_stamp(
        wh.read_bronze(tx.BRONZE_TABLES["A75"]), "2026-01-02 00:00:00").collect())
    assert stamp_touched == [("BE", "2025-06"), ("FR", "2025-07")]
    incremental = layers.build_models(spark, wh, exact_scale=2, touched=touched)
    got = sorted(tuple(r) for r in incremental["int_generation_daily"].collect())
    full = Warehouse(spark, f"{scratch}/wh_full")
    full_daily = layers.build_models(spark, _copy_bronze(spark, wh, full), exact_scale=2)["int_generation_daily"]
    assert got == sorted(tuple(r) for r in full_daily.collect())
    be_june = [r for r in incremental["int_generation_daily"].collect()
               if r.country_code == "BE" and r.generation_date == dt.date(2025, 6, 15)]
    assert be_june[0].hourly_records_count == 3


def _copy_bronze(spark, src: Warehouse, dst: Warehouse) -> Warehouse:
    table = tx.BRONZE_TABLES["A75"]
    spark.read.parquet(src.path("bronze", table)).write.partitionBy("country_code", "index_month") \
        .parquet(dst.path("bronze", table))
    return dst


def test_refresh_scan_is_partition_pruned(spark, scratch):
    from gridmix.sources.warehouse import MONTH_COL

    wh = Warehouse(spark, f"{scratch}/wh")
    rows = spark.createDataFrame([("FR", dt.datetime(2025, m, 1), float(m)) for m in (1, 2, 3)],
                                 "country_code string, index timestamp, solar_actual_aggregated double")
    wh.append_bronze(rows, tx.BRONZE_TABLES["A75"], month_of="index")
    wh.create_layers()
    from gridmix.contracts import BRONZE_A75
    from gridmix.operators import marts, staging

    full = marts.generation_daily(staging.stg_generation(wh.read_bronze(tx.BRONZE_TABLES["A75"], BRONZE_A75)))
    wh.save_table(full, "silver", layers.DAILY_TABLE)
    touched = spark.createDataFrame([("FR", "2025-02")], f"country_code string, {MONTH_COL} string")
    out = layers.refresh_daily(spark, wh, touched)
    assert sorted((r.generation_date, r.solar_mwh) for r in out.collect()) == [
        (dt.date(2025, 1, 1), 1.0), (dt.date(2025, 2, 1), 2.0), (dt.date(2025, 3, 1), 3.0)]
    b = wh.read_bronze(tx.BRONZE_TABLES["A75"], BRONZE_A75)
    key = F.concat_ws("|", F.col("country_code"), F.col(MONTH_COL)).isin(["FR|2025-02"])
    text = b.where(key)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "index_month" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_run_all_twice(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    root = f"{scratch}/landing"
    rows = [("A75", c, dt.datetime(2025, 7, 1, h), 10.0, 5.0) for c in ("FR", "BE") for h in range(24)]
    _land_generation(spark, root, rows)
    first = layers.run_all(spark, wh, root, ["FR", "BE"], ["A75"], IngestWindow(end="2025-07-02",
                           default_start="2025-07-01"), exact_scale=2, now="2026-01-01 00:00:00")
    # the window ends at Brussels midnight, 22:00 UTC: hours 22 and 23 of each country wait for the next run
    assert {r.status: r.n_rows for r in first.ingest.summary.collect()} == {"updated": 44}
    mix1 = sorted(tuple(r) for r in first.models["fct_energy_mix"].collect())
    assert len(mix1) == 2 and first.checks.where(F.col("failures") > 0).count() == 0
    # quirk 5: the next run starts the day after the mark (07-02) and ends at 07-02, an empty
    # window; the fetch finds nothing (failed, 0 rows) and hours 22-23 of 07-01 are never loaded
    second = layers.run_all(spark, wh, root, ["FR", "BE"], ["A75"], IngestWindow(end="2025-07-02",
                            default_start="2025-07-01"), exact_scale=2, now="2026-01-02 00:00:00")
    assert {(r.status, r.rows) for r in second.ingest.outcomes.collect()} == {("failed", 0)}
    assert sorted(tuple(r) for r in second.models["fct_energy_mix"].collect()) == mix1


def test_landing_types_with_clashing_raw_names(spark, scratch):
    root = f"{scratch}/landing"
    gen = spark.sql("SELECT 'A75' AS document_type, 'FR' AS country_code, TIMESTAMP '2025-07-01 10:00:00' AS index, "
                    "named_struct('Actual Aggregated', 5.0D) AS Solar")
    cap = spark.sql("SELECT 'A68' AS document_type, 'FR' AS country_code, TIMESTAMP '2025-07-01 00:00:00' AS index, "
                    "7.0D AS Solar")
    landing.land_extract(gen, root)
    landing.land_extract(cap, root)
    assert landing.read_extracts(spark, root, "A75").first().Solar["Actual Aggregated"] == 5.0
    assert landing.read_extracts(spark, root, "A68").first().Solar == 7.0
    assert landing.read_extracts(spark, root, "A73") is None
    wh = Warehouse(spark, f"{scratch}/wh")
    res = layers.ingest_extracts(spark, wh, root, ["FR"], ["A75", "A68", "A73"],
                                 IngestWindow(start="2025-07-01", end="2025-07-02"), now="2026-01-01 00:00:00")
    out = {r.document_type: (r.status, r.rows) for r in res.outcomes.collect()}
    assert out == {"A75": ("updated", 1), "A68": ("updated", 1), "A73": ("failed", 0)}
    assert wh.read_bronze(tx.BRONZE_TABLES["A75"]).first().solar_actual_aggregated == 5.0
    assert wh.read_bronze(tx.BRONZE_TABLES["A68"]).first().solar == 7.0


def test_first_run_with_generation_only(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    root = f"{scratch}/landing"
    _land_generation(spark, root, [("A75", "FR", dt.datetime(2025, 7, 1, h), 1.0, 1.0) for h in range(3)])
    res = layers.run_all(spark, wh, root, ["FR"], ["A75", "A68"], IngestWindow(start="2025-07-01", end="2025-07-02"),
                         exact_scale=2, now="2026-01-01 00:00:00")
    assert res.models["fct_energy_mix"].count() == 1
    assert res.models["fct_capacity_per_unit"].count() == 0
    assert res.models["fct_renewable_capacity"].count() == 0
    assert {r.document_type: r.status for r in res.ingest.outcomes.collect()} == {"A75": "updated", "A68": "failed"}


def _broken_page(folder):
    """Overwrite data pages of the first Parquet file of a folder; its footer stays sound."""
    name = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    path = f"{folder}/{name}"
    with open(path, "r+b") as fh:
        size = os.path.getsize(path)
        fh.seek(size - 4 - 4)
        footer = int.from_bytes(fh.read(4), "little")
        fh.seek(4)
        fh.write(b"\xff" * (size - 8 - footer - 4))
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    return name


def test_a_broken_data_page_costs_its_file_only(spark, scratch):
    root = f"{scratch}/landing"
    for day in (1, 2):  # a file a day and country
        _land_generation(spark, root, [("A75", "FR", dt.datetime(2025, 7, day, h), 10.0, 5.0) for h in range(4)])
    _land_generation(spark, root, [("A75", "BE", dt.datetime(2025, 7, 1, h), 10.0, 5.0) for h in range(4)])
    _land_generation(spark, root, [("A68", "FR", dt.datetime(2025, 7, 1), 1.0, 1.0)])
    before = spark.read.parquet(f"{root}/document_type=A75/country_code=FR").count()
    name = _broken_page(f"{root}/document_type=A75/country_code=FR")
    wh = Warehouse(spark, f"{scratch}/wh")
    res = layers.ingest_extracts(spark, wh, root, ["FR", "BE"], ["A75", "A68"], IngestWindow(start="2025-06-01", end="2025-08-01"), now="2026-01-01 00:00:00")
    (path, why), = res.broken_files.items()
    assert path.endswith(name) and why.startswith("0 of ") and res.unreadable == {}
    lost = int(why.split(" of ")[1].split()[0])
    counts = {(r.country_code, r.document_type): (r.status, r.rows) for r in res.outcomes.collect()}
    assert counts == {("FR", "A75"): ("updated", before - lost), ("BE", "A75"): ("updated", 4), ("FR", "A68"): ("updated", 1), ("BE", "A68"): ("failed", 0)}


def test_per_unit_run_with_requested_skipped_and_missing_countries(spark, scratch):
    root = f"{scratch}/responses"
    rows = [("FR", 200, doc(ts(), ts(unit="U2"))), ("FR", 503, "busy"), ("BE", 200, "<Acknowledgement_MarketDocument/>"), ("CH", 200, doc(ts(unit="U3"))),
            ("ES", 200, doc("<Wrapped>" + ts(unit="U4", periods=["<In>" + period(points=("1", "2")) + "</In>"]) + "</Wrapped>").replace("><", ">\n<"))]
    landing.land_responses(spark.createDataFrame(rows, "country_code string, http_status int, body string"), root)
    wh = Warehouse(spark, f"{scratch}/wh")
    res = layers.load_per_unit(spark, wh, root, ["FR", "BE", "DE", "CH"], now="2026-01-01 00:00:00", one_per_line=True)
    assert sorted(map(tuple, res.outcomes.collect())) == [("BE", "failed", 1, 0), ("CH", "skipped", 0, 0), ("DE", "missing", 0, 0), ("FR", "success", 2, 2)]
    assert {r.status: (r.n_countries, r.n_responses, r.n_rows) for r in res.summary.collect()} == {
        "failed": (1, 1, 0), "skipped": (1, 0, 0), "missing": (1, 0, 0), "success": (1, 2, 2)}
    bronze = wh.read_bronze(tx.A71_TABLE)
    assert sorted(r.unit_id for r in bronze.collect()) == ["U1", "U2"]
    again = layers.load_per_unit(spark, wh, root, ["ES"], now="2026-01-02 00:00:00", one_per_line=True)
    assert [r.installed_capacity_mw for r in wh.read_bronze(tx.A71_TABLE, load_id=again.load_id).orderBy("installed_capacity_mw").collect()] == [1.0, 2.0]
    assert not wh._list(f"{wh.root}/_staged")


def _land_many(spark, root, monkeypatch):
    """200 documents of ``FR`` and 100 of ``BE`` from one task, at most 60 a file; the texts as landed."""
    monkeypatch.setattr(landing, "LANDED_DOCUMENTS", 60, raising=False)
    rows = [("FR" if k % 3 else "BE", 503 if k == 7 else 200, "busy" if k == 7 else doc(ts(unit=f"U{k}")).replace("><", ">\n<")) for k in range(300)]
    df = spark.createDataFrame(rows, "country_code string, http_status int, body string").coalesce(1)
    landing.land_responses(df, root)
    return [(c, s, b.replace("\n", " ")) for c, s, b in rows]


def test_landed_responses_are_compressed_files_of_bounded_size(spark, scratch, monkeypatch):
    import gzip
    from pathlib import Path

    root = f"{scratch}/responses"
    landed = _land_many(spark, root, monkeypatch)
    files = list(Path(root).rglob("part-*"))
    texts = [gzip.decompress(p.read_bytes()).decode() for p in files]
    assert sorted(len(t.splitlines()) for t in texts) == [1, 19, 40, 60, 60, 60, 60]
    assert 5 * sum(p.stat().st_size for p in files) < sum(map(len, texts))
    back = landing.read_responses(spark, root, one_per_line=True).select("country_code", "http_status", "body").collect()
    assert sorted(map(tuple, back)) == sorted(landed)
    wh = Warehouse(spark, f"{scratch}/wh")
    layers.load_per_unit(spark, wh, root, ["FR", "BE"], now="2026-01-01 00:00:00", one_per_line=True)
    assert sorted(r.unit_id for r in wh.read_bronze(tx.A71_TABLE).collect()) == sorted(f"U{k}" for k in range(300) if k != 7)


def test_outcomes_count_every_document_of_compressed_responses(spark, scratch, monkeypatch):
    root = f"{scratch}/responses"
    landed = _land_many(spark, root, monkeypatch)
    held = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)
    assert 4 * held < sum(len(b) for _, _, b in landed)  # with checksum files
    res = layers.load_per_unit(spark, Warehouse(spark, f"{scratch}/wh"), root, ["FR", "BE", "DE", "CH"], now="2026-01-01 00:00:00", one_per_line=True)
    assert sorted(map(tuple, res.outcomes.collect())) == [("BE", "success", 100, 100), ("CH", "skipped", 0, 0), ("DE", "missing", 0, 0),
                                                          ("FR", "success", 200, 199)]


def test_a_response_is_parsed_once(spark):
    from gridmix.operators import per_unit

    df = spark.createDataFrame([("FR", 200, doc(ts()))], "country_code string, http_status int, body string")
    plan = per_unit.with_series(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 2  # by children, and for wrapped documents by descendants; never again for the count


def test_silver_views_live_in_the_catalogue(spark, scratch):
    from gridmix.contracts import BRONZE_A75
    from gridmix.operators import staging
    from gridmix.session import configure

    wh = Warehouse(spark, f"{scratch}/wh", {"bronze": "b_views", "silver": "s_views", "gold": "g_views"})
    for solar in (1.0, 2.0):
        wh.append_bronze(spark.createDataFrame([("FR", "A75", dt.datetime(2025, 7, 1), dt.datetime(2025, 7, 1), solar)],
                                               "country_code string, document_type string, ingestion_timestamp timestamp, index timestamp, solar_actual_aggregated double"),
                         "gen", BRONZE_A75, month_of="index")
    wh.create_view("silver", "stg", staging.sql_generation(wh.register_bronze("gen", BRONZE_A75, month_of="index")))
    rows = configure(spark.newSession()).table("s_views.stg")
    direct = staging.stg_generation(wh.read_bronze("gen", BRONZE_A75))
    assert rows.columns == direct.columns and sorted(map(str, rows.collect())) == sorted(map(str, direct.collect()))
    assert wh.register_bronze("never_loaded", BRONZE_A75) and spark.table("b_views.never_loaded").count() == 0
    for layer, value in (("silver", 1), ("gold", 2)):  # views of one name in two layers
        wh.create_view(layer, "same", f"SELECT {value} AS x")
    assert (spark.table("s_views.same").first().x, spark.table("g_views.same").first().x) == (1, 2)


def test_per_unit_state_reads_only_new_loads(spark, scratch):
    from gridmix.contracts import BRONZE_A71
    from gridmix.operators import marts, staging

    def load(number, units):
        rows = spark.createDataFrame(
            [("FR", u, mw, "Solar", True, f"2025-0{m}-01", f"2025-0{m}-28") for u, mw, m in units],
            "country_code string, unit_id string, installed_capacity_mw double, energy_type string, is_renewable boolean, period_start string, period_end string")
        wh.append_bronze(rows, tx.A71_TABLE, BRONZE_A71, load_id=number)
        return rows

    def values(df):
        return sorted(map(tuple, df.collect()))

    wh = Warehouse(spark, f"{scratch}/wh")
    assert values(layers.refresh_capacity_per_unit(wh, 2)) == []  # no table yet
    first = load("01", [("a", 1.5, 1), ("b", 2.0, 1), (None, 3.0, 2)])
    layers.refresh_capacity_per_unit(wh, 2)
    other = load("01", [("z", 99.0, 9)])  # what the state holds is not read again
    second = load("1", [("a", 4.0, 1), ("c", None, 3)])
    want = values(marts.capacity_per_unit(staging.stg_capacity_per_unit(first.unionByName(second)), 2))
    assert want[0][3:5] == (10.5, 3)
    assert values(layers.refresh_capacity_per_unit(wh, 2)) == want
    assert values(layers.refresh_capacity_per_unit(wh, 2)) == want  # nothing new
    load("1", [("a", 4.0, 1), ("c", None, 3)])  # a load that runs again under its id
    assert values(layers.refresh_capacity_per_unit(wh, 2)) == want
    anew = values(marts.capacity_per_unit(staging.stg_capacity_per_unit(other.unionByName(second)), 2))
    assert values(layers.refresh_capacity_per_unit(wh, 2, incremental=False)) == anew

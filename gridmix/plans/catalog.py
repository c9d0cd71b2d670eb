"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Inputs are the bronze-shaped adapters of ``gridmix.sources.fixtures`` over
the whole test tables; the work is done by the library's operators.  Sums use
fixed-point totals at 2 decimals (``EXACT``) so that results are exact and
independent of partial-aggregate merge order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.functions import exprs as X
from gridmix.functions.taxonomy import DOMAIN_CODES
from gridmix.operators import ingest, marts, per_unit, quality, reports, staging
from gridmix.operators.joins import freeze, spread
from gridmix.session import configure
from gridmix.sources import fixtures as fx

EXACT = 2

Query = Callable[[SparkSession, str], DataFrame]


def _gen_daily(spark: SparkSession, sf_dir: str, long: bool = False, reused: bool = False) -> DataFrame:
    """The daily rollup; ``reused`` checkpoints it (one row per country and day)
    when several models of one query read it, as the warehouse run writes it once."""
    bronze = fx.bronze_a75_long(spark, sf_dir) if long else fx.bronze_a75(spark, sf_dir)
    daily = marts.generation_daily(staging.stg_generation(bronze), exact_scale=EXACT)
    return freeze(daily) if reused else daily


def q_staging_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: staged hourly generation."""
    configure(spark)
    return staging.stg_generation(fx.bronze_a75(spark, sf_dir))


def q_staging_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: staged capacity snapshots."""
    configure(spark)
    return staging.stg_capacity(fx.bronze_a68(spark, sf_dir))


def q_staging_capacity_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: staged per-unit capacity (bronze enriched by PRJ11)."""
    configure(spark)
    return staging.stg_capacity_per_unit(fx.bronze_a71(spark, sf_dir))


def q_staging_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: staged per-plant output, plant columns sanitised on load and passed through."""
    configure(spark)
    return staging.stg_forecast(fx.bronze_a73(spark, sf_dir))


def q_generation_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: daily energy per country."""
    configure(spark)
    return _gen_daily(spark, sf_dir)


def q_dim_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: country dimension, ordered by code."""
    configure(spark)
    return marts.dim_countries(_gen_daily(spark, sf_dir))


def q_energy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: daily energy mix per country (the flagship query)."""
    configure(spark)
    return marts.energy_mix(_gen_daily(spark, sf_dir))


def q_capacity_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: capacity by country and energy type, ordered by country then capacity."""
    configure(spark)
    return marts.capacity_per_unit(staging.stg_capacity_per_unit(fx.bronze_a71(spark, sf_dir)),
                                   exact_scale=EXACT)


def renewable_capacity_from(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    per_unit = marts.capacity_per_unit(staging.stg_capacity_per_unit(fx.bronze_a71(spark, sf_dir)),
                                       exact_scale=EXACT, ordered=False)
    daily = daily if daily is not None else _gen_daily(spark, sf_dir)
    dim = freeze(marts.dim_countries(daily, ordered=False))
    return marts.renewable_capacity(staging.stg_capacity(fx.bronze_a68(spark, sf_dir)), per_unit, dim,
                                    exact_scale=EXACT)


def q_renewable_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: capacity mix per country from snapshots and per-unit documents."""
    configure(spark)
    return renewable_capacity_from(spark, sf_dir)


# ---------------------------------------------------------------------------
# Per-unit documents
# ---------------------------------------------------------------------------

def q_a71_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 + FLT5: parse every landed data document into per-point rows."""
    configure(spark)
    responses = per_unit.classify_responses(spread(fx.a71_responses(spark, sf_dir)))
    return per_unit.parse_documents(responses.where(F.col("response_class") == "data"))


def q_a71_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING5: classify -> parse -> enrich, the rows appended to per-unit bronze."""
    configure(spark)
    return per_unit.ingest_responses(spread(fx.a71_responses(spark, sf_dir)), ingestion_ts=fx.INGESTION_TS)


def q_a71_response_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT5 / S16: landed responses per country and class."""
    configure(spark)
    classified = per_unit.classify_responses(fx.a71_responses(spark, sf_dir))
    return classified.groupBy("country_code", "response_class").agg(F.count(F.lit(1)).alias("n_responses"))


def q_a71_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING6 / ING7 for per-unit responses: responses and rows per outcome."""
    configure(spark)
    outcomes = per_unit.response_outcomes(spread(fx.a71_responses(spark, sf_dir)))
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n_responses"),
                                          F.sum("rows").cast("long").alias("n_rows"))


def q_a71_parse_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 with descendant search: several series, periods and points per document, all below other elements."""
    configure(spark)
    return per_unit.parse_nested(fx.a71_nested_responses(spark, sf_dir))  # dealt out by order already


def q_a71_series_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4 / SRC7 at size: large response files split by element over tasks, a truncated file left out as a whole."""
    from gridmix.sources import landing

    configure(spark)
    root = f"{_run_folder(spark, 'a71_series_scan')}/responses"
    fx.land_a71_files(spark, sf_dir, root)
    return per_unit.series_rows(landing.read_series(spark, root, complete_only=True))


def _per_unit_run(spark: SparkSession, sf_dir: str):
    """SRC4, SNK2, ING5: landed responses loaded into a warehouse.  Of the requested countries PT landed nothing and CH has no domain code; NL landed, but is not requested."""
    from gridmix.plans import layers
    from gridmix.sources import landing
    from gridmix.sources.warehouse import Warehouse

    configure(spark)
    run = _run_folder(spark, "responses_to_bronze")
    landing.land_responses(fx.a71_responses(spark, sf_dir).where("country_code <> 'PT'"), f"{run}/responses")
    wh = Warehouse(spark, f"{run}/warehouse")
    result = layers.load_per_unit(spark, wh, f"{run}/responses", [c for c in fx.COUNTRIES_10 if c != "NL"], now=fx.INGESTION_TS, one_per_line=True)
    return wh, result


def q_responses_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4 + SNK2 + ING5: landed response files -> one parse -> per-unit bronze, read back."""
    from gridmix.contracts import BRONZE_A71
    from gridmix.functions import taxonomy as tx

    wh, _ = _per_unit_run(spark, sf_dir)
    return wh.read_bronze(tx.A71_TABLE, BRONZE_A71)


def q_per_unit_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT7 + ING6 + ING7: each requested country of that run as success, failed, missing or skipped."""
    return _per_unit_run(spark, sf_dir)[1].outcomes


# Run parameters of the per-unit request plan: an end without a start, so
# the rule requests January 1 of the run's year up to the run time.
A71_NOW = "2026-03-13 06:00:00"


def q_a71_request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING3 / FLT7 / S19 / S21: request windows for every country with landed
    per-unit responses or capacity snapshots; countries without a domain code
    (CH in the snapshots) are skipped."""
    configure(spark)
    countries = fx.a71_responses(spark, sf_dir).select("country_code") \
        .unionByName(fx.bronze_a68(spark, sf_dir).select("country_code"))
    return per_unit.request_plan(countries, None, "2026-02-01", A71_NOW)


# ---------------------------------------------------------------------------
# Ingestion
# ---------------------------------------------------------------------------

# Parameters of the incremental run planned by ``ingest_window_plan``.
PLAN_WINDOW = ingest.IngestWindow(end="2024-01-20", default_start="2024-01-01")
# Parameters of the explicit backfill of ``ingest_append``.
BACKFILL_WINDOW = ingest.IngestWindow(start="1995-01-01", end="2001-06-30")
# Parameters of the incremental run summarised by ``ingest_summary``.
SUMMARY_WINDOW = ingest.IngestWindow(end="2001-06-30", default_start="1995-01-01")
DOCUMENTS = ["A75", "A73", "A68"]
LOAD_TS = "2026-03-14 06:00:00"


def q_sanitized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ6 / PRJ7 / S15 as column expressions over raw names."""
    configure(spark)
    part = fx.table(spark, sf_dir, "part")
    raw = F.concat_ws("/", "p_name", "p_brand")
    return part.select(
        "p_partkey", raw.alias("raw_name"), X.sanitize_name(raw).alias("column_name"),
        X.sanitize_name(X.flatten_name("p_type", "p_brand")).alias("flat_name"))


def q_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7: last loaded day per bronze table and country."""
    configure(spark)
    return ingest.marks_by_document({"A75": fx.bronze_a75(spark, sf_dir), "A73": fx.bronze_a73(spark, sf_dir),
                                     "A68": fx.bronze_a68(spark, sf_dir)})


def q_high_water_mark_a71(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8: last period start per country in per-unit bronze."""
    configure(spark)
    return ingest.high_water_marks_per_unit(fx.bronze_a71(spark, sf_dir))


def q_ingest_window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING1 / ING2 / JN4 / FLT6 / SRC6 / S19: incremental window per key."""
    configure(spark)
    a75, a73, a68 = fx.bronze_a75(spark, sf_dir), fx.bronze_a73(spark, sf_dir), fx.bronze_a68(spark, sf_dir)
    countries = a75.select("country_code").unionByName(a73.select("country_code")) \
        .unionByName(a68.select("country_code"))
    marks = ingest.marks_by_document({"A75": a75, "A73": a73, "A68": a68})
    return ingest.window_plan(ingest.plan_keys(countries, DOCUMENTS), marks, PLAN_WINDOW)


# Explicit window from a winter date to a summer date (both DST offsets).
BOUNDS_WINDOW = ingest.IngestWindow(start="2024-01-15", end="2024-07-15")


def q_window_bounds_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6 / S19: request bounds of every landed key in UTC and as API parameters.

    The window opens in winter (UTC+1 in the market zone) and closes in
    summer (UTC+2), so both offsets are applied.
    """
    configure(spark)
    keys = (fx.bronze_a75(spark, sf_dir).select("country_code", "document_type")
            .unionByName(fx.bronze_a68(spark, sf_dir).select("country_code", "document_type")).distinct())
    plan = ingest.window_plan(keys, None, BOUNDS_WINDOW)
    return plan.select("country_code", "document_type", "start_date", "end_date", "request_start_utc",
                       "request_end_utc", "period_start_param", "period_end_param")


def q_ingest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING4 / SNK1 / PRJ6 / PRJ7 / PRJ10 / PRJ12: bronze after an explicit backfill.

    Existing bronze predates the consumption columns; the landed extract has
    two-level raw names.  The batch is planned, filtered to its window,
    renamed and stamped, then appended with an additive schema.  The result
    is the appended table's contents, computed in memory; the Parquet
    writer (``Warehouse.append_bronze``) is exercised by the warehouse tests.
    Rows outside the window are not loaded, and the old rows read NULL in
    the columns the load adds.
    """
    configure(spark)
    existing = fx.bronze_a75_before_consumption(spark, sf_dir)
    landed = fx.landed_a75(fx.bronze_a75_long(spark, sf_dir))
    plan = freeze(ingest.window_plan(ingest.plan_keys(landed, ["A75"]), None, BACKFILL_WINDOW))
    return ingest.append(existing, ingest.load_batch(landed, plan, LOAD_TS))


def q_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ12 + M1 over grown bronze: the backfilled rows bring consumption
    columns the older rows lack; staging reads those as NULL."""
    configure(spark)
    return staging.stg_generation(q_ingest_append(spark, sf_dir))


def q_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING6 / ING7 / AGG9: outcome counts of one incremental run (loads computed in memory).

    Generation bronze already holds a month; generation and capacity extracts
    are landed, per-plant output is not.
    """
    configure(spark)
    existing = {"A75": fx.bronze_a75(spark, sf_dir)}
    landed = {"A75": fx.landed_a75(fx.bronze_a75_long(spark, sf_dir)),
              "A68": fx.landed_a68(fx.bronze_a68(spark, sf_dir))}
    countries = existing["A75"].select("country_code")
    for df in landed.values():
        countries = countries.unionByName(df.select("country_code"))
    plan = freeze(ingest.window_plan(ingest.plan_keys(countries, DOCUMENTS), ingest.marks_by_document(existing),
                                     SUMMARY_WINDOW))
    batches = [ingest.load_batch(df, plan, LOAD_TS) for df in landed.values()]
    return ingest.summary(ingest.load_outcomes(plan, batches))


def q_table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK8 / SRC5: bronze table and extract kind of every landed document type."""
    configure(spark)
    docs = (fx.bronze_a75(spark, sf_dir).select("document_type")
            .unionByName(fx.bronze_a73(spark, sf_dir).select("document_type"))
            .unionByName(fx.bronze_a68(spark, sf_dir).select("document_type"))
            .unionByName(fx.a71_responses(spark, sf_dir).select(F.lit("A71").alias("document_type"))))
    counted = docs.groupBy("document_type").agg(F.count(F.lit(1)).alias("n_rows"))
    kind = ingest.extract_kind(F.col("document_type"))
    return counted.select("document_type", X.bronze_table_name("document_type").alias("table_name"),
                          kind.alias("extract_kind"), kind.isNotNull().alias("supported"), "n_rows")


def q_country_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT7: requested countries with a domain code are fetched, others skipped."""
    configure(spark)
    requested = fx.bronze_a68(spark, sf_dir).select("country_code").distinct()
    domain = X.lookup(DOMAIN_CODES, "country_code")
    return requested.select("country_code", domain.alias("domain_code"),
                            F.when(domain.isNull(), F.lit("skipped")).otherwise(F.lit("requested")).alias("status"))


def q_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1: stream landed per-plant extracts into bronze, then rerun the stream.

    The extracts are landed as files under the shared checkpoint folder; the
    stream (available-now trigger) sanitises names and stamps lineage.  The
    second run finds no new file and appends nothing, so the result holds
    each landed row exactly once.
    """
    import uuid

    from gridmix.session import shared_dir
    from gridmix.sources import landing
    from gridmix.streaming import bronze_stream

    configure(spark)
    run = shared_dir(spark, "stream_append", uuid.uuid4().hex)
    landed = fx.landed_a73(spark, sf_dir).drop("ingestion_timestamp")
    landing.land_extract(landed, f"{run}/landing")
    schema = bronze_stream.landed_schema(spark, f"{run}/landing")
    for _ in range(2):
        bronze_stream.stream_to_bronze(spark, f"{run}/landing", schema, f"{run}/bronze", f"{run}/checkpoint",
                                       ingestion_ts=fx.INGESTION_TS)
    return bronze_stream.read_stream_output(spark, f"{run}/bronze")


# ---------------------------------------------------------------------------
# The warehouse path: files landed, appended, read back, refreshed
# ---------------------------------------------------------------------------

def _run_folder(spark: SparkSession, name: str) -> str:
    import uuid

    from gridmix.session import shared_dir

    return shared_dir(spark, name, uuid.uuid4().hex)


def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 + SNK1 + SNK3: two appends of growing schema and a skipped missing frame, read back from bronze."""
    from gridmix.contracts import BRONZE_A75
    from gridmix.sources.warehouse import MONTH_COL, Warehouse

    configure(spark)
    wh = Warehouse(spark, _run_folder(spark, "bronze_roundtrip"))
    rows = fx.bronze_a75(spark, sf_dir)
    early = F.dayofmonth("index") <= 15
    wh.append_bronze(fx.bronze_a75_before_consumption(spark, sf_dir).where(early), "bronze_a75", BRONZE_A75, month_of="index")
    wh.append_bronze(None, "bronze_a75", BRONZE_A75)
    wh.append_bronze(rows.where(~early), "bronze_a75", BRONZE_A75, month_of="index")
    return staging.stg_generation(wh.read_bronze("bronze_a75", BRONZE_A75).drop(MONTH_COL))


def q_high_water_mark_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7 over bronze stored by country and month: only the latest partitions are scanned."""
    from gridmix.contracts import BRONZE_A75
    from gridmix.sources.warehouse import Warehouse

    configure(spark)
    wh = Warehouse(spark, _run_folder(spark, "high_water_mark_partitioned"))
    wh.append_bronze(fx.bronze_a75_long(spark, sf_dir), "bronze_a75", BRONZE_A75, month_of="index")
    return ingest.high_water_marks(wh.read_bronze("bronze_a75", BRONZE_A75))


def q_daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, ING4, SNK5, M5: a full build, a run that stops before its build, and an incremental run.

    Every third month goes to one of three landings; the last build must
    hold the months of all of them.
    """
    from gridmix.plans import layers
    from gridmix.sources import landing
    from gridmix.sources.warehouse import Warehouse

    configure(spark)
    run = _run_folder(spark, "daily_refresh")
    wh = Warehouse(spark, f"{run}/warehouse")
    landed = fx.landed_a75(fx.bronze_a75_long(spark, sf_dir))
    window = ingest.IngestWindow(start="1990-01-01", end="2005-01-01")
    for k in range(3):
        landing.land_extract(landed.where(F.month("index") % 3 == k), f"{run}/landing{k}")
        layers.ingest_extracts(spark, wh, f"{run}/landing{k}", fx.COUNTRIES_10, ["A75"], window, f"2026-01-0{k + 1} 00:00:00")
        if k == 0:
            layers.build_daily(spark, wh, EXACT)
    return layers.build_daily(spark, wh, EXACT, incremental=True)


def q_stream_into_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1, SNK1, M5: batch loads and a stream on one bronze table.

    A batch load and a full build, two streamed landings, the last micro-batch
    run a second time (as after a failure before its commit), an incremental build.
    """
    from gridmix.plans import layers
    from gridmix.sources import landing
    from gridmix.sources.warehouse import Warehouse
    from gridmix.streaming import bronze_stream

    configure(spark)
    run = _run_folder(spark, "stream_into_warehouse")
    wh = Warehouse(spark, f"{run}/warehouse")
    landed = fx.landed_a75(fx.bronze_a75_long(spark, sf_dir))
    landing.land_extract(landed.where(F.month("index") % 3 == 0), f"{run}/extracts")
    layers.ingest_extracts(spark, wh, f"{run}/extracts", fx.COUNTRIES_10, ["A75"],
                           ingest.IngestWindow(start="1990-01-01", end="2005-01-01"), "2026-01-01 00:00:00")
    layers.build_daily(spark, wh, EXACT)
    for k in (1, 2):
        landing.land_extract(landed.where(F.month("index") % 3 == k), f"{run}/stream")
        bronze_stream.stream_to_warehouse(wh, f"{run}/stream", "A75", f"{run}/checkpoint", ingestion_ts=f"2026-01-0{k + 1} 00:00:00")
    bronze_stream.forget_last_commit(spark, f"{run}/checkpoint")
    bronze_stream.stream_to_warehouse(wh, f"{run}/stream", "A75", f"{run}/checkpoint", ingestion_ts="2026-01-04 00:00:00")
    return layers.build_daily(spark, wh, EXACT, incremental=True)


def q_capacity_per_unit_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 from its stored state: one load, a refresh, two more loads (one written twice under its id), a refresh that reads only those."""
    from gridmix.contracts import BRONZE_A71
    from gridmix.functions import taxonomy as tx
    from gridmix.plans import layers
    from gridmix.sources.warehouse import Warehouse

    configure(spark)
    wh = Warehouse(spark, f"{_run_folder(spark, 'capacity_per_unit_refresh')}/warehouse")
    rows = freeze(fx.bronze_a71(spark, sf_dir))
    third = F.pmod(F.xxhash64("unit_id", "period_start"), F.lit(3))
    for number in (0, 1, 2, 2):
        wh.append_bronze(rows.where(third == number), tx.A71_TABLE, BRONZE_A71, load_id=f"load-{number}")
        if number == 0:
            layers.refresh_capacity_per_unit(wh, EXACT)
    return layers.refresh_capacity_per_unit(wh, EXACT)


def q_landed_mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, PRJ7, ING4: two-level, flat and whole-number extracts of one type, loaded together."""
    from gridmix.contracts import BRONZE_A75, GENERATION_RENAMES
    from gridmix.plans import layers
    from gridmix.sources import landing
    from gridmix.sources.warehouse import MONTH_COL, Warehouse

    configure(spark)
    run = _run_folder(spark, "landed_mixed_shapes")
    rows = fx.bronze_a75(spark, sf_dir).drop("ingestion_timestamp")
    flat = [c.replace("_", " ").title() for c in GENERATION_RENAMES]
    whole = F.col("country_code").isin("DE", "ES")
    landing.land_extract(fx.landed_a75(rows.where("country_code < 'DE'")), f"{run}/landing")
    landing.land_extract(rows.where(whole).select("document_type", "country_code", "index", *[
        F.floor(c).cast("bigint").alias(n) for c, n in zip(GENERATION_RENAMES, flat)]), f"{run}/landing")
    landing.land_extract(rows.where((F.col("country_code") >= "DE") & ~whole).select("document_type", "country_code", "index", *[
        F.col(c).alias(n) for c, n in zip(GENERATION_RENAMES, flat)]), f"{run}/landing")
    wh = Warehouse(spark, f"{run}/warehouse")
    layers.ingest_extracts(spark, wh, f"{run}/landing", fx.COUNTRIES_10, ["A75"],
                           ingest.IngestWindow(start="1990-01-01", end="2030-01-01"), fx.INGESTION_TS)
    return staging.stg_generation(wh.read_bronze(_a75_table(), BRONZE_A75).drop(MONTH_COL))


def _landed_csv(spark: SparkSession, sf_dir: str) -> str:
    """Generation extracts landed as CSV below the returned folder."""
    configure(spark)
    run = _run_folder(spark, "landed_csv")
    fx.land_csv_a75(fx.bronze_a75_long(spark, sf_dir), f"{run}/csv")
    return run


def q_landed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, PRJ6, PRJ7, ING4: CSV extracts with two header rows and differing columns, loaded into a warehouse and staged."""
    from gridmix.contracts import BRONZE_A75
    from gridmix.plans import layers
    from gridmix.sources.warehouse import MONTH_COL, Warehouse

    run = _landed_csv(spark, sf_dir)
    wh = Warehouse(spark, f"{run}/warehouse")
    layers.ingest_extracts(spark, wh, f"{run}/landing", fx.COUNTRIES_10, ["A75"], ingest.IngestWindow(start="1990-01-01", end="2005-01-01"),
                           fx.INGESTION_TS, csv_root=f"{run}/csv")
    return staging.stg_generation(wh.read_bronze(_a75_table(), BRONZE_A75).drop(MONTH_COL))


def q_landed_csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, ING6: lines of these extracts that are kept apart, by country and reason."""
    from gridmix.sources import landing

    _, rejected = landing.read_csv_extracts(spark, f"{_landed_csv(spark, sf_dir)}/csv", "A75")
    return rejected.groupBy("country_code", "reason").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("file_path").alias("n_files"))


def _a75_table() -> str:
    from gridmix.functions import taxonomy as tx

    return tx.BRONZE_TABLES["A75"]


def q_layer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4-SNK7: a view and two rebuilds of a gold table in the layers' databases, read by qualified name."""
    from gridmix.sources.warehouse import Warehouse

    configure(spark)
    wh = Warehouse(spark, _run_folder(spark, "layer_tables"))
    wh.create_layers()
    daily = wh.view(_gen_daily(spark, sf_dir), "silver", "daily_view")
    for source in (daily.limit(0), spark.table("daily_view")):
        wh.save_table(marts.energy_mix(source), "gold", "layer_tables_mix")
    return spark.table(wh.name("gold", "layer_tables_mix"))


def q_layer_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4 + SNK6 + SRC1: a silver view over bronze in the catalogue, read by its qualified name in a second session.

    The first load lacks the consumption columns, so the view spans files of two schemas.
    """
    from gridmix.contracts import BRONZE_A75
    from gridmix.sources.warehouse import Warehouse

    configure(spark)
    layers_of_run = {k: f"{k}_{_run_folder(spark, 'layer_views').rsplit('/', 1)[-1][:8]}" for k in ("bronze", "silver", "gold")}
    wh = Warehouse(spark, _run_folder(spark, "layer_views"), layers_of_run)
    every, early = fx.bronze_a75(spark, sf_dir), F.day("index") <= 10
    wh.append_bronze(fx.bronze_a75_before_consumption(spark, sf_dir).where(early), _a75_table(), BRONZE_A75, month_of="index")
    wh.append_bronze(every.where(~early), _a75_table(), BRONZE_A75, month_of="index")
    wh.create_view("silver", "stg_generation_view", staging.sql_generation(wh.register_bronze(_a75_table(), BRONZE_A75, month_of="index")))
    other = configure(spark.newSession())
    return other.table(wh.name("silver", "stg_generation_view"))


def q_generation_daily_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 with plain DOUBLE sums (the warehouse's default), rounded after the sum."""
    configure(spark)
    daily = marts.generation_daily(staging.stg_generation(fx.bronze_a75(spark, sf_dir)), exact_scale=None)
    return daily.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in daily.dtypes])


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

def gold_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    daily = _gen_daily(spark, sf_dir, reused=True)
    dim = freeze(marts.dim_countries(daily, ordered=False))
    per_unit_cap = marts.capacity_per_unit(staging.stg_capacity_per_unit(fx.bronze_a71(spark, sf_dir)),
                                           exact_scale=EXACT, ordered=False)
    return {
        "int_generation_daily": daily,
        "dim_countries": dim,
        "fct_energy_mix": marts.energy_mix(daily),
        "fct_renewable_capacity": marts.renewable_capacity(
            staging.stg_capacity(fx.bronze_a68(spark, sf_dir)), per_unit_cap, dim, exact_scale=EXACT),
    }


def _dq(test: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return quality.failing_keys(gold_models(spark, sf_dir), test)
    run.__doc__ = f"DQ: failing rows of every {test} check, as keys."
    return run


def violating_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two models that break their checks: no country for BE, repeated and unknown countries."""
    daily = _gen_daily(spark, sf_dir, reused=True)
    dim = marts.dim_countries(daily, ordered=False)
    unknown = dim.where("country_code = 'BE'").select(F.lit("CH").alias("country_code"), F.lit(None).cast("string").alias("country_name"))
    return {
        "int_generation_daily": daily.withColumn("country_code", F.nullif("country_code", F.lit("BE"))),
        "dim_countries": dim.unionByName(dim.where("country_code in ('FR', 'DE')")).unionByName(unknown),
    }


def _dq_violations(test: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        models = violating_models(spark, sf_dir)
        return quality.failing_keys(models, test, [c for c in quality.CHECKS if c.model in models])
    run.__doc__ = f"DQ: failing rows of the {test} checks over models that break them."
    return run


def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ5: the 14 checks with their failure counts."""
    configure(spark)
    return quality.report(gold_models(spark, sf_dir))


# ---------------------------------------------------------------------------
# Reports over the long generation history
# ---------------------------------------------------------------------------

def _long_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.energy_mix(_gen_daily(spark, sf_dir, long=True))


def q_report_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT1: all-country daily totals and shares."""
    configure(spark)
    return reports.overview(_long_mix(spark, sf_dir), exact_scale=EXACT)


def q_report_country_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT2: mix per country over the whole history."""
    configure(spark)
    return reports.country_mix(_long_mix(spark, sf_dir), exact_scale=EXACT)


def q_report_monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT3: monthly renewable and fossil shares per country."""
    configure(spark)
    return reports.monthly_trend(_long_mix(spark, sf_dir), exact_scale=EXACT)


def q_report_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT4: countries ranked by renewable share over the whole history."""
    configure(spark)
    return reports.ranking(_long_mix(spark, sf_dir), exact_scale=EXACT)


def q_report_capacity_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT5: capacity per energy type with its share of the country total."""
    configure(spark)
    cap = marts.capacity_per_unit(staging.stg_capacity_per_unit(fx.bronze_a71(spark, sf_dir)),
                                  exact_scale=EXACT, ordered=False)
    return reports.capacity_share(cap, exact_scale=EXACT)


def q_report_capacity_vs_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT6: capacity mix beside production mix per country."""
    configure(spark)
    daily = _gen_daily(spark, sf_dir, long=True, reused=True)
    mix = reports.country_mix(marts.energy_mix(daily), exact_scale=EXACT)
    return reports.capacity_vs_production(renewable_capacity_from(spark, sf_dir, daily=daily), mix)


def q_report_country_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT7: one country's daily mix over 1997, in date order."""
    configure(spark)
    return reports.country_detail(_long_mix(spark, sf_dir), "FR", start="1997-01-01", end="1997-12-31")


QUERIES: dict[str, Query] = {
    "staging_generation": q_staging_generation,
    "staging_capacity": q_staging_capacity,
    "staging_capacity_per_unit": q_staging_capacity_per_unit,
    "staging_forecast": q_staging_forecast,
    "generation_daily": q_generation_daily,
    "dim_countries": q_dim_countries,
    "energy_mix": q_energy_mix,
    "capacity_per_unit": q_capacity_per_unit,
    "renewable_capacity": q_renewable_capacity,
    "a71_parse": q_a71_parse,
    "a71_enrich": q_a71_enrich,
    "a71_response_class": q_a71_response_class,
    "a71_ingest_summary": q_a71_ingest_summary,
    "a71_request_plan": q_a71_request_plan,
    "a71_parse_nested": q_a71_parse_nested,
    "a71_series_scan": q_a71_series_scan,
    "responses_to_bronze": q_responses_to_bronze,
    "per_unit_outcomes": q_per_unit_outcomes,
    "sanitized_names": q_sanitized_names,
    "high_water_mark": q_high_water_mark,
    "high_water_mark_a71": q_high_water_mark_a71,
    "ingest_window_plan": q_ingest_window_plan,
    "window_bounds_utc": q_window_bounds_utc,
    "ingest_append": q_ingest_append,
    "schema_evolution": q_schema_evolution,
    "ingest_summary": q_ingest_summary,
    "table_names": q_table_names,
    "country_subset": q_country_subset,
    "stream_append": q_stream_append,
    "dq_not_null_violations": _dq_violations("not_null"),
    "dq_unique_violations": _dq_violations("unique"),
    "dq_accepted_values_violations": _dq_violations("accepted_values"),
    "bronze_roundtrip": q_bronze_roundtrip,
    "high_water_mark_partitioned": q_high_water_mark_partitioned,
    "daily_refresh": q_daily_refresh,
    "stream_into_warehouse": q_stream_into_warehouse,
    "capacity_per_unit_refresh": q_capacity_per_unit_refresh,
    "landed_mixed_shapes": q_landed_mixed_shapes,
    "landed_csv": q_landed_csv,
    "landed_csv_rejected": q_landed_csv_rejected,
    "layer_tables": q_layer_tables,
    "layer_views": q_layer_views,
    "generation_daily_double": q_generation_daily_double,
    "dq_not_null": _dq("not_null"),
    "dq_unique": _dq("unique"),
    "dq_accepted_values": _dq("accepted_values"),
    "dq_relationships": _dq("relationships"),
    "dq_report": q_dq_report,
    "report_overview": q_report_overview,
    "report_country_mix": q_report_country_mix,
    "report_monthly_trend": q_report_monthly_trend,
    "report_ranking": q_report_ranking,
    "report_capacity_share": q_report_capacity_share,
    "report_capacity_vs_production": q_report_capacity_vs_production,
    "report_country_detail": q_report_country_detail,
}

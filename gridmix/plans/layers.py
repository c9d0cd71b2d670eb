"""The model graph and the end-to-end run over a warehouse (section 3 of the survey).

Order: ingest landed extracts -> ingest per-unit responses -> build silver and
gold -> run the quality checks.  Every step is one distributed job over all
countries and documents; the driver only handles the per-key window plan,
which has one row per (country, document) and is checkpointed to the shared
checkpoint folder before anything is appended.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gridmix.contracts import BRONZE_A68, BRONZE_A71, BRONZE_A75
from gridmix.functions import taxonomy as tx
from gridmix.operators import ingest, marts, per_unit, quality, staging
from gridmix.operators.joins import anti_join, freeze, in_partitions, semi_join, spread
from gridmix.session import configure, described, shared_dir
from gridmix.sources import landing
from gridmix.sources.warehouse import LOAD_COL, MONTH_COL, Warehouse, month_key

CONTRACTS = {"A75": BRONZE_A75, "A68": BRONZE_A68}
# Hourly time-series tables are also partitioned by month of their timestamp.
TIME_SERIES = {"A75": "index", "A73": "index"}
DAILY_TABLE = "int_generation_daily"


def run_stamp(now: str | None = None) -> str:
    """The run's ingestion stamp (a parameter in place of ``now()``)."""
    return now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


@dataclass
class IngestResult:
    plan: DataFrame
    outcomes: DataFrame
    summary: DataFrame
    unreadable: dict[tuple[str, str], str] = field(default_factory=dict)  # (document, country): why it was left out
    broken_files: dict[str, str] = field(default_factory=dict)  # landed file: why it was left out
    rejected: DataFrame | None = None  # lines of CSV extracts that were kept apart, with file and reason


def ingest_extracts(spark: SparkSession, wh: Warehouse, landing_root: str, countries: list[str],
                    documents: list[str], window: ingest.IngestWindow, now: str | None = None,
                    csv_root: str | None = None) -> IngestResult:
    """ING1-ING4, ING6, ING7 over landed extracts, all keys in one plan.

    ``csv_root`` holds extracts landed as CSV; they load together with those of ``landing_root``.

    The window plan is computed from the bronze high-water marks and
    checkpointed (a few rows) before the appends, so that appending cannot
    change it.  Rows per key are then counted from bronze, reading only the
    files of this run (their ``ingestion_timestamp`` row-group statistics
    exclude every older file).
    """
    configure(spark)
    shared_dir(spark)  # make sure a checkpoint folder is set
    stamp = run_stamp(now)
    tables = {d: tx.BRONZE_TABLES.get(d, f"{tx.BRONZE_TABLE_PREFIX}{d.lower()}") for d in documents}
    marks_src = {d: wh.read_bronze(t, CONTRACTS.get(d)) for d, t in tables.items() if wh.exists("bronze", t)}
    marks_src = {d: df for d, df in marks_src.items() if "index" in df.columns}
    country_df = spark.createDataFrame([(c,) for c in countries], "country_code string")
    keys = ingest.plan_keys(country_df, documents)
    if window.mode == "incremental" and marks_src:
        marks = ingest.marks_by_document(marks_src)
    else:
        marks = spark.createDataFrame([], "document_type string, country_code string, last_date date")
    with described(spark, "gridmix: window plan"):
        plan = freeze(ingest.window_plan(keys, marks, window))

    bounds = plan.where("action = 'fetch'").agg(F.min("request_start_utc").alias("lo"), F.max("request_end_utc").alias("hi")).first()
    unreadable: dict[tuple[str, str], str] = {}
    broken: dict[str, str] = {}
    rejected: DataFrame | None = None
    for doc, table in tables.items():
        if doc not in tx.DOCUMENT_EXTRACTS:
            continue  # SRC5: unsupported type, reported as failed by the outcomes
        csv, kept_apart = landing.read_csv_extracts(spark, csv_root, doc) if csv_root is not None else (None, None)
        if kept_apart is not None:
            rejected = kept_apart if rejected is None else rejected.unionByName(kept_apart)
        with described(spark, f"gridmix: load {doc}"):
            if doc == "A75":
                wh.mark_pending(touched_from_plan(plan, doc), table)
            try:
                failed = _load_extracts(spark, wh, landing_root, doc, table, plan, bounds, stamp, csv=csv)
            except (PySparkException, Py4JJavaError):
                # ING6: a page that cannot be read costs its file, not the load; nothing of the failed write is visible
                bad = landing.broken_files(spark, landing_root, doc)
                if not bad:
                    raise
                broken.update(bad)
                failed = _load_extracts(spark, wh, landing_root, doc, table, plan, bounds, stamp, set(bad), csv)
        unreadable.update({(doc, c): why for c, why in failed.items()})

    loaded = []
    for doc, table in tables.items():
        b = wh.read_bronze(table, CONTRACTS.get(doc))
        if "ingestion_timestamp" in b.columns:
            b = b.where(F.col("ingestion_timestamp") == F.lit(stamp).cast("timestamp"))
            loaded.append(b.select("country_code", F.lit(doc).alias("document_type")))
    if not loaded:
        loaded = [spark.createDataFrame([], "country_code string, document_type string")]
    outcomes = ingest.load_outcomes(plan, loaded)
    return IngestResult(plan, outcomes, ingest.summary(outcomes), unreadable, broken, rejected)


def _load_extracts(spark: SparkSession, wh: Warehouse, landing_root: str, doc: str, table: str, plan: DataFrame, bounds: Row, stamp: str,
                   leave_out: set[str] | None = None, csv: DataFrame | None = None) -> dict[str, str]:
    """Append one type's landed rows inside the plan's windows; returns the countries that could not be read."""
    landed, failed = landing.read_extracts_by_country(spark, landing_root, doc, leave_out)
    if csv is not None:
        landed = csv if landed is None else landed.unionByName(csv, allowMissingColumns=True)
    if landed is None:
        return failed  # SNK3: nothing landed for this type; its keys are reported as failed
    if bounds.lo is not None and dict(landed.dtypes).get("index", "").startswith("timestamp"):
        # literal bounds of the plan, so that files outside the window are skipped by their statistics
        landed = landed.where((F.col("index") >= F.lit(bounds.lo)) & (F.col("index") < F.lit(bounds.hi)))
    wh.append_bronze(ingest.load_batch(landed, plan, stamp), table, CONTRACTS.get(doc), month_of=TIME_SERIES.get(doc))
    return failed


@dataclass
class PerUnitResult:
    outcomes: DataFrame  # country_code, status, n_responses, n_rows
    summary: DataFrame  # status, n_countries, n_responses, n_rows
    load_id: str


def load_per_unit(spark: SparkSession, wh: Warehouse, responses_root: str, countries: list[str], *, start: str | None = None, end: str | None = None,
                  manifest: DataFrame | None = None, now: str | None = None, one_per_line: bool = False) -> PerUnitResult:
    """ING3 + FLT7 + SRC4 + SNK2 + ING5-ING7 in one pass: request plan, landed responses, parse, append, outcomes.

    Countries without a domain code are ``skipped`` and their responses not read.  The requested ones'
    responses are classified and parsed once; the parsed documents are written to
    a folder of the run, from which the rows are appended under the run's load id and the outcomes
    counted, so a lost executor neither parses again nor counts twice.  A requested country is ``success``
    with rows, ``failed`` with responses but no rows, and ``missing`` without a response.
    """
    configure(spark)
    shared_dir(spark)
    stamp = run_stamp(now)
    load = f"a71-{uuid.uuid4().hex}"
    plan = freeze(per_unit.request_plan(spark.createDataFrame([(c,) for c in countries], "country_code string"), start, end, stamp))
    requested = plan.where("status = 'requested'").select("country_code")
    responses = semi_join(landing.read_responses(spark, responses_root, manifest, one_per_line), requested, "country_code")
    staged = f"{wh.root}/_staged/{load}"
    with described(spark, "gridmix: parse A71"):
        per_unit.with_series(spread(responses)).select("country_code", "file_name", "response_class", "n_rows", "series").write.parquet(staged)
    parsed = spark.read.parquet(staged)
    with described(spark, "gridmix: load A71"):
        rows = per_unit.enrich(per_unit.series_rows(parsed.where("n_rows > 0").select("country_code", F.explode("series").alias("ts"))), stamp)
        wh.append_bronze(rows, tx.A71_TABLE, BRONZE_A71, load_id=load)
    counts = parsed.groupBy("country_code").agg(F.count(F.lit(1)).alias("n_responses"), F.sum("n_rows").alias("n_rows"))
    rows_of = F.coalesce("n_rows", F.lit(0).cast("long"))
    status = (F.when(F.col("status") == "skipped", "skipped").when(rows_of > 0, "success")
              .when(F.col("n_responses").isNull(), "missing").otherwise("failed"))
    outcomes = freeze(plan.join(counts, "country_code", "left").select(
        "country_code", status.alias("status"), F.coalesce("n_responses", F.lit(0).cast("long")).alias("n_responses"), rows_of.alias("n_rows")))
    summary = outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n_countries"), F.sum("n_responses").alias("n_responses"), F.sum("n_rows").alias("n_rows"))
    wh.drop_staged(load)
    return PerUnitResult(outcomes, summary, load)


def ingest_per_unit(spark: SparkSession, wh: Warehouse, responses_root: str, manifest: DataFrame | None = None,
                    now: str | None = None) -> DataFrame:
    """ING5 + SNK2 for whatever responses have landed, without a request plan: parse once, append, summary per outcome.

    As in the source project the documents are appended on every run (no
    high-water mark is applied).
    """
    configure(spark)
    shared_dir(spark)
    load = f"a71-{uuid.uuid4().hex}"
    staged = f"{wh.root}/_staged/{load}"
    with described(spark, "gridmix: parse A71"):
        responses = spread(landing.read_responses(spark, responses_root, manifest))
        per_unit.with_series(responses).select("country_code", "n_rows", "series").write.parquet(staged)
    parsed = spark.read.parquet(staged)
    rows = per_unit.series_rows(parsed.where("n_rows > 0").select("country_code", F.explode("series").alias("ts")))
    with described(spark, "gridmix: load A71"):
        wh.append_bronze(per_unit.enrich(rows, run_stamp(now)), tx.A71_TABLE, BRONZE_A71, load_id=load)
    status = F.when(F.col("n_rows") > 0, F.lit("success")).otherwise(F.lit("failed"))
    summary = freeze(parsed.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_responses"), F.sum("n_rows").alias("n_rows")))
    wh.drop_staged(load)
    return summary


def touched_from_plan(plan: DataFrame, document_type: str = "A75") -> DataFrame:
    """(country_code, index_month) pairs a run may have appended to, from its plan alone.

    Every fetched key's UTC request window is expanded into the months it
    spans; no bronze file is read.  The result is bounded by keys x months
    of the window.
    """
    fetched = plan.where((F.col("action") == "fetch") & (F.col("document_type") == document_type))
    last = F.col("request_end_utc") - F.expr("INTERVAL 1 MICROSECOND")
    months = F.sequence(F.trunc("request_start_utc", "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))
    return (fetched.where(F.col("request_start_utc") < F.col("request_end_utc"))
            .select("country_code", F.explode(months).alias("m"))
            .select("country_code", month_key(F.col("m")).alias(MONTH_COL)).distinct())


def touched_from_stamp(bronze: DataFrame, stamp: str) -> DataFrame:
    """(country_code, index_month) pairs holding rows of one ingestion run.

    For appends made outside a window plan (e.g. a stream).  Only files of
    that run pass the ``ingestion_timestamp`` row-group statistics.
    """
    month = F.col(MONTH_COL) if MONTH_COL in bronze.columns else month_key(F.col("index"))
    return (bronze.where(F.col("ingestion_timestamp") == F.lit(stamp).cast("timestamp"))
            .select("country_code", month.alias(MONTH_COL)).distinct())


def refresh_daily(spark: SparkSession, wh: Warehouse, touched: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Re-aggregate only the touched bronze months into the daily rollup.

    A day lies in one UTC month, so recomputing whole (country, month)
    partitions gives exactly what a full rebuild gives for them; the other
    days of the stored table are kept.  The touched pairs are joined to
    bronze, and partition pruning leaves only their partitions (and those of
    NULL keys, whose days are always recomputed) to be read.  The merged
    table is small (one row per country and day) and is written as a new
    version, so it may be read while it is replaced.
    """
    b75 = wh.read_bronze(tx.BRONZE_TABLES["A75"], BRONZE_A75)
    if MONTH_COL not in b75.columns:
        b75 = b75.withColumn(MONTH_COL, month_key(F.col("index")))
    keys = ["country_code", MONTH_COL]
    touched = freeze(touched.select(*keys).distinct())
    fresh = marts.generation_daily(staging.stg_generation(in_partitions(b75, touched, keys)), exact_scale)
    old = spark.read.parquet(wh.current("silver", DAILY_TABLE)).withColumn(
        MONTH_COL, month_key(F.col("generation_date").cast("timestamp")))
    kept = anti_join(old.where(f"country_code is not null and {MONTH_COL} is not null"), touched, keys).drop(MONTH_COL)
    return wh.save_table(kept.unionByName(fresh), "silver", DAILY_TABLE)


def build_daily(spark: SparkSession, wh: Warehouse, exact_scale: int | None = None,
                touched: DataFrame | None = None, incremental: bool = False) -> DataFrame:
    """The daily rollup as a silver table: refreshed where bronze grew, or rebuilt in full."""
    with described(spark, "gridmix: int_generation_daily"):
        pending = wh.pending(tx.BRONZE_TABLES["A75"])  # before bronze is listed: a later append keeps its own mark
        if (incremental or touched is not None) and wh.current("silver", DAILY_TABLE):
            pairs = spark.createDataFrame([], f"country_code string, {MONTH_COL} string")
            if pending:
                pairs = spark.read.parquet(*pending)
            if touched is not None:
                pairs = pairs.unionByName(touched.select("country_code", MONTH_COL))
            daily = refresh_daily(spark, wh, pairs, exact_scale)
        else:
            b75 = wh.read_bronze(tx.BRONZE_TABLES["A75"], BRONZE_A75)
            daily = wh.save_table(marts.generation_daily(staging.stg_generation(b75), exact_scale), "silver", DAILY_TABLE)
        wh.clear_pending(pending)
    return daily


def refresh_capacity_per_unit(wh: Warehouse, exact_scale: int | None = None, incremental: bool = True) -> DataFrame:
    """M8 from a stored state of partial results, to which only loads that it does not hold yet are added.

    The state is a silver table with one row per group, unit and period (so it does not grow with re-appended
    loads) and one per load that it holds; both are written as one version, so a
    job that dies changes neither.  Only the ids of the loads come to the driver.  Run it when no load is being written:
    a load counts as a whole.  ``incremental=False`` builds the state anew from all loads.
    """
    name = f"int_capacity_unit_periods_{'double' if exact_scale is None else exact_scale}"
    bronze = wh.read_loads(tx.A71_TABLE, BRONZE_A71)
    version = wh.current("silver", name) if incremental else None
    state = wh.spark.read.parquet(version) if version else None
    loads = bronze.select(LOAD_COL).distinct()
    new = [r[0] for r in (loads.join(state.select(LOAD_COL), LOAD_COL, "left_anti") if state is not None else loads).collect()]
    if state is None and not new:  # nothing was ever loaded: no state to write
        return marts.capacity_of_periods(marts.unit_periods(staging.stg_capacity_per_unit(bronze), exact_scale), exact_scale, ordered=False)
    if new:
        periods = marts.unit_periods(staging.stg_capacity_per_unit(bronze.where(F.col(LOAD_COL).isin(new))), exact_scale)
        held = wh.spark.createDataFrame([(x,) for x in new], f"{LOAD_COL} string")
        if state is not None:
            periods = marts.merge_unit_periods(state.where("part = 'period'").drop("part", LOAD_COL), periods)
            held = held.unionByName(state.where("part = 'load'").select(LOAD_COL))
        rows = periods.withColumn("part", F.lit("period")).unionByName(held.withColumn("part", F.lit("load")), allowMissingColumns=True)
        state = wh.save_table(rows, "silver", name, partition_by=("part",))
    return marts.capacity_of_periods(state.where("part = 'period'"), exact_scale, ordered=False)


def _save_mart(wh: Warehouse, df: DataFrame, name: str, nulls: dict[str, int]) -> DataFrame:
    """Write a gold table; the failures of its not-null checks are counted in the same job and added to ``nulls``."""
    observed, seen = quality.observe_nulls(df, name)
    table = wh.save_table(observed, "gold", name)
    if seen is not None:
        nulls.update(seen.get)
    return table


def build_models(spark: SparkSession, wh: Warehouse, exact_scale: int | None = None,
                 touched: DataFrame | None = None, incremental: bool = False, nulls: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Silver views, the daily rollup and the four marts, in dependency order.

    Staging models are views of the silver database in the catalogue (recomputed on read).  The daily rollup feeds
    two marts, so it is written once as a silver table; when ``incremental``
    and a complete table exists, only the pending months (those that any
    ingestion recorded since the last rebuild, also one that died) and the
    ``touched`` (country, month) pairs are re-aggregated from bronze
    (``refresh_daily``), otherwise it is rebuilt in full.  Marts are rebuilt in full, from the small daily table and the
    state of per-unit partial results, to which new loads are added (``refresh_capacity_per_unit``).  The capacity mart reads the written dimension
    and per-unit mart, whose file sizes the planner knows.  The failures of the marts' not-null checks are counted
    by the jobs that write them and put into ``nulls``, for ``run_checks``.
    """
    configure(spark)
    wh.create_layers()
    nulls = {} if nulls is None else nulls
    b75 = wh.read_bronze(tx.BRONZE_TABLES["A75"], BRONZE_A75)
    b68 = wh.read_bronze(tx.BRONZE_TABLES["A68"], BRONZE_A68)
    b71 = wh.read_bronze(tx.A71_TABLE, BRONZE_A71)
    stg_gen, stg_cap, stg_cpu = staging.stg_generation(b75), staging.stg_capacity(b68), staging.stg_capacity_per_unit(b71)
    a75, a68 = tx.BRONZE_TABLES["A75"], tx.BRONZE_TABLES["A68"]
    for name, text, table, contract, month in (
            ("generation", staging.sql_generation, a75, BRONZE_A75, TIME_SERIES.get("A75")), ("capacity", staging.sql_capacity, a68, BRONZE_A68, None),
            ("capacity_per_unit", staging.sql_capacity_per_unit, tx.A71_TABLE, BRONZE_A71, None)):
        wh.create_view("silver", f"stg_entsoe__{name}", text(wh.register_bronze(table, contract, month_of=month)))
    models = {"stg_entsoe__generation": stg_gen, "stg_entsoe__capacity": stg_cap,
              "stg_entsoe__capacity_per_unit": stg_cpu}
    a73 = tx.BRONZE_TABLES["A73"]
    if wh.exists("bronze", a73):
        models["stg_entsoe__forecast"] = wh.view(staging.stg_forecast(wh.read_bronze(a73)), "silver",
                                                 "stg_entsoe__forecast")
    daily = build_daily(spark, wh, exact_scale, touched, incremental)
    with described(spark, "gridmix: dim_countries, fct_energy_mix"):
        dim = _save_mart(wh, marts.dim_countries(daily, ordered=False), "dim_countries", nulls)
        mix = _save_mart(wh, marts.energy_mix(daily), "fct_energy_mix", nulls)
    with described(spark, "gridmix: fct_capacity_per_unit"):
        cpu = _save_mart(wh, refresh_capacity_per_unit(wh, exact_scale, incremental), "fct_capacity_per_unit", nulls)
    with described(spark, "gridmix: fct_renewable_capacity"):
        cap = _save_mart(wh, marts.renewable_capacity(stg_cap, cpu, dim, exact_scale), "fct_renewable_capacity", nulls)
    models.update({"int_generation_daily": daily, "dim_countries": dim, "fct_energy_mix": mix,
                   "fct_capacity_per_unit": cpu, "fct_renewable_capacity": cap})
    return models


class QualityCheckFailed(RuntimeError):
    pass


def run_checks(models: dict[str, DataFrame], fail: bool = True, nulls: dict[str, int] | None = None) -> DataFrame:
    """DQ5 after a build; with ``fail`` a failing check raises, naming it.

    ``nulls``: failures that ``build_models`` counted while writing; those checks read no table again.
    """
    with described(models["dim_countries"].sparkSession, "gridmix: quality checks"):
        report = freeze(quality.report(models, known=nulls))
    if fail:
        failing = report.where(F.col("failures") > 0).select("test_id", "failures").collect()
        if failing:
            raise QualityCheckFailed(", ".join(f"{r.test_id}={r.failures}" for r in failing))
    return report


@dataclass
class RunResult:
    ingest: IngestResult
    per_unit: DataFrame | None
    models: dict[str, DataFrame]
    checks: DataFrame


def run_all(spark: SparkSession, wh: Warehouse, landing_root: str, countries: list[str], documents: list[str],
            window: ingest.IngestWindow, responses_root: str | None = None, manifest: DataFrame | None = None,
            exact_scale: int | None = None, now: str | None = None, fail_on_checks: bool = True, csv_root: str | None = None) -> RunResult:
    """Section 3.4 in one application: ingest -> per-unit ingest -> models -> checks.

    The daily rollup is refreshed for the months this run touched (a full
    build the first time); a failing quality check raises after the build,
    naming the checks, as a failed test run would stop the chain.
    """
    stamp = run_stamp(now)
    ingested = ingest_extracts(spark, wh, landing_root, countries, documents, window, stamp, csv_root)
    per_unit_summary = (ingest_per_unit(spark, wh, responses_root, manifest, stamp)
                        if responses_root is not None else None)
    nulls: dict[str, int] = {}
    models = build_models(spark, wh, exact_scale, incremental=True, nulls=nulls)
    return RunResult(ingested, per_unit_summary, models, run_checks(models, fail=fail_on_checks, nulls=nulls))

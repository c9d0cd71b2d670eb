"""Incremental ingestion as set-based DataFrame operators (ING1-ING7, AGG7-AGG9).

The per-(country, document) loop of a request-by-request loader becomes one
distributed job: a small *window plan* (one row per key) is computed from the
high-water marks of bronze, broadcast once proven small, and joined to the
landed extracts, which are filtered to their window, renamed and stamped in a
single pass, then appended.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions import exprs as X
from gridmix.functions import taxonomy as tx
from gridmix.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast, in_partitions, is_small

KEYS = ["country_code", "document_type"]


# ---------------------------------------------------------------------------
# ING1 / ING3: run windows
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class IngestWindow:
    """Window of one ingestion run (ING1).

    ``start`` given -> explicit (backfill) mode for every key; otherwise
    incremental: each key starts the day after its high-water mark, or at
    ``default_start`` when it has none.  ``end`` is the run's "now".
    """

    end: str
    start: str | None = None
    default_start: str = tx.DEFAULT_FIRST_START

    @property
    def mode(self) -> str:
        return "explicit" if self.start else "incremental"


def per_unit_window(start: str | None, end: str | None, now: str) -> tuple[str, str]:
    """ING3: both dates are needed; otherwise January 1 of ``now``'s year to ``now``."""
    if start and end:
        return start, end
    return f"{now[:4]}-01-01", now


# ---------------------------------------------------------------------------
# PRJ6 / PRJ7 / PRJ10: names and lineage
# ---------------------------------------------------------------------------

def sanitize(name: str) -> str:
    """PRJ6 on one column name (schema metadata, resolved at plan time)."""
    cleaned = re.sub(r"[^a-z0-9_]", "_", name.lower())
    return re.sub(r"_+", "_", cleaned).strip("_")


def flatten_columns(df: DataFrame, sep: str = "_") -> DataFrame:
    """PRJ7: a two-level column (struct) becomes ``<level1>_<level2>`` columns."""
    out: list[Column] = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            for sub in field.dataType.fields:
                out.append(F.col(f"`{field.name}`")[sub.name].alias(f"{field.name}{sep}{sub.name}".strip()))
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """PRJ6 on a frame: rename every column; two names that collide raise."""
    new = [sanitize(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, clean in zip(df.columns, new):
        if clean in seen:
            raise ValueError(f"columns {seen[clean]!r} and {old!r} both sanitise to {clean!r}")
        seen[clean] = old
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(df.columns, new)])


def add_lineage(df: DataFrame, ingestion_ts, country_code: str | None = None,
                document_type: str | None = None) -> DataFrame:
    """PRJ10: ``country_code``, ``document_type`` (when given) and ``ingestion_timestamp``."""
    cols: dict[str, Column] = {}
    if country_code is not None:
        cols["country_code"] = F.lit(country_code)
    if document_type is not None:
        cols["document_type"] = F.lit(document_type)
    cols["ingestion_timestamp"] = (F.current_timestamp() if ingestion_ts is None
                                   else F.lit(ingestion_ts).cast("timestamp"))
    return df.withColumns(cols)


# ---------------------------------------------------------------------------
# AGG7 / AGG8: high-water marks
# ---------------------------------------------------------------------------

def high_water_marks(bronze: DataFrame, by_country: bool = True, ts_col: str = "index",
                     month_col: str = "index_month") -> DataFrame:
    """AGG7: ``max(date(index))`` per country (or overall), one pass.

    An empty table gives no row per country (or a NULL overall mark); rows
    without a country are one group.  When bronze is partitioned by month
    (``month_col``), the latest month of each country is found first from the
    partition values alone (no data column is read) and joined back, so that
    partition pruning leaves only those partitions, and those of NULL
    values, to be scanned for the exact mark.
    """
    day = X.to_day(F.max(F.col(ts_col).cast("timestamp")))
    if month_col in bronze.columns:
        latest = bronze.groupBy("country_code").agg(F.max(month_col).alias(month_col))
        bronze = in_partitions(bronze, latest, ["country_code", month_col])
    if by_country:
        return bronze.groupBy("country_code").agg(day.alias("last_date"))
    return bronze.agg(day.alias("last_date"))


def high_water_marks_per_unit(bronze_a71: DataFrame) -> DataFrame:
    """AGG8: per-country mark over ISO ``period_start`` strings."""
    day = X.to_day(X.parse_iso_instant("period_start"))
    return bronze_a71.groupBy("country_code").agg(F.max(day).alias("last_date"))


def marks_by_document(bronze_by_type: dict[str, DataFrame]) -> DataFrame:
    """AGG7 over several bronze tables: (document_type, country_code, last_date)."""
    parts = [high_water_marks(df).withColumn("document_type", F.lit(doc))
             for doc, df in bronze_by_type.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("document_type", "country_code", "last_date")


# ---------------------------------------------------------------------------
# JN4 / ING2 / FLT6 / SRC6 / S19: window plan
# ---------------------------------------------------------------------------

def plan_keys(countries: DataFrame, documents: list[str]) -> DataFrame:
    """JN4: every country with every configured document type.

    The document list is a literal array exploded per country row, so no
    join is needed; the output has ``len(documents)`` rows per country.
    """
    docs = F.explode(F.array(*[F.lit(d) for d in documents]))
    return countries.select("country_code").distinct().select("country_code", docs.alias("document_type"))


def window_plan(keys: DataFrame, marks: DataFrame | None, window: IngestWindow,
                max_keys: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """ING2: start, end and action for every (country, document) key.

    Incremental: start = mark + 1 day (the rest of a partly loaded last day
    is not fetched again), or ``default_start``; explicit: the given start.
    ``skip`` when start > end (FLT6).  Request bounds are local midnight in
    the market zone, converted to UTC (SRC6) and formatted for the API (S19).

    ``keys`` are unique (country, document) pairs and ``marks`` hold at most
    one row per pair.  Once the keys are proven small, the marks are first
    cut to the planned keys (an inner join with the broadcast keys), which
    leaves at most one row per key; that result is then broadcast into the
    plan without counting the bronze scan behind the marks.
    """
    end_day = F.to_date(F.lit(window.end))
    if window.mode == "explicit":
        planned = keys.withColumn("last_date", F.lit(None).cast("date")) \
            .withColumn("start_date", F.to_date(F.lit(window.start)))
    elif marks is None:  # nothing loaded yet: every key starts at the default
        planned = keys.withColumn("last_date", F.lit(None).cast("date")) \
            .withColumn("start_date", F.to_date(F.lit(window.default_start)))
    else:
        m = marks.select(*KEYS, "last_date")
        if is_small(keys, max_keys):
            k = F.broadcast(keys.select(*KEYS))
            planned = keys.join(F.broadcast(m.join(k, KEYS, "inner")), KEYS, "left")
        else:
            planned = keys.join(m, KEYS, "left")
        planned = planned.withColumn(
            "start_date", F.coalesce(F.date_add("last_date", 1), F.to_date(F.lit(window.default_start))))
    end_local = F.to_timestamp(F.lit(window.end))
    return planned.select(
        *KEYS,
        X.bronze_table_name("document_type").alias("table_name"),
        F.lit(window.mode).alias("mode"),
        "last_date",
        "start_date",
        end_day.alias("end_date"),
        F.when(F.col("start_date") > end_day, F.lit("skip")).otherwise(F.lit("fetch")).alias("action"),
        X.market_time_to_utc(F.col("start_date").cast("timestamp")).alias("request_start_utc"),
        X.market_time_to_utc(end_local).alias("request_end_utc"),
        X.api_time(F.col("start_date").cast("timestamp")).alias("period_start_param"),
        X.api_time(end_local).alias("period_end_param"),
    )


def extract_kind(document_type: Column) -> Column:
    """SRC5: which extract a document type is; NULL = unsupported."""
    return X.lookup(tx.DOCUMENT_EXTRACTS, document_type)


# ---------------------------------------------------------------------------
# ING4 / SNK1 / SNK3: load
# ---------------------------------------------------------------------------

def load_batch(landed: DataFrame, plan: DataFrame, ingestion_ts=None) -> DataFrame:
    """ING4: landed extract rows of planned keys, within their window, renamed and stamped.

    ``landed`` carries ``country_code`` and ``document_type`` (the landing
    partition columns), ``index`` and raw value columns (two-level names
    allowed).  The plan holds one row per key, so it is broadcast once its
    size is checked and the landed rows are never shuffled.
    """
    fetch = plan.where((F.col("action") == "fetch") & extract_kind(F.col("document_type")).isNotNull()) \
        .select(*KEYS, "request_start_utc", "request_end_utc")
    clean = sanitize_columns(flatten_columns(landed))
    ts = F.col("index").cast("timestamp")
    kept = clean.join(checked_broadcast(fetch), KEYS, "inner").where(
        (ts >= F.col("request_start_utc")) & (ts < F.col("request_end_utc")))
    value_cols = [c for c in clean.columns if c not in (*KEYS, "ingestion_timestamp")]
    return add_lineage(kept.select(*KEYS, *value_cols), ingestion_ts)


def append(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """SNK1 in memory: append with an additive schema (new columns allowed).

    Rows of either side lacking a column get NULL there, as a warehouse load
    with field addition does.  Appending an empty batch changes nothing.
    """
    return existing.unionByName(batch, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# ING6 / ING7 / AGG9: outcomes and summary
# ---------------------------------------------------------------------------

def load_outcomes(plan: DataFrame, batches: list[DataFrame],
                  max_keys: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """ING6: one outcome per key: ``skipped``, ``updated`` (rows > 0) or ``failed``.

    ``batches`` are the loaded frames (one per bronze table).  An unsupported
    document type or a key with no landed rows in its window is ``failed``; it
    never stops the other keys.  Rows are counted per key (partial counts
    before the shuffle); the counts are cut to the plan's keys, so at most one
    row per key meets the plan and can be broadcast once the plan is proven
    small.
    """
    keyed = batches[0].select(*KEYS)
    for b in batches[1:]:
        keyed = keyed.unionByName(b.select(*KEYS))
    counts = keyed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"))
    actions = plan.select(*KEYS, "action")
    if is_small(actions, max_keys):
        bounded = counts.join(F.broadcast(actions.select(*KEYS)), KEYS, "left_semi")
        joined = actions.join(F.broadcast(bounded), KEYS, "left")
    else:
        joined = actions.join(counts, KEYS, "left")
    rows = F.coalesce(F.col("rows"), F.lit(0)).cast("long")
    status = (F.when(F.col("action") == "skip", F.lit("skipped"))
              .when(rows > 0, F.lit("updated")).otherwise(F.lit("failed")))
    return joined.select(*KEYS, status.alias("status"),
                         F.when(F.col("action") == "skip", F.lit(0).cast("long")).otherwise(rows).alias("rows"))


def summary(outcomes: DataFrame) -> DataFrame:
    """ING7 / AGG9: keys and rows per status."""
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("rows").cast("long").alias("n_rows"))

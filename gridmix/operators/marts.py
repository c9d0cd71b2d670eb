"""Intermediate and gold models M5-M9.

Every model is a pure function ``DataFrame -> DataFrame``.  ``exact_scale``
(default ``None``: DOUBLE sums, as in the warehouse) switches the SUM
aggregates to fixed-point summation at that many decimals; see
``exprs.total_sum``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.contracts import DAILY_ENERGY
from gridmix.functions import exprs as X
from gridmix.functions import taxonomy as tx
from gridmix.operators.joins import semi_join


def generation_daily(stg_generation: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """M5 (AGG1): hourly MW rolled up to daily MWh per country and UTC day.

    MWh = sum of hourly MW (valid for hourly rows); ``hourly_records_count``
    counts the rows of the day.  A partial aggregate per task runs before the
    shuffle on (country, day), so a country holding most rows does not skew it.
    """
    return (
        stg_generation.groupBy("country_code", X.to_day("generation_datetime").alias("generation_date"))
        .agg(
            *[X.total_sum(X.zero_if_null(mw), exact_scale).alias(mwh) for mw, mwh in DAILY_ENERGY.items()],
            F.count(F.lit(1)).alias("hourly_records_count"),
        )
    )


def dim_countries(generation_daily: DataFrame, ordered: bool = True) -> DataFrame:
    """M6 (AGG5, JN3, SRT1): distinct countries with display names."""
    out = (
        generation_daily.select("country_code").distinct()
        .select("country_code", X.country_name("country_code").alias("country_name"))
    )
    return out.orderBy("country_code") if ordered else out


def _category_totals(categories: dict[str, list[str]], suffix: str) -> dict[str, F.Column]:
    return {f"total_{cat}_{suffix}": X.zero_filled_total(cols) for cat, cols in categories.items()}


def _mix(df: DataFrame, keys: list[str], suffix: str, total_name: str, pct_suffix: str) -> DataFrame:
    """Total of the four categories, then each category's zero-guarded share."""
    totals = [f"total_{cat}_{suffix}" for cat in tx.CATEGORIES]
    with_total = df.withColumn(total_name, X.add_all(totals))
    return with_total.select(
        *keys, *totals, total_name,
        *[X.share(f"total_{cat}_{suffix}", total_name).alias(f"{cat}_{pct_suffix}") for cat in tx.CATEGORIES],
    )


def energy_mix(generation_daily: DataFrame) -> DataFrame:
    """M7 (S1, S2, S5): daily renewable / fossil / nuclear / other mix.

    The total is projected once and each share divides by it; a zero (or
    NULL) total gives NULL shares.
    """
    cats = generation_daily.select(
        "country_code", "generation_date", *[v.alias(k) for k, v in _category_totals(
            tx.GENERATION_CATEGORIES, "mwh").items()])
    return _mix(cats, ["country_code", "generation_date"], "mwh", "total_production_mwh", "percentage")


def capacity_per_unit(stg_capacity_per_unit: DataFrame, exact_scale: int | None = None,
                      ordered: bool = True) -> DataFrame:
    """M8 (AGG2, AGG6, SRT2): per-unit capacity by country and energy type.

    Sums every row of a unit (all periods and points, and every re-appended
    load), counts distinct units exactly, and keeps the greatest period
    bounds as strings (lexicographic).

    Plan: Spark aggregates a string ``max`` with a sort-based aggregate, which
    would sort every raw row.  So rows are first collapsed by (group, unit,
    period) in a hash aggregate, where the strings are keys; re-appended
    loads and multi-point periods collapse there, and only one row per
    unit and period reaches the string maxima and the distinct count.
    """
    return capacity_of_periods(unit_periods(stg_capacity_per_unit, exact_scale), exact_scale, ordered)


_UNIT_GROUP = ["country_code", "energy_type", "is_renewable"]
_UNIT_PERIOD = [*_UNIT_GROUP, "unit_id", "period_start", "period_end"]


def unit_periods(stg_capacity_per_unit: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """M8's partial results: one row per group, unit and period, its capacity summed as ``_mw``."""
    return stg_capacity_per_unit.groupBy(*_UNIT_PERIOD).agg(F.sum(X.to_units("installed_capacity_mw", exact_scale)).alias("_mw"))


def merge_unit_periods(*parts: DataFrame) -> DataFrame:
    """Partial results of several loads as one: sums add up, equal units and periods become one row."""
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united.groupBy(*_UNIT_PERIOD).agg(F.sum("_mw").alias("_mw"))


def capacity_of_periods(per_period: DataFrame, exact_scale: int | None = None, ordered: bool = True) -> DataFrame:
    """M8 from its partial results."""
    out = per_period.groupBy(*_UNIT_GROUP).agg(
        X.from_units(F.sum("_mw"), exact_scale).alias("total_capacity_mw"),
        F.count_distinct("unit_id").alias("number_of_units"),
        F.max("period_start").alias("latest_period_start"),
        F.max("period_end").alias("latest_period_end"),
    )
    return out.orderBy("country_code", F.desc("total_capacity_mw")) if ordered else out


def _snapshot_arm(stg_capacity: DataFrame) -> DataFrame:
    """Latest snapshot per country outside the per-unit list (FLT1, WIN1).

    ``row_number() = 1`` over (country, newest first) is planned as a
    per-task group limit before the shuffle, so only one row per country and
    task is exchanged.  Ties on the stamp go to the latest ingestion.
    """
    newest = Window.partitionBy("country_code").orderBy(
        F.col("capacity_date").desc(), F.col("ingestion_timestamp").desc())
    latest = (
        stg_capacity.where(~F.col("country_code").isin(tx.PER_UNIT_COUNTRIES))
        .withColumn("_rn", F.row_number().over(newest))
        .where(F.col("_rn") == 1)
    )
    return latest.select(
        "country_code",
        X.to_day("capacity_date").alias("capacity_date"),
        *[v.alias(k) for k, v in _category_totals(tx.CAPACITY_CATEGORIES, "capacity_mw").items()],
    )


def _per_unit_arm(capacity_per_unit: DataFrame, countries: DataFrame,
                  exact_scale: int | None) -> DataFrame:
    """Per-unit totals by category for countries of the dimension (FLT2, JN1, AGG3, AGG4)."""
    mw = F.col("total_capacity_mw")
    renewable = F.col("is_renewable")
    fossil = F.col("energy_type").like("Fossil%")
    nuclear = F.col("energy_type") == "Nuclear"
    zero = F.lit(0.0)
    kept = semi_join(capacity_per_unit.where(F.col("country_code") != tx.SNAPSHOT_ONLY_COUNTRY),
                     countries, "country_code")
    return kept.groupBy("country_code").agg(
        F.max(X.to_day(X.parse_iso_instant("latest_period_start"))).alias("capacity_date"),
        X.total_sum(F.when(renewable, mw).otherwise(zero), exact_scale).alias("total_renewable_capacity_mw"),
        X.total_sum(F.when(fossil, mw).otherwise(zero), exact_scale).alias("total_fossil_capacity_mw"),
        X.total_sum(F.when(nuclear, mw).otherwise(zero), exact_scale).alias("total_nuclear_capacity_mw"),
        X.total_sum(F.when(~renewable & ~nuclear & ~fossil, mw).otherwise(zero),
                    exact_scale).alias("total_other_capacity_mw"),
    )


def renewable_capacity(stg_capacity: DataFrame, capacity_per_unit: DataFrame, countries: DataFrame,
                       exact_scale: int | None = None) -> DataFrame:
    """M9 (SET1 + S5): capacity mix per country.

    Snapshot arm: countries outside the per-unit list, newest snapshot each.
    Per-unit arm: per-unit totals, Portugal excluded, restricted to the
    country dimension by a semi-join (broadcast once the dimension is proven
    small).  The arms are unioned and the shares computed on the union.
    """
    union = _snapshot_arm(stg_capacity).unionByName(_per_unit_arm(capacity_per_unit, countries, exact_scale))
    return _mix(union, ["country_code", "capacity_date"], "capacity_mw",
                "total_installed_capacity_mw", "capacity_percentage")

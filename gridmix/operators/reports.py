"""Dashboard queries over the gold tables (RPT1-RPT7).

Shares are always recomputed from summed energies, never averaged from
daily percentages.  Each report aggregates first; the only unpartitioned step
(ranking) runs on one row per country.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.functions import exprs as X
from gridmix.functions import taxonomy as tx
from gridmix.operators.joins import lookup_join

ENERGY = [f"total_{c}_mwh" for c in tx.CATEGORIES]


def _energy_sums(exact_scale: int | None) -> list:
    return [X.total_sum(c, exact_scale).alias(c) for c in (*ENERGY, "total_production_mwh")]


def _shares(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *ENERGY, "total_production_mwh", *[
        X.share(f"total_{c}_mwh", "total_production_mwh").alias(f"{c}_percentage") for c in tx.CATEGORIES])


def _period(energy_mix: DataFrame, start: str | None, end: str | None) -> DataFrame:
    d = F.col("generation_date")
    if start:
        energy_mix = energy_mix.where(d >= F.to_date(F.lit(start)))
    if end:
        energy_mix = energy_mix.where(d <= F.to_date(F.lit(end)))
    return energy_mix


def overview(energy_mix: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """RPT1: all countries together, per day."""
    daily = energy_mix.groupBy("generation_date").agg(
        F.count_distinct("country_code").alias("countries"), *_energy_sums(exact_scale))
    return _shares(daily, ["generation_date", "countries"])


def country_mix(energy_mix: DataFrame, start: str | None = None, end: str | None = None,
                exact_scale: int | None = None) -> DataFrame:
    """RPT2: energy mix per country over a period (whole history by default)."""
    per_country = _period(energy_mix, start, end).groupBy("country_code").agg(
        F.count(F.lit(1)).alias("days"), *_energy_sums(exact_scale))
    return _shares(per_country, ["country_code", "days"])


def monthly_trend(energy_mix: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """RPT3: renewable and fossil share per country and month."""
    month = F.trunc("generation_date", "month").alias("month")
    monthly = energy_mix.groupBy("country_code", month).agg(
        X.total_sum("total_renewable_mwh", exact_scale).alias("total_renewable_mwh"),
        X.total_sum("total_fossil_mwh", exact_scale).alias("total_fossil_mwh"),
        X.total_sum("total_production_mwh", exact_scale).alias("total_production_mwh"))
    return monthly.select(
        "country_code", "month", "total_renewable_mwh", "total_fossil_mwh", "total_production_mwh",
        X.share("total_renewable_mwh", "total_production_mwh").alias("renewable_percentage"),
        X.share("total_fossil_mwh", "total_production_mwh").alias("fossil_percentage"))


def ranking(energy_mix: DataFrame, start: str | None = None, end: str | None = None,
            exact_scale: int | None = None) -> DataFrame:
    """RPT4: countries ranked by renewable share (highest first, NULL last).

    The window has no partition key on purpose: it runs after the per-country
    aggregation, on one row per country.
    """
    mix = country_mix(energy_mix, start, end, exact_scale)
    order = Window.orderBy(F.col("renewable_percentage").desc_nulls_last())
    return mix.select("country_code", "renewable_percentage", "fossil_percentage", "total_production_mwh",
                      F.rank().over(order).cast("long").alias("renewable_rank"))


def capacity_share(capacity_per_unit: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """RPT5: capacity by country and energy type, with share of the country total."""
    per_country = Window.partitionBy("country_code")
    total = X.windowed_total("total_capacity_mw", per_country, exact_scale)
    with_total = capacity_per_unit.withColumn("country_total_capacity_mw", total)
    return with_total.select(
        "country_code", "energy_type", "is_renewable", "total_capacity_mw", "number_of_units",
        "country_total_capacity_mw",
        X.share("total_capacity_mw", "country_total_capacity_mw").alias("capacity_share_percentage"))


def capacity_vs_production(renewable_capacity: DataFrame, country_mix_df: DataFrame) -> DataFrame:
    """RPT6: installed capacity mix beside the production mix, per country.

    Both sides hold one row per country; the production side is broadcast
    after its size is checked.
    """
    prod = country_mix_df.select("country_code", "days", "total_production_mwh", "renewable_percentage")
    cap = renewable_capacity.select("country_code", "capacity_date", "total_installed_capacity_mw",
                                    "renewable_capacity_percentage")
    joined = lookup_join(cap, prod, "country_code", "inner")
    return joined.select(
        "country_code", "capacity_date", "total_installed_capacity_mw", "renewable_capacity_percentage",
        "days", "total_production_mwh", "renewable_percentage",
        F.round(F.col("renewable_percentage") - F.col("renewable_capacity_percentage"), 2)
        .alias("renewable_gap_points"))


def country_detail(energy_mix: DataFrame, country_code: str, start: str | None = None,
                   end: str | None = None) -> DataFrame:
    """RPT7: one country's daily mix over a date range, in date order.

    The country filter is on a grouping key of the daily rollup, so Catalyst
    pushes it below the aggregate down to the bronze scan.
    """
    rows = _period(energy_mix.where(F.col("country_code") == country_code), start, end)
    return rows.orderBy("generation_date")

"""Silver staging models M1-M4: rename-and-select over bronze.

Each is a pure projection, so Catalyst prunes the bronze scan to the columns a
downstream model needs and pushes filters through to the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.contracts import (BRONZE_A68, BRONZE_A71, BRONZE_A75, CAPACITY_PER_UNIT_COLUMNS,
                               CAPACITY_RENAMES, GENERATION_RENAMES, METADATA, ensure_columns)


def _renamed(df: DataFrame, ts_name: str, renames: dict[str, str]) -> DataFrame:
    return df.select(
        *METADATA,
        F.col("index").cast("timestamp").alias(ts_name),
        *[F.col(raw).alias(staged) for raw, staged in renames.items()],
    )


def stg_generation(bronze_a75: DataFrame) -> DataFrame:
    """M1 (PRJ1, PRJ12, S8): hourly actual generation with staged names.

    Fuel columns a country never reported are absent from the additive bronze
    schema; they are filled as typed NULL before the projection.
    """
    return _renamed(ensure_columns(bronze_a75, BRONZE_A75), "generation_datetime", GENERATION_RENAMES)


def stg_capacity(bronze_a68: DataFrame) -> DataFrame:
    """M2 (PRJ2, S8): installed-capacity snapshots with staged names.

    ``capacity_date`` stays a TIMESTAMP despite its name.
    """
    return _renamed(ensure_columns(bronze_a68, BRONZE_A68), "capacity_date", CAPACITY_RENAMES)


def stg_forecast(bronze_a73: DataFrame) -> DataFrame:
    """M3 (PRJ3, S8): per-plant output; every plant column passes through.

    Equivalent of ``SELECT meta, cast(index) AS forecast_datetime, * EXCEPT (meta, index)``.
    """
    plants = [c for c in bronze_a73.columns if c not in (*METADATA, "index")]
    return bronze_a73.select(
        *METADATA,
        F.col("index").cast("timestamp").alias("forecast_datetime"),
        *[F.col(f"`{c}`") for c in plants],
    )


def stg_capacity_per_unit(bronze_a71: DataFrame) -> DataFrame:
    """M4 (PRJ4): per-unit capacity, pure column selection."""
    return ensure_columns(bronze_a71, BRONZE_A71).select(*CAPACITY_PER_UNIT_COLUMNS)


def _select(table: str, columns: list[tuple[str, str]]) -> str:
    return "SELECT " + ", ".join(f"{e} AS `{n}`" if e != n else f"`{n}`" for e, n in columns) + f" FROM {table}"


def sql_generation(table: str) -> str:
    """M1 as a view's text over a registered bronze table."""
    return _select(table, [(c, c) for c in METADATA] + [("CAST(`index` AS TIMESTAMP)", "generation_datetime")] + [(f"`{r}`", n) for r, n in GENERATION_RENAMES.items()])


def sql_capacity(table: str) -> str:
    """M2 as a view's text."""
    return _select(table, [(c, c) for c in METADATA] + [("CAST(`index` AS TIMESTAMP)", "capacity_date")] + [(f"`{r}`", n) for r, n in CAPACITY_RENAMES.items()])


def sql_capacity_per_unit(table: str) -> str:
    """M4 as a view's text."""
    return _select(table, [(c, c) for c in CAPACITY_PER_UNIT_COLUMNS])

"""Column contracts of the bronze, silver and gold tables.

Rename maps are FIXED VALUES (raw bronze name -> silver name) and must equal
the staging models they stand for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA = ["country_code", "document_type", "ingestion_timestamp"]

# FIXED VALUES: actual-generation columns, raw name -> staged name.
GENERATION_RENAMES: dict[str, str] = {
    "biomass_actual_aggregated": "biomass_mw",
    "hydro_pumped_storage_actual_aggregated": "hydro_pumped_storage_mw",
    "hydro_run_of_river_and_poundage_actual_aggregated": "hydro_run_of_river_mw",
    "hydro_water_reservoir_actual_aggregated": "hydro_water_reservoir_mw",
    "solar_actual_aggregated": "solar_mw",
    "wind_onshore_actual_aggregated": "wind_onshore_mw",
    "wind_offshore_actual_aggregated": "wind_offshore_mw",
    "fossil_gas_actual_aggregated": "gas_mw",
    "fossil_hard_coal_actual_aggregated": "hard_coal_mw",
    "fossil_oil_actual_aggregated": "oil_mw",
    "nuclear_actual_aggregated": "nuclear_mw",
    "waste_actual_aggregated": "waste_mw",
    "energy_storage_actual_aggregated": "energy_storage_mw",
    "energy_storage_actual_consumption": "energy_storage_consumption_mw",
    "hydro_pumped_storage_actual_consumption": "hydro_pumped_storage_consumption_mw",
    "fossil_hard_coal_actual_consumption": "hard_coal_consumption_mw",
    "fossil_oil_actual_consumption": "oil_consumption_mw",
    "wind_offshore_actual_consumption": "wind_offshore_consumption_mw",
    "wind_onshore_actual_consumption": "wind_onshore_consumption_mw",
}

# FIXED VALUES: installed-capacity snapshot columns, raw name -> staged name.
CAPACITY_RENAMES: dict[str, str] = {
    "biomass": "biomass_capacity_mw",
    "energy_storage": "energy_storage_capacity_mw",
    "fossil_brown_coal_lignite": "coal_lignite_capacity_mw",
    "fossil_coal_derived_gas": "coal_derived_gas_capacity_mw",
    "fossil_gas": "gas_capacity_mw",
    "fossil_hard_coal": "hard_coal_capacity_mw",
    "fossil_oil": "oil_capacity_mw",
    "fossil_oil_shale": "oil_shale_capacity_mw",
    "fossil_peat": "peat_capacity_mw",
    "geothermal": "geothermal_capacity_mw",
    "hydro_pumped_storage": "hydro_pumped_storage_capacity_mw",
    "hydro_run_of_river_and_poundage": "hydro_run_of_river_capacity_mw",
    "hydro_water_reservoir": "hydro_water_reservoir_capacity_mw",
    "marine": "marine_capacity_mw",
    "nuclear": "nuclear_capacity_mw",
    "other": "other_capacity_mw",
    "other_renewable": "other_renewable_capacity_mw",
    "solar": "solar_capacity_mw",
    "waste": "waste_capacity_mw",
    "wind_offshore": "wind_offshore_capacity_mw",
    "wind_onshore": "wind_onshore_capacity_mw",
}

# FIXED VALUES: daily rollup, staged MW column -> daily MWh column.
DAILY_ENERGY = {
    "biomass_mw": "biomass_mwh",
    "hydro_pumped_storage_mw": "hydro_pumped_storage_mwh",
    "hydro_run_of_river_mw": "hydro_run_of_river_mwh",
    "hydro_water_reservoir_mw": "hydro_water_reservoir_mwh",
    "solar_mw": "solar_mwh",
    "wind_onshore_mw": "wind_onshore_mwh",
    "wind_offshore_mw": "wind_offshore_mwh",
    "gas_mw": "gas_mwh",
    "hard_coal_mw": "hard_coal_mwh",
    "oil_mw": "oil_mwh",
    "nuclear_mw": "nuclear_mwh",
    "waste_mw": "waste_mwh",
    "energy_storage_mw": "energy_storage_mwh",
}

# Per-unit capacity, in the staged column order.
CAPACITY_PER_UNIT_COLUMNS = [
    "country_code", "unit_id", "unit_name", "psr_type", "energy_type", "is_renewable",
    "installed_capacity_mw", "period_start", "period_end", "latitude", "longitude",
    "document_type", "ingestion_timestamp",
]

_D = T.DoubleType()
_S = T.StringType()

BRONZE_A75 = T.StructType(
    [T.StructField("country_code", _S), T.StructField("document_type", _S),
     T.StructField("ingestion_timestamp", T.TimestampType()), T.StructField("index", T.TimestampType())]
    + [T.StructField(c, _D) for c in GENERATION_RENAMES]
)

BRONZE_A68 = T.StructType(
    [T.StructField("country_code", _S), T.StructField("document_type", _S),
     T.StructField("ingestion_timestamp", T.TimestampType()), T.StructField("index", T.TimestampType())]
    + [T.StructField(c, _D) for c in CAPACITY_RENAMES]
)

BRONZE_A71 = T.StructType([
    T.StructField("country_code", _S), T.StructField("unit_id", _S), T.StructField("unit_name", _S),
    T.StructField("psr_type", _S), T.StructField("period_start", _S), T.StructField("period_end", _S),
    T.StructField("installed_capacity_mw", _D), T.StructField("latitude", _D),
    T.StructField("longitude", _D), T.StructField("energy_type", _S),
    T.StructField("is_renewable", T.BooleanType()), T.StructField("document_type", _S),
    T.StructField("ingestion_timestamp", T.TimestampType()),
])


def ensure_columns(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Add every contract column the frame lacks as a typed NULL (PRJ12).

    Additive bronze schemas leave columns absent for countries that never
    reported them; downstream projections then see NULL, as in the warehouse.
    """
    present = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in contract.fields if f.name not in present}
    return df.withColumns(missing) if missing else df


"""Business reference data as plain values.

Everything in this module is a FIXED VALUE: the lists and mappings must equal
the ones the source models use, so that results match.  They are stated here
in their natural order and never derived.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: generation columns of the daily rollup, grouped by category
# (energy-mix mart).  Order inside a category is the order of the sums.
# ---------------------------------------------------------------------------
GENERATION_CATEGORIES: dict[str, list[str]] = {
    "renewable": [
        "biomass_mwh",
        "hydro_pumped_storage_mwh",
        "hydro_run_of_river_mwh",
        "hydro_water_reservoir_mwh",
        "solar_mwh",
        "wind_onshore_mwh",
        "wind_offshore_mwh",
    ],
    "fossil": ["gas_mwh", "hard_coal_mwh", "oil_mwh"],
    "nuclear": ["nuclear_mwh"],
    "other": ["waste_mwh", "energy_storage_mwh"],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: installed-capacity columns (snapshot documents) by category.
# ---------------------------------------------------------------------------
CAPACITY_CATEGORIES: dict[str, list[str]] = {
    "renewable": [
        "biomass_capacity_mw",
        "hydro_pumped_storage_capacity_mw",
        "hydro_run_of_river_capacity_mw",
        "hydro_water_reservoir_capacity_mw",
        "solar_capacity_mw",
        "wind_onshore_capacity_mw",
        "wind_offshore_capacity_mw",
        "marine_capacity_mw",
        "geothermal_capacity_mw",
        "other_renewable_capacity_mw",
    ],
    "fossil": [
        "coal_lignite_capacity_mw",
        "coal_derived_gas_capacity_mw",
        "gas_capacity_mw",
        "hard_coal_capacity_mw",
        "oil_capacity_mw",
        "oil_shale_capacity_mw",
        "peat_capacity_mw",
    ],
    "nuclear": ["nuclear_capacity_mw"],
    "other": ["waste_capacity_mw", "other_capacity_mw", "energy_storage_capacity_mw"],
}

CATEGORIES = ["renewable", "fossil", "nuclear", "other"]

# ---------------------------------------------------------------------------
# FIXED VALUES: production-type (PSR) codes and their names.
# ---------------------------------------------------------------------------
PSR_TYPES: dict[str, str] = {
    "B01": "Biomass",
    "B02": "Fossil Brown coal/Lignite",
    "B03": "Fossil Coal-derived gas",
    "B04": "Fossil Gas",
    "B05": "Fossil Hard coal",
    "B06": "Fossil Oil",
    "B07": "Fossil Oil shale",
    "B08": "Fossil Peat",
    "B09": "Geothermal",
    "B10": "Hydro Pumped Storage",
    "B11": "Hydro Run-of-river and poundage",
    "B12": "Hydro Water Reservoir",
    "B13": "Marine",
    "B14": "Nuclear",
    "B15": "Other renewable",
    "B16": "Solar",
    "B17": "Waste",
    "B18": "Wind Offshore",
    "B19": "Wind Onshore",
    "B20": "Other",
    "B21": "AC Link",
    "B22": "DC Link",
    "B23": "Substation",
    "B24": "Transformer",
}

# FIXED VALUES: PSR codes counted as renewable for per-unit capacity.
RENEWABLE_PSR_TYPES = ["B01", "B09", "B10", "B11", "B12", "B13", "B15", "B16", "B18", "B19"]

# FIXED VALUES: display names of the country dimension; other codes show as is.
COUNTRY_NAMES: dict[str, str] = {
    "AT": "Austria",
    "BE": "Belgium",
    "DE": "Germany",
    "ES": "Spain",
    "FR": "France",
    "IT": "Italy",
    "NL": "Netherlands",
    "PT": "Portugal",
}

# FIXED VALUES: accepted country codes of the dimension's quality check.
ACCEPTED_COUNTRIES = ["AT", "BE", "DE", "ES", "FR", "IT", "NL", "PT", "UK"]

# FIXED VALUES: countries whose capacity comes from per-unit documents; the
# snapshot arm of the capacity mart keeps every other country.
PER_UNIT_COUNTRIES = ["FR", "UK", "IT", "NL", "BE", "AT", "ES", "DE"]
# FIXED VALUE: country taken from snapshots instead of per-unit documents.
SNAPSHOT_ONLY_COUNTRY = "PT"

# FIXED VALUES: bidding-zone (domain) codes of the per-unit capacity requests.
DOMAIN_CODES: dict[str, str] = {
    "FR": "10YFR-RTE------C",
    "UK": "10YGB----------A",
    "IT": "10YIT-GRTN-----B",
    "NL": "10YNL----------L",
    "BE": "10YBE----------2",
    "AT": "10YAT-APG------L",
    "ES": "10YES-REE------0",
    "PT": "10YPT-REN------W",
    "DE": "10Y1001A1001A83F",
}

# FIXED VALUES: bronze table per document type; other types get
# ``bronze_entsoe_<lower(type)>``.
BRONZE_TABLES: dict[str, str] = {
    "A75": "bronze_entsoe_a75_actual_generation",
    "A73": "bronze_entsoe_a73_generation_forecast",
    "A68": "bronze_entsoe_a68_installed_capacity",
}
A71_TABLE = "bronze_entsoe_a71_installed_capacity_per_unit"
BRONZE_TABLE_PREFIX = "bronze_entsoe_"

# FIXED VALUES: which extract each supported document type is.
DOCUMENT_EXTRACTS: dict[str, str] = {
    "A75": "generation",
    "A73": "generation_per_plant",
    "A68": "installed_generation_capacity",
}

# FIXED VALUES: ingestion defaults.
DEFAULT_FIRST_START = "2025-06-01"
MARKET_TIME_ZONE = "Europe/Brussels"
API_TIME_FORMAT = "yyyyMMddHHmm"
A71_NAMESPACE = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"
DATA_DOCUMENT_MARKER = "GL_MarketDocument"
ACK_DOCUMENT_MARKER = "Acknowledgement"

# FIXED VALUES: layer (database) names.
LAYERS = {"bronze": "analytics_bronze", "silver": "analytics_silver", "gold": "analytics_gold"}

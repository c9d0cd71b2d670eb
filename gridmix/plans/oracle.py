"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes a query from the raw test tables, independently of
the Spark code: the bronze adapters as CTEs (FIXTURES.md), then the model
logic written as plain SQL.  Sums of money-like values use the same
fixed-point totals as the Spark side (integers of 0.01).
"""

from __future__ import annotations

from gridmix.contracts import CAPACITY_RENAMES, GENERATION_RENAMES
from gridmix.functions import taxonomy as tx
from gridmix.operators.ingest import sanitize
from gridmix.sources.fixtures import COUNTRIES_9, COUNTRIES_10, INGESTION_TS, PLANT_NAMES

TS = f"TIMESTAMP '{INGESTION_TS}'"


def cyc(key: str, codes: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(codes))
    return f"CASE ({key}) % {len(codes)} {whens} END"


def piv(v: str, k: str, n: int, i: int) -> str:
    return f"CAST(sum(CASE WHEN ({k}) % {n} = {i} THEN CAST({v} AS DECIMAL(18,2)) END) AS DOUBLE)"


def xsum(expr: str) -> str:
    """Fixed-point SUM at 2 decimals, cast back to DOUBLE."""
    return f"(CAST(sum(CAST(round(({expr}) * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE))"


def share(part: str, total: str) -> str:
    return f"CASE WHEN {total} = 0 THEN NULL ELSE round({part} / {total} * 100, 2) END"


def lit_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def case_map(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


# ---------------------------------------------------------------------------
# Adapters (bronze stand-ins)
# ---------------------------------------------------------------------------

BRONZE_A75 = f"""bronze_a75 AS (
  SELECT {cyc('user_id', COUNTRIES_9)} AS country_code, date_trunc('hour', ts) AS "index",
    {', '.join(f"{piv('value', 'event_id', 20, i)} AS {c}" for i, c in enumerate(GENERATION_RENAMES))},
    'A75' AS document_type, {TS} AS ingestion_timestamp
  FROM events GROUP BY 1, 2)"""

BRONZE_A75_LONG = f"""bronze_a75 AS (
  SELECT {cyc('l_suppkey', COUNTRIES_9)} AS country_code, l_shipdate AS "index",
    {', '.join(f"{piv('l_extendedprice', 'l_partkey', 20, i)} AS {c}" for i, c in enumerate(GENERATION_RENAMES))},
    'A75' AS document_type, {TS} AS ingestion_timestamp
  FROM lineitem GROUP BY 1, 2)"""

BRONZE_A68 = f"""bronze_a68 AS (
  SELECT {cyc('o_custkey', COUNTRIES_10)} AS country_code, o_orderdate AS "index",
    {', '.join(f"{piv('o_totalprice', 'o_orderkey', 22, i)} AS {c}" for i, c in enumerate(CAPACITY_RENAMES))},
    'A68' AS document_type, {TS} AS ingestion_timestamp
  FROM orders GROUP BY 1, 2)"""

PSR_CODE = "CASE WHEN l_partkey % 26 < 25 THEN concat('B', lpad(CAST(l_partkey % 26 + 1 AS VARCHAR), 2, '0')) END"
ENERGY_TYPE = case_map("psr_type", tx.PSR_TYPES, "concat('Unknown (', coalesce(psr_type, 'None'), ')')")
IS_RENEWABLE = f"coalesce(psr_type IN ({lit_list(tx.RENEWABLE_PSR_TYPES)}), false)"

A71_UNITS = f"""a71_units AS (
  SELECT {cyc('l_suppkey', COUNTRIES_9)} AS country_code,
    concat('U', CAST(l_suppkey AS VARCHAR)) AS unit_id,
    concat('Unit ', CAST(l_suppkey AS VARCHAR)) AS unit_name,
    {PSR_CODE} AS psr_type,
    concat(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 'T00:00Z') AS period_start,
    concat(CAST(year(l_shipdate) AS VARCHAR), '-12-31T23:00Z') AS period_end,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS installed_capacity_mw,
    CASE WHEN l_suppkey % 3 = 0 THEN CAST(45 + l_suppkey % 10 AS DOUBLE) END AS latitude,
    CASE WHEN l_suppkey % 3 = 0 THEN CAST(5 + l_suppkey % 10 AS DOUBLE) END AS longitude
  FROM lineitem)"""

BRONZE_A71 = f"""bronze_a71 AS (
  SELECT *, {ENERGY_TYPE} AS energy_type, {IS_RENEWABLE} AS is_renewable,
    'A71' AS document_type, {TS} AS ingestion_timestamp
  FROM a71_units)"""

PLANT_COLS = [sanitize(p) for p in PLANT_NAMES]

BRONZE_A73 = f"""bronze_a73 AS (
  SELECT {cyc('user_id', COUNTRIES_9)} AS country_code, date_trunc('hour', ts) AS "index",
    {', '.join(f"{piv('value', 'user_id', 12, i)} AS {c}" for i, c in enumerate(PLANT_COLS))},
    'A73' AS document_type, {TS} AS ingestion_timestamp
  FROM events GROUP BY 1, 2)"""

# ---------------------------------------------------------------------------
# Models
# ---------------------------------------------------------------------------

STG_GENERATION = f"""stg_generation AS (
  SELECT country_code, document_type, ingestion_timestamp,
    CAST("index" AS TIMESTAMP) AS generation_datetime,
    {', '.join(f"{raw} AS {st}" for raw, st in GENERATION_RENAMES.items())}
  FROM bronze_a75)"""

STG_CAPACITY = f"""stg_capacity AS (
  SELECT country_code, document_type, ingestion_timestamp,
    CAST("index" AS TIMESTAMP) AS capacity_date,
    {', '.join(f"{raw} AS {st}" for raw, st in CAPACITY_RENAMES.items())}
  FROM bronze_a68)"""

STG_CAPACITY_PER_UNIT = """stg_capacity_per_unit AS (
  SELECT country_code, unit_id, unit_name, psr_type, energy_type, is_renewable,
    installed_capacity_mw, period_start, period_end, latitude, longitude,
    document_type, ingestion_timestamp
  FROM bronze_a71)"""

_DAILY = [st for st in list(GENERATION_RENAMES.values())[:13]]
GENERATION_DAILY = f"""generation_daily AS (
  SELECT country_code, CAST(generation_datetime AS DATE) AS generation_date,
    {', '.join(f"{xsum(f'coalesce({c}, 0)')} AS {c[:-3]}_mwh" for c in _DAILY)},
    count(*) AS hourly_records_count
  FROM stg_generation GROUP BY 1, 2)"""

DIM_COUNTRIES = f"""dim_countries AS (
  SELECT country_code, {case_map('country_code', tx.COUNTRY_NAMES, 'country_code')} AS country_name
  FROM (SELECT DISTINCT country_code FROM generation_daily))"""


def _totals(categories: dict[str, list[str]], suffix: str) -> str:
    return ",\n    ".join(
        "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + f") AS total_{cat}_{suffix}"
        for cat, cols in categories.items())


def _mix(src: str, keys: str, suffix: str, total: str, pct: str) -> str:
    parts = [f"total_{c}_{suffix}" for c in tx.CATEGORIES]
    t = "(" + " + ".join(parts) + ")"
    shares = ",\n    ".join(f"{share(p, t)} AS {c}_{pct}" for p, c in zip(parts, tx.CATEGORIES))
    return f"""SELECT {keys}, {', '.join(parts)}, {t} AS {total},
    {shares}
  FROM {src}"""


ENERGY_MIX = f"""category_totals AS (
  SELECT country_code, generation_date,
    {_totals(tx.GENERATION_CATEGORIES, 'mwh')}
  FROM generation_daily),
energy_mix AS (
  {_mix('category_totals', 'country_code, generation_date', 'mwh', 'total_production_mwh', 'percentage')})"""

CAPACITY_PER_UNIT = f"""capacity_per_unit AS (
  SELECT country_code, energy_type, is_renewable,
    {xsum('installed_capacity_mw')} AS total_capacity_mw,
    count(DISTINCT unit_id) AS number_of_units,
    max(period_start) AS latest_period_start,
    max(period_end) AS latest_period_end
  FROM stg_capacity_per_unit GROUP BY 1, 2, 3)"""

RENEWABLE_CAPACITY = f"""a68_arm AS (
  SELECT country_code, CAST(capacity_date AS DATE) AS capacity_date,
    {_totals(tx.CAPACITY_CATEGORIES, 'capacity_mw')}
  FROM stg_capacity
  WHERE country_code NOT IN ({lit_list(tx.PER_UNIT_COUNTRIES)})
  QUALIFY row_number() OVER (PARTITION BY country_code
                             ORDER BY capacity_date DESC, ingestion_timestamp DESC) = 1),
a71_arm AS (
  SELECT country_code,
    max(CAST(strptime(latest_period_start, '%Y-%m-%dT%H:%MZ') AS DATE)) AS capacity_date,
    {xsum('CASE WHEN is_renewable THEN total_capacity_mw ELSE 0 END')} AS total_renewable_capacity_mw,
    {xsum("CASE WHEN energy_type LIKE 'Fossil%' THEN total_capacity_mw ELSE 0 END")} AS total_fossil_capacity_mw,
    {xsum("CASE WHEN energy_type = 'Nuclear' THEN total_capacity_mw ELSE 0 END")} AS total_nuclear_capacity_mw,
    {xsum("CASE WHEN NOT is_renewable AND energy_type != 'Nuclear' AND energy_type NOT LIKE 'Fossil%' "
          "THEN total_capacity_mw ELSE 0 END")} AS total_other_capacity_mw
  FROM capacity_per_unit
  WHERE country_code != '{tx.SNAPSHOT_ONLY_COUNTRY}'
    AND country_code IN (SELECT country_code FROM dim_countries)
  GROUP BY country_code),
both_arms AS (SELECT * FROM a68_arm UNION ALL SELECT * FROM a71_arm),
renewable_capacity AS (
  {_mix('both_arms', 'country_code, capacity_date', 'capacity_mw', 'total_installed_capacity_mw',
        'capacity_percentage')})"""


def with_(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


GEN_CHAIN = (BRONZE_A75, STG_GENERATION, GENERATION_DAILY)
GEN_CHAIN_LONG = (BRONZE_A75_LONG, STG_GENERATION, GENERATION_DAILY)
UNIT_CHAIN = (A71_UNITS, BRONZE_A71, STG_CAPACITY_PER_UNIT, CAPACITY_PER_UNIT)


def renewable_capacity_sql(gen_chain=GEN_CHAIN) -> tuple[str, ...]:
    return (*gen_chain, DIM_COUNTRIES, *UNIT_CHAIN, BRONZE_A68, STG_CAPACITY, RENEWABLE_CAPACITY)


ORACLE: dict[str, str] = {
    "staging_generation": with_(BRONZE_A75, STG_GENERATION, final="SELECT * FROM stg_generation"),
    "staging_capacity": with_(BRONZE_A68, STG_CAPACITY, final="SELECT * FROM stg_capacity"),
    "staging_capacity_per_unit": with_(A71_UNITS, BRONZE_A71, STG_CAPACITY_PER_UNIT,
                                       final="SELECT * FROM stg_capacity_per_unit"),
    "staging_forecast": with_(BRONZE_A73, final=(
        "SELECT country_code, document_type, ingestion_timestamp, CAST(\"index\" AS TIMESTAMP) AS forecast_datetime, "
        "* EXCLUDE (country_code, document_type, ingestion_timestamp, \"index\") FROM bronze_a73")),
    "generation_daily": with_(*GEN_CHAIN, final="SELECT * FROM generation_daily"),
    "dim_countries": with_(*GEN_CHAIN, DIM_COUNTRIES, final="SELECT * FROM dim_countries ORDER BY country_code"),
    "energy_mix": with_(*GEN_CHAIN, ENERGY_MIX, final="SELECT * FROM energy_mix"),
    "capacity_per_unit": with_(*UNIT_CHAIN, final=(
        "SELECT * FROM capacity_per_unit ORDER BY country_code, total_capacity_mw DESC")),
    "renewable_capacity": with_(*renewable_capacity_sql(), final="SELECT * FROM renewable_capacity"),
}


# ---------------------------------------------------------------------------
# Per-unit documents
# ---------------------------------------------------------------------------

# A landed response is parsed when it is a data document that is well formed:
# see ``fixtures.a71_responses`` for how each line number is landed.
A71_FAILED = "(l_linenumber IN (4, 6, 7) OR (l_linenumber = 5 AND l_returnflag = 'R'))"

A71_PARSED = f"""a71_parsed AS (
  SELECT {cyc('l_suppkey', COUNTRIES_9)} AS country_code,
    concat('U', CAST(l_suppkey AS VARCHAR)) AS unit_id,
    concat('Unit ', CAST(l_suppkey AS VARCHAR)) AS unit_name,
    {PSR_CODE} AS psr_type,
    concat(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 'T00:00Z') AS period_start,
    concat(CAST(year(l_shipdate) AS VARCHAR), '-12-31T23:00Z') AS period_end,
    CASE WHEN l_linenumber = 3 THEN NULL
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS installed_capacity_mw,
    CASE WHEN l_suppkey % 3 = 0 THEN CAST(45 + l_suppkey % 10 AS DOUBLE) END AS latitude,
    CASE WHEN l_suppkey % 3 = 0 THEN CAST(5 + l_suppkey % 10 AS DOUBLE) END AS longitude
  FROM lineitem WHERE NOT {A71_FAILED})"""

RESPONSE_CLASS = """CASE WHEN l_linenumber = 5 AND l_returnflag = 'R' THEN 'failed'
       WHEN l_linenumber = 7 THEN 'no_data' WHEN l_linenumber = 6 THEN 'unknown' ELSE 'data' END"""

ORACLE.update({
    "a71_parse": with_(A71_PARSED, final="SELECT * FROM a71_parsed"),
    "a71_enrich": with_(A71_PARSED, final=(
        f"SELECT *, {ENERGY_TYPE} AS energy_type, {IS_RENEWABLE} AS is_renewable, "
        f"'A71' AS document_type, {TS} AS ingestion_timestamp FROM a71_parsed")),
    "a71_response_class": (
        f"SELECT {cyc('l_suppkey', COUNTRIES_9)} AS country_code, {RESPONSE_CLASS} AS response_class, "
        "count(*) AS n_responses FROM lineitem GROUP BY 1, 2"),
    "a71_ingest_summary": (
        f"SELECT CASE WHEN {A71_FAILED} THEN 'failed' ELSE 'success' END AS status, count(*) AS n_responses, "
        f"CAST(sum(CASE WHEN {A71_FAILED} THEN 0 ELSE 1 END) AS BIGINT) AS n_rows FROM lineitem GROUP BY 1"),
})

_UNIT_COLUMNS = f"""{cyc('l_suppkey', COUNTRIES_9)} AS country_code,
    concat('U', CAST(l_suppkey AS VARCHAR)) AS unit_id, concat('Unit ', CAST(l_suppkey AS VARCHAR)) AS unit_name, {PSR_CODE} AS psr_type,
    concat(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 'T00:00Z') AS period_start,
    concat(CAST(year(l_shipdate) AS VARCHAR), '-12-31T23:00Z') AS period_end,
    CASE WHEN l_suppkey % 3 = 0 THEN CAST(45 + l_suppkey % 10 AS DOUBLE) END AS latitude,
    CASE WHEN l_suppkey % 3 = 0 THEN CAST(5 + l_suppkey % 10 AS DOUBLE) END AS longitude"""

# The run of ``responses_to_bronze`` does not request NL; PT lands nothing, CH has no domain code.
_REQUESTED = "country_code NOT IN ('NL', 'PT')"
ORACLE.update({
    # an order's document in a country is cut off when 7 divides its key
    "a71_parse_nested": " UNION ALL ".join(
        f"SELECT {_UNIT_COLUMNS}, CAST(CAST({q} AS DECIMAL(18,2)) AS DOUBLE) AS installed_capacity_mw FROM lineitem WHERE l_orderkey % 7 <> 0"
        for q in ("l_extendedprice", "l_quantity", "l_discount")),
    "a71_series_scan": (
        f"SELECT * FROM (SELECT {_UNIT_COLUMNS}, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS installed_capacity_mw, "
        "l_orderkey % 4 AS part FROM lineitem) WHERE NOT (country_code = 'FR' AND part = 3)").replace("SELECT * FROM (", "SELECT * EXCLUDE (part) FROM (", 1),
    "responses_to_bronze": with_(A71_PARSED, final=(
        f"SELECT *, {ENERGY_TYPE} AS energy_type, {IS_RENEWABLE} AS is_renewable, "
        f"'A71' AS document_type, {TS} AS ingestion_timestamp FROM a71_parsed WHERE {_REQUESTED}")),
    "per_unit_outcomes": f"""
SELECT country_code, CASE WHEN n_rows > 0 THEN 'success' ELSE 'failed' END AS status, n_responses, n_rows
FROM (SELECT {cyc('l_suppkey', COUNTRIES_9)} AS country_code, count(*) AS n_responses,
        CAST(sum(CASE WHEN {A71_FAILED} THEN 0 ELSE 1 END) AS BIGINT) AS n_rows FROM lineitem GROUP BY 1)
WHERE {_REQUESTED}
UNION ALL SELECT 'PT', 'missing', 0, 0 UNION ALL SELECT 'CH', 'skipped', 0, 0""",
})

# ---------------------------------------------------------------------------
# Ingestion
# ---------------------------------------------------------------------------


def _sanitize_sql(expr: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({expr}), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_')"


def _utc(ts: str) -> str:
    return f"timezone('UTC', timezone('{tx.MARKET_TIME_ZONE}', {ts}))"


TABLE_NAME = case_map("document_type", tx.BRONZE_TABLES, "concat('bronze_entsoe_', lower(document_type))")

BRONZE_A75_LONG_AS = BRONZE_A75_LONG.replace("bronze_a75 AS (", "bronze_a75_long AS (", 1)
DOCS = "(VALUES ('A75'), ('A73'), ('A68')) d(document_type)"


def _marks(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{doc}' AS document_type, country_code, max(CAST(\"index\" AS DATE)) AS last_date "
        f"FROM {t} GROUP BY country_code" for doc, t in tables.items())


def _plan(countries_sql: str, marks_sql: str, end: str, default_start: str) -> str:
    return f"""keys AS (
  SELECT c.country_code, d.document_type FROM (SELECT DISTINCT country_code FROM ({countries_sql})) c
  CROSS JOIN {DOCS}),
marks AS ({marks_sql}),
planned AS (
  SELECT k.country_code, k.document_type, m.last_date,
    coalesce(CAST(m.last_date + 1 AS DATE), DATE '{default_start}') AS start_date
  FROM keys k LEFT JOIN marks m ON k.country_code = m.country_code AND k.document_type = m.document_type),
plan AS (
  SELECT country_code, document_type, {TABLE_NAME} AS table_name, 'incremental' AS mode, last_date, start_date,
    DATE '{end}' AS end_date,
    CASE WHEN start_date > DATE '{end}' THEN 'skip' ELSE 'fetch' END AS action,
    {_utc('CAST(start_date AS TIMESTAMP)')} AS request_start_utc,
    {_utc(f"TIMESTAMP '{end} 00:00:00'")} AS request_end_utc,
    strftime(CAST(start_date AS TIMESTAMP), '%Y%m%d%H%M') AS period_start_param,
    strftime(TIMESTAMP '{end} 00:00:00', '%Y%m%d%H%M') AS period_end_param
  FROM planned)"""


_AGG_COLS = [c for c in GENERATION_RENAMES if c.endswith("_actual_aggregated")]
LOAD_TS_SQL = "TIMESTAMP '2026-03-14 06:00:00'"

APPENDED = f"""appended AS (
  SELECT country_code, document_type, ingestion_timestamp, "index", {', '.join(_AGG_COLS)} FROM bronze_a75
  UNION ALL BY NAME
  SELECT country_code, document_type, {LOAD_TS_SQL} AS ingestion_timestamp, "index", {', '.join(GENERATION_RENAMES)}
  FROM bronze_a75_long
  WHERE "index" >= {_utc("TIMESTAMP '1995-01-01 00:00:00'")} AND "index" < {_utc("TIMESTAMP '2001-06-30 00:00:00'")})"""

ORACLE.update({
    "sanitized_names": (
        "SELECT p_partkey, concat_ws('/', p_name, p_brand) AS raw_name, "
        + _sanitize_sql("concat_ws('/', p_name, p_brand)") + " AS column_name, "
        + _sanitize_sql("trim(concat_ws('_', p_type, p_brand))") + " AS flat_name FROM part"),
    "high_water_mark": with_(BRONZE_A75, BRONZE_A73, BRONZE_A68, final=_marks(
        {"A75": "bronze_a75", "A73": "bronze_a73", "A68": "bronze_a68"})),
    "high_water_mark_a71": with_(A71_UNITS, final=(
        "SELECT country_code, max(CAST(strptime(period_start, '%Y-%m-%dT%H:%MZ') AS DATE)) AS last_date "
        "FROM a71_units GROUP BY 1")),
    "ingest_window_plan": with_(
        BRONZE_A75, BRONZE_A73, BRONZE_A68,
        _plan("SELECT country_code FROM bronze_a75 UNION ALL SELECT country_code FROM bronze_a73 "
              "UNION ALL SELECT country_code FROM bronze_a68",
              _marks({"A75": "bronze_a75", "A73": "bronze_a73", "A68": "bronze_a68"}),
              end="2024-01-20", default_start="2024-01-01"),
        final="SELECT * FROM plan"),
    "ingest_append": with_(BRONZE_A75, BRONZE_A75_LONG_AS, APPENDED, final="SELECT * FROM appended"),
    "ingest_summary": with_(
        BRONZE_A75, BRONZE_A75_LONG_AS, BRONZE_A68,
        _plan("SELECT country_code FROM bronze_a75 UNION ALL SELECT country_code FROM bronze_a75_long "
              "UNION ALL SELECT country_code FROM bronze_a68",
              _marks({"A75": "bronze_a75"}), end="2001-06-30", default_start="1995-01-01"),
        """landed AS (
  SELECT country_code, 'A75' AS document_type, "index" FROM bronze_a75_long
  UNION ALL SELECT country_code, 'A68' AS document_type, "index" FROM bronze_a68),
counts AS (
  SELECT p.country_code, p.document_type, count(*) AS n FROM plan p
  JOIN landed l ON p.country_code = l.country_code AND p.document_type = l.document_type
  WHERE p.action = 'fetch' AND l."index" >= p.request_start_utc AND l."index" < p.request_end_utc
  GROUP BY 1, 2),
outcomes AS (
  SELECT CASE WHEN p.action = 'skip' THEN 'skipped' WHEN coalesce(c.n, 0) > 0 THEN 'updated' ELSE 'failed' END
      AS status,
    CASE WHEN p.action = 'skip' THEN 0 ELSE coalesce(c.n, 0) END AS n
  FROM plan p LEFT JOIN counts c ON p.country_code = c.country_code AND p.document_type = c.document_type)""",
        final="SELECT status, count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows FROM outcomes GROUP BY 1"),
    "table_names": with_(BRONZE_A75, BRONZE_A73, BRONZE_A68, final=f"""
SELECT document_type, {TABLE_NAME} AS table_name,
  {case_map('document_type', tx.DOCUMENT_EXTRACTS, 'NULL')} AS extract_kind,
  document_type IN ({lit_list(list(tx.DOCUMENT_EXTRACTS))}) AS supported, n_rows
FROM (SELECT document_type, count(*) AS n_rows FROM (
  SELECT document_type FROM bronze_a75 UNION ALL SELECT document_type FROM bronze_a73
  UNION ALL SELECT document_type FROM bronze_a68 UNION ALL SELECT 'A71' AS document_type FROM lineitem)
  GROUP BY 1)"""),
    "country_subset": with_(BRONZE_A68, final=f"""
SELECT country_code, domain_code, CASE WHEN domain_code IS NULL THEN 'skipped' ELSE 'requested' END AS status
FROM (SELECT country_code, {case_map('country_code', tx.DOMAIN_CODES, 'NULL')} AS domain_code
      FROM (SELECT DISTINCT country_code FROM bronze_a68))"""),
})

# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

_MODEL_CTE = {"int_generation_daily": "generation_daily", "dim_countries": "dim_countries",
              "fct_energy_mix": "energy_mix", "fct_renewable_capacity": "renewable_capacity"}
GOLD = (*renewable_capacity_sql(), ENERGY_MIX)


def _dq_failing(check) -> tuple[str, str]:
    """(value expression, FROM ... WHERE ...) of a check's failing rows."""
    m = _MODEL_CTE[check.model]
    c = check.column
    if check.test == "not_null":
        return c, f"{m} WHERE {c} IS NULL"
    if check.test == "unique":
        return "unique_field", (f"(SELECT {c} AS unique_field, count(*) AS n_records FROM {m} "
                                f"WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    if check.test == "accepted_values":
        return "value_field", (f"(SELECT {c} AS value_field, count(*) AS n_records FROM {m} GROUP BY 1) "
                               f"WHERE value_field NOT IN ({lit_list(check.values)})")
    if check.test == "relationships":
        p = _MODEL_CTE[check.parent]
        return f"ch.{c}", (f"{m} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                           f"(SELECT 1 FROM {p} pa WHERE pa.{check.parent_column} = ch.{c})")
    raise ValueError(check.test)


def _dq_keys(test: str) -> str:
    from gridmix.operators.quality import CHECKS

    parts = []
    for ch in CHECKS:
        if ch.test != test:
            continue
        value, src = _dq_failing(ch)
        parts.append(f"SELECT '{ch.test_id}' AS test_id, '{ch.model}' AS model, '{ch.column}' AS column_name, "
                     f"CAST({value} AS VARCHAR) AS value FROM {src}")
    return with_(*GOLD, final="\nUNION ALL\n".join(parts))


def _dq_report() -> str:
    from gridmix.operators.quality import CHECKS

    parts = []
    for ch in CHECKS:
        _, src = _dq_failing(ch)
        parts.append(f"SELECT '{ch.test_id}' AS test_id, '{ch.test}' AS test, '{ch.model}' AS model, "
                     f"'{ch.column}' AS column_name, count(*) AS failures FROM {src}")
    return with_(*GOLD, final="\nUNION ALL\n".join(parts))


ORACLE.update({
    "dq_not_null": _dq_keys("not_null"),
    "dq_unique": _dq_keys("unique"),
    "dq_accepted_values": _dq_keys("accepted_values"),
    "dq_relationships": _dq_keys("relationships"),
    "dq_report": _dq_report(),
})

# ---------------------------------------------------------------------------
# Reports (long generation history)
# ---------------------------------------------------------------------------

LONG_MIX = (*GEN_CHAIN_LONG, ENERGY_MIX)
_E = [f"total_{c}_mwh" for c in tx.CATEGORIES]


def _energy_sums() -> str:
    return ", ".join(f"{xsum(c)} AS {c}" for c in (*_E, "total_production_mwh"))


def _energy_shares() -> str:
    return ", ".join(f"{share(f'total_{c}_mwh', 'total_production_mwh')} AS {c}_percentage" for c in tx.CATEGORIES)


COUNTRY_MIX = f"""country_mix AS (
  SELECT country_code, days, {', '.join(_E)}, total_production_mwh, {_energy_shares()}
  FROM (SELECT country_code, count(*) AS days, {_energy_sums()} FROM energy_mix GROUP BY 1))"""

ORACLE.update({
    "report_overview": with_(*LONG_MIX, final=f"""
SELECT generation_date, countries, {', '.join(_E)}, total_production_mwh, {_energy_shares()}
FROM (SELECT generation_date, count(DISTINCT country_code) AS countries, {_energy_sums()}
      FROM energy_mix GROUP BY 1)"""),
    "report_country_mix": with_(*LONG_MIX, COUNTRY_MIX, final="SELECT * FROM country_mix"),
    "report_monthly_trend": with_(*LONG_MIX, final=f"""
SELECT country_code, month, total_renewable_mwh, total_fossil_mwh, total_production_mwh,
  {share('total_renewable_mwh', 'total_production_mwh')} AS renewable_percentage,
  {share('total_fossil_mwh', 'total_production_mwh')} AS fossil_percentage
FROM (SELECT country_code, CAST(date_trunc('month', generation_date) AS DATE) AS month,
        {xsum('total_renewable_mwh')} AS total_renewable_mwh, {xsum('total_fossil_mwh')} AS total_fossil_mwh,
        {xsum('total_production_mwh')} AS total_production_mwh
      FROM energy_mix GROUP BY 1, 2)"""),
    "report_ranking": with_(*LONG_MIX, COUNTRY_MIX, final="""
SELECT country_code, renewable_percentage, fossil_percentage, total_production_mwh,
  rank() OVER (ORDER BY renewable_percentage DESC NULLS LAST) AS renewable_rank
FROM country_mix"""),
    "report_capacity_share": with_(*UNIT_CHAIN, final=f"""
SELECT country_code, energy_type, is_renewable, total_capacity_mw, number_of_units, country_total_capacity_mw,
  {share('total_capacity_mw', 'country_total_capacity_mw')} AS capacity_share_percentage
FROM (SELECT *, CAST(sum(CAST(round(total_capacity_mw * 100) AS BIGINT)) OVER (PARTITION BY country_code) AS DOUBLE)
                / CAST(100 AS DOUBLE) AS country_total_capacity_mw
      FROM capacity_per_unit)"""),
    "report_capacity_vs_production": with_(*renewable_capacity_sql(GEN_CHAIN_LONG), ENERGY_MIX, COUNTRY_MIX, final="""
SELECT r.country_code, r.capacity_date, r.total_installed_capacity_mw, r.renewable_capacity_percentage,
  m.days, m.total_production_mwh, m.renewable_percentage,
  round(m.renewable_percentage - r.renewable_capacity_percentage, 2) AS renewable_gap_points
FROM renewable_capacity r JOIN country_mix m ON r.country_code = m.country_code"""),
    "report_country_detail": with_(*LONG_MIX, final="""
SELECT * FROM energy_mix
WHERE country_code = 'FR' AND generation_date >= DATE '1997-01-01' AND generation_date <= DATE '1997-12-31'
ORDER BY generation_date"""),
})

# STR1: the stream's output is every landed per-plant row once, sanitised and stamped.
ORACLE["stream_append"] = with_(BRONZE_A73, final="SELECT * FROM bronze_a73")

# ING3: start given without end -> January 1 of the run's year to the run time.
ORACLE["a71_request_plan"] = with_(BRONZE_A68, final=f"""
SELECT country_code, domain_code, CASE WHEN domain_code IS NULL THEN 'skipped' ELSE 'requested' END AS status,
  period_start, period_end,
  strftime(period_start, '%Y%m%d%H%M') AS period_start_param, strftime(period_end, '%Y%m%d%H%M') AS period_end_param
FROM (SELECT country_code, {case_map('country_code', tx.DOMAIN_CODES, 'NULL')} AS domain_code,
        CASE WHEN req_start IS NULL OR req_end IS NULL THEN CAST(date_trunc('year', run_now) AS TIMESTAMP)
             ELSE req_start END AS period_start,
        CASE WHEN req_start IS NULL OR req_end IS NULL THEN run_now ELSE req_end END AS period_end
      FROM (SELECT {cyc('l_suppkey', COUNTRIES_9)} AS country_code FROM lineitem
            UNION SELECT country_code FROM bronze_a68),
           (SELECT CAST(NULL AS TIMESTAMP) AS req_start, TIMESTAMP '2026-02-01 00:00:00' AS req_end,
                   TIMESTAMP '2026-03-13 06:00:00' AS run_now))""")

# PRJ12 + M1 over the appended bronze of ``ingest_append``.
ORACLE["schema_evolution"] = with_(BRONZE_A75, BRONZE_A75_LONG_AS, APPENDED,
                                   STG_GENERATION.replace("FROM bronze_a75)", "FROM appended)"),
                                   final="SELECT * FROM stg_generation")

# SRC6 / S19: explicit window from a winter to a summer date, for every landed key.
ORACLE["window_bounds_utc"] = with_(BRONZE_A75, BRONZE_A68, final=f"""
SELECT country_code, document_type, DATE '2024-01-15' AS start_date, DATE '2024-07-15' AS end_date,
  {_utc("TIMESTAMP '2024-01-15 00:00:00'")} AS request_start_utc,
  {_utc("TIMESTAMP '2024-07-15 00:00:00'")} AS request_end_utc,
  strftime(TIMESTAMP '2024-01-15 00:00:00', '%Y%m%d%H%M') AS period_start_param,
  strftime(TIMESTAMP '2024-07-15 00:00:00', '%Y%m%d%H%M') AS period_end_param
FROM (SELECT DISTINCT country_code, document_type FROM (
  SELECT country_code, document_type FROM bronze_a75 UNION ALL SELECT country_code, document_type FROM bronze_a68))""")


# ---------------------------------------------------------------------------
# The warehouse path
# ---------------------------------------------------------------------------

_CONSUMPTION = [st for raw, st in GENERATION_RENAMES.items() if not raw.endswith("_actual_aggregated")]
ORACLE |= {
    "bronze_roundtrip": with_(BRONZE_A75, STG_GENERATION, final=(
        "SELECT * REPLACE (" + ", ".join(f"CASE WHEN day(generation_datetime) > 15 THEN {c} END AS {c}" for c in _CONSUMPTION)
        + ") FROM stg_generation")),
    "high_water_mark_partitioned": with_(BRONZE_A75_LONG, final=(
        'SELECT country_code, max(CAST("index" AS DATE)) AS last_date FROM bronze_a75 GROUP BY country_code')),
    "capacity_per_unit_refresh": with_(*UNIT_CHAIN, final="SELECT * FROM capacity_per_unit"),
    "landed_mixed_shapes": with_(BRONZE_A75, STG_GENERATION, final=(
        "SELECT * REPLACE (" + ", ".join(
            f"CASE WHEN country_code IN ('DE', 'ES') THEN floor({c}) ELSE {c} END AS {c}" for c in GENERATION_RENAMES.values())
        + ") FROM stg_generation")),
    # countries before DE land no consumption columns; bad lines of BE and FR are kept apart
    "landed_csv": with_(BRONZE_A75_LONG, STG_GENERATION, final="SELECT * REPLACE (" + ", ".join(
        f"CASE WHEN country_code >= 'DE' THEN {st} END AS {st}" for raw, st in GENERATION_RENAMES.items() if raw.endswith("_actual_consumption"))
        + ") FROM stg_generation WHERE NOT (country_code = 'BE' AND day(generation_datetime) = 13) AND NOT (country_code = 'FR' AND day(generation_datetime) = 14)"),
    "landed_csv_rejected": with_(BRONZE_A75_LONG, final=(
        "SELECT country_code, CASE country_code WHEN 'BE' THEN 'not a number' ELSE 'wrong number of cells' END AS reason, "
        "count(*) AS n_lines, count(DISTINCT day(\"index\") % 3) AS n_files FROM bronze_a75 "
        "WHERE (country_code = 'BE' AND day(\"index\") = 13) OR (country_code = 'FR' AND day(\"index\") = 14) GROUP BY 1, 2")),
    "daily_refresh": with_(*GEN_CHAIN_LONG, final="SELECT * FROM generation_daily"),
    "stream_into_warehouse": with_(*GEN_CHAIN_LONG, final="SELECT * FROM generation_daily"),
    # the first load (days up to the 10th) has no consumption columns
    "layer_views": with_(BRONZE_A75, STG_GENERATION, final="SELECT * REPLACE (" + ", ".join(
        f"CASE WHEN day(generation_datetime) > 10 THEN {st} END AS {st}" for raw, st in GENERATION_RENAMES.items() if raw.endswith("_actual_consumption"))
        + ") FROM stg_generation"),
    "layer_tables": with_(*GEN_CHAIN, ENERGY_MIX, final="SELECT * FROM energy_mix"),
    "generation_daily_double": with_(BRONZE_A75, STG_GENERATION, final=(
        "SELECT country_code, CAST(generation_datetime AS DATE) AS generation_date, "
        + ", ".join(f"round(sum(coalesce({c}, 0)), 4) AS {c[:-3]}_mwh" for c in _DAILY)
        + ", count(*) AS hourly_records_count FROM stg_generation GROUP BY 1, 2")),
}

BROKEN = (
    *GEN_CHAIN, DIM_COUNTRIES,
    "broken_daily AS (SELECT * REPLACE (nullif(country_code, 'BE') AS country_code) FROM generation_daily)",
    "broken_dim AS (SELECT * FROM dim_countries UNION ALL SELECT * FROM dim_countries WHERE country_code IN ('FR', 'DE') "
    "UNION ALL SELECT 'CH', NULL FROM dim_countries WHERE country_code = 'BE')",
)


def _broken(test: str, model: str, column: str, value: str, source: str) -> str:
    return f"SELECT '{test}_{model}_{column}' AS test_id, '{model}' AS model, '{column}' AS column_name, CAST({value} AS VARCHAR) AS value FROM {source}"


ORACLE |= {
    "dq_not_null_violations": with_(*BROKEN, final=" UNION ALL ".join(
        _broken("not_null", m, c, "NULL", f"{t} WHERE {c} IS NULL") for m, t, c in (
            ("int_generation_daily", "broken_daily", "country_code"), ("int_generation_daily", "broken_daily", "generation_date"),
            ("dim_countries", "broken_dim", "country_code"), ("dim_countries", "broken_dim", "country_name")))),
    "dq_unique_violations": with_(*BROKEN, final=_broken(
        "unique", "dim_countries", "country_code", "country_code",
        "(SELECT country_code FROM broken_dim WHERE country_code IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")),
    "dq_accepted_values_violations": with_(*BROKEN, final=_broken(
        "accepted_values", "dim_countries", "country_code", "country_code",
        "(SELECT DISTINCT country_code FROM broken_dim WHERE country_code NOT IN ('AT', 'BE', 'DE', 'ES', 'FR', 'IT', 'NL', 'PT', 'UK'))")),
}

"""Column-expression builders (scalar functions S1-S25).

All of them return ``Column`` objects made of built-in Spark expressions, so
they stay inside whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmix.functions import taxonomy as tx

ColumnOrName = Column | str

# Pattern of ISO-8601 stamps as documents carry them ("2025-07-01T22:00Z"):
# seconds, fraction and zone optional; an offset such as +02:00 is applied,
# and a stamp without a zone is read in the session zone (UTC).
ISO_MINUTE_PATTERN = "yyyy-MM-dd'T'HH:mm[:ss][.SSS][XXX]"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_if_null(c: ColumnOrName) -> Column:
    """``coalesce(x, 0)``."""
    return F.coalesce(col(c), F.lit(0.0))


def add_all(cols: list[ColumnOrName]) -> Column:
    """Left-to-right ``+`` chain (order kept for float equality)."""
    return reduce(add, [col(c) for c in cols])


def zero_filled_total(cols: list[ColumnOrName]) -> Column:
    """S1+S2: ``coalesce(a,0) + coalesce(b,0) + ...``."""
    return add_all([zero_if_null(c) for c in cols])


def share(part: ColumnOrName, total: ColumnOrName, digits: int = 2) -> Column:
    """``CASE WHEN total = 0 THEN NULL ELSE round(part / total * 100, d) END``.

    A NULL total gives NULL as well; the guard keeps ANSI division from raising.
    """
    t = col(total)
    return F.when(t != 0, F.round(col(part) / t * F.lit(100.0), digits))


def total_sum(c: ColumnOrName, exact_scale: int | None = None) -> Column:
    """SUM aggregate of a DOUBLE column.

    ``exact_scale=None`` sums doubles, as the warehouse does.  With a scale
    ``s`` the values are summed as integers of 10^-s units (fixed point), which
    makes totals exact and independent of the order partial sums are merged
    in; the result is cast back to DOUBLE.  NULL inputs are skipped and an
    all-NULL group stays NULL, as with SUM.
    """
    return from_units(F.sum(to_units(c, exact_scale)), exact_scale)


def to_units(c: ColumnOrName, exact_scale: int | None) -> Column:
    """A value as the summand of ``total_sum`` (a LONG count of 10^-s units)."""
    c = col(c)
    if exact_scale is None:
        return c
    return F.round(c * F.lit(float(10 ** exact_scale))).cast("long")


def from_units(summed: Column, exact_scale: int | None) -> Column:
    """Back from a sum of ``to_units`` values to a DOUBLE total."""
    if exact_scale is None:
        return summed
    return summed.cast("double") / F.lit(float(10 ** exact_scale))


def windowed_total(c: ColumnOrName, window, exact_scale: int | None = None) -> Column:
    """``sum(c) OVER window`` with the same fixed-point option as ``total_sum``."""
    c = col(c)
    if exact_scale is None:
        return F.sum(c).over(window)
    unit = float(10 ** exact_scale)
    return F.sum(F.round(c * F.lit(unit)).cast("long")).over(window).cast("double") / F.lit(unit)


def parse_iso_instant(c: ColumnOrName) -> Column:
    """ISO stamp string (seconds optional) -> TIMESTAMP; bad text -> NULL."""
    return F.try_to_timestamp(col(c), F.lit(ISO_MINUTE_PATTERN))


def to_day(c: ColumnOrName) -> Column:
    """``date(ts)`` in the session zone (UTC)."""
    return F.to_date(col(c))


def map_literal(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def lookup(mapping: dict[str, str], key: ColumnOrName) -> Column:
    """Dictionary lookup against a literal map; a missing or NULL key gives NULL."""
    return F.try_element_at(map_literal(mapping), col(key))


def psr_energy_type(psr: ColumnOrName) -> Column:
    """PRJ11 / S17: PSR code -> energy type name, else ``Unknown (<code>)``.

    A NULL code is rendered as ``None``, the way the ingestion formatted it.
    """
    p = col(psr)
    unknown = F.concat(F.lit("Unknown ("), F.coalesce(p, F.lit("None")), F.lit(")"))
    return F.coalesce(lookup(tx.PSR_TYPES, p), unknown)


def psr_is_renewable(psr: ColumnOrName) -> Column:
    """Membership in the renewable PSR list; NULL -> False."""
    return F.coalesce(col(psr).isin(tx.RENEWABLE_PSR_TYPES), F.lit(False))


def country_name(code: ColumnOrName) -> Column:
    """Simple CASE with the code itself as default."""
    return F.coalesce(lookup(tx.COUNTRY_NAMES, code), col(code))


def sanitize_name(c: ColumnOrName) -> Column:
    """S15 / PRJ6 as a column: lower, non ``[a-z0-9_]`` -> ``_``, squeeze, strip."""
    cleaned = F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9_]", "_"), "_+", "_")
    return F.trim(cleaned, F.lit("_"))


def flatten_name(*levels: ColumnOrName) -> Column:
    """PRJ7 / S24: join the levels of a two-level column name with ``_``."""
    return F.trim(F.concat_ws("_", *[col(x) for x in levels]))


def bronze_table_name(document_type: ColumnOrName) -> Column:
    """SNK8: mapped bronze table, else ``bronze_entsoe_<lower(type)>``."""
    d = col(document_type)
    return F.coalesce(lookup(tx.BRONZE_TABLES, d), F.concat(F.lit(tx.BRONZE_TABLE_PREFIX), F.lower(d)))


def response_class(body: ColumnOrName, http_status: ColumnOrName) -> Column:
    """FLT5 / S16: classify a landed API response.

    Status other than 200 -> ``failed``; a market document -> ``data``; an
    acknowledgement -> ``no_data``; anything else -> ``unknown``.
    """
    b = col(body)
    return (
        F.when(F.coalesce(col(http_status) != 200, F.lit(True)), F.lit("failed"))
        .when(b.contains(tx.DATA_DOCUMENT_MARKER), F.lit("data"))
        .when(b.contains(tx.ACK_DOCUMENT_MARKER), F.lit("no_data"))
        .otherwise(F.lit("unknown"))
    )


def market_time_to_utc(c: ColumnOrName) -> Column:
    """SRC6: a wall-clock time in the market zone -> UTC instant."""
    return F.to_utc_timestamp(col(c), tx.MARKET_TIME_ZONE)


def api_time(c: ColumnOrName) -> Column:
    """Format a stamp as the request parameter ``yyyyMMddHHmm``."""
    return F.date_format(col(c), tx.API_TIME_FORMAT)

"""Per-unit installed capacity documents: classify, parse, enrich (FLT5, SRC7, PRJ11).

Parsing is ``from_xml`` with an explicit schema followed by explodes; it runs
per document in the task that holds it, with no keyed shuffle (a caller may
spread a low-partition input first, ``joins.spread``).  Landed responses hold
one document each; a response too large for one row is read by element with
``landing.read_series`` and turned into rows by ``series_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions import exprs as X

_S = T.StringType()

_MANY = T.ArrayType(_S)  # of a repeated element the first one counts

# Reading schema of a market document (only the fields the rows need).
MARKET_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("TimeSeries", T.ArrayType(T.StructType([
        T.StructField("registeredResource.mRID", _MANY),
        T.StructField("registeredResource.name", _MANY),
        T.StructField("MktPSRType", T.ArrayType(T.StructType([T.StructField("psrType", _MANY)]))),
        T.StructField("location", T.ArrayType(T.StructType([
            T.StructField("latitude", _MANY), T.StructField("longitude", _MANY)]))),
        T.StructField("Period", T.ArrayType(T.StructType([
            T.StructField("timeInterval.start", _MANY),
            T.StructField("timeInterval.end", _MANY),
            T.StructField("Point", T.ArrayType(T.StructType([T.StructField("quantity", _MANY)]))),
        ]))),
    ]))),
    T.StructField("_corrupt_record", _S),
])

# Attributes are not read; element prefixes (``ns:TimeSeries``) are ignored, so
# documents with a default namespace and prefixed ones parse alike.
XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "excludeAttribute": "true",
               "ignoreNamespace": "true"}

# Text that is a decimal number (a cast alone also takes suffixes such as ``12d``).
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(text: Column) -> Column:
    """The text as DOUBLE, NULL unless it is a decimal number."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def request_plan(countries: DataFrame, start: str | None, end: str | None, now: str) -> DataFrame:
    """ING3 + FLT7 + S19 + S21: one request per country for per-unit documents.

    Both dates are needed; when either is missing the window is January 1 of
    ``now``'s year to ``now``.  Countries without a domain code are
    ``skipped``.  Request bounds are formatted as given (no zone shift).
    """
    from gridmix.functions import taxonomy as tx

    now_ts = F.to_timestamp(F.lit(now))
    start_ts, end_ts = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    incomplete = start_ts.isNull() | end_ts.isNull()
    period_start = F.when(incomplete, F.trunc(now_ts, "year").cast("timestamp")).otherwise(start_ts)
    period_end = F.when(incomplete, now_ts).otherwise(end_ts)
    domain = X.lookup(tx.DOMAIN_CODES, "country_code")
    return countries.select("country_code").distinct().select(
        "country_code",
        domain.alias("domain_code"),
        F.when(domain.isNull(), F.lit("skipped")).otherwise(F.lit("requested")).alias("status"),
        period_start.alias("period_start"),
        period_end.alias("period_end"),
        X.api_time(period_start).alias("period_start_param"),
        X.api_time(period_end).alias("period_end_param"),
    )


def classify_responses(responses: DataFrame) -> DataFrame:
    """FLT5: add ``response_class`` (data / no_data / unknown / failed)."""
    return responses.withColumn("response_class", X.response_class("body", "http_status"))


SERIES_SCHEMA: T.StructType = MARKET_DOCUMENT_SCHEMA["TimeSeries"].dataType.elementType


# Documents whose series, periods or points hang below elements of other names: the tags that rows are read from (most frequent first) ...
_KNOWN = (r"quantity|Point|Period|timeInterval\.(?:start|end)|TimeSeries|registeredResource\.(?:mRID|name)|MktPSRType|psrType|location"
          r"|latitude|longitude")
_PREFIXED = rf"[\w.-]++:(?:{_KNOWN})"
_ATTRIBUTES = r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+"
# ... stay, without prefix and attributes (groups 1 to 5); comments, declarations and all other tags go, their content stays.
# One pass, which leaves a plain known tag at once.
TAGS = (rf"(?s)(?=<)(?!</?+(?:{_KNOWN})/?>)(?:<(?:/?+(?!(?:{_KNOWN}|{_PREFIXED})[\s/>])[A-Za-z_]{_ATTRIBUTES}>|!--.*?-->|\?.*?\?>|!DOCTYPE[^>]*>)"
        rf"|(<)(/?)(?:[\w.-]++:)?+({_KNOWN})(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)?(/?)(>))")
QUANTITY = r"<(?:quantity|[\w.-]++:quantity)[\s>]"


def unwrapped(body: Column) -> Column:
    """The document with every series directly below the root, every period below its series, and so on."""
    return F.concat(F.lit("<document>"), F.regexp_replace(body, TAGS, "$1$2$3$4$5"), F.lit("</document>"))


def _quantities(series: Column) -> Column:
    """How many points with a quantity an array of series has (array built-ins, no lambdas but one)."""
    periods = F.flatten(F.array_compact(series["Period"]))
    points = F.flatten(F.array_compact(periods["Point"]))["quantity"]
    return F.coalesce(F.size(F.filter(points, lambda q: F.get(q, F.lit(0)).isNotNull())), F.lit(0))


def with_series(responses: DataFrame) -> DataFrame:
    """SRC7: ``responses`` with ``response_class``, the parsed array ``series`` and ``n_rows``, its points with a quantity.

    Each data document is parsed once, by direct children.  A well-formed one that holds more quantities than
    that finds is parsed again with its wrappers taken away, so that series, periods and points are found at any depth.
    A malformed document, an acknowledgement or an error page has no series.
    """
    doc = F.from_xml(F.when(F.col("response_class") == "data", F.col("body")), MARKET_DOCUMENT_SCHEMA, XML_OPTIONS)
    parsed = classify_responses(responses).withColumn("_doc", doc).withColumn("_found", _quantities(F.col("_doc")["TimeSeries"]))
    any_quantity = F.contains("body", F.lit("<quantity>")) | F.col("body").rlike(QUANTITY)  # as a rule the first is there
    more = F.when(F.col("_found") == 0, any_quantity).otherwise(F.regexp_count("body", F.lit(QUANTITY)) > F.col("_found"))
    deeper = F.col("_doc").isNotNull() & F.col("_doc")["_corrupt_record"].isNull() & more
    again = F.from_xml(F.when(deeper, unwrapped(F.col("body"))), MARKET_DOCUMENT_SCHEMA, {**XML_OPTIONS, "ignoreNamespace": "false"})  # no prefixes left
    both = parsed.withColumn("_again", again)
    nested = F.col("_again")["TimeSeries"]
    series = F.when(_quantities(nested) > F.col("_found"), nested).otherwise(F.col("_doc")["TimeSeries"])
    return (both.withColumn("series", series).withColumn("n_rows", F.greatest(F.col("_found"), _quantities(nested)).cast("long"))
            .drop("_doc", "_found", "_again"))


def _each_series(documents: DataFrame, series: Column, keys: list[str]) -> DataFrame:
    """One row ``ts`` per series of parsed documents.

    Before a plain explode Spark filters on the array's size, and pushes that filter with a copy of the whole parse for each
    mention of its result below the parse.  The outer explode has no such filter: each document is parsed where ``series`` is made.
    """
    return documents.select(*keys, F.explode_outer(series).alias("ts")).where("ts is not null")


def parse_documents(responses: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """SRC7: one row per TimeSeries x Period x Point that has a quantity.

    Missing unit fields, PSR, location or interval give NULL; a quantity that
    is not a number gives a row with NULL MW; a malformed document or an
    acknowledgement gives no row.  ``key_cols`` (default ``country_code``)
    are carried from the response to each row.
    """
    keys = key_cols or ["country_code"]
    doc = F.from_xml(F.col("body"), MARKET_DOCUMENT_SCHEMA, XML_OPTIONS)
    return series_rows(_each_series(responses, doc["TimeSeries"], keys), keys)


def parse_nested(responses: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """SRC7 with descendant search: as ``parse_documents``, for documents whose series, periods or points may be wrapped."""
    keys = key_cols or ["country_code"]
    return series_rows(_each_series(with_series(responses), F.col("series"), keys), keys)


def series_rows(series: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Rows of parsed TimeSeries structs (column ``ts``): explode Period, then Point.

    Each level keeps only scalar fields before the next explode, so a long
    series is not copied into each of its points; the last explode runs
    over the array of quantities alone.
    """
    keys = key_cols or ["country_code"]
    ts = F.col("ts")
    unit = [
        F.get(ts.getField("registeredResource.mRID"), F.lit(0)).alias("unit_id"),
        F.get(ts.getField("registeredResource.name"), F.lit(0)).alias("unit_name"),
        F.get(F.get(ts["MktPSRType"], F.lit(0))["psrType"], F.lit(0)).alias("psr_type"),
        number(F.get(F.get(ts["location"], F.lit(0))["latitude"], F.lit(0))).alias("latitude"),
        number(F.get(F.get(ts["location"], F.lit(0))["longitude"], F.lit(0))).alias("longitude"),
    ]
    unit_cols = ["unit_id", "unit_name", "psr_type", "latitude", "longitude"]
    periods = series.select(*keys, *unit, F.explode(ts["Period"]).alias("p"))
    p = F.col("p")
    points = periods.select(
        *keys, *unit_cols,
        F.get(p.getField("timeInterval.start"), F.lit(0)).alias("period_start"),
        F.get(p.getField("timeInterval.end"), F.lit(0)).alias("period_end"),
        F.explode(p["Point"]["quantity"]).alias("quantities"))
    quantity = F.get("quantities", F.lit(0))
    return points.where(quantity.isNotNull()).select(
        *keys, "unit_id", "unit_name", "psr_type", "period_start", "period_end",
        number(quantity).alias("installed_capacity_mw"), "latitude", "longitude")


def enrich(units: DataFrame, ingestion_ts=None) -> DataFrame:
    """PRJ11: energy type name, renewable flag and lineage columns.

    ``ingestion_ts`` (string or Column) replaces ``now()`` so runs repeat.
    """
    stamp = (F.current_timestamp() if ingestion_ts is None
             else F.lit(ingestion_ts).cast("timestamp") if isinstance(ingestion_ts, str) else ingestion_ts)
    return units.withColumns({
        "energy_type": X.psr_energy_type("psr_type"),
        "is_renewable": X.psr_is_renewable("psr_type"),
        "document_type": F.lit("A71"),
        "ingestion_timestamp": stamp,
    })


def ingest_responses(responses: DataFrame, ingestion_ts=None) -> DataFrame:
    """ING5: classify -> keep data documents -> parse -> enrich, ready to append."""
    data = classify_responses(responses).where(F.col("response_class") == "data")
    return enrich(parse_documents(data), ingestion_ts)


def response_outcomes(responses: DataFrame) -> DataFrame:
    """ING6/ING7 for per-unit responses: one outcome row per response.

    ``success`` when the document yields rows, ``failed`` otherwise (HTTP
    error, acknowledgement, unknown body, malformed or empty document).
    """
    classified = classify_responses(responses)
    doc = F.from_xml(F.col("body"), MARKET_DOCUMENT_SCHEMA, XML_OPTIONS)
    # Count the points with a quantity using array built-ins (no lambdas):
    # missing levels are NULL array elements, removed by array_compact.  The
    # parse appears once in the plan (inside the data-class branch only) and
    # the count is projected before ``status`` reads it, so each document is
    # parsed once.
    periods = F.flatten(F.array_compact(doc["TimeSeries"]["Period"]))
    points = F.flatten(F.array_compact(periods["Point"]))["quantity"]
    quantities = F.filter(points, lambda q: F.get(q, F.lit(0)).isNotNull())
    n_points = F.coalesce(F.size(quantities), F.lit(0))
    counted = classified.withColumn(
        "rows", F.when(F.col("response_class") == "data", n_points).otherwise(F.lit(0)))
    return counted.withColumn("status", F.when(F.col("rows") > 0, F.lit("success")).otherwise(F.lit("failed")))

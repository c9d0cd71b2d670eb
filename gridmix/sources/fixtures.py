"""Bronze-shaped stand-in inputs built from the driver's test tables.

These adapters only produce rows in the bronze schemas the models read
(FIXTURES.md, section A); they do none of the models' work.  Each is a plain
expression over a parquet scan, so its size grows with the scale factor.

Notation of FIXTURES.md: ``C9(k)`` picks a country by ``k % 9``; ``PIV`` pivots
``value`` into the i-th of n columns by ``key % n``, summed exactly
(DECIMAL(18,2)) and cast to DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.contracts import CAPACITY_RENAMES, GENERATION_RENAMES
from gridmix.session import unsorted_writes

# FIXED VALUES: country cycles of the adapters, in order.
COUNTRIES_9 = ["AT", "BE", "DE", "ES", "FR", "IT", "NL", "PT", "UK"]
COUNTRIES_10 = COUNTRIES_9 + ["CH"]
# FIXED VALUE: ingestion stamp written by the adapters (runs are repeatable).
INGESTION_TS = "2026-03-13 06:00:00"

# FIXED VALUES: plant names of the per-plant adapter, raw (unsanitised) form.
PLANT_NAMES = [f"Plant-{i:02d} (Nord)/Actual Aggregated" for i in range(12)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cycle(key: Column, codes: list[str]) -> Column:
    """``CASE key % n WHEN 0 THEN codes[0] ... END``."""
    return F.try_element_at(F.array(*[F.lit(c) for c in codes]), (key % len(codes) + 1).cast("int"))


def piv(value: str, key: str, n: int, i: int) -> Column:
    cents = F.when(F.col(key) % n == i, F.col(value).cast("decimal(18,2)"))
    return F.sum(cents).cast("double")


def _meta(document_type: str) -> dict[str, Column]:
    return {
        "document_type": F.lit(document_type),
        "ingestion_timestamp": F.lit(INGESTION_TS).cast("timestamp"),
    }


def bronze_a75(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hourly actual generation per country from ``events``."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.groupBy(cycle(F.col("user_id"), COUNTRIES_9).alias("country_code"),
                   F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("index"))
        .agg(*[piv("value", "event_id", 20, i).alias(c) for i, c in enumerate(GENERATION_RENAMES)])
        .withColumns(_meta("A75"))
    )


def bronze_a75_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1L: daily-stamped generation over several years from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    return (
        li.groupBy(cycle(F.col("l_suppkey"), COUNTRIES_9).alias("country_code"),
                   F.col("l_shipdate").cast("timestamp").alias("index"))
        .agg(*[piv("l_extendedprice", "l_partkey", 20, i).alias(c)
               for i, c in enumerate(GENERATION_RENAMES)])
        .withColumns(_meta("A75"))
    )


def bronze_a68(spark: SparkSession, sf_dir: str) -> DataFrame:
    """installed-capacity snapshots per country from ``orders``."""
    o = table(spark, sf_dir, "orders")
    return (
        o.groupBy(cycle(F.col("o_custkey"), COUNTRIES_10).alias("country_code"),
                  F.col("o_orderdate").cast("timestamp").alias("index"))
        .agg(*[piv("o_totalprice", "o_orderkey", 22, i).alias(c) for i, c in enumerate(CAPACITY_RENAMES)])
        .withColumns(_meta("A68"))
    )


def a71_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 before enrichment: one per-unit capacity point per ``lineitem`` row.

    Spread over the cores like ``a71_responses``: the per-unit rows feed a hash
    aggregate keyed by strings, which would otherwise run in the single task
    reading the one-row-group test table.
    """
    from gridmix.operators.joins import spread

    li = spread(table(spark, sf_dir, "lineitem"))
    s = F.col("l_suppkey")
    psr_n = F.col("l_partkey") % 26
    located = s % 3 == 0
    return li.select(
        cycle(s, COUNTRIES_9).alias("country_code"),
        F.concat(F.lit("U"), s.cast("string")).alias("unit_id"),
        F.concat(F.lit("Unit "), s.cast("string")).alias("unit_name"),
        F.when(psr_n < 25, F.concat(F.lit("B"), F.lpad((psr_n + 1).cast("string"), 2, "0"))).alias("psr_type"),
        F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00Z")).alias("period_start"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-12-31T23:00Z")).alias("period_end"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("double").alias("installed_capacity_mw"),
        F.when(located, (F.lit(45) + s % 10).cast("double")).alias("latitude"),
        F.when(located, (F.lit(5) + s % 10).cast("double")).alias("longitude"),
    )


def bronze_a71(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per-unit capacity as appended to bronze (enriched by PRJ11)."""
    from gridmix.operators.per_unit import enrich

    return enrich(a71_units(spark, sf_dir), ingestion_ts=INGESTION_TS)


def landed_a73(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 as landed: per-plant output with raw plant names, not yet sanitised."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.groupBy(cycle(F.col("user_id"), COUNTRIES_9).alias("country_code"),
                   F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("index"))
        .agg(*[piv("value", "user_id", 12, i).alias(name) for i, name in enumerate(PLANT_NAMES)])
        .withColumns(_meta("A73"))
    )


def bronze_a73(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per-plant output in bronze (column names sanitised on load)."""
    from gridmix.operators.ingest import sanitize_columns

    return sanitize_columns(landed_a73(spark, sf_dir))


# ---------------------------------------------------------------------------
# landed per-unit capacity responses (one XML document per response)
# ---------------------------------------------------------------------------

def _xml_text(tag: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))


def _optional(value: Column, text: Column) -> Column:
    return F.when(value.isNotNull(), text).otherwise(F.lit(""))


def a71_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one landed response per ``lineitem`` row, with its country.

    ``l_linenumber`` picks the response kind so that every class occurs:
    7 -> acknowledgement, 6 -> an HTML error page, 5 with return flag ``R`` ->
    HTTP 503, 4 -> a truncated (malformed) document, 3 -> a point whose
    quantity is not a number, 2 -> an extra point without a quantity; all
    others are plain market documents with one unit, period and point.
    """
    from gridmix.functions.taxonomy import A71_NAMESPACE
    from gridmix.operators.joins import spread

    # Each test table is one Parquet row group, read by one task; landed
    # responses are many files read by many.  Spreading the rows first lets
    # the documents be built, and then parsed, on every core.
    li = spread(table(spark, sf_dir, "lineitem"))
    s = F.col("l_suppkey")
    n = F.col("l_linenumber")
    psr_n = F.col("l_partkey") % 26
    psr = F.when(psr_n < 25, F.concat(F.lit("B"), F.lpad((psr_n + 1).cast("string"), 2, "0")))
    lat = F.when(s % 3 == 0, (F.lit(45) + s % 10).cast("string"))
    lon = F.when(s % 3 == 0, (F.lit(5) + s % 10).cast("string"))
    qty = F.when(n == 3, F.lit("n/a")).otherwise(
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    point = F.concat(F.lit("<Point><position>1</position>"), _xml_text("quantity", qty), F.lit("</Point>"))
    extra_point = F.when(n == 2, F.lit("<Point><position>2</position></Point>")).otherwise(F.lit(""))
    series = F.concat(
        F.lit("<TimeSeries><mRID>1</mRID><businessType>B11</businessType>"),
        _xml_text("registeredResource.mRID", F.concat(F.lit("U"), s.cast("string"))),
        _xml_text("registeredResource.name", F.concat(F.lit("Unit "), s.cast("string"))),
        _optional(psr, _xml_text("MktPSRType", _xml_text("psrType", psr))),
        _optional(lat, _xml_text("location", F.concat(_xml_text("latitude", lat), _xml_text("longitude", lon)))),
        F.lit("<Period>"),
        _xml_text("timeInterval.start", F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00Z"))),
        _xml_text("timeInterval.end", F.concat(F.year("l_shipdate").cast("string"), F.lit("-12-31T23:00Z"))),
        F.lit("<resolution>P1Y</resolution>"),
        point, extra_point,
        F.lit("</Period></TimeSeries>"),
    )
    doc_id = F.concat_ws("-", F.col("l_orderkey").cast("string"), n.cast("string"))
    document = F.concat(
        F.lit(f'<?xml version="1.0" encoding="UTF-8"?><GL_MarketDocument xmlns="{A71_NAMESPACE}">'),
        _xml_text("mRID", doc_id),
        F.lit("<type>A71</type>"),
        series,
        F.lit("</GL_MarketDocument>"),
    )
    ack = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><Acknowledgement_MarketDocument>'),
        _xml_text("mRID", doc_id),
        F.lit("<Reason><code>999</code><text>No matching data found</text></Reason>"
              "</Acknowledgement_MarketDocument>"),
    )
    body = (
        F.when(n == 7, ack)
        .when(n == 6, F.lit("<html><body>Service temporarily unavailable</body></html>"))
        .when(n == 4, F.substring(document, 1, 200))
        .otherwise(document)
    )
    status = F.when((n == 5) & (F.col("l_returnflag") == "R"), F.lit(503)).otherwise(F.lit(200))
    return li.select(
        cycle(s, COUNTRIES_9).alias("country_code"),
        doc_id.alias("response_id"),
        status.alias("http_status"),
        body.alias("body"),
    )


def _unit_xml(periods: Column, of=F.col) -> Column:
    """One ``TimeSeries`` per ``lineitem`` row, around the given periods; ``of`` gives the row's column of a name."""
    s, psr_n = of("l_suppkey"), of("l_partkey") % 26
    psr = F.when(psr_n < 25, F.concat(F.lit("B"), F.lpad((psr_n + 1).cast("string"), 2, "0")))
    lat = F.when(s % 3 == 0, (F.lit(45) + s % 10).cast("string"))
    lon = F.when(s % 3 == 0, (F.lit(5) + s % 10).cast("string"))
    return F.concat(
        F.lit("<TimeSeries><businessType>B11</businessType>"),
        _xml_text("registeredResource.mRID", F.concat(F.lit("U"), s.cast("string"))),
        _xml_text("registeredResource.name", F.concat(F.lit("Unit "), s.cast("string"))),
        _optional(psr, _xml_text("MktPSRType", _xml_text("psrType", psr))),
        _optional(lat, _xml_text("location", F.concat(_xml_text("latitude", lat), _xml_text("longitude", lon)))),
        periods, F.lit("</TimeSeries>"))


def _period_xml(wrapper: str, *points: Column, of=F.col) -> Column:
    start = F.concat(of("l_shipdate").cast("date").cast("string"), F.lit("T00:00Z"))
    end = F.concat(F.year(of("l_shipdate")).cast("string"), F.lit("-12-31T23:00Z"))
    inner = [F.concat(F.lit(f"<{wrapper}><Point><position>{k + 1}</position>"), _xml_text("quantity", p), F.lit(f"</Point></{wrapper}>"))
             for k, p in enumerate(points)]
    return F.concat(F.lit("<Period>"), _xml_text("timeInterval.start", start), _xml_text("timeInterval.end", end), *inner, F.lit("</Period>"))


def _number(column: str, of=F.col) -> Column:
    return of(column).cast("decimal(18,2)").cast("string")


def a71_nested_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one response per order and country; a series per ``lineitem`` row, each with two periods, all below wrapper elements.

    The first period has a point with the price and one with the quantity, the second
    one with the discount.  Orders whose key 7 divides are cut off.
    """
    from gridmix.functions.taxonomy import A71_NAMESPACE

    def unit(line: Column) -> Column:
        of = line.getField
        periods = F.concat(F.lit("<Details><!-- <quantity>0</quantity> -->"),
                           _period_xml("Step", _number("l_extendedprice", of), _number("l_quantity", of), of=of),
                           F.lit("</Details><Details>"), _period_xml("Step", _number("l_discount", of), of=of), F.lit("</Details>"))
        return F.concat(F.lit("<Unit>"), _unit_xml(periods, of), F.lit("</Unit>"))

    # Dealt out and gathered by order as table rows, the texts are built from an order's rows: a test table is read by one task.
    lines = (table(spark, sf_dir, "lineitem").withColumn("country_code", cycle(F.col("l_suppkey"), COUNTRIES_9))
             .repartition("country_code", "l_orderkey"))
    line = F.struct("l_suppkey", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_shipdate")
    order = (lines.groupBy("country_code", "l_orderkey").agg(F.collect_list(line).alias("lines"))  # an order has 7 lines at most
             .select("country_code", "l_orderkey", F.array_join(F.transform("lines", unit), "").alias("series")))
    document = F.concat(F.lit(f'<?xml version="1.0"?><GL_MarketDocument xmlns="{A71_NAMESPACE}"><mRID>x</mRID><Units note="a>b">'), F.col("series"),
                        F.lit("</Units></GL_MarketDocument>"))
    cut = F.when(F.col("l_orderkey") % 7 == 0, F.substring(document, 1, 400)).otherwise(document)
    return order.select("country_code", F.lit(200).alias("http_status"), cut.alias("body"))


def land_a71_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """four large files per country, a series per line; the file of ``FR`` with number 3 is cut off before its end tag."""
    from gridmix.functions.taxonomy import A71_NAMESPACE

    # Shuffled and sorted as table rows; the text of a line is built when it is written, compressed (a file is read by one task either way).
    lines = table(spark, sf_dir, "lineitem").select(
        cycle(F.col("l_suppkey"), COUNTRIES_9).alias("country_code"), (F.col("l_orderkey") % 4).cast("int").alias("part"),
        F.lit(1).alias("ord"), "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate")
    files = lines.select("country_code", "part").distinct()
    first = files.withColumn("ord", F.lit(0))
    last = files.where("not (country_code = 'FR' and part = 3)").withColumn("ord", F.lit(2))
    value = (F.when(F.col("ord") == 0, f'<?xml version="1.0"?><GL_MarketDocument xmlns="{A71_NAMESPACE}">').when(F.col("ord") == 2, "</GL_MarketDocument>")
             .otherwise(_unit_xml(F.regexp_replace(_period_xml("Step", _number("l_extendedprice")), "</?Step>", ""))))
    rows = (lines.unionByName(first, allowMissingColumns=True).unionByName(last, allowMissingColumns=True)
            .repartition("country_code", "part").sortWithinPartitions("country_code", "part", "ord"))
    with unsorted_writes(spark):
        rows.select("country_code", "part", value.alias("value")).write.partitionBy("country_code", "part").option("compression", "gzip").text(root)


# ---------------------------------------------------------------------------
# Landed extracts with raw names, as an API client returns them
# ---------------------------------------------------------------------------

def _raw_labels() -> dict[str, str]:
    """Sanitised fuel stem -> raw label (the production-type names, plus storage)."""
    from gridmix.functions.taxonomy import PSR_TYPES
    from gridmix.operators.ingest import sanitize

    labels = {sanitize(name): name for name in PSR_TYPES.values()}
    labels["energy_storage"] = "Energy Storage"
    return labels


def _split_generation_column(name: str) -> tuple[str, str]:
    for suffix, measure in (("_actual_aggregated", "Actual Aggregated"),
                            ("_actual_consumption", "Actual Consumption")):
        if name.endswith(suffix):
            return _raw_labels()[name[: -len(suffix)]], measure
    raise ValueError(name)


def landed_a75(bronze: DataFrame) -> DataFrame:
    """Generation extract with two-level raw names (fuel, measure) as struct columns."""
    fuels: dict[str, list[tuple[str, str]]] = {}
    for c in GENERATION_RENAMES:
        if c in bronze.columns:
            fuel, measure = _split_generation_column(c)
            fuels.setdefault(fuel, []).append((measure, c))
    return bronze.select(
        "country_code", "document_type", "index",
        *[F.struct(*[F.col(c).alias(m) for m, c in parts]).alias(fuel) for fuel, parts in fuels.items()])


def land_csv_a75(bronze: DataFrame, root: str) -> None:
    """F8: generation extracts as CSV with two header rows, three files per country.

    Countries before ``DE`` land no consumption columns.  ``BE`` has ``n/e`` as first value on the 13th of a month, ``FR`` a
    cell too many on the 14th.
    """
    keep = {c: _split_generation_column(c) for c in GENERATION_RENAMES}
    few = [c for c in keep if c.endswith("_actual_aggregated")]

    def lines(rows: DataFrame, names: list[str]) -> DataFrame:
        head = [",".join(["", *(f'"{keep[c][k]}"' for c in names)]) for k in (0, 1)]
        cell = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
        on = F.dayofmonth("index")
        cell[0] = F.when((F.col("country_code") == "BE") & (on == 13), "n/e").otherwise(cell[0])
        extra = F.when((F.col("country_code") == "FR") & (on == 14), ",").otherwise("")
        body = rows.select("document_type", "country_code", (on % 3).alias("part"), F.lit(2).alias("ord"),
                           F.concat(F.concat_ws(",", F.col("index").cast("string"), *cell), extra).alias("value"))
        files = body.select("document_type", "country_code", "part").distinct()
        tops = files.select("*", F.posexplode(F.array(*map(F.lit, head))).alias("ord", "value"))
        return tops.unionByName(body)

    early = F.col("country_code") < "DE"
    both = lines(bronze.where(early), few).unionByName(lines(bronze.where(~early), list(keep)))
    (both.repartition("country_code", "part").sortWithinPartitions("document_type", "country_code", "part", "ord")
     .select("document_type", "country_code", "part", "value").write.partitionBy("document_type", "country_code", "part").option("compression", "none").text(root))


def landed_a68(bronze: DataFrame) -> DataFrame:
    """Capacity extract with flat raw names (production-type labels)."""
    labels = _raw_labels()
    return bronze.select("country_code", "document_type", "index",
                         *[F.col(c).alias(labels[c]) for c in CAPACITY_RENAMES])


def bronze_a75_before_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as bronze looked before consumption columns were first loaded."""
    b = bronze_a75(spark, sf_dir)
    keep = [c for c in GENERATION_RENAMES if c.endswith("_actual_aggregated")]
    return b.select("country_code", "document_type", "ingestion_timestamp", "index", *keep)

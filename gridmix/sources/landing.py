"""Landed inputs (SRC3, SRC4): files an extractor dropped in a landing folder.

Layout (Hive-style partitions, discovered by Spark):

* extracts: ``<root>/document_type=A75/country_code=FR/<file>.parquet`` with an
  ``index`` timestamp and raw value columns (raw names; schemas differ
  between countries, so they are merged on read);
* CSV extracts: ``<root>/document_type=A75/country_code=FR/**/<file>`` under a root of their own, with the index in
  the first column and two header rows (fuel, measure), or one (``read_csv_extracts``);
* per-unit responses: ``<root>/country_code=FR[/http_status=503]/<file>.xml``, one response
  document per file, or one per line (``land_responses``); the status is read from the folder, or from an optional
  manifest ``(file_name, http_status)``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions import exprs as X
from gridmix.operators.joins import anti_join, freeze, lookup_join, semi_join
from gridmix.session import unsorted_writes

LANDED_DOCUMENTS = 200_000  # of a file that ``land_responses`` writes, at most


def read_extracts(spark: SparkSession, root: str, document_type: str) -> DataFrame | None:
    """SRC3: landed extracts of one document type, schemas merged across countries.

    Only that type's folder is listed and read (``basePath`` keeps
    ``document_type`` and ``country_code`` as columns): raw names of
    different document types may clash, so their schemas are never merged
    together.  Returns ``None`` when nothing of that type has landed.
    """
    from pyspark.errors import AnalysisException

    folder = f"{root.rstrip('/')}/document_type={document_type}"
    try:
        return (spark.read.option("mergeSchema", "true").option("basePath", root)
                .parquet(folder))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def broken_files(spark: SparkSession, root: str, document_type: str) -> dict[str, str]:
    """ING6: landed files of one type that cannot be read to their end, with the reason.

    The footers say how many rows each file has (a count that reads no data page); a second scan decodes every column with
    unreadable pages left out and counts what came.  Countries whose footers cannot be read are not looked
    at here: ``read_extracts_by_country`` leaves them out.  Only the broken files' paths come to the driver.
    """
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    out: dict[str, str] = {}
    for name in _country_folders(spark, root, document_type):
        folder = f"{root.rstrip('/')}/document_type={document_type}/{name}"
        path = F.col("_metadata.file_path").alias("file_path")
        try:
            listed = spark.read.option("mergeSchema", "true").parquet(folder).select(path).groupBy("file_path").agg(F.count(F.lit(1)).alias("listed"))
            rows = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "true").parquet(folder)
            read = rows.select(path, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("all")).groupBy("file_path").agg(
                F.count("all").alias("read"), F.bit_xor("all").alias("_all"))
            short = listed.join(read, "file_path", "left").where(F.coalesce("read", F.lit(0)) < F.col("listed")).collect()
        except (PySparkException, Py4JJavaError):
            continue
        out.update({r.file_path: f"{r.read or 0} of {r.listed} rows can be read" for r in short})
    return out


def _country_folders(spark: SparkSession, root: str, document_type: str) -> list[str]:
    sc = spark.sparkContext
    top = sc._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/document_type={document_type}")
    fs = top.getFileSystem(sc._jsc.hadoopConfiguration())
    names = sorted(x.getPath().getName() for x in fs.listStatus(top)) if fs.exists(top) else []
    return [n for n in names if n.startswith("country_code=")]


def read_extracts_by_country(spark: SparkSession, root: str, document_type: str, leave_out: set[str] | None = None) -> tuple[DataFrame | None, dict[str, str]]:
    """SRC3 + PRJ6 + PRJ7: the extracts of one type, each country read and shaped by itself.

    Countries may land two-level or flat names and other number types: every
    country's columns are flattened and sanitised, its value columns cast
    to DOUBLE, and the countries united by name.  A country whose
    files cannot be read (a corrupt footer, columns that collide, types that
    do not merge) is left out and returned with its reason; the others load.
    Rows of the files in ``leave_out`` (paths) are left out too.  Returns ``None`` for the rows when no country can be read.
    """
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    from gridmix.operators.ingest import KEYS, flatten_columns, sanitize_columns

    folder = f"{root.rstrip('/')}/document_type={document_type}"
    parts: list[DataFrame] = []
    unreadable: dict[str, str] = {}
    for name in _country_folders(spark, root, document_type):
        country = name.removeprefix("country_code=")
        try:
            raw = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", str(bool(leave_out)).lower()).parquet(f"{folder}/{name}")
            if leave_out:  # the filter on the path also keeps these files from being opened
                raw = raw.where(~F.col("_metadata.file_path").isin(*leave_out))
            clean = sanitize_columns(flatten_columns(raw))
            values = {f.name for f in clean.schema.fields if isinstance(f.dataType, T.NumericType)}
            parts.append(clean.select(
                F.lit(document_type).alias(KEYS[0]) if KEYS[0] == "document_type" else F.lit(country).alias(KEYS[0]),
                F.lit(document_type).alias(KEYS[1]) if KEYS[1] == "document_type" else F.lit(country).alias(KEYS[1]),
                *[F.col(c).cast("double").alias(c) if c in values else F.col(c) for c in clean.columns if c not in KEYS]))
        except (PySparkException, Py4JJavaError, ValueError) as e:
            unreadable[country] = str(e).strip().splitlines()[0][:300]
    united = None
    for part in parts:
        united = part if united is None else united.unionByName(part, allowMissingColumns=True)
    return united, unreadable


#: One cell of a CSV line that a comma was put before: quoted, or up to the next comma.
CSV_CELL = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*)'


def _csv_cells(line: str) -> Column:
    """The cells of a CSV line without quotes and outer blanks."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), F.col(line)), F.lit(CSV_CELL), F.lit(1))
    return F.transform(raw, lambda c: F.trim(F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)))


def _csv_headers(lines: DataFrame, header_rows: int) -> DataFrame:
    """``file_path, header, names`` per file: its header lines, and the clean column names behind the index (PRJ6, PRJ7).

    A header line is one of the file's first lines whose index cell holds no digit.  The row number is cut
    to ``header_rows`` in each task before the shuffle, so a file of bad lines costs no more.
    """
    first = (lines.where((F.col("block") == 0) & ~F.element_at("cells", 1).rlike(r"\d"))
             .withColumn("no", F.row_number().over(Window.partitionBy("file_path").orderBy("id")))
             .where(F.col("no") <= header_rows))
    rows = first.groupBy("file_path").agg(F.array_sort(F.collect_list(F.struct("no", "line", "cells"))).alias("rows")).where(F.size("rows") == header_rows)
    levels = [F.col("rows")[i]["cells"] for i in range(header_rows)]
    name = levels[0] if header_rows == 1 else F.transform(F.arrays_zip(*[x.alias(f"l{i}") for i, x in enumerate(levels)]),
                                                          lambda z: X.flatten_name(*[F.coalesce(z[f"l{i}"], F.lit("")) for i in range(header_rows)]))
    clean = F.transform(name, X.sanitize_name)
    return rows.select("file_path", F.col("rows.line").alias("header"), F.slice(clean, F.lit(2), F.greatest(F.size(clean) - 1, F.lit(0))).alias("names"))


def read_csv_extracts(spark: SparkSession, root: str, document_type: str, header_rows: int = 2) -> tuple[DataFrame | None, DataFrame | None]:
    """SRC3 for CSV: ``(rows, rejected)`` of one document type, every file by its own header rows.

    All files are one scan, however many there are and whatever columns each has: the header rows of every file give its
    column positions, which are joined to its lines by path (one row per file, broadcast behind a size
    check), so large files may be split between tasks.  Only the distinct column names come to the driver, as a schema does.
    Value columns are DOUBLE; an empty cell, or a column that the file lacks, is NULL.

    A line is kept apart in ``rejected`` (``country_code, document_type, file_path, line, reason``) when its file has no
    header rows or names that collide once sanitised, when it has more or fewer cells than the header, an index that is no
    timestamp, or a value that is no number.  Blank lines are skipped.  A quoted cell may hold commas and quotes, not line
    breaks.  ``(None, None)`` when nothing of that type has landed.
    """
    folder = f"{root.rstrip('/')}/document_type={document_type}"
    if not _country_folders(spark, root, document_type):
        return None, None
    text = spark.read.option("basePath", root).text(folder)
    lines = text.where(F.trim("value") != "").select(
        F.col("country_code").cast("string").alias("country_code"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"),
        F.regexp_replace("value", "^\\x{FEFF}", "").alias("line")).withColumn("cells", _csv_cells("line"))
    headers = freeze(_csv_headers(lines, header_rows))
    names = sorted(r.name for r in headers.select(F.explode("names").alias("name")).distinct().collect())
    known = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    places = headers.select(
        "file_path", "header", (F.size("names") + 1).alias("width"), (F.size(F.array_distinct("names")) < F.size("names")).alias("collide"),
        F.transform(known, lambda n: F.array_position("names", n).cast("int")).alias("places"))
    body = lookup_join(lines.drop("block", "id"), places, "file_path", "left").where(~F.coalesce(F.array_contains("header", F.col("line")), F.lit(False)))
    index = F.element_at("cells", 1).try_cast("timestamp")
    no_number = F.exists(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))), lambda c: (c != "") & c.try_cast("double").isNull())
    reason = (F.when(F.col("width").isNull(), "no header").when(F.col("collide"), "columns collide")
              .when(F.size("cells") != F.col("width"), "wrong number of cells").when(index.isNull(), "no timestamp").when(no_number, "not a number"))
    judged = body.withColumn("reason", reason)
    values = [F.when(F.col("places")[i] > 0, F.get("cells", F.col("places")[i])).try_cast("double").alias(n) for i, n in enumerate(names)]
    rows = judged.where("reason is null").select("country_code", F.lit(document_type).alias("document_type"), index.alias("index"), *values)
    rejected = judged.where("reason is not null").select("country_code", F.lit(document_type).alias("document_type"), "file_path", "line", "reason")
    return rows, rejected


def read_responses(spark: SparkSession, root: str, manifest: DataFrame | None = None, one_per_line: bool = False) -> DataFrame:
    """SRC4: one row per landed response: ``country_code, file_name, http_status, body``.

    ``wholetext`` keeps a file's document in one row; with ``one_per_line`` each line is a document.  Country and
    status come from the partition folders, so no join carries the bodies; only where the
    statuses lie in a manifest are they joined by file name.  Without either every response counts as HTTP 200.
    """
    raw = spark.read.option("wholetext", str(not one_per_line).lower()).text(root)
    status = F.col("http_status").cast("int") if "http_status" in raw.columns else F.lit(200)
    docs = raw.select(F.col("country_code").cast("string").alias("country_code"), F.col("_metadata.file_name").alias("file_name"),
                      status.alias("_status"), F.col("value").alias("body"))
    if manifest is None:
        return docs.select("country_code", "file_name", F.coalesce("_status", F.lit(200)).alias("http_status"), "body")
    joined = lookup_join(docs, manifest.select("file_name", "http_status"), "file_name", "left")
    return joined.select("country_code", "file_name",
                         F.coalesce(F.col("http_status").cast("int"), F.col("_status"), F.lit(200)).alias("http_status"), "body")


def land_responses(responses: DataFrame, root: str) -> None:
    """Write ``country_code, http_status, body`` rows into the landing layout, one document per line.

    XML repeats its tags in every document, so the files are compressed.  One such file is read by one task; a file
    ends at ``LANDED_DOCUMENTS`` documents, so that a large country is still read by many.
    """
    one_line = F.regexp_replace("body", r"[\r\n]+", " ")
    rows = responses.select("country_code", "http_status", one_line.alias("value"))
    with unsorted_writes(responses.sparkSession):
        (rows.write.mode("append").partitionBy("country_code", "http_status")
         .option("compression", "gzip").option("maxRecordsPerFile", LANDED_DOCUMENTS).text(root))


def land_extract(df: DataFrame, root: str) -> None:
    """Write extract rows into the landing layout (used by tests and the stream demo)."""
    df.write.mode("append").partitionBy("document_type", "country_code").parquet(root)



def complete_files(spark: SparkSession, root: str, root_tag: str = "GL_MarketDocument") -> DataFrame:
    """``file_path`` of the files in which the root element's end tag stands: those not cut off."""
    lines = spark.read.text(root).where(F.col("value").rlike(rf"</(?:[\w.-]+:)?{re.escape(root_tag)}\s*>"))
    return lines.select(F.col("_metadata.file_path").alias("file_path")).distinct()


def read_series(spark: SparkSession, root: str, manifest: DataFrame | None = None, complete_only: bool = False) -> DataFrame:
    """SRC4 for large responses: one row per ``TimeSeries`` element, as column ``ts``.

    The XML data source reads a file as a stream and finds its ``<TimeSeries>`` elements, so a response of any size
    is never one row.  A file is read by one task, whether compressed or not; files are dealt out over tasks.  Files the manifest marks as failed
    (status other than 200) are dropped.  Acknowledgements have no series and
    give no rows.  Of a truncated file the series before the cut are kept; with ``complete_only`` none are, as the
    per-document path has it: files without the root's end tag, found by a scan of
    the lines that keeps file paths alone, are left out.
    """
    from gridmix.operators.per_unit import SERIES_SCHEMA

    raw = (spark.read.format("xml").option("rowTag", "TimeSeries").option("mode", "PERMISSIVE")
           .option("excludeAttribute", "true").option("ignoreNamespace", "true")
           .schema(SERIES_SCHEMA).load(root))
    series = raw.select(F.col("country_code").cast("string").alias("country_code"),
                        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
                        F.struct(*[F.col(f"`{f.name}`") for f in SERIES_SCHEMA.fields]).alias("ts"))
    if manifest is not None:
        failed = manifest.where(F.coalesce(F.col("http_status") != 200, F.lit(True))).select("file_name")
        series = anti_join(series, failed, "file_name")
    if complete_only:
        series = semi_join(series, freeze(complete_files(spark, root)), "file_path")  # one scan: counted, then joined
    return series.drop("file_path")

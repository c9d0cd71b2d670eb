"""STR1: incremental bronze append from a landing folder, exactly once per file.

A Structured Streaming file source over the landing folder replaces the
batch high-water mark: the checkpoint records which files were processed, so
a rerun picks up only new files and never refetches or drops the tail of a
partly loaded day.  ``trigger(availableNow=True)`` drains what is there in
bounded micro-batches and stops, so the same code runs as a scheduled batch
job or continuously (drop the trigger).

``stream_to_warehouse`` appends each micro-batch to the same bronze table as
the batch loads, under a load id of its own (the stream's id and the batch's
number): a batch that is repeated after a failure replaces its own rows.
``stream_to_bronze`` writes a folder that only the stream owns, through
the file sink and its log; readers of such a folder see nothing but the log's files, so it refuses a folder that holds others.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.operators.ingest import add_lineage, flatten_columns, sanitize_columns

if TYPE_CHECKING:
    from gridmix.sources.warehouse import Warehouse


def bronze_rows(raw: DataFrame, ingestion_ts: str | None = None) -> DataFrame:
    """PRJ7 + PRJ6 + PRJ10 on a (streaming or batch) frame of landed rows."""
    return add_lineage(sanitize_columns(flatten_columns(raw)), ingestion_ts)


def landed_schema(spark: SparkSession, landing_root: str) -> T.StructType:
    """The columns of all landed files together (countries land different plants and fuels)."""
    return spark.read.option("mergeSchema", "true").parquet(landing_root).schema


def _unknown(landed: T.StructType, known: T.StructType, prefix: str = "") -> list[str]:
    """Columns, nested ones too, that ``known`` lacks: the stream would drop them."""
    out = []
    for field in landed.fields:
        if field.name not in known.names:
            out.append(prefix + field.name)
        elif isinstance(field.dataType, T.StructType) and isinstance(known[field.name].dataType, T.StructType):
            out += _unknown(field.dataType, known[field.name].dataType, f"{prefix}{field.name}.")
    return out


def _refuse_unknown(spark: SparkSession, landing_root: str, schema: T.StructType) -> None:
    missing = _unknown(landed_schema(spark, landing_root), schema)
    if missing:
        raise ValueError(f"landed files have columns that the stream's schema lacks: {', '.join(missing)}")


def stream_to_warehouse(wh: "Warehouse", landing_root: str, document_type: str, checkpoint: str, *,
                        schema: T.StructType | None = None, ingestion_ts: str | None = None,
                        max_files_per_trigger: int = 1000, available_now: bool = True):
    """Stream the landed extracts of one type into the warehouse's bronze table of that type.

    Each micro-batch first records the (country, month) pairs it holds as
    pending (time-series types), then appends its rows under the load id
    ``stream-<query id>-<batch>``; the query's id lives in the checkpoint, so a
    restarted stream that repeats a batch overwrites what the first attempt
    left, and an incremental build picks up the months of both.  ``schema`` (default:
    the columns of all files landed so far) must list the landed columns; a landed file with
    a column that it lacks is an error at the start.
    """
    from gridmix.functions import taxonomy as tx
    from gridmix.plans.layers import CONTRACTS, TIME_SERIES
    from gridmix.sources.warehouse import MONTH_COL, month_key

    spark = wh.spark
    folder = f"{landing_root.rstrip('/')}/document_type={document_type}"
    table = tx.BRONZE_TABLES.get(document_type, f"{tx.BRONZE_TABLE_PREFIX}{document_type.lower()}")
    month_of = TIME_SERIES.get(document_type)
    if schema is None:
        schema = landed_schema(spark, folder)
    else:
        _refuse_unknown(spark, folder, schema)

    def write(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = f"stream-{query}-{number}"
        rows = bronze_rows(batch, ingestion_ts).withColumns(
            {"document_type": F.lit(document_type), "country_code": F.col("country_code").cast("string")})
        if month_of is not None:
            pairs = rows.select("country_code", month_key(F.col(month_of)).alias(MONTH_COL)).distinct()
            wh.mark_pending(pairs, table, load)
        wh.append_bronze(rows, table, CONTRACTS.get(document_type), month_of=month_of, load_id=load)

    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)
    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def stream_to_bronze(spark: SparkSession, landing_root: str, schema: T.StructType, bronze_path: str,
                     checkpoint: str, ingestion_ts: str | None = None, max_files_per_trigger: int = 1000,
                     partition_by: tuple[str, ...] = ("country_code",), available_now: bool = True,
                     month_of: str | None = None, files_per_value: int = 4):
    """Start the stream; returns the ``StreamingQuery`` (already finished when ``available_now``).

    ``schema`` must list the landed columns including the partition columns
    (``document_type``, ``country_code``), which Spark fills from the paths
    (``landed_schema`` gives it); a landed file with a column that it lacks
    is an error at the start, before any file counts as processed.
    The file sink's commit log makes the append exactly once: a batch that
    failed half-way is redone from the checkpoint and readers of
    ``bronze_path`` only see committed files.  ``month_of`` adds the
    ``index_month`` partition of time-series bronze, as the batch append does.
    """
    from gridmix.sources.warehouse import MONTH_COL, month_key

    _refuse_unknown(spark, landing_root, schema)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(bronze_path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    if held and "_spark_metadata" not in held:
        raise ValueError(f"{bronze_path} holds rows of batch loads, which the file sink would hide: use stream_to_warehouse")
    raw = (spark.readStream.schema(schema)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(landing_root))
    rows = bronze_rows(raw, ingestion_ts)
    if month_of is not None:
        rows = rows.withColumn(MONTH_COL, month_key(F.col(month_of)))
        partition_by = (*partition_by, MONTH_COL)
    # A few tasks per output partition value and micro-batch, so each batch
    # writes a few files per (country[, month]), and a hot country is spread.
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_value))
    rows = rows.repartition(*[F.col(c) for c in partition_by], salt)
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("path", bronze_path).option("checkpointLocation", checkpoint)
              .partitionBy(*partition_by))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Take back the last micro-batch's commit, so that the next start runs it again (repairs, and tests of a failure)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    numbers = [x.getPath().getName() for x in fs.listStatus(folder)]
    last = max((n for n in numbers if n.isdigit()), key=int)
    fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, last), False)


def read_stream_output(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Batch read of the stream's output (only committed files, the schemas of all batches merged)."""
    return spark.read.option("mergeSchema", "true").parquet(bronze_path).withColumn("country_code", F.col("country_code").cast("string"))

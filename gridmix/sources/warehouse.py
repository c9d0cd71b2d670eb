"""Layered storage: bronze / silver / gold databases over one shared root.

SRC1 (bronze scan), SNK1-SNK3 (additive append), SNK4 (view), SNK5 (table,
full rebuild), SNK6 (layer placement), SNK7 (layer databases).

Tables are Parquet folders under the root, which on a cluster must be a
shared file system or object store (by default a folder below
``spark.checkpoint.dir``).  Writes go through Spark's commit protocol: a lost
executor only reruns its tasks.  Each append writes partitions of its own (``load_id``), so batch
loads and streams share a table, and an append that is repeated under the same id, after dying at any point of its
commit, replaces its own rows and no others.  A table rebuild writes a new version folder and then
points the table to it; a run that dies leaves the last complete version.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions import taxonomy as tx
from gridmix.session import shared_dir


MONTH_COL, LOAD_COL = "index_month", "load_id"
VERSION, PENDING = "version-", "_pending"


def month_key(ts) -> "F.Column":
    """UTC month of a timestamp as ``yyyy-MM`` (the bronze month partition)."""
    return F.date_format(ts, "yyyy-MM")


def qualified_name(custom_schema: str | None, table: str, target_schema: str = "analytics") -> str:
    """SNK6: a model's custom schema is used as is, otherwise the target's."""
    return f"{custom_schema or target_schema}.{table}"


def cast_known(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Cast the contract's columns to their types; keep every other column as is.

    New columns (a fuel a country starts reporting) pass through, so the
    stored schema only grows.
    """
    types = {f.name: f.dataType for f in contract.fields}
    return df.select(*[df[f"`{c}`"].cast(types[c]).alias(c) if c in types else df[f"`{c}`"]
                       for c in df.columns])


class Warehouse:
    """The three layers of the project as databases whose tables live under ``root``."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 layers: dict[str, str] | None = None) -> None:
        self.spark = spark
        self.root = (root or shared_dir(spark, "warehouse")).rstrip("/")
        self.layers = dict(layers or tx.LAYERS)

    # -- SNK7 / SNK6 ------------------------------------------------------
    def create_layers(self) -> None:
        """SNK7: ``CREATE DATABASE IF NOT EXISTS`` for each layer."""
        for db in self.layers.values():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{self.root}/{db}'")

    def name(self, layer: str, table: str) -> str:
        return qualified_name(self.layers.get(layer), table)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.layers[layer]}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        fs, hpath = self._fs(self.path(layer, table))
        return fs.exists(hpath)

    # -- SRC1 / SNK1-SNK3 -------------------------------------------------
    def read_bronze(self, table: str, contract: T.StructType | None = None, load_id: str | None = None) -> DataFrame:
        """SRC1: scan a bronze table, or the rows of one load.

        With a contract the table is read with that schema: no file footer is
        read to merge schemas (a full listing pass over a large table), and
        contract columns that older files lack read as NULL.  Without one
        (tables whose columns are open-ended, such as per-plant output) the
        schemas of all files are merged.  Partition columns are always
        present, but for ``load_id``.  A table not created yet (or holding no data file) reads as
        empty.
        """
        from pyspark.errors import AnalysisException

        empty_schema = contract or T.StructType([T.StructField("country_code", T.StringType())])
        if not self.exists("bronze", table):
            return self.spark.createDataFrame([], empty_schema)
        path = self.path("bronze", table)
        try:
            rows = (self.spark.read.schema(contract) if contract is not None
                    else self.spark.read.option("mergeSchema", "true")).parquet(path)
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return self.spark.createDataFrame([], empty_schema)
        if load_id is not None:
            rows = rows.where(F.col(LOAD_COL) == load_id) if LOAD_COL in rows.columns else rows.limit(0)
        return rows.drop(LOAD_COL)

    def read_loads(self, table: str, contract: T.StructType) -> DataFrame:
        """A bronze table with the id of each row's load as ``load_id`` (text), a partition column: a filter on it opens only those loads' files."""
        schema = T.StructType([*contract.fields, T.StructField(LOAD_COL, T.StringType())])
        if not self.exists("bronze", table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path("bronze", table))

    def append_bronze(self, df: DataFrame | None, table: str, contract: T.StructType | None = None,
                      partition_by: tuple[str, ...] = ("country_code",), month_of: str | None = None,
                      load_id: str | None = None) -> None:
        """SNK1 / SNK2 / SNK3: append with an additive schema; a missing frame is skipped.

        Known columns are cast to the contract (e.g. the renewable flag to
        BOOLEAN); new columns are stored as they come.  Partitioning by
        country keeps per-country scans (high-water marks, filters) pruned.
        ``month_of`` names a timestamp column whose UTC month becomes a second
        partition column (``index_month``), so time-series tables can be
        re-aggregated month by month.  Rows are rebalanced on the partition
        columns first (one shuffle), which keeps the file count near one per
        partition without making a large partition a single task.

        The last partition column is the load's id, a new one for each append
        unless ``load_id`` names it (letters, digits, ``-``).  An append repeated under its id
        overwrites exactly the partitions it wrote before.
        """
        if df is None:
            return
        if contract is not None:
            df = cast_known(df, contract)
        if month_of is not None:
            df = df.withColumn(MONTH_COL, month_key(F.col(month_of)))
            partition_by = (*partition_by, MONTH_COL)
        # Cluster rows by the partition columns before writing, so each
        # partition gets a few files instead of one per task; AQE splits a
        # hot partition (a large country) and coalesces small ones.
        clustered = df.hint("rebalance", *partition_by).withColumn(LOAD_COL, F.lit(load_id or f"load-{uuid.uuid4().hex}"))
        (clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by, LOAD_COL).parquet(self.path("bronze", table)))

    def table_exists(self, layer: str, name: str) -> bool:
        return self.exists(layer, name)

    # -- SNK4 / SNK5 ------------------------------------------------------
    def register_bronze(self, table: str, contract: T.StructType, partition_by: tuple[str, ...] = ("country_code",), month_of: str | None = None) -> str:
        """A bronze table in the catalogue, over its folder and with its contract's columns; returns its qualified name.

        Partitions are those that exist now: register again after loads (``layers.build_models`` does).
        """
        self.create_layers()
        name, path = self.name("bronze", table), self.path("bronze", table)
        parts = (*partition_by, *((MONTH_COL,) if month_of else ()), LOAD_COL)
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in contract.fields if f.name not in parts] + [f"`{p}` string" for p in parts]
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} ({', '.join(fields)}) USING parquet PARTITIONED BY ({', '.join(parts)}) LOCATION '{path}'")
        if self.exists("bronze", table):
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def create_view(self, layer: str, name: str, query: str) -> DataFrame:
        """SNK4 + SNK6: a view of the layer's database, kept in the catalogue for every session; recomputed by every reader."""
        self.create_layers()
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, name)} AS {query}")
        return self.spark.table(self.name(layer, name))

    def view(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """SNK4 for a model that exists only as a frame: a view of this session, under its layer's name (``<database>__<name>``) and its own."""
        df.createOrReplaceTempView(f"{self.layers[layer]}__{name}")
        df.createOrReplaceTempView(name)
        return df

    def save_table(self, df: DataFrame, layer: str, name: str,
                   partition_by: tuple[str, ...] = ()) -> DataFrame:
        """SNK5: rebuild a table in full, register it, and return a scan of it.

        Each rebuild writes a new version folder and only then points the
        table to it, so a job that dies while writing leaves the last
        complete version in place, and readers never see a gap.  The version
        before stays for readers that still scan it; older ones are deleted.
        The returned frame reads the written files, which cuts the lineage
        (later models do not recompute this one) and gives the planner the
        table's real size for join planning.
        """
        version = f"{VERSION}{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        path = f"{self.path(layer, name)}/{version}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        db = self.layers[layer]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{self.root}/{db}'")
        if self.spark.catalog.tableExists(f"{db}.{name}") and self.spark.table(f"{db}.{name}").schema == self.spark.read.parquet(path).schema:
            self.spark.sql(f"ALTER TABLE {db}.{name} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(f"{db}.{name}")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
            self.spark.catalog.createTable(f"{db}.{name}", path=path, source="parquet")
        if partition_by:
            self.spark.sql(f"ALTER TABLE {db}.{name} RECOVER PARTITIONS")
        for old in self._versions(layer, name)[:-2]:
            self._delete(f"{self.path(layer, name)}/{old}")
        return self.spark.read.parquet(path)

    def current(self, layer: str, name: str) -> str | None:
        """The folder of a table's last complete version, or None."""
        versions = self._versions(layer, name)
        return f"{self.path(layer, name)}/{versions[-1]}" if versions else None

    def _versions(self, layer: str, name: str) -> list[str]:
        """Complete versions (Spark's commit marker is there), oldest first."""
        return [v for v in self._list(self.path(layer, name))
                if v.startswith(VERSION) and "_SUCCESS" in self._list(f"{self.path(layer, name)}/{v}")]

    # -- months to refresh --------------------------------------------------
    def mark_pending(self, pairs: DataFrame, table: str, load_id: str | None = None) -> None:
        """Record (country, month) pairs that are about to be appended to a bronze table."""
        pairs.write.mode("overwrite").parquet(f"{self.root}/{PENDING}/{table}/{load_id or uuid.uuid4().hex}")

    def pending(self, table: str) -> list[str]:
        """Folders of pairs that no rebuild has taken up yet."""
        top = f"{self.root}/{PENDING}/{table}"
        return [f"{top}/{x}" for x in self._list(top) if "_SUCCESS" in self._list(f"{top}/{x}")]

    def clear_pending(self, folders: list[str]) -> None:
        for folder in folders:
            self._delete(folder)

    def drop_staged(self, load_id: str) -> None:
        """Delete the parsed documents of a finished load."""
        self._delete(f"{self.root}/_staged/{load_id}")

    # -- folders --------------------------------------------------------------
    def _fs(self, path: str):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def _list(self, path: str) -> list[str]:
        fs, hpath = self._fs(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(hpath)) if fs.exists(hpath) else []

    def _delete(self, path: str) -> None:
        fs, hpath = self._fs(path)
        fs.delete(hpath, True)

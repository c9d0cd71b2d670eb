"""Pieces that several training-data operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.operators.joins import freeze
from gridmix.session import shared_dir

#: White space of every operator here (fixed by the queries' contracts), as a Java and Python pattern.
SPACE = r"[\x20\x09-\x0D]"
#: One word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
EDGES_A_TASK = 50_000  # of a union-find round


def text_or_empty(column) -> F.Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def store(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: like a checkpoint, but compressed by column.

    For intermediate results that grow with the texts.  The folder stays until
    whoever owns ``spark.checkpoint.dir`` clears it after the run.
    """
    path = shared_dir(df.sparkSession, f"stored-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distributed union-find over an edge list: ``(node, component)`` for every node that has an edge.

    ``component`` is the smallest node reachable.  Alternating large-star and
    small-star steps (each a partial ``min`` and an equi-join, so a hub with a
    third of all edges is pre-aggregated and its join side can be split) until
    the edge set no longer changes.  The edges are checkpointed after each
    round: lineage stays short and a lost executor costs one round.  Self
    loops, repeated edges and NULL ends are ignored; no edges give no rows.
    """
    e = freeze(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
        .filter("_a is not null and _b is not null and u <> v").select("u", "v").distinct()
    )
    before = _signature(e)
    tasks = 1 + before[0] // EDGES_A_TASK
    e = e.coalesce(tasks)  # a shuffle of few edges into few files
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.withColumnRenamed("m", "v")).coalesce(tasks).distinct()
        )
        e = freeze(small.coalesce(tasks))
        after = _signature(e)
        if after == before:
            break
        before = after
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

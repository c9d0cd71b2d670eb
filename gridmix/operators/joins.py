"""Join helpers with a checked broadcast.

A side is broadcast only after it has been shown to hold at most ``max_rows``
rows (counting stops at ``max_rows + 1``); otherwise the join is left to the
planner (sort-merge with AQE skew handling).  Only the join keys of the small
side are kept, so a broadcast row is a few bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if ``df`` is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def semi_join(big: DataFrame, keys: DataFrame, on: list[str] | str,
              max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """JN1 / SUB1: rows of ``big`` whose key occurs in ``keys`` (IN-subquery)."""
    cols = [on] if isinstance(on, str) else list(on)
    return big.join(checked_broadcast(keys.select(*cols), max_rows), cols, "left_semi")


def anti_join(big: DataFrame, keys: DataFrame, on: list[str] | str,
              max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """JN2: rows of ``big`` whose key does not occur in ``keys`` (NOT EXISTS)."""
    cols = [on] if isinstance(on, str) else list(on)
    return big.join(checked_broadcast(keys.select(*cols), max_rows), cols, "left_anti")


def lookup_join(big: DataFrame, small: DataFrame, on: list[str] | str, how: str = "left",
                max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a (possibly) small lookup side, broadcasting it only if proven small."""
    cols = [on] if isinstance(on, str) else list(on)
    return big.join(checked_broadcast(small, max_rows), cols, how)


def in_partitions(df: DataFrame, keys: DataFrame, on: list[str],
                  max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` in the partitions that ``keys`` (text columns) names, and all rows with a NULL key.

    Equality keeps the join open to partition pruning (a null-safe join is
    not), and the comparison with the empty text, true of every key, is
    the selective filter without which Spark does not try it.  The few
    partitions of NULL keys are a filter on partition values.
    """
    empty = " or ".join(f"{c} is null" for c in on)
    keys = keys.where(" and ".join(f"{c} >= ''" for c in on))
    return semi_join(df, keys, on, max_rows).unionByName(df.where(empty))


def freeze(df: DataFrame) -> DataFrame:
    """Checkpoint a small frame that several jobs reuse (a plan, a dimension).

    The rows go to the shared ``spark.checkpoint.dir`` (set by the deployment;
    tests set their own), so later jobs read them back instead of recomputing
    the scans behind them, and a lost executor does not lose them.
    """
    from gridmix.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread rows over at least ``min_partitions`` tasks before CPU-heavy row work.

    Parsing documents costs far more per row than reading them (``from_xml``
    parsed about 55 MB/s per core here).  An input with fewer partitions
    than the cluster has cores (one large file, one row group) would leave
    most cores idle, so it is repartitioned round-robin first: at sf0.1 the
    per-unit parse went from 10.0 s in one task to 4.5 s.  The price is one
    shuffle of the input, which moves data at about the rate it is parsed.
    So an input that is already spread over many tasks gains little, and
    callers can pass a lower ``min_partitions``.  An input with enough
    partitions is left as is.  ``min_partitions`` defaults to the default
    parallelism.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df

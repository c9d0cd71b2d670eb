"""Exact de-duplication with two-pass Bloom filtering.

Pass 1 hashes every normalised text to two filter positions and counts the
positions (partial counts before the shuffle); those seen twice or more make
the filter, a bit map kept as blocks of 32,768 bits.  Pass 2 tests each row
against the broadcast filter.  A row whose two positions are both set is
possibly repeated and is shuffled to its group; every other row is proven
unique and passes straight through.

The filter has ``bits_per_row`` bits a row and never more than ``max_bits``
(its proven broadcast bound, 64 MB by default).  Beyond that size more unique rows are
shuffled than need be; the result is the same.

Defined cases: a NULL text counts as empty, all empty texts are one group; a
NULL id sorts after every other id; rows that repeat an id and a text count in
``group_size`` and are the same document, so they share ``kept``; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import SPACE, text_or_empty
from gridmix.operators.joins import freeze

BLOCK_BITS = 32_768  # of bitmap_construct_agg


def filter_bits(rows: int, bits_per_row: int = 16, max_bits: int = 1 << 29) -> int:
    """The least power of two with ``bits_per_row`` bits a row, within one block and ``max_bits``."""
    bits = BLOCK_BITS
    while bits < min(rows * bits_per_row, max_bits):
        bits *= 2
    return bits


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_cp, sha, h`` of each row: code points of the text, digest and hash of the text without white space."""
    return (
        docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
        .select("id", F.length("t").cast("long").alias("n_cp"), F.regexp_replace("t", SPACE, "").alias("norm"))
        .select("id", "n_cp", F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("h"))
    )


def _positions(bits: int) -> list:
    return [F.pmod(F.col("h"), F.lit(bits)), F.pmod(F.xxhash64("h"), F.lit(bits))]


def repeated_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """The Bloom filter of the positions that two rows or more set: ``block, bitmap``."""
    return (
        hashes.select(F.explode(F.array_distinct(F.array(*_positions(bits)))).alias("p"))
        .groupBy("p").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .groupBy(F.expr(f"p div {BLOCK_BITS}").alias("block"))
        .agg(F.bitmap_construct_agg(F.expr(f"p % {BLOCK_BITS}")).alias("bitmap"))
    )


def possibly_repeated(rows: DataFrame, bloom: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``maybe``: both positions of ``h`` are set in the filter."""
    out = rows
    for k, p in enumerate(_positions(bits)):
        side = F.broadcast(bloom.select(F.col("block").alias(f"_b{k}"), F.col("bitmap").alias(f"_m{k}")))
        out = out.withColumn(f"_p{k}", p).join(side, F.expr(f"_p{k} div {BLOCK_BITS} = _b{k}"), "left")
    test = "coalesce(shiftright(cast(conv(hex(substring({m}, cast({p} % {n} div 8 as int) + 1, 1)), 16, 10) as int), cast({p} % 8 as int)) & 1, 0) = 1"
    both = " and ".join(test.format(m=f"_m{k}", p=f"_p{k}", n=BLOCK_BITS) for k in range(2))
    return out.select(*rows.columns, F.expr(both).alias("maybe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                bits_per_row: int = 16, max_bits: int = 1 << 29) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space.  Of equal texts the
    one with the most code points stays, then the smallest id.
    """
    bits = filter_bits(docs.count(), bits_per_row, max_bits)
    rows = digests(docs, id_col, text_col)
    bloom = freeze(repeated_filter(rows.select("h"), bits))
    tested = freeze(possibly_repeated(rows, bloom, bits).drop("h"))
    maybe = tested.filter("maybe").select("id", "n_cp", "sha")
    groups = maybe.groupBy("sha").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n_cp")).alias("rank"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))).alias("best"),
    )
    shuffled = maybe.join(groups, "sha").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        F.col("id").eqNullSafe(F.col("best.id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    straight = tested.filter("not maybe").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    return shuffled.unionByName(straight)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept; rows are told apart by id and text."""
    stay = exact_dedup(docs, id_col, text_col, **options).filter("kept").select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    normal = F.sha2(F.regexp_replace(text_or_empty(text_col), SPACE, ""), 256)
    marked = docs.withColumn("_digest", normal)
    return (
        marked.join(stay, marked[id_col].eqNullSafe(stay["_id"]) & (F.col("_digest") == F.col("_sha")), "left_semi")
        .dropDuplicates(["_digest"]).drop("_digest")
    )

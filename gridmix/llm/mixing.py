"""Mixing sources to target weights: packed blocks, permuted indexes, no sampling of rows.

1. Words are packed: the documents of a source, one after the other, form a
   stream of words that is cut into blocks of ``block`` words (the last one
   may be shorter).  Positions in the stream are prefix sums taken in two
   levels (buckets of a few thousand rows, then the buckets' sums), so a
   source with a third of all rows is never ordered in one task.
2. Each source's target is turned into slots: as many passes over its blocks
   as the target holds, then part of a pass, the last slot cut so that the
   words taken equal the rounded target.  A target is at most ``cap`` times
   the source, so no block is used more than ``cap`` times.
3. All slots are dealt to output shards by a pseudorandom permutation of the
   global slot numbers.  The source counts of a shard are thus a multinomial
   draw conditioned on the totals (multivariate hypergeometric): drawn at
   random in each shard, exact over all shards.
4. Inside a source, slot ``i`` of a pass maps to a block through that pass's
   own pseudorandom permutation of the block numbers, and slots join blocks
   by that index.

The permutations are swap-or-not shuffles: bijections of ``[0, n)`` for any n,
computed per row without a sort.  Everything is built-in functions.

Defined cases: a NULL or blank text has size 0 and is never taken; a NULL
source is a source of its own, the last one; repeated rows are separate
documents; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import WORD, text_or_empty
from gridmix.operators.joins import checked_broadcast, freeze

ROUNDS = 20
CHUNK = 4096
TASK_SLOTS = 100_000


def permute(x: F.Column, n: F.Column, *key: F.Column, rounds: int = ROUNDS) -> F.Column:
    """A pseudorandom bijection of ``[0, n)`` chosen by ``key``, applied to ``x`` (n >= 1)."""
    steps = F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda r: F.struct(
        F.pmod(F.xxhash64(*key, r), n).alias("k"), r.alias("r")))

    def step(y: F.Column, s: F.Column) -> F.Column:
        other = F.pmod(s["k"] - y, n)
        swap = F.pmod(F.xxhash64(*key, F.lit("swap"), s["r"], F.greatest(y, other)), F.lit(2)) == 1
        return F.when(swap, other).otherwise(y)

    return F.aggregate(steps, x.cast("long"), step)


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """``rank, source, source_size, target`` for each source.

    Weights repeat over the sources by name (NULL last).  ``share`` times all
    words is dealt by weight; a source stops at ``cap`` times its size and the
    excess is dealt again by weight: with sources ordered by cap over weight, the
    capped ones come first, and the level of the others is the largest
    ``(rest of the words) / (rest of the weights)`` along that order.
    One row per source goes through these windows, not one per document.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "rank")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("ratio", F.col("most") / F.col("w"))
        .withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("level", (F.col("all_words") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
                    / (F.col("all_w") - F.coalesce(F.sum("w").over(earlier), F.lit(0))))
        .withColumn("level", F.max("level").over(everything))
        .select("rank", "source", "source_size", F.least("most", F.col("level") * F.col("w")).alias("target"))
    )


def positions(sized: DataFrame, by_source: DataFrame, bucket_rows: int = 2000) -> DataFrame:
    """Each document's row in its source's stream: ``rank, bucket, rn, id, size, start, source_size, target``."""
    buckets = max(1, -(-sized.count() // bucket_rows))
    rows = (
        sized.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
        .join(checked_broadcast(by_source), sized["source"].eqNullSafe(by_source["source"]))
        .select("rank", "bucket", "id", "size", "source_size", "target")
    )
    inside = Window.partitionBy("rank", "bucket").orderBy("id", "size")
    before = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("n")).select(
        "rank", "bucket", (F.sum("n").over(Window.partitionBy("rank").orderBy("bucket")) - F.col("n")).alias("offset"))
    return (
        rows.withColumn("rn", F.row_number().over(inside))
        .withColumn("within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(before, ["rank", "bucket"])
        .withColumn("start", F.col("offset") + F.col("within")).drop("offset", "within")
    )


def pieces(placed: DataFrame, block: int) -> DataFrame:
    """The part of each block that each document fills: words ``a`` to ``b`` of ``block_no``, from ``word`` of the document."""
    last = F.greatest("start", F.col("start") + F.col("size") - 1)
    blocks = F.explode(F.sequence(F.expr(f"start div {block}"), F.floor(last / block))).alias("block_no")
    return placed.select("*", blocks).withColumn("a", F.greatest(F.lit(0), F.col("start") - F.col("block_no") * block)).withColumn(
        "b", F.least(F.lit(block), F.col("start") + F.col("size") - F.col("block_no") * block)).withColumn(
        "word", F.col("block_no") * block + F.col("a") - F.col("start"))


def slots(by_source: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """``shard, slot, rank, block_no, words`` for every slot of the mix."""
    per_source = (
        by_source.filter("source_size > 0")
        .withColumn("goal", F.least(F.round("target").cast("long"), F.floor(F.col("target")).cast("long") + 1))
        .withColumn("full", F.expr(f"source_size div {block}"))
        .withColumn("tail", F.col("source_size") % block)
        .withColumn("blocks", F.col("full") + F.when(F.col("tail") > 0, 1).otherwise(0))
        .withColumn("n", F.expr("goal div source_size") * F.col("blocks") + F.ceil((F.col("goal") % F.col("source_size")) / block))
        .withColumn("offset", F.sum("n").over(Window.orderBy("rank")) - F.col("n"))
        .withColumn("total", F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .filter("n > 0")
    )
    chunks = per_source.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}"))))
    total = per_source.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # a few bytes a chunk become thousands of slots: adaptive execution, which goes by bytes, must not put chunks together
    each = chunks.repartition(max(1, -(-total // TASK_SLOTS)), "rank", "chunk").withColumn(
        "j", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least("n", (F.col("chunk") + 1) * CHUNK) - 1)))
    return (
        each.withColumn("turn", F.expr("j div blocks")).withColumn("i", F.col("j") % F.col("blocks"))
        .withColumn("block_no", F.when(F.col("i") < F.col("full"), permute(
            F.col("i"), F.greatest("full", F.lit(1).cast("long")), F.lit(seed), F.col("rank"), F.col("turn"))).otherwise(F.col("full")))
        .withColumn("words", F.least(
            F.when(F.col("i") < F.col("full"), F.lit(block).cast("long")).otherwise(F.col("tail")),
            F.col("goal") - F.col("turn") * F.col("source_size") - F.col("i") * block))
        .withColumn("at", permute(F.col("offset") + F.col("j"), F.col("total"), F.lit(seed), F.lit("deal")))
        .select(F.expr(f"at div {shard_slots}").alias("shard"), (F.col("at") % shard_slots).alias("slot"), "rank", "block_no", "words")
    )


def _parts(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share, cap, block, shard_slots, seed):
    sized = freeze(sizes(docs, id_col, text_col, source_col))
    by_source = freeze(targets(sized, weights, share, cap))
    return pieces(positions(sized, by_source), block), slots(by_source, block, shard_slots, seed), by_source


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block: int = 128,
        shard_slots: int = 4096, seed: int = 17) -> DataFrame:
    """The mix itself: ``shard, slot, at, source, id_col, word, words``.

    Slot ``slot`` of output ``shard`` holds, from its word ``at`` on, ``words``
    words of the document, starting with its word ``word``.
    """
    filled, dealt, by_source = _parts(docs, id_col, text_col, source_col, weights, share, cap, block, shard_slots, seed)
    taken = F.least("b", "words") - F.col("a")
    return (
        filled.join(dealt.hint("merge"), ["rank", "block_no"]).filter(taken > 0)
        .join(checked_broadcast(by_source.select("rank", "source")), "rank")
        .select("shard", "slot", F.col("a").alias("at"), "source", F.col("id").alias(id_col), "word", taken.alias("words"))
    )


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
               weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block: int = 128,
               shard_slots: int = 4096, seed: int = 17) -> DataFrame:
    """One row per document: ``id_col, size, source_size, target, taken`` (words that the mix takes, repeats counted)."""
    filled, dealt, _ = _parts(docs, id_col, text_col, source_col, weights, share, cap, block, shard_slots, seed)
    taken = F.greatest(F.lit(0), F.least("b", F.coalesce("words", F.lit(0))) - F.col("a"))  # least() skips NULL
    return (
        filled.join(dealt.select("rank", "block_no", "words").hint("merge"), ["rank", "block_no"], "left")
        .groupBy("rank", "bucket", "rn", "id", "size", "source_size", "target")
        .agg(F.coalesce(F.sum(taken), F.lit(0)).cast("long").alias("taken"))
        .select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")
    )

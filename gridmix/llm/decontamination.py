"""Benchmark decontamination: MinHash containment search, verified by exact shingle containment.

An item's set is its distinct five-word shingles, hashed to 64 bits (the whole
sequence of words as one shingle if there are fewer).  A document holds an item when
it has at least 80% of the item's shingles, however long the document is.  For items of fewer than five words the
documents' runs of as many words are looked up too (of the lengths that occur among the items).

*Search.*  Items are partitioned by set size (powers of two).  Each
partition's sketch is a bottom-k MinHash: the k smallest hashes of the set, where k
is one more than the shingles that the partition's largest item may miss.
A document that holds an item has one of its sketch's hashes at least
(pigeonhole), so no item is missed; nothing is signed on the side of the
documents, whose length does not matter.

*Verification.*  Only documents found by the search are read again; their
shingles are joined to the full sets of the items and counted for the pairs found.

The items' sides are broadcast once their size is checked, else the joins
shuffle.  Only DataFrame functions are used.

Defined cases: NULL and wordless items or texts match nothing; documents are
told apart by id and text, so rows that repeat both are one document, as are
items; NULL ids are kept; words are lower-cased and parted by ASCII white space; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import WORD
from gridmix.operators.joins import checked_broadcast, freeze

WIDTH = 5
SMALL = 500_000  # rows of a few longs that may be broadcast


def word_list(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def shingle_hashes(words: str, width: int = WIDTH) -> Column:
    """Hashes of all shingles of a word array (empty or NULL gives none), repeats included."""
    w, n = F.col(words), F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
    return F.when(n >= width, windows).when(n > 0, F.array(F.xxhash64(F.lit("short"), F.array_join(w, " "))))


def _short_runs(words: str, lengths: list[int]) -> list[Column]:
    """Hashes of all runs of so few words, as an item of that length has."""
    w, n = F.col(words), F.size(words)

    def runs(k: int) -> Column:
        return F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(F.lit("short"), F.array_join(F.slice(w, i + 1, k), " ")))

    return [F.when(n >= k, runs(k)) for k in lengths]


def _shingled(rows: DataFrame, id_col: str, text_col: str, width: int, lengths: list[int] | None = None) -> DataFrame:
    """``id, h, s`` of each row; with ``lengths``, the runs of so many words too.

    No filter may stand on ``s`` (``explode`` infers one, ``explode_outer`` does not): the
    optimizer would push it below and cut the text into words once per shingle.
    """
    return (
        rows.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), word_list(text_col).alias("w"))
        .select("id", "h", F.array_distinct(_joined([shingle_hashes("w", width), *_short_runs("w", lengths or [])])).alias("s"))
    )


def _joined(lists: list[Column]) -> Column:
    return lists[0] if len(lists) == 1 else F.concat(*[F.coalesce(x, F.array().cast("array<bigint>")) for x in lists])


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """The sketch of each item (``item, s, n``), by size partition: ``item, hash``."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    k = (largest - F.ceil(largest * threshold - 1e-9) + 1).cast("int")
    return items.select("item", F.explode(F.slice(F.sort_array("s"), 1, k)).alias("hash"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", *, threshold: float = 0.8, width: int = WIDTH) -> DataFrame:
    """Every document and item it holds: ``id_col, h, item_col, n_item, n_shared, containment``.

    ``h`` is the hash of the document's text.
    """
    sets = freeze(_shingled(items, item_col, item_text_col, width).select(
        F.struct("id", "h").alias("item"), "s", F.size("s").alias("n")).dropDuplicates(["item"])).filter("n > 0")
    few = F.size(word_list(item_text_col))
    lengths = sorted(r[0] for r in items.select(few.alias("n")).filter((F.col("n") > 0) & (F.col("n") < width)).distinct().collect())  # below ``width``
    sketch = checked_broadcast(sketches(sets, threshold), SMALL)
    documents = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = freeze(
        _shingled(documents, "id", "text", width, lengths).select("id", "h", F.explode_outer("s").alias("hash"))
        .join(sketch, "hash").select("id", "h", "item").distinct()
    )
    again = checked_broadcast(found.select(F.col("id").alias("_id"), F.col("h").alias("_h")).distinct(), SMALL)
    documents = documents.withColumn("_hash", F.xxhash64("text"))
    held = documents.join(again, F.col("id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_semi")
    full = checked_broadcast(sets.select("item", F.explode("s").alias("hash"), "n"), SMALL)
    counted = (
        _shingled(held, "id", "text", width, lengths).dropDuplicates(["id", "h"]).select("id", "h", F.explode_outer("s").alias("hash"))
        .join(full, "hash").groupBy("id", "h", "item", "n").agg(F.count(F.lit(1)).alias("n_shared"))
        .filter(F.col("n_shared") >= F.col("n") * threshold - 1e-9)
    )
    f, c = found.alias("f"), counted.alias("c")
    return (
        c.join(f, F.expr("c.id <=> f.id and c.h = f.h and c.item.id <=> f.item.id and c.item.h = f.item.h"), "left_semi")
        .select(F.col("id").alias(id_col), "h", F.col("item.id").alias(item_col), F.col("n").cast("long").alias("n_item"),
                "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns kept."""
    held = contained_items(docs, items, id_col, text_col, **options).select(F.col(id_col).alias("_id"), F.col("h").alias("_h")).distinct()
    return (
        docs.withColumn("_hash", F.xxhash64(text_col))
        .join(checked_broadcast(held, SMALL), docs[id_col].eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_anti")
        .select(*docs.columns)
    )

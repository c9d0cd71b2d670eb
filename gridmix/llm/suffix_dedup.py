"""Repeated passages by sparse suffix arrays.

A passage is repeated when the same words (white space aside) stand in two
places; ``min_words`` words (50) make a passage.

1. *Sparse suffixes.*  Only suffixes at content-selected positions are kept: of
   every ``window`` (16) neighbouring ones that whose first ``min_words - window + 1``
   words have the smallest hash (a minimiser).  Equal passages select equal
   positions, and each passage of ``min_words`` words holds a selected suffix with its whole key.
2. *Neighbours.*  Suffixes are sorted and grouped by these keys across the cluster;
   one whose key no other suffix has is dropped.  What is left lies in or near a repeat.
3. *Extension.*  Around each kept suffix the match is extended left and right: of the
   ``window`` places where a passage of ``min_words`` words over it can begin, those whose passage occurs
   again, anywhere, are found by counting the passages' hashes (counts are partial before
   the shuffle, so a passage that a third of all documents share is no hot group).
   Overlapping repeated passages of a document make its spans.

Equal texts are classed first, by a 128-bit hash, and only one of each class
is searched; the others are one span each.

Result: one row per span.  ``removable`` spans have an earlier occurrence, in the document with the
smallest id (``first_id``), or earlier in the same document; the others are that first occurrence.

Defined cases: NULL texts, texts of fewer than ``min_words`` words and rows
with a NULL id have no span; rows that repeat an id and a text are one
document, different texts under one id are documents of their own; very long texts are read whole; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import WORD, store
from gridmix.llm.ngram_join import Powers, _lists
from gridmix.operators.joins import checked_broadcast

MIN_WORDS, WINDOW = 50, 16
SMALL = 1_000_000  # ids that may be broadcast
_WORDS = re.compile(WORD)


class _Text:
    """The words of a text as hashes, and the hashes of all runs of ``k`` words."""

    def __init__(self, text: str | None, powers: Powers) -> None:
        self.powers, self.words = powers, powers.words((text or "").encode("utf-8", "replace"))

    def runs(self, k: int) -> np.ndarray:
        starts = np.arange(max(0, len(self.words) - k + 1))
        return self.powers.runs(self.words, starts, starts + k)


def selected(keys: np.ndarray, window: int) -> np.ndarray:
    """Positions of the minimisers: of each ``window`` neighbouring keys the (leftmost) smallest."""
    if len(keys) < window:
        return np.empty(0, np.int64)
    return np.unique(sliding_window_view(keys, window).argmin(axis=1) + np.arange(len(keys) - window + 1))


def _sample(min_words: int, window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            keys, words = [], []
            for text in batch["text"]:
                t = _Text(text.as_py(), powers)
                runs = t.runs(min_words - window + 1)
                keys.append(runs[selected(runs, window)].view(np.int64))
                words.append(len(t.words))
            yield pa.RecordBatch.from_arrays([batch[c] for c in ("id", "doc", "h1", "h2")] + [pa.array(words, pa.int64()), _lists(keys)],
                                             names=["id", "doc", "h1", "h2", "n_words", "keys"])

    return run


def _passages(min_words: int, window: int) -> Callable:
    """Rows of ``id, text, kept`` (keys) to the passages over the kept suffixes: ``id``, arrays ``start, passage, again`` (stands before in the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            starts, passages, again = [], [], []
            for text, kept in zip(batch["text"], batch["kept"], strict=True):
                t = _Text(text.as_py(), powers)
                runs = t.runs(min_words - window + 1)
                at = selected(runs, window)
                at = at[np.isin(runs[at].view(np.int64), kept.values.to_numpy(zero_copy_only=False))]
                whole = t.runs(min_words)
                near = np.unique((at[:, None] - np.arange(window)).ravel())
                near = near[(near >= 0) & (near < len(whole))]
                starts.append(near)
                passages.append(whole[near].view(np.int64))
                later = np.ones(len(near), np.int64)
                later[np.unique(passages[-1], return_index=True)[1]] = 0
                again.append(later)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["doc"], _lists(starts), _lists(passages), _lists(again)], names=["id", "doc", "start", "passage", "again"])

    return run


def _spans(min_words: int) -> Callable:
    """Rows of ``id, text, copies`` and arrays ``start, removable, first_id`` of repeated passages to spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for k in range(batch.num_rows):
                id_, words = batch["id"][k].as_py(), [m.span() for m in _WORDS.finditer(batch["text"][k].as_py() or "")]
                start, removable, first = (np.asarray(batch[c][k].values if batch[c][k].is_valid else [], np.int64) for c in ("start", "removable", "first_id"))
                order = np.argsort(start)
                order = order[start[order] + min_words <= len(words)]
                start, removable, first = start[order], removable[order], first[order]
                if batch["copies"][k].as_py() > 1:  # every passage of the text stands in its copies too
                    n = len(words) - min_words + 1
                    all_removable, all_first = np.zeros(n, np.int64), np.full(n, id_)
                    all_removable[start], all_first[start] = removable, first
                    start, removable, first = np.arange(n), all_removable, all_first
                if not len(start):
                    continue
                cuts = np.flatnonzero((np.diff(start) != 1) | (np.diff(removable) != 0)) + 1
                begins, ends = np.append(0, cuts), np.append(cuts, len(start)) - 1
                for a, b, low in zip(begins, ends, np.minimum.reduceat(first, begins), strict=True):
                    row = (id_, words[start[a]][0], words[start[b] + min_words - 1][1], int(start[b] - start[a]) + min_words, bool(removable[a]), int(low))
                    for c, v in zip(columns, row, strict=True):
                        c.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["id", "start", "end", "n_words", "removable", "first_id"])

    return run


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, doc, text`` of the wanted documents, one row each."""
    return rows.join(checked_broadcast(wanted.select("doc"), SMALL), "doc", "left_semi").groupBy("doc").agg(F.any_value("id").alias("id"), F.any_value("text").alias("text"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                      min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """One row per span: ``id_col, start, end`` (code points), ``n_words, removable, first_id``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null").withColumn(
        "doc", F.xxhash64("id", "text"))
    hashed = rows.select("id", "doc", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"), "text")
    samples = store(hashed.mapInArrow(_sample(min_words, window), "id long, doc long, h1 long, h2 long, n_words long, keys array<long>")
                    .filter(F.col("n_words") >= min_words))
    first = F.min(F.struct("id", "doc"))
    classes = store(samples.groupBy("h1", "h2").agg(first.alias("f"), F.count(F.lit(1)).alias("copies")).select(
        "h1", "h2", F.col("f.id").alias("first_id"), F.col("f.doc").alias("first_doc"), "copies"))
    searched = samples.join(checked_broadcast(classes.select(F.col("first_doc").alias("doc")).distinct(), SMALL), "doc", "left_semi")

    suffixes = searched.select("doc", F.explode("keys").alias("key"))
    again = suffixes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    kept = store(suffixes.join(again, "key").groupBy("doc").agg(F.collect_set("key").alias("kept")))

    near = _texts(rows, kept).join(kept, "doc")
    passages = store(near.mapInArrow(_passages(min_words, window), "id long, doc long, start array<long>, passage array<long>, again array<long>"))
    each = passages.select("id", "doc", F.explode(F.arrays_zip("start", "passage", "again")).alias("p")).select(
        "id", "doc", F.col("p.start").cast("int").alias("start"), "p.passage", F.col("p.again").cast("byte").alias("again"))
    repeats = each.groupBy("passage").agg(F.min(F.struct("id", "doc")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "passage", F.col("f.id").alias("first_id"), F.col("f.doc").alias("first_doc"))
    removable = ((F.col("doc") != F.col("first_doc")) | (F.col("again") == 1)).cast("long")
    at = each.join(repeats, "passage").groupBy("doc").agg(F.collect_list(F.struct("start", removable.alias("removable"), "first_id")).alias("a")).select(
        "doc", F.col("a.start").cast("array<long>").alias("start"), F.col("a.removable").alias("removable"), F.col("a.first_id").alias("first_id"))

    copied = classes.filter("copies > 1").groupBy(F.col("first_doc").alias("doc")).agg(F.max("copies").alias("copies"))
    wanted = store(at.join(copied, "doc", "full").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long"))))
    spans = _texts(rows, wanted).join(wanted, "doc").select("id", "text", "copies", "start", "removable", "first_id").mapInArrow(
        _spans(min_words), "id long, start long, end long, n_words long, removable boolean, first_id long")

    others = samples.join(classes.filter("copies > 1"), ["h1", "h2"]).filter("doc <> first_doc").select("doc", "first_id", "n_words").distinct()
    begin = F.length(F.regexp_extract("text", r"^[\x20\x09-\x0D]*", 0)).cast("long")
    last = F.length(F.rtrim("text", F.lit(" \t\n\x0b\f\r"))).cast("long")
    whole = rows.join(checked_broadcast(others, SMALL), "doc").dropDuplicates(["doc"]).select(
        "id", begin.alias("start"), last.alias("end"), "n_words", F.lit(True).alias("removable"), "first_id")
    return spans.unionByName(whole).withColumnRenamed("id", id_col)

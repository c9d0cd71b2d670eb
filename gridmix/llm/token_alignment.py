"""Cross-tokenizer alignment by interval coalescing: which tokens of a byte-level BPE (A) and of a piece model (B) cover the same bytes.

*Intervals.*  A encodes the text with a space in front, B the text (it adds the space itself), so
both token rows tile the same bytes.  A task lexsorts all A and B tokens of its words by
start and takes ``maximum.accumulate`` of their ends; a group breaks where a start reaches the running maximum,
which is where both kinds of token end.  Inside a group every A token meets every B token: a link.

*Words.*  Both tokenizers cut before a space that follows a character other than white space, and around a line feed, so equal words of a
task are encoded and coalesced once, and a document's groups, links and counts are those of its words.

*Corpus counts.*  A task writes, for each block of at most ``BLOCK_BYTES`` of text, the block's distinct id
pairs with the number of its documents that hold them, and for each document the numbers of its
pairs in that list.  Only block pairs are shuffled: summed by pair, compared with the highest of their A id, and sent
back to their block, where documents and pairs meet in a cogroup of bounded size.  A frequent
pair is one row a block, and nothing is broadcast or collected.

Defined cases: NULL and empty texts, and texts that hold U+2581 (B's bytes differ), have no tokens: zeros and no groups;
very long texts are one block of their own; rows that repeat an id or a text are documents of their own; a NULL id is kept; an empty table
gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import store
from gridmix.llm.piece_encoding import cut_words, encode_words, flat, gather, load, slices

BLOCK_BYTES = 3 << 20
ALIGNED = ("n_a long, n_b long, n_groups long, n_links long, groups string, block long, pair_at array<int>, pair_n array<int>, "
           "pairs array<long>, pair_docs array<int>")


#: The pattern by which byte-level BPE of this kind parts a text before merging (a fixed value of the file format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=2)
def load_bytes(model: str) -> tuple[Callable[[list[str]], list[list[int]]], pa.Array]:
    """The byte-level tokenizer of a JSON file's content, as a function over texts, and each id's bytes.

    A file whose ids follow its merges is run by the faster library, which merges by id.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_str(model)
    tokenizer.encode_special_tokens = True
    # byte-level BPE writes printable Latin-1 bytes as themselves and the others as the code points from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    surface = [b""] * (1 + max(vocabulary.values()))
    for token, i in vocabulary.items():
        surface[i] = bytes(byte[c] for c in token)
    spec = json.loads(model)
    merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
    in_order = len(vocabulary) == 256 + len(merges) and all(vocabulary.get(m.replace(" ", "")) == 256 + k for k, m in enumerate(merges))
    usual = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if in_order and spec["normalizer"] is None and spec["pre_tokenizer"] == usual and not spec["model"].get("ignore_merges"):
        import tiktoken

        encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={b: i for i, b in enumerate(surface)}, special_tokens={}).encode_ordinary
        return lambda texts: list(map(encode, texts)), pa.array(surface, pa.large_binary())
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], pa.array(surface, pa.large_binary())


def read_tokenizer(path: str) -> str:
    """A tokenizer file's content, read on the driver; tasks get it with their code (a vocabulary, not data)."""
    with open(path, encoding="utf-8") as f:
        json.loads(text := f.read())
    return text


def word_starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where both tokenizers cut: texts' starts, spaces behind a character that is no white space, and around a line feed between ASCII characters."""
    at = np.flatnonzero(data == 32)
    b1, b2, b3 = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    wide = (b1 >= 0x80) & (((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0)))  # also cuts less behind other characters of these blocks
                           | (b3 >= 0xE1) & (b3 <= 0xE3) & ((b2 == 0x80) | (b2 == 0x81) | (b2 == 0x9A) | (b2 == 0xA0)))
    begins = np.zeros(len(data), bool)
    begins[at[(at > 0) & (b1 > 32) & ~wide]] = True
    lines = np.flatnonzero((data[1:-1] == 10) & (data[:-2] > 32) & (data[:-2] < 127) & (data[2:] > 32) & (data[2:] < 127)) + 1
    begins[lines] = begins[lines + 1] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def _spans(surface: pa.Array, ids: np.ndarray, offsets: np.ndarray, starts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each token, given where its word starts, and the words whose bytes (in ``data``) the tokens give."""
    at, got = flat(surface.take(pa.array(ids)))
    bounds = at[offsets]
    valid = np.diff(bounds) == np.diff(starts)
    if not (valid.all() and np.array_equal(got, data)):
        valid &= [np.array_equal(got[a:b], data[c:d]) for a, b, c, d in zip(bounds, bounds[1:], starts, starts[1:], strict=False)]
    shift = np.repeat(starts[:-1] - bounds[:-1], np.diff(offsets))
    return at[:-1] + shift, at[1:] + shift, valid


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each A and each B interval: connected runs of overlapping intervals, by start."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    breaks = start[order][1:] >= reach[:-1]
    group = np.empty(len(start), np.int64)
    group[order] = np.concatenate([[0], np.cumsum(breaks)])[:len(start)]
    return group[:len(a_start)], group[len(a_start):]


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``group, id`` with their numbers, by group."""
    keys, n = np.unique(group << 32 | ids, return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, n


def _texts(a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, per_word: np.ndarray) -> pa.Array:
    """Each word's groups as ``a1,a2|b1;`` and so on; ``per_word``: its tokens."""
    ids = max(a_ids.max(initial=0), b_ids.max(initial=0)) + 1
    table = pa.array([f"{i}{end}" for end in ",|;" for i in range(ids)], pa.large_binary())
    last = lambda group: np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
    order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    at, data = flat(table.take(pa.array(np.concatenate([a_ids + ids * last(a_group), b_ids + 2 * ids * last(b_group)])[order])))
    bounds = at[np.concatenate([[0], np.cumsum(per_word)])]
    return pa.Array.from_buffers(pa.large_binary(), len(per_word), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])


class Words:
    """Both tokenizers' tokens, groups and links of distinct words."""

    def __init__(self, a_encode, a_surface: pa.Array, piece_model, words: pa.Array):
        encoded = a_encode([w.decode() for w in words.to_pylist()])
        a_ids = np.fromiter(chain.from_iterable(encoded), np.int64)
        a_off = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)
        b_ids, b_off = encode_words(piece_model, words)
        b_ids = b_ids.astype(np.int64)
        starts, data = flat(words)
        a_start, a_end, a_valid = _spans(a_surface, a_ids, a_off, starts, data)
        b_start, b_end, b_valid = _spans(piece_model.surface, b_ids, b_off, starts, data)
        self.valid = a_valid & b_valid
        a_keep, b_keep = np.repeat(self.valid, np.diff(a_off)), np.repeat(self.valid, np.diff(b_off))
        a_ids, b_ids = a_ids[a_keep], b_ids[b_keep]
        self.n_a, self.n_b = np.diff(a_off) * self.valid, np.diff(b_off) * self.valid
        a_group, b_group = coalesce(a_start[a_keep], a_end[a_keep], b_start[b_keep], b_end[b_keep])
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        word_of = np.empty(groups, np.int64)
        word_of[a_group] = np.repeat(np.arange(len(words)), self.n_a)
        a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        self.n_groups = np.bincount(word_of, minlength=len(words))
        self.n_links = np.zeros(len(words), np.int64)
        np.add.at(self.n_links, word_of, a_in * b_in)
        ends = lambda n: np.concatenate([[0], np.cumsum(n)])
        self.texts = _texts(a_ids, a_group, b_ids, b_group, self.n_a + self.n_b)
        # links: each group's distinct A ids with its distinct B ids, weighted by how often they occur
        (ga, a, na), (gb, b, nb) = _counted(a_group, a_ids), _counted(b_group, b_ids)
        per = np.bincount(gb, minlength=groups)
        first = ends(per)
        n = per[ga]
        other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[ga], n)
        pair = np.repeat(a, n) << 32 | b[other]
        coded = pa.array(pair).dictionary_encode()
        self.pairs, number = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        of_word, at, self.pair_n = _summed(word_of[np.repeat(ga, n)], number, np.repeat(na, n) * nb[other], max(len(self.pairs), 1))
        self.pair_at, self.pair_offsets = at, ends(np.bincount(of_word, minlength=len(words)))


def _summed(row: np.ndarray, at: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``n`` summed for each distinct ``(row, at)``, by row."""
    key = row * width + at
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[firsts] // width, key[firsts] % width, np.add.reduceat(n, firsts) if len(key) else n


def _per_text(n: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(n[words])])[bounds])


def align_block(a_encode, a_surface: pa.Array, piece_model, texts: pa.Array) -> dict[str, list | np.ndarray]:
    """The columns of ``ALIGNED`` but ``block`` for one block of texts; the first row holds the block's pairs."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    offsets, data = flat(texts)
    size = len(texts)
    if not len(data):
        zero, empty = np.zeros(size, np.int64), [[]] * size
        return {"n_a": zero, "n_b": zero, "n_groups": zero, "n_links": zero, "groups": [""] * size, "pair_at": empty, "pair_n": empty,
                "pairs": [[], *[None] * (size - 1)], "pair_docs": [[], *[None] * (size - 1)]}
    coded, bounds = cut_words(offsets, data, word_starts(offsets, data))
    words = Words(a_encode, a_surface, piece_model, coded.dictionary)
    numbers = coded.indices.to_numpy()
    of_text = np.repeat(np.arange(size), np.diff(bounds))
    bad = np.zeros(size, bool)
    bad[of_text[~words.valid[numbers]]] = True
    good = ~bad
    out = {name: _per_text(getattr(words, name), numbers, bounds) * good for name in ("n_a", "n_b", "n_groups", "n_links")}
    at, data = flat(words.texts.take(coded.indices))
    raw, ends = data.tobytes(), at[bounds]
    out["groups"] = [raw[a:max(a, b - 1)].decode() * g for a, b, g in zip(ends.tolist(), ends[1:].tolist(), good.tolist(), strict=False)]
    use = good[of_text]
    row, word, times = _summed(of_text[use], numbers[use], np.ones(use.sum(), np.int64), len(coded.dictionary))
    at, ends = gather(words.pair_at, words.pair_offsets, pa.array(word))
    weight, _ = gather(words.pair_n, words.pair_offsets, pa.array(word))
    reps = np.diff(ends)
    row, at, weight = _summed(np.repeat(row, reps), at, weight * np.repeat(times, reps), max(len(words.pairs), 1))
    used, place = np.unique(at, return_inverse=True)
    lists = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=size))]), pa.int32())
    out["pair_at"] = pa.ListArray.from_arrays(lists, pa.array(place, pa.int32()))
    out["pair_n"] = pa.ListArray.from_arrays(lists, pa.array(weight, pa.int32()))
    out["pairs"] = [words.pairs[used], *[None] * (size - 1)]
    out["pair_docs"] = [np.bincount(place, minlength=len(used)), *[None] * (size - 1)]
    return out


def align(docs: DataFrame, a_model: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's ``id_col`` and the columns of ``ALIGNED``.

    ``groups`` are ``a1,a2|b1;a3|b2,b3``: decimal ids in order.  ``pair_at`` and ``pair_n``: which of its
    block's ``pairs`` (A id * 2**32 + B id) a row holds, and its links of each.  ``pairs`` and
    ``pair_docs`` stand on one row of each block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a_encode, surface), pieces = load_bytes(a_model), load(b_model)
        if not (pieces.words and pieces.lines):
            raise ValueError("models with pieces that span words or lines are not supported")
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_BYTES):
                out = align_block(a_encode, surface, pieces, batch["text"])
                out["block"] = np.full(batch.num_rows, block)
                block += 1
                kinds = {"groups": pa.string(), "pair_at": pa.list_(pa.int32()), "pair_n": pa.list_(pa.int32()),
                         "pairs": pa.list_(pa.int64()), "pair_docs": pa.list_(pa.int32())}
                names = [f.split()[0] for f in ALIGNED.split(", ")]
                columns = [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], kinds.get(n, pa.int64())) for n in names]
                yield pa.RecordBatch.from_arrays([batch["id"], *columns], names=["id", *names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, {ALIGNED}").withColumnRenamed("id", id_col)


def pair_counts(block_pairs: DataFrame) -> DataFrame:
    """``pair, n_docs, best`` of the corpus: how many documents hold a pair linked, and if no pair of its A id has more."""
    counts = block_pairs.groupBy("pair").agg(F.sum("docs").alias("n_docs")).withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("n_docs").alias("highest"))
    return counts.join(highest, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))


def _score_block(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's documents with ``n_best`` and ``count_sum`` from its pairs' corpus counts."""
    count, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
    at = pairs["at"].to_numpy()
    count[at], best[at] = pairs["n_docs"].to_numpy(), pairs["best"].to_numpy()
    places, weights = (pc.list_flatten(rows[c]).to_numpy().astype(np.int64) for c in ("pair_at", "pair_n"))
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(rows["pair_at"]).to_numpy())]).astype(np.int64)
    out = rows.drop_columns(["pair_at", "pair_n", "block"])
    for name, of in (("n_best", best), ("count_sum", count)):
        out = out.append_column(name, pa.array(np.diff(np.concatenate([[0], np.cumsum(of[places] * weights)])[bounds]), pa.int64()))
    return out


def with_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` (stored rows of ``align``; other columns are kept) with ``n_best`` and ``count_sum`` in place of the pair columns."""
    block_pairs = aligned.filter("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("at", "p")).select(
        "block", "at", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").cast("long").alias("docs"))
    known = block_pairs.select("block", "at", "pair").join(store(pair_counts(block_pairs)), "pair").select(F.col("block").alias("of"), "at", "n_docs", "best")
    docs = aligned.drop("pairs", "pair_docs")
    kept = [f for f in docs.schema.fields if f.name not in ("block", "pair_at", "pair_n")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_best long", "count_sum long"])
    return docs.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_score_block, schema)

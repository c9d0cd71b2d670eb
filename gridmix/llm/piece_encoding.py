"""SentencePiece BPE encoding and decoding by vectorised merge rounds over flat numpy arrays.

*Words.*  A text gets the leading space that the model adds, and is cut before each space that
follows another character (no piece holds a space after another character, so no merge crosses
the cut; a model with such a piece has one word a text) and around line feeds.  A task's equal words are encoded once and
gathered back.  Inside a word, two characters that stand side by side in no piece part it again.

*Rounds.*  All words' symbols lie in one flat array.  Each round looks up the rank of every new
pair, takes the smallest rank of each word (a segmented minimum), and merges that word's pairs of this rank
together, leftmost first and without overlap.  A merge that opens a pair of the same or a better
rank would be followed by that pair, so in its word the merges to its right wait for
the next round.  Merged arrays are compacted, finished words leave; the rounds end when no word has a pair.  That is the
order of the library's queue (best score, then leftmost), whatever the model's scores.

Characters that are no piece become byte pieces.  Decoding gathers the pieces' bytes, drops the
space that encoding added, and replaces each byte that is no UTF-8 by U+FFFD, as the library does.

Tasks only map rows: nothing is shuffled, and a task holds ``SLICE_BYTES`` of text at a time, or
one longer text.  Defined cases: NULL and empty texts have no ids, a NULL list of ids decodes to
the empty text, NULL ids decode to nothing; very long texts are encoded whole; repeated rows are encoded each; an empty
table gives no rows; all other columns are kept, and one of the output's name is replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
SLICE_BYTES = 2 << 20
#: Symbols from here on are characters that are no piece: ``CHARS`` plus the code point.
CHARS = 1 << 30
NONE = np.iinfo(np.int32).max


class KeyTable:
    """A fixed map from non-negative integers to rows of integers, looked up by whole arrays (hashed, linear probing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros((1 << self.bits, values.shape[1]), np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = keys[free]  # of keys with one slot the last stays
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
        self.values[slot] = values

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each key's slot, and if the key is there."""
        slot = self._slot(keys)
        there = self.keys[slot]
        found = there == keys
        open_ = np.flatnonzero(~found & (there >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[open_]]
            found[open_] = hit = there == keys[open_]
            open_ = open_[~hit & (there >= 0)]
        return slot, found


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.int64) << 31 | right


class PieceModel:
    """The lookup tables of one BPE model; ``kinds``: ``normal``, ``byte``, ``control`` or ``unknown`` for each piece."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        mergeable = {p: i for i, (p, kind) in enumerate(zip(pieces, kinds, strict=True)) if kind == "normal"}
        self.words = not any(SPACE in p.lstrip(SPACE) for p in mergeable)
        self.symbol = np.arange(0x110000, dtype=np.int32) + CHARS
        for p, i in mergeable.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        ranks = np.unique(-np.asarray(scores, np.float32), return_inverse=True)[1]

        def of(part: str) -> int | None:
            return mergeable.get(part, CHARS + ord(part) if len(part) == 1 else None)

        merges, beside = {}, set()
        for p, i in mergeable.items():
            for k in range(1, len(p)):
                left, right = of(p[:k]), of(p[k:])
                if left is not None and right is not None:
                    merges[left << 31 | right] = (ranks[i], i)
                beside.add(of(p[k - 1]) << 31 | of(p[k]))
        self.lines = not any("\n" in p and len(p) > 1 for p in mergeable)
        self.merges = KeyTable(np.array(list(merges), np.int64), np.array(list(merges.values()), np.int32).reshape(-1, 2))
        self.beside = KeyTable(np.array(list(beside), np.int64), np.zeros((len(beside), 0), np.int32))
        self.byte_ids = np.zeros(256, np.int32)
        surface = []
        for i, (p, kind) in enumerate(zip(pieces, kinds, strict=True)):
            if kind == "byte":
                self.byte_ids[int(p[3:5], 16)] = i
                surface.append(bytes([int(p[3:5], 16)]))
            else:
                surface.append({"control": b"", "unknown": " ⁇ ".encode()}.get(kind, p.replace(SPACE, " ").encode()))
        self.surface = pa.array([*surface, b""], pa.large_binary())
        self.is_byte = np.array([*[k == "byte" for k in kinds], False])
        self.is_control = np.array([*[k == "control" for k in kinds], True])
        self.silent = len(pieces)  # stands for a NULL id
        self.opens = np.array([*[p.startswith(SPACE) and kind == "normal" for p, kind in zip(pieces, kinds, strict=True)], False])

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; rank ``NONE`` if it is no piece."""
        at, found = self.merges.find(_key(left, right))
        rank, merged = self.merges.values[at].T
        return np.where(found, rank, NONE), merged


@functools.lru_cache(maxsize=2)
def load(model: bytes) -> PieceModel:
    """The tables of a model file's content.  Its normaliser must only add the leading space."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    probe = " a\t  ﬁéé "
    if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("models that rewrite texts before encoding are not supported")
    ids = range(sp.vocab_size())
    if any(sp.is_unused(i) for i in ids) or not any(sp.is_byte(i) for i in ids):
        raise ValueError("models with unused pieces or without byte pieces are not supported")
    kinds = ["byte" if sp.is_byte(i) else "control" if sp.is_control(i) else "unknown" if sp.is_unknown(i) else "normal" for i in ids]
    return PieceModel([sp.id_to_piece(i) for i in ids], [sp.get_score(i) for i in ids], kinds)


def read_model(path: str) -> bytes:
    """A model file's content, read on the driver; tasks get it with their code (a vocabulary, not data)."""
    with open(path, "rb") as f:
        return f.read()


def _starts(groups: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))


def merge_rounds(model: PieceModel, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges until no pair is left: ``sym`` are all words' symbols, ``word`` their word numbers, ascending."""
    done_sym, done_word = [], []
    rank, into = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)
    new = np.ones(len(sym), bool)
    while len(sym):
        same = np.append(word[1:] == word[:-1], False)
        again = np.flatnonzero(same & (new | np.append(new[1:], False)))
        rank[again], into[again] = model.pairs(sym[again], sym[again + 1])
        rank[~same] = NONE
        starts = _starts(word)
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
        live = best != NONE
        if not live.all():
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            sym, word, rank, into, best = sym[live], word[live], rank[live], into[live], best[live]
            if not len(sym):
                break
        hit = rank == best
        first = hit & ~np.concatenate([[False], hit[:-1]])
        place = np.arange(len(sym))
        chosen = np.flatnonzero(hit & ((place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0))
        chosen = _until_one_opens(model, sym, word, into, best, chosen)
        sym[chosen] = into[chosen]
        keep = np.ones(len(sym), bool)
        keep[chosen + 1] = False
        new = np.zeros(len(sym), bool)
        new[chosen] = True
        sym, word, rank, into, new = sym[keep], word[keep], rank[keep], into[keep], new[keep]
    if not done_sym:
        return sym, word
    word = np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return np.concatenate(done_sym)[order], word[order]


def _until_one_opens(model: PieceModel, sym, word, into, best, chosen) -> np.ndarray:
    """Of each word's chosen merges, those up to the first that opens a pair no worse than itself."""
    merged, last = into[chosen], len(sym) - 1
    after = np.minimum(chosen + 2, last)
    opened = np.where((chosen + 2 <= last) & (word[after] == word[chosen]), model.pairs(merged, sym[after])[0], NONE)
    before = np.maximum(chosen - 1, 0)
    left = sym[before]
    touching = np.concatenate([[False], np.diff(chosen) == 2])  # the symbol before is the merge before
    left[touching] = merged[np.flatnonzero(touching) - 1]
    opened = np.minimum(opened, np.where((chosen > 0) & (word[before] == word[chosen]), model.pairs(left, merged)[0], NONE))
    opens = opened <= best[chosen]
    if not opens.any():
        return chosen
    earlier = np.cumsum(opens) - opens
    starts = _starts(word[chosen])
    return chosen[earlier == np.repeat(earlier[starts], np.diff(np.append(starts, len(chosen))))]


def _as_bytes(model: PieceModel, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters that are no piece as the byte pieces of their UTF-8 form."""
    plain = sym < CHARS
    if plain.all():
        return sym, word
    cp = np.where(plain, 0, sym - CHARS)
    n = np.where(plain, 1, 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF))
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    cp, size, ids = np.repeat(cp, n), np.repeat(n, n), np.repeat(sym, n)
    bits = cp >> 6 * (size - 1 - at)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size]
    byte = np.where(at == 0, lead | bits, 0x80 | bits & 0x3F)
    return np.where(ids < CHARS, ids, model.byte_ids[byte & 0xFF]), np.repeat(word, n)


def encode_words(model: PieceModel, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``ids, offsets`` of the words: UTF-8 with the space that the model adds, plain or as U+2581."""
    data = b"".join(words.to_pylist())
    cp = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    cp = np.where(cp == 32, ord(SPACE), cp)
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    firsts = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])  # characters before each byte
    word = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(np.concatenate([[0], firsts[ends]])))
    sym = model.symbol[cp]
    del data, cp, firsts
    cut = (word[1:] != word[:-1]) | ~model.beside.find(_key(sym[:-1], sym[1:]))[1]
    segment = np.concatenate([[0], np.cumsum(cut, dtype=np.int32)])[:len(sym)].astype(np.int32)
    of = word[_starts(segment)] if len(sym) else word
    sym, segment = _as_bytes(model, *merge_rounds(model, sym, segment))
    return sym.astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(of[segment], minlength=len(words)))])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``offsets, bytes`` of a text column without NULLs."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def cut_words(offsets: np.ndarray, data: np.ndarray, starts: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words between ``starts`` (positions, ascending), equal ones numbered alike, and each text's first word, the end last."""
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)])
    return words.dictionary_encode(), np.searchsorted(starts, offsets)


def gather(values: np.ndarray, offsets: np.ndarray, numbers: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the given numbers, end to end, with their offsets."""
    got = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values)).take(numbers)
    return got.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(offsets)[numbers.to_numpy()])]).astype(np.int64)


def encode_texts(model: PieceModel, texts: pa.Array) -> pa.ListArray:
    """The ids of each text, NULLs as empty ones."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    offsets, data = flat(texts)
    if not len(data):
        return pa.array([[]] * len(texts), pa.list_(pa.int32()))
    begins = (data == 32) & model.words
    begins[1:] &= data[:-1] != 32
    if model.words and model.lines:
        breaks = data == 10
        begins |= breaks
        begins[1:] |= breaks[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    words, of_text = cut_words(offsets, data, np.flatnonzero(begins))
    ids, ends = gather(*encode_words(model, words.dictionary), words.indices)
    return pa.ListArray.from_arrays(pa.array(ends[of_text], pa.int32()), pa.array(ids, pa.int32()))


def _bytes_as_text(run: bytes) -> str:
    """UTF-8 bytes as text, each byte that belongs to no character as U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at:at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        at += n
    return "".join(out)


def decode_ids(model: PieceModel, ids: pa.Array) -> pa.Array:
    """The text of each list of ids."""
    ids = ids.cast(pa.large_list(pa.int32()))
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    known = pc.fill_null(ids.flatten(), model.silent).to_numpy()
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    offsets, data = flat(model.surface.take(pa.array(known)))
    shown = np.append(np.flatnonzero(~model.is_control[known]), len(known))
    first = shown[np.searchsorted(shown, bounds[:-1])]  # each row's first visible piece
    strip = (first < bounds[1:]) & np.append(model.opens[known], False)[first]
    parted = np.zeros(len(ids), bool)  # byte pieces on both sides of a control piece are two runs
    parted[np.searchsorted(bounds, np.flatnonzero(model.is_control[known]), "right") - 1] = True
    raw, out = data.tobytes(), []
    for row, (a, b) in enumerate(zip((offsets[bounds[:-1]] + strip).tolist(), offsets[bounds[1:]].tolist(), strict=True)):
        try:
            if not parted[row]:
                out.append(raw[a:b].decode())
                continue
        except UnicodeDecodeError:  # byte pieces that are no UTF-8
            pass
        runs = []
        for k in range(bounds[row], bounds[row + 1]):
            piece = raw[offsets[k] + (strip[row] and k == first[row]):offsets[k + 1]]
            if k > bounds[row] and model.is_byte[known[k - 1:k + 1]].all():
                runs[-1] += piece
            else:
                runs.append(piece)
        out.append("".join(map(_bytes_as_text, runs)))
    return pa.array(out, pa.string())


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in pieces whose ``column`` has at most ``limit`` bytes, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, "right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


def encode(docs: DataFrame, model: bytes, text_col: str = "text", out: str = "ids", *, decoded: str | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the ids of ``text_col`` appended as ``array<int>``; with ``decoded``, also the text they decode to.

    ``keep`` names the columns to keep, all others by default.
    """
    new = [n.lower() for n in (out, decoded) if n]
    rows = docs.withColumn(text_col, F.col(text_col).cast("string"))
    kept = [f for f in rows.schema.fields if f.name.lower() not in new and (keep is None or f.name in keep)]
    added = [T.StructField(out, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = load(model)
        for whole in batches:
            for batch in slices(whole, text_col):
                ids = encode_texts(tables, batch[text_col])
                yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], ids, *([decode_ids(tables, ids)] if decoded else [])],
                                                 names=[*names, out, *([decoded] if decoded else [])])

    return rows.mapInArrow(run, T.StructType([*kept, *added]))


def decode(rows: DataFrame, model: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids in ``ids_col`` appended."""
    kept = [f for f in rows.schema.fields if f.name.lower() != out.lower()]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = load(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([*[part[c] for c in names], decode_ids(tables, part[ids_col])], names=[*names, out])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.StringType())]))

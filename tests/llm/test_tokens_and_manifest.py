"""Encoding against the library, alignment and hash trees against plain Python."""

from __future__ import annotations

import heapq
import random
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmix.llm import merkle_manifest as mm
from gridmix.llm import piece_encoding as pe
from gridmix.llm import token_alignment as ta
from gridmix.llm.queries import tokenizer_path

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")
PIECES = ["a", "b", " ", "  ", "\n", "\t", "é", "🙂", "漢字", "ß", "0", "12", "'s", "the", " the", "ing", "́", "\x00", "\x1c", " ", "　",
          " ", "\u0085", "᠎", "<s>", "<0x0A>", "<|endoftext|>", "aaaa", "-----", "à ", "�", "⁇", "\n\n", ".\nAn"]
TEXT = st.lists(st.sampled_from([*PIECES, "▁"]) | st.text(max_size=3), max_size=40).map("".join)
LONG = "ab the\n" * 20_000 + "x" * 5_000


@pytest.fixture(scope="module")
def model():
    return pe.read_model(tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXT, max_size=5))
def test_ids_are_the_librarys(model, library, texts):
    ids = pe.encode_texts(pe.load(model), pa.array(texts, pa.string()))
    assert ids.to_pylist() == [library.encode(t) for t in texts]
    assert pe.decode_ids(pe.load(model), ids).to_pylist() == [library.decode(library.encode(t)) for t in texts]


@settings(max_examples=300, deadline=None)
@given(rows=st.lists(st.lists(st.integers(0, 300) | st.integers(0, 31_999) | st.sampled_from([0, 1, 2, 28705, 264]), max_size=12), max_size=4))
def test_any_ids_decode_as_in_the_library(model, library, rows):
    assert pe.decode_ids(pe.load(model), pa.array(rows, pa.list_(pa.int32()))).to_pylist() == [library.decode(r) for r in rows]


def queue_encode(pieces, scores, text):
    """The library's order: best score first, then leftmost."""
    known = dict(zip(pieces, scores, strict=True))
    sym, heap, nxt, prev = list(text), [], list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))

    def push(i, j):
        if 0 <= i < j < len(sym) and sym[i] + sym[j] in known:
            heapq.heappush(heap, (-known[sym[i] + sym[j]], i, j, sym[i] + sym[j]))

    for i in range(len(sym) - 1):
        push(i, i + 1)
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if sym[i] and sym[j] and nxt[i] == j and sym[i] + sym[j] == whole:
            sym[i], sym[j], nxt[i] = whole, "", nxt[j]
            if nxt[j] < len(sym):
                prev[nxt[j]] = i
            push(prev[i], i)
            push(i, nxt[i])
    return [s for s in sym if s]


@settings(max_examples=400, deadline=None)
@given(text=st.text("abc", min_size=1, max_size=40), more=st.lists(st.text("abc", min_size=2, max_size=5), unique=True, max_size=12), data=st.data())
def test_merge_order_with_any_scores(text, more, data):
    """Also where a merge opens a better pair, or scores tie."""
    pieces = ["a", "b", "c", *more]
    scores = [0.0] * 3 + [float(data.draw(st.integers(-6, 0))) for _ in more]
    model = pe.PieceModel(pieces, scores, ["normal"] * len(pieces))
    ids, _ = pe.encode_words(model, pa.array([text.encode()], pa.large_binary()))
    assert [pieces[i] for i in ids] == queue_encode(pieces, scores, text)


def test_encoding_rows(documents, model, library):
    rows = [(1, "a  b"), (1, "other"), (2, None), (3, ""), (None, "▁x"), (4, LONG), (4, LONG)]
    got = pe.decode(pe.encode(documents(rows), model, out="source"), model, ids_col="source", out="K")
    assert got.columns == ["doc_id", "text", "lang", "n_chars", "h", "line", "id", "source", "K"]
    want = sorted((str(i), t or "", library.encode(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), r.text or "", r.source) for r in got.collect()) == want
    assert {r.text or "": r.K for r in got.collect()} == {t or "": library.decode(library.encode(t or "")) for _, t in rows}
    assert pe.encode(documents([]), model).collect() == []


def whole_file(path):
    """The library that the file is made for, as an independent encoder."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_both_byte_level_libraries_agree():
    path = tokenizer_path("byte_bpe_50k.json")
    encode, _ = ta.load_bytes(ta.read_tokenizer(path))
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)} b{chr(c)}. {chr(c)} " for c in [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F000, 0x1FB00)]]
    assert encode(texts) == [e.ids for e in whole_file(path).encode_batch_fast(texts, add_special_tokens=False)]


def plain_alignment(tokenizer, a_surface, pieces, library, text):
    """``(A ids, B ids)`` of each group."""
    if not text:
        return []
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, library.encode(text)
    a_bytes, b_bytes = [a_surface[i].as_py() for i in a], [pieces.surface[i].as_py() for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return []
    a_ends, b_ends = (list(accumulate(map(len, x))) for x in (a_bytes, b_bytes))
    groups, start = [], 0
    for end in sorted(set(a_ends) & set(b_ends)):
        groups.append(tuple([i for i, e in zip(ids, ends, strict=True) if start < e <= end] for ids, ends in ((a, a_ends), (b, b_ends))))
        start = end
    return groups


def plain_rows(texts, align):
    """``(n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` of each text."""
    groups = [align(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    docs = Counter(p for x in links for p in x)
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    return [(sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(x.values()), sum(n for p, n in x.items() if docs[p] == best[p[0]]),
             sum(n * docs[p] for p, n in x.items()), ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g))
            for g, x in zip(groups, links, strict=True)]


def test_alignment_of_odd_texts_and_corpus_counts(documents, model, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(30))) for _ in range(400)]
    texts += [None, "", "a▁b", "the " * 3000, "a" * 400, " " * 90, "漢字🙂" * 30, "the the", "the the"]
    a_model = ta.read_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    tokenizer, (_, surface), pieces = whole_file(tokenizer_path("byte_bpe_50k.json")), ta.load_bytes(a_model), pe.load(model)
    docs = documents([(k if k % 50 else None, t) for k, t in enumerate(texts)]).repartition(5)
    got = ta.with_counts(ta.store(ta.align(docs, a_model, model)))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    want = plain_rows(texts, lambda t: plain_alignment(tokenizer, surface, pieces, library, t))
    key = lambda row: tuple(map(str, row))
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got.collect()), key=key) == sorted(
        ((k if k % 50 else None, *w) for k, w in enumerate(want)), key=key)
    assert ta.with_counts(ta.store(ta.align(documents([]), a_model, model))).collect() == []


def test_intervals_coalesce_where_ends_meet():
    a, b = ta.coalesce(np.array([0, 3, 5]), np.array([3, 5, 9]), np.array([0, 1, 5, 7]), np.array([1, 5, 7, 9]))
    assert a.tolist() == [0, 0, 1] and b.tolist() == [0, 0, 1, 1]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """The root, and each leaf's siblings from left to right and step by step."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            proofs[k].append((nodes[i - 1], None) if i % 2 else (None, nodes[i + 1] if i + 1 < len(nodes) else None))
        nodes, at = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return (nodes or [None])[0], proofs


@pytest.mark.parametrize("height", range(8))
def test_van_emde_boas_addresses(height):
    every = np.concatenate([mm.addresses(height, d) for d in range(height + 1)])
    assert sorted(every.tolist()) == list(range((2 << height) - 1)) and every[0] == 0
    if height == 3:  # the root's two levels, then four subtrees of two levels
        assert [mm.addresses(3, d).tolist() for d in range(4)] == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]


@pytest.mark.parametrize("height", [1, 2, 3, 12])
def test_manifest(spark, height):
    rng = random.Random(height)
    sizes = {None: 1, "": 2, "é": 9, "a": 37, "b": 5, "zz": 64, "|": 65}
    rows = [(rng.choice([None, *range(200)]) if k else 7, lang, h(str(rng.random()))) for lang, n in sizes.items() for k in range(n)]
    rows += rows[-3:]
    df = spark.createDataFrame(rows, "doc_id int, lang string, leaf string").repartition(4)
    out = mm.manifest(df, F.col("lang"), ["doc_id"], "leaf", height)
    trees = {lang: sorted(((d is not None, d or 0, x) for d, y, x in rows if y == lang)) for lang in sizes}
    order = sorted(sizes, key=lambda x: (x is not None, (x or "").encode()))
    built = {lang: plain_tree([x for *_, x in trees[lang]]) for lang in order}
    root, above = plain_tree([built[lang][0] for lang in order])
    want = sorted(str((t[1] if t[0] else None, t[2], built[lang][0], root, built[lang][1][k] + above[order.index(lang)]))
                  for lang in order for k, t in enumerate(trees[lang]))
    got = out.rows.withColumn("folded", mm.fold("leaf", "proof")).collect()
    assert sorted(str((r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.proof])) for r in got) == want
    assert all(r.folded == root for r in got)
    other = out.rows.select(mm.fold(F.sha2(F.lit("other"), 256), "proof").alias("f")).filter(F.col("f") == root).count()
    assert other == 0


def test_manifest_of_nothing_one_and_fields(spark):
    empty = spark.createDataFrame([], "doc_id int, lang string, leaf string")
    assert mm.manifest(empty, F.col("lang"), ["doc_id"], "leaf").rows.collect() == []
    one = spark.createDataFrame([(1, "x", h("l"))], "doc_id int, lang string, leaf string")
    row = mm.manifest(one, F.col("lang"), ["doc_id"], "leaf").rows.first()
    assert (row.subroot, row.root, row.proof) == (h("l"), h("l"), [])
    df = spark.createDataFrame([(12, None, "é", "")], "a int, b string, c string, d string")
    assert df.select(mm.field_digest("a", "b", "c", "d")).first()[0] == h("2:12-2:é0:")

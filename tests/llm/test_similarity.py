"""N-gram Jaccard join, line de-duplication, decontamination and repeated passages against brute force."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmix.llm import decontamination, line_dedup, ngram_join, suffix_dedup
from gridmix.llm.common import connected_components
from tests.llm import brute

RNG = random.Random(7)
VOCABULARY = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 9))) for _ in range(400)]


def prose(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def edited(words, edits, rng=RNG):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = rng.choice(VOCABULARY) + "x"
    return out


def corpus(seed):
    """Copies, near copies in steps, shared passages, short, blank and long texts, ties."""
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "one", "one", "One two", "one two three four", "a b c d e", "a b c d e", "abé É x y z w"]
    for n in (30, 60, 150, 700):
        base = prose(n, rng)
        texts += [" ".join(base), " ".join(base), "\n".join(base)]
        texts += [" ".join(edited(base, e, rng)) for e in (1, 1, 2, 3, n // 40, n // 25, n // 10)]
        texts += [" ".join(base[: n * 9 // 10]), " ".join(base + prose(n // 8, rng))]
    passage = prose(55, rng)
    texts += [" ".join(prose(rng.randint(0, 90), rng) + passage + prose(rng.randint(0, 90), rng)) for _ in range(12)]
    texts += [" ".join(passage), " ".join(passage[:50]), " ".join(passage[:49]), " ".join(passage + passage)]
    texts += [" ".join(prose(8000, rng))] * 2
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "blocks"), [(1, 2000), (2, 3)])
def test_jaccard_components(documents, seed, blocks):
    rows = corpus(seed)
    got = ngram_join.jaccard_components(documents(rows), block_sets=blocks).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard_components(rows)


def test_jaccard_edge_rows(documents):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (3, "A B C D E F"), (9, None), (9, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(documents(rows)).collect()), key=str)
    assert got == [(3, 2, 3), (5, 2, 3), (5, 2, 3), (9, 0, 9), (9, 0, 9), (None, 2, None)]
    assert ngram_join.jaccard_components(documents([])).collect() == []
    assert sorted(map(str, (r.doc_id for r in ngram_join.keep_one(documents(rows)).collect()))) == ["3", "9", "9", "None"]


def test_jaccard_links_of_every_text_of_a_repeated_id(documents):
    words = prose(140)
    chain = [" ".join(words[k:k + 100]) for k in (0, 8, 16, 24)]  # each links to the next only
    got = ngram_join.jaccard_components(documents(list(zip((1, 2, 1, 3), chain, strict=True)))).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1), min_size=2, max_size=14), st.booleans())
def test_prefix_tree_finds_the_components(sets, two):
    import numpy as np

    arrays = [np.array(sorted(s), np.int64) for s in sets]
    sides = [i % 2 * two for i in range(len(sets))]
    linked = lambda i, j: (sides[i] != sides[j] or not two) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    links = {frozenset(p) for p in ngram_join.join_sets(arrays, sides)}
    assert all(linked(*p) for p in links)
    assert brute.components(len(sets), lambda i, j: {i, j} in links) == brute.components(len(sets), linked)


def lines_corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(prose(rng.randint(3, 60), rng)) for _ in range(40)]
    texts = [None, "", "\n\n", " \n\tx\n", "https://example.org/" + "a" * 60 + "1", "https://example.org/" + "a" * 60 + "2" * 30,
             "漢字" * 30, "字" + "漢字" * 30, "All rights reserved.", "All rights reserved. ", "x" * 20_000]
    for _ in range(40):
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(pool).split()
            lines.append("  " * rng.randint(0, 1) + " ".join(edited(words, 1, rng) if rng.random() < 0.4 and len(words) > 25 else words))
        texts.append("\n".join(lines))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(documents, seed):
    rows = lines_corpus(seed)
    got = line_dedup.dedup_lines(documents(rows)).collect()
    want = brute.dedup_lines(rows)
    differing = [r.doc_id for r in got if (r.text, r.n_lines, r.n_dropped) != want[r.doc_id]]
    assert len(got) == len(rows) and len(differing) <= 1  # bands miss a pair of similarity 0.8 with probability 0.002


def stays(lines):
    """The lines of one text that stay, by sets of all 12-character runs (written out here, not the operator's pattern)."""
    sets = [{x[i:i + 12] for i in range(max(1, len(x) - 11))} for x in lines]
    groups = brute.components(len(lines), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    return [x for i, x in enumerate(lines) if groups[i] == i]


def test_line_dedup_compares_template_lines_with_many_unlike_neighbours(documents):
    rng = random.Random(11)
    start, lines = " ".join(prose(42, rng)), []
    for i in range(180):
        tail = prose(18, rng)
        lines.append(f"{start} {' '.join(tail)}")
        if i % 3:
            lines.append(f"{start} {' '.join(edited(tail, 1, rng))}")
    got = line_dedup.dedup_lines(documents([(1, "\n".join(lines))])).first()
    assert got.text.split("\n") == stays(lines) and got.n_dropped == 120


def test_line_dedup_judges_by_all_runs_of_characters(documents):
    rng, lines = random.Random(12), []
    for _ in range(150):
        words = prose(rng.randint(20, 45), rng)
        lines += [" ".join(words), " ".join(edited(words, rng.randint(1, 2), rng))]
    got = line_dedup.dedup_lines(documents([(1, "\n".join(lines))])).first()
    assert got.text.split("\n") == stays(lines)


def alike_of(spark, lines, buckets):
    """Components of ``lines`` in the given buckets, as lists of line numbers."""
    rows = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    keyed = line_dedup._with_keys(rows).drop("k2")
    numbers = {r.k1: r.n for r in keyed.collect()}
    bands = spark.createDataFrame([(n, b) for n, b in enumerate(buckets)], "n int, bands array<long>")
    got = line_dedup.alike_components(rows, keyed.join(bands, "n").select("k1", "bands"), 0.8).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.component, []).append(numbers[r.k1])
    return sorted(sorted(g) for g in groups.values())


def test_lines_of_one_bucket_are_all_compared(spark):
    rng = random.Random(5)
    lines, want = [], []
    for _ in range(30):  # alike pairs, and chains whose ends are not alike, that are unlike all other lines
        words = prose(40, rng)
        chain = [" ".join(words[k:k + 30]) for k in (0, 3, 6, 9)][:rng.choice((2, 4))]
        lines += chain
        groups = brute.components(len(chain), lambda i, j, c=chain: stays([c[i], c[j]]) == c[:0] + [c[i]])
        for g in set(groups):
            members = [len(lines) - len(chain) + i for i, x in enumerate(groups) if x == g]
            want += [members] if len(members) > 1 else []
    assert len(want) > 20
    assert alike_of(spark, lines, [[1]] * len(lines)) == sorted(want)


def test_one_unlike_line_of_a_bucket_is_compared_with_all(spark):
    words = prose(40, random.Random(6))
    chain = [" ".join(words[k:k + 30]) for k in (0, 2, 4, 6, 8, 10)]
    assert alike_of(spark, chain, [[1]] * 6) == [[0, 1, 2, 3, 4, 5]]


def test_near_copies_of_one_bucket_meet_in_few_pairs(spark, monkeypatch):
    rng, met, judge = random.Random(8), [], line_dedup._alike
    words = prose(60, rng)
    lines = sorted({" ".join(edited(words, rng.randint(1, 8), rng)) for _ in range(160)})

    def counted(pairs, texts, threshold):
        met.append(pairs.count())
        return judge(pairs, texts, threshold)

    monkeypatch.setattr(line_dedup, "_alike", counted)
    sets = [{x[i:i + 12] for i in range(len(x) - 11)} for x in lines]
    groups = {}
    for i, x in enumerate(brute.components(len(lines), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))):
        groups.setdefault(x, []).append(i)
    assert alike_of(spark, lines, [[1]] * len(lines)) == sorted(g for g in groups.values() if len(g) > 1)
    assert sum(met) < 8 * len(lines), met


def test_bands_of_lines_are_shuffled_once(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(line_dedup, "store", lambda df: stored.append(df) or df)
    rows = [(n, [1, n, n // 2 + 1000]) for n in range(400)] + [(7, [1, 7, 1003])] * 3
    near = line_dedup._compared(spark.createDataFrame(rows, "k1 long, bands array<long>").selectExpr("k1", "explode(bands) as key"))
    got = {(r.key, r.k1, r.pivot, r.others) for r in near.collect()}
    want = {(1, n, 0, 399) for n in range(1, 400)} | {(n // 2 + 1000, n, n - 1, 1) for n in range(1, 400, 2)}
    assert got == want and len(stored) == 1
    final = stored[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"\+- Exchange hashpartitioning", final)) == 1 and "ReusedExchange" in final, final


def test_full_sets_are_all_runs_of_characters(spark):
    rng = random.Random(13)
    lines = ["a", "x" * 11, "x" * 12, "ab" * 20, "漢字" * 9, "é😀" * 13] + ["".join(rng.choice("ab é😀字") for _ in range(n)) for n in range(10, 60)]
    runs = [(n, x[i:i + 12]) for n, x in enumerate(lines) for i in range(max(1, len(x) - 11))]
    got = spark.createDataFrame(list(enumerate(lines)), "n int, line string").select("n", line_dedup.run_hashes("line").alias("runs")).collect()
    want = {n: set() for n in range(len(lines))}
    for r in spark.createDataFrame(runs, "n int, run string").selectExpr("n", "xxhash64(run) as h").collect():
        want[r.n].add(r.h)
    assert {r.n: set(r.runs) for r in got} == want


def test_lines_are_judged_by_runs_found_by_place(spark, monkeypatch):
    rng = random.Random(14)
    lines = ["", "a", "x" * 11, "x" * 12, "ab" * 20, "漢字" * 9, "é😀" * 13] + ["".join(rng.choice("ab é😀字") for _ in range(n)) for n in range(10, 60)]
    pairs = [(x, y[:k] + "é" + y[k:]) for x in lines for y in (x, lines[20]) for k in (0, 5, 30)] + [(x, x) for x in lines]
    rows = spark.createDataFrame([(i, *xy) for i, xy in enumerate(pairs)], "i int, x string, y string")
    hashed = rows.select("i", *[line_dedup.coded_run_hashes(c).alias(c) for c in "xy"])
    got = {r.i: (r.n, r.m, r.both) for r in hashed.selectExpr(
        "i", "size(array_distinct(x)) as n", "size(array_distinct(y)) as m", "size(array_intersect(x, y)) as both").collect()}
    sets = [[{t[k:k + 12] for k in range(max(1, len(t) - 11))} for t in xy] for xy in pairs]
    assert got == {i: (len(x), len(y), len(x & y)) for i, (x, y) in enumerate(sets)}
    # pairs of lines are judged by these, without patterns
    monkeypatch.setattr(line_dedup, "run_hashes", None)
    texts = spark.createDataFrame([(1, "x" * 30), (2, "x" * 31), (3, "another line")], "k1 long, line string")
    found = line_dedup._alike(spark.createDataFrame([(2, 1), (3, 1)], "a long, b long"), texts, 0.8).collect()
    assert [tuple(r) for r in found] == [(2, 1)]


def test_outer_white_space_of_lines(spark):
    lines = [a + x + b for x in ("", "q", "p q", "é\u2003字") for a in ("", " ", "\t \x0b", "\u2003", "\x1f") for b in ("", "\r", " \f", "\xa0", "\x00")]
    df = spark.createDataFrame(list(enumerate([*lines, None])), "i int, line string").select("i", "line", line_dedup._trimmed("line").alias("t"))
    assert [(r.line, r.t) for r in df.orderBy("i").collect()] == [(x, x.strip(brute.BLANKS)) for x in lines] + [(None, None)]
    plan = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    out = line_dedup.occurrences(plan, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in out or "if " in out, out  # most lines are not trimmed


def test_runs_from_word_starts(spark):
    rng = random.Random(15)
    lines = ["", "one", "a b c d e f g h", "x" * 10 + " y", "x" * 11 + " y", "x" * 30, "漢字" * 12 + " 字"]
    lines += ["".join(rng.choice("abcde é😀字 \t\x0b\x0c\x85\u2003\xa0\x1c") for _ in range(rng.randrange(80))) for _ in range(200)]
    runs = set()
    for n, x in enumerate(lines):
        for word in re.finditer(r"[^\x20\x09-\x0D]+", x):
            runs |= {(n, x[at:at + 12]) for at in range(word.start(), max(word.start(), word.end() - 10) + 1)}
    want = {n: set() for n in range(len(lines))}
    for r in spark.createDataFrame(sorted(runs), "n int, run string").selectExpr("n", "xxhash64(run) as h").collect():
        want[r.n].add(r.h)
    got = spark.createDataFrame(list(enumerate(lines)), "n int, line string").select("n", line_dedup.shingle_hashes("line").alias("s")).collect()
    assert {r.n: r.s for r in got} == {n: sorted(x) for n, x in want.items()}


def test_union_find_of_few_edges_takes_few_tasks(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 10], "a long, b long")
    changed = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    sc = spark.sparkContext
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few edges", "")
        got = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - (i - 1) % 10 for i in range(1, 41)} | {40: 31}
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few edges") for s in tracker.getJobInfo(j).stageIds}
    tasks = [i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i]
    assert tasks and sum(n >= 60 for n in tasks) <= 12, tasks  # 52 with rounds in full width


def test_line_dedup_edge_rows(documents):
    rows = [(1, "a b\nc d"), (1, "a b\nc d"), (None, "a b\nnew"), (2, "c d\n\nown"), (3, "a b"), (4, None), (5, "")]
    docs = documents(rows)
    got = sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs).fillna("-", ["text"]).collect())
    assert got == [("1", "a b\nc d", 2, 0), ("1", "a b\nc d", 2, 0), ("2", "\nown", 2, 1), ("3", "", 1, 1), ("4", "-", 0, 0), ("5", "", 0, 0), ("None", "new", 2, 1)]
    kept = line_dedup.keep_lines(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "4", "5", "None"]
    assert line_dedup.dedup_lines(documents([])).collect() == []


def test_contained_items(documents, spark):
    rng = random.Random(3)
    items = [(k, " ".join(prose(n, rng))) for k, n in enumerate((5, 6, 9, 16, 17, 33, 40, 64, 120))] + [(20, None), (21, ""), (22, "one two"), (None, " ".join(prose(30, rng)))]
    rows = [(i, t) for i, t in corpus(4)]
    for k, text in items:
        for e in range(4 if text and len(text.split()) > 4 else 1):
            around = prose(rng.choice((0, 5, 3000)), rng)
            rows.append((len(rows), " ".join(around + (edited(text.split(), e, rng) if text else []) + around).upper()))
    rows += [(9999, "one two"), (9998, "one two three"), (None, items[4][1])]
    table = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, h int")
    got = decontamination.contained_items(documents(rows), table).collect()
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == brute.contained(rows, items)
    assert len(got) > 10
    left = decontamination.decontaminate(documents(rows), table)
    held = {k[0] for k in brute.contained(rows, items)}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in held)
    assert decontamination.contained_items(documents([]), table).collect() == []
    assert decontamination.decontaminate(documents(rows), table.limit(0)).count() == len(rows)


@pytest.mark.parametrize(("seed", "min_words", "window"), [(5, 50, 16), (6, 12, 5)])
def test_repeated_passages(documents, seed, min_words, window):
    rows = corpus(seed)
    got = suffix_dedup.repeated_passages(documents(rows), min_words=min_words, window=window).collect()
    every, removable = brute.repeated_words(rows, min_words)
    place = {i: [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")] for i, t in rows}
    found, gone = {i: set() for i, _ in rows}, {i: set() for i, _ in rows}
    for r in got:
        words = {k for k, (a, b) in enumerate(place[r.doc_id]) if a >= r.start and b <= r.end}
        assert len(words) == r.n_words >= min_words and r.first_id <= r.doc_id
        found[r.doc_id] |= words
        if r.removable:
            gone[r.doc_id] |= words
    assert found == {i: every[i] for i, _ in rows}
    assert gone == {i: removable[i] for i, _ in rows}


def test_items_of_few_words_inside_long_texts(documents, spark):
    rows = [(1, "so the CAPITAL of France Paris is"), (2, "capital of france"), (3, "of"), (4, " ".join(prose(3000) + ["of", "france"])), (5, None)]
    items = spark.createDataFrame([(1, "capital of france paris"), (2, "of France"), (3, "of")], "item_id long, text string")
    got = decontamination.contained_items(documents(rows), items).collect()
    assert sorted((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got) == [
        (1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1), (2, 2, 1, 1), (2, 3, 1, 1), (3, 3, 1, 1), (4, 2, 1, 1), (4, 3, 1, 1)]


def test_repeated_passages_of_every_text_of_a_repeated_id(documents):
    base, q, other, z = (" ".join(prose(n)) for n in (60, 9, 60, 7))
    rows = [(1, base), (1, other), (2, f"{q} {base} {z}"), (3, f"{q} {other} {z}")]
    spans = {(r.doc_id, r.n_words, r.removable) for r in suffix_dedup.repeated_passages(documents(rows)).collect()}
    assert {(2, 60, True), (3, 60, True)} <= spans and {s for s in spans if s[0] == 1} == {(1, 60, False)}


def test_repeated_passages_edge_rows(documents):
    text = " ".join(prose(60))
    rows = [(1, text), (1, text), (None, text), (2, None), (3, " " + text + " "), (4, "")]
    got = sorted((r.doc_id, r.start, r.end, r.removable, r.first_id) for r in suffix_dedup.repeated_passages(documents(rows)).collect())
    assert [g for g in got if g[0] == 3] == [(3, 1, len(text) + 1, True, 1)]
    assert {g[0] for g in got} == {1, 3}
    assert suffix_dedup.repeated_passages(documents([])).collect() == []


def test_connected_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)

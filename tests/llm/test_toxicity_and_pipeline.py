"""Toxicity by held-out accuracy on a planted table; the pipeline against plain versions of its stages."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from gridmix.llm import toxicity
from gridmix.llm.queries import QUERIES, held_out
from tests.conftest import SF_SMALL
from tests.llm import brute


def planted(n=1200, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(500)]
    insults = ["grobnik", "zwerfel", "IDIOT", "stupid", "klumpf"]
    rows, labels = [], []
    for i in range(n):
        text, bad = [rng.choice(words) for _ in range(rng.randint(20, 200))], i % 10 == 3
        for _ in range(rng.randint(2, 5) * bad):
            text[rng.randrange(len(text))] = rng.choice(insults) + rng.choice(["", "ak", "en", "ossa", "!"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_on_a_planted_table(spark, documents):
    rows, labels = planted()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    edge = [(5000, None), (5001, ""), (None, "you stupid idiot, moron"), (5002, "word " * 50_000), (0, rows[0][1])]
    scores = toxicity.score(documents(rows + edge), table, train=~held_out()).collect()
    assert len(scores) == len(rows) + len(edge) and all(0 <= r.score <= 1 for r in scores)
    by = {r.doc_id: r.score for r in scores}
    held = [(i, toxic) for i, _, toxic in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((by[i] >= 0.7) == bool(toxic) for i, toxic in held)
    assert right >= 0.98 * len(held)
    assert by[5000] < 0.3 and by[5001] < 0.3 and by[5002] < 0.3 and by[None] >= 0.7


def test_the_classifier_beats_the_label_model_on_held_out_rows(spark):
    """Nine in ten toxic rows caught, fewer than one clean row in a hundred, and better than the posterior labels it was trained on."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet").repartition(8), labels, train=~held_out())
    held = scores.join(labels.filter(held_out()), "doc_id").select("posterior", "score", "toxic").toPandas()
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert (toxic.score >= 0.7).mean() >= 0.9 and (clean.score >= 0.7).mean() < 0.01
    assert ((held.score - held.toxic) ** 2).mean() < ((held.posterior - held.toxic) ** 2).mean()
    assert (clean.score >= 0.7).sum() < (clean.posterior >= 0.7).sum()


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    rows, labels = planted(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    docs = documents(rows)
    one, two = ({r.doc_id: r.score for r in toxicity.score(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"), train=~held_out()).collect()}
                for x in (labels, flipped))
    assert one == pytest.approx(two)


def test_without_labels_and_without_rows(spark, documents):
    none = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(documents([(1, "a stupid idiot"), (2, "a b")]), none).collect()}
    assert got[1] > got[2]
    assert toxicity.score(documents([]), none).collect() == []
    assert toxicity.drop_toxic(documents([(1, "a"), (2, None)]), none).count() == 2


def test_pipeline_stages_against_plain_versions(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    before = None
    for name, stage in corpus_pipeline.STAGES:
        rows = before if before is not None else [tuple(r) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, SF_SMALL)
        if name == "mixing sources":
            sizes = {i: len((t or "").encode().split()) for i, t in rows}
            got = out.collect()
            assert {r.doc_id: r["size"] for r in got} == sizes and all(r.taken <= 2 * r["size"] for r in got)
            taken, goal = defaultdict(int), {}
            source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
            for r in got:
                taken[source[r.doc_id]] += r.taken
                goal[source[r.doc_id]] = r.target
            assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
            break
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        if name == "toxicity":
            scores = {r.doc_id: r.predicted for r in QUERIES["op1_toxicity"](spark, SF_SMALL).collect()}
            want = [(i, t) for i, t in rows if not scores[i]]
        elif name == "line dedup":
            plain = brute.dedup_lines(rows)
            want = [(i, plain[i][0]) for i, _ in rows if not plain[i][2] or plain[i][2] < plain[i][1]]
        elif name == "n-gram Jaccard join":
            plain = brute.jaccard_components(rows)
            want = [(i, t) for i, t in rows if plain[i][1] == i]
        else:
            held = {k[0] for k in brute.contained(rows, items)}
            want = [(i, t) for i, t in rows if i not in held]
        assert sorted(before) == sorted(want)

"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. *Voters.*  A voter fires or abstains on a text.  Lexicon voters are words, word
   beginnings (4 to 8 bytes, for inflected forms), and beginnings that one word in 100 has: a fixed seed list, and terms induced
   from labelled rows.  Pattern voters look at the form of the text (shouting,
   exclamation marks, masked words, address followed by an insult, no lexicon word at all).
2. *Label model.*  All documents are voted on and the vote patterns counted.  A
   two-class generative model is fitted to these counts by expectation
   maximisation: each voter has a rate of firing on toxic and on other texts
   (its accuracy), started from and steadied by its rates on the labelled rows.  The
   correlation of every two voters inside a class is estimated from the model's
   second moments, and correlated voters share their weight.
3. *Classifier.*  A linear model on the text itself (the share of the text's words that start with each
   beginning of ``FEATURE_BYTES`` bytes, hashed into ``2 ** FEATURE_BITS`` buckets, and the votes) is trained by logistic regression on the posterior labels of
   all documents, so it also learns what stands beside the voters' words, and how much of a text they are.
4. *Calibration.*  Its log-odds are fitted to the labelled training rows by two numbers (Platt scaling).

Labels are read for training rows only, and of those at most ``sample`` rows (by
a hash of the id) induce terms and starting rates and calibrate: a documented bound on what the driver
collects.  Terms are counted and tested in Spark; of those that pass, the ``max_voters`` that most toxic rows hold become voters.
The votes, counts, moments, features and training sums cover all documents; what comes to the driver
are sums of the size of (voters x voters) or of the buckets, whatever the input's size.  Labels, language,
source and id are never inputs of a score.

Defined cases: NULL and empty texts fire no voter, have no features and get the score of
silence; very long texts are read whole; NULL ids or labels train nothing; rows that repeat an id are scored
each; without labels the seed list and default rates remain; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import store, text_or_empty
from gridmix.operators.joins import checked_broadcast, freeze

#: Fixed seed list: English insults.
SEEDS = "idiot idiots moron morons stupid loser losers pathetic disgusting worthless scum trash clown dumb imbecile vermin filth".split()
PATTERNS = ("shouting", "exclaiming", "masked word", "address and insult", "several lexicon words", "one word in 100", "no lexicon voter fires")
MASKED = re.compile(rb"\b[a-z]+[*#@$%]{2,}[a-z]*\b")
#: ASCII punctuation and controls to spaces; other bytes stay.
PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
BEGINNINGS = (4, 5, 6, 7, 8)
MAX_VOTERS = 256
FEATURE_BYTES, FEATURE_BITS = 5, 16
MERGING_TASKS = 16
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def _words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(PLAIN).split()


def _terms(words: list[bytes]) -> set[bytes]:
    """What a lexicon voter can be: words, beginnings (``abcd-``), and beginnings of two words or more that are one in 100 (``abcd-%``)."""
    counts = Counter(words)
    out, begin = set(counts), Counter()
    for n in BEGINNINGS:
        for w, c in counts.items():
            if len(w) > n:
                begin[w[:n]] += c
    out.update(b + b"-" for b in begin)
    out.update(b + b"-%" for b, c in begin.items() if c > 1 and 100 * c >= len(words))
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a label to rows of ``term, toxic, clean`` counts, one set per batch."""
    for batch in batches:
        counts: dict[bytes, list[int]] = {}
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            for t in _terms(_words(text.as_py())):
                counts.setdefault(t, [0, 0])[1 - toxic.as_py()] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array([c[0] for c in counts.values()], pa.int64()),
                                          pa.array([c[1] for c in counts.values()], pa.int64())], names=["term", "toxic", "clean"])


def induce(labelled: DataFrame, max_voters: int = MAX_VOTERS) -> tuple[list[bytes], dict[bytes, tuple[int, int]], tuple[int, int]]:
    """Lexicon terms from labelled rows (``text, toxic``): the seeds, then the most telling terms.

    A term qualifies if nearly all rows that hold it are toxic and that is
    no accident (at the base rate, fewer than 0.1 of all terms looked at would have so
    many toxic rows among theirs).  A term that begins with a chosen beginning, and a beginning
    that only repeats a chosen word, are left out.
    """
    totals = labelled.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in totals}
    positive, negative = n.get(1, 0), n.get(0, 0)
    base = max(positive, 1) / max(positive + negative, 2)
    counts = freeze(labelled.mapInArrow(_count_terms, "term binary, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter("toxic >= 3"))
    bar = math.log(10 * max(counts.count(), 1))
    p = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    surprise = (F.col("toxic") + F.col("clean")) * (p * F.log(p / base) + F.when(F.col("clean") > 0, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0))
    seeds = F.col("term").isin(*[bytearray(x.encode()) for x in SEEDS])
    some = {bytes(r["term"]): (r["toxic"], r["clean"], r["telling"]) for r in counts.withColumn(
        "telling", (p >= 0.9) & (surprise > bar)).filter(F.col("telling") | seeds).collect()}
    telling = [(-t, len(term), term) for term, (t, _, yes) in some.items() if yes]
    lexicon: list[bytes] = [s.encode() for s in SEEDS]
    for _, _, term in sorted(telling):
        word, kind = term.rstrip(b"-%"), term[len(term.rstrip(b"-%")):]
        alike = [k for k in lexicon if k.endswith(b"%") == kind.endswith(b"%")]  # dense beginnings and the others prune each other
        if len(lexicon) < max_voters and term not in lexicon and not any(
                word.startswith(k.rstrip(b"-%")) if k.endswith((b"-", b"%")) else k.startswith(word) and some[term][0] == some.get(k, (0,))[0] for k in alike):
            lexicon.append(term)
    return lexicon, {t: some.get(t, (0, 0))[:2] for t in lexicon}, (positive, negative)


class Lexicon:
    """The terms' voter numbers, looked up by word and by beginning."""

    def __init__(self, terms: list[bytes]) -> None:
        self.size, self.words, self.begin = len(terms), {}, {}
        for k, t in enumerate(terms):
            bare = t.rstrip(b"-%")
            if bare == t:
                self.words[t] = k
            else:  # (beginning, dense beginning)
                self.begin.setdefault(bare, [-1, -1])[t.endswith(b"%")] = k
        self.lengths = sorted({len(b) for b in self.begin})


def votes_of(text: str, words: list[bytes], counts: Counter, lexicon: Lexicon) -> list[int]:
    """The numbers of the voters that fire; pattern voters come after the lexicon."""
    lexical, dense, n = set(), Counter(), 0
    for w, c in counts.items():
        voter, hit = lexicon.words.get(w), False
        if voter is not None:
            lexical.add(voter)
            hit = True
        for size in lexicon.lengths:
            if len(w) > size and (found := lexicon.begin.get(w[:size])) is not None:
                hit = True
                if found[0] >= 0:
                    lexical.add(found[0])
                if found[1] >= 0:
                    dense[found[1]] += c
        n += c * hit
    lexical.update(v for v, c in dense.items() if c > 1 and 100 * c >= len(words))
    fired, first = sorted(lexical), lexicon.size
    silent = not fired
    raw = text.encode("utf-8", "replace")
    if 2 * (len(raw) - len(raw.translate(None, CAPITALS))) > sum(map(len, words)):
        fired.append(first)
    if text.count("!") * 20 > len(words):
        fired.append(first + 1)
    if "*" in text and MASKED.search(raw.lower()):
        fired.append(first + 2)
    if not silent:
        if any(a in (b"you", b"your") and b in lexicon.words for a, b in zip(words, words[1:], strict=False)):
            fired.append(first + 3)
        fired += [first + 4] * (n >= 3) + [first + 5] * (100 * n >= len(words))
    return fired + [first + 6] * silent


def features_of(counts: Counter) -> tuple[list[int], list[int]]:
    """Buckets of the words' beginnings, ascending, and how many words fall into each."""
    begin: dict[bytes, int] = {}
    for w, n in counts.items():
        begin[w[:FEATURE_BYTES]] = begin.get(w[:FEATURE_BYTES], 0) + n
    out: dict[int, int] = {}
    for beginning, n in begin.items():
        bucket = zlib.crc32(beginning) >> 32 - FEATURE_BITS
        out[bucket] = out.get(bucket, 0) + n
    order = sorted(out)
    return order, [out[b] for b in order]


def vote(docs: DataFrame, id_col: str, text_col: str, lexicon: list[bytes]) -> DataFrame:
    """``id, h`` (hash of the text), ``votes``, and the text's features ``bucket, times, words`` of each row."""
    terms = Lexicon(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, 1000) for at in range(0, whole.num_rows, 1000)):
                votes, features, n = [], [], []
                for text in batch["text"]:
                    words = _words(text.as_py() or "")
                    counts = Counter(words)
                    votes.append(votes_of(text.as_py() or "", words, counts, terms))
                    features.append(features_of(counts))
                    n.append(len(words))
                lists = lambda values: pa.array(values, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], batch["h"], lists(votes), lists([f[0] for f in features]), lists([f[1] for f in features]), pa.array(n, pa.int64())],
                    names=["id", "h", "votes", "bucket", "times", "words"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, h long, votes array<int>, bucket array<int>, times array<int>, words long")


def _summed(rows: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``of(batch)`` over all rows; only sums leave the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                got = of(batch.slice(at, 4096))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch["sums"]:
                got = row.values.to_numpy()
                total = got.copy() if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    # one row a task, then one for each of a fixed number of merging tasks, then one
    sums = rows.mapInArrow(run, "sums array<double>").repartition(MERGING_TASKS).mapInArrow(merge, "sums array<double>")
    parts = sums.repartition(1).mapInArrow(merge, "sums array<double>").toArrow()["sums"]
    return parts.combine_chunks().flatten().to_numpy().copy() if len(parts) else np.zeros(0)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values, and each one's row."""
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), lengths)


def _sums(patterns: DataFrame, size: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of(votes as a 0/1 matrix, counts)`` over all patterns."""

    def matrix(part: pa.RecordBatch) -> np.ndarray:
        x = np.zeros((part.num_rows, size))
        votes, row = _flat(part["votes"])
        x[row, votes] = 1
        return of(x, part["count"].to_numpy().astype(float))

    return _summed(patterns, matrix)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_label_model(patterns: DataFrame, rates: np.ndarray, prior: float, rounds: int = 8) -> tuple[float, np.ndarray]:
    """``bias, weights`` of the posterior log-odds; ``rates``: (2, voters), starting rates of firing on clean and toxic texts.

    A voter adds evidence when it fires; one that abstains says nothing (toxic texts
    use few of the words each), but that none fires is a voter of its own.
    """
    m = rates.shape[1]
    now, pi, weights = rates.copy(), prior, None
    share = np.ones(m)
    share_of = lambda y: prior if y else 1 - prior
    for turn in range(rounds):
        weights = share * np.clip(np.log(now[1] / now[0]), -8, 8)
        bias = math.log(pi / (1 - pi))
        moments = turn == 2  # once the rates have settled

        def expect(x: np.ndarray, n: np.ndarray, bias=bias, weights=weights, moments=moments) -> np.ndarray:
            p = _sigmoid(bias + x @ weights) * n
            first = [np.array([p.sum(), n.sum()]), p @ x, (n - p) @ x]
            return np.concatenate([*first, ((x * p[:, None]).T @ x).ravel()] if moments else first)

        s = _sums(patterns, m, expect)
        if not s.size or not s[1]:
            break
        toxic, rows = s[0], s[1]
        steady = rows  # the labelled rows' rates weigh as much as all documents do
        for y, (fired, total) in enumerate(((s[2 + m:2 + 2 * m], rows - toxic), (s[2:2 + m], toxic))):
            now[y] = np.clip((fired + steady * share_of(y) * rates[y]) / (total + steady * share_of(y)), 1e-6, 1 - 1e-3)
        pi = min(max((toxic + steady * prior) / (rows + steady), 1e-4), 0.5)
        if moments and toxic > 1:  # voters correlated inside the toxic class share their weight
            a = s[2:2 + m] / toxic
            spread = np.sqrt(np.maximum(a * (1 - a), 1e-9))
            r = (s[2 + 2 * m:].reshape(m, m) / toxic - np.outer(a, a)) / np.outer(spread, spread)
            share = 1 / np.maximum(1, np.where(r > 0.3, r, 0).sum(axis=1))
    return bias, weights


def _features(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of a batch: ``row, column, value``; the buckets' words in 100 (at most 5), then the votes."""
    bucket, row = _flat(part["bucket"])
    votes, voted = _flat(part["votes"])
    value = np.minimum(100 * part["times"].flatten().to_numpy() / np.maximum(part["words"].to_numpy(), 1)[row], 5.0)
    return np.concatenate([row, voted]), np.concatenate([bucket, (1 << FEATURE_BITS) + votes]), np.concatenate([value, np.ones(len(votes))])


def _logits(part: pa.RecordBatch, w: np.ndarray) -> np.ndarray:
    row, column, value = _features(part)
    return w[-1] + np.bincount(row, w[column] * value, minlength=part.num_rows)


def fit_classifier(voted: DataFrame, posterior: tuple[float, np.ndarray], steps: int = 14, ridge: float = 0.3) -> np.ndarray:
    """Logistic regression of the posterior labels on the text's features: a weight for each bucket and voter, the bias last.

    Each step sums gradient and curvature of every weight over all rows; a quasi-Newton step
    (limited memory, started from the curvatures) follows, shortened while the loss grows.
    """
    size = (1 << FEATURE_BITS) + len(posterior[1]) + 1

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def run(part: pa.RecordBatch) -> np.ndarray:
            votes, row_of_vote = _flat(part["votes"])
            y = _sigmoid(posterior[0] + np.bincount(row_of_vote, posterior[1][votes], minlength=part.num_rows))
            row, column, value = _features(part)
            p = _sigmoid(w[-1] + np.bincount(row, w[column] * value, minlength=part.num_rows))
            loss = -(y * np.log(p) + (1 - y) * np.log1p(-p)).sum()
            curve, slope = p * (1 - p), p - y
            return np.concatenate([[loss], np.bincount(column, slope[row] * value, minlength=size - 1), [slope.sum()],
                                   np.bincount(column, curve[row] * value * value, minlength=size - 1), [curve.sum()]])

        s = _summed(voted.select("votes", "bucket", "times", "words"), run)
        if not s.size:
            return 0.0, np.zeros(size), np.ones(size)
        keep = np.append(np.full(size - 1, ridge), 1e-6)
        return s[0] + (keep * w * w).sum() / 2, s[1:size + 1] + keep * w, s[size + 1:] + keep

    w = np.zeros(size)
    loss, slope, curve = at(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    length = 0.3  # the curvatures alone know nothing of words that stand together
    for _ in range(steps):
        direction, used = slope.copy(), []
        for ds, dg in reversed(pairs[-6:]):
            a = ds @ direction / (ds @ dg)
            used.append(a)
            direction -= a * dg
        direction /= curve
        if pairs:
            ds, dg = pairs[-1]
            direction *= (ds @ dg) / (dg @ (dg / curve))
        for (ds, dg), a in zip(pairs[-6:], reversed(used), strict=True):
            direction += ds * (a - dg @ direction / (ds @ dg))
        step = -(1.0 if pairs else length) * direction
        new = w + step
        new_loss, new_slope, new_curve = at(new)
        if new_loss > loss:
            length /= 4
            pairs = []
            continue
        if step @ (new_slope - slope) > 1e-9:
            pairs.append((step, new_slope - slope))
        done = loss - new_loss < 1e-4 * abs(loss)
        w, loss, slope, curve = new, new_loss, new_slope, new_curve
        if done:
            break
    return w


def calibrate(z: np.ndarray, toxic: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """``a, b`` of the probability ``1 / (1 + exp(-(a * z + b)))`` that fits the labelled rows (Platt's targets)."""
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    if not n1 or not n0:
        return 1.0, 0.0
    x, y = np.column_stack([z, np.ones(len(z))]), np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ab = np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ ab)
        ab = ab - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - y))
        ab[0] = min(max(ab[0], 0.05), 20.0)
    return float(ab[0]), float(ab[1])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *,
          train: F.Column | None = None, sample: int = 20_000, max_voters: int = MAX_VOTERS) -> DataFrame:
    """``id_col, h`` (hash of the text) ``, posterior`` (the label model's), ``score`` for every row of ``docs``.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1); only rows for which ``train``
    holds are read as labels, and at most ``sample`` of them.
    """
    chosen = labels.filter(train) if train is not None else labels
    chosen = freeze(chosen.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic")).orderBy(F.xxhash64("_id"), "_id").limit(sample))
    labelled = store(docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"]).select(text_or_empty(text_col).alias("text"), "toxic"))
    lexicon, seen, (positive, negative) = induce(labelled, max_voters)
    size = len(lexicon) + len(PATTERNS)
    rates = np.empty((2, size))
    rates[0], rates[1] = 0.02, 0.02  # pattern voters
    rates[:, -3:] = [[0.02, 0.02, 0.9], [0.3, 0.3, 0.05]]
    for k, t in enumerate(lexicon):
        a, c = seen[t]
        rates[1, k], rates[0, k] = (a + 1) / (positive + 20), (c + 0.02) / (negative + 20)
    prior = (positive + 1) / (positive + negative + 10)

    voted = store(vote(docs, id_col, text_col, lexicon))
    patterns = store(voted.groupBy("votes").count())
    bias, weights = fit_label_model(patterns, rates, prior)
    w = fit_classifier(voted, (bias, weights))
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, row = _flat(batch["votes"])
            posterior = _sigmoid(bias + np.bincount(row, weights[votes], minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["h"], pa.array(posterior, pa.float64()), pa.array(_logits(batch, w), pa.float64())],
                                             names=["id", "h", "posterior", "z"])

    scored = store(voted.mapInArrow(run, f"id {kind}, h long, posterior double, z double"))
    known = scored.join(F.broadcast(chosen), scored["id"] == chosen["_id"]).select("z", "toxic").limit(4 * sample).toPandas()  # rows that repeat an id count again
    slope, shift = calibrate(known["z"].to_numpy(float), known["toxic"].to_numpy(float))
    return scored.select(F.col("id").alias(id_col), "h", "posterior", (1 / (1 + F.exp(-(F.lit(slope) * F.col("z") + F.lit(shift))))).alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, at_least: float = 0.7,
               **options) -> DataFrame:
    """``docs`` without the rows that score ``at_least`` or more; all columns kept."""
    gone = score(docs, labels, id_col, text_col, **options).filter(F.col("score") >= at_least).select(
        F.col(id_col).alias("_id"), F.col("h").alias("_h")).distinct()
    return (
        docs.withColumn("_hash", F.xxhash64(text_col))
        .join(checked_broadcast(gone, 500_000), docs[id_col].eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_anti")
        .select(*docs.columns)
    )

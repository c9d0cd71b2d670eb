"""Personal data: base patterns, and bootstrapped contextual extraction on top of them.

*Base.*  E-mail addresses, IP addresses, payment cards and phone numbers are
found by fixed patterns in every whole text; these spans always stay.

*Bootstrapping.*  The base spans are seeds.  Other tokens that look like an
identifier (with a digit or an ``@``) are candidates.  Each occurrence has lexical
patterns: the words before it, and the words around it, with a coarse class of the
token (an ``@``, or many or few digits; its form is left open).  Spark scores the graph of patterns and instances in rounds: a pattern's
confidence in a kind is the share of its occurrences that are instances of this kind (seeds count 1,
others their score), lowered by a prior for patterns with few different
instances; an instance's score is that of one minus the product of the doubts of its
patterns.  After the last round, instances whose score and support pass high
thresholds are accepted, and all their occurrences become spans of the kind.
All sums are partial before the shuffle, so a very common word pair is no hot
group, and no list of occurrences is ever gathered by pattern.

Spans are in code points, the end exclusive.  Defined cases: NULL and empty texts
have no span; rows that repeat an id are separate rows of one document (spans are keyed by
id and text); a NULL id is kept; very long texts are read whole; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import store

KINDS = ("email", "ip", "card", "phone")
# fixed values: the base patterns (guards in front only skip starts that cannot begin a leftmost match)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Tokens that may be identifiers.
CANDIDATE = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
SPAN = "array<struct<kind:string,start:int,end:int>>"
OCCURRENCE = "array<struct<instance:string,kind:string,start:int,end:int,patterns:array<string>>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans in order of kind, then start; matches that fail a check are dropped and not tried again."""
    out: list[tuple[str, int, int]] = []
    if "@" in text:
        end = 0
        for run in LOCAL.finditer(text):
            start = max(run.start(), end)
            if start < run.end() and (m := DOMAIN.match(text, run.end())):
                end = m.end()
                out.append(("email", start, end))
    if not any(d in text for d in "0123456789"):
        return out
    for m in IP.finditer(text):
        if all(int(p.lstrip("0")[:4] or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def _class(token: str) -> str:
    """A coarse class, so that an instance may have a form no seed has: ``@``, or many or few digits."""
    return "@" if "@" in token else "9" * (1 + (sum(map(str.isdigit, token)) >= 7))


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of an occurrence: words before, words around, each with the token's class."""
    before = text[max(0, start - 200):start].split()[-2:]
    after = text[end:end + 100].split()[:1]
    kind = _class(text[start:end])
    b1 = before[-1].lower() if before else "^"
    b2 = before[0].lower() if len(before) == 2 else "^"
    a1 = after[0].lower() if after else "$"
    return [f"L2|{b2} {b1}|{kind}", f"LR|{b1} _ {a1}|{kind}", f"L1|{b1}|{kind}"]


def occurrences(text: str | None) -> tuple[list, list]:
    """The base spans, and every seed and candidate with its patterns (``kind`` is NULL for candidates)."""
    text = text or ""
    base = base_spans(text)
    if not base and not CANDIDATE.search(text):
        return base, []
    out = [(text[s:e], kind, s, e, _patterns(text, s, e)) for kind, s, e in base]
    covered = sorted((s, e) for _, s, e in base)
    at = 0
    for m in CANDIDATE.finditer(text):
        token = m[0].strip(".,;:!?()[]{}<>\"'")
        start = m.start() + m[0].find(token)
        end = start + len(token)
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if token and not (at < len(covered) and covered[at][0] < end):
            out.append((token, None, start, end, _patterns(text, start, end)))
    return base, out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    occurrence = pa.list_(pa.struct([("instance", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                     ("patterns", pa.list_(pa.string()))]))
    for batch in batches:
        found = [occurrences(t.as_py()) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([
            batch["id"], batch["h"],
            pa.array([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in base] for base, _ in found], span),
            pa.array([[dict(zip(("instance", "kind", "start", "end", "patterns"), x, strict=True)) for x in all_] for _, all_ in found], occurrence),
        ], names=["id", "h", "base", "occurrences"])


def bootstrap(occurrence: DataFrame, *, rounds: int = 3, prior: float = 4.0, confident: float = 0.9, support: int = 3) -> DataFrame:
    """Accepted instances: ``instance, kind, score``; ``occurrence``: ``instance, kind`` (NULL if no seed) ``, pattern``.

    ``prior`` is the weight of doubt: a pattern needs many different instances of a kind
    before it is trusted; ``support`` is how many different seeds, or instances accepted
    in an earlier round, must share a pattern with an accepted instance.
    """
    edges = store(occurrence.groupBy("pattern", "instance").agg(F.max("kind").alias("seed"), F.count(F.lit(1)).alias("n")))
    known = edges.filter("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    accepted = None
    for _ in range(rounds):
        trusted = (
            edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("good"), F.count(F.lit(1)).alias("known"))
            .join(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")), "pattern")
            .withColumn("confidence", F.col("good") / (F.col("instances") + prior))
            .filter(F.col("known") >= support).select("pattern", "kind", "confidence")
        )
        scored = (
            edges.filter("seed is null").join(trusted, "pattern").groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("score"))
        )
        accepted = store(scored.filter(F.col("score") >= confident))
        known = known.select("instance", "kind", "score").unionByName(accepted).groupBy("instance", "kind").agg(F.max("score").alias("score"))
    best = accepted.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("best"))
    return best.select("instance", F.col("best.kind").alias("kind"), F.col("best.score").alias("score"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``id_col``, ``base`` and ``spans``, arrays of ``kind, start, end`` in order of kind, then start."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("string").alias("text"))
    scanned = store(rows.mapInArrow(_scan, f"id {kind}, h long, base {SPAN}, occurrences {OCCURRENCE}"))
    each = scanned.select("id", "h", F.explode("occurrences").alias("o")).select("id", "h", "o.*")
    accepted = bootstrap(each.select("instance", "kind", F.explode("patterns").alias("pattern")), **options)
    more = (
        each.filter("kind is null").drop("kind").join(accepted, "instance").select("id", "h", F.struct("kind", "start", "end").alias("s"))
        .groupBy("id", "h").agg(F.collect_set("s").alias("more"))
    )
    s, m = scanned.drop("occurrences").alias("s"), more.alias("m")
    rank = {k: i for i, k in enumerate(KINDS)}
    place = lambda x: F.element_at(F.create_map(*[F.lit(v) for kv in rank.items() for v in kv]), x["kind"])
    ordered = F.transform(
        F.array_sort(F.transform(F.concat("base", F.coalesce("more", F.array().cast(SPAN))), lambda x: F.struct(
            place(x).alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return s.join(m, F.expr("s.id <=> m.id and s.h = m.h"), "left").select(F.col("s.id").alias(id_col), "base", ordered.alias("spans"))


def joined(spans: str) -> F.Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def counted(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")

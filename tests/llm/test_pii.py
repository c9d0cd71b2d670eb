"""Personal data: the base patterns against their plain form, and bootstrapping on a planted table."""

from __future__ import annotations

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from gridmix.llm import pii

# fixed values: the patterns as the contract states them
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(int(p) for p in m[0].split(".")) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ 0(5%ß", max_size=60))
def test_base_equals_plain_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_base_known_values():
    text = "a@b.co +1 (555) 123-4567 4111 1111 1111 1111 10.0.0.256 1.2.3.4.5.6.7.8 a@b@c.de x@y.z@w.v 000000255.1.1.1"
    assert pii.base_spans(text) == brute(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_ip_parts_with_leading_zeros_are_judged_whole():
    text = "00999.1.1.1 000256.1.1.1 000255.1.1.1 0000.0.0.0"
    assert pii.base_spans(text) == brute(text)
    assert [text[s:e] for _, s, e in pii.base_spans(text)] == ["000255.1.1.1", "0000.0.0.0"]


def test_bootstrapping_finds_what_the_patterns_miss(documents):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeioubcdfg") for _ in range(6))
    rows = [(i, f"{word()} {word()} write me at user{i}@host{i}.example.org today {word()}") for i in range(60)]
    rows += [(100 + i, f"{word()} write me at user{i}@localhost today {word()}") for i in range(5)]
    rows += [(200 + i, f"{word()} room {i}{i} {word()} code{i} {word()}") for i in range(60)]
    rows += [(300, None), (301, ""), (None, "mail q@w.ee"), (302, "+4912345678901" + " x" * 50_000), (200, "room 7"), (200, "room 7")]
    got = pii.find_pii(documents(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all([s.kind for s in by[100 + i].spans] == ["email"] and by[100 + i].base == [] for i in range(5))
    assert all(by[200 + i].spans == [] for i in range(60))
    assert [s.kind for s in by[302].spans] == ["phone"] and [s.kind for s in by[None].spans] == ["email"]
    for r in got:
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))


def test_bootstrapping_finds_new_forms_and_new_patterns(documents):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioubcdfg") for _ in range(6))
    number = lambda i: f"0171-555{i:04}"
    rows = [(i, f"{word()} please call +49171555{i:04} today {word()}") for i in range(60)]
    rows += [(100 + i, f"{word()} please call {number(i)} today {word()}") for i in range(6)]  # no '+'
    rows += [(200 + i, f"{word()} my mobile {number(i % 40)} anytime {word()}") for i in range(40)]  # six of them are known by then
    rows += [(300 + i, f"{word()} order {i:08} shipped {word()}") for i in range(60)]
    by = {r.doc_id: r for r in pii.find_pii(documents(rows)).collect()}
    assert all([s.kind for s in by[100 + i].spans] == ["phone"] and by[100 + i].base == [] for i in range(6))
    assert all([s.kind for s in by[200 + i].spans] == ["phone"] for i in range(6))
    assert all(by[300 + i].spans == [] for i in range(60))


def test_accepted_instances_support_new_patterns(spark):
    rows = [(f"seed{i}", "phone", p) for i in range(60) for p in ("call", "please call")]
    rows += [(f"new{i}", None, p) for i in range(60) for p in ("call", "please call", "mobile", "my mobile")]
    rows += [("last", None, p) for p in ("mobile", "my mobile")] + [("other", None, "room")]
    rows += [(f"seed{i}", "phone", p) for i in range(60, 1000) for p in ("call", "please call")]
    got = pii.bootstrap(spark.createDataFrame(rows, "instance string, kind string, pattern string")).collect()
    assert {r.instance for r in got} == {f"new{i}" for i in range(60)} | {"last"}


def test_empty_table(documents):
    assert pii.find_pii(documents([])).collect() == []

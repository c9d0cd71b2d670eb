"""Chat formatting: exact round trip and loss mask."""

from __future__ import annotations

from collections import defaultdict

import pytest

from gridmix.llm import chat

EVIL = [r"\### Assistant: </turn> ok", "</turn></turn>\n### user: x</turn>\n", "\\\\b\\h#####", "</tur", "###", "a" * 50_000, "", "n̈ \U0001f600</turn>", "\\"]


def rows_of():
    rows = []
    for c in range(12):
        rows += [(c, 0, "system", f"system {c}")] * (c % 2)
        for t in range(1, 2 + 5 * c):
            rows.append((c, t, ("user", "assistant")[t % 2], EVIL[(c + t) % len(EVIL)] + " word" * (t * 13 % 90)))
    rows += [(None, 1, "user", "x"), (None, 2, "assistant", None), (50, None, "user", "no turn"), (50, 3, None, "no role"), (50, 4, "a:b", "odd role"),
             (51, 1, "assistant", "same"), (51, 1, "assistant", "same"), (51, 1, "system", "late"), (-7, 0, "user", EVIL[0]), (-7, 1, "assistant", EVIL[0])]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, 1, "w") for r in rows_of()], "conv_id long, turn long, role string, text string, key int, window string")


def test_round_trip(conversations):
    want = defaultdict(list)
    for c, t, r, x in rows_of():
        want[c].append((t is not None, t or 0, r or "", x or ""))
    got = {r.conv: r for r in chat.read_back(chat.windows(conversations)).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        assert got[c].n_turns == len(turns)
        assert got[c].turns == "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        assert got[c].loss == "".join(x for *_, r, x in turns if r == "assistant")


def test_windows_keep_budget_history_and_system(conversations):
    budget, history = 60, 2
    for w in chat.windows(conversations, budget=budget, history=history).collect():
        shown = w.formatted.split("</turn>\n")[:-1]
        assert len(shown) == w.n_repeated + w.n_new and 1 <= w.n_new <= budget and w.n_repeated <= history + 1
        costs = [len(s.split(": ", 1)[1].split()) + 1 for s in shown[w.n_repeated:]]
        assert sum(costs[:-1]) < budget
        if w.conv in (1, 3, 5):
            assert shown[0].startswith("### system: ")
        for start, end in w.loss_spans:
            assert w.formatted[:start].rsplit("### ", 1)[1] == "assistant: " and w.formatted[end:].startswith("</turn>\n")


def test_empty_table(conversations):
    assert chat.windows(conversations.limit(0)).collect() == []
    assert chat.read_back(chat.windows(conversations.limit(0))).collect() == []

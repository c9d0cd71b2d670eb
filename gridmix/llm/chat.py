"""Chat formatting in budgeted windows, with a loss mask and a reversible template.

The turns of a conversation, in order, are cut into windows.  Prefix sums of
the turns' costs (words plus one) choose the spans: a turn belongs to span
``floor(cost before it / budget)``, so spans are turn-aligned and a span's
cost is under the budget plus its last turn.  A window shows the system turn
(if the span does not already hold it), up to ``history`` turns repeated from the
span before, then its own turns.  Loss falls only on the texts of the
window's own assistant turns: each is learnt once, repeats are masked.

The prefix sums are taken in two levels (ranges of ``turn``, then the ranges'
sums), so a conversation with a third of all rows is not one task; a window
holds at most ``budget`` turns of its own.  Only built-in functions are used.

Template: ``### role: text</turn>`` and a line feed for each turn.  Inside a text or role the
control strings are escaped: ``\\`` becomes ``\\b``, ``###`` becomes ``\\h``, ``</turn>``
becomes ``\\e`` and, in roles only, ``:`` becomes ``\\c``.  Every backslash of an
escaped text starts a code, so reading it back is unambiguous.

Defined cases: a NULL text or role is empty; turns are ordered by ``turn``
(NULL first), then role, then text; equal rows are separate turns; a NULL
conversation id is a conversation of its own; the system turn is the first
turn with role ``system``, later ones are ordinary turns; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import WORD

END = "</turn>"
TEXT_CODES = (("\\", "\\b"), ("###", "\\h"), (END, "\\e"))
ROLE_CODES = (*TEXT_CODES, (":", "\\c"))
RANGE = 256  # turn numbers in a range of the prefix sums


def _escape(c: Column, codes) -> Column:
    return reduce(lambda x, code: F.replace(x, F.lit(code[0]), F.lit(code[1])), codes, c)


def _unescape(c: Column, codes) -> Column:
    return reduce(lambda x, code: F.replace(x, F.lit(code[1]), F.lit(code[0])), reversed(codes), c)


def ordered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each turn with its prefix sum: ``key, conv, role, text, before`` (cost before it, unique in a conversation)."""
    turns = rows.select(
        F.coalesce(F.col(conv).cast("string"), F.lit("\0")).alias("key"), F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    ).withColumn("cost", F.regexp_count("text", F.lit(WORD)).cast("long") + 1).withColumn(
        "range", F.coalesce(F.floor(F.col("turn") / RANGE), F.lit(-(1 << 62))))
    offsets = turns.groupBy("key", "range").agg(F.sum("cost").alias("n")).select(
        "key", "range", (F.sum("n").over(Window.partitionBy("key").orderBy("range")) - F.col("n")).alias("offset"))
    inside = Window.partitionBy("key", "range").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    return (
        turns.withColumn("within", F.sum("cost").over(inside) - F.col("cost"))
        .join(offsets, ["key", "range"])
        .select("key", "conv", "role", "text", (F.col("offset") + F.col("within")).alias("before"))
    )


def windows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *,
            budget: int = 256, history: int = 2) -> DataFrame:
    """One row per window: ``conv, window, formatted, n_repeated, n_new, loss_spans``.

    ``n_repeated`` leading turns repeat earlier ones; ``loss_spans`` are the
    ``(start, end)`` code points of ``formatted`` that are learnt.
    """
    turns = ordered_turns(rows, conv, turn, role, text).withColumn("window", F.expr(f"before div {budget}"))
    spans = turns.groupBy("key", "conv", "window").agg(F.min("before").alias("first")).withColumn(
        "next", F.lead("window").over(Window.partitionBy("key").orderBy("window")))
    system = turns.filter("role = 'system'").groupBy("key").agg(F.min(F.struct("before", "text")).alias("s")).select(
        "key", F.col("s.before").alias("system_at"), F.col("s.text").alias("system_text"))
    own = turns.select("key", "window", F.lit(2).alias("part"), "before", "role", "text")
    from_end = Window.partitionBy("key", "window").orderBy(F.desc("before"))
    repeated = (
        turns.withColumn("from_end", F.row_number().over(from_end)).filter(F.col("from_end") <= history)
        .join(spans.filter("next is not null").select("key", "window", "next"), ["key", "window"])
        .join(system.select("key", "system_at"), "key", "left").filter("system_at is null or before <> system_at")
        .select("key", F.col("next").alias("window"), F.lit(1).alias("part"), "before", "role", "text")
    )
    heads = spans.join(system, "key").filter(f"system_at div {budget} <> window").select(
        "key", "window", F.lit(0).alias("part"), F.col("system_at").alias("before"), F.lit("system").alias("role"),
        F.col("system_text").alias("text"))
    entry = F.struct("part", "before", F.concat(F.lit("### "), _escape(F.col("role"), ROLE_CODES), F.lit(": ")).alias("head"),
                     _escape(F.col("text"), TEXT_CODES).alias("body"), (F.col("role") == "assistant").alias("learn"))
    shown = own.unionByName(repeated).unionByName(heads).groupBy("key", "window").agg(F.sort_array(F.collect_list(entry)).alias("t"))
    lengths = F.transform("t", lambda x: F.length(x["head"]) + F.length(x["body"]) + len(END) + 1)
    begin = lambda i: F.aggregate(F.slice(F.col("lengths"), 1, i), F.lit(0), lambda a, b: a + b)
    bodies = F.transform("t", lambda x, i: F.struct(
        ((x["part"] == 2) & x["learn"]).alias("learn"), (begin(i) + F.length(x["head"])).alias("start"), F.length(x["body"]).alias("n")))
    return (
        shown.withColumn("lengths", lengths)
        .withColumn("formatted", F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(END + "\n"))), ""))
        .withColumn("n_repeated", F.size(F.filter("t", lambda x: x["part"] < 2)))
        .withColumn("loss_spans", F.transform(F.filter(bodies, lambda x: x["learn"]), lambda x: F.struct(
            x["start"].alias("start"), (x["start"] + x["n"]).alias("end"))))
        .withColumn("n_new", F.size("t") - F.col("n_repeated"))
        .join(spans.select("key", "conv", "window"), ["key", "window"])
        .select("conv", "window", "formatted", "n_repeated", "n_new", "loss_spans")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: ``conv, n_turns, turns, loss, formatted_chars``.

    ``turns`` is every turn's role, line feed, text, line feed; ``loss`` all text
    under the mask.  Both are unescaped and in order.
    """
    segments = F.slice(F.split("formatted", END + "\n"), F.col("n_repeated") + 1, F.col("n_new"))
    turn = lambda s: F.concat(
        _unescape(F.regexp_extract(s, r"(?s)^### ([^:]*): (.*)$", 1), ROLE_CODES), F.lit("\n"),
        _unescape(F.regexp_extract(s, r"(?s)^### ([^:]*): (.*)$", 2), TEXT_CODES), F.lit("\n"))
    learnt = F.transform("loss_spans", lambda x: _unescape(
        F.substring(F.col("formatted"), x["start"] + 1, x["end"] - x["start"]), TEXT_CODES))
    parts = formatted.select("conv", "n_new", F.length("formatted").alias("chars"), F.struct(
        "window", F.array_join(F.transform(segments, turn), "").alias("turns"), F.array_join(learnt, "").alias("loss")).alias("w"))
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    return (
        parts.groupBy("conv").agg(F.sum("n_new").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                  F.sort_array(F.collect_list("w")).alias("w"))
        .select("conv", "n_turns", joined("turns").alias("turns"), joined("loss").alias("loss"), "formatted_chars")
    )

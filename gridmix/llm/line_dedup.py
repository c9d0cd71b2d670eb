"""Fuzzy line de-duplication: MinHash bands, exact Jaccard verification, distributed union-find.

Lines are compared without outer white space; blank lines always stay.  A line's set is its
runs of 12 characters, one from each character (a shorter line is one run).  Two lines are alike
when the Jaccard similarity of their sets is 0.8 or more.  Of each component
of alike lines one line stays, its first occurrence by document id and line number.

Equal lines are classed by a 128-bit hash (partial counts before the
shuffle).  Candidates come from a thinner set, the runs from each word start (and inside long
words).  MinHash: with these hashed to 64 bits, the ``rows`` hashes that
follow a fixed point of the hash ring are a min-wise sample; ``bands`` points give as many
bands (a pair whose thin sets have similarity j shares none with probability about
(1 - j ** rows) ** bands: with 10 bands of 3, 0.08% at 0.8 and 0.002% at 0.9).

All lines of a bucket are compared with one pivot, its smallest key, which links near copies without
listing their pairs.  A bucket of three lines or more that are not all in one component is mixed.  All its lines are then compared
with a few more, and, where components still differ, with each other.  There bit marks of the full sets rule out pairs that cannot
be alike (a differing mark is a run that only one line has), so none is lost by them.  So every pair that shares a bucket is
compared, ruled out or in one component.  Lost are only pairs that share no band.  Pairs are judged by their
full sets.  Only DataFrame functions are used.

The bands are shuffled once: a window over each bucket finds its pivot, and lines alone in their bucket
go no further.  Marks are made of lines in mixed buckets only.

Defined cases: a NULL text stays NULL; documents are told apart by id and text, so rows that
repeat both are one document and get the same lines; a NULL id comes after all others; lines
are split at line feeds only; other columns are kept as they are; an empty
table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import connected_components, store
from gridmix.operators.joins import checked_broadcast, freeze

RUN = 12  # characters
#: Eight characters and the eleven behind them, which hold the runs from each of the eight; the last piece is shorter.
PIECE = r"(?s)(?=(.{12,19})).{1,8}"
#: Looks at a run from a word start, then moves on: behind the word if at most 10 of its characters are left, else by one character.
SPARSE = r"(?s)(?=(\S.{0,11}+))(?:\S{1,10}+(?!\S)|\S)\s*+"
BANDS, ROWS = 10, 3
WORDS = 16  # 64-bit words of marks of a line
HUBS = 8  # lines of a bucket that all its lines are compared with before all are
BLANKS = " \t\n\x0b\f\r"
SMALL = 500_000  # rows of a few longs that may be broadcast


def shingle_hashes(line: Column | str) -> Column:
    """The sorted distinct 64-bit hashes of a line's runs from word starts."""
    return F.sort_array(F.array_distinct(F.transform(
        F.regexp_extract_all(line, F.lit(SPARSE), F.lit(1)), lambda s: F.xxhash64(s))))


def run_hashes(line: str) -> Column:
    """The 64-bit hashes of a line's full set: the 12 characters from each that has as many, or the whole of a shorter line.  They may repeat."""

    def run(piece: Column, at: Column) -> Column:
        return F.xxhash64(F.substring(piece, at, F.lit(RUN)))

    def runs(piece: Column) -> Column:  # written out for whole pieces: a lambda for each character is slow
        some = F.transform(F.sequence(F.lit(1), F.length(piece) - (RUN - 1)), lambda at: run(piece, at))
        return F.when(F.length(piece) == RUN + 7, F.array(*[run(piece, F.lit(at)) for at in range(1, 9)])).otherwise(some)

    pieces = F.transform(F.regexp_extract_all(line, F.lit(PIECE), F.lit(1)), runs)
    return F.when(F.length(line) < RUN, F.array(F.xxhash64(line))).otherwise(F.flatten(pieces))


def coded_run_hashes(line: Column | str) -> Column:
    """As ``run_hashes``, of the runs in UTF-32: other values for the same runs, found by place and so three times faster."""
    width = 4 * RUN

    def runs(coded: Column) -> Column:
        starts = F.sequence(F.lit(1), F.octet_length(coded) - (width - 1), F.lit(4))
        return F.when(F.octet_length(coded) < width, F.array(F.xxhash64(coded))).otherwise(
            F.transform(starts, lambda at: F.xxhash64(F.substring(coded, at, F.lit(width)))))

    return F.transform(F.array(F.encode(line, "UTF-32")), runs)[0]  # an array holds the coded line, else each run would code it again


def _points(bands: int) -> list[int]:
    return [-(1 << 63) + k * ((1 << 64) // bands) for k in range(bands)]


def _ring(hashes: str, bands: int) -> Column:
    return F.sort_array(F.concat(hashes, F.array(*map(F.lit, _points(bands)))))


def band_keys(hashes: str, twice: str, ring: str, bands: int = BANDS, rows: int = ROWS) -> Column:
    """One hash per band of the ``rows`` hashes that follow the band's point.

    ``twice``: the hashes, then the first ``rows`` of them again; ``ring``: hashes and points in order.
    """

    def key(band: int, point: int) -> Column:
        at = (F.array_position(ring, F.lit(point)) - F.lit(1 + band)) % F.size(hashes)  # found by position: a filter for each point is slow
        return F.xxhash64(F.lit(band), F.slice(twice, at.cast("int") + 1, rows))

    return F.array(*[key(band, point) for band, point in enumerate(_points(bands))])


def _trimmed(line: str) -> Column:
    """``line`` without outer white space; a trim goes through the whole line, and few lines need one."""
    outer = [f(line, F.lit(blank)) for f in (F.startswith, F.endswith) for blank in BLANKS]
    return F.when(reduce(Column.__or__, outer), F.btrim(line, F.lit(BLANKS))).otherwise(F.col(line))


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each non-blank line: ``id, h`` (the document), ``line_no``, ``line`` without outer white space."""
    return (
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
        .select("id", "h", F.posexplode_outer(F.split("t", "\n")).alias("line_no", "line"))  # explode would split twice
        .withColumn("line", _trimmed("line")).filter("line <> ''")
    )


def _with_keys(lines: DataFrame) -> DataFrame:
    return lines.withColumn("k1", F.xxhash64("line")).withColumn("k2", F.xxhash64(F.lit("second"), "line"))


def _alike(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (``a, b``) whose lines' full sets are alike; ``texts``: ``k1, line``."""
    sets = F.explode(F.array(F.struct(coded_run_hashes("la").alias("x"), coded_run_hashes("lb").alias("y"))))  # exploded, so that runs are taken once
    return (
        pairs.join(texts.select(F.col("k1").alias("a"), F.col("line").alias("la")), "a")
        .join(texts.select(F.col("k1").alias("b"), F.col("line").alias("lb")), "b")
        .select("a", "b", sets.alias("of"))
        .filter(F.size(F.array_intersect("of.x", "of.y")) >= threshold * F.size(F.array_union("of.x", "of.y")) - 1e-9)
        .select("a", "b")
    )


def _marked(texts: DataFrame) -> DataFrame:
    """``k1, n, marks`` of each line: the size of its full set, and for each of ``64 * WORDS`` bits whether an odd number of its runs fall on it."""
    runs = texts.select("k1", F.explode(F.array_distinct(run_hashes("line"))).alias("run"))
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(run, 32) & 63 as int))")
    words = [F.coalesce(F.bit_xor(F.when(F.pmod("run", F.lit(WORDS)) == w, bit)), F.lit(0).cast("long")) for w in range(WORDS)]
    return runs.groupBy("k1").agg(F.count(F.lit(1)).cast("int").alias("n"), F.array(*words).alias("marks"))


def _may_be_alike(x: str, y: str, threshold: float) -> Column:
    """False only for lines whose full sets cannot be alike: each differing mark, and each run that one has more, is a run that only one has."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differing = sum((F.bit_count(F.col(f"{x}.marks")[w].bitwiseXOR(F.col(f"{y}.marks")[w])) for w in range(1, WORDS)),
                    F.bit_count(F.col(f"{x}.marks")[0].bitwiseXOR(F.col(f"{y}.marks")[0])))
    most = (n + m) * ((1 - threshold) / (1 + threshold)) + 1e-6  # runs that only one of two alike lines has
    return (F.abs(n - m) <= most) & (differing <= most)


def _compared(entries: DataFrame) -> DataFrame:
    """The lines of each bucket beside the bucket's pivot, its smallest key, and how many they are: ``key, k1, pivot, others``."""
    dealt = entries.filter("key is not null and k1 is not null").repartition("key")  # shuffled once (the filter is what the join adds): what follows keeps its partitions
    pivots = dealt.groupBy("key").agg(F.min("k1").alias("pivot"), F.max("k1").alias("last")).filter("pivot <> last").drop("last")
    near = dealt.join(pivots.hint("shuffle_hash"), "key").filter("k1 <> pivot").distinct()
    return store(near.withColumn("others", F.count(F.lit(1)).over(Window.partitionBy("key"))))


def _members(near: DataFrame) -> DataFrame:
    """``key, k1`` of the buckets that hold two lines or more beside the pivot; pivots too."""
    members = near.filter("others > 1")
    return members.select("key", "k1").unionByName(members.select("key", F.col("pivot").alias("k1")).distinct())


def _unsettled(members: DataFrame, components: DataFrame) -> DataFrame:
    """``members`` with ``component``, in buckets whose lines are not all of one component."""
    bucket = Window.partitionBy("key")
    placed = members.join(checked_broadcast(components, SMALL), "k1", "left").withColumn("component", F.coalesce("component", "k1"))
    return placed.withColumn("lo", F.min("component").over(bucket)).withColumn("hi", F.max("component").over(bucket)).filter("lo <> hi").drop("lo", "hi")


def _meeting(rest: DataFrame, others: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` of a line of ``rest`` and one of ``others`` of lower rank in one bucket and in different components that may be alike, none left out."""
    x, y = rest.alias("x"), others.alias("y")
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.rank") > F.col("y.rank"))
                 & _may_be_alike("x", "y", threshold))
    return met.select(F.greatest("x.k1", "y.k1").alias("a"), F.least("x.k1", "y.k1").alias("b")).distinct()


def _components(linked: DataFrame) -> DataFrame:
    return freeze(connected_components(linked, "a", "b").withColumnRenamed("node", "k1"))


def _linked(components: DataFrame, more: DataFrame) -> DataFrame:
    """``components`` with those that ``more`` (``a, b``) joins made one."""
    more = freeze(more)
    return components if more.isEmpty() else _components(more.unionByName(components.select(F.col("k1").alias("a"), F.col("component").alias("b"))))


def alike_components(lines: DataFrame, banded: DataFrame, threshold: float) -> DataFrame:
    """``k1, component`` of every line that is alike to another; ``banded``: ``k1, bands`` of each line."""
    near = _compared(banded.select("k1", F.explode("bands").alias("key")))
    pairs = freeze(near.select(F.col("k1").alias("a"), F.col("pivot").alias("b")).distinct())
    wanted = freeze(pairs.select(F.explode(F.array("a", "b")).alias("k1")).distinct())
    texts = store(
        _with_keys(lines.select("line")).drop("k2").join(checked_broadcast(wanted, SMALL), "k1", "left_semi")
        .groupBy("k1").agg(F.any_value("line").alias("line"))
    )
    components = _components(freeze(_alike(pairs, texts, threshold)))
    by_hash = Window.partitionBy("key").orderBy(F.xxhash64("k1"), "k1")
    mixed = store(_unsettled(_members(near), components).withColumn("rank", F.row_number().over(by_hash)))
    if mixed.isEmpty():
        return components
    marked = _marked(texts.join(checked_broadcast(freeze(mixed.select("k1").distinct()), SMALL), "k1", "left_semi"))
    rest = store(mixed.join(marked, "k1"))
    hubs, others = rest.filter(F.col("rank") <= HUBS), rest.filter(F.col("rank") > HUBS)
    # a few lines of each bucket join most of its components, so that few pairs of the others are left
    components = _linked(components, _alike(freeze(_meeting(rest, hubs, threshold)), texts, threshold))
    others = store(_unsettled(others.drop("component"), components))
    if others.isEmpty():
        return components
    return _linked(components, _alike(freeze(_meeting(others, others, threshold)), texts, threshold))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The lines that go: ``id, h, line_no``."""
    lines = occurrences(docs, id_col, text_col)
    keyed = store(
        _with_keys(lines).withColumn("s", shingle_hashes("line"))
        .withColumn("ring", _ring("s", bands)).withColumn("twice", F.concat("s", F.slice("s", 1, rows)))
        .select("id", "h", "line_no", "k1", "k2", F.when(F.size("s") > 1, band_keys("s", "twice", "ring", bands, rows)).alias("bands"))
    )
    components = alike_components(lines, keyed.filter("bands is not null").select("k1", "bands"), threshold)
    twice = keyed.groupBy("k1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    known = components.withColumn("n", F.lit(None).cast("long")).unionByName(twice.withColumn("component", F.lit(None).cast("long")))
    several = freeze(known.groupBy("k1").agg(F.max("component").alias("component")))
    placed = store(  # lines that are not alone: by component, others by both hashes
        keyed.drop("bands").join(checked_broadcast(several, SMALL), "k1")
        .select("id", "h", "line_no", F.coalesce("component", "k1").alias("g1"), F.when(F.col("component").isNull(), F.col("k2")).otherwise(0).alias("g2"))
    )
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "h", "line_no")
    stays = freeze(placed.groupBy("g1", "g2").agg(F.min(place).alias("stay")))
    return (
        placed.join(checked_broadcast(stays, SMALL), ["g1", "g2"])
        .filter(~place.eqNullSafe(F.col("stay"))).select("id", "h", "line_no")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and ``n_lines``, ``n_dropped`` appended.

    ``n_lines`` counts non-blank lines.
    """
    gone = freeze(repeated_lines(docs, id_col, text_col, **options))
    lists = gone.groupBy("id", "h").agg(F.collect_set("line_no").alias("_gone")).select(
        F.col("id").alias("_id"), F.col("h").alias("_h"), "_gone")
    # not broadcast: the lists grow with the texts, and one plan at all sizes lets its disk be carried on to larger tables
    split = F.split(F.col(text_col), "\n")
    rest = F.array_join(F.filter("_split", lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return (
        docs.withColumn("_hash", F.xxhash64(text_col))
        .join(lists, docs[id_col].eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
        .withColumn("_split", split)
        .withColumn("_lines", F.size(F.filter("_split", lambda x: F.ltrim(x, F.lit(BLANKS)) != "")))
        .withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(rest))
        .select(*docs.columns, F.greatest("_lines", F.lit(0)).cast("long").alias("n_lines"),
                F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
    )


def keep_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` with repeated lines taken out; a document all of whose lines stand elsewhere goes.

    ``count_col``, if there is one, is set to the code points that are left.
    """
    out = dedup_lines(docs, id_col, text_col, **options).filter("n_dropped = 0 or n_dropped < n_lines")
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.when(F.col("n_dropped") > 0, F.length(text_col).cast("long")).otherwise(F.col(count_col)))
    return out.select(*docs.columns)

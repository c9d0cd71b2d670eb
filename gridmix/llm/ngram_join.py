"""Exact n-gram Jaccard join over whole documents: prefix filtering, then a prefix-tree join of what is left.

A document's set is its distinct five-word shingles as 64-bit hashes (the whole
sequence of words as one shingle if there are fewer).  Two documents link when
``100 * intersection >= 80 * union``.  Linked pairs are not listed: the result
is one row per document with its class (equal sets) and its component, found
without losing a link between different sets.

1. *Prefixes.*  Shingles are ordered by hash.  Linked sets share at least
   ``ceil(0.8 n)`` shingles, so their first ``n - ceil(0.8 n) + k`` shingles share at
   least ``k`` (here 10% of the set).  Only these prefixes are shuffled.
2. *Groups.*  A class keeps its shared prefix shingles but for the ``k - 1``
   most frequent ones (``k`` of its smallest possible partner); one with fewer
   than ``k`` is alone.  Linked classes share ``k``, so they both keep the rarest of
   these: the step loses nothing, and a passage that many documents share does not
   glue them together.  Each kept shingle joins its classes of like size (linked
   sizes differ by a quarter at most) to the smallest one (a star, not all
   pairs); the components of these stars are *groups* that no link leaves.
3. *Prefix tree.*  Inside a group, the full sets, ordered by rarity, are stored in a
   trie; a traversal shares the partial overlap of a common path and
   prunes subtrees by remaining-length bounds.  A large group is cut into blocks of
   bounded size and every pair of blocks is its own task.  A task emits a
   spanning forest of the links it finds, and distributed union-find joins them.

Defined cases: NULL and wordless texts have an empty set and link with nothing;
a NULL id links with nothing; rows that repeat an id are rows of one
document, each with the component of its own text; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import connected_components, store
from gridmix.operators.joins import checked_broadcast, freeze

WIDTH = 5
BLOCK_SETS, BLOCK_SHINGLES = 2000, 2_000_000  # of one task's block of a group


SPACES = np.isin(np.arange(256), [32, *range(9, 14)])
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def runs(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each run ``values[start:end]``, from prefix sums of one polynomial."""
        n = len(values)
        if n >= len(self.up):
            one = np.ones(1, np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(2 * n, _BASE, np.uint64)]))
            self.down = np.cumprod(np.concatenate([one, np.full(2 * n, _INVERSE, np.uint64)]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[:n], dtype=np.uint64)])
        return _mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def words(self, raw: bytes) -> np.ndarray:
        """A hash of each word of a text (between ASCII white space)."""
        b = np.frombuffer(raw, np.uint8)
        edges = np.flatnonzero(np.diff(~SPACES[b], prepend=False, append=False))
        return self.runs(b.astype(np.uint64) + np.uint64(1), edges[::2], edges[1::2])


def shingles(text: str | None, powers: Powers, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes of a text (lower-cased A-Z, words between ASCII white space)."""
    w = powers.words((text or "").encode("utf-8", "replace").lower())
    if not len(w):
        return np.empty(0, np.int64)
    starts = np.arange(max(1, len(w) - width + 1))
    return np.unique(powers.runs(w, starts, starts + min(width, len(w))).view(np.int64))


def least_common(n: int) -> int:
    """Shingles that a set of n shares with any set it links to, at least."""
    return -(-4 * n // 5)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)]), pa.int64()))


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        sets = [shingles(t.as_py(), powers) for t in batch["text"]]
        digests = [_digest(s) for s in sets]
        yield pa.RecordBatch.from_arrays([
            batch["id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
            pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
            _lists([s[:len(s) - least_common(len(s)) + max(1, len(s) // 10)] for s in sets]),
        ], names=["id", "n", "digest", "key", "prefix"])


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        sets = [shingles(t.as_py(), powers) for t in batch["text"]]
        same = pa.array([_digest(s) == d.as_py() for s, d in zip(sets, batch["digest"], strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch[c] for c in ("key", "grp", "blocks")] + [_lists(sets)], names=["key", "grp", "blocks", "set"]).filter(same)


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.find(j)] = self.find(i)


class _Node:
    """Sets below a path of the trie; ``low`` and ``longest`` bound their sizes and trimmed lengths."""

    __slots__ = ("next", "low", "longest")

    def __init__(self) -> None:
        self.next: dict = {}  # shingle -> _Node, or (index, position) of the only set that goes on there
        self.low, self.longest = 1 << 60, 0


def join_sets(sets: list[np.ndarray], sides: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` (one side only), or between side 0 and side 1."""
    found: list[tuple[int, int]] = []
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, counts))] = np.arange(len(values))
    shared = counts[inverse] > 1
    ends = np.cumsum([0, *map(len, sets)])
    rows = [np.sort(rank[inverse[a:b][shared[a:b]]]) for a, b in zip(ends, ends[1:], strict=False)]
    trimmed = [r.tolist() for r in rows]
    sizes = [len(s) for s in sets]
    two = len(set(sides)) == 2
    roots, forest = (_Node(), _Node()), _Forest(len(sets))

    def insert(i: int) -> None:
        path, node, at = trimmed[i], roots[sides[i]], 0
        while True:
            node.low, node.longest = min(node.low, sizes[i]), max(node.longest, len(path))
            token = path[at] if at < len(path) else -1 - i  # a set that ends here has an entry of its own
            other = node.next.get(token)
            if other is None:
                node.next[token] = (i, at)
                return
            if isinstance(other, tuple):  # one more set goes on here: the first moves a step down
                j, _ = other
                node.next[token] = child = _Node()
                child.low, child.longest = sizes[j], len(trimmed[j])
                child.next[trimmed[j][at + 1] if at + 1 < len(trimmed[j]) else -1 - j] = (j, at + 1)
                other = child
            node, at = other, at + 1

    def probe(i: int) -> None:
        n, path = sizes[i], trimmed[i]
        mine = set(path)
        left = {t: len(path) - p - 1 for p, t in enumerate(path)}
        stack = [(roots[1 - sides[i]] if two else roots[0], 0, 0, len(path))]
        while stack:
            node, depth, common, rest = stack.pop()
            need = -(-80 * (n + node.low) // 180)
            if common + rest < need or common + node.longest - depth < need:
                continue
            for token, below in node.next.items():
                if isinstance(below, tuple):
                    j, at = below
                    if 5 * min(n, sizes[j]) < 4 * max(n, sizes[j]) or forest.find(i) == forest.find(j):
                        continue
                    both = common + len(mine.intersection(trimmed[j][at:]))
                    if 100 * both >= 80 * (n + sizes[j] - both):
                        forest.join(i, j)
                        found.append((i, j))
                elif token in mine:
                    stack.append((below, depth + 1, common + 1, left[token]))
                else:
                    stack.append((below, depth + 1, common, rest))

    for i in sorted(range(len(sets)), key=lambda i: sizes[i]):
        probe(i)
        insert(i)
    return found


def _tree_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins each run of equal ``(grp, one, two)`` in a task's sorted rows; sets are told apart by ``key``."""
    run, members = None, {}

    def links():
        keys = list(members)
        pairs = join_sets([members[k][1] for k in keys], [members[k][0] for k in keys]) if len(keys) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([keys[i] for i, _ in pairs], pa.int64()),
                                           pa.array([keys[j] for _, j in pairs], pa.int64())], names=["a", "b"])

    for batch in batches:
        for grp, one, two, key, mine, s in zip(*(batch[c] for c in ("grp", "one", "two", "key", "mine", "set")), strict=True):
            this = (grp.as_py(), one.as_py(), two.as_py())
            if this != run:
                if members:
                    yield links()
                run, members = this, {}
            members.setdefault(key.as_py(), (int(mine.as_py() != this[1]), s.values.to_numpy(zero_copy_only=False)))
    if members:
        yield links()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                       block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id`` (smallest id reachable by links, its own included)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = store(rows.mapInArrow(_prefixes, "id long, n long, digest binary, key long, prefix array<long>"))
    classes = freeze(sketch.filter("id is not null and n > 0").groupBy("digest").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("key").alias("key")))

    entries = sketch.filter("id is not null").select("key", "n", F.explode("prefix").alias("token"))
    repeated = entries.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    common = entries.join(repeated, "token").select("key", "n", "token", "rows").distinct()
    need = F.greatest(F.lit(1).cast("long"), F.expr("((4 * n + 4) div 5) div 10"))
    stars = store(common.withColumn("at", F.row_number().over(Window.partitionBy("key", "n").orderBy(F.desc("rows"), "token")))
                  .filter(F.col("at") >= need).select("key", "n", "token"))
    size = F.floor(F.log(F.col("n")) / F.lit(math.log(1.250001)))  # of linked classes equal, or neighbours
    stars = stars.select("key", "token", F.explode(F.array(size, size + 1)).alias("size"))
    least = stars.groupBy("token", "size").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo <> hi")
    groups = connected_components(stars.join(least, ["token", "size"]).filter("key <> lo").select("key", "lo").distinct(), "key", "lo")

    members = classes.join(groups.select(F.col("node").alias("key"), F.col("component").alias("grp")), "key")
    blocks = members.groupBy("grp").agg(F.ceil(F.greatest(
        F.sum("n") / F.lit(float(block_shingles)), F.count(F.lit(1)) / F.lit(float(block_sets)))).cast("int").alias("blocks"))
    placed = freeze(members.join(blocks, "grp").select("rep", "key", "digest", "grp", "blocks"))
    full = rows.join(checked_broadcast(placed, 1_000_000), rows["id"] == placed["rep"]).select("key", "digest", "grp", "blocks", "text")
    mine = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = (
        full.mapInArrow(_full, "key long, grp long, blocks int, set array<long>")
        .withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("grp", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), "key", "mine", "set")
    )
    links = dealt.repartition("grp", "one", "two").sortWithinPartitions("grp", "one", "two").mapInArrow(_tree_join, "a long, b long")
    components = freeze(connected_components(links, "a", "b").withColumnRenamed("node", "key"))

    linked_classes = classes.select("key", "rep").join(components, "key")
    lowest = linked_classes.groupBy("component").agg(F.min("rep").alias("low"))
    reps = classes.select("digest", "key", "rep").join(components.join(lowest, "component"), "key", "left").select(
        "digest", F.coalesce("low", "rep").alias("component"))
    linked = sketch.select("id", "n", "digest").join(reps, "digest", "left")
    return linked.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns kept."""
    gone = jaccard_components(docs, id_col, text_col, **options).filter(F.col(id_col) != F.col("component_id")).select(
        F.col(id_col).alias("_gone")).distinct()
    return docs.join(checked_broadcast(gone, 1_000_000), docs[id_col] == gone["_gone"], "left_anti")

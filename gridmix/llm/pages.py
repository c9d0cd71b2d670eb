"""Main text of web pages by nearest-URL page differencing.

Every page is cut into text blocks (its lines) in a Python task.  Pages of one host whose lines
are the same are classed by a 128-bit hash, and each class stands at its first
place by URL path and id.  The classes are ordered by host and place (a range partitioning, so a
host with a third of all pages spreads over many tasks), and each is aligned with
the nearest one of its host: the one before it, or the next for a host's first.
Lines in the longest common subsequence of the two are what the site
repeats (menus, notices, footers); they are deleted.  The first and last
class of each task meet in a table of two rows a task, so the neighbour, and
with it the text, does not depend on where the tasks are cut.

Two exact checks follow the differencing.  Lines inside an element that says
what it is (``nav``, ``footer``, ``aside``, ``form``, a class or id such as ``ad`` or
``comments``) are deleted also where no neighbour repeats them.  Lines inside an
``article`` or ``main`` element are the article: they stay even if the neighbour
shares them (articles quote each other), and a page with such an element has
no other text.

Only hashes of the lines are ordered and aligned.  The longest common subsequence is found in bit
rows (one big integer a line of the page), halved first (Hirschberg) where the rows would take more
than ``BITS``.

Defined cases: NULL, empty or markup-free input is taken as one text body;
copies of a page share its class and its text; the only class of a host has no neighbour and keeps
its lines; pages of equal URL are ordered by id, then by the hash of their lines (ties); a NULL URL is the
empty host and path; very long pages are aligned whole; unclosed tags end with the page, an unfinished tag at
the end of the page is markup; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import store
from gridmix.operators.joins import checked_broadcast

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPACES = re.compile(r"\s+")
#: Content up to the end tag is never text.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "noembed", "noframes"}
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "select", "button", "head"}
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark a part which is not the article.
MARKS = set("""
    ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion
    nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar tabs header masthead topbar
    footer sidebar aside widget widgets related recommended trending complementary contentinfo
    cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup login search
    comment comments respond reply replies disqus discussion share sharing social
""".split())

#: Where a line stands.
PLAIN, ARTICLE, MARKED = 0, 1, 2
BITS = 1 << 28  # of an alignment's rows in memory
SMALL = 200_000  # classes that may be broadcast
NUMBERS = 4_000_000  # places of lines that may be broadcast


def _marked(attributes: str) -> bool:
    for m in ATTRIBUTE.finditer(attributes):
        if MARKS & set(re.split(r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower())):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int]]:
    """Each text block of the page and where it stands: ``PLAIN``, ``ARTICLE`` (or main) or ``MARKED`` as boilerplate."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    articles, skipped, depth, at = 0, "", 0, 0  # skipped: the boilerplate element we are in, and how deep

    def flush() -> None:
        if text and (block := SPACES.sub(" ", html.unescape("".join(text))).strip()):
            out.append((block, MARKED if skipped else ARTICLE if articles else PLAIN))
        text.clear()

    while at < len(page):
        m = TAG.search(page, at)
        text.append(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name, closing, attributes = (m[2] or "").lower(), m[1] == "/", m[3] or ""
        if not name:
            continue
        content = name in ("article", "main")
        if name in RAW and not closing:
            end = re.compile(f"</{re.escape(name)}\\b[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif skipped:
            if name == skipped:
                depth += -1 if closing else not attributes.endswith("/")
            if not depth or (content and not closing and not articles and not _marked(attributes)):  # an article ends a part left open
                flush()
                skipped = ""
                articles += content and not closing
            elif name not in INLINE:
                flush()
        elif closing:
            if name not in INLINE:
                flush()
            articles -= content and articles > 0
        else:
            if name not in INLINE:
                flush()
            boiler = name in BOILERPLATE or (name == "header" and not articles) or (name not in ("html", "body") and _marked(attributes))
            if boiler and name not in VOID and not attributes.endswith("/"):
                flush()
                skipped, depth = name, 1
            elif content:
                articles += 1
            elif name in ("br", "img"):
                text.append(" ")
    flush()
    return out


def _bit_rows(a: list, b: list, keep: bool) -> list[int]:
    """Per item of ``a`` (or for the last alone) the places of ``b``, as zero bits, where the common length grows."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _lengths(a: list, b: list) -> np.ndarray:
    """The common length of ``a`` with each beginning of ``b``."""
    row = _bit_rows(a, b, keep=False)[0]
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.append(0, np.cumsum(1 - bits.astype(np.int64)))


def common(a: list, b: list, bits: int = BITS) -> list[int]:
    """The places of ``a`` in a longest common subsequence of ``a`` and ``b``."""
    low, high = 0, 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    ends = [*range(low), *range(len(a) - high, len(a))]
    in_a, in_b = set(a[low:len(a) - high]), set(b[low:len(b) - high])
    places = [i for i in range(low, len(a) - high) if a[i] in in_b]
    inner, other = [a[i] for i in places], [x for x in b[low:len(b) - high] if x in in_a]
    if not inner:
        return ends
    if len(inner) > 1 and len(inner) * len(other) > bits:
        half = len(inner) // 2
        cut = int((_lengths(inner[:half], other) + _lengths(inner[half:][::-1], other[::-1])[::-1]).argmax())
        found = common(inner[:half], other[:cut], bits) + [half + i for i in common(inner[half:], other[cut:], bits)]
    else:
        rows, found = _bit_rows(inner, other, keep=True), []
        i, j = len(inner) - 1, len(other) - 1
        while i >= 0 and j >= 0:
            if rows[i] >> j & 1:  # the length does not grow at j
                j -= 1
            elif i and not rows[i - 1] >> j & 1:  # it grew there before line i
                i -= 1
            else:
                found.append(i)
                i, j = i - 1, j - 1
    return sorted(ends + [places[i] for i in found])


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [blocks(x or "") for x in batch["html"]]
        urls = [_url(u) for u in batch["url"]]
        yield pd.DataFrame({
            "page_id": batch["page_id"], "url": batch["url"], "host": [h for h, _ in urls], "path": [p for _, p in urls],
            "lines": [[t for t, _ in x] for x in found], "places": [[i for _, i in x] for x in found],
        })


def _url(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
        return parts.netloc.lower(), parts.path
    except ValueError:
        return "", url or ""


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's sorted classes to the lines each shares with its neighbour; ``edge``: first (1) and last (2) of the task.

    ``open``: no class of the host stands before it in the task, so the one before it, if any, is in another task.
    """
    before, held = None, None  # held: the row before, not yet given

    def shared(row, neighbour):
        return common(row.hashes.tolist(), neighbour.hashes.tolist()) if neighbour is not None and neighbour.host == row.host else None

    def out(row, after, edge):
        alone = before is None or before.host != row.host
        return (row.host, row.c1, row.c2, shared(row, after if alone else before), edge, alone, *(
            (row.path, row.page_id, list(row.hashes)) if edge else (None, None, None)))

    names = ["host", "c1", "c2", "shared", "edge", "open", "path", "page_id", "hashes"]
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            if held is not None:
                rows.append(out(held, row, int(before is None)))
                before = held
            held = row
        if rows:
            yield pd.DataFrame(rows, columns=names, dtype=object)
    if held is not None:
        yield pd.DataFrame([out(held, None, 2 + (before is None))], columns=names, dtype=object)


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines that first and last classes of tasks share with a class of another task."""
    for batch in batches:
        yield pd.DataFrame({"host": batch["host"], "c1": batch["c1"], "c2": batch["c2"],
                            "shared": [common(a.tolist(), b.tolist()) for a, b in zip(batch["hashes"], batch["other"], strict=True)]})


def shared_lines(cut: DataFrame, kind: str) -> DataFrame:
    """``host, c1, c2, shared``: for each class of pages the places of the lines that its neighbour has too (NULL: no neighbour)."""
    place = F.struct("path", "page_id")
    classes = cut.groupBy("host", "c1", "c2").agg(F.min(place).alias("place"), F.any_value("hashes").alias("hashes")).select(
        "host", "place.path", "place.page_id", "c1", "c2", "hashes")
    order = ["host", "path", "page_id", "c1", "c2"]
    aligned = store(classes.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _align, f"host string, c1 long, c2 long, shared array<int>, edge int, open boolean, path string, page_id {kind}, hashes array<long>"))
    w = Window.orderBy(*order)  # at most two rows a task
    edges = aligned.filter("edge > 0").select(
        "*", F.lag(F.struct("host", "hashes")).over(w).alias("before"), F.lead(F.struct("host", "hashes")).over(w).alias("after"))
    other = F.when(F.col("open") & (F.col("edge") % 2 == 1) & (F.col("before.host") == F.col("host")), F.col("before.hashes")).when(
        F.col("open") & (F.col("edge") >= 2) & (F.col("after.host") == F.col("host")), F.col("after.hashes"))
    across = store(edges.select("host", "c1", "c2", "hashes", other.alias("other")).filter("other is not null").mapInPandas(
        _across, "host string, c1 long, c2 long, shared array<int>"))
    keys = ["host", "c1", "c2"]
    inside = aligned.select(*keys, "shared").join(checked_broadcast(across.select(*keys), SMALL), keys, "left_anti")
    return inside.unionByName(across)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, url_col, text`` (blocks in page order, joined by a line feed; empty if none), ``n_lines`` and ``n_shared``.

    ``n_shared`` of the page's ``n_lines`` lines stand in its neighbour, too.
    """
    kind = dict(pages.dtypes)[id_col]
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    stays = F.when(F.array_contains("places", ARTICLE), ARTICLE).otherwise(PLAIN)
    cut = store(
        rows.mapInPandas(_split, f"page_id {kind}, url string, host string, path string, lines array<string>, places array<int>")
        .withColumn("stays", stays).select(
            "page_id", "url", "host", "path", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
            F.xxhash64("lines").alias("c1"), F.xxhash64(F.lit("second"), "lines").alias("c2"), "stays",
            F.filter(F.arrays_zip(F.transform("lines", lambda _, i: i).alias("at"), "lines", "places"), lambda x: x["places"] == F.col("stays")).alias("kept"))
        .select("page_id", "url", "host", "path", "hashes", "c1", "c2", "stays",
                F.col("kept.at").alias("at"), F.col("kept.lines").alias("lines")))
    keys = ["host", "c1", "c2"]
    lists = shared_lines(cut, kind).filter("size(shared) > 0")
    if (lists.agg(F.sum(F.size("shared"))).first()[0] or 0) <= NUMBERS:
        lists = checked_broadcast(lists, SMALL)
    found = cut.join(lists, keys, "left")
    shared = F.coalesce("shared", F.array().cast("array<int>"))
    new = F.filter("lines", lambda _, i: ~F.array_contains(shared, F.get("at", i)))
    return found.select(
        F.col("page_id").alias(id_col), F.col("url").alias(url_col),
        F.array_join(F.when((F.col("stays") == ARTICLE) | (F.size(shared) == 0), F.col("lines")).otherwise(new), "\n").alias("text"),
        F.size("hashes").cast("long").alias("n_lines"), F.size(shared).cast("long").alias("n_shared"))

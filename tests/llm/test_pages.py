"""Main text of pages, on hand-made pages."""

from __future__ import annotations

import random

import pytest

from gridmix.llm import pages

HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p#x</style><style></style><script>var t='</p><article>';</script></head><body>"


def texts(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, text int")
    return {r.page_id: r.text for r in pages.extract(df).collect()}


def test_article_pages(spark):
    page = (HEAD + "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav><header><h1>Site</h1></header><div class='ad'>Buy</div>"
            "<article><header><h1>Title &amp; <i>more</i></h1></header><p>One\n  two&nbsp;three<br>four<p>Open <b>para"
            "<div class=\"share-bar\">Share</div><form><input><p>Form</p></form><aside>Side</aside><ul><li>a<li>b</ul>"
            "<!-- <p>no</p> --><p data-x='a>b'>Last &lt;tag&gt;</p><section id=comments><p>Comment</p><article>Reply</article></section></article>"
            "<div class='cookie notice'>Cookies</div><footer>&copy; x</footer></body></html>")
    got = texts(spark, [(1, "http://h/a/1", page), (2, "http://h/a/2", page), (3, None, None), (4, "http://h/a/3", ""), (5, "http://[bad", "just text")])
    want = "Title & more\nOne two three four\nOpen para\na\nb\nLast <tag>"
    assert got == {1: want, 2: want, 3: "", 4: "", 5: "just text"}


def test_an_article_ends_an_open_part_and_shared_lines_of_articles_stay(spark):
    same = "<nav><p>menu<article><p>Shared line</p>{}</article>"
    got = texts(spark, [(i, f"http://h/{i}", HEAD + same.format(f"<p>own {i}")) for i in range(3)])
    assert got == {i: f"Shared line\nown {i}" for i in range(3)}


def test_unmarked_pages_lose_what_neighbours_share(spark):
    page = HEAD + "<div>Home</div><div>News</div><div>{}</div><div>{}</div><div>Contact us</div>"
    rows = [(i, f"http://h/n/{i:03}", page.format(f"story {i}", f"end {i}")) for i in range(40)]
    rows += [(100 + i, "http://copy/x", page.format("copy", "copy end")) for i in range(3)]
    got = texts(spark, rows)
    alone = [k for k in range(40) if got[k] != f"story {k}\nend {k}"]
    assert alone == []
    assert {got[100 + i] for i in range(3)} == {"Home\nNews\ncopy\ncopy end\nContact us"}  # no different page to align with


def plain_common(a, b):
    """Length of the longest common subsequence by the plain table."""
    above = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        above = row
    return above[-1]


@pytest.mark.parametrize("bits", [1 << 28, 6])
def test_longest_common_subsequence(bits):
    rng = random.Random(5)
    for _ in range(400):
        a, b = ([rng.randrange(rng.choice((2, 5, 30))) for _ in range(rng.randrange(25))] for _ in range(2))
        got = pages.common(a, b, bits)
        assert got == sorted(set(got)) and len(got) == plain_common(a, b)
        rest = iter(b)
        assert all(x in rest for x in (a[i] for i in got))  # in b's order, too
    assert len(pages.common(list("XYZpqrs"), list("p1q2r3s4XYZ"), bits)) == 4
    assert len(pages.common([1] * 3000 + [2], [2] + [1] * 2000)) == 2000


def plain_texts(rows):
    """The operator on pages of plain ``div`` lines: neighbours by sorted distinct pages of each host."""
    lines = {i: tuple(t for t, _ in pages.blocks(h)) for i, _, h in rows}
    hosts = {}
    for i, url, _ in rows:
        host, path = pages._url(url)
        places = hosts.setdefault(host, {})
        places[lines[i]] = min(places.get(lines[i], (path, i)), (path, i))
    out = {}
    for i, url, _ in rows:
        order = sorted(hosts[pages._url(url)[0]].items(), key=lambda x: x[1])
        at = [x for x, _ in order].index(lines[i])
        near = order[at - 1][0] if at else order[1][0] if len(order) > 1 else ()
        gone = pages.common(list(lines[i]), list(near))
        out[i] = "\n".join(x for k, x in enumerate(lines[i]) if k not in gone)
    return out


@pytest.mark.parametrize("tasks", [1, 8, 200])
def test_text_does_not_depend_on_tasks(spark, tasks):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        host = rng.choice(("a", "a", "b", "c", f"h{i % 40}"))
        lines = ["Home", "News"] * rng.randrange(2) + [f"story {rng.randrange(60)}" for _ in range(rng.randrange(5))] + ["Contact us"]
        rows.append((i, f"http://{host}/p/{rng.randrange(80)}", "".join(f"<div>{x}</div>" for x in lines)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert texts(spark, rows) == plain_texts(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_copies_of_a_page_are_cleaned(spark):
    page = "<div>Home</div><div>{}</div><div>Contact</div>"
    got = texts(spark, [(i, f"http://h/{i:05}", page.format("copy")) for i in range(5000)] + [(9000, "http://h/9", page.format("last"))])
    assert set(got.values()) == {"copy", "last"}


def test_marked_lines_are_aligned_and_go_without_a_neighbour(spark):
    df = spark.createDataFrame(
        [(k, f"http://h/{k}", f"<nav>Menu</nav><div>Home</div><div>own {k}</div><div class=ad>Buy {k}</div>") for k in (1, 2)]
        + [(3, "http://x/", "<nav>Menu</nav><div>own</div>"), (None, None, "<nav>Menu</nav><p>no id</p>")], "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_lines, r.n_shared) for r in pages.extract(df).collect()}
    assert got == {1: ("own 1", 4, 2), 2: ("own 2", 4, 2), 3: ("own", 2, 0), None: ("no id", 2, 0)}


def test_truncated_and_long_pages(spark):
    long = "<article>" + "".join(f"<p>para {i}</p>" for i in range(5000))
    got = texts(spark, [(1, "u", "<article><p>text &am"), (2, "u", "<article><p>text</p><foo"), (3, "u", long), (4, "u", "<article><p>a < b</p>"), (5, "u", "<script>x")])
    assert got[1] == "text &am" and got[2] == "text" and got[3].count("\n") == 4999 and got[4] == "a < b" and got[5] == ""


def test_empty_table(spark):
    assert texts(spark, []) == {}

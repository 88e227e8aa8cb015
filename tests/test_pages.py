"""Elements of broken and odd pages."""

from __future__ import annotations

import random
import time

import pytest

from skulink.sources import pages as pg


def inner(html: str, tag: str) -> list[str]:
    return [html[e.tag[1]:e.end] for e in pg.page_elements(html) if e.name == tag]


@pytest.mark.parametrize("html, tag, want", [
    ("<p>1<p>2<div>3</div><p>4", "p", ["1", "2", "4"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x", "li", ["a", "b<ul><li>c</ul>", "c", "d"]),
    ("<li><p>a<li><p>b", "p", ["a", "b"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", "dd", ["b"]),
    ("<select><option>a<option>b</select>c", "option", ["a", "b"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>z", "td", ["1", "2", "3"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>z", "tr", ["<td>1<td>2", "<td>3"]),
    ("<table><tr><td><table><tr></td><td>in</table>out</td></tr></table>", "td",
     ["<table><tr></td><td>in</table>out", "in"]),
    ("<b><table><td>x</b>y</td></table></b>q", "b", ["<table><td>x</b>y</td></table>"]),
    ("</b>a<b>c</i>d</b>e", "b", ["c</i>d"]),
    ("<div>a<br>b<img src=x>c<hr/>d</div>e", "div", ["a<br>b<img src=x>c<hr/>d"]),
    ("<div>a<br>b</div>", "br", [""]),
    ("<!-- <p>no</p> --><p>a<!-- </p> -->b</p>", "p", ["a<!-- </p> -->b"]),
    ("<p>a<script>'</p><p>'</SCRIPT >b</p>", "p", ["a<script>'</p><p>'</SCRIPT >b"]),
    ("<title>a <p> b</title><p>c", "p", ["c"]),
    ("<a href=/x/>y</a><a href=\"/z\"/>q<a t=\"a>b\" u='>'>r</a><a x=\"y>s", "a", ["y", "", "r", "s"]),
    ("<P Class=x>a</p ><p>b<", "p", ["a", "b<"]),
    ("<p>a</p><p class=", "p", ["a"]),
    ("<p>a<!-- open <p>b", "p", ["a<!-- open <p>b"]),
    ("", "p", []), ("plain > text <", "p", []),
])
def test_elements_of_broken_pages(html, tag, want):
    assert inner(html, tag) == want


def tree(r: random.Random, depth: int, made: list) -> tuple[str, str]:
    """A random element as (markup, markup with end tags left out where the rules allow)."""
    name = r.choice(["div", "ul", "span", "table"] if depth else ["span"])
    kids = {"ul": ["li"], "table": ["tr"], "tr": ["td"]}

    def build(name: str, depth: int) -> tuple[str, str]:
        mark = f"t{len(made)} "
        made.append((name, mark))
        full, short = mark, mark
        if depth > 0:
            for _ in range(r.randint(0, 3)):
                child = r.choice(kids.get(name, ["div", "ul", "b", "table", "span"]))
                f, s = build(child, depth - 1)
                full, short = full + f, short + s
        end = "" if name in ("li", "tr", "td") and r.random() < 0.6 else f"</{name}>"
        return f"<{name}>{full}</{name}>", f"<{name}>{short}{end}"
    return build(name, depth)


def test_left_out_end_tags_change_no_element():
    r = random.Random(8)
    strip = lambda h: pg.re.sub(r"<[^>]*>", "", h)
    for _ in range(300):
        made: list = []
        full, short = tree(r, 6, made)
        a, b = pg.page_elements(full), pg.page_elements(short)
        assert [e.name for e in a] == [n for n, _ in made] == [e.name for e in b]
        assert ([strip(full[e.tag[1]:e.end]) for e in a] == [strip(short[e.tag[1]:e.end]) for e in b])
        assert [e.last for e in a] == [e.last for e in b]
        # an element's last descendant, from the balanced markup itself
        for i, e in enumerate(a):
            assert e.last == i + full[e.tag[1]:e.end].count("<") // 2


@pytest.mark.parametrize("html", [
    "<p>x" * 100_000, "<div>" * 100_000, "<b></i>" * 50_000, "<ul><li>" * 50_000, "<div>a</div>" * 50_000,
    "<b " * 50_000, '<b "' * 50_000, "<!" * 50_000, "<!--" * 50_000, "<a b='c\" >" * 20_000, "<a" + " = " * 50_000,
    "<" * 100_000, "<a b=a=a=a" * 20_000 + "/>"])
def test_one_pass_whatever_the_page(html):
    start = time.time()
    pg.page_elements(html)
    assert time.time() - start < 5


def test_unclosed_elements_in_rules(spark):
    html = ("<ul class=hits><li class='hit x'>Item # 1<li class=HIT>Item # no<li class=\"hit\">Item # 2<p data-id=7>p"
            "<ul><li class=hit>Item # 3</ul></ul><li class=hit>Item # outside")
    pages = spark.createDataFrame([(1, "u", html, "x"), (2, "u", None, "x"), (3, "u", "", "x"), (4, "u", html, "x")],
                                  "page_id long, url string, html string, rank string")
    hit = pg.ListingRule("LI", "hit", contains="#", delimiter="#", within=pg.ListingRule("ul", "hits"))
    got = pg.extract_listing_ids(pages, hit).collect()
    want = [(1, "1"), (2, "2pItem # 3"), (3, "3")]
    assert sorted((r.page_id, r.rank, r.product_id) for r in got) == [
        (i, k, v) for i in (1, 4) for k, v in want]
    by_attr = pg.ListingRule("p", attrs={"DATA-ID": "7"})
    assert {r.product_id for r in pg.extract_listing_ids(pages, by_attr).collect()} == {"p"}
    # an element inside two enclosing ones counts for each
    twice = pg.ListingRule("li", "hit", within=pg.ListingRule("ul"))
    assert [r.product_id for r in pg.extract_listing_ids(pages.where("page_id = 1"), twice).collect()].count(
        "Item # 3") == 2
    assert pg.extract_listing_ids(pages.limit(0), hit).count() == 0

"""Product ids out of crawled listing pages.

The live site search is replaced by a table of crawled pages
``(page_id, url, html)``.  Elements are found in one pass over a page's tags
with a stack of the open elements, so the work is linear in the page:

* void elements (``br``, ``img`` ...) and ``<x/>`` have no content; comments,
  declarations and the text of ``script``, ``style``, ``title`` and ``textarea``
  hold no tags;
* end tags may be missing: a new ``li`` closes the open one of its list, a block
  element closes an open ``p``, likewise ``dt``/``dd``, ``option`` and the parts of
  tables; an end tag closes everything that was opened inside its element, and the
  page's end closes the rest; a tag that the page ends in is none;
* an end tag without its element is ignored, also if the element is open outside
  of the table cell (or caption) that the tag stands in.

Tag and attribute names match in any case, attribute values as written, in
either quote or none; an element may be asked for inside another one.  Only
this pass runs in Python, in Arrow batches; the rest is built-in functions.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.functions.text import EDGE_SPACE_RE, strip_parens, text_after

# Fixed values of HTML: elements without content, elements whose content is text, elements
# that close an open paragraph, and per element the open ones it closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search "
    "section summary table ul".split())
CELLS = ("caption", "table", "td", "th")
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu", *CELLS)),
    "dt": (("dt", "dd"), ("dl", *CELLS)),
    "dd": (("dt", "dd"), ("dl", *CELLS)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "caption", "colgroup"), ("table", "thead", "tbody", "tfoot")),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup", "tr"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup", "tr"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup", "tr"), ("table",)),
}
TABLE_PARTS = frozenset("caption table td th tr thead tbody tfoot colgroup".split())

# Character references decoded in element text (the common five).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


@dataclass(frozen=True)
class ListingRule:
    """Where a listing shows a product id and how to cut it out.

    ``tag``: the element's name; ``css_class``: one of its classes (None: any);
    ``attrs``: attributes it must have, with a value or just be there (None);
    ``within``: a rule of the element that must enclose it; ``contains``: keep
    only elements whose markup holds this text (F5); ``delimiter``: keep the
    text after its first occurrence (X18); ``strip_parens``: drop parentheses
    (X19).
    """
    tag: str
    css_class: str | None = None
    contains: str | None = None
    delimiter: str | None = None
    strip_parens: bool = False
    attrs: dict[str, str | None] = field(default_factory=dict)
    within: "ListingRule | None" = None


# A quote counts after "=" only, and only if it is closed.  Possessive, so each character is read once.
MARKUP_RE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"""(?P<attrs>(?:[^>=]|=\s*+(?:"[^"]*"|'[^']*'|))*+)(?P<close>>|\Z)""", re.S)
UNQUOTED_END_RE = re.compile(r"""=\s*[^\s"'=][^\s"'=]*/\Z""")
ATTRIBUTE_RE = re.compile(
    r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
RAW_END_RE = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW_TEXT}


@dataclass
class Element:
    """An element of a page: its start tag, where its content lies, and the last one inside it."""
    name: str
    attrs: str
    tag: tuple[int, int]
    end: int = -1
    last: int = -1


def page_elements(html: str) -> list[Element]:
    """All elements of a page in the order of their start tags, in one pass."""
    found: list[Element] = []
    stack: list[int] = []                   # open elements, outermost first
    depths: dict[str, list[int]] = {}       # name -> where on the stack

    def deepest(names) -> int:
        return max((depths[n][-1] for n in names if depths.get(n)), default=-1)

    def close(depth: int, at: int) -> None:
        """Close the stack down to ``depth``: the content of what is closed ends at ``at``."""
        while len(stack) > depth:
            e = found[stack.pop()]
            depths[e.name].pop()
            e.end, e.last = at, len(found) - 1

    def imply(names, bounds, at: int) -> None:
        """Close the outermost open element of ``names`` inside the nearest of ``bounds``."""
        bound = deepest(bounds)
        inside = [depths[n][bisect_right(depths[n], bound)] for n in names
                  if depths.get(n) and depths[n][-1] > bound]
        if inside:
            close(min(inside), at)

    at = 0
    while (m := MARKUP_RE.search(html, at)) is not None:
        at = m.end()
        if m["name"] is None:
            continue
        if not m["close"]:
            break            # the page ends inside a tag
        name = m["name"].lower()
        if m["end"]:
            depth = deepest((name,))
            bounds = () if name == "table" else ("table",) if name in TABLE_PARTS else CELLS
            if depth > deepest(bounds):
                close(depth, m.start())
            continue
        if name in CLOSES_P:
            imply(("p",), CELLS, m.start())
        if name in IMPLIED_END:
            imply(*IMPLIED_END[name], m.start())
        attrs = m["attrs"]
        e = Element(name, attrs, (m.start(), m.end()))
        found.append(e)
        if name in VOID or (attrs.endswith("/") and not UNQUOTED_END_RE.search(attrs)):
            e.end, e.last = m.end(), len(found) - 1
        elif name in RAW_TEXT:
            stop = RAW_END_RE[name].search(html, at)
            e.end = at = stop.start() if stop else len(html)
            e.last = len(found) - 1
        else:
            depths.setdefault(name, []).append(len(stack))
            stack.append(len(found) - 1)
    close(0, len(html))
    return found


def fits(e: Element, rule: ListingRule) -> bool:
    """Whether an element is one that the rule asks for (not looking at ``within``)."""
    if e.name != rule.tag.lower():
        return False
    if rule.css_class is None and not rule.attrs:
        return True
    attrs: dict[str, str] = {}
    for name, *values in ATTRIBUTE_RE.findall(e.attrs):
        attrs.setdefault(name.lower(), entities.unescape("".join(values)))     # the first one counts
    return ((rule.css_class is None or rule.css_class in attrs.get("class", "").split())
            and all(k.lower() in attrs and v in (None, attrs[k.lower()]) for k, v in rule.attrs.items()))


def matching(found: list[Element], rule: ListingRule) -> list[int]:
    """Numbers of a rule's elements in order; inside two enclosing ones an element counts twice."""
    own = [i for i, e in enumerate(found) if fits(e, rule)]
    if rule.within is None:
        return own
    return [i for k in matching(found, rule.within)
            for i in own[bisect_right(own, k):bisect_left(own, found[k].last + 1)]]


def elements(markup: Column, rule: ListingRule) -> Column:
    """Elements of a markup in order: array of struct m (with tags), t (inner markup)."""
    @F.pandas_udf("array<struct<m:string,t:string>>")
    def of_pages(pages: pd.Series) -> pd.Series:
        out = []
        for html in pages:
            row = []
            if html:
                found = page_elements(html)
                for e in (found[i] for i in matching(found, rule)):
                    inner = html[e.tag[1]:e.end]
                    row.append({"m": f"{html[slice(*e.tag)]}{inner}</{rule.tag}>", "t": inner})
            out.append(row)
        return pd.Series(out)

    return of_pages(markup)


def element_text(inner) -> Column:
    """Text of an element's inner markup: tags removed, entities decoded, trimmed."""
    s = F.regexp_replace(inner, r"<[^>]+>", "")
    for ent, ch in ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return F.regexp_replace(s, EDGE_SPACE_RE, "")


def extract_listing_ids(pages: DataFrame, rule: ListingRule) -> DataFrame:
    """``page_id, rank, product_id`` for every matching element, in page order."""
    x = pages.select("page_id", F.posexplode(elements(F.col("html"), rule)).alias("i", "e"))
    if rule.contains is not None:
        x = x.where(F.col("e.m").contains(rule.contains))
    v = element_text(F.col("e.t"))
    if rule.delimiter is not None:
        v = text_after(v, rule.delimiter)
    if rule.strip_parens:
        v = strip_parens(v)
    v = F.regexp_replace(v, EDGE_SPACE_RE, "")
    return x.select("page_id", (F.col("i") + 1).alias("rank"), v.alias("product_id"))


HREF_RE = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"


def hrefs(markup: Column) -> Column:
    """The href of every ``<a>`` in a markup, in order."""
    quoted = F.regexp_extract_all(markup, F.lit(HREF_RE), F.lit(0))
    return F.transform(quoted, lambda m: F.regexp_extract(
        F.regexp_extract(m, r"(?is)href\s*=\s*([\"'].*)$", 1), r"(?s)^.(.*).$", 1))


def extract_links(pages: DataFrame, within: ListingRule | None = None) -> DataFrame:
    """``page_id, rank, href`` of every ``<a href>`` in page order (of an element's only)."""
    found = (hrefs(F.col("html")) if within is None else
             F.flatten(F.transform(elements(F.col("html"), within), lambda e: hrefs(e["t"]))))
    return pages.select("page_id", F.posexplode(found).alias("i", "href")).select(
        "page_id", (F.col("i") + 1).alias("rank"), "href")


def heading_key(pages: DataFrame) -> DataFrame:
    """Detail-page key: '/' + first word of the page's ``<h1>``."""
    h1 = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return pages.select(F.col("page_id").alias("detail_page_id"),
                        F.concat(F.lit("/"), F.split(h1, " ", 2)[0]).alias("key"))


def url_key(pages: DataFrame) -> DataFrame:
    """Detail-page key: the page's own URL."""
    return pages.select(F.col("page_id").alias("detail_page_id"), F.col("url").alias("key"))


def two_hop_ids(pages: DataFrame, rule: ListingRule, base_url: str = "", key: str = "heading",
                links_in: ListingRule | None = None) -> DataFrame:
    """J8 + P6: listing link -> detail page -> first product id on that page.

    ``base_url`` + href is matched against the detail pages' key: their URL
    (``key="url"``) or a path from their heading.  ``links_in`` keeps the
    links of a listing element only.  Both sides are equi-joined (shuffle
    hash/sort-merge; AQE broadcasts a small side from runtime sizes).
    """
    links = extract_links(pages, links_in).withColumn("key", F.concat(F.lit(base_url), F.col("href")))
    details = {"heading": heading_key, "url": url_key}[key](pages)
    ids = extract_listing_ids(pages, rule).where(F.col("rank") == 1).select(
        F.col("page_id").alias("detail_page_id"), "product_id")
    # a page's key and id meet first: the links' many rows are joined once and not moved again
    return (links.join(details.join(ids, "detail_page_id"), "key")
            .select("page_id", "rank", "href", "detail_page_id", "product_id"))

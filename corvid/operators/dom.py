"""HTML as trees and as a relation of nodes, and queries over them.

trees() parses a page once into a row: its elements in document order and its visible text. Pre-order numbers give containment
(enter < x <= exit), order and siblings; an element's text is a span of the page's text. So each query is a column over the row: no join, no
shuffle, however many queries a plan has. html_nodes() gives the nodes as rows, for counts and joins over many pages. Page is the
tree in Python for extractions that need many fields of a page in one pass.

Repair: void elements never open; a p is closed by a block start or another p, also through open inline tags; li, dt/dd, tr,
td/th and option close their own kind; an end tag without a start is dropped.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..functions.text import clean, first_nonempty
from ..functions.urls import resolved
from ..ship import cut, ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
HIDDEN = frozenset(("script", "style", "template"))


class Node:
    __slots__ = ("attrs", "children", "depth", "enter", "exit", "parent", "tag", "text")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None, enter: int, text: str = ""):
        self.tag, self.attrs, self.parent, self.enter, self.exit, self.text = tag, attrs, parent, enter, enter, text
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []

    def walk(self) -> Iterator[Node]:
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.children))

    def strings(self) -> Iterator[str]:
        """Text below, without that of scripts, styles and templates."""
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if node.tag == "#text":
                yield node.text
            elif node.tag not in HIDDEN:
                stack.extend(reversed(node.children))

    def raw(self) -> str:
        return " ".join(self.strings())

    def cleaned(self) -> str:
        return clean(self.raw())

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#document", {}, None, 0)
        self.open, self.count = [self.root], 0

    def _add(self, tag: str, attrs: dict[str, str], text: str = "") -> Node:
        self.count += 1
        node = Node(tag, attrs, self.open[-1], self.count, text)
        self.open[-1].children.append(node)
        return node

    def _close(self, at: int) -> None:
        for node in self.open[at:]:
            node.exit = self.count
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == "p":
                    self._close(i)
                    break
                if self.open[i].tag in BLOCK or self.open[i].tag in ("td", "th", "button", "object"):
                    break
        if tag in CLOSES:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in SCOPES[tag]:
                    break
                if self.open[i].tag in CLOSES[tag]:
                    self._close(i)
        known: dict[str, str] = {}
        for k, v in attrs:
            known.setdefault(k, v or "")
        node = self._add(tag, known)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._close(i)
                return

    def handle_data(self, data: str) -> None:
        self._add("#text", {}, data)


class Page:
    """A parsed page; queries give nodes in document order."""

    def __init__(self, html: str | None):
        builder = _Builder()
        builder.feed(html or "")
        builder.close()
        builder._close(1)
        builder.root.exit = builder.count
        self.root = builder.root
        self.nodes = list(self.root.walk())

    def first(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.nodes if n.tag != "#text" and test(n)), None)

    def by_id(self, name: str) -> Node | None:
        return self.first(lambda n: n.attrs.get("id") == name)

    def by_class(self, name: str) -> Node | None:
        return self.first(lambda n: n.has_class(name))

    def tag(self, *names: str) -> Node | None:
        return self.first(lambda n: n.tag in names)

    def meta(self, key: str) -> str:
        for kind in ("property", "name"):
            tag = self.first(lambda n, k=kind: n.tag == "meta" and n.attrs.get(k) == key)
            if tag and tag.attrs.get("content"):
                return clean(tag.attrs["content"])
        return ""

    def densest(self, least: int = 3) -> Node | None:
        """The div, article or section with most paragraphs as its own children, at least `least`; the first of equals."""
        counted = [(sum(c.tag == "p" for c in n.children), -n.enter, n) for n in self.nodes if n.tag in ("div", "article", "section")]
        best = max(counted, key=lambda x: x[:2], default=(0, 0, None))
        return best[2] if best[0] >= least else None

    def before(self, node: Node | None, tag: str) -> Node | None:
        """The nearest element of a kind that starts before node."""
        return next((n for n in reversed(self.nodes) if node and n.enter < node.enter and n.tag == tag), None)


def body_text(body: Node) -> str:
    return clean(" ".join(p.raw() for p in body.all("p")))


def _pages_anchors(html: str | None) -> list[tuple[int, str, str, str, bool]]:
    page = Page(html)
    listed = [n for n in page.nodes if n.tag == "a" and "href" in n.attrs]
    steps = page.first(lambda n: n.tag == "ol" and n.has_class("index-pagination"))
    onward = next((n for n in listed if steps and steps.enter < n.enter <= steps.exit and "next" in n.raw().strip().lower()), None)
    return [(i, n.attrs["href"], n.cleaned(), clean(n.attrs.get("aria-label", "")), n is onward) for i, n in enumerate(listed)]


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """The other columns of pages with pos, href, text, aria_label and is_next of each anchor: is_next marks the first anchor of the page's
    ol.index-pagination whose text holds "next"."""
    ship(pages.sparkSession)
    rest = [c for c in pages.columns if c != html]

    @F.pandas_udf("array<struct<pos:int,href:string,text:string,aria_label:string,is_next:boolean>>")
    def found(column: pd.Series) -> pd.Series:
        return column.map(lambda x: [dict(zip(("pos", "href", "text", "aria_label", "is_next"), a, strict=True)) for a in _pages_anchors(x)])

    return pages.select(*rest, F.explode(found(html)).alias("a")).select(*rest, "a.*")


def followed(pages: DataFrame, start: str, most: int) -> DataFrame:
    """page (1, 2, ...), url, html: the listing at `start` and those its next-page links lead to, at most `most`. pages: url, html.

    The links are taken once, then composed with themselves: k rounds reach 2^k pages. A page has the number of its first visit, so loops end.
    """
    links = anchors(pages.where("url is not null")).where("is_next").groupBy("url").agg(F.min_by("href", "pos").alias("href"))
    hop = cut(links.select("url", resolved("url", "href").alias("onward")))
    reach, width = pages.where(F.col("url") == start).select("url").distinct().withColumn("page", F.lit(1)), 1
    while width < most:
        far = reach.join(hop, "url").select(F.col("onward").alias("url"), (F.col("page") + width).alias("page"))
        reach = cut(reach.unionByName(far).groupBy("url").agg(F.min("page").alias("page")))
        width *= 2
        if width < most:
            hop = cut(hop.alias("a").join(hop.alias("b"), F.col("a.onward") == F.col("b.url")).select("a.url", "b.onward"))
    return pages.join(reach.where(F.col("page") <= max(most, 1)), "url").select("page", "url", "html")


def labelled(links: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, section: the first label (slug, name, i) that one of the page's links (page_id, href, text) names and leads to."""
    hit = links.join(F.broadcast(labels), (F.lower("text") == F.lower("name")) & F.col("href").contains(F.concat(F.lit("/"), "slug")))
    return hit.groupBy("page_id").agg(F.min_by("name", "i").alias("section"))


NODE_SCHEMA = "page_id bigint, node_id int, parent_id int, enter int, exit int, depth int, tag string, attrs map<string,string>, own_text string"


def html_nodes(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """The node relation of pages; text is rows of tag #text. node_id is the pre-order number, 0 the document (not a row)."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for pid, markup in zip(batch["page_id"], batch["html"], strict=True):
                for n in Page(markup).nodes:
                    rows.append((pid, n.enter, n.parent.enter, n.enter, n.exit, n.depth, n.tag, n.attrs, n.text))
            yield pd.DataFrame(rows, columns=["page_id", "node_id", "parent_id", "enter", "exit", "depth", "tag", "attrs", "own_text"])

    return pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(html).alias("html")).where("page_id is not null").mapInPandas(run, NODE_SCHEMA)


TREE_SCHEMA = (
    "page_id bigint, shown string, nodes array<struct<enter:int,exit:int,parent_id:int,depth:int,tag:string,attrs:map<string,string>,text_at:int,text_end:int,paragraphs:int>>"
)


def _tree(markup: str | None) -> tuple[str, list[dict]]:
    """The page's visible text, its text nodes in order with a space between, and its elements with their spans of it and their number of own
    paragraphs."""
    page = Page(markup)
    hidden_to, at, texts, starts, orders = 0, 0, [], [], []
    for n in page.nodes:
        if n.tag in HIDDEN:
            hidden_to = max(hidden_to, n.exit)
        elif n.tag == "#text" and n.enter > hidden_to:
            orders.append(n.enter)
            starts.append(at)
            texts.append(n.text)
            at += len(n.text) + 1
    rows = []
    for n in page.nodes:
        if n.tag != "#text":
            first, last = bisect_right(orders, n.enter), bisect_right(orders, n.exit)
            span = (starts[first], starts[last - 1] + len(texts[last - 1])) if last > first else (0, 0)
            rows.append({"enter": n.enter, "exit": n.exit, "parent_id": n.parent.enter, "depth": n.depth, "tag": n.tag, "attrs": n.attrs, "text_at": span[0], "text_end": span[1], "paragraphs": sum(c.tag == "p" for c in n.children)})
    return " ".join(texts), rows


def trees(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, shown, nodes: one row for each page, parsed once. Rows without a page_id go; a null page has no nodes."""
    ship(pages.sparkSession)
    kinds = to_arrow_schema(_parse_datatype_string(TREE_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # a page's elements are several times its size
                part = batch.slice(at, 64)
                parsed = [_tree(x) for x in part.column(1).to_pylist()]
                # as pairs, which maps are read from
                for _, rows in parsed:
                    for r in rows:
                        r["attrs"] = list(r["attrs"].items())
                columns = [part.column(0).cast(pa.int64()), pa.array([x for x, _ in parsed], pa.string()), pa.array([x for _, x in parsed], kinds.field("nodes").type)]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(html).alias("html")).where("page_id is not null").mapInArrow(run, TREE_SCHEMA)


def elements(test: Callable[[Column], Column], nodes: Column | str = "nodes") -> Column:
    """The elements of a tree that pass, in document order."""
    return F.filter(nodes, test)


def first_element(test: Callable[[Column], Column]) -> Column:
    return F.get(elements(test), F.lit(0))


def text_in(element: Column) -> Column:
    """An element's raw text: the text nodes below it in order, a space between, hidden ones left out; null without an element."""
    return F.substring(F.col("shown"), element["text_at"] + 1, element["text_end"] - element["text_at"])


def inside(element: Column, tag: str) -> Column:
    """The elements of a kind below an element."""
    return elements(lambda n: (n["tag"] == tag) & (n["enter"] > element["enter"]) & (n["enter"] <= element["exit"]))


def paragraphs_of(body: Column) -> Column:
    """Raw paragraph texts of a body in order, a space between."""
    return F.array_join(F.transform(inside(body, "p"), text_in), " ")


def densest_container(least: int = 3) -> Column:
    """The div, article or section with most own paragraphs, at least `least`; the first of equals."""
    held = elements(lambda n: n["tag"].isin("div", "article", "section") & (n["paragraphs"] >= least))
    order = F.transform(held, lambda n: F.struct(n["paragraphs"], (-n["enter"]).alias("before"), n["enter"].alias("enter")))
    best = F.array_max(order)["enter"]
    return first_element(lambda n: n["enter"] == best)


def chain_container(ids: list[str]) -> tuple[Column, Column]:
    """The element with the first id of the chain that there is, and that id's place (from 1)."""
    place = lambda n: F.array_position(F.array(*map(F.lit, ids)), n["attrs"]["id"])
    rank = F.array_min(F.transform(elements(lambda n: place(n) > 0), place))
    return first_element(lambda n: place(n) == rank), rank


def nearest_before(tag: str, anchor: str) -> Column:
    """The last `tag` that starts before the first `anchor`."""
    limit = first_element(lambda n: n["tag"] == anchor)["enter"]
    found = elements(lambda n: (n["tag"] == tag) & (n["enter"] < limit))
    return F.get(found, F.size(found) - 1)


def next_sibling(anchor: str, tag: str) -> Column:
    """The first `tag` after the first `anchor` under the same parent."""
    first = first_element(lambda n: n["tag"] == anchor)
    return first_element(lambda n: (n["tag"] == tag) & (n["enter"] > first["exit"]) & (n["parent_id"] == first["parent_id"]))


def meta_content(key: str) -> Column:
    """The content of the first meta of that property, else of that name; empty where neither says anything, null without a meta of it."""
    def by_kind(kind: str) -> Column:
        return first_element(lambda n: (n["tag"] == "meta") & (n["attrs"][kind] == key))

    by = [by_kind("property"), by_kind("name")]
    return F.when(by[0].isNotNull() | by[1].isNotNull(), first_nonempty(*[x["attrs"]["content"] for x in by]))


def resolve_sections(anchors: DataFrame, primary: DataFrame) -> DataFrame:
    """page_id, section, subsection from a page's navigation.

    anchors: page_id, pos, segs (path segments), label (cleaned, not empty); primary: page_id, primary. category/<parent>/<child>... names
    a child; one segment, or category/<x>, names a top section. First anchors win; labels match regardless of case.
    """
    from ..functions.text import slug_label

    n, seg = F.size("segs"), F.col("segs")
    child = anchors.where((n >= 3) & (F.get(seg, 0) == "category")).groupBy("page_id", F.lower("label").alias("key")).agg(F.min_by(F.struct(F.get(seg, 1).alias("slug"), "label"), "pos").alias("c"))
    top = anchors.where((n == 1) | ((n == 2) & (F.get(seg, 0) == "category"))).groupBy("page_id", F.get(seg, n - 1).alias("slug")).agg(F.min_by("label", "pos").alias("top"))
    hit = primary.withColumn("key", F.lower("primary")).join(child, ["page_id", "key"], "left").withColumn("slug", F.col("c.slug")).join(top, ["page_id", "slug"], "left")
    found = F.col("c").isNotNull() & (F.col("primary") != "")
    return hit.select(
        "page_id",
        F.when(found, F.coalesce("top", slug_label("slug"))).otherwise(F.col("primary")).alias("section"),
        F.when(found, F.col("c.label")).otherwise("").alias("subsection"),
    )

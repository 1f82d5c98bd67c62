"""Parsing, DOM queries as relations against the same queries on the tree, and the site extractions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corvid.operators import dom
from corvid.plans.sites import SITES, extract_pages

PAGES = {
    1: '<p><b>x<br><p>y<script>var a="</p>";</script><div>z</div>',
    2: "<div><p>1<p>2</div><section><p>a</p><p>b</p><p>c</p></section><article><p>d<p>e<p>f</article>",
    3: '<a href="/n">News</a><div><a href="/u"> Uni <i>x</i></a><h1>T</h1><p>q</p><h2>Deck</h2><h2>No</h2></div><ul><li>1<li>2<ul><li>3</ul></ul>',
    4: '<meta name="og:title" content="by name"><meta property="og:title" content=""><table><tr><td>a<td>b<tr><td>c</table>',
    5: "",
    6: None,
}


@pytest.fixture(scope="module")
def nodes(spark):  # noqa: ANN001, ANN201
    return dom.html_nodes(spark.createDataFrame(list(PAGES.items()), "page_id bigint, html string")).cache()


def test_repair() -> None:
    page = dom.Page(PAGES[1])
    assert [p.cleaned() for p in page.root.all("p")] == ["x", "y"] and page.tag("div").parent is page.root
    assert [len(n.children) for n in dom.Page(PAGES[3]).root.all("ul")] == [2, 1]
    assert [n.cleaned() for n in dom.Page(PAGES[4]).root.all("td")] == ["a", "b", "c"]


def test_relation_is_the_tree(nodes) -> None:  # noqa: ANN001
    for pid, html in PAGES.items():
        want = [(n.enter, n.parent.enter, n.exit, n.tag) for n in dom.Page(html).nodes]
        got = [(r["enter"], r["parent_id"], r["exit"], r["tag"]) for r in nodes.where(F.col("page_id") == pid).orderBy("enter").collect()]
        assert got == want


@pytest.fixture(scope="module")
def trees(spark):  # noqa: ANN001, ANN201
    return dom.trees(spark.createDataFrame(list(PAGES.items()), "page_id bigint, html string")).cache()


def test_trees_are_the_tree(trees) -> None:  # noqa: ANN001
    """Numbers, spans of text and own paragraphs of each element, against the tree in Python."""
    texts = F.transform("nodes", dom.text_in)
    for r in trees.select("page_id", "nodes", texts.alias("texts")).collect():
        want = [n for n in dom.Page(PAGES[r["page_id"]]).nodes if n.tag != "#text"]
        assert [(n["enter"], n["exit"], n["parent_id"], n["tag"], n["attrs"], n["paragraphs"]) for n in r["nodes"]] == [(n.enter, n.exit, n.parent.enter, n.tag, n.attrs, sum(c.tag == "p" for c in n.children)) for n in want]
        assert r["texts"] == ["" if n.tag in dom.HIDDEN else n.raw() for n in want]


def test_densest(trees) -> None:  # noqa: ANN001
    found = {r["page_id"]: r for r in trees.withColumn("best", dom.densest_container()).where("best is not null").select("page_id", "best", dom.paragraphs_of(F.col("best")).alias("text")).collect()}
    assert set(found) == {2} and found[2]["best"]["paragraphs"] == 3 and found[2]["best"]["enter"] == dom.Page(PAGES[2]).densest().enter
    assert found[2]["text"] == "a b c"


def test_neighbours(trees) -> None:  # noqa: ANN001
    both = trees.where("page_id = 3").select(dom.text_in(dom.nearest_before("a", "h1")).alias("a"), dom.text_in(dom.next_sibling("h1", "h2")).alias("h2")).first()
    assert both["a"].split() == ["Uni", "x"] and both["h2"] == "Deck"
    assert trees.select(dom.nearest_before("a", "h1").alias("x")).where("x is not null").count() == 1
    assert {r["page_id"]: r["c"] for r in trees.select("page_id", dom.meta_content("og:title").alias("c")).where("c is not null").collect()} == {4: "by name"}
    assert trees.where(dom.chain_container(["none"])[0].isNotNull()).count() == 0


def test_a_plan_parses_once(spark) -> None:  # noqa: ANN001
    pages = spark.createDataFrame(list(PAGES.items()), "page_id bigint, html string")
    best = dom.densest_container()
    found = dom.trees(pages).select("page_id", dom.paragraphs_of(best).alias("text"), dom.text_in(dom.nearest_before("a", "h1")).alias("kicker"), dom.meta_content("og:title").alias("title"), dom.paragraphs_of(dom.chain_container(["a"])[0]).alias("chain"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan and "Join" not in plan
    assert found.count() == 6


@pytest.mark.parametrize("most", [1, 2, 5, 7, 100])
def test_followed(spark, most) -> None:  # noqa: ANN001
    """A long chain, a loop, and a link that leads nowhere."""
    step = lambda n: f'<ol class="index-pagination"><a href="/l?page={n}">Next</a></ol>'
    chain = [(f"https://h/l?page={i}", step(i + 1)) for i in range(1, 61)]
    for rows, want in ((chain, 60), (chain[:4] + [("https://h/l?page=5", step(2))], 5), (chain[:3], 3)):
        got = dom.followed(spark.createDataFrame(rows, "url string, html string"), "https://h/l?page=1", most)
        assert sorted((r["page"], r["url"]) for r in got.select("page", "url").collect()) == sorted((i, f"https://h/l?page={i}") for i in range(1, min(want, most) + 1))
    assert got._jdf.queryExecution().analyzed().toString().count("Join") <= 1, "the plan doesn't grow with the walk"


def extracted(spark, site: str, url: str, html: str, inner: str = "") -> dict:  # noqa: ANN001
    return extract_pages(spark.createDataFrame([(url, html, inner)], "url string, html string, inner_text string"), SITES[site]).first().asDict()


def test_site_n(spark) -> None:  # noqa: ANN001
    nav = '<nav><a href="/category/campus/academic/">Academic</a><a href="/campus/">Campus</a></nav>'
    got = extracted(spark, "n", "https://h/2020/01/02/a/b/", f'<meta property="article:section" content="academic">{nav}<h1 id="sno-story-headline">Head</h1><div class="sno-story-byline">By A B</div><div id="sno-story-body-content"><p>1<p>2<p>3 <b>x</b>, y</div>')
    assert got == {"url": got["url"], "text": "1 2 3 x , y", "title": "Head", "author": "A B", "publication_date": "2020-01-02", "subtitle": "", "section": "Campus", "subsection": "Academic"}
    got = extracted(spark, "n", "u", '<div id="classic_story"></div><div><p>1<p>2<p>3</div><span class="storybyline">By <a>Maia Pandey</a>, Editor</span>')
    assert (got["text"], got["author"]) == ("", "Maia Pandey")


def test_site_d(spark) -> None:  # noqa: ANN001
    byline = lambda prefix, *names: f'<div class="article--byline"><span class="article--byline-prefix">{prefix}</span>' + "".join(f'<a class="article--author">{n}</a>' for n in names) + "</div>"
    got = extracted(spark, "d", "https://h/article/x-20200102", byline("Photo by", "P Q") + byline("By", "A B", "C D") + '<a href="/n">News | University</a><h1>T</h1><div class="article-content"><p>x</p></div><meta property="og:description" content="deck">')
    assert (got["author"], got["section"], got["subsection"], got["publication_date"], got["subtitle"], got["text"]) == ("A B, C D", "News", "University", "20200102", "deck", "x")
    got = extracted(spark, "d", "u", '<script type="application/ld+json">{bad</script><script type="application/ld+json">[{"articleSection": ["topstory"]}, {"articleSection": ["news","newsletter-top","local-national"]}]</script><a>' + "k" * 61 + "</a><h1>T</h1>")
    assert (got["section"], got["subsection"]) == ("News", "Local National")


def test_site_y(spark) -> None:  # noqa: ANN001
    got = extracted(spark, "y", "u", '<a href="/city/">CITY</a><div class="payload-richtext"></div><article><h1>T</h1><h2>Deck</h2><p>x</p></article><a href="/author/a">By Ann Lee</a><a href="/author/b">ann lee</a><a href="/author/c">Bo</a>', "Monday, June 15, 2026 9:48 a.m., June 9, 2026")
    assert (got["author"], got["publication_date"], got["subtitle"], got["title"], got["section"], got["text"]) == ("Ann Lee, Bo", "June 9, 2026", "Deck", "T", "City", "x")


def test_site_c(spark) -> None:  # noqa: ANN001
    got = extracted(spark, "c", "u", '<meta property="og:title" content="Real"><h1>Masthead</h1><div class="sno-story-byline"><a href="/staff_name/x">Ann Lee</a><a href="/staff_name/y">Senior Reporter</a><a href="/staff_name/z">Z (x)</a></div><span class="sno-story-date">May 3, 2021</span><div id="sno-story-body-content"><p>b</p></div>')
    assert (got["title"], got["author"], got["publication_date"], got["text"]) == ("Real", "Ann Lee", "May 3, 2021", "b")
    assert extracted(spark, "c", "u", None)["text"] == ""

"""Queries over documents built from table columns: whole site extractions, discovery runs, caches and DOM operators, with their SQL."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text, urls
from ..operators import discovery, dom, merge
from ..schema import ARTICLE_COLS, empty_page
from ..ship import shared
from ..sources import files, xml
from ..sources.changelog import ChangeLog
from .catalog import _LISTING, _MAPPED, _listing, _order_urls, _sitemaps, query, t
from .discover import discover
from .sites import SITES, extract_pages


def filled(template: str) -> Column:
    """The template with {column} replaced by the column's text."""
    return F.concat(*[F.col(x[1:-1]).cast("string") if re.fullmatch(r"\{\w+\}", x) else F.lit(x) for x in re.split(r"(\{\w+\})", template) if x])


def by_case(key: Column, *templates: str) -> Column:
    out = None
    for i, x in enumerate(templates):
        out = F.when(key == i, filled(x)) if out is None else out.when(key == i, filled(x))
    return out


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "part").withColumnRenamed("p_partkey", "k")


_K = "FROM (SELECT *, p_partkey AS k FROM part)"


# --- pages of the four sites
@query(f"""
SELECT 'https://h.example.com/2019/03/07/x/s-' || k || '/' AS url,
  CASE k % 4 WHEN 0 THEN 'one ' || k || ' two' WHEN 1 THEN 'c ' || k WHEN 2 THEN 'd1 d2 d3 ' || k ELSE '' END AS text,
  CASE WHEN k % 4 = 0 THEN p_name ELSE CASE WHEN k % 4 = 2 THEN 'OG ' || p_name ELSE '' END END AS title, CASE WHEN k % 4 IN (0, 1) THEN p_type ELSE '' END AS author,
  CASE k % 4 WHEN 0 THEN '2020-01-02T00:00:00' WHEN 3 THEN '' ELSE '2019-03-07' END AS publication_date, '' AS subtitle,
  CASE WHEN k % 4 = 0 THEN 'Campus' ELSE '' END AS section, CASE WHEN k % 4 = 0 THEN 'Academics' ELSE '' END AS subsection {_K}""")
def site_n_pages(spark: SparkSession, sf: str) -> DataFrame:
    html = by_case(
        F.col("k") % 4,
        '<html><head><meta property="og:title" content="OG {p_name}"><meta property="article:section" content="academics"><meta property="article:published_time" content="2020-01-02T00:00:00">'
        '</head><body><nav><a href="/category/campus/academics/">Academics</a><a href="/campus/">Campus</a></nav><h1 id="sno-story-headline">{p_name}</h1>'
        '<div class="sno-story-byline">By {p_type}</div><div id="sno-story-body-content"><p>one {k}</p><p> two</p></div></body></html>',
        '<span class="storybyline">{p_type} , Role</span><div id="classic_story"><p>c {k}</p></div>',
        '<meta name="og:title" content="OG {p_name}"><div><p>x</p></div><div><p>d1</p><p>d2</p><p>d3 {k}</p></div>',
        "<div><p>only</p></div>",
    )
    return extract_pages(_parts(spark, sf).select(filled("https://h.example.com/2019/03/07/x/s-{k}/").alias("url"), html.alias("html")), SITES["n"])


@query(f"""
SELECT 'https://d/article/s' || k || '-20190405' AS url, 'a ' || k AS text, '' AS title, p_type || ', Zed' AS author, CASE WHEN k % 2 = 0 THEN '2021-02-03' ELSE '20190405' END AS publication_date,
  'Sub ' || k AS subtitle, CASE WHEN k % 3 = 0 THEN 'News' ELSE 'Men Sports' END AS section, CASE WHEN k % 3 = 0 THEN 'University' ELSE 'Big News' END AS subsection {_K}""")
def site_d_pages(spark: SparkSession, sf: str) -> DataFrame:
    kicker = by_case(F.col("k") % 3, '<a href="/section/news">News | University</a>', "", f'<a href="/section/x">{"Long " * 20}</a>')
    time = by_case(F.col("k") % 2, '<time datetime="2021-02-03">x</time>', "<time>none</time>")
    rest = filled(
        '<h1>T</h1><div class="article--byline"><span class="article--byline-prefix">Photo by</span><a class="article--author">Pic</a></div><div class="article--byline">'
        '<span class="article--byline-prefix">By</span> <a class="article--author">{p_type}</a> and <a class="article--author"> Zed </a></div><div class="article-content"><p>a {k}</p></div>'
        '<script type="application/ld+json">{"articleSection":["topstory-x","men-sports","big-news"]}</script>'
    )
    page = _parts(spark, sf).withColumn("html", F.concat(filled('<meta property="og:description" content="Sub {k}">'), kicker, rest, time))
    return extract_pages(page.select(filled("https://d/article/s{k}-20190405").alias("url"), "html"), SITES["d"])


@query(f"""
SELECT 'https://y/articles/s' || k AS url, 'y ' || k AS text, 'H ' || p_name AS title, CASE WHEN k % 2 = 0 THEN 'Ann Lee' ELSE p_type || ', Zed' END AS author,
  CASE WHEN k % 5 = 0 THEN '2022-01-01' ELSE 'June 9, 2026' END AS publication_date, 'Deck ' || k AS subtitle,
  CASE k % 3 WHEN 0 THEN 'Arts' WHEN 1 THEN 'Short' ELSE '' END AS section, '' AS subsection {_K}""")
def site_y_pages(spark: SparkSession, sf: str) -> DataFrame:
    label = by_case(F.col("k") % 3, '<a href="/arts/x">arts</a>', '<a href="/none">Short</a>', "")
    byline = by_case(F.col("k") % 2, "<p>By Ann Lee today</p>", '<a href="/author/a">By {p_type}</a><a href="/author/b">{low}</a><a href="/author/c">Zed</a>')
    time = F.when(F.col("k") % 5 == 0, '<time datetime="2022-01-01">x</time>').otherwise("")
    body = filled('<div><h1>H {p_name}</h1><p>z</p><h2>Deck {k}</h2></div><div class="payload-richtext"></div><article><p>y {k}</p></article>')
    page = _parts(spark, sf).withColumn("low", F.lower("p_type")).withColumn("html", F.concat(label, body, byline, time))
    return extract_pages(page.select(filled("https://y/articles/s{k}").alias("url"), "html", F.lit("Monday, June 15, 2026\n9:48 a.m., June 9, 2026").alias("inner_text")), SITES["y"])


@query(f"""
SELECT 'https://c/1/x/s' || k AS url, CASE k % 3 WHEN 2 THEN 'p q r ' || k ELSE 'b ' || k END AS text, 'OG ' || p_name AS title, CASE WHEN k % 2 = 0 THEN 'Amy Poe, Bo Ray' ELSE 'Jo Doe' END AS author,
  CASE WHEN k % 4 = 0 THEN '' ELSE 'June 9, 2026' END AS publication_date, 'Sub ' || k AS subtitle, 'Sec' AS section, '' AS subsection {_K}""")
def site_c_pages(spark: SparkSession, sf: str) -> DataFrame:
    body = by_case(F.col("k") % 3, '<div id="sno-story-body-content"><p>b {k}</p></div>', '<div id="classic_story"><p>b {k}</p></div>', "<section><p>p</p><p>q</p><p>r {k}</p></section>")
    byline = by_case(
        F.col("k") % 2,
        '<div class="sno-story-byline">By <a href="/staff_name/a">Amy Poe</a><a href="/staff_name/b">News Editor</a><a href="/staff_name/c">Bo (x)</a><a href="/staff_name/d">Bo Ray</a><a href="/staff_name/e">AMY POE</a></div>',
        '<div class="sno-story-byline">By Jo Doe, Staff</div>',
    )
    date = F.when(F.col("k") % 4 == 0, '<span class="sno-story-date">soon</span>').otherwise('<span class="sno-story-date">June 9, 2026</span>')
    head = filled('<meta property="og:title" content="OG {p_name}"><meta property="og:description" content="Sub {k}"><meta property="article:section" content="Sec"><h1>Masthead</h1>')
    return extract_pages(_parts(spark, sf).select(filled("https://c/1/x/s{k}").alias("url"), F.concat(head, byline, date, body).alias("html")), SITES["c"])


# --- DOM trees
def _trees(spark: SparkSession, sf: str, html: Column) -> DataFrame:
    return dom.trees(_parts(spark, sf).select(F.col("k").alias("page_id"), html.alias("html")))


@query(f"SELECT k AS page_id, CASE k % 3 WHEN 0 THEN 'P ' || p_name WHEN 1 THEN 'N ' || p_name ELSE '' END AS content {_K}")
def dom_meta(spark: SparkSession, sf: str) -> DataFrame:
    html = by_case(F.col("k") % 3, '<meta name="og:title" content="N"><meta property="og:title" content="P {p_name}">', '<meta property="og:title" content=""><meta name="og:title" content="N {p_name}">', '<meta property="og:title" content="">')
    return _trees(spark, sf, html).select("page_id", dom.meta_content("og:title").alias("content"))


@query(f"SELECT k AS page_id, 'Deck ' || k AS raw {_K} WHERE k % 2 = 0")
def dom_deck_after_h1(spark: SparkSession, sf: str) -> DataFrame:
    trees = _trees(spark, sf, by_case(F.col("k") % 2, "<div><h2>no</h2><h1>T</h1><p>z</p><h2>Deck {k}</h2><h2>later</h2></div>", "<div><h1>T</h1></div><h2>other parent</h2>"))
    return trees.select("page_id", dom.text_in(dom.next_sibling("h1", "h2")).alias("raw")).where("raw is not null")


@query(f"SELECT k AS page_id, CASE WHEN k % 3 = 0 THEN 1 ELSE 2 END AS rank, CASE k % 3 WHEN 0 THEN 'first ' || k || ' more' ELSE 'second ' || k END AS text {_K} WHERE k % 3 < 2")
def dom_chain_container(spark: SparkSession, sf: str) -> DataFrame:
    trees = _trees(spark, sf, by_case(F.col("k") % 3, '<div id="b"><p>no</p></div><div id="a"><p>first {k}</p><i>x</i><p>more</p></div>', '<div id="b"><p>second {k}</p></div>', "<div><p>z</p></div>"))
    found, rank = dom.chain_container(["a", "b"])
    return trees.where(found.isNotNull()).select("page_id", rank.cast("int").alias("rank"), dom.paragraphs_of(found).alias("text"))


@query(f"SELECT k AS page_id, CASE k % 3 WHEN 0 THEN 'a b c ' || k ELSE 'p q r' END AS text {_K} WHERE k % 3 < 2")
def dom_densest_built(spark: SparkSession, sf: str) -> DataFrame:
    """The most own paragraphs, the first of equals, none below three."""
    trees = _trees(spark, sf, by_case(F.col("k") % 3, "<div><p>x</p><p>y</p><p>z</p></div><section><p>a</p><p>b</p><p>c</p><p>{k}</p></section>", "<div><p>p</p><p>q</p><p>r</p></div><div><p>x</p><p>y</p><p>z</p></div>", "<div><p>x</p><p>y</p></div>"))
    found = trees.withColumn("best", dom.densest_container()).where("best is not null")
    return found.select("page_id", text.collapse(dom.paragraphs_of(F.col("best"))).alias("text"))


@query(f"SELECT k AS page, '/news?page=' || (k + 1) AS href {_K} WHERE k % 3 = 0")
def listing_next_link(spark: SparkSession, sf: str) -> DataFrame:
    html = by_case(F.col("k") % 3, '<a href="/z">next</a><ol class="index-pagination"><li><a href="/p">Previous</a><a href="/news?page={n}"> Next ›</a><a href="/q">next</a></li></ol>', '<a href="/z">next</a>', '<ol class="index-pagination"><a href="/p">Back</a></ol>')
    pages = _parts(spark, sf).withColumn("n", F.col("k") + 1)
    return dom.anchors(pages.select(F.col("k").alias("page"), html.alias("html"))).where("is_next").select("page", "href")


# --- discovery runs
def _spread(n: int, order: str = "url") -> str:
    return f"""k AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY {order}) - 1 AS k, count(*) OVER (PARTITION BY year) AS cnt FROM u),
s AS (SELECT * FROM k WHERE cnt <= {n} OR list_contains(list_transform(range(0, {n}), lambda i: round_even(i * ((cnt - 1) / ({n} - 1.0)), 0)::BIGINT), k))"""


_DATED = f"{_MAPPED}, u AS (SELECT DISTINCT url, year(strptime(regexp_extract(url, '/([0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}})/', 1), '%Y/%m/%d'))::INT AS year FROM m)"


@query(f"{_DATED}, {_spread(8)} SELECT (row_number() OVER (ORDER BY year, url) - 1)::INT AS pos, url, '' AS title, '' AS author, replace(regexp_extract(url, '/([0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}})/', 1), '/', '-') AS publication_date, '' AS section, year FROM s WHERE year BETWEEN 1993 AND 1997")
def discover_n_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    return discover(spark, "n", {"host": "news.example.com", "year_start": 1993, "year_end": 1997, "per_year": 2}, {"sitemaps": _sitemaps(spark, sf)})


@query(f"{_DATED} SELECT year, count(*) AS n, min(url) AS first_url, max(url) AS last_url FROM u WHERE year BETWEEN 1993 AND 1997 GROUP BY year")
def dated_buckets(spark: SparkSession, sf: str) -> DataFrame:
    found = discovery.year_buckets(discovery.dated_candidates(xml.sitemap_entries(_sitemaps(spark, sf)), "news.example.com", 1993, 1997))
    return found.select("year", F.size("urls").cast("bigint").alias("n"), F.get("urls", 0).alias("first_url"), F.element_at("urls", -1).alias("last_url"))


@query("""SELECT (row_number() OVER (ORDER BY c_custkey) - 1)::INT AS pos, 'https://f/' || c_custkey AS url, c_name AS title, CASE WHEN c_custkey % 2 = 0 THEN 'Ann' ELSE '' END AS author, '2020-01-01' AS publication_date, c_mktsegment AS section
FROM customer WHERE c_custkey < 40 AND c_custkey % 9 <> 0""")
def discover_n_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The first 40 items of a feed in pages of 100; items without a link go after that."""
    c = t(spark, sf, "customer")
    item = F.concat(F.lit("<item>"), F.when(F.col("c_custkey") % 9 != 0, filled("<link> https://f/{c_custkey} </link>")).otherwise(""), filled("<title>{c_name}</title>"), F.when(F.col("c_custkey") % 2 == 0, "<dc:creator>Ann</dc:creator>").otherwise(""), filled("<pubDate>2020-01-01</pubDate><category>{c_mktsegment}</category><category>x</category></item>"))
    pages = c.groupBy(F.floor(F.col("c_custkey") / 100).alias("page")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", item.alias("i")))).alias("items"))
    feed = pages.select("page", F.concat(F.lit("<rss><channel>"), F.array_join(F.transform("items", lambda x: x["i"]), ""), F.lit("</channel></rss>")).alias("xml"))
    return discover(spark, "n", {"discovery_mode": "rss", "max_articles": 40}, {"feed": feed})


_NUMBERED = "SELECT o_orderkey, 'https://www.y.example.com/' || o_orderkey || '/' || lower(replace(o_orderpriority, ' ', '')) || '/story/' AS url, lower(replace(o_orderpriority, ' ', '')) AS p, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS lastmod, year(o_orderdate)::INT AS year FROM orders WHERE o_orderkey % 9 <> 0"


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    o = _order_urls(spark, sf).withColumn("p", F.lower(F.replace("o_orderpriority", F.lit(" "), F.lit(""))))
    stamp = F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.lit("<lastmod>"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("</lastmod>"))).otherwise("")
    entry = F.concat(filled("<url><loc>https://www.y.example.com/{o_orderkey}/{p}/story/</loc>"), stamp, F.lit("</url>"))
    whole = o.groupBy(F.floor(F.col("o_orderkey") / 100).alias("file")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", entry.alias("e")))).alias("es"))
    return whole.select("file", F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.transform("es", lambda x: x["e"]), ""), F.lit("</urlset>")).alias("xml"))


@query(f"WITH u AS ({_NUMBERED}), {_spread(12)} SELECT (row_number() OVER (ORDER BY year, url) - 1)::INT AS pos, url, '' AS title, '' AS author, '' AS publication_date, p[1] || ' ' || upper(p[3]) || p[4:] AS section, year, lastmod FROM s WHERE year BETWEEN 1993 AND 1997")
def discover_c_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    return discover(spark, "c", {"host": "y.example.com", "year_start": 1993, "year_end": 1997, "per_year": 3}, {"sitemaps": _numbered(spark, sf)})


@query(f"WITH u AS ({_NUMBERED}) SELECT year, count(*) AS n, min(url) AS first_url FROM u GROUP BY year")
def sitemap_bucket_year(spark: SparkSession, sf: str) -> DataFrame:
    found = discovery.lastmod_candidates(xml.sitemap_entries(_numbered(spark, sf)), "y.example.com", 0, 9999)
    return found.groupBy("year").agg(F.count("*").alias("n"), F.min("url").alias("first_url"))


def _y_inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    p = _parts(spark, sf)
    gathered = lambda x: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", x.alias("e")))), lambda y: y["e"]), "")
    links = p.select("k", F.explode(F.array(F.lit("city"), F.lit("arts"))).alias("slug")).where("(slug = 'city' and k % 7 = 0) or (slug = 'arts' and k % 5 = 0)")
    sections = links.groupBy("slug").agg(F.concat(gathered(filled('<a href="/articles/s-{k}">T{k} {slug}</a>')), F.lit('<a href="/about">x</a>')).alias("html"))
    entry = by_case(F.col("k") % 4, "<url><loc>https://y/articles/s-{k}</loc></url>", "<url><loc>https://y/articles/s-{k}/</loc></url>", "<url><loc>https://y/articles/s-{k}?q=1</loc></url>", "<url><loc>https://y/articles/s-{k}</loc></url>")
    sitemap = p.groupBy(F.floor(F.col("k") / 500).alias("file")).agg(F.concat(F.lit("<urlset>"), gathered(entry), F.lit("</urlset>")).alias("xml"))
    return {"sitemap": sitemap, "sections": sections}


@query(f"""WITH u AS (SELECT k, 'https://y/articles/s-' || k || CASE WHEN k % 4 = 1 THEN '/' ELSE '' END AS url, CASE WHEN k % 4 = 1 THEN '' WHEN k % 7 = 0 THEN 'City' WHEN k % 5 = 0 THEN 'Arts' ELSE '' END AS section {_K} WHERE k % 4 <> 2)
SELECT (row_number() OVER (ORDER BY k) - 1)::INT AS pos, url, '' AS title, '' AS author, '' AS publication_date, section FROM u ORDER BY k LIMIT 1000""")
def discover_y_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    return discover(spark, "y", {"base_url": "https://y", "discovery_mode": "sitemap", "max_articles": 1000}, _y_inputs(spark, sf))


@query(f"""WITH l AS (SELECT k, 1 AS page, 'City' AS section, 'city' AS slug {_K} WHERE k % 7 = 0 UNION ALL SELECT k, 3, 'Arts', 'arts' {_K} WHERE k % 5 = 0),
f AS (SELECT k, min(page) AS page, arg_min(section, page) AS section, arg_min(slug, page) AS slug FROM l GROUP BY k)
SELECT (row_number() OVER (ORDER BY page, k) - 1)::INT AS pos, 'https://y/articles/s-' || k AS url, 'T' || k || ' ' || slug AS title, '' AS author, '' AS publication_date, section FROM f ORDER BY page, k LIMIT 500""")
def discover_y_sections(spark: SparkSession, sf: str) -> DataFrame:
    return discover(spark, "y", {"base_url": "https://y/", "max_articles": 500}, _y_inputs(spark, sf))


def _listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    rows = _listing(spark, sf)
    link = F.concat(filled('<a href="/article/s{o_orderkey}-{year}0101">'), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(filled("T{o_orderkey}")), F.lit("</a>"))
    return rows.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", link.alias("e")))), lambda x: x["e"]), "").alias("links"))


_URL_D = "'https://d/article/s' || o_orderkey || '-' || year || '0101'"


@query(f"""
WITH l AS ({_LISTING}), m AS (SELECT max(page) AS m FROM l), y AS (SELECT unnest(range(1990, 2002))::INT AS year), sp AS (SELECT page, min(year) AS lo FROM l GROUP BY page),
g AS (SELECT year, greatest(1, (2001 - year) * 4 + 1) AS c FROM y),
ok AS (SELECT DISTINCT g.year FROM g JOIN l ON l.year = g.year AND l.page BETWEEN greatest(1, c - 2) AND c + 2),
f AS (SELECT g.year, coalesce((SELECT min(page) FROM sp WHERE lo <= g.year), c) AS c FROM g WHERE year NOT IN (SELECT year FROM ok)),
w AS (SELECT g.year, p FROM g, LATERAL (SELECT unnest(range(greatest(1, c - 2), c + 3)) AS p) WHERE g.year IN (SELECT year FROM ok)
  UNION ALL SELECT f.year, p FROM f, LATERAL (SELECT unnest(range(greatest(1, c - 2), least((SELECT m FROM m), c + 2) + 1)) AS p)),
u AS (SELECT {_URL_D} AS url, year, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'T' || o_orderkey END AS title FROM l JOIN (SELECT DISTINCT year, p AS page FROM w) USING (year, page)), {_spread(3)}
SELECT (row_number() OVER (ORDER BY year, url) - 1)::INT AS pos, url, title, '' AS author, '' AS publication_date, 'News' AS section, year FROM s""")
def discover_d_stratified(spark: SparkSession, sf: str) -> DataFrame:
    pages = _listing_pages(spark, sf).select(F.col("page").cast("int").alias("page"), F.lit(None).cast("string").alias("url"), F.col("links").alias("html"))
    most = int(pages.agg(F.max("page")).first()[0] or 1)
    config = {"base_url": "https://d", "year_start": 1990, "year_end": 2001, "per_year": 3, "pages_per_year": 4, "page_window": 2, "max_pages": most, "max_articles": 1000}
    return discover(spark, "d", config, {"listings": pages})


@query(f"""WITH l AS ({_LISTING}) SELECT (row_number() OVER (ORDER BY page, o_orderkey) - 1)::INT AS pos, {_URL_D} AS url, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'T' || o_orderkey END AS title, '' AS author, '' AS publication_date, 'News' AS section, year
FROM l WHERE page <= 3 ORDER BY page, o_orderkey LIMIT 120""")
def discover_d_recent(spark: SparkSession, sf: str) -> DataFrame:
    """Three listing pages, each found by the next-page link of the one before."""
    number = _listing_pages(spark, sf).withColumn("n", F.col("page") + 1)
    url = F.when(F.col("page") == 1, "https://d/section/news").otherwise(filled("https://d/section/news?page={page}"))
    html = F.concat("links", filled('<ol class="index-pagination"><a href="/section/news?page={n}">Next</a></ol>'))
    return discover(spark, "d", {"base_url": "https://d", "max_pages": 3, "max_articles": 120}, {"listings": number.select(url.alias("url"), html.alias("html"))})


# --- caches
@query("SELECT year(o_orderdate)::INT AS year, 'u' || o_custkey % 40 AS url, max('t' || o_custkey % 40) AS title, '' AS author, '' AS publication_date, 's' AS section FROM orders GROUP BY 1, 2")
def cache_metas(spark: SparkSession, sf: str) -> DataFrame:
    key = (F.col("o_custkey") % 40).cast("string")
    rows = t(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.concat(F.lit("u"), key).alias("url"), F.concat(F.lit("t"), key).alias("title"), F.lit("").alias("author"), F.lit("").alias("publication_date"), F.lit("s").alias("section")).distinct()
    return files.cached_rows(files.cache_document(rows, "metas", {"year_end": 2001}, "now"), "metas")


@query("SELECT year(o_orderdate)::INT AS year, (row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) - 1)::INT AS pos, 'u' || o_orderkey AS url, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS lastmod FROM orders")
def cache_pairs(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("")
    rows = t(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url"), stamp.alias("lastmod"))
    return files.cached_rows(files.cache_document(rows, "pairs", {}, "now"), "pairs")


@query("SELECT DISTINCT year(o_orderdate)::INT AS year, 'u' || o_custkey % 40 AS url FROM orders")
def cache_url_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = t(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.concat(F.lit("u"), (F.col("o_custkey") % 40).cast("string")).alias("url"))
    return files.cached_rows(files.cache_document(rows, "urls", {}, "now"), "urls").select("year", "url")


@query("SELECT DISTINCT year(o_orderdate)::INT AS year, 'u' || o_custkey % 4000 AS url FROM orders WHERE year(o_orderdate) <> 1996 UNION ALL SELECT 1996, 'z' || o_orderkey FROM orders WHERE year(o_orderdate) = 1996")
def cache_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """A cache folder, written whole and then one year anew."""
    path = f"{shared(spark)}/cache-{uuid.uuid4().hex}"
    o = t(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    files.write_cache(o.select("year", F.concat(F.lit("u"), (F.col("o_custkey") % 4000).cast("string")).alias("url")), path, "urls", {"year_end": 2001}, "now")
    files.write_cache(o.where("year = 1996").select("year", F.concat(F.lit("z"), F.col("o_orderkey").cast("string")).alias("url")), path, "urls", {"year_end": 2001}, "later", years_only=True)
    return files.read_cache(spark, path, "urls", {"year_end": 2001})


# --- corpora kept as changes
@query("""
WITH c AS (SELECT o_orderkey, 'u' || o_custkey AS url, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 't' || o_orderkey END AS text, (o_orderkey % 4)::INT AS step FROM orders),
f AS (SELECT url, step, arg_min(text, o_orderkey) AS text FROM c GROUP BY url, step)
SELECT url, CASE WHEN count(*) FILTER (WHERE text <> '') > 0 THEN arg_min(text, step) FILTER (WHERE text <> '') ELSE '' END AS text FROM f GROUP BY url""")
def change_log_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Four runs over one corpus, as changes: the first text of a URL stays, a blank one is replaced by a later run."""
    log = ChangeLog(spark, f"{shared(spark)}/log-{uuid.uuid4().hex}", fold=2)
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("url"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(filled("t{o_orderkey}")).alias("text"))
    for step in range(4):
        new = o.where(F.col("pos") % 4 == step).select("pos", *[F.col(c) if c in ("url", "text") else F.lit("").alias(c) for c in ARTICLE_COLS])
        log.commit(merge.changes(log.held(), new))
    return log.read("text").select("url", "text")


# --- scalars
@query(f"SELECT k, k % 4 IN (0, 1) AS is_article, k % 4 = 3 AS is_game {_K}")
def url_slug_article(spark: SparkSession, sf: str) -> DataFrame:
    url = by_case(F.col("k") % 4, "https://y/articles/s-{k}", "https://y/Articles/S-{k}/", "https://y/articles/s-{k}?x=1", "https://y/games/s-{k}")
    return _parts(spark, sf).select("k", urls.slug_article(url).alias("is_article"), urls.is_game(url).alias("is_game"))


@query(f"SELECT k, k % 3 = 0 AS ready, 'fi1' || p_name AS folded {_K}")
def date_ready_nfkc(spark: SparkSession, sf: str) -> DataFrame:
    shown = by_case(F.col("k") % 3, "x 9:48 a.m., June 9, 2026 y", "June 9, 2026", "9:48 a.m., June 9, 1999")
    return _parts(spark, sf).select("k", dates.timed_date_ready(shown).alias("ready"), text.nfkc(filled("ﬁ①{p_name}")).alias("folded"))


@query(f"SELECT k, CASE k % 3 WHEN 0 THEN 'Amy Poe, By Bo' WHEN 1 THEN 'Jo Doe' ELSE '' END AS author {_K}")
def byline_people_join(spark: SparkSession, sf: str) -> DataFrame:
    names = F.when(F.col("k") % 3 == 0, F.array(*map(F.lit, ("Amy Poe", "News Editor", "", "By Bo", "amy poe", "X (y)", "Z9")))).otherwise(F.array(F.lit("Staff")))
    raw = F.when(F.col("k") % 3 == 1, "by Jo Doe , Role").otherwise("")
    return _parts(spark, sf).select("k", text.byline_people(names, raw).alias("author"))


@query(f"SELECT k, '' AS text, '' AS title, '' AS author, '' AS publication_date, '' AS subtitle, '' AS section, '' AS subsection {_K}")
def empty_page_record(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf).select("k", empty_page().alias("p")).select("k", "p.*")

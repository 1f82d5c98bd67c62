"""The query catalogue: each operator over the driver's tables, with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, text, urls
from ..operators import discovery, dom, merge, sampling
from ..schema import conform
from ..ship import ship
from ..sources import files, xml
from . import quality
from .sites import SECTION_PAGES, SITES, extract_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf}/{name}.parquet")


# --- a page slice that the minimum end-to-end query uses: title, paragraphs, origin, first wins, counts
@query(r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) AS origin,
  regexp_replace(url, '[?#].*$', '') AS bare,
  trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) AS title,
  (length(html) - length(replace(html, '<p>', ''))) // 3 AS paragraphs FROM pages),
f AS (SELECT *, row_number() OVER (PARTITION BY bare ORDER BY page_id) AS k FROM p)
SELECT origin, count(*) AS n_pages, sum(paragraphs)::BIGINT AS n_paragraphs, min(title) AS first_title FROM f WHERE k = 1 GROUP BY origin""")
def page_origins(spark: SparkSession, sf: str) -> DataFrame:
    p = t(spark, sf, "pages").select(
        "page_id", urls.origin("url").alias("origin"), F.regexp_replace("url", "[?#].*$", "").alias("bare"),
        text.collapse(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"),
        F.expr("(length(html) - length(replace(html, '<p>', ''))) div 3").alias("paragraphs"),
    )
    return merge.first_wins(p, "bare", ["page_id"]).groupBy("origin").agg(F.count("*").alias("n_pages"), F.sum("paragraphs").alias("n_paragraphs"), F.min("title").alias("first_title"))


# --- text scalars
@query(r"SELECT doc_id, coalesce(trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')), '') AS cleaned FROM documents")
def text_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "documents").select("doc_id", text.collapse("text").alias("cleaned"))


@query(r"SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g'))) AS stripped FROM pages")
def text_tag_strip(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "pages").select("page_id", F.md5(text.collapse(text.strip_tags("html"))).alias("stripped"))


@query("SELECT page_id, replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&amp;', '&') AS title FROM pages")
def entity_amp_decode(spark: SparkSession, sf: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t(spark, sf, "pages").select("page_id", F.replace(F.replace(title, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&")).alias("title"))


@query("""
WITH k AS (SELECT p_partkey, list_filter(list_transform(string_split(replace(p_name, ' ', ' | '), '|'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM part)
SELECT p_partkey, coalesce(parts[1], '') AS section, coalesce(parts[2], '') AS subsection FROM k""")
def kicker_split(spark: SparkSession, sf: str) -> DataFrame:
    k = t(spark, sf, "part").select("p_partkey", text.split_kicker(F.replace("p_name", F.lit(" "), F.lit(" | "))).alias("k"))
    return k.select("p_partkey", "k.section", "k.subsection")


@query("""
SELECT c_custkey, regexp_replace(CASE WHEN c_custkey % 3 = 0 THEN 'By  ' WHEN c_custkey % 3 = 1 THEN 'bY ' ELSE 'By' END || c_name, '(?i)^by\\s+', '') AS author,
  trim(split_part(c_name || ' , Staff ' || c_mktsegment, ',', 1)) AS without_role FROM customer""".replace("\\\\", "\\"))
def by_strip(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey") % 3
    prefix = F.when(k == 0, "By  ").when(k == 1, "bY ").otherwise("By")
    return t(spark, sf, "customer").select("c_custkey", text.strip_by(F.concat(prefix, "c_name")).alias("author"), text.drop_role(F.concat("c_name", F.lit(" , Staff "), "c_mktsegment")).alias("without_role"))


_ROLES = "|".join(text.ROLE_WORDS)


@query(rf"""
WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'Senior Reporter' WHEN p_partkey % 5 = 1 THEN 'Ann (ed.)' WHEN p_partkey % 5 = 2 THEN p_name ELSE regexp_replace(p_name, '[0-9]', '', 'g') END AS name FROM part)
SELECT p_partkey, name FROM n WHERE name <> '' AND NOT regexp_matches(name, '(?i)\b({_ROLES})\b') AND NOT contains(name, '(') AND NOT regexp_matches(name, '[0-9]')""")
def role_filter(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, "Senior Reporter").when(k == 1, "Ann (ed.)").when(k == 2, F.col("p_name")).otherwise(F.regexp_replace("p_name", "[0-9]", ""))
    return t(spark, sf, "part").select("p_partkey", name.alias("name")).where(text.is_person("name"))


@query("""
WITH n AS (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'By ' || c_mktsegment ELSE lower(c_mktsegment) END AS name FROM customer),
s AS (SELECT c_nationkey, c_custkey, regexp_replace(name, '(?i)^by\\s+', '') AS name FROM n),
f AS (SELECT c_nationkey, lower(name) AS key, arg_min(name, c_custkey) AS name, min(c_custkey) AS pos FROM s GROUP BY ALL)
SELECT c_nationkey, string_agg(name, ', ' ORDER BY pos) AS authors FROM f GROUP BY c_nationkey""".replace("\\\\", "\\"))
def author_join_ci(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("By "), "c_mktsegment")).otherwise(F.lower("c_mktsegment"))
    named = t(spark, sf, "customer").select("c_nationkey", "c_custkey", name.alias("name"))
    listed = named.groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "name"))), lambda x: x["name"]).alias("names"))
    return listed.select("c_nationkey", text.join_authors("names").alias("authors"))


@query("""
SELECT p_partkey, list_aggregate(list_transform(string_split(lower(replace(p_type, ' ', '-')), '-'), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS label FROM part""")
def slug_labels(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "part").select("p_partkey", text.slug_label(F.lower(F.replace("p_type", F.lit(" "), F.lit("-")))).alias("label"))


@query("""
SELECT page_id, contains(html, 'Vercel Security Checkpoint') OR contains(html, 'Enable JavaScript to continue') OR contains(html, 'We''re verifying your browser') AS checkpoint,
  contains(html, 'track(1)') AS tracked FROM pages""")
def checkpoint_flag(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "pages").select("page_id", text.is_checkpoint("html").alias("checkpoint"), F.col("html").contains("track(1)").alias("tracked"))


@query("""
SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END, ''), nullif(CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE '' END, ''), '') AS value,
  CASE WHEN length(c_name || c_mktsegment) <= 27 THEN c_name || c_mktsegment ELSE '' END AS short FROM customer""")
def first_nonempty_merge(spark: SparkSession, sf: str) -> DataFrame:
    a = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("")
    b = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise("")
    return t(spark, sf, "customer").select("c_custkey", text.first_nonempty(a, b).alias("value"), text.short_label(F.concat("c_name", "c_mktsegment"), 27).alias("short"))


@query(r"SELECT doc_id, regexp_extract('Story By ' || text || ' and By Ann Lee Bo', '\bBy\s+([A-Z][a-z]+(?:\s+[A-Z][a-z.\x27-]+){1,3})', 1) AS author FROM documents")
def byline_in_text(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "documents").select("doc_id", text.byline_in_text(F.concat(F.lit("Story By "), F.col("text"), F.lit(" and By Ann Lee Bo"))).alias("author"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g'))) AS cleaned FROM documents")
def clean_text_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without markup, whose SQL is therefore a matter of white space; most stay in the JVM."""
    return t(spark, sf, "documents").select("doc_id", F.md5(text.clean_text("text")).alias("cleaned"))


@query()
def clean_text_full(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "pages").select("page_id", F.md5(text.clean_text("html")).alias("cleaned"))


# --- URL scalars
@query(r"""
SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) AS origin, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
  len(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> ''))::INT AS n_segments FROM pages""")
def url_origin(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "pages").select("page_id", urls.origin("url").alias("origin"), urls.path_of("url").alias("path"), F.size(urls.segments("url")).alias("n_segments"))


_ORDER_URL = "'https://news.example.com/' || strftime(o_orderdate, '%Y/%m/%d') || '/' || lower(replace(o_orderpriority, ' ', '')) || '/story-' || o_orderkey"


@query(rf"""
WITH u AS (SELECT o_orderkey, {_ORDER_URL} || CASE WHEN o_orderkey % 4 = 0 THEN '/' ELSE '' END AS url FROM orders)
SELECT o_orderkey, regexp_matches(url, '^https://news\.example\.com/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/[^/]+/[^/]+/?$') AS is_article,
  replace(regexp_extract(url, '/([0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}})/', 1), '/', '-') AS day, regexp_extract(url, '/([0-9]{{4}})/', 1)::INT AS year FROM u""")
def url_year(spark: SparkSession, sf: str) -> DataFrame:
    u = _order_urls(spark, sf).withColumn("url", F.concat("url", F.when(F.col("o_orderkey") % 4 == 0, "/").otherwise("")))
    return u.select("o_orderkey", urls.dated_article("url", "news.example.com").alias("is_article"), urls.date_in_path("url").alias("day"), urls.year_in_path("url").alias("year"))


def _order_urls(spark: SparkSession, sf: str) -> DataFrame:
    slug = F.lower(F.replace("o_orderpriority", F.lit(" "), F.lit("")))
    return t(spark, sf, "orders").withColumn("url", F.concat(F.lit("https://news.example.com/"), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/"), slug, F.lit("/story-"), F.col("o_orderkey").cast("string")))


@query(r"""
WITH u AS (SELECT o_orderkey, 'https://x.example.com/a-b-' || strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderkey % 3 = 0 THEN '/' ELSE '' END AS url FROM orders)
SELECT o_orderkey, TRY_CAST(nullif(left(regexp_extract(regexp_replace(url, '/+$', ''), '-([0-9]{8})$', 1), 4), '') AS INT) AS year, regexp_extract(url, '-([0-9]{8})$', 1) AS suffix FROM u""")
def url_slug_date(spark: SparkSession, sf: str) -> DataFrame:
    u = t(spark, sf, "orders").withColumn("url", F.concat(F.lit("https://x.example.com/a-b-"), F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderkey") % 3 == 0, "/").otherwise("")))
    return u.select("o_orderkey", urls.year_in_slug("url").alias("year"), urls.date_suffix("url").alias("suffix"))


@query(r"""
WITH u AS (SELECT p_partkey, 'http://www.y.example.com/' || p_partkey || '/' || lower(replace(p_type, ' ', '-')) || '/slug-' || p_size || '/' AS url FROM part)
SELECT p_partkey, regexp_matches(url, '^https?://(?:www\.)?y\.example\.com/[0-9]+/[^/]+/[^/]+/?$') AS is_article,
  list_aggregate(list_transform(string_split(string_split(url, '/')[5], '-'), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS section FROM u""")
def url_section_label(spark: SparkSession, sf: str) -> DataFrame:
    u = t(spark, sf, "part").withColumn("url", F.concat(F.lit("http://www.y.example.com/"), F.col("p_partkey").cast("string"), F.lit("/"), F.lower(F.replace("p_type", F.lit(" "), F.lit("-"))), F.lit("/slug-"), F.col("p_size").cast("string"), F.lit("/")))
    return u.select("p_partkey", urls.numbered_article("url", "y.example.com").alias("is_article"), urls.section_in_path("url").alias("section"))


@query("""
WITH u AS (SELECT page_id, url, ['/a/b', '#top', '?q=1', 'c', '//h.example.org/x', 'https://z.example.org/'][(page_id % 6 + 1)::INT] AS href,
  regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS o, regexp_extract(url, '^([^?#]*)', 1) AS page FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN o || href WHEN 1 THEN regexp_extract(url, '^([^#]*)', 1) || href WHEN 2 THEN page || href
  WHEN 3 THEN regexp_extract(page, '^(.*/)', 1) || href WHEN 4 THEN regexp_extract(url, '^([a-z]+:)', 1) || href ELSE href END AS resolved FROM u""")
def url_resolve(spark: SparkSession, sf: str) -> DataFrame:
    refs = F.array(*map(F.lit, ("/a/b", "#top", "?q=1", "c", "//h.example.org/x", "https://z.example.org/")))
    return t(spark, sf, "pages").select("page_id", urls.resolved("url", F.get(refs, (F.col("page_id") % 6).cast("int"))).alias("resolved"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey <= 1 THEN n_name ELSE n_name || '?page=' || n_nationkey END AS listing FROM nation")
def listing_urls(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "nation").select("n_nationkey", urls.listing_page("n_name", "n_nationkey").alias("listing"))


# --- dates
_LONG = "strftime(o_orderdate, '%B ') || day(o_orderdate) || strftime(o_orderdate, ', %Y')"
_AS_2K = "20' || right(strftime(o_orderdate, '%Y'), 2)"


@query(rf"""
WITH x AS (SELECT o_orderkey, 'Monday, June 15, 2026 ' || CASE WHEN o_orderkey % 2 = 0 THEN '9:48 p.m., ' ELSE '' END || strftime(o_orderdate, '%B ') || day(o_orderdate) || ', {_AS_2K} || ' end' AS s FROM orders)
SELECT o_orderkey, coalesce(nullif(regexp_extract(s, '[0-9]{{1,2}}:[0-9]{{2}}\s*[ap]\.m\.,\s*([A-Z][a-z]+\s+[0-9]{{1,2}},\s+20[0-9]{{2}})', 1), ''), 'June 15, 2026') AS found FROM x""")
def long_date_extract(spark: SparkSession, sf: str) -> DataFrame:
    year = F.concat(F.lit("20"), F.right(F.date_format("o_orderdate", "yyyy"), F.lit(2)))
    s = F.concat(F.lit("Monday, June 15, 2026 "), F.when(F.col("o_orderkey") % 2 == 0, "9:48 p.m., ").otherwise(""), F.date_format("o_orderdate", "MMMM d"), F.lit(", "), year, F.lit(" end"))
    return t(spark, sf, "orders").select("o_orderkey", dates.long_date(s).alias("found"))


@query(rf"""
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN 'UNPARSED:junk ' || o_orderkey ELSE strftime(o_orderdate, '%Y-%m-%d') END AS publication_date FROM orders""")
def normalize_date_formats(spark: SparkSession, sf: str) -> DataFrame:
    d, k = "o_orderdate", F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MMMM d, yyyy")).when(k == 2, F.date_format(d, "yyyyMMdd")).when(k == 3, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T23:30:00-06:00"))).otherwise(F.concat(F.lit("junk "), F.col("o_orderkey").cast("string")))
    return t(spark, sf, "orders").select("o_orderkey", dates.normalize_listed(raw).alias("publication_date"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'UNPARSED:' WHEN o_orderkey % 6 = 1 THEN 'UNPARSED:' || o_orderpriority ELSE strftime(o_orderdate, '%Y-%m-%d') END AS publication_date FROM orders""")
def unparsed_tagging(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey") % 6
    raw = F.when(k == 0, "").when(k == 1, F.col("o_orderpriority")).when(k == 2, F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss '+0000'")).otherwise(F.date_format("o_orderdate", "d MMM yyyy"))
    return t(spark, sf, "orders").select("o_orderkey", dates.normalize_date(raw).alias("publication_date"))


@query("""
SELECT event_id, CASE WHEN regexp_matches(left(v, 4), '^[0-9]+$') THEN left(v, 4)::INT END AS year
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN '' WHEN 2 THEN left(event_id::VARCHAR, 2) ELSE 'x' || event_id END AS v FROM events)""")
def iso_years(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("event_id") % 4, F.col("event_id").cast("string")
    v = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd")).when(k == 1, "").when(k == 2, F.left(n, F.lit(2))).otherwise(F.concat(F.lit("x"), n))
    return t(spark, sf, "events").select("event_id", dates.iso_year(v).alias("year"))


# --- DOM, expression tier
@query(r"""
SELECT page_id, u.href, u.pos, u.label FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS h, regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS l FROM pages) p,
  LATERAL (SELECT unnest(h) AS href, unnest(range(0, len(h)))::INT AS pos, unnest(l) AS label) u""")
def anchor_links(spark: SparkSession, sf: str) -> DataFrame:
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), 1).alias("href"), F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), 1).alias("label"))
    return t(spark, sf, "pages").select("page_id", F.posexplode(both).alias("pos", "x")).select("page_id", "x.href", "pos", "x.label")


@query("SELECT page_id, len(regexp_extract_all(html, '<p[ >]'))::INT AS n_p, len(regexp_extract_all(html, '<a '))::INT AS n_a, regexp_extract(html, '<meta charset=\"([^\"]*)\"', 1) AS charset, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h1 FROM pages")
def paragraph_counts(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "pages").select("page_id", F.regexp_count("html", F.lit("<p[ >]")).alias("n_p"), F.regexp_count("html", F.lit("<a ")).alias("n_a"), F.regexp_extract("html", '<meta charset="([^"]*)"', 1).alias("charset"), F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("h1"))


@query(r"""
SELECT page_id, coalesce(regexp_extract_all(split_part(html, '<h1>', 1), '<a href="[^"]*">([^<]*)</a>', 1)[-1], '') AS kicker FROM pages""")
def kicker_before_h1(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest anchor before the headline, over the trees of the pages."""
    return dom.trees(t(spark, sf, "pages")).select("page_id", F.coalesce(dom.text_in(dom.nearest_before("a", "h1")), F.lit("")).alias("kicker"))


_NAV = r"""
WITH a AS (SELECT page_id, u.pos, u.href, u.label FROM (SELECT page_id, regexp_extract_all(html, '<a href="/([^"]*)">', 1) AS h, regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1) AS l FROM pages) p,
  LATERAL (SELECT unnest(h) AS href, unnest(range(0, len(h)))::INT AS pos, unnest(l) AS label) u),
s AS (SELECT page_id, pos, label, CASE pos % 3 WHEN 0 THEN ['category', 'desk-' || page_id % 3, href] WHEN 1 THEN ['desk-' || page_id % 2] ELSE ['category', href] END AS segs FROM a WHERE label <> ''),
primary_of AS (SELECT page_id, arg_max(label, pos) FILTER (WHERE pos % 3 = page_id % 3) AS p FROM s GROUP BY page_id),
child AS (SELECT page_id, lower(label) AS key, arg_min(segs[2], pos) AS slug, arg_min(label, pos) AS label FROM s WHERE len(segs) >= 3 AND segs[1] = 'category' GROUP BY ALL),
tops AS (SELECT page_id, segs[-1] AS slug, arg_min(label, pos) AS label FROM s WHERE len(segs) = 1 OR (len(segs) = 2 AND segs[1] = 'category') GROUP BY ALL)
SELECT o.page_id, CASE WHEN child.key IS NOT NULL THEN coalesce(tops.label, 'Desk ' || child.slug[-1:]) ELSE o.p END AS section, CASE WHEN child.key IS NOT NULL THEN child.label ELSE '' END AS subsection
FROM primary_of o LEFT JOIN child ON child.page_id = o.page_id AND child.key = lower(o.p) LEFT JOIN tops ON tops.page_id = o.page_id AND tops.slug = child.slug WHERE o.p IS NOT NULL"""


@query(_NAV)
def nav_section_resolve(spark: SparkSession, sf: str) -> DataFrame:
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">'), 1).alias("href"), F.regexp_extract_all("html", F.lit('<a href="/[^"]*">([^<]*)</a>'), 1).alias("label"))
    a = t(spark, sf, "pages").select("page_id", F.posexplode(both).alias("pos", "x")).select("page_id", "pos", "x.href", "x.label").where("label <> ''")
    desk = lambda n: F.concat(F.lit("desk-"), (F.col("page_id") % n).cast("string"))
    segs = F.when(F.col("pos") % 3 == 0, F.array(F.lit("category"), desk(3), "href")).when(F.col("pos") % 3 == 1, F.array(desk(2))).otherwise(F.array(F.lit("category"), F.col("href")))
    a = a.withColumn("segs", segs)
    primary = a.where("pos % 3 = page_id % 3").groupBy("page_id").agg(F.max_by("label", "pos").alias("primary"))
    return dom.resolve_sections(a, primary)


@query("""
WITH j AS (SELECT event_id, CASE WHEN event_id % 5 = 4 THEN '{bad' ELSE '{"articleSection": ["' || event_type || '", "topstory", "local-' || event_type || '"]}' END AS s FROM events),
v AS (SELECT event_id, list_filter(from_json(CASE WHEN json_valid(s) THEN s ELSE '{}' END, '{"articleSection": ["VARCHAR"]}').articleSection, lambda x: NOT contains(x, 'topstory')) AS r FROM j)
SELECT event_id, coalesce(upper(r[1][1]) || r[1][2:], '') AS section, coalesce('Local ' || upper(r[2][7]) || r[2][8:], '') AS subsection FROM v""")
def jsonld_sections(spark: SparkSession, sf: str) -> DataFrame:
    s = F.when(F.col("event_id") % 5 == 4, "{bad").otherwise(F.concat(F.lit('{"articleSection": ["'), "event_type", F.lit('", "topstory", "local-'), "event_type", F.lit('"]}')))
    real = t(spark, sf, "events").select("event_id", text.real_sections(F.from_json(s, "struct<articleSection:array<string>>")["articleSection"]).alias("r"))
    return real.select("event_id", F.coalesce(text.slug_label(F.get("r", 0)), F.lit("")).alias("section"), F.coalesce(text.slug_label(F.get("r", 1)), F.lit("")).alias("subsection"))


@query("SELECT event_id, (props->>'k')::INT AS k FROM events")
def event_props_json(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "events").select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k"))


@query(f"""
WITH a AS (SELECT page_id, ['/x/arts/1', '/city/', '/none', '/wknd/a'][(page_id % 4 + 1)::INT] AS href, CASE WHEN page_id % 2 = 0 THEN 'arts' ELSE 'City' END AS label FROM pages),
l(slug, name, i) AS (VALUES {", ".join(f"('{s}', '{n}', {i})" for i, (s, n) in enumerate(SECTION_PAGES))})
SELECT page_id, arg_min(name, i) AS section FROM a JOIN l ON contains(href, '/' || slug) AND lower(label) = lower(name) GROUP BY page_id""")
def label_contains_join(spark: SparkSession, sf: str) -> DataFrame:
    href = F.get(F.array(*map(F.lit, ("/x/arts/1", "/city/", "/none", "/wknd/a"))), (F.col("page_id") % 4).cast("int"))
    a = t(spark, sf, "pages").select("page_id", href.alias("href"), F.when(F.col("page_id") % 2 == 0, "arts").otherwise("City").alias("text"))
    labels = spark.createDataFrame([(s, n, i) for i, (s, n) in enumerate(SECTION_PAGES)], "slug string, name string, i int")
    return dom.labelled(a, labels)


# --- sitemaps, listings, discovery
def _sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    """XML files of 100 orders each, one url in nine without lastmod."""
    o = _order_urls(spark, sf)
    entry = F.concat(F.lit("<url><loc> "), "url", F.lit(" </loc>"), F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.lit("<lastmod>"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit("</lastmod>"))).otherwise(""), F.lit("</url>"))
    files_of = o.groupBy(F.floor(F.col("o_orderkey") / 100).alias("file")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", entry.alias("e")))).alias("es"))
    body = F.array_join(F.transform("es", lambda x: x["e"]), "")
    return files_of.select("file", F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), body, F.lit("</urlset>")).alias("xml"))


_MAPPED = f"""WITH m AS (SELECT o_orderkey // 100 AS file, (row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1)::INT AS pos, {_ORDER_URL} AS url,
  CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') ELSE '' END AS lastmod FROM orders)"""


@query(_MAPPED + " SELECT file, pos, url, lastmod FROM m")
def sitemap_parse(spark: SparkSession, sf: str) -> DataFrame:
    return xml.sitemap_entries(_sitemaps(spark, sf))


@query(_MAPPED + " SELECT file, pos, url FROM m")
def sitemap_locs(spark: SparkSession, sf: str) -> DataFrame:
    return xml.sitemap_urls(_sitemaps(spark, sf))


@query("SELECT 'https://h/wp-sitemap-posts-post-' || n_nationkey || '.xml' AS url FROM nation WHERE n_nationkey % 2 = 0")
def sitemap_index(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("https://h/wp-sitemap-posts-post-"), F.col("n_nationkey").cast("string"), F.lit(".xml"))).otherwise(F.lit("https://h/wp-sitemap-taxonomies.xml"))
    entry = F.concat(F.lit("<sitemap><loc>"), name, F.lit("</loc></sitemap>"))
    index = t(spark, sf, "nation").groupBy().agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.array_sort(F.collect_list(entry)), ""), F.lit("</sitemapindex>")).alias("xml"))
    return xml.sub_sitemaps(index, "wp-sitemap-posts-post").select("url")


_LISTING = "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1) // 50 + 1 AS page, year(o_orderdate)::INT AS year FROM orders"


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    # ranks by day first, so that no window holds all rows
    days = o.groupBy("o_orderdate").agg(F.count("*").alias("n"))
    before = days.select("o_orderdate", (F.sum("n").over(Window.orderBy(F.desc("o_orderdate"))) - F.col("n")).alias("before"))
    k = F.row_number().over(Window.partitionBy("o_orderdate").orderBy("o_orderkey")) - 1
    ranked = o.withColumn("k", k).join(before, "o_orderdate")
    return ranked.select("o_orderkey", F.expr("(before + k) div 50 + 1").alias("page"), "year")


@query(f"WITH l AS ({_LISTING}) SELECT page, min(year) AS min_year, max(year) AS max_year FROM l GROUP BY page")
def listing_min_max(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.page_years(_listing(spark, sf))


@query(f"""
WITH l AS ({_LISTING}), m AS (SELECT max(page) AS m FROM l), y AS (SELECT DISTINCT year FROM l), s AS (SELECT page, min(year) AS lo FROM l GROUP BY page),
g AS (SELECT year, greatest(1, (2001 - year) * 2 + 1) AS c FROM y),
ok AS (SELECT DISTINCT g.year FROM g JOIN l ON l.year = g.year AND l.page BETWEEN greatest(1, c - 1) AND c + 1),
f AS (SELECT g.year, coalesce((SELECT min(page) FROM s WHERE lo <= g.year), c) AS c FROM g WHERE year NOT IN (SELECT year FROM ok))
SELECT g.year, p::BIGINT AS page FROM g, LATERAL (SELECT unnest(range(greatest(1, c - 1), c + 2)) AS p) WHERE g.year IN (SELECT year FROM ok)
UNION ALL SELECT f.year, p::BIGINT FROM f, LATERAL (SELECT unnest(range(greatest(1, c - 1), least((SELECT m FROM m), c + 1) + 1)) AS p)""")
def page_seek_lower_bound(spark: SparkSession, sf: str) -> DataFrame:
    listing = _listing(spark, sf)
    found = discovery.year_pages(listing, listing.select("year").distinct(), 2001, 2, 1, int(listing.agg(F.max("page")).first()[0] or 1))
    return found.select("year", F.col("page").cast("bigint").alias("page"))


def _anchors(spark: SparkSession, sf: str) -> DataFrame:
    o = t(spark, sf, "lineitem")
    return o.select(
        F.col("l_linenumber").alias("page"), F.col("l_orderkey").alias("pos"),
        F.concat(F.lit("/article/s"), (F.col("l_orderkey") % 500).cast("string"), F.when(F.col("l_orderkey") % 500 % 7 == 0, "").otherwise(F.concat(F.lit("-"), (2000 + F.col("l_orderkey") % 500 % 20).cast("string"), F.lit("0102")))).alias("href"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 3 == 0, F.concat(F.lit("T"), F.col("l_orderkey").cast("string"))).otherwise("").alias("text"), F.lit("").alias("aria_label"),
    )


@query("""
WITH a AS (SELECT l_linenumber AS page, l_orderkey AS pos, l_orderkey % 500 AS k, CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 'T' || l_orderkey WHEN l_linenumber % 2 = 0 THEN 'A' || l_orderkey ELSE '' END AS title FROM lineitem)
SELECT min(page)::INT AS page, arg_min(pos, page * 100000000 + pos) AS pos, 'https://b/article/s' || k || '-' || (2000 + k % 20) || '0102' AS url, coalesce(arg_min(title, page * 100000000 + pos) FILTER (WHERE title <> ''), '') AS title, (2000 + k % 20)::INT AS year
FROM a WHERE k % 7 <> 0 GROUP BY k""")
def title_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Titles from the text, else from the aria label without its "read ", of the first anchor that has any."""
    label = F.when(F.col("page") % 2 == 0, F.concat(F.lit("Read A"), F.col("pos").cast("string"))).otherwise("")
    return discovery.listing_articles(_anchors(spark, sf).withColumn("aria_label", label), "https://b")


# --- sampling and quotas
def _even(n: int) -> str:
    return f"""WITH k AS (SELECT o_orderkey, year(o_orderdate)::INT AS year, row_number() OVER (PARTITION BY year(o_orderdate), o_custkey % 50 ORDER BY o_orderkey) - 1 AS k, count(*) OVER (PARTITION BY year(o_orderdate), o_custkey % 50) AS cnt, (o_custkey % 50)::BIGINT AS grp FROM orders)
SELECT o_orderkey, year, grp FROM k WHERE cnt <= {n} OR {f"k = cnt // 2" if n == 1 else f"list_contains(list_transform(range(0, {n}), lambda i: round_even(i * ((cnt - 1) / ({n} - 1.0)), 0)::BIGINT), k)"}"""


def _sample(spark: SparkSession, sf: str, n: int) -> DataFrame:
    o = t(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 50).alias("grp"))
    return sampling.even_spread(o, ["year", "grp"], ["o_orderkey"], n)


@query(_even(3))
def stratified_sample_year(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf, 3)


@query(_even(1))
def stratified_sample_n1(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf, 1)


@query(_even(12))
def stratified_sample_oversample(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf, 3 * 4)


@query("WITH s AS (" + _even(4) + ") SELECT * FROM s ORDER BY year, grp, o_orderkey LIMIT 40")
def stratified_sample_capped(spark: SparkSession, sf: str) -> DataFrame:
    o = t(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 50).alias("grp"))
    return sampling.capped_sample(o, ["year", "grp"], ["o_orderkey"], 4, 40)


@query("""
WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, o_custkey FROM r WHERE k <= 2 ORDER BY o_orderkey LIMIT 500""")
def quota_backfill(spark: SparkSession, sf: str) -> DataFrame:
    o = t(spark, sf, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey")
    return sampling.until_quota(o, ["o_custkey"], ["o_orderkey"], 2, 500, None, ["o_orderkey"])


@query("""
WITH d AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 4 = 0 GROUP BY 1),
r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 4 <> 0)
SELECT o_orderkey, r.o_custkey FROM r LEFT JOIN d USING (o_custkey) WHERE k + coalesce(n, 0) <= 5""")
def quota_seeded(spark: SparkSession, sf: str) -> DataFrame:
    o = t(spark, sf, "orders")
    done = o.where("o_orderkey % 4 = 0").groupBy("o_custkey").count()
    return sampling.until_quota(o.where("o_orderstatus <> 'P' and o_orderkey % 4 <> 0").select("o_orderkey", "o_custkey"), ["o_custkey"], ["o_orderkey"], 5, None, done)


# --- joins, merging, set operators
@query("SELECT * FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) WHERE k = 1".replace("SELECT *", "SELECT user_id, event_id, event_type", 1))
def dedup_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return merge.first_wins(t(spark, sf, "events").select("user_id", "event_id", "event_type"), "user_id", ["event_id"])


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return merge.last_wins(t(spark, sf, "events").select("user_id", "event_id", "event_type"), "user_id", ["event_id"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
def anti_skip(spark: SparkSession, sf: str) -> DataFrame:
    skip = t(spark, sf, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return merge.not_in(t(spark, sf, "customer").select("c_custkey", "c_name"), skip, "c_custkey")


@query("SELECT o_orderkey, 'u' || o_orderkey AS url FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 3)")
def skip_known(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates that aren't held, most of them told apart by a Bloom filter of what is."""
    held = t(spark, sf, "lineitem").where("l_linenumber = 3").select(F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("url"))
    return merge.unknown(t(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url")), held)


@query("SELECT c_custkey, c_nationkey, coalesce(CASE WHEN n_nationkey % 3 <> 0 THEN n_name END, '') AS section FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def left_section_lookup(spark: SparkSession, sf: str) -> DataFrame:
    labels = t(spark, sf, "nation").where("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("section"), F.col("n_nationkey").alias("pos"))
    return merge.looked_up(t(spark, sf, "customer").select("c_custkey", "c_nationkey"), labels, "c_nationkey", "section")


def _corpora(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    d = t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("url"), F.col("doc_id").alias("pos"), F.md5("text").alias("text"))
    return d.where("pos % 3 <> 0").withColumn("text", F.when(F.col("pos") % 5 == 0, " ").otherwise(F.col("text"))), d.where("pos % 2 = 0")


_MERGE = """WITH d AS (SELECT doc_id::VARCHAR AS url, doc_id AS pos, md5(text) AS text FROM documents), e AS (SELECT url, pos, CASE WHEN pos % 5 = 0 THEN ' ' ELSE text END AS text FROM d WHERE pos % 3 <> 0), n AS (SELECT * FROM d WHERE pos % 2 = 0)"""


@query(_MERGE + """
SELECT *, 0 AS src_rank FROM e WHERE NOT (trim(text) = '' AND url IN (SELECT url FROM n))
UNION ALL SELECT *, 1 FROM n WHERE url NOT IN (SELECT url FROM e WHERE trim(text) <> '')""")
def incremental_merge_intent(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merged(*_corpora(spark, sf), "intent")


@query(_MERGE + " SELECT *, 0 AS src_rank FROM e WHERE trim(text) <> '' UNION ALL SELECT *, 1 FROM n WHERE url NOT IN (SELECT url FROM e)")
def incremental_merge_literal(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merged(*_corpora(spark, sf), "literal")


@query("""
WITH d AS (SELECT c_custkey AS k, c_name AS title, '' AS author, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS section FROM customer),
p AS (SELECT o_custkey AS k, max(o_orderpriority) AS section, max(o_orderstatus) AS author, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'body' END AS text FROM orders GROUP BY o_custkey)
SELECT d.k::VARCHAR AS url, title, '' AS subtitle, p.author AS author, '2020-01-01' AS publication_date, coalesce(nullif(d.section, ''), p.section) AS section, '' AS subsection, text FROM d JOIN p USING (k) WHERE text <> ''""")
def field_precedence(spark: SparkSession, sf: str) -> DataFrame:
    e = F.lit("")
    d = t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("url"), F.col("c_name").alias("title"), e.alias("author"), F.lit("2020-01-01").alias("publication_date"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("section"), e.alias("subtitle"), e.alias("subsection"))
    p = t(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("url")).agg(F.max("o_orderpriority").alias("section"), F.max("o_orderstatus").alias("author"))
    p = p.select("url", F.when(F.col("url").cast("bigint") % 4 == 0, "").otherwise("body").alias("text"), e.alias("title"), "author", e.alias("publication_date"), e.alias("subtitle"), "section", e.alias("subsection"))
    return merge.fields_merged(d, p, merge.PRECEDENCE["y"])


@query("SELECT n_name AS name, 0 AS site_rank FROM nation UNION ALL SELECT r_name, 1 FROM region")
def corpus_union(spark: SparkSession, sf: str) -> DataFrame:
    return merge.combined([t(spark, sf, "nation").select(F.col("n_name").alias("name")), t(spark, sf, "region").select(F.col("r_name").alias("name"))])


@query("""
SELECT source, count(*) AS n, count(*) FILTER (WHERE lang = 'xx') AS empty_section, count(*) FILTER (WHERE doc_id % 11 = 0) AS unparsed, (count(*) - count(DISTINCT text))::BIGINT AS duplicates, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def quality_audit(spark: SparkSession, sf: str) -> DataFrame:
    corpus = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left")
    articles = conform(corpus.select(F.col("text").alias("url"), F.col("lang").alias("section"), F.when(F.col("doc_id") % 11 == 0, "UNPARSED:x").otherwise("2020-01-01").alias("publication_date"), F.col("source").alias("institution"), F.when(F.col("quality").isNotNull(), "").otherwise("x").alias("text")))
    found = quality.audit(articles, ["institution"])
    return found.select(F.col("institution").alias("source"), "n", "empty_section", "unparsed", "duplicates", F.col("empty_text").alias("labelled"))


@query("SELECT year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY 1")
def year_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return quality.year_histogram(t(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date")), [])


@query("SELECT year(o_orderdate)::INT AS year, list_sort(list(DISTINCT 'u' || o_custkey % 40)) AS urls FROM orders GROUP BY 1".replace("list_sort(list(DISTINCT 'u' || o_custkey % 40)) AS urls", "array_to_string(list_sort(list(DISTINCT 'u' || o_custkey % 40)), ',') AS urls"))
def cache_urls(spark: SparkSession, sf: str) -> DataFrame:
    rows = t(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.concat(F.lit("u"), (F.col("o_custkey") % 40).cast("string")).alias("url"))
    document = files.cache_document(rows, "urls", {"year_end": 2001}, "2026-01-01T00:00:00+00:00")
    years = document.select(F.explode(F.from_json("value", "struct<by_year:map<string,array<string>>>")["by_year"]).alias("year", "urls"))
    return years.select(F.col("year").cast("int").alias("year"), F.array_join("urls", ",").alias("urls"))


# --- DOM, relation tier, and whole extractions: no SQL counterpart
@query()
def dom_densest_container(spark: SparkSession, sf: str) -> DataFrame:
    found = dom.trees(t(spark, sf, "pages")).withColumn("best", dom.densest_container()).where("best is not null")
    return found.select("page_id", text.collapse(dom.paragraphs_of(F.col("best"))).alias("text"))


@query("SELECT page_id, len(regexp_extract_all(html, '<p[ >]')) AS n_p, len(regexp_extract_all(html, '<a ')) AS n_a FROM pages")
def dom_node_counts(spark: SparkSession, sf: str) -> DataFrame:
    nodes = dom.html_nodes(t(spark, sf, "pages"))
    return nodes.groupBy("page_id").agg(F.count_if(F.col("tag") == "p").alias("n_p"), F.count_if(F.col("tag") == "a").alias("n_a"))


@query()
def site_pages_n(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(t(spark, sf, "pages"), SITES["n"])


@query()
def site_pages_y(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(t(spark, sf, "pages"), SITES["y"])


@query()
def site_pages_d(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(t(spark, sf, "pages"), SITES["d"])


@query()
def site_pages_c(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(t(spark, sf, "pages"), SITES["c"])

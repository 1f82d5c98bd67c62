"""Discovery as a run: captured sitemaps, feeds, listings and section pages -> a site's candidates, through its cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import discovery, sampling
from ..operators.dom import anchors, followed
from ..ship import cut
from ..sources import xml
from ..sources.files import read_cache, write_cache
from .sites import SECTION_PAGES

CANDIDATE = ("url", "title", "author", "publication_date", "section")
#: The captured tables that a site's discovery reads, and their columns.
INPUTS = {
    "n": {"sitemaps": "file, xml", "feed": "[page,] xml"},
    "d": {"listings": "page, url, html"},
    "y": {"sitemap": "file, xml", "sections": "slug, html"},
    "c": {"sitemaps": "file, xml"},
}


def _ordered(rows: DataFrame, *order: str) -> DataFrame:
    """Candidates with pos by the given order, missing fields empty. What is numbered is a sample or has a cap."""
    have = set(rows.columns)
    fields = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in CANDIDATE]
    extra = [c for c in ("year", "lastmod") if c in have]
    return rows.select((F.row_number().over(Window.orderBy(*order)) - 1).alias("pos"), *fields, *extra)


def _cached(spark, path: str | None, kind: str, key: dict, refresh: bool, cached_at: str, scan) -> DataFrame:  # noqa: ANN001
    """Rows of the cache; without one (or with refresh) those of a scan, which is written if it has any."""
    if path and not refresh:
        held = read_cache(spark, path, kind, key)
        if held is not None:
            return held
    rows = scan()
    if path and write_cache(rows, path, kind, key, cached_at):
        return read_cache(spark, path, kind, key)
    return rows


def _entries(files: DataFrame) -> DataFrame:
    """Entries of sitemap files with pos over all of them, in order of file."""
    return xml.sitemap_entries(files).withColumn("pos", F.struct("file", "pos"))


def _discover_n(spark, config: dict, inputs: dict, cache) -> DataFrame:  # noqa: ANN001
    if config.get("discovery_mode", "sitemap") != "sitemap":
        return _ordered(xml.feed_items(inputs["feed"], int(config.get("max_articles", 100))), "pos")
    first, last = int(config.get("year_start", 2000)), int(config["year_end"])
    host = config["host"]
    rows = cache("urls", {"host": host}, lambda: discovery.dated_candidates(_entries(inputs["sitemaps"]), host, 0, 9999))
    spread = discovery.spread_dated(rows.where(F.col("year").between(first, last)), int(config.get("per_year", 2)))
    return _ordered(spread, "year", "url")


def _discover_d(spark, config: dict, inputs: dict, cache) -> DataFrame:  # noqa: ANN001
    base, label = config["base_url"].rstrip("/"), config.get("section_label", "News")
    most = int(config.get("max_articles", 100))
    if config.get("year_start") is None or not config.get("per_year"):
        start = config.get("section_url") or f"{base}/section/news"
        walked = followed(inputs["listings"].select("url", "html"), start, int(config.get("max_pages", 5)))
        rows = discovery.recent_articles(anchors(walked), base, 1 << 30, most)
        return _ordered(rows.withColumn("section", F.lit(label)), "page", "pos")
    first, last = int(config["year_start"]), int(config["year_end"])

    def scan() -> DataFrame:
        listing = cut(discovery.page_articles(anchors(inputs["listings"].select("page", "html")), base))  # read three times, parsed once
        years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
        pages = discovery.year_pages(listing, years, last, int(config.get("pages_per_year", 28)), int(config.get("page_window", 3)), int(config.get("max_pages", 400)))
        return discovery.year_records(listing, pages).select("year", "url", "title", F.lit("").alias("author"), F.lit("").alias("publication_date"), F.lit(label).alias("section"))

    rows = cache("metas", {"year_start": first, "year_end": last, "base_url": base}, scan)
    picked = sampling.capped_sample(rows.where(F.col("year").between(first, last)), ["year"], ["url"], int(config["per_year"]), most)
    return _ordered(picked, "year", "url")


def _discover_y(spark, config: dict, inputs: dict, cache) -> DataFrame:  # noqa: ANN001
    base, most = config["base_url"].rstrip("/"), int(config.get("max_articles", 100))
    listed = [(i, slug, label) for i, (slug, label) in enumerate(config.get("section_pages") or SECTION_PAGES)]
    names = spark.createDataFrame(listed, "page int, slug string, section string")
    links = discovery.section_links(anchors(inputs["sections"].join(F.broadcast(names), "slug").select("page", "section", "html")), base)
    if config.get("articles_sitemap") or config.get("discovery_mode") == "sitemap":
        return _ordered(discovery.sitemap_with_sections(_entries(inputs["sitemap"]).drop("lastmod"), links, most), "pos")
    return _ordered(discovery.section_articles(links, most), "page", "pos")


def _discover_c(spark, config: dict, inputs: dict, cache) -> DataFrame:  # noqa: ANN001
    first, last, host = int(config.get("year_start", 2016)), int(config["year_end"]), config["host"]
    rows = cache("pairs", {"host": host}, lambda: discovery.lastmod_candidates(_entries(inputs["sitemaps"]), host, 0, 9999))
    spread = discovery.spread_lastmod(rows.where(F.col("year").between(first, last)), int(config.get("per_year", 2)), literal=bool(config.get("literal")))
    return _ordered(spread, "year", "url", "pos")


DISCOVERERS = {"n": _discover_n, "d": _discover_d, "y": _discover_y, "c": _discover_c}


def discover(spark, key: str, config: dict, inputs: dict[str, DataFrame], cache_path: str | None = None, refresh: bool = False, cached_at: str = "") -> DataFrame:  # noqa: ANN001
    """Candidates of a site: pos, url, title, author, publication_date, section[, year, lastmod].

    config: the site's configuration (year_end and host or base_url must be given); inputs: its captured tables (INPUTS).
    A cache made with other parameters is not used; refresh scans anew and rewrites it.
    """

    def cache(kind: str, parameters: dict, scan) -> DataFrame:  # noqa: ANN001
        return _cached(spark, cache_path, kind, parameters, refresh, cached_at, scan)

    return DISCOVERERS[key](spark, config, inputs, cache)

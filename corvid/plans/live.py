"""Live input of a run: the tables that a site's discovery reads, and its candidates' pages, fetched politely into a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import listing_page
from ..operators import merge
from ..sources import web, xml
from .sites import SECTION_PAGES

#: What the names of the sub-sitemaps with articles hold.
MARKERS = {"n": "post-sitemap", "c": "wp-sitemap-posts-post"}


def _bodies(spark: SparkSession, rows: DataFrame, config: dict, folder: str, opener: web.Opener) -> DataFrame:
    """rows (url, ...) with the html of those that were answered."""
    found = web.crawl(rows, config, folder, opener=opener)
    return rows.join(found.where("html is not null").select("url", "html"), "url")


def _sitemaps(spark: SparkSession, key: str, config: dict, folder: str, opener: web.Opener) -> DataFrame:
    """file, xml of the sub-sitemaps of the site's index."""
    index = _bodies(spark, spark.createDataFrame([(config["sitemap_index"],)], "url string"), config, f"{folder}/index", opener)
    subs = xml.sub_sitemaps(index.drop("url"), config.get("sitemap_marker", MARKERS.get(key, "sitemap")), "html").select(F.col("pos").alias("file"), "url")
    return _bodies(spark, subs, config, f"{folder}/sitemaps", opener).select("file", F.col("html").alias("xml"))


def tables(spark: SparkSession, key: str, config: dict, folder: str, opener: web.Opener = web.opened) -> dict[str, DataFrame]:
    """The tables of discover.INPUTS that the site's configuration asks for."""
    if key in ("n", "c"):
        if key == "n" and config.get("discovery_mode", "sitemap") != "sitemap":
            feed = spark.createDataFrame([(config["rss_url"],)], "url string")
            return {"feed": _bodies(spark, feed, config, f"{folder}/feed", opener).select(F.col("html").alias("xml"))}
        return {"sitemaps": _sitemaps(spark, key, config, folder, opener)}
    base = config["base_url"].rstrip("/")
    if key == "d":
        start = config.get("section_url") or f"{base}/section/news"
        pages = spark.range(1, int(config.get("max_pages", 5)) + 1).select(F.col("id").cast("int").alias("page"), listing_page(F.lit(start), F.col("id")).alias("url"))
        return {"listings": _bodies(spark, pages, config, f"{folder}/listings", opener)}
    listed = spark.createDataFrame([(slug, f"{base}/{slug}") for slug, _ in config.get("section_pages") or SECTION_PAGES], "slug string, url string")
    out = {"sections": _bodies(spark, listed, config, f"{folder}/sections", opener).select("slug", "html")}
    if config.get("articles_sitemap"):
        one = spark.createDataFrame([(0, config["articles_sitemap"])], "file int, url string")
        out["sitemap"] = _bodies(spark, one, config, f"{folder}/sitemap", opener).select("file", F.col("html").alias("xml"))
    return out


def pages(spark: SparkSession, candidates: DataFrame, held: DataFrame, config: dict, folder: str, opener: web.Opener = web.opened) -> DataFrame:
    """url, html of the candidates that aren't held with text yet. held: url."""
    found = web.crawl(merge.unknown(candidates.select("url").distinct(), held), config, f"{folder}/articles", opener=opener)
    return found.where("html is not null").select("url", "html")

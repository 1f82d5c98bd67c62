"""Sitemaps and feeds as columns of XML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _c
from ..operators.sampling import first_rows

_NAMED = "//*[local-name()='{}']"


def locs(xml: Column | str) -> Column:
    """All non-blank loc values in document order, trimmed."""
    found = F.xpath(_c(xml), F.lit(_NAMED.format("loc") + "/text()"))
    return F.filter(F.transform(found, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def sitemap_urls(files: DataFrame, xml: str = "xml") -> DataFrame:
    """files with pos, url for each loc."""
    rest = [c for c in files.columns if c != xml]
    return files.select(*rest, F.posexplode(locs(xml)).alias("pos", "url"))


def sitemap_entries(files: DataFrame, xml: str = "xml") -> DataFrame:
    """files with pos, url, lastmod for each url element that has a loc; lastmod empty where missing."""
    rest = [c for c in files.columns if c != xml]
    # namespaces are dropped so that one schema reads them all
    plain = F.regexp_replace(xml, r"\sxmlns(?::\w+)?=(?:\"[^\"]*\"|'[^']*')", "")
    parsed = F.from_xml(plain, "struct<url:array<struct<loc:string,lastmod:string>>>")
    rows = files.select(*rest, F.posexplode(parsed["url"]).alias("pos", "u"))
    return rows.select(*rest, "pos", F.regexp_replace("u.loc", r"^\s+|\s+$", "").alias("url"), F.coalesce(F.trim("u.lastmod"), F.lit("")).alias("lastmod")).where("url <> ''")


def sub_sitemaps(index: DataFrame, marker: str, xml: str = "xml") -> DataFrame:
    """The sub-sitemaps of an index that contain the marker and end in .xml."""
    return sitemap_urls(index, xml).where(F.col("url").contains(marker) & F.col("url").endswith(".xml"))


def feed_items(feeds: DataFrame, most: int, xml: str = "xml") -> DataFrame:
    """pos, url, title, author, publication_date, section of the first `most` items; items without a link go after that.

    A feed that comes in several documents has their order in a column page: the first `most` of all are taken, and pos is (page, pos)."""
    plain = F.regexp_replace(F.regexp_replace(xml, r"\sxmlns(?::\w+)?=(?:\"[^\"]*\"|'[^']*')", ""), r"<(/?)dc:creator", "<$1author")
    item = "struct<link:string,title:string,author:string,pubDate:string,category:array<string>>"
    parsed = F.from_xml(plain, f"struct<channel:struct<item:array<{item}>>>")
    paged = ["page"] if "page" in feeds.columns else []
    rows = feeds.select(*paged, F.posexplode(parsed["channel"]["item"]).alias("pos", "i")).where(F.col("pos") < most)
    if paged:
        rows = first_rows(rows.select(F.struct("page", "pos").alias("pos"), "i"), ["pos"], most)
    e = F.lit("")
    return rows.select("pos", F.coalesce(F.trim("i.link"), e).alias("url"), F.coalesce("i.title", e).alias("title"), F.coalesce("i.author", e).alias("author"), F.coalesce("i.pubDate", e).alias("publication_date"), F.coalesce(F.get("i.category", 0), e).alias("section")).where("url <> ''")

"""Discovery: from sitemap, listing and section-page rows to candidate records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, urls
from ..functions.text import title_or_aria
from .merge import first_wins, looked_up
from .sampling import even_spread, first_rows


def dated_candidates(sitemap: DataFrame, host: str, first_year: int, last_year: int) -> DataFrame:
    """site N: year, url, pos of article URLs that carry their year; games left out."""
    kept = sitemap.where(urls.dated_article("url", host) & ~urls.is_game("url")).withColumn("year", urls.year_in_path("url"))
    return kept.where(F.col("year").between(first_year, last_year))


def lastmod_candidates(sitemap: DataFrame, host: str, first_year: int, last_year: int) -> DataFrame:
    """site C: the year is that of lastmod; rows without one go."""
    kept = sitemap.where(urls.numbered_article("url", host)).withColumn("year", dates.iso_year("lastmod"))
    return kept.where(F.col("year").between(first_year, last_year))


def year_buckets(candidates: DataFrame) -> DataFrame:
    """year, urls: distinct, sorted."""
    return candidates.groupBy("year").agg(F.array_sort(F.collect_set("url")).alias("urls"))


def spread_dated(candidates: DataFrame, per_year: int, oversample: int = 4) -> DataFrame:
    """Distinct URLs, an even spread of each year."""
    return even_spread(candidates.select("year", "url").distinct(), ["year"], ["url"], per_year * oversample).withColumn("publication_date", urls.date_in_path("url"))


def spread_lastmod(candidates: DataFrame, per_year: int, oversample: int = 4, literal: bool = False) -> DataFrame:
    """Duplicates consume quota only in literal mode."""
    rows = candidates if literal else first_wins(candidates, "url", ["pos"])
    return even_spread(rows, ["year"], ["url", "pos"], per_year * oversample).withColumn("section", urls.section_in_path("url"))


def listing_articles(anchors: DataFrame, base: str, year: int | None = None) -> DataFrame:
    """page, pos, url, title, year of anchors (page, pos, href, text, aria_label) to /article/; undated ones go. The first
    anchor of a URL wins; an empty title is filled from the next one that has any."""
    links = anchors.where(F.col("href").startswith("/article/")).withColumn("url", F.concat(F.lit(base), "href")).withColumn("year", urls.year_in_slug("url")).where("year is not null")
    if year is not None:
        links = links.where(F.col("year") == year)
    return first_with_title(links)


def page_articles(anchors: DataFrame, base: str) -> DataFrame:
    """page, pos, url, title, year: the dated articles of each listing page; within a page the first anchor of a URL wins, its title filled
    from the next that has any."""
    links = anchors.where(F.col("href").startswith("/article/")).withColumn("url", F.concat(F.lit(base), "href")).withColumn("year", urls.year_in_slug("url")).where("year is not null")
    title = title_or_aria("text", "aria_label")
    named = F.coalesce(F.min_by(title, F.when(title != "", F.col("pos"))), F.lit("")).alias("title")
    return links.groupBy("page", "url", "year").agg(F.min("pos").alias("pos"), named).select("page", "pos", "url", "title", "year")


def year_records(listing: DataFrame, pages: DataFrame) -> DataFrame:
    """year, url, title of each year's articles on its pages (year, page); of a URL on several pages the last page wins."""
    on = listing.join(pages, ["year", "page"])
    return on.groupBy("year", "url").agg(F.max_by("title", "page").alias("title"))


def first_with_title(links: DataFrame) -> DataFrame:
    at = F.struct("page", "pos")
    title = title_or_aria("text", "aria_label")
    return links.groupBy("url", "year").agg(F.min(at).alias("at"), F.coalesce(F.min_by(title, F.when(title != "", at)), F.lit("")).alias("title")).select("at.page", "at.pos", "url", "title", "year")


def recent_articles(anchors: DataFrame, base: str, max_pages: int, max_articles: int) -> DataFrame:
    """The first pages of a listing, undated articles included."""
    links = anchors.where((F.col("page") <= max_pages) & F.col("href").startswith("/article/")).withColumn("url", F.concat(F.lit(base), "href")).withColumn("year", urls.year_in_slug("url"))
    return first_rows(first_with_title(links), ["page", "pos"], max_articles)


def page_years(articles: DataFrame) -> DataFrame:
    return articles.groupBy("page").agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def estimated_page(year, year_end: int, per_year: int):  # noqa: ANN001, ANN201
    return F.greatest(F.lit(1), (F.lit(year_end) - year) * per_year + 1)


def year_pages(listing: DataFrame, years: DataFrame, year_end: int, per_year: int, window: int, max_page: int) -> DataFrame:
    """year, page: the listing pages to read for each year.

    The window around the estimate; where no article of the year is on it, the window around the page that a binary search over
    1..max_page for the lowest page whose oldest article is not newer than the year ends at; a page without dated articles
    stops the search at what it has (at first the estimate). listing: page, year; years: year.
    """
    guess = years.select("year", estimated_page(F.col("year"), year_end, per_year).alias("centre"))
    around = guess.select("year", "centre", F.explode(F.sequence(F.greatest(F.lit(1), F.col("centre") - window), F.col("centre") + window)).alias("page"))
    on_window = around.join(listing.select("page", "year").distinct(), ["page", "year"]).select("year").distinct()
    spans = page_years(listing)
    missing = guess.join(on_window, "year", "left_anti")
    sought = _searched(missing, spans, max_page)
    low, high = F.greatest(F.lit(1), F.col("centre") - window), F.least(F.lit(max_page), F.col("centre") + window)
    moved = sought.select("year", F.explode(F.when(low <= high, F.sequence(low, high))).alias("page"))
    return around.join(on_window, "year", "left_semi").select("year", "page").unionByName(moved)


def _searched(years: DataFrame, spans: DataFrame, max_page: int) -> DataFrame:
    """year, centre: where the binary search of each year (year, centre) ends. The spans searched are at most max_page rows."""
    held = spans.where(F.col("page").between(1, max_page)).agg(F.map_from_entries(F.collect_list(F.struct(F.col("page").cast("int"), "min_year"))).alias("lows"))
    both = years.withColumn("one", F.lit(1)).join(F.broadcast(held.withColumn("one", F.lit(1))), "one")
    start = F.struct(F.lit(1).alias("lo"), F.lit(max_page).alias("hi"), F.col("centre").cast("int").alias("at"))

    def step(s, _):  # noqa: ANN001, ANN202
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        low = F.try_element_at("lows", middle)
        stopped = F.struct(F.lit(1).alias("lo"), F.lit(0).alias("hi"), s["at"].alias("at"))
        newer = F.struct((middle + 1).alias("lo"), s["hi"].alias("hi"), s["at"].alias("at"))
        found = F.struct(s["lo"].alias("lo"), (middle - 1).alias("hi"), middle.alias("at"))
        return F.when(s["lo"] > s["hi"], s).when(low.isNull(), stopped).when(low > F.col("year"), newer).otherwise(found)

    steps = F.sequence(F.lit(1), F.lit(max_page.bit_length() + 1))
    return both.select("year", F.aggregate(steps, start, step)["at"].alias("centre"))


def section_links(anchors: DataFrame, base: str) -> DataFrame:
    """page, pos, url, text, section of the anchors of section pages (page, section, pos, href, text) that lead to articles."""
    return anchors.withColumn("url", urls.resolved(F.lit(f"{base}/"), "href")).where(urls.slug_article("url")).select("page", "pos", "url", "text", "section")


def section_articles(links: DataFrame, max_articles: int) -> DataFrame:
    """page, pos, url, title, section: the first link of each article, in order of section pages; the first max_articles."""
    first = links.groupBy("url").agg(F.min(F.struct("page", "pos", F.col("text").alias("title"), "section")).alias("x")).select("url", "x.*")
    return first_rows(first, ["page", "pos"], max_articles)


def section_labels(anchors: DataFrame) -> DataFrame:
    """url -> the label of the first section page that links it. anchors: page, pos, url, section."""
    at = F.struct("page", "pos")
    return anchors.where(urls.slug_article("url")).groupBy("url").agg(F.min_by("section", at).alias("section"), F.min(at).alias("pos"))


def sitemap_with_sections(sitemap: DataFrame, anchors: DataFrame, max_articles: int) -> DataFrame:
    """Article URLs of a sitemap in order, labelled by section pages where these link them; the first max_articles."""
    articles = first_rows(sitemap.where(urls.slug_article("url")), ["pos"], max_articles)
    return looked_up(articles, section_labels(anchors), "url", "section")

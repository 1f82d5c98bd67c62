"""The article record: ten strings, none null, url the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_COLS = ("institution", "title", "subtitle", "author", "publication_date", "section", "subsection", "url", "text", "scraped_at")
ARTICLE = T.StructType([T.StructField(c, T.StringType(), False) for c in ARTICLE_COLS])
PAGE_COLS = ("text", "title", "author", "publication_date", "subtitle", "section", "subsection")


def conform(df: DataFrame) -> DataFrame:
    """The article columns by name: missing ones and nulls become empty, extra ones go, rows without a url go."""
    have = set(df.columns)
    picked = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in ARTICLE_COLS])
    return picked.where("url <> ''")


def empty_page():  # noqa: ANN201
    """The page fields of a page that gives none: all empty."""
    return F.struct(*[F.lit("").alias(c) for c in PAGE_COLS])

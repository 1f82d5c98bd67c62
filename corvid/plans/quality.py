"""Data-quality audits of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ARTICLE_COLS


def metrics(sketch: float = 0.01) -> dict[str, Column]:
    """What audit() counts, as aggregates that a write observes while it writes: no second scan. Distinct URLs are a sketch (relative error `sketch`)."""
    blanks = {f"empty_{c}": F.count_if(F.col(c) == "") for c in ARTICLE_COLS}
    return {**blanks, "unparsed": F.count_if(F.col("publication_date").startswith("UNPARSED:")), "urls": F.approx_count_distinct("url", sketch)}


def audit(corpus: DataFrame, by: list[str]) -> DataFrame:
    """Rows, empty values of each field, unparsed dates, blank and duplicate URLs."""
    blanks = [F.count_if(F.col(c) == "").alias(f"empty_{c}") for c in ARTICLE_COLS]
    return corpus.groupBy(*by).agg(F.count("*").alias("n"), *blanks, F.count_if(F.col("publication_date").startswith("UNPARSED:")).alias("unparsed"), (F.count("*") - F.countDistinct("url")).alias("duplicates"))


def year_histogram(corpus: DataFrame, by: list[str]) -> DataFrame:
    year = F.when(F.col("publication_date").rlike("^[0-9]{4}-"), F.left("publication_date", F.lit(4)).try_cast("int"))
    return corpus.groupBy(*by, year.alias("year")).agg(F.count("*").alias("n"))


def violations(corpus: DataFrame) -> DataFrame:
    """Rows that break an invariant: a null field, a blank url, a date that is neither ISO nor marked."""
    null = F.lit(False)
    for c in ARTICLE_COLS:
        null = null | F.col(c).isNull()
    return corpus.where(null | (F.col("url") == "") | ~F.col("publication_date").rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}$|UNPARSED:)"))

"""Sampling, quotas and limits by rank in an explicit order.

Group keys are (site, year) or the like, and a group may hold most of the rows: ranks are made of counts of key ranges, quotas keep each task's first rows
only before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..ship import cut


def _c(x: Column | str | int) -> Column:
    return F.lit(x) if isinstance(x, int) else F.col(x) if isinstance(x, str) else x


def _key(columns: list) -> Column:
    return F.struct(*columns) if columns else F.struct(F.lit(0))


def ranked(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """row (all columns of df), k (from 0) and n of each row: its rank in its group by order, and the size of the group.

    The rows are dealt out by ranges of (by, order) and written; a row's rank is its rank in its range plus the counts of the group's ranges before. A
    group of any size is many tasks; what meets in one window are the counts of its ranges.
    """
    dealt = df.repartitionByRange(*by, *order) if by or order else df
    rows = cut(dealt.select(F.struct("*").alias("row"), _key(by).alias("g"), _key(order).alias("o"), F.spark_partition_id().alias("range")))
    sizes = rows.groupBy("g", "range").agg(F.count("*").alias("size"))
    group = Window.partitionBy("g")
    before = sizes.select("g", "range", (F.sum("size").over(group.orderBy("range")) - F.col("size")).alias("before"), F.sum("size").over(group).alias("n"))
    local = rows.withColumn("k", F.row_number().over(Window.partitionBy("g", "range").orderBy("o")) - 1)
    return local.join(before, ["g", "range"]).select("row", (F.col("k") + F.col("before")).alias("k"), "n")


def even_spread(df: DataFrame, by: list[str], order: list[Column | str], n: int | Column) -> DataFrame:
    """n rows spread evenly over each group's order, both ends included: row round_half_even(i * (len - 1) / (n - 1)); all rows
    where there are no more than n; the row len // 2 for n = 1; none for n <= 0."""
    rows = ranked(df.select(F.struct("*").alias("all"), *[F.col(c).alias(f"b{i}") for i, c in enumerate(by)], *[_c(c).alias(f"o{i}") for i, c in enumerate(order)], _c(n).alias("wanted")), [f"b{i}" for i in range(len(by))], [f"o{i}" for i in range(len(order))])
    n = F.col("row.wanted")
    k, length = F.col("k"), F.col("n")
    step = (length - 1) / F.when(n > 1, n - 1)
    # the pick that could land on row k is the one nearest to k / step
    near = F.floor(k / step)
    hit = F.lit(False)
    for d in (-1, 0, 1, 2):
        i = near + d
        hit = hit | ((i >= 0) & (i < n) & (F.rint(i * step) == k))
    keep = F.when(n <= 0, False).when(length <= n, True).when(n == 1, k == F.floor(length / 2)).otherwise(hit)
    return rows.where(keep).select("row.all.*")


def until_quota(df: DataFrame, by: list[str], order: list[Column | str], quota: int, cap: int | None = None, done: DataFrame | None = None, cap_order: list[Column | str] | None = None) -> DataFrame:
    """Successes in order until each group has `quota` (those in `done`, with a count column, included), and `cap` in all. Rows without a
    group (a null in `by`) have no quota.

    df holds the rows that succeeded and aren't skipped; equal to fetching one by one and stopping at the quota. A task sends at most `quota` rows of a
    group to its window (a group limit before the shuffle).
    """
    grouped = F.lit(True)
    for c in by:
        grouped = grouped & F.col(c).isNotNull()
    rows = df.where(grouped).select(F.struct("*").alias("row"), _key(by).alias("g"), _key(order).alias("o"))
    first = rows.withColumn("k", F.row_number().over(Window.partitionBy("g").orderBy("o"))).where(F.col("k") <= quota)
    if done is not None:
        first = first.join(done.select(_key(by).alias("g"), F.col("count").alias("had")), "g", "left").where(F.col("k") + F.coalesce("had", F.lit(0)) <= quota)
    out = first.select("row.*")
    if by:
        out = out.unionByName(df.where(~grouped))
    return out if cap is None else first_rows(out, cap_order or order, cap)


def first_rows(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """The first n rows in order: a top-n, not a full sort."""
    return df.orderBy(*order).limit(max(n, 0))


def capped_sample(df: DataFrame, by: list[str], order: list[Column | str], n: int, cap: int) -> DataFrame:
    """Even spread of each group, groups in order, until `cap` rows; the test follows each row, so at least one row comes."""
    return first_rows(even_spread(df, by, order, n), [*by, *order], max(cap, 1))

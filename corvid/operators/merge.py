"""Joins and set operators of the incremental corpus: first-wins, anti joins, merge modes, field precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_nonempty


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order. An aggregate, so rows of a hot key combine before the shuffle."""
    rest = [c for c in df.columns if c != key and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("r")
    return df.groupBy(key).agg(least).select(key, "r.*").select(*df.columns)


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c != key and c not in order]
    return df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("r")).select(key, "r.*").select(*df.columns)


def not_in(df: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    return df.join(known.select(key).distinct(), key, "left_anti")


def looked_up(df: DataFrame, labels: DataFrame, key: str, value: str) -> DataFrame:
    """df with `value` from labels, first label of a key in order of pos; empty where there is none."""
    first = labels.groupBy(key).agg(F.min_by(value, "pos").alias(value))
    return df.join(first, key, "left").withColumn(value, F.coalesce(value, F.lit("")))


def merged(existing: DataFrame, new: DataFrame, mode: str = "intent", url: str = "url", text: str = "text", pos: str = "pos") -> DataFrame:
    """Existing rows and new rows, in that order (src_rank, pos).

    intent: a new row replaces an existing one whose text is blank. literal: rows of known URLs are dropped from the new ones first, and
    then an existing blank row goes, so a refetched blank URL is missing until the next run.
    """
    known = existing.select(url).distinct()
    blank = F.trim(text) == ""
    fresh = first_wins(new, url, [pos])
    if mode == "literal":
        kept, added = existing.where(~blank), fresh.join(known, url, "left_anti")
    elif mode == "intent":
        filled = existing.where(~blank).select(url).distinct()
        added = fresh.join(filled, url, "left_anti")
        kept = existing.join(added.select(url), url, "left_anti")
    else:
        raise ValueError(f"unknown mode: {mode}")
    return kept.withColumn("src_rank", F.lit(0)).unionByName(added.withColumn("src_rank", F.lit(1)))


#: Bits of a Bloom filter for each key, hash functions, and the most bits a filter may have (16 MB, broadcast): 13 million keys.
BLOOM_BITS, BLOOM_HASHES, BLOOM_MOST = 10, 6, 1 << 27


def bloom(known: DataFrame, key: str) -> tuple[DataFrame, int] | None:
    """A Bloom filter of the keys: one row, words array<bigint>, and its number of bits. None where it would be larger than BLOOM_MOST, which is
    checked before anything is built, and for no keys."""
    keys = known.select(F.col(key).cast("string").alias("key")).where("key is not null")
    n = keys.agg(F.approx_count_distinct("key", 0.02)).first()[0]
    bits = (int(n * 1.1) * BLOOM_BITS + 64) // 64 * 64
    if not n or bits > BLOOM_MOST:
        return None
    at = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(i), "key"), F.lit(bits)) for i in range(BLOOM_HASHES)])).alias("at")
    words = keys.select(at).groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))).alias("bits"))
    every = known.sparkSession.range(bits // 64).select(F.col("id").alias("word")).join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words")), bits


def might_hold(words: Column, bits: int, key: Column) -> Column:
    """Whether the filter may hold a key: false means it doesn't."""
    held = F.lit(True)
    for i in range(BLOOM_HASHES):
        at = F.pmod(F.xxhash64(F.lit(i), key.cast("string")), F.lit(bits))
        held = held & (F.bit_get(F.get(words, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1)
    return held


def unknown(df: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """df without the keys of a known set, exactly; rows without a key stay.

    Where the set's Bloom filter is small enough to broadcast, rows that it can't hold are done with without a shuffle. The others meet the keys of the set
    that they ask for: a semi join, which needs no shuffle of the set where they are few. df is read more than once.
    """
    made = bloom(known, key)
    if made is None:
        return _without(df, known, key)
    one = F.broadcast(made[0].withColumn("one", F.lit(1)).alias("f"))
    rows = df.select(F.struct("*").alias("row"), F.lit(1).alias("one")).join(one, "one")
    judged = rows.select("row", F.coalesce(might_hold(F.col("words"), made[1], F.col("row")[key]), F.lit(False)).alias("maybe"))
    sure = judged.where(~F.col("maybe")).select("row.*")
    return sure.unionByName(_without(judged.where("maybe").select("row.*"), known, key))


def _without(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    met = known.select(key).join(df.select(key).distinct(), key, "left_semi").distinct()
    return df.join(met, key, "left_anti")


def changes(held: DataFrame, new: DataFrame, mode: str = "intent", url: str = "url", pos: str = "pos") -> DataFrame:
    """What merged() changes: new rows to put (gone false) and, in literal mode, tombstones (gone true, other columns empty) of the rows that go.

    held: url and filled (whether the text isn't blank) of the rows that are there.
    """
    fresh = first_wins(new, url, [pos])
    if mode == "intent":
        return not_in(fresh, held.where("filled"), url).withColumn("gone", F.lit(False))
    if mode != "literal":
        raise ValueError(f"unknown mode: {mode}")
    added = not_in(fresh, held, url).withColumn("gone", F.lit(False))
    nothing = [F.lit("" if kind == "string" else None).cast(kind).alias(c) for c, kind in new.dtypes if c not in (url, pos)]
    blank = held.where("not filled").select(F.lit(0).cast(dict(new.dtypes)[pos]).alias(pos), F.col(url), *nothing, F.lit(True).alias("gone"))
    return added.unionByName(blank)


def combined(sites: list[DataFrame]) -> DataFrame:
    """All sites, in order of site_rank."""
    out = None
    for rank, df in enumerate(sites):
        ranked = df.withColumn("site_rank", F.lit(rank))
        out = ranked if out is None else out.unionByName(ranked)
    return out


#: Which side a field comes from, first non-empty first: p the page, d the discovery record, l its lastmod; empty: constant "".
PRECEDENCE: dict[str, dict[str, str]] = {
    "n": {"title": "pd", "subtitle": "", "author": "pd", "publication_date": "pd", "section": "pd", "subsection": "p"},
    "d": {"title": "d", "subtitle": "p", "author": "pd", "publication_date": "pd", "section": "pd", "subsection": "p"},
    "y": {"title": "dp", "subtitle": "p", "author": "pd", "publication_date": "pd", "section": "dp", "subsection": ""},
    "c": {"title": "pd", "subtitle": "p", "author": "pd", "publication_date": "pl", "section": "pd", "subsection": "p"},
}


def fields_merged(discovered: DataFrame, pages: DataFrame, precedence: dict[str, str], url: str = "url") -> DataFrame:
    """One row for each discovered URL whose page has text: url, text and the merged fields; other columns of discovered stay, but lastmod and a text of its own."""
    p, d = pages.alias("p"), discovered.alias("d")

    def pick(field: str) -> Column:
        sides = {"p": f"p.{field}", "d": f"d.{field}", "l": "d.lastmod"}
        return first_nonempty(*[F.col(sides[s]) for s in precedence[field]]).alias(field) if precedence[field] else F.lit("").alias(field)

    rest = [f"d.`{c}`" for c in discovered.columns if c not in (url, "text", "lastmod") and c not in precedence]
    return d.join(p, F.col(f"d.{url}") == F.col(f"p.{url}")).where(F.trim(F.col("p.text")) != "").select(F.col(f"d.{url}").alias(url), *map(pick, precedence), "p.text", *rest)


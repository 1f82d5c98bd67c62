"""CSV corpus files and discovery caches.

A cache is a folder: rows/, Parquet by year, and manifest/, one small JSON text with kind, key (the parameters it was made with) and time. No task holds
more than its share of a year. The JSON document of all years is for exchange (export_cache, and read_cache of such a file).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import ARTICLE, ARTICLE_COLS, conform

CSV = {"header": True, "multiLine": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none where there is no folder."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def renamed(spark: SparkSession, old: str, new: str) -> None:
    """Puts a folder in place; an error where there is one of that name."""
    fs, p = _fs(spark, new)
    if fs.exists(p) or not fs.rename(_fs(spark, old)[1], p):
        raise FileExistsError(new)


def deleted(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def touched(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p).close()


def size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A corpus file by header name; a missing file is an empty corpus."""
    if not exists(spark, path):
        return spark.createDataFrame([], ARTICLE)
    return conform(spark.read.options(**CSV).csv(path))


def write_csv(df: DataFrame, path: str, single: bool = True, found: dict | None = None, metrics: dict[str, Column] | None = None) -> int:
    """Writes the article columns with a header (also without rows) and returns the number of rows.

    single: one file, for hand-over of one site's corpus; otherwise as many as there are partitions. metrics: name -> aggregate over the rows,
    counted as they are written and put into found.
    """
    counted = Observation()
    rows = df.select(*ARTICLE_COLS).observe(counted, F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in (metrics or {}).items()])
    (rows.coalesce(1) if single else rows).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if found is not None:
        found.update(counted.get)
    return counted.get["n"]


#: The columns of a kind of cache. urls: distinct; metas: one record of a URL and year; pairs: in order of pos.
CACHED = {"urls": ("year", "url"), "metas": ("year", "url", "title", "author", "publication_date", "section"), "pairs": ("year", "pos", "url", "lastmod")}
#: Tasks that write a year.
YEAR_TASKS = 16


def read_cache(spark: SparkSession, path: str, kind: str, key: dict | None = None) -> DataFrame | None:
    """Rows of a by-year cache, or None where it is missing, unreadable or made with other parameters than key. path: a cache folder or a JSON document.

    kind: "urls" (year, url; of a document pos too), "metas" (year, url, title, author, publication_date, section; the last record of a URL),
    "pairs" (year, pos, url, lastmod).
    """
    if not exists(spark, path):
        return None
    fits = lambda held: key is None or {k: str(v) for k, v in key.items()} == (held or {})
    if exists(spark, f"{path}/rows"):
        if not exists(spark, f"{path}/manifest"):
            return None  # its writer died
        held = spark.read.text(f"{path}/manifest").select(F.from_json("value", "struct<kind:string,key:map<string,string>>").alias("m")).select("m.*").first()
        return spark.read.parquet(f"{path}/rows").select(*CACHED[kind]) if held and held["kind"] == kind and fits(held["key"]) else None
    documents = spark.read.text(path, wholetext=True)
    head = documents.select(F.from_json("value", "struct<key:map<string,string>,by_year:map<string,string>>").alias("c")).select("c.key", F.col("c.by_year").isNotNull().alias("ok")).first()
    return cached_rows(documents, kind) if head is not None and head["ok"] and fits(head["key"]) else None


def cached_rows(documents: DataFrame, kind: str) -> DataFrame:
    """Rows of cache documents (value: JSON) of a kind."""
    meta = "struct<url:string,title:string,author:string,publication_date:string,section:string>"
    item = {"urls": "string", "metas": meta, "pairs": "array<string>"}[kind]
    raw = documents.select(F.from_json("value", f"struct<cached_at:string,key:map<string,string>,by_year:map<string,array<{item}>>>").alias("c"))
    years = raw.select(F.explode("c.by_year").alias("year", "items")).select(F.col("year").cast("int").alias("year"), F.posexplode("items").alias("pos", "x"))
    if kind == "urls":
        return years.select("year", "pos", F.col("x").alias("url"))
    if kind == "pairs":
        return years.select("year", "pos", F.get("x", 0).alias("url"), F.coalesce(F.get("x", 1), F.lit("")).alias("lastmod"))
    named = years.where(F.coalesce("x.url", F.lit("")) != "")
    return named.groupBy("year", F.col("x.url").alias("url")).agg(F.max_by("x", "pos").alias("x")).select("year", "url", *[F.coalesce(f"x.{c}", F.lit("")).alias(c) for c in ("title", "author", "publication_date", "section")])


def cache_document(rows: DataFrame, kind: str, key: dict, cached_at: str) -> DataFrame:
    """One row, value: the JSON cache (and n_years). URLs distinct and sorted, metas sorted by url, pairs in order of pos; years sorted."""
    if kind == "urls":
        items = F.array_sort(F.collect_set("url"))
    elif kind == "pairs":
        items = F.transform(F.array_sort(F.collect_list(F.struct("pos", "url", "lastmod"))), lambda x: F.array(x["url"], x["lastmod"]))
    else:
        items = F.array_sort(F.collect_list(F.struct("url", "title", "author", "publication_date", "section")))
    by_year = rows.groupBy("year").agg(items.alias("items"))
    listed = by_year.agg(F.array_sort(F.collect_list(F.struct(F.col("year").cast("string").alias("key"), F.col("items").alias("value")))).alias("years"))
    return listed.select(F.to_json(F.struct(F.lit(cached_at).alias("cached_at"), _fixed(key).alias("key"), F.map_from_entries("years").alias("by_year"))).alias("value"), F.size("years").alias("n_years"))


def write_cache(rows: DataFrame, path: str, kind: str, key: dict, cached_at: str, years_only: bool = False) -> bool:
    """Writes the cache folder if there is any URL; says whether it did. rows are computed once.

    years_only: only the years of rows are replaced, the others stay; otherwise the cache has just these rows. The old rows stay until the new
    ones are whole; a folder without a manifest is no cache.
    """
    spark = rows.sparkSession
    kept = rows.select(*CACHED[kind])
    if kind == "urls":
        kept = kept.distinct()
    elif kind == "metas":
        rest = CACHED[kind][2:]
        kept = kept.groupBy("year", "url").agg(F.max(F.struct(*rest)).alias("r")).select("year", "url", "r.*")
    counted = Observation()
    dealt = kept.repartition("year", F.pmod(F.xxhash64("url"), F.lit(YEAR_TASKS))).sortWithinPartitions("year", "pos" if kind == "pairs" else "url")
    writer = dealt.observe(counted, F.count(F.lit(1)).alias("n")).write.partitionBy("year")
    target = f"{path}/rows"
    if years_only and exists(spark, target):
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target)
        if not counted.get["n"]:
            return False
        deleted(spark, f"{path}/manifest")
    else:
        writer.mode("overwrite").parquet(f"{path}/_new")
        if not counted.get["n"]:
            deleted(spark, f"{path}/_new")
            return False
        deleted(spark, f"{path}/manifest")
        deleted(spark, target)
        renamed(spark, f"{path}/_new", target)
    manifest = spark.range(1).select(F.to_json(F.struct(F.lit(kind).alias("kind"), F.lit(cached_at).alias("cached_at"), _fixed(key).alias("key"))).alias("value"))
    manifest.coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return True


def _fixed(key: dict) -> Column:
    return F.create_map(*[F.lit(str(x)) for kv in sorted(key.items()) for x in kv]) if key else F.create_map().cast("map<string,string>")


def export_cache(rows: DataFrame, path: str, kind: str, key: dict, cached_at: str) -> bool:
    """Writes the JSON document, one row, if there is any URL; says whether it did. For exchange: it holds all rows at once."""
    document = cache_document(rows, kind, key, cached_at).where("n_years > 0").select("value")
    counted = Observation()
    document.observe(counted, F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").text(path + ".new")
    if not counted.get["n"]:
        deleted(rows.sparkSession, path + ".new")
        return False
    deleted(rows.sparkSession, path)
    renamed(rows.sparkSession, path + ".new", path)
    return True

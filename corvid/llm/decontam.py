"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification. DataFrame functions only.

An item is contained in a document if at least `threshold` of the item's distinct shingles (`k` words) occur in it. Items are
partitioned by the power of two of their shingle count. A partition's sketch is the bottom-b MinHash of each item, with b
fitted to the partition: the largest item of the class can lack at most n - ceil(threshold * n) of its shingles, so
b = that + 1 hashed minima always hold one that the document has, whatever the document's length. So no containment is missed.
Documents stream past the sketches: a shingle that is in a sketch makes the pair a candidate, and only candidates are
verified, by counting the item's own shingles (as strings) in the whole document.

Words are runs of ASCII letters and digits and of all other characters above U+007F; A-Z are lower-cased.
An item with fewer than k words has no shingle and matches nothing; null and empty texts match nothing. Rows that repeat an
id are one document that has the shingles of each of them; a null id is never reported. A very long text is one row of
words and hashes in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch entries up to which the index is broadcast (about 24 bytes each); beyond, it is joined by shuffle.
BROADCAST_ENTRIES = 2_000_000
#: Characters of all items' shingles up to which these are broadcast for the exact check.
BROADCAST_CHARACTERS = 64_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: ASCII other than letters and digits.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Array of normalised words; null for a null text."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), _BETWEEN), lambda w: w != "")


def _starts(ws: Column, k: int) -> Column:
    return F.when(F.size(ws) >= k, F.sequence(F.lit(1), F.size(ws) - k + 1)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words_hashed: Column, k: int) -> Column:
    """64-bit hashes of all runs of k hashed words, in order; empty where there are fewer."""
    return F.transform(_starts(words_hashed, k), lambda i: F.xxhash64(*[F.get(words_hashed, i + (j - 1)) for j in range(k)]))


def shingle_strings(ws: Column, k: int) -> Column:
    return F.array_distinct(F.transform(_starts(ws, k), lambda i: F.array_join(F.slice(ws, i, F.lit(k)), " ")))


def _hashed(rows: DataFrame, k: int) -> DataFrame:
    """rows (id, t) -> id, hashes. Each step is a column of its own, so that no lambda recomputes the words."""
    w = rows.select("id", words(F.col("t")).alias("w"))
    return w.select("id", F.transform("w", lambda x: F.xxhash64(x)).alias("w")).select("id", shingle_hashes(F.col("w"), k).alias("hashes"))


def items_of(benchmark: DataFrame, k: int, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(item, shingles, n) and (item, n, hashes): one row per item with a shingle; rows that repeat an id are merged."""
    rows = benchmark.select(benchmark[item_id].alias("id"), benchmark[text].cast("string").alias("t")).where("id is not null and t is not null")
    strings = rows.select("id", words(F.col("t")).alias("w")).select("id", shingle_strings(F.col("w"), k).alias("s"))
    strings = strings.groupBy(F.col("id").alias("item")).agg(F.array_distinct(F.flatten(F.collect_list("s"))).alias("shingles"))
    hashes = _hashed(rows, k).groupBy(F.col("id").alias("item")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hashes")))).alias("hashes"))
    return strings.withColumn("n", F.size("shingles")).where("n > 0"), hashes.withColumn("n", F.size("hashes")).where("n > 0")


def sketches(hashes: DataFrame, threshold: float) -> DataFrame:
    """h, item, size_class: the bottom-b hashes of each item, b by its size class."""
    size_class = F.floor(F.log2("n")).cast("int")
    largest = F.pow(F.lit(2.0), F.col("size_class") + 1) - 1
    bottom = (largest - F.ceil(largest * F.lit(threshold) - 1e-9) + 1).cast("int")
    sized = hashes.withColumn("size_class", size_class).withColumn("b", F.least(bottom, F.col("n")))
    return sized.select("item", "size_class", F.explode(F.slice("hashes", F.lit(1), F.col("b"))).alias("h"))


def contained(documents: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_item, n_found, containment: every pair at or above the threshold."""
    docs = documents.select(documents[doc_id].alias("id"), documents[text].cast("string").alias("t")).where("id is not null and t is not null")
    items, hashes = items_of(benchmark, k, item_id, item_text)
    sketch = sketches(hashes, threshold).select("h", "item")
    small = sketch.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES
    characters = items.agg(F.coalesce(F.sum(F.length(F.array_join("shingles", ""))), F.lit(0)).alias("n")).first()["n"]
    plain = lambda x: x
    sketched, listed = F.broadcast if small else plain, F.broadcast if characters <= BROADCAST_CHARACTERS else plain

    # explode_outer: explode would have Catalyst push size(hashes) > 0, with all of its words, below the columns it is made from
    streamed = _hashed(docs, k).select("id", F.explode_outer("hashes").alias("h"))
    found = streamed.join(sketched(sketch), "h").groupBy("id").agg(F.collect_set("item").alias("candidates"))

    cut = docs.join(found, "id").select("id", "candidates", words(F.col("t")).alias("w"))
    checked = cut.select("id", "candidates", shingle_strings(F.col("w"), k).alias("own")).select("id", "own", F.explode("candidates").alias("item"))
    verified = checked.join(listed(items), "item").select(F.col("id").alias("doc"), "item", "n", F.array_intersect("shingles", "own").alias("hit"))
    merged = verified.groupBy("doc", "item").agg(F.max("n").alias("n"), F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hits"))
    return merged.where(F.col("hits") >= F.col("n") * F.lit(threshold) - 1e-9).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("n").cast("bigint").alias("n_item"), F.col("hits").cast("bigint").alias("n_found"), (F.col("hits") / F.col("n")).alias("containment")
    )


def clean(documents: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of documents that contain no item; rows without an id stay."""
    hits = contained(documents, benchmark, k, threshold, doc_id, text, item_id, item_text).select(F.col("doc_id").alias("__hit")).distinct()
    return documents.join(hits, documents[doc_id] == F.col("__hit"), "left_anti")

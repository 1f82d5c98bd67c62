"""Near-duplicate detection: circulant MinHash, banding, exact Jaccard, connected components.

Circulant MinHash: shingles are hashed to a universe of 2^20 values by a first permutation (a bijective mix, cut to 20 bits); a second permutation pi,
one table, is shifted circularly by k for coordinate k, so coordinate k of a set is min over x of pi[x + k]. BANDS bands of
ROWS coordinates: two sets of similarity exactly 0.8 share no band with probability (1 - 0.8^5)^32 = 3e-6.

Exact copies (equal shingle sets) meet first and one of them stands for all. The sets of a band's bucket propose the pairs:

- Of each bucket one set is the centre, the one whose buckets are largest together (ties: the smaller set, then its digest): the original
  among near copies shares its buckets with most of them. Pairs of a set and its buckets' centres are confirmed on the full sets.
- A bucket's sets go on only if a possible partner in another component is left among them: two sets of n and n' shingles can be linked only if the
  smaller has 80 in 100 of the larger's.
- What goes on is mostly sets with a common part that doesn't make them alike, so a bucket's pairs aren't listed: its pairs are met through what is rare
  among the sets that go on. Their shingles are put in one order, rarest first; two linked sets share a shingle among the first
  n - ceil(0.8 n) + 1 of each, their prefixes. With s the first shingle they share and `at` shingles of a set before it at most n - at can be shared, so a
  pair is possible only if min(n - at, n' - at') * 180 >= 80 * (n + n').

Before sets are moved, a pair's signatures (low bytes) are compared: it must share a band, and agree in at least 0.8 less SIGMAS deviations of
the coordinates (two sets of 0.8 agree less with a probability of 3e-7). There are two rounds of confirmation, however large a bucket is; a pair that
shares a band is passed over only if it can't be linked or lies within a component already, and no bucket is capped.

Nulls and empties: a text without words (or null) has no shingle and is linked with nothing; a row with a null id is its own
class with a null component. Rows that repeat an id count as one node, which has the links of each of them. Words are runs of
characters other than space and U+0009-000D; A-Z are lower-cased. A text with fewer than k words is one shingle. A very long
text is held whole by one task, with its shingles (8 bytes each). Other columns of documents, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Grown, Words, apart, batch_words, grams, mix, session, table, text_bytes
from .graph import components

BANDS, ROWS, UNIVERSE_BITS = 32, 5, 20
#: Deviations by which the signatures of two sets may agree less than they should; ids that are broadcast at most (8 to 16 MB).
SIGMAS, FEW_IDS = 5, 1_000_000
#: Bytes of text that are hashed at a time: work memory.
GROUP = 1 << 18
_PI: dict[int, np.ndarray] = {}


def _pi(coordinates: int) -> np.ndarray:
    """Row view of pi: [x] is pi[x : x + coordinates], circularly."""
    if coordinates not in _PI:
        size = 1 << UNIVERSE_BITS
        order = np.argsort(mix(np.arange(size, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)), kind="stable")
        pi = np.empty(size, np.uint32)
        pi[order] = np.arange(size, dtype=np.uint32)
        _PI[coordinates] = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:coordinates]]), coordinates)
    return _PI[coordinates]


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    every = grams(words.hashes, k)
    for low, high in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        n = high - low
        if n >= k:
            yield np.unique(every[low : high - k + 1])
        elif n:
            yield grams(words.hashes[low:high], n) ^ np.uint64(n)
        else:
            yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    at = (mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64((1 << UNIVERSE_BITS) - 1)).astype(np.int64)
    rows, best = _pi(coordinates), np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(at), 4096):
        np.minimum(best, rows[at[i : i + 4096]].min(axis=0), out=best)
    return best


def _bands(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(-1, BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return h.view(np.int64)


def _signed(docs: DataFrame, k: int) -> DataFrame:
    """id, n, whole (digest of the set), bands, sketch (the low byte of each coordinate)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, whole, sigs = [], [], []
            for words in batch_words(text_bytes(batch.column(1)), True, GROUP)[1]:
                for s in shingle_sets(words, k):
                    sizes.append(len(s))
                    whole.append(xxhash.xxh3_128_digest(s) if len(s) else None)
                    sigs.append(signature(s))
            bands = _bands(np.array(sigs, np.uint32)) if sigs else np.empty((0, BANDS), np.int64)
            sketches = pa.array([x.astype(np.uint8).tobytes() for x in sigs], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(whole, pa.binary()), lists, sketches], names=["id", "n", "whole", "bands", "sketch"])
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, f"id {kind}, n bigint, whole binary, bands array<bigint>, sketch binary")


def _full_sets(docs: DataFrame, k: int) -> DataFrame:
    """whole, n, own: the full shingle set of each row, under its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in batch_words(text_bytes(batch.column(1)), True, GROUP)[1]:
                sets = list(shingle_sets(words, k))
                whole = pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary())
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array((np.concatenate(sets) if sets else np.empty(0, np.uint64)).view(np.int64)))
                yield pa.RecordBatch.from_arrays([whole, pa.array(np.diff(ends).astype(np.int64)), lists], names=["whole", "n", "own"])
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "whole binary, n bigint, own array<bigint>")


def classes(documents: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of documents."""
    session(documents.sparkSession)
    docs = documents.select(documents[doc_id].alias("id"), documents[text].cast("string").alias("text"))
    signed = table(_signed(docs, k))
    nodes = signed.where("id is not null and whole is not null")
    same = nodes.groupBy("whole").agg(F.min("id").alias("rep"))
    # one row stands for each distinct set
    reps = nodes.join(same.select("whole", F.col("rep").alias("id")), ["whole", "id"], "left_semi").dropDuplicates(["whole"])
    buckets = reps.select("whole", "n", F.explode("bands").alias("s"))
    shared = buckets.groupBy("s").agg(F.count("*").alias("size")).where("size > 1")
    live = table(buckets.join(apart(shared, "s"), "s"))
    met = table(reps.join(live.select("whole").distinct(), "whole", "left_semi").select("id", "whole", "sketch"))

    near = _linked(docs, met, live, k, percent)
    copies = nodes.join(apart(same, "whole"), "whole").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = components(near.unionByName(copies))
    out = signed.select("id", "n").join(found, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) with linked. The sets that no pair names stay where they are: few pairs, as in later rounds, move few sets."""
    pairs = table(pairs)
    wanted = table(pairs.select(F.col("a").alias("whole")).unionByName(pairs.select(F.col("b").alias("whole"))).distinct())
    needed = table(sets.join(wanted, "whole", "left_semi"))
    first = pairs.join(needed.select(F.col("whole").alias("a"), F.col("n").alias("a_n"), F.col("own").alias("a_set")), "a")
    both = first.join(needed.select(F.col("whole").alias("b"), F.col("n").alias("b_n"), F.col("own").alias("b_set")), "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.select("a", "b", (shared * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent).alias("linked"))


def _alive(live: DataFrame, percent: int) -> DataFrame:
    """Rows of live (s, at, n, whole, label) that may have a partner of another label under their key.

    A pair is possible if each set's n is within the other's reach, (n - at) * (100 + percent) / percent - n. A row stays if the least
    n of another label is within its reach, and its own n within the greatest reach of another label.
    """
    reach = F.floor((F.col("n") - F.col("at")) * (100 + percent) / percent) - F.col("n")
    rows = live.withColumn("reach", reach)
    by_label = rows.groupBy("s", "label").agg(F.min("n").alias("n"), F.max("reach").alias("reach"))
    # of each shingle the best label, and the best of the others
    first = by_label.groupBy("s").agg(F.min(F.struct("n", "label")).alias("n1"), F.max(F.struct("reach", "label")).alias("r1"))
    other = by_label.join(apart(first, "s"), "s").groupBy("s", "n1", "r1").agg(
        F.min(F.when(F.col("label") != F.col("n1.label"), F.col("n"))).alias("n2"), F.max(F.when(F.col("label") != F.col("r1.label"), F.col("reach"))).alias("r2")
    )
    best = other.where("n2 is not null").select("s", "n1", "n2", "r1", "r2")
    near = F.when(F.col("label") == F.col("n1.label"), F.col("n2")).otherwise(F.col("n1.n"))
    far = F.when(F.col("label") == F.col("r1.label"), F.col("r2")).otherwise(F.col("r1.reach"))
    kept = rows.join(apart(best, "s"), "s").where((near <= F.col("reach")) & (far >= F.col("n")))
    return kept.select("s", "at", "n", "whole", "label")


def _alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share a band and whose signatures say that they may be linked."""
    p = percent / 100
    least = p - SIGMAS * (p * (1 - p) / (BANDS * ROWS)) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            same = (x == y).reshape(batch.num_rows, BANDS, ROWS)
            keep = same.all(axis=2).any(axis=1) & (same.mean(axis=(1, 2)) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = pairs.join(sketches.select(F.col("whole").alias("a"), F.col("sketch").alias("x")), "a")
    both = first.join(sketches.select(F.col("whole").alias("b"), F.col("sketch").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """s, at, n, whole: the prefix shingles that another set holds too, and how many shingles of the set come before each."""
    each = sets.select("whole", "n", F.explode("own").alias("s"))
    held = each.groupBy("s").agg(F.count("*").alias("sets")).where("sets > 1")
    shared = each.join(apart(held, "s"), "s").groupBy("whole", "n").agg(F.array_sort(F.collect_list(F.struct("sets", "s"))).alias("order"))
    lone = F.col("n") - F.size("order")
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = F.slice("order", 1, F.greatest(F.lit(0), length - lone).cast("int"))
    return shared.select("whole", "n", lone.alias("lone"), F.posexplode(first["s"]).alias("i", "s")).select("s", (F.col("lone") + F.col("i")).alias("at"), "n", "whole")


def _linked(docs: DataFrame, met: DataFrame, live: DataFrame, k: int, percent: int) -> DataFrame:
    """Edges (a, b) between ids that join all linked sets of met (id, whole, sketch), which share the buckets of live (s, size, n, whole)."""
    ids = met.select("id").distinct()
    # few ids leave the texts where they are; many are shuffled with them
    of_ids = docs.join(F.broadcast(ids) if met.count() <= FEW_IDS else ids, "id", "left_semi")
    sets = table(_full_sets(of_ids, k).join(met.select("whole"), "whole", "left_semi").dropDuplicates(["whole"]))
    sketches = met.select("whole", "sketch")
    tried = Grown(docs.sparkSession)

    def test(pairs: DataFrame) -> None:
        distinct = pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
        new = distinct.join(tried.all().select("a", "b"), ["a", "b"], "left_anti") if tried.paths else distinct
        tried.add(_confirmed(_alike(new, sketches, percent), sets, percent))

    def possible(rows: DataFrame, label: DataFrame) -> DataFrame:
        """Rows under their keys with their components, as far as those differ."""
        return table(_alive(table(rows.join(label, "whole", "left").select("s", "at", "n", "whole", F.coalesce("component", "whole").alias("label"))), percent))

    def met_by(rows: DataFrame) -> DataFrame:
        can = f"x.s = y.s and x.whole < y.whole and x.label <> y.label and least(x.n - x.at, y.n - y.at) * {100 + percent} >= {percent} * (x.n + y.n)"
        return rows.alias("x").join(rows.alias("y"), F.expr(can)).select(F.col("x.whole").alias("p"), F.col("y.whole").alias("q"))

    crowd = live.groupBy("whole").agg(F.sum("size").alias("crowd"))
    centres = live.join(crowd, "whole").groupBy("s").agg(F.max(F.struct("crowd", (-F.col("n")).alias("less"), "whole")).alias("c"))
    y = apart(centres.select("s", "c.whole", (-F.col("c.less")).alias("n")), "s").alias("y")
    fits = F.expr(f"x.s = y.s and x.whole <> y.whole and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
    test(live.alias("x").join(y, fits).select(F.col("x.whole").alias("p"), F.col("y.whole").alias("q")))

    label = components(tried.all().where("linked")).select(F.col("node").alias("whole"), "component")
    left = possible(live.select("s", F.lit(0).alias("at"), "n", "whole"), label).select("whole").distinct()
    test(met_by(possible(_prefixes(table(sets.join(left, "whole", "left_semi")), percent), label)))
    links, ids = tried.all().where("linked"), met.select("whole", "id")
    first = links.join(ids.select(F.col("whole").alias("a"), F.col("id").alias("x")), "a")
    return first.join(ids.select(F.col("whole").alias("b"), F.col("id").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))


def deduplicated(documents: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: the rows of the smallest id; of rows that repeat it, all stay. Rows without an id stay."""
    gone = classes(documents, k, percent, doc_id, text).where(~F.col("kept")).select("doc_id").distinct().alias("gone")
    return documents.alias("all").join(gone, F.col(f"all.{doc_id}") == F.col("gone.doc_id"), "left_anti")

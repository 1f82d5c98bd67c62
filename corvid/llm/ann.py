"""Nearest neighbours by largest inner product: multiprobe p-stable hashing.

Equal vectors are one entry with its smallest ids. Entries are divided into bands of norms; in a band whose longest norm is M an entry x becomes
(x / M, sqrt(1 - |x / M|^2)) and a query q becomes (q / |q|, 0), all of length 1, so that the largest inner product is the least distance.
Each of TABLES tables has k Gaussian (2-stable) projections cut into slots of width WIDTH; k follows the number of entries, so that a bucket holds
about BUCKET of them.

A query visits perturbed buckets in the order of their estimated success: a neighbour at distance r lies in a slot with the probability that a normal
deviation of scale r puts on it, and in a bucket with their product. Buckets are visited until the tables together hold such a neighbour with
probability TARGET. r is measured: the distance that FAR of the true neighbours of SAMPLE entries (smallest hash, an exact pass over all rows) don't
exceed. Where BEAM buckets don't reach the target, or a query finds fewer than it should return, it is compared with all entries of one table:
the exact way for what the caps leave.

Entries are gathered in cells: those of a table and band with equal leading slots, split by salt above CELL; a query is sent once to each cell that it
visits, with the buckets to visit there, in blocks of BLOCK queries. A cell merges what its buckets hold; a query's cells are merged by a
window over at most a cell's answer each. Scores are double sums in the order of the components, on the original vectors.

Odd input: vectors that are null, empty, zero or hold a null or a component that is not finite take no part, nor do rows with a null id or vectors of
another length than the most common one (of equals the longest). Repeated rows count once. Rows with one id and different vectors are one id: each of its
vectors is a query, and an id is found once, by its best score. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..ship import ship
from .common import mix, table

#: Hash tables; width of a slot (in a space of unit vectors); entries of a bucket, about; chance of holding a neighbour; buckets ranked a table.
TABLES, WIDTH, BUCKET, TARGET, BEAM = 2, 1.5, 256, 0.97, 4096
#: Entries whose true neighbours are measured, and the share of these that is nearer than r.
SAMPLE, FAR = 64, 0.8
#: Entries of a cell and queries of a block, about; rows a group of equal vectors sends on from each of SALTS places.
CELL, BLOCK, SALTS = 32768, 2048, 64
_SLOTS = 4  # slots to either side that are ranked


class Hashes:
    """TABLES tables of k projections of d + 1 components."""

    def __init__(self, d: int, k: int, seed: int = 11):
        r = np.random.default_rng(seed)
        self.k, self.a = k, r.standard_normal((TABLES, d + 1, k))
        self.b = r.uniform(0, WIDTH, (TABLES, k))

    def projected(self, unit: np.ndarray, t: int) -> np.ndarray:
        return (unit @ self.a[t] + self.b[t]) / WIDTH


def lifted(x: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Entries as unit vectors of their band."""
    y = x / most[:, None]
    return np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))])


def aimed(q: np.ndarray) -> np.ndarray:
    """Queries as unit vectors."""
    return np.column_stack([q / _norms(q)[:, None], np.zeros(len(q))])


def _norms(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def named(slots: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots (..., k) as 64-bit names: of the first of them, and of all."""
    name = np.zeros(slots.shape[:-1], np.uint64)
    prefix = name
    for i in range(slots.shape[-1]):
        if i == first:
            prefix = name
        name = mix(name * np.uint64(0x9E3779B97F4A7C15) + slots[..., i].astype(np.int64).view(np.uint64) + np.uint64(1))
    return (name if first >= slots.shape[-1] else prefix).view(np.int64), name.view(np.int64)


def chances(offset: np.ndarray, r: float) -> np.ndarray:
    """For projections at `offset` within their slot (0 to 1): the probability that a neighbour at distance r is _SLOTS slots below, ..., above."""
    phi = np.vectorize(lambda z: (1 + erf(z / sqrt(2))) / 2, otypes=[float])
    edges = (np.arange(-_SLOTS, _SLOTS + 2) - offset[..., None]) * WIDTH / r
    return np.maximum(np.diff(phi(edges), axis=-1), 1e-300)


def probes(y: np.ndarray, r: float, wanted: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of projected queries (n, k): the perturbations (n, BEAM, k) by falling probability, how many reach `wanted`, and whether they do.

    Slots are added one projection at a time and the BEAM best kept, which loses none of the BEAM best of the whole.
    """
    n, k = y.shape
    p = np.log(chances(y - np.floor(y), r))
    score, steps = np.zeros((n, 1)), np.zeros((n, 1, 0), np.int8)
    width = 2 * _SLOTS + 1
    for i in range(k):
        every = (score[:, :, None] + p[:, None, i]).reshape(n, -1)
        keep = np.argpartition(-every, BEAM - 1, axis=1)[:, :BEAM] if every.shape[1] > BEAM else np.broadcast_to(np.arange(every.shape[1]), every.shape)
        score = np.take_along_axis(every, keep, 1)
        steps = np.concatenate([np.take_along_axis(steps, (keep // width)[:, :, None], 1), (keep % width - _SLOTS)[:, :, None].astype(np.int8)], axis=2)
    order = np.argsort(-score, axis=1, kind="stable")
    score, steps = np.take_along_axis(score, order, 1), np.take_along_axis(steps, order[:, :, None], 1)
    reached = np.cumsum(np.exp(score), axis=1)
    count = np.minimum((reached < wanted).sum(axis=1) + 1, score.shape[1])
    return steps, count, reached[:, -1] >= wanted


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions that can be among the k best of a row of scores; somewhat more where rounding leaves it open."""
    if len(scores) <= k:
        return np.flatnonzero(scores > -np.inf)
    least = np.partition(scores, -k)[-k]
    return np.flatnonzero((scores >= least - 1e-9 * abs(least) - 1e-300) & (scores > -np.inf)) if np.isfinite(least) else np.flatnonzero(scores > -np.inf)


def ordered_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components."""
    return np.cumsum(x * y, axis=1)[:, -1]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def entries(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, v (doubles), h (two 64-bit hashes that name the vector) of the rows that take part, -0.0 as 0.0."""
    v = F.transform(F.col(embedding).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    return rows.withColumn("h", F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b")))


def classes(rows: DataFrame, most: int) -> DataFrame:
    """h, v, ids: equal vectors once, with their `most` smallest ids in order. A vector that a third of the rows share is cut down in
    salted windows first, then combined before its shuffle."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    least = salted.withColumn("n", F.dense_rank().over(Window.partitionBy("h", "salt").orderBy("vec_id"))).where(F.col("n") <= most)
    return least.groupBy("h").agg(F.first("v").alias("v"), F.slice(F.array_sort(F.collect_set("vec_id")), 1, most).alias("ids"))


def search(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, its own id left out. is_query: a test of vec_id, a column named so."""
    spark = ship(vectors.sparkSession)
    rows = entries(vectors, vec_id, embedding)
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not common:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    d = common[0]["d"]
    rows = rows.where(F.size("v") == d)
    # the norm in powers of two, half a power off, so that vectors of length 1 are in one band
    longest = F.array_max(F.transform("v", F.abs))
    norm = longest * F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / longest) * (x / longest)))
    entry = table(classes(rows, k + 1).withColumn("norm", norm).withColumn("band", F.floor(F.log2("norm") + 0.5).cast("int")))
    bands = {r["band"]: (r["most"], r["n"]) for r in entry.groupBy("band").agg(F.max("norm").alias("most"), F.count("*").alias("n")).collect()}  # 2,100 at most
    total = sum(n for _, n in bands.values())
    n_ids = rows.select("vec_id").distinct().count()
    hashes = Hashes(d, max(0, min(24, round(log(total / BUCKET)))))
    first = max(0, min(hashes.k, round(log(max(1, total / CELL)))))
    r = _distance(entry, {b: m for b, (m, _) in bands.items()}, d, k)

    most = {b: m for b, (m, _) in bands.items()}
    placed = entry.select("band", "v", "ids").mapInArrow(_placer(hashes, first, most, d), "t int, prefix bigint, bucket bigint, band int, v array<double>, ids array<bigint>")
    sizes = table(placed.groupBy("t", "prefix", "band").agg(F.count("*").alias("n")))
    asked = rows.where(is_query).groupBy("h").agg(F.first("v").alias("v"))
    dealt = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "h")  # few bytes, much work: not to be put together
    queries = table(dealt.mapInArrow(_prober(hashes, first, r, d), "h struct<a bigint, b bigint>, v array<double>, t int, prefix bigint, buckets array<bigint>"))
    found = _merged(_visited(queries, placed, sizes, k, d), k)
    found = table(found)
    # the exact way for queries that found too few
    short = found.where(F.size("found") < min(k + 1, n_ids)).select("h")
    whole = table(asked.join(found.select("h"), "h", "left_anti").unionByName(asked.join(short, "h", "left_semi")))
    if not whole.isEmpty():
        every = whole.select("h", "v", F.lit(0).alias("t"), F.lit(None).cast("bigint").alias("prefix"), F.lit(None).cast("array<bigint>").alias("buckets"))
        rest = _merged(_visited(every, placed, sizes, k, d), k)
        found = table(found.join(whole.select("h"), "h", "left_anti").unionByName(rest))
    asking = rows.where(is_query).select("vec_id", "h").distinct()
    own = asking.select(F.col("vec_id").alias("query_id"), F.col("h")).join(found, "h")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    listed = own.select("query_id", others.alias("found"))
    # an id with several vectors has one list
    several = listed.groupBy("query_id").agg(F.collect_list("found").alias("all"))
    one = F.when(F.size("all") == 1, F.get("all", F.lit(0))).otherwise(F.slice(_ranked(_best_of(F.flatten("all"))), 1, k))
    return several.select("query_id", F.posexplode(one).alias("pos", "x")).select("query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", "x.score")


def _ranked(found: Column) -> Column:
    """By falling score, then id."""
    return F.transform(F.array_sort(F.transform(found, lambda x: F.struct((-x["score"]).alias("m"), x["vec_id"].alias("vec_id"), x["score"].alias("score")))), lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score")))


def _best_of(found: Column) -> Column:
    """The first of each id in order of score."""
    ranked = _ranked(found)
    return F.aggregate(ranked, F.slice(ranked, 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: y["vec_id"] == x["vec_id"]), acc).otherwise(F.concat(acc, F.array(x))))


def _distance(entry: DataFrame, most: dict[int, float], d: int, k: int) -> float:
    """The distance that FAR of the true neighbours of SAMPLE entries don't exceed."""
    picked = entry.orderBy(F.xxhash64("h"), "h").limit(SAMPLE).select("v").collect()
    asked = np.array([x["v"] for x in picked], np.float64)
    unit = asked / _norms(asked)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.full((len(unit), k + 1), -np.inf)
        far = np.zeros((len(unit), k + 1))
        for batch in batches:
            x = _matrix(batch.column("v"), d)
            longest = np.array([most[b] for b in batch.column("band").to_pylist()])
            scores = unit @ x.T
            apart = np.sqrt(np.maximum(0, 2 - 2 * scores / longest))
            both, lengths = np.hstack([top, scores]), np.hstack([far, apart])
            keep = np.argsort(-both, axis=1)[:, : k + 1]
            top, far = np.take_along_axis(both, keep, 1), np.take_along_axis(lengths, keep, 1)
        at, _ = np.nonzero(top > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(top[top > -np.inf]), pa.array(far[top > -np.inf])], names=["q", "s", "r"])

    near = entry.select("band", "v").mapInArrow(run, "q int, s double, r double")
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s")))).where(F.col("n").between(2, k + 1))
    lengths = np.sort([x["r"] for x in ranked.select("r").collect()])
    return float(max(0.05, lengths[min(len(lengths) - 1, int(FAR * len(lengths)))])) if len(lengths) else 1.0


def _placer(hashes: Hashes, first: int, most: dict[int, float], d: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = lifted(_matrix(batch.column("v"), d), np.array([most[b] for b in batch.column("band").to_pylist()]))
            for t in range(TABLES):
                prefix, bucket = named(np.floor(hashes.projected(x, t)), first)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(prefix), pa.array(bucket), batch.column("band"), batch.column("v"), batch.column("ids")], names=["t", "prefix", "bucket", "band", "v", "ids"])

    return run


def _prober(hashes: Hashes, first: int, r: float, d: int):  # noqa: ANN202
    """A row for each query, table and leading slots that it visits; without leading slots and buckets where the beam was too short."""
    wanted = 1 - (1 - TARGET) ** (1 / TABLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                q = aimed(_matrix(part.column("v"), d))
                out: list[tuple[int, int, int | None, np.ndarray | None]] = []
                by_table, fine = [], np.ones(len(q), bool)
                for t in range(TABLES):
                    y = hashes.projected(q, t)
                    steps, count, enough = probes(y, r, wanted)
                    fine &= enough
                    by_table.append((np.floor(y), steps, count))
                for t, (base, steps, count) in enumerate(by_table):
                    for i in np.flatnonzero(fine):
                        prefix, bucket = named(base[i] + steps[i, : count[i]], first)
                        for p in np.unique(prefix):
                            out.append((i, t, p, bucket[prefix == p]))
                out += [(i, 0, None, None) for i in np.flatnonzero(~fine)]
                rows = pa.array([x[0] for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("h").take(rows), part.column("v").take(rows), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.list_(pa.int64()))],
                    names=["h", "v", "t", "prefix", "buckets"],
                )

    return run


def _visited(queries: DataFrame, placed: DataFrame, sizes: DataFrame, k: int, d: int) -> DataFrame:
    """h, ids, scores: of each cell that a query visits the k + 1 best ids in the buckets it names (null: in all), a row a cell."""
    salts = F.ceil(F.col("n") / CELL).cast("int")
    cells = sizes.select("t", "prefix", "band", salts.alias("salts"))
    named_rows = queries.where("prefix is not null").join(cells, ["t", "prefix"])
    whole_rows = queries.where("prefix is null").drop("prefix").join(cells, "t")
    sent = named_rows.unionByName(whole_rows).select("t", "prefix", "band", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "h", "v", "buckets")
    asked = table(sent)
    blocks = asked.groupBy("t", "prefix", "band", "salt").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cell = ["t", "prefix", "band", "salt", "block"]
    ask = asked.join(blocks, cell[:4]).withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")).drop("blocks")
    hold = placed.join(cells, cell[:3]).withColumn("salt", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int")).drop("salts")
    hold = hold.join(table(blocks), cell[:4]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        asked, held = asked.combine_chunks(), held.combine_chunks()
        if not len(asked) or not len(held):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "scores": pa.array([], pa.list_(pa.float64()))})
        x, q = _matrix(held["v"].combine_chunks(), d), _matrix(asked["v"].combine_chunks(), d)
        ids = held["ids"].to_pylist()
        buckets, of = np.unique(held["bucket"].to_numpy(), return_inverse=True)
        members = np.split(np.argsort(of, kind="stable"), np.cumsum(np.bincount(of))[:-1])
        wanted = asked["buckets"].to_pylist()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(q), 256):
            scores = np.full((min(256, len(q) - at), len(x)), -np.inf)
            visits = [np.arange(len(buckets)) if w is None else np.flatnonzero(np.isin(buckets, w)) for w in wanted[at : at + 256]]
            who, which = np.repeat(np.arange(len(visits)), [len(v) for v in visits]), np.concatenate(visits)
            order = np.argsort(which, kind="stable")
            for b, askers in zip(*_runs(which[order], who[order]), strict=True):
                scores[np.ix_(askers, members[b])] = q[at + askers] @ x[members[b]].T
            for i, row in enumerate(scores):
                near = best(row, k + 1)
                exact = ordered_sums(x[near], q[at + i][None])
                listed = sorted((-s, n) for j, s in zip(near, exact, strict=True) for n in ids[j])[: k + 1]
                out.append((np.array([n for _, n in listed], np.int64), np.array([-s for s, _ in listed])))
        h, bounds = asked["h"].combine_chunks(), pa.array(np.append(0, np.cumsum([len(n) for n, _ in out])), pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([x[i] for x in out]))) for i in (0, 1)]
        return pa.table({"a": h.field("a"), "b": h.field("b"), "ids": lists[0], "scores": lists[1]})

    met = ask.groupBy(*cell).cogroup(hold.groupBy(*cell)).applyInArrow(run, "a bigint, b bigint, ids array<bigint>, scores array<double>")
    return met.select(F.struct("a", "b").alias("h"), "ids", "scores")


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted keys once, and the values of each."""
    names, starts = np.unique(keys, return_index=True)
    return names, np.split(values, starts[1:]) if len(names) else []


def _merged(found: DataFrame, k: int) -> DataFrame:
    """h, found: the k + 1 best ids of each query, an id once."""
    each = found.select("h", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    once = each.groupBy("h", F.col("x.ids").alias("vec_id")).agg(F.max("x.scores").alias("score"))
    kept = once.withColumn("n", F.row_number().over(Window.partitionBy("h").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= k + 1)
    return kept.groupBy("h").agg(_ranked(F.collect_list(F.struct("vec_id", "score"))).alias("found"))

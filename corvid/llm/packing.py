"""Packing token sequences into fixed windows by minimum bin slack.

A document (its ids and one end id) is cut into full windows and a remainder. Only the histogram of the remainder lengths, at
most `window` numbers, goes to the driver. There each window is opened with the longest length left and filled with the
multiset of remaining lengths whose sum comes closest to its capacity: a bitset of reachable sums (a Python integer) grows
length by length, with counts split in powers of two, and is traced back to the counts taken. A multiset is used as often as
the counts allow, so there are about as many multisets as lengths, whatever the number of documents.

The plan is applied without moving documents: pieces are ranked within their length (salted, so no length meets in one task)
and a piece's rank tells its window and offset.

A null or empty text is just the end id. Repeated rows are packed as separate documents. Order: salt, doc_id, start.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table
from .tokens import Tokenizer

#: Pieces in a salt: the rows that one ranking group holds at most, about.
SALT_ROWS = 20_000


@dataclass(frozen=True)
class Pattern:
    """`repeat` windows, each filled with items: (length, how many)."""

    repeat: int
    items: tuple[tuple[int, int], ...]


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The sub-multiset of counts (length -> number) whose sum is closest to capacity from below."""
    reach, steps = 1, []
    mask, goal = (1 << (capacity + 1)) - 1, 1 << capacity
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, part = min(counts[length], capacity // length), 1
        while left:
            take = min(part, left)
            grown = (reach | reach << (length * take)) & mask
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left, part = left - take, part * 2
            if reach & goal:
                break
        if reach & goal:
            break
    at, taken = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            taken[length] = taken.get(length, 0) + take
    return taken


def plan(histogram: dict[int, int], window: int) -> list[Pattern]:
    counts = {x: n for x, n in histogram.items() if n}
    patterns = []
    while counts:
        top = max(counts)
        counts[top] -= 1
        chosen = fill({x: n for x, n in counts.items() if n}, window - top)
        counts[top] += 1
        chosen[top] = chosen.get(top, 0) + 1
        repeat = min(counts[x] // n for x, n in chosen.items())
        for x, n in chosen.items():
            counts[x] -= n * repeat
            if not counts[x]:
                del counts[x]
        patterns.append(Pattern(repeat, tuple(sorted(chosen.items(), reverse=True))))
    return patterns


def pieces(documents: DataFrame, load: Callable[[], Tokenizer], window: int = 1024, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full windows and the remainder of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, end = load(), end_id.to_bytes(4, "little")
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, x in enumerate(batch.column(1).to_pylist()):
                ids = memoryview(t.ids(x) + end)
                n = len(ids) // 4
                for s in range(0, n, window):
                    row.append(i)
                    start.append(s)
                    length.append(min(window, n - s))
                    crc.append(zlib.crc32(ids[4 * s : 4 * (s + window)]))
                    total.append(n)
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *numbers], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    docs = documents.select(documents[doc_id].alias("doc_id"), documents[text].cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack(documents: DataFrame, load: Callable[[], Tokenizer], window: int = 1024, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """pieces() with sequence_id and offset: windows are filled without gaps from offset 0."""
    spark = documents.sparkSession
    cut = table(pieces(documents, load, window, end_id, doc_id, text))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, ranks, sequence = [], {}, 0
    for p in plan(histogram, window):
        offset = 0
        for length, n in p.items:
            first = ranks.get(length, 0)
            ranks[length] = first + n * p.repeat
            slots.append((length, first, ranks[length], n, sequence, offset))
            offset += length * n
        sequence += p.repeat
    slots = spark.createDataFrame(slots, "length bigint, first bigint, last bigint, each bigint, base bigint, at bigint")
    salts = sum(histogram.values()) // SALT_ROWS + 1
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = salted.withColumn("k", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")) - 1).join(before, ["length", "salt"])
    rank = F.col("before") + F.col("k")
    placed = ranked.withColumn("rank", rank).alias("p").join(F.broadcast(slots.alias("s")), (F.col("p.length") == F.col("s.length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    j = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "start", F.col("p.length").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("base") + F.floor(j / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + j % F.col("each") * F.col("p.length")).cast("bigint").alias("offset"),
    )

"""Shared pieces of the training-data operators: materialised tables, Arrow access and vectorised word hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship as session  # noqa: F401 (lets Python workers import this package wherever the driver was started)

def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local session (one machine) gets a temporary
    folder; on a cluster that is an error, for it would be another folder on each executor."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and sc.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="corvid-")
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


class Grown:
    """A table in the shared folder that rounds append to: one scan, however many parts it has."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.schema = spark, [], None

    def add(self, df: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}/corvid/{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append(path)
        self.schema = df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)


def table(df: DataFrame) -> DataFrame:
    """Cut lineage: write df as Parquet into the shared folder and read it back with the same schema."""
    return Grown(df.sparkSession).add(df)


def apart(df: DataFrame, key: str) -> DataFrame:
    """df, an aggregate by `key`, with its key recomputed. A join to it then shuffles both of its sides anew, which lets
    adaptive execution split a hot key; on the aggregate's own partitioning it couldn't."""
    kind = dict(df.dtypes)[key]
    again = F.substring(key, 1, 2**31 - 1) if kind in ("binary", "string") else F.col(key) + F.lit(0).cast(kind)
    return df.withColumn(key, again)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one contiguous binary array; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


# The 64-bit word hash: sum of V[byte] * P^position, brought to position 0 by P's inverse, then mixed.
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_CHUNK = 1 << 20
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POW or len(_POW["up"]) < n:
        size = max(n, _CHUNK + 1024)
        _POW["up"], _POW["down"] = _powers(_P, size), _powers(_P_INVERSE, size)
    return _POW["up"], _POW["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES_LOWER = _VALUES[_LOWER]


def _hash_span(buf: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of buf; a word never crosses a position in cuts."""
    n = len(buf)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = buf - np.uint8(9)
    inside = (inside > 4) & (buf != 0x20)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _tables(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    values = (_VALUES_LOWER if lower else _VALUES).take(buf, mode="clip")
    values *= up[:n]
    np.cumsum(values, out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words (runs of bytes other than space and 0x09-0x0D) of a group of consecutive rows.

    bounds[i]:bounds[i + 1] are the words of row first_row + i; starts and ends are byte positions in the batch.
    """

    def __init__(self, first_row: int, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        self.first_row, self.bounds, self.starts, self.ends, self.hashes = first_row, bounds, starts, ends, hashes

    def __len__(self) -> int:
        return len(self.bounds) - 1


def batch_words(texts: pa.Array, lower: bool, group: int = _CHUNK) -> tuple[np.ndarray, Iterator[Words]]:
    """The bytes of a text_bytes() array, and its words in groups of rows of about `group` bytes.

    A row larger than a group is hashed in spans cut at white space, so work memory stays bounded by its words.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)

    def groups() -> Iterator[Words]:
        row, n = 0, len(offsets) - 1
        while row < n:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + group, "right")) - 1)
            low, high = int(offsets[row]), int(offsets[stop])
            parts, at = [], low
            while at < high:
                to = min(high, at + 2 * group)
                while to < high and _WORD_BYTE[data[to - 1]]:  # end a span behind white space
                    more = np.flatnonzero(~_WORD_BYTE[data[to : min(high, to + group)]])
                    to = to + int(more[0]) + 1 if len(more) else min(high, to + group)
                s, e, h = _hash_span(data[at:to], offsets[row : stop + 1] - at, lower)
                parts.append((s + at, e + at, h))
                at = to
            if len(parts) == 1:
                s, e, h = parts[0]
            else:
                s, e, h = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, (np.int64, np.int64, np.uint64)[i]) for i in range(3))
            yield Words(row, np.searchsorted(s, offsets[row : stop + 1]), s, e, h)
            row = stop

    return data, groups()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words (across rows as well; callers mask those)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(_P)
        out += hashes[j : j + n]
    return mix(out)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + length)."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    starts = np.asarray(starts, np.int64)
    if not lengths.all():
        there = np.flatnonzero(lengths)
        starts, lengths = starts[there], lengths[there]
    # steps of one, and from each range's last place to the next one's start: their sum as it runs
    out = np.ones(total, np.int64)
    out[0] = starts[0]
    out[np.cumsum(lengths[:-1])] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out, out=out)

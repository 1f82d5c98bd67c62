"""Removal of repeated passages: a compressed FM-index per shard, searched backward by streamed fragments.

A window is `window` consecutive words. Its blocks are the BLOCK-word runs that start at its words 0, BLOCK, 2 * BLOCK, ...; an FM-index over block
symbols finds a window in window / BLOCK backward steps, and the match length in blocks is the matching statistic cut at the
threshold. A window whose statistic reaches the threshold in a document with a smaller id is reported.

Sharding keeps this linear. A window's key is the least hash of its BLOCK-word runs (a minimizer), so equal windows have
equal keys and neighbouring windows mostly share one. Keys that occur in one document only are dropped before any text moves;
the fragments (runs of windows with one key) of the others are shuffled by key and indexed shard by shard: a task sorts by key
and closes a shard at the first key boundary after SHARD symbols. A key in more than HOT documents is refined: its windows are
grouped by how far before the minimizer they start, GROUP starts a group, and the words that all windows of a group share
belong to the group's key. Most of a common passage's windows that run out of it are alone by then, and dropped. A group's key
that is in more than HOT documents is refined to single windows; equal ones of one Arrow batch are one row with a list of
places, and of each the least ids of PARTS sets of batches are indexed and searched, so an index never grows with the number of documents
that hold a passage. Exact copies of a document need no index: all their windows start in the first copy.

Words are runs of characters other than space and U+0009-000D, unchanged. Nulls and empties have no words. A row with a null
id keeps all its words and removes none of another's. Rows that repeat an id don't remove each other's words: no id is smaller. A
very long text is held whole by one task, with the hashes of its words. Other columns of documents play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, apart, batch_words, grams, mix, ranges, table, text_bytes
from .fmindex import FMIndex

BLOCK, HOT, SHARD, GROUP, PARTS = 10, 256, 300_000, 5, 16


def _keys(run_hashes: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive hashes."""
    out, have = run_hashes, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def _row_keys(words: Words, i: int, runs: np.ndarray, window: int) -> np.ndarray:
    low, high = words.bounds[i], words.bounds[i + 1]
    return _keys(runs[low : high - BLOCK + 1], window - BLOCK + 1) if high - low >= window else np.empty(0, np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64()))


def _minimizers(docs: DataFrame, window: int) -> DataFrame:
    """id, th, whole (hash of the word sequence), n_words, keys (distinct)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, sizes, keys = [], [], []
            for words in batch_words(text_bytes(batch.column(2)), lower=False)[1]:
                runs = grams(words.hashes, BLOCK)
                for i in range(len(words)):
                    own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
                    whole.append(hashlib.blake2b(own, digest_size=16).digest())
                    sizes.append(len(own))
                    keys.append(np.unique(_row_keys(words, i, runs, window)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(whole, pa.binary()), pa.array(sizes, pa.int64()), _lists(keys)], names=["id", "th", "whole", "n_words", "keys"])

    return docs.mapInArrow(run, "id bigint, th bigint, whole binary, n_words bigint, keys array<bigint>")


def _group_keys(runs: np.ndarray, keys: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The keys of the groups of the windows `at` of a row, whose run hashes and window keys are given."""
    place = np.empty(len(at), np.int64)
    for key in np.unique(keys[at]):
        mine = keys[at] == key
        found = np.flatnonzero(runs == key)
        place[mine] = found[np.searchsorted(found, at[mine])]
    group = (place - at) // GROUP
    first = place - GROUP * group  # where the words that the group's windows share begin
    last = window - (np.minimum(GROUP * group + GROUP - 1, window - BLOCK) - GROUP * group) - BLOCK
    out = mix(keys[at] + group.astype(np.uint64))
    for j in range(window // BLOCK):
        out = mix(out ^ runs[first + np.minimum(BLOCK * j, last)])
    return out


def _in(values: np.ndarray, wanted: pa.Scalar) -> np.ndarray:
    """Which values are in a list of signed integers (null: none)."""
    return np.isin(values, wanted.values.to_numpy().view(np.uint64)) if wanted.is_valid and len(wanted.values) else np.zeros(len(values), bool)


def _groups(wanted: DataFrame, window: int) -> DataFrame:
    """sub, ids, ths: the group keys of all windows with a hot key, of rows (id, th, text, hots), and the rows of a batch that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            subs, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for words in batch_words(text_bytes(batch.column(2)), lower=False)[1]:
                runs = grams(words.hashes, BLOCK)
                for i in range(len(words)):
                    own = _row_keys(words, i, runs, window)
                    at = np.flatnonzero(_in(own, batch.column(3)[words.first_row + i]))
                    if len(at):
                        subs.append(np.unique(_group_keys(runs[words.bounds[i] : words.bounds[i + 1] - BLOCK + 1], own, at, window)))
                        owners.append(np.full(len(subs[-1]), words.first_row + i))
            sub, owner = np.concatenate(subs), np.concatenate(owners)
            order = np.argsort(sub, kind="stable")
            sub, take = sub[order], pa.array(owner[order])
            edge = np.flatnonzero(np.append(True, sub[1:] != sub[:-1])) if len(sub) else np.empty(0, np.int64)
            ends = pa.array(np.append(edge, len(sub)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, batch.column(c).take(take)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(sub[edge].view(np.int64)), *lists], names=["sub", "ids", "ths"])

    return wanted.mapInArrow(run, "sub bigint, ids array<bigint>, ths array<bigint>")


def _fragments(wanted: DataFrame, window: int) -> DataFrame:
    """id, th, key, start, n (windows), blocks (hashes at each word): of rows (id, th, text, keys, hots, subs, hot_subs).

    A hot group's windows have n = 0 instead, the blocks of the window alone, the least id of the batch, part (which batch) and places
    (ids, ths and starts).
    """
    per = window // BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            part = (TaskContext.get().partitionId() << 24) + number
            row, key, start, n, blocks = [], [], [], [], []
            singles: dict[bytes, list[tuple[int, int]]] = {}
            for words in batch_words(text_bytes(batch.column(2)), lower=False)[1]:
                runs = grams(words.hashes, BLOCK)
                for i in range(len(words)):
                    at = words.first_row + i
                    own = _row_keys(words, i, runs, window)
                    if not len(own):
                        continue
                    base = int(words.bounds[i])
                    mine = runs[base : base + len(own) + window - BLOCK]
                    is_hot = _in(own, batch.column(4)[at])
                    used = _in(own, batch.column(3)[at]) & ~is_hot
                    named = own.copy()
                    hot = np.flatnonzero(is_hot)
                    if len(hot):
                        named[hot] = sub = _group_keys(mine, own, hot, window)
                        used[hot] = _in(sub, batch.column(5)[at])
                        for s in hot[_in(sub, batch.column(6)[at])].tolist():
                            used[s] = False
                            singles.setdefault(mine[s : s + window - BLOCK + 1 : BLOCK].tobytes(), []).append((at, s))
                    edge = np.flatnonzero(np.append(True, (named[1:] != named[:-1]) | (used[1:] != used[:-1])))
                    for s, e in zip(edge.tolist(), [*edge[1:].tolist(), len(own)], strict=True):
                        if used[s]:
                            for a in range(s, e, window):  # one key over a long periodic text: in pieces
                                b = min(e, a + window)
                                row.append(at)
                                key.append(int(named[a]))
                                start.append(a)
                                n.append(b - a)
                                blocks.append(mine[a : b + window - BLOCK].tobytes())
            ids, ths = batch.column(0), batch.column(1)
            take, none = pa.array(row, pa.int64()), len(row)
            places = [p for found in singles.values() for p in found]
            owners = pa.array([p[0] for p in places], pa.int64())
            bounds = np.cumsum([0, *map(len, singles.values())]).astype(np.int64)
            least = np.minimum.reduceat(ids.take(owners).to_numpy(), bounds[:-1]) if len(singles) else np.empty(0, np.int64)
            window_key = grams(np.frombuffer(b"".join(singles), np.uint64).copy(), per)[::per] if len(singles) else np.empty(0, np.uint64)
            ends = pa.array(np.concatenate([np.zeros(none), bounds]).astype(np.int32))

            def joined(left: list | pa.Array, right: list | np.ndarray, kind: pa.DataType) -> pa.Array:
                return pa.concat_arrays([pa.array(left, kind), pa.array(right, kind)])

            yield pa.RecordBatch.from_arrays(
                [
                    joined(ids.take(take), least, pa.int64()),
                    joined(ths.take(take), np.zeros(len(singles), np.int64), pa.int64()),
                    pa.array(np.concatenate([np.array(key, np.uint64), window_key]).view(np.int64)),
                    joined(start, np.zeros(len(singles), np.int64), pa.int64()),
                    joined(n, np.zeros(len(singles), np.int64), pa.int64()),
                    joined(blocks, list(singles), pa.binary()),
                    pa.array(np.full(none + len(singles), part)),
                    *(pa.ListArray.from_arrays(ends, values) for values in (ids.take(owners), ths.take(owners), pa.array([p[1] for p in places], pa.int64()))),
                ],
                names=["id", "th", "key", "start", "n", "blocks", "part", "ids", "ths", "starts"],
            )

    return wanted.mapInArrow(run, "id bigint, th bigint, key bigint, start bigint, n bigint, blocks binary, part bigint, ids array<bigint>, ths array<bigint>, starts array<bigint>")


def _by_document(found: DataFrame) -> DataFrame:
    """id, th, starts of rows (part, ids, ths, starts, least): the places whose id is above the least, gathered for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c) for c in (1, 2, 3)]
            ids, ths, starts = (x.flatten().to_numpy() for x in lists)
            least = np.repeat(batch.column(4).to_numpy(), lists[0].value_lengths().to_numpy())
            gone = ids > least
            order = np.lexsort((starts[gone], ths[gone], ids[gone]))
            i, t, s = ids[gone][order], ths[gone][order], starts[gone][order]
            edge = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (t[1:] != t[:-1]))) if len(i) else np.empty(0, np.int64)
            out = pa.ListArray.from_arrays(pa.array(np.append(edge, len(i)).astype(np.int32)), pa.array(s))
            yield pa.RecordBatch.from_arrays([pa.array(i[edge]), pa.array(t[edge]), out], names=["id", "th", "starts"])

    return found.select("part", "ids", "ths", "starts", "least").repartition("part").sortWithinPartitions("part").mapInArrow(run, "id bigint, th bigint, starts array<bigint>")


def search_shard(ids: np.ndarray, n: np.ndarray, blocks: list[bytes], single: np.ndarray, window: int) -> list[np.ndarray]:
    """For each fragment the least id over the shard in which each of its windows starts."""
    per = window // BLOCK
    sizes = np.array([len(b) // 8 for b in blocks], np.int64)
    flat = np.frombuffer(b"".join(blocks), np.uint64)
    begin = np.cumsum(sizes) - sizes
    known, symbol = np.unique(flat, return_inverse=True)
    symbol = symbol.astype(np.int64) + 1
    # chains of blocks that follow each other: BLOCK words apart, or one apart where a fragment holds just its window's blocks
    step = np.where(single, 1, BLOCK)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(flat)) - begin[owner]
    residue, turn = within % step[owner], within // step[owner]
    order = np.lexsort((turn, residue, owner))
    chain = owner[order] * BLOCK + residue[order]
    new = np.append(True, chain[1:] != chain[:-1]) if len(chain) else np.empty(0, bool)
    place = np.arange(len(order)) + np.cumsum(new)  # a separator before each chain
    text = np.zeros(len(order) + int(new.sum()) + 1, np.int64)
    text[place] = symbol[order]
    document = np.full(len(text), np.iinfo(np.int64).max)
    document[place] = ids[owner[order]]
    index = FMIndex(text, len(known) + 1, per)
    at = ranges(begin, n)
    stride = np.repeat(step, n)
    patterns = symbol[at[:, None] + stride[:, None] * np.arange(per)]
    low, high, matched = index.search(patterns)
    least = np.where(matched >= per, index.least(document, low, high), np.iinfo(np.int64).max)
    return np.split(least, np.cumsum(n)[:-1])


def _searched(fragments: DataFrame, window: int) -> DataFrame:
    """id, th, key, start, least (a list, one for each window)."""
    per = window // BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows)
            n, blocks = t.column("n").to_numpy(), t.column("blocks").to_pylist()
            single = np.array([len(b) == 8 * per for b in blocks], bool)
            least = search_shard(t.column("id").to_numpy(), n, blocks, single, window)
            return pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks() for c in ("id", "th", "key", "start")), _lists(least)], names=["id", "th", "key", "start", "least"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            keys = batch.column(2).to_numpy()
            ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)) if len(keys) else []
            weight = np.cumsum([len(b) // 8 for b in batch.column(5).to_pylist()])
            if held and len(keys) and held[-1].column(2)[-1].as_py() != keys[0] and size >= SHARD:
                yield close(held)
                held, size = [], 0
            start = 0
            for e in ends[:-1]:  # the last key may go on in the next batch
                if size + weight[e - 1] - (weight[start - 1] if start else 0) >= SHARD:
                    held.append(batch.slice(start, e - start))
                    yield close(held)
                    held, size, start = [], 0, e
            if start < len(keys):
                held.append(batch.slice(start))
                size += int(weight[-1] - (weight[start - 1] if start else 0))
        if held:
            yield close(held)

    return fragments.mapInArrow(run, "id bigint, th bigint, key bigint, start bigint, least array<bigint>")


def repeated(documents: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows of documents as (id, text, th), and (id, th, copy, starts): the windows to remove of each row that has any."""
    if window % BLOCK:
        raise ValueError(f"window must be a multiple of {BLOCK}")
    docs = documents.select(documents[doc_id].cast("bigint").alias("id"), documents[text].cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    known = docs.where("id is not null and text is not null")
    signed = table(_minimizers(known.select("id", "th", "text"), window).where(F.col("n_words") >= window))
    first = signed.groupBy("whole").agg(F.min("id").alias("id"))
    copies = signed.select("id", "th", "whole").join(apart(first.withColumnRenamed("id", "first"), "whole"), "whole").where("id > first").select("id", "th").distinct()
    own = signed.join(first, ["whole", "id"], "left_semi").select("id", "th", F.explode("keys").alias("key")).distinct()
    counts = own.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("docs")).where("low < high")
    used = own.join(apart(counts.select("key", (F.col("docs") > HOT).alias("hot")), "key"), "key")
    keyed = used.groupBy("id", "th").agg(F.collect_list("key").alias("keys"), F.array_compact(F.collect_list(F.when(F.col("hot"), F.col("key")))).alias("hots"))
    keyed = table(keyed)
    groups = table(_groups(known.join(keyed.where(F.size("hots") > 0), ["id", "th"]).select("id", "th", "text", "hots"), window))
    sizes = groups.groupBy("sub").agg(F.min(F.array_min("ids")).alias("low"), F.max(F.array_max("ids")).alias("high"), F.sum(F.size("ids")).alias("docs")).where("low < high")
    again = groups.join(apart(sizes.select("sub", (F.col("docs") > HOT).alias("hot")), "sub"), "sub")
    each = again.select("sub", "hot", F.explode(F.arrays_zip("ids", "ths")).alias("x")).select(F.col("x.ids").alias("id"), F.col("x.ths").alias("th"), "sub", "hot").distinct()
    listed = each.groupBy("id", "th").agg(F.collect_list("sub").alias("subs"), F.array_compact(F.collect_list(F.when(F.col("hot"), F.col("sub")))).alias("hot_subs"))
    cut = table(_fragments(known.join(keyed.join(listed, ["id", "th"], "left"), ["id", "th"]).select("id", "th", "text", "keys", "hots", "subs", "hot_subs"), window))
    by_key = lambda x: x.repartition("key").sortWithinPartitions("key")
    fragment = ["id", "th", "key", "start", "n", "blocks"]
    runs = _searched(by_key(cut.where("n > 0").select(fragment)), window)
    gone = F.filter(F.transform("least", lambda m, i: F.when(m < F.col("id"), F.col("start") + i)), lambda x: x.isNotNull())
    cold = runs.select("id", "th", gone.alias("starts")).where(F.size("starts") > 0)
    # a hot window is indexed with the least ids of a few sets of batches, of which the search finds the least
    single = cut.where("n = 0")
    stand = single.groupBy("key", "blocks", F.pmod("part", F.lit(PARTS)).alias("p")).agg(F.min("id").alias("id"))
    stand = stand.select("id", F.lit(0).cast("bigint").alias("th"), "key", F.lit(0).cast("bigint").alias("start"), F.lit(1).cast("bigint").alias("n"), "blocks")
    least = _searched(by_key(stand), window).select("key", F.element_at("least", 1).alias("least")).groupBy("key").agg(F.min("least").alias("least"))
    hot = _by_document(single.join(apart(least, "key"), "key"))
    starts = cold.unionByName(hot).groupBy("id", "th").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    marks = starts.withColumn("copy", F.lit(False)).unionByName(copies.select("id", "th", F.array().cast("array<bigint>").alias("starts"), F.lit(True).alias("copy")))
    return docs, marks


def removed(documents: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space), kept_sha256: one row per row of documents."""
    docs, marks = repeated(documents, window, doc_id, text)
    joined = docs.join(marks, ["id", "th"], "left").select("id", "text", "copy", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(text_bytes(batch.column(1)).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True)
            sizes, gone, kept, digest = [], [], [], []
            for raw, copy, starts in rows:
                words = raw.split()
                n = len(words)
                if copy:
                    words = []
                elif starts.is_valid and len(starts.values):
                    at = starts.values.to_numpy()
                    change = np.bincount(at, minlength=n + 1)[: n + 1] - np.bincount(at + window, minlength=n + 1)[: n + 1]
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:n] == 0)]
                left = b" ".join(words)
                sizes.append(n)
                gone.append(n - len(words))
                kept.append(left)
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digest)], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")

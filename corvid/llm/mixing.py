"""Scoring text by online logistic context mixing of hashed-context bit predictors.

A text is a sequence of tokens (words, then one end). The words seen HEAD_COUNT times or more (the most frequent MAX_HEAD of them) form the
head; a token is a path of bits down the Huffman tree of the head, the end and an escape, and an escaped word is spelled by the bits of its
bytes and a closing space. Every bit has three predictors: the tree's own counts and hashed contexts of one and two tokens before
in the tree; two and four bytes before and the whole word so far in the spelling. A hashed slot's counts of zeros and ones, gathered over all
training texts (spelling: over all distinct training words), give a log-odds. A gate (how deep the bit lies, how often the longer contexts were
seen) picks the weights that add the log-odds up, and an adaptive table by the sum and the depth refines the probability, with which it is averaged.

Weights and tables are fitted on all training rows: each bit, its own count taken out, falls into a cell of a histogram (gate and the three
log-odds in steps), whose sums don't depend on how rows are dealt to tasks; the driver solves each gate's regression on the cells. Within
a text they go on learning online, BLOCK tokens at a time, the blocks of many texts side by side; spelling keeps its fitted weights, so
a word has one probability.

Statistics that grow with the corpus: words and segments, counted in full and joined by shuffle. Where the last ANCHOR words hash to 0 modulo SPACING
a segment begins, up to the next such place. With the counts of the anchor and of the segment after it, over the other training texts (a training text's own
are taken out), the segment has the probability (1 - w) * mixed + w * count / anchor's count; w depends on the anchor's count and on whether
the segment before was found, and is fitted on all training rows. So text that the corpus holds elsewhere scores far better than new text.

Broadcast tables have a bounded size: head (MAX_HEAD words), slots (2^MAX_BITS an order, fewer on small corpora), cells. They don't grow beyond it:
contexts share slots on large corpora. The counts of head words are broadcast with it; those of the others are joined.

A null or empty text is its end alone. Rows that repeat an id are scored each (rows that repeat id and text get one value); without training rows every
token is unknown. Of a very long text the hashes of its words are held (24 bytes a word) and bits for CHUNK tokens at once. Other columns of
documents play no part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, _tables, apart, batch_words, grams, mix, ranges, table, text_bytes

MAX_HEAD, HEAD_COUNT, MAX_BITS = 1 << 17, 4, 21
END, ESCAPE, FIRST_WORD = 0, 1, 2  # symbols; words follow by rank
BLOCK_SLOTS = 2048
DEPTHS, CONFIDENCES, STEPS, WIDTH, BUCKETS = 12, 4, 16, 1.0, 25
GATES = DEPTHS * CONFIDENCES**2
CELLS = GATES * STEPS**3
BLOCK, CHUNK, GROUP = 64, 1 << 16, 1 << 18
#: Bytes of texts scored side by side: what a block costs besides its bits is shared by all of them.
SCORED = 1 << 20
#: Bytes of texts that are put in the order of their lengths.
SORTED = 1 << 23
RATE, INERTIA, TABLE_RATE = 0.3, 40.0, 0.02
LIMIT, PRIOR, GRID = 12.0, 0.4, 256
#: Probabilities (1e-6 at least) whose product is taken at once.
FACTORS = 50
LOG10_E = 1 / math.log(10)
ANCHOR, SPACING = 3, 16
CACHE = 200_000
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_ODD_POWERS = np.multiply.accumulate(np.full(256, 0x2C9277B5, np.uint32), dtype=np.uint32)
U32 = np.uint32


@dataclass
class Bits:
    """sizes: how many bits each token (or spelled word) of the chunk has; bit; depth; first: node of order 0 (or None); slots: one array an order."""

    sizes: np.ndarray
    bit: np.ndarray
    depth: np.ndarray
    first: np.ndarray | None
    slots: list[np.ndarray]


class Tree:
    """A Huffman tree of symbols with counts: symbol i has length[i] steps from begin[i] on, each a node, its bit and its depth (at most DEPTHS - 1) in
    one number; odds are those of a one."""

    def __init__(self, weights: list[int]):
        n = len(weights)
        heap = [(w, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        parent, side, sums = np.zeros(2 * n, np.int32), np.zeros(2 * n, np.int8), [*weights, *[0] * n]
        node = n
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[i] = parent[j] = node
            side[j] = 1
            sums[node] = a + b
            heapq.heappush(heap, (a + b, node))
            node += 1
        root = node - 1
        length = np.zeros(2 * n, np.int32)
        for i in range(root - 1, -1, -1):
            length[i] = length[parent[i]] + 1
        self.length = length[:n].copy()
        self.begin = np.cumsum(self.length) - self.length
        self.steps = np.zeros(int(self.length.sum()), np.int32)
        at, left = np.arange(n), self.length.copy()
        while (left > 0).any():
            live = np.flatnonzero(left > 0)
            place = self.begin[live] + left[live] - 1
            depth = np.minimum(left[live] - 1, DEPTHS - 1)
            self.steps[place] = (parent[at[live]] - n) << 5 | depth << 1 | side[at[live]]
            at[live] = parent[at[live]]
            left[live] -= 1
        self.ones = np.zeros(n, np.float64)
        is_right = side[:root] == 1
        self.ones[parent[:root][is_right] - n] = np.array(sums[:root], np.float64)[is_right]
        self.zeros = np.array(sums[n : 2 * n], np.float64) - self.ones
        self.odds = np.log((self.ones + PRIOR) / (self.zeros + PRIOR)).astype(np.float32)

    @property
    def path(self) -> np.ndarray:
        return self.steps >> 5

    @property
    def bits(self) -> np.ndarray:
        return self.steps & 1

    def walk(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many bits each symbol has; of all bits, one symbol after another, the depth, node and bit."""
        n = self.length.take(symbols)
        steps = self.steps.take(ranges(self.begin.take(symbols), n), mode="clip")
        return n, steps >> 1 & 15, steps >> 5, steps & 1


class Head:
    """The head's words, their counts and their tree; hashes are sorted."""

    def __init__(self, ranked: np.ndarray, counts: np.ndarray, documents: int, total: int, distinct: int):
        self.documents, self.total, self.distinct = documents, total, distinct
        order = np.argsort(ranked, kind="stable")
        self.hashes, self.symbols, self.counts = ranked[order], (order + FIRST_WORD).astype(np.int32), counts[order]
        # where the hashes of each run of top bits begin: a search in a few steps
        self.shift = 64 - max(len(order).bit_length() + 1, 1)
        self.starts = np.searchsorted(self.hashes, np.arange(1 << (64 - self.shift), dtype=np.uint64) << np.uint64(self.shift)).astype(np.int32)
        escaped = max(total - documents - int(counts.sum()), 0)
        self.tree = Tree([max(documents, 1), max(escaped, 1), *counts.tolist()])

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol (ESCAPE where there is none) and count (-1 where there is none) of each word hash."""
        if not len(self.hashes):
            return np.full(len(h), ESCAPE, np.int32), np.full(len(h), -1, np.int64)
        last = len(self.hashes) - 1
        at = np.minimum(self.starts.take((h >> np.uint64(self.shift)).astype(np.int64)).astype(np.int64), last)
        behind = np.flatnonzero(self.hashes.take(at) < h)
        while len(behind):
            behind = behind[at[behind] < last]
            at[behind] += 1
            behind = behind[self.hashes.take(at[behind]) < h[behind]]
        there = self.hashes.take(at) == h
        return np.where(there, self.symbols.take(at), np.int32(ESCAPE)), np.where(there, self.counts.take(at), -1)


def _slot(context: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
    """The slot of each context (overwritten) and node, which comes multiplied."""
    context ^= spread
    context *= U32(0x85EBCA6B)
    context ^= context >> U32(15)
    context *= U32(0xC2B2AE35)
    context >>= U32(32 - bits)
    return context


def _tokens(words: Words, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, symbol and place within the row of all tokens of a group of rows, each row closed by END."""
    sizes = np.diff(words.bounds)
    row = np.repeat(np.arange(len(sizes)), sizes + 1)
    ends = np.cumsum(sizes + 1) - 1
    out = np.full(len(row), END, np.int32)
    inside = np.ones(len(row), bool)
    inside[ends] = False
    out[inside] = symbols
    return row, out, np.arange(len(row)) - np.repeat(ends - sizes, sizes + 1)


def token_bits(head: Head, symbol: np.ndarray, place: np.ndarray, at: np.ndarray, bits: int) -> Bits:
    """The bits of the tokens `at` of a group, in that order; contexts are the tokens before them in the text."""
    before = np.where(place[at] > 0, symbol[np.maximum(at - 1, 0)] + 1, 0).astype(U32)
    before2 = np.where(place[at] > 1, symbol[np.maximum(at - 2, 0)] + 1, 0).astype(U32)
    one = (before + U32(1)) * U32(0x27D4EB2F)
    two = (one ^ before2 * U32(0x165667B1)) * U32(0x9E3779B1) ^ U32(0x5BD1E995)
    n, depth, node, bit = head.tree.walk(symbol[at])
    spread = node.view(U32) * U32(0x9E3779B1)
    return Bits(n, bit, depth, node, [_slot(np.repeat(c, n), spread, bits) for c in (one, two)])


def byte_bits(tree: Tree, flat: np.ndarray, sizes: np.ndarray, bits: int) -> Bits:
    """The bits of words (their bytes one after another in flat, lower-cased) and their closing spaces."""
    total = sizes + 1
    begin = np.cumsum(total) - total
    at = ranges(np.zeros(len(total), np.int64), total)
    spelled = np.full(int(total.sum()), 0x20, np.uint8)
    spelled[ranges(begin, sizes)] = flat
    b = spelled.astype(U32)
    past = []
    for j in (1, 2, 3, 4):
        p = np.zeros(len(b), U32)
        p[j:] = b[:-j] if len(b) > j else 0
        p[at < j] = 0
        past.append(p)
    # all bytes of the word before this one, as a sum that is the same wherever the word stands
    weighed = (b + U32(1)) * U32(0x9E3779B1) * _ODD_POWERS[np.minimum(at, len(_ODD_POWERS) - 1)]
    running = np.cumsum(weighed, dtype=U32) - weighed
    prefix = running - running[np.repeat(begin, total)] if len(b) else b
    two = past[0] | past[1] << U32(8) | U32(1 << 30)
    four = past[0] | past[1] << U32(8) | past[2] << U32(16) | past[3] << U32(24)
    n, depth, node, bit = tree.walk(spelled)
    spread = node.view(U32) * U32(0x9E3779B1)
    contexts = (two * U32(0x2C9277B5), four * U32(0x27D4EB2F) + U32(1), prefix * U32(0x165667B1) + U32(2))
    return Bits(np.add.reduceat(n, begin) if len(begin) else n, bit, depth, None, [_slot(np.repeat(c, n), spread, bits) for c in contexts])


def _log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))


def _confidence(n: np.ndarray) -> np.ndarray:
    return (n > 0).astype(np.int32) + (n > 3) + (n > 30)


def slot_odds(slots: np.ndarray) -> np.ndarray:
    """The log-odds of each slot to the nearest 1/GRID, its confidence in the lowest two bits: one look-up gives both."""
    pairs = slots.astype(np.float32)
    odds = np.round(_log_odds(pairs[:, 0], pairs[:, 1]) * np.float32(GRID)) / np.float32(GRID)
    return (odds.view(np.int32) & ~3 | _confidence(slots.sum(axis=1)).astype(np.int32)).view(np.float32)


def _packed(odds: np.ndarray) -> np.ndarray:
    """slot_odds in two bytes a slot, half the memory that a look-up anywhere in the table waits for: steps of 1/GRID from -32 on and the confidence."""
    return np.clip(np.round((odds + np.float32(32)) * np.float32(GRID)), 0, (1 << 14) - 1).astype(np.uint16) << 2 | (odds.view(np.int32) & 3).astype(np.uint16)


def _gate(depth: np.ndarray, middle: np.ndarray, longest: np.ndarray) -> np.ndarray:
    return (depth * CONFIDENCES + middle) * CONFIDENCES + longest


def _step(x: np.ndarray) -> np.ndarray:
    """Which of STEPS intervals of WIDTH around 0 a log-odds lies in."""
    return np.clip(x * np.float32(1 / WIDTH) + np.float32(STEPS / 2), 0, STEPS - 1).astype(np.int32)


def count_words(training: DataFrame) -> DataFrame:
    """h, c, word: counts of all word hashes over rows (text), and the word (lower-cased)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(0))
            data, groups = batch_words(texts, lower=True)
            hashes, counts, starts, ends = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for words in groups:
                h, first, c = np.unique(words.hashes, return_index=True, return_counts=True)
                hashes.append(h)
                counts.append(c)
                starts.append(words.starts[first])
                ends.append(words.ends[first])
            h, c, s, e = (np.concatenate(x) for x in (hashes, counts, starts, ends))
            h, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            c = np.bincount(inverse, c, len(h)).astype(np.int64)
            s, n = s[first], (e - s)[first]
            for low in range(0, len(h), 50_000):
                part = slice(low, low + 50_000)
                flat = _FOLD[data[ranges(s[part], n[part])]]
                ends32 = np.concatenate([[0], np.cumsum(n[part])]).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(ends32) - 1, [None, pa.py_buffer(ends32.tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(c[part]), raw], names=["h", "c", "word"])

    return training.select("text").mapInArrow(run, "h bigint, c bigint, word binary").groupBy("h").agg(F.sum("c").alias("c"), F.min("word").alias("word"))


def _written(df: DataFrame) -> DataFrame:
    """table(df), whose shuffle files go once it is written: nothing reads them again, and they would take disk until the driver collects garbage."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return table(df)
    finally:
        conf.set(name, before)


def fit_head(training: DataFrame) -> tuple[Head, DataFrame]:
    """The head, and the table of all counts. The driver gets at most MAX_HEAD rows and the totals."""
    counts = _written(count_words(training))
    documents = training.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.where(F.col("c") >= HEAD_COUNT).select("h", "c").orderBy(F.desc("c"), "h").limit(MAX_HEAD).toArrow()
    ranked = top.column("h").to_numpy().view(np.uint64)
    return Head(ranked, top.column("c").to_numpy(), documents, sums["n"] + documents, sums["v"] + bool(documents)), counts


def fit_bytes(counts: DataFrame) -> Tree:
    """The tree of the bytes of all distinct training words and their closing spaces."""

    def tally(values: pa.Array, totals: np.ndarray) -> None:
        raw = text_bytes(values)
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        if len(raw) and offsets[-1] > offsets[0]:
            totals[:256] += np.bincount(np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], minlength=256).astype(np.int32)
        totals[0x20] += len(raw)

    return Tree([int(n) + 1 for n in _added(counts, "word", 256, tally)])


def _bits_for(n: int) -> int:
    return min(MAX_BITS, max(16, math.ceil(math.log2(max(n, 1)))))


def _chunks(place: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of a group's tokens: all, or CHUNK tokens at once of a long text."""
    for low in range(0, len(place), CHUNK if place[-1] >= CHUNK else len(place)):
        yield low, min(len(place), low + CHUNK) if place[-1] >= CHUNK else len(place)


def _text_streams(column: pa.Array, head: Head, bits: int) -> Iterator[Bits]:
    for words in batch_words(text_bytes(column), lower=True, group=GROUP)[1]:
        _, symbol, place = _tokens(words, head.look_up(words.hashes)[0])
        for low, high in _chunks(place):
            yield token_bits(head, symbol, place, np.arange(low, high), bits)


def _word_streams(column: pa.Array, tree: Tree, bits: int) -> Iterator[Bits]:
    raw = text_bytes(column)
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if len(raw) and raw.buffers()[2] is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(raw):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
        yield byte_bits(tree, data[offsets[low] : offsets[high]], np.diff(offsets[low : high + 1]), bits)
        low = high


def _added(rows: DataFrame, column: str, size: int, tally) -> np.ndarray:  # noqa: ANN001
    """The sum over all tasks of what `tally` adds to an array of `size` counts: compressed blocks, added up by block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(-(-size // BLOCK_SLOTS) * BLOCK_SLOTS, np.int32)
        for batch in batches:
            tally(batch.column(0), totals)
        each = totals.reshape(-1, BLOCK_SLOTS)
        used = np.flatnonzero(each.any(axis=1))
        for s in range(0, len(used), 64):
            yield packed(used[s : s + 64].tolist(), [each[i] for i in used[s : s + 64]])

    def packed(blocks: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        raw = [pa.compress(np.ascontiguousarray(x, np.int64).tobytes(), codec="zstd", asbytes=True) for x in parts]
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(raw, pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(pa.decompress(raw, 8 * BLOCK_SLOTS, codec="zstd"), np.int64)
                sums[b] = sums[b] + part if b in sums else part
        for b, total in sums.items():
            yield packed([b], [total])

    found = rows.select(column).mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary")
    out = np.zeros(-(-size // BLOCK_SLOTS) * BLOCK_SLOTS, np.int64)
    for r in found.toLocalIterator():
        out[BLOCK_SLOTS * r["block"] : BLOCK_SLOTS * (r["block"] + 1)] += np.frombuffer(pa.decompress(bytes(r["counts"]), 8 * BLOCK_SLOTS, codec="zstd"), np.int64)
    return out[:size]


def fit_slots(rows: DataFrame, column: str, streams, orders: int, bits: int) -> np.ndarray:  # noqa: ANN001
    """Counts of zeros and ones by slot: (orders << bits) x 2."""

    def tally(values: pa.Array, totals: np.ndarray) -> None:
        one = np.int32(1)
        for d in streams(values):
            for k, slots in enumerate(d.slots):
                at = slots << U32(1)
                at |= d.bit.view(U32)
                at.sort()  # it costs less than it saves: equal slots are counted one after another
                np.add.at(totals[k << bits + 1 :], at.astype(np.int64), one)

    return _added(rows, column, 2 * orders << bits, tally).reshape(-1, 2)


def _codes(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """For each pair of counts and each bit, with the bit's own count taken out: step of the log-odds and, above it, confidence."""
    out = np.empty((len(zeros), 2), np.uint8)
    for bit in (0, 1):
        z = np.maximum(zeros - (1 - bit), 0).astype(np.float32)
        o = np.maximum(ones - bit, 0).astype(np.float32)
        out[:, bit] = _step(_log_odds(z, o)) | _confidence(z + o) << 4
    return out.ravel()


def fit_cells(rows: DataFrame, column: str, streams, tree: Tree | None, counts: np.ndarray, bits: int) -> np.ndarray:  # noqa: ANN001
    """Counts of zeros and ones by cell, each bit's own count taken out: CELLS x 2."""
    held = rows.sparkSession.sparkContext.broadcast((None if tree is None else _codes(tree.zeros, tree.ones), _codes(counts[:, 0], counts[:, 1])))

    def tally(values: pa.Array, totals: np.ndarray) -> None:
        first, codes = held.value
        for d in streams(values):
            c = [first.take(d.first << 1 | d.bit)] if first is not None else []
            c += [codes[k << bits + 1 :].take(s << U32(1) | d.bit.view(U32)) for k, s in enumerate(d.slots)]
            cell = _gate(d.depth, c[-2] >> 4, c[-1] >> 4)
            for code in c:
                cell *= STEPS
                cell += code & 15
            np.add.at(totals, (cell << 1 | d.bit).astype(np.int64), np.int32(1))

    return _added(rows, column, 2 * CELLS, tally).reshape(-1, 2)


def solve(cells: np.ndarray, start: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of each gate (GATES x 3) by damped Newton steps on the cells, and the refining table (DEPTHS x BUCKETS)."""
    weights = np.tile(np.array(start), (GATES, 1))
    used = np.flatnonzero(cells.any(axis=1))
    zeros, ones = cells[used, 0].astype(np.float64), cells[used, 1].astype(np.float64)
    gate = used // STEPS**3
    x = np.column_stack([((used // STEPS**j) % STEPS - STEPS / 2 + 0.5) * WIDTH for j in (2, 1, 0)])
    n = zeros + ones
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip((weights[gate] * x).sum(axis=1), -LIMIT, LIMIT)))
        slope, bend = ones - n * p, n * p * (1 - p)
        g = np.column_stack([np.bincount(gate, slope * x[:, i], GATES) for i in range(3)]) - 2.0 * (weights - np.array(start))
        h = np.stack([np.column_stack([np.bincount(gate, bend * x[:, i] * x[:, j], GATES) for j in range(3)]) for i in range(3)], axis=1).astype(np.float64)
        h += np.eye(3) * (2.0 + 0.02 * np.trace(h, axis1=1, axis2=2))[:, None, None]
        weights += np.clip(np.linalg.solve(h, g[:, :, None])[:, :, 0], -0.5, 0.5)
    z = np.clip((weights[gate] * x).sum(axis=1), -LIMIT, LIMIT)
    place = (z + LIMIT) / (2 * LIMIT) * (BUCKETS - 1)
    low = np.minimum(place.astype(np.int64), BUCKETS - 2)
    share = place - low
    centre = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, BUCKETS)))
    top, all_ = np.tile(centre * 8, (DEPTHS, 1)).ravel(), np.full(DEPTHS * BUCKETS, 8.0)
    row = gate // CONFIDENCES**2 * BUCKETS + low
    for side, part in ((0, 1 - share), (1, share)):
        top += np.bincount(row + side, ones * part, DEPTHS * BUCKETS)
        all_ += np.bincount(row + side, n * part, DEPTHS * BUCKETS)
    return weights.astype(np.float32), (top / all_).reshape(DEPTHS, BUCKETS).astype(np.float32)


@dataclass
class Model:
    head: Head
    letters: Tree
    odds: tuple[np.ndarray, np.ndarray]
    bits: tuple[int, int]
    weights: tuple[np.ndarray, np.ndarray]
    tables: tuple[np.ndarray, np.ndarray]

    def packed(self, i: int) -> np.ndarray:
        """_packed(odds[i]), made once in each process."""
        made = self.__dict__.setdefault("_made", {})
        if i not in made:
            made[i] = _packed(self.odds[i])
        return made[i]

    def for_scoring(self) -> Model:
        """This model with the packed log-odds alone."""
        out = replace(self, odds=(None, None))
        out._made = {i: self.packed(i) for i in range(2)}
        return out


def fit(training: DataFrame, text: str = "text") -> tuple[Model, DataFrame]:
    """A model of all training rows, and their word counts (h, c, word)."""
    rows = training.select(training[text].cast("string").alias("text"))
    head, counts = fit_head(rows)
    bits = (_bits_for(2 * head.total), _bits_for(32 * head.distinct))
    letters = fit_bytes(counts)
    held = rows.sparkSession.sparkContext.broadcast(head)
    texts = lambda column: _text_streams(column, held.value, bits[0])
    words = lambda column: _word_streams(column, letters, bits[1])
    slots = fit_slots(rows, "text", texts, 2, bits[0])
    weights, refined = solve(fit_cells(rows, "text", texts, head.tree, slots, bits[0]), (0.8, 0.2, 0.2))
    spelled = fit_slots(counts, "word", words, 3, bits[1])
    spell_weights, spell_refined = solve(fit_cells(counts, "word", words, None, spelled, bits[1]), (0.3, 0.4, 0.4))
    return Model(head, letters, (slot_odds(slots), slot_odds(spelled)), bits, (weights, spell_weights), (refined, spell_refined)), counts


def _inputs(d: Bits, first: np.ndarray | None, packed: np.ndarray, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The three log-odds of each bit, and its gate."""
    x, sure = [], []
    for k, slots in enumerate(d.slots):
        code = packed[k << bits : (k + 1) << bits].take(slots, mode="clip")
        sure.append(code & np.uint16(3))
        code >>= np.uint16(2)
        odds = code.astype(np.float32)
        odds *= np.float32(1 / GRID)
        odds -= np.float32(32)
        x.append(odds)
    gate = _gate(d.depth, sure[-2], sure[-1])
    return ([first.take(d.first, mode="clip"), *x] if first is not None else x), gate


def _refined(z: np.ndarray, flat: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a one by a flat table whose rows of BUCKETS start at `row`; the nearer of the two buckets it lies between."""
    place = (z + np.float32(LIMIT)) * np.float32((BUCKETS - 1) / (2 * LIMIT))
    low = np.minimum(place.astype(np.int32), BUCKETS - 2)
    place -= low.astype(np.float32)
    low += row
    at = low.astype(np.int64)
    below = flat.take(at, mode="clip")
    upper = place > np.float32(0.5)
    at += 1
    place *= flat.take(at, mode="clip") - below
    below += place
    at -= ~upper
    return below, at


def _sure(z: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Probability of each bit, whose sign is 1 or -1, by the log-odds of a one: exact at both ends."""
    p = z * -sign
    np.exp(p, out=p)
    p += np.float32(1)
    return np.reciprocal(p, out=p)


def _mean(p: np.ndarray, refined: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """The mean of two probabilities: that of the bit, and that of a one."""
    q = refined - np.float32(0.5)
    q *= sign
    q += np.float32(0.5)
    q += p
    q *= np.float32(0.5)
    return np.clip(q, np.float32(1e-6), np.float32(1 - 1e-6), out=q)


def _log10_sums(q: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of log10 of each token's (or word's) bits: one logarithm of their product where no product can leave the range of a double."""
    begin = np.cumsum(sizes) - sizes
    if sizes.max() <= FACTORS:
        return np.log10(np.multiply.reduceat(q, begin, dtype=np.float64))
    return np.add.reduceat(np.log(q, out=q), begin, dtype=np.float64) * LOG10_E


def _mixed(weights: np.ndarray, at: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
    """The log-odds added up with the weights at `at` (rows of three and a blank, which a 16-byte look-up gives at once), within the limits."""
    w = weights.view(np.complex128).take(at, mode="clip").view(np.float32).reshape(-1, 4)
    z = w[:, 0] * x[0]
    for k in (1, 2):
        z += w[:, k] * x[k]
    return np.clip(z, np.float32(-LIMIT), np.float32(LIMIT), out=z)


def _padded(weights: np.ndarray) -> np.ndarray:
    """Weights of gates (x 3) with a blank fourth column."""
    return np.column_stack([weights, np.zeros(len(weights), weights.dtype)])


def spelling(model: Model, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each word's bytes and closing space."""
    out = np.zeros(len(sizes))
    weights = _padded(model.weights[1]).ravel()
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
        d = byte_bits(model.letters, flat[before : ends[high - 1]], sizes[low:high], model.bits[1])
        x, gate = _inputs(d, None, model.packed(1), model.bits[1])
        z, sign = _mixed(weights, gate, x), (2 * d.bit - 1).astype(np.float32)
        better, _ = _refined(z, model.tables[1].ravel(), d.depth * np.int32(BUCKETS))
        out[low:high] = _log10_sums(_mean(_sure(z, sign), better, sign), d.sizes)
        low = high
    return out


class Mixer:
    """The weights and tables of a group of rows, which learn within each row."""

    def __init__(self, model: Model, rows: int):
        self.model = model
        self.weights = np.tile(_padded(model.weights[0]).ravel(), (rows, 1))
        self.tables = np.tile(model.tables[0].ravel(), (rows, 1))

    def score(self, symbol: np.ndarray, row: np.ndarray, place: np.ndarray, low: int, high: int) -> np.ndarray:
        """log10 probability of the tokens low..high of a group; a row's tokens come whole, or in chunks that begin at multiples of BLOCK."""
        m, out, odds = self.model, np.empty(high - low), self.model.packed(0)
        block = place[low:high] // BLOCK
        order = np.argsort(block, kind="stable")  # the first BLOCK tokens of each row, the next of each, ...
        owner = row[low:high][order].astype(np.int32)
        ends = np.append(np.flatnonzero(np.diff(block[order])) + 1, high - low)
        start = 0
        for end in ends.tolist():
            # the bits of a block of all rows at a time: few enough to stay in the processor's cache
            d = token_bits(m.head, symbol, place, order[start:end] + low, m.bits[0])
            y, gate = _inputs(d, m.head.tree.odds, odds, m.bits[0])
            s = (2 * d.bit - 1).astype(np.float32)
            rows = owner[start:end]
            begin = np.append(0, np.flatnonzero(np.diff(rows)) + 1)
            present = rows[begin]
            local = np.repeat(np.arange(len(present), dtype=np.int32), np.add.reduceat(d.sizes, begin))
            part = self.weights[present].ravel()
            flat = self.tables[present].ravel()
            g = (local * np.int32(GATES) + gate).astype(np.int64)
            z = _mixed(part, g, y)
            p = _sure(z, s)
            local *= np.int32(DEPTHS)
            local += d.depth
            local *= np.int32(BUCKETS)
            better, near = _refined(z, flat, local)
            out[order[start:end]] = _log10_sums(_mean(p, better, s), d.sizes)
            error = np.subtract(np.float32(1), p, out=p)
            error *= s
            # slope and bend of each gate, two sums in one pass
            both, weights = np.empty(len(g), np.complex64), part.reshape(-1, 4)
            two = both.view(np.float32).reshape(-1, 2)
            for k in range(3):
                np.multiply(error, y[k], out=two[:, 0])
                np.multiply(y[k], y[k], out=two[:, 1])
                sums = np.zeros(len(weights), np.complex64)
                np.add.at(sums, g, both)
                weights[:, k] += np.float32(RATE) * sums.real / (sums.imag / np.float32(4) + np.float32(INERTIA))
            self.weights[present] = part.reshape(len(present), 4 * GATES)
            near <<= 1
            near |= d.bit
            seen = np.bincount(near, minlength=2 * len(flat)).astype(np.float32).reshape(-1, 2)
            ones, all_ = seen[:, 1], seen[:, 0] + seen[:, 1]
            flat += np.float32(TABLE_RATE) * (ones - all_ * flat) / (np.float32(1) + np.float32(TABLE_RATE) * all_)
            self.tables[present] = flat.reshape(len(present), DEPTHS * BUCKETS)
            start = end
        return out


def by_length(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in parts of about SORTED bytes of text, each from its shortest text to its longest: texts that are scored side by side
    then end together, instead of all but one long text ending early and its blocks costing as much as full ones."""
    for batch in batches:
        texts = text_bytes(batch.column(column))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        low = 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SORTED, "right")) - 1)
            yield batch.slice(low, high - low).take(pa.array(np.argsort(np.diff(offsets[low : high + 1]), kind="stable")))
            low = high


def segments(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a group: each token's segment (counted over the group); each segment's row, whether an anchor begins it, and the hashes of that anchor
    and of anchor and segment."""
    sizes = np.diff(words.bounds)
    row, _, place = _tokens(words, np.zeros(len(words.hashes), np.int32))
    word_row = np.repeat(np.arange(len(sizes)), sizes)
    gram = grams(words.hashes, ANCHOR)  # of the words i .. i + ANCHOR - 1
    anchor = np.zeros(len(words.hashes), bool)
    if len(gram):
        whole = word_row[: len(gram)] == word_row[ANCHOR - 1 :]
        anchor[ANCHOR - 1 :] = whole & (gram % np.uint64(SPACING) == 0)
    after = np.zeros(len(row), bool)  # a token behind an anchor, or the first of a row
    token_of = np.arange(len(words.hashes)) + word_row
    after[token_of[anchor] + 1] = True
    begins = after | (place == 0)
    segment = np.cumsum(begins) - 1
    start = np.flatnonzero(begins)
    hashes = np.full(len(row), 0x5851F42D4C957F2D, np.uint64)  # ends
    hashes[token_of] = words.hashes
    up, down = _tables(len(row) + 1)
    total = np.append(np.uint64(0), np.cumsum(hashes * up[: len(row)], dtype=np.uint64))
    stop = np.append(start[1:], len(row))
    content = mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))
    context = np.zeros(len(start), np.uint64)
    headed = after[start]
    context[headed] = gram[np.flatnonzero(anchor) - (ANCHOR - 1)]
    return segment, row[start], headed, context, mix(context * np.uint64(0x9E3779B97F4A7C15) + content)


def scored(documents: DataFrame, model: Model, counts: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte: one row per row of documents. `training` tells
    the rows that the model was fitted on."""
    held = documents.sparkSession.sparkContext.broadcast(model.for_scoring())
    total, distinct = model.head.total, model.head.distinct
    floor = math.log10(total + 0.1 * (distinct + 1))
    plain = documents[text].cast("string")
    docs = documents.select(documents[doc_id].alias("doc_id"), F.xxhash64(plain).alias("th"), F.coalesce(training, F.lit(False)).alias("trained"), plain.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def times(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
        """How often each value occurs in its own row."""
        order = np.lexsort((values, owner))
        o, v = owner[order], values[order]
        first = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (v[1:] != v[:-1]))) if len(o) else np.empty(0, np.int64)
        n = np.diff(np.append(first, len(o)))
        out = np.empty(len(o), np.int64)
        out[order] = np.repeat(n, n)
        return out

    def lists(values: np.ndarray, owner: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)), pa.array(values, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        known_words, known_values = np.empty(0, np.uint64), np.empty(0)

        def spelled(data: np.ndarray, words: Words, tail: np.ndarray) -> np.ndarray:
            """What each word at `tail` costs to spell; the last CACHE distinct words or more are remembered."""
            nonlocal known_words, known_values
            h, first, inverse = np.unique(words.hashes[tail], return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(known_words, h), max(len(known_words) - 1, 0))
            there = known_words[at] == h if len(known_words) else np.zeros(len(h), bool)
            value = np.empty(len(h))
            value[there] = known_values[at[there]]
            if not there.all():
                pick = tail[first[~there]]
                sizes = words.ends[pick] - words.starts[pick]
                value[~there] = spelling(m, _FOLD[data[ranges(words.starts[pick], sizes)]], sizes)
                if len(known_words) > CACHE:
                    known_words, known_values = h, value
                else:
                    joined = np.append(known_words, h[~there])
                    order = np.argsort(joined, kind="stable")
                    known_words, known_values = joined[order], np.append(known_values, value[~there])[order]
            return value[inverse]

        end_known, end_score = int(m.head.documents > 0), math.log10(m.head.documents + 0.1) - floor
        for batch in by_length(batches, 3):
            texts = text_bytes(batch.column(3))
            data, groups = batch_words(texts, lower=True, group=SCORED)
            for words in groups:
                rows = len(words)
                symbols, c = m.head.look_up(words.hashes)
                row, symbol, place = _tokens(words, symbols)
                mixer, value = Mixer(m, rows), np.zeros(len(row))
                # only a text that is alone is cut: in a group, a cut would fall within a block
                for low, high in _chunks(place) if rows == 1 else [(0, len(place))]:
                    value[low:high] = mixer.score(symbol, row, place, low, high)
                tail = np.flatnonzero(c < 0)
                owner = np.repeat(np.arange(rows), np.diff(words.bounds))
                if len(tail):
                    value[tail + owner[tail]] += spelled(data, words, tail)
                segment, seg_row, headed, context, key = segments(words)
                mixed = np.bincount(segment, value, len(seg_row))
                score = np.bincount(seg_row, mixed, rows)
                # of each headed segment: how often its anchor, and it, occur in this very row
                mine = np.flatnonzero(headed)
                own_row, own_context, own_key = seg_row[mine], context[mine], key[mine]
                own_n, context_n = times(own_row, own_key), times(own_row, own_context)
                known = c >= 0
                base = np.bincount(owner[known], np.log10(c[known] + 0.1) - floor, rows) + end_score
                # words outside the head, distinct within a row
                order = np.lexsort((words.hashes[tail], owner[tail]))
                h, o = words.hashes[tail][order], owner[tail][order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1]))) if len(h) else np.empty(0, np.int64)
                part = batch.slice(words.first_row, rows)
                n_bytes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset + words.first_row : texts.offset + words.first_row + rows + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(3)), pa.array(n_bytes), pa.array(np.diff(words.bounds).astype(np.int64) + 1),
                        pa.array(np.bincount(owner[known], minlength=rows).astype(np.int64) + end_known), pa.array(base), pa.array(score),
                        lists(h[first].view(np.int64), o[first], rows, pa.int64()), lists(np.diff(np.append(first, len(h))), o[first], rows, pa.int32()),
                        lists(own_context.view(np.int64), own_row, rows, pa.int64()), lists(own_key.view(np.int64), own_row, rows, pa.int64()),
                        lists(context_n, own_row, rows, pa.int32()), lists(own_n, own_row, rows, pa.int32()),
                        lists(mixed[mine], own_row, rows, pa.float64()),
                    ],
                    names=["doc_id", "th", "trained", "n_bytes", "n_tokens", "head_known", "head_base", "mixed", "words", "word_n", "contexts", "keys", "context_n", "key_n", "segment"],
                )

    shape = f"doc_id {kind}, th bigint, trained boolean, n_bytes bigint, n_tokens bigint, head_known bigint, head_base double, mixed double, words array<bigint>, word_n array<int>, contexts array<bigint>, keys array<bigint>, context_n array<int>, key_n array<int>, segment array<double>"
    main = _written(docs.mapInArrow(run, shape))
    row = ["doc_id", "th"]
    # rows that repeat id and text have equal parts: one of them stands for all
    rare = main.select(*row, F.explode(F.arrays_zip("words", "word_n")).alias("x")).select(*row, F.col("x.words").alias("h"), F.col("x.word_n").alias("n"))
    found = rare.join(apart(counts.select("h", "c"), "h"), "h", "left").select(*row, "n", F.coalesce("c", F.lit(0)).alias("c"))
    copies = F.count(F.lit(1)).alias("m")
    value = F.col("n") * (F.log10(F.col("c") + 0.1) - floor)
    words = found.groupBy(*row).agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(value).alias("base"))
    zipped = F.arrays_zip("contexts", "keys", "context_n", "key_n", "segment")
    places = main.select(*row, "trained", F.posexplode(zipped).alias("i", "x")).select(*row, "trained", "i", "x.*")
    pairs = main.where("trained").select(F.explode(F.arrays_zip("keys", "contexts")).alias("x")).select("x.*")
    by_key = pairs.groupBy("keys").agg(F.min("contexts").alias("contexts"), F.count("*").alias("c"))
    by_context = by_key.groupBy("contexts").agg(F.sum("c").alias("of")).where("of > 1")
    seen = places.join(apart(by_context, "contexts"), "contexts").join(apart(by_key.select("keys", "c"), "keys"), "keys", "left")
    out_own = lambda n, own: F.coalesce(F.col(n), F.lit(0)) - F.when(F.col("trained"), F.col(own)).otherwise(0)
    rest = seen.select(*row, "trained", "i", "segment", out_own("c", "key_n").alias("c"), out_own("of", "context_n").alias("of")).where("of > 0")
    rest = rest.repartition(*row).dropDuplicates([*row, "i"])  # one shuffle for these and for the window
    w = Window.partitionBy(*row).orderBy("i")
    before = F.coalesce((F.lag("i").over(w) == F.col("i") - 1) & (F.lag("c").over(w) > 0), F.lit(False))
    gated = _written(rest.withColumn("gate", F.when(F.col("of") > 3, 2).when(F.col("of") > 1, 1).otherwise(0) * 2 + before.cast("int")))
    odds = {r["gate"]: (r["hits"] + 0.5) / (r["n"] + 2) for r in gated.where("trained").groupBy("gate").agg(F.count("*").alias("n"), F.sum((F.col("c") > 0).cast("int")).alias("hits")).collect()}
    share = F.element_at(F.create_map(*[F.lit(x) for g in range(6) for x in (g, odds.get(g, 0.2))]), F.col("gate"))
    other = F.log10(1 - share)
    copied = F.log10(share) + F.log10(F.col("c") / F.col("of")) - F.col("segment")
    gain = F.when(F.col("c") > 0, F.greatest(other, copied) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(other - copied)))).otherwise(other)
    gains = gated.select(*row, gain.alias("gain")).groupBy(*row).agg(F.sum("gain").alias("gain"))
    same = main.groupBy(*row).agg(copies)
    a, b, s = (x.select(F.col("doc_id").alias(f"{p}_id"), F.col("th").alias(f"{p}_th"), *[c for c in x.columns if c not in row]) for p, x in (("a", words), ("b", gains), ("m", same)))
    on = lambda p: main["doc_id"].eqNullSafe(F.col(f"{p}_id")) & (main["th"] == F.col(f"{p}_th"))
    joined = main.join(a, on("a"), "left").join(b, on("b"), "left").join(s, on("m"), "left")
    score = F.col("mixed") + F.coalesce("gain", F.lit(0.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce(F.col("known") / F.col("m"), F.lit(0)).cast("bigint")).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.coalesce(F.col("base") / F.col("m"), F.lit(0.0))).alias("base_score"), score.alias("score"),
        (-score * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )

"""Language identification by language-bitmask n-gram filters.

The n-grams are the runs of four bytes of a text whose A-Z are lower-cased and whose other ASCII characters than letters count
as one separator each. Training counts each (language, n-gram) over all labelled rows. An n-gram belongs to every language in
which its relative frequency reaches SHARE of the highest one, so an n-gram may belong to several and stray foreign passages
don't spoil a filter. The filters of all languages are bit-sliced into one Bloom filter: a slot holds a bit per language, and
the AND of an n-gram's K slots is the mask of all languages that contain it. A text's hits are counted per language (popcounts
over its n-grams), corrected for the language's false positives, and the highest corrected share decides.

The filter is sized by the n-grams that the languages hold: LOAD slots for each n-gram of the largest language and hash function, a power of two
from LEAST_SLOTS to MOST_SLOTS (8 bytes a slot for up to 62 languages, one more array for each further 62: 64 MB at most for 62), which
bounds its broadcast. Four bytes of folded text can't make many more; beyond that the correction still holds, with more noise. A text that is null or has no letter is `und` with score 0; with no labelled rows, all are.
Rows that are judged by filters fitted on them would cover themselves: for them only n-grams of several different texts count (fit).
Ties go to the language first in order. score is the winner's corrected share of hits times its lead over the second:
share * winner / (winner + second), from 0 to 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, text_bytes

K, SHARE, LANES = 3, 0.25, 62
LOAD, LEAST_SLOTS, MOST_SLOTS = 4, 1 << 16, 1 << 23
#: Rows that are filtered at a time.
ROWS = 500
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 0x20
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def _groups(texts: pa.Array, size: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, n-grams, bounds by row) for groups of rows of about `size` bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        low, lengths = int(offsets[row]), np.diff(offsets[row : stop + 1])
        # each text gets a separator on both sides; n-grams across texts are then left out by position
        padded = np.full(int(lengths.sum()) + 2 * len(lengths), 0x20, np.uint8)
        begin = np.cumsum(lengths + 2) - lengths - 1
        inside = np.ones(len(padded), bool)
        inside[begin - 1] = inside[begin + lengths] = False
        padded[inside] = _FOLD[data[low : int(offsets[stop])]]
        b = padded.astype(np.uint32)
        g = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24) if len(b) > 3 else np.empty(0, np.uint32)
        space = padded == 0x20
        good = ~(space[:-3] & space[1:-2] | space[1:-2] & space[2:-1] | space[2:-1] & space[3:]) if len(b) > 3 else np.empty(0, bool)
        for j in (0, 1, 2):  # a run that starts in the last two bytes of a text, or on its closing separator, crosses into the next
            at = begin + lengths - j
            good[at[(at >= 0) & (at < len(good))]] = False
        where = np.flatnonzero(good)
        yield row, g[where], np.searchsorted(where, np.append(begin - 1, len(padded)))
        row = stop


def count_ngrams(labelled: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, gram, n, lo, hi: counts over all rows with a language, least and greatest hash of the texts that hold the n-gram."""
    rows = labelled.select(labelled[text].cast("string").alias("text"), labelled[lang].cast("string").alias("lang")).where("lang is not null and text is not null")
    rows = rows.withColumn("th", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counts] = {}
        for batch in batches:
            codes = batch.column(1).dictionary_encode()
            index, names, hashes = codes.indices.to_numpy(), codes.dictionary.to_pylist(), batch.column(2).to_numpy()
            parts: list[Counts] = []
            held, most = 0, 400_000
            for row, g, bounds in _groups(text_bytes(batch.column(0))):
                span, sizes = slice(row, row + len(bounds) - 1), np.diff(bounds)
                own, th = np.repeat(index[span].astype(np.uint64), sizes), np.repeat(hashes[span], sizes)
                parts.append(_merge([(own << np.uint64(32) | g, np.ones(len(g), np.int64), th, th)]))
                held += len(parts[-1][0])
                if held > most:  # a batch's counts are merged as they come, not all at its end
                    parts = [_merge(parts)]
                    held = len(parts[0][0])
                    most = max(most, 2 * held)
            for key, found in _by_language(parts).items():
                total[names[key]] = _merge([total[names[key]], found] if names[key] in total else [found])
            if sum(len(x[0]) for x in total.values()) > 2_000_000:  # bounded memory: hand on what is there
                yield from _rows(total)
                total = {}
        yield from _rows(total)
        pa.default_memory_pool().release_unused()

    found = rows.mapInArrow(run, "lang string, gram bigint, n bigint, lo bigint, hi bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


#: n-grams, counts, least and greatest text hash.
Counts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _merge(parts: list[Counts]) -> Counts:
    keys, counts, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    if not len(keys):
        return keys, counts, low, high
    return keys[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _by_language(parts: list[Counts]) -> dict[int, Counts]:
    if not parts:
        return {}
    keys, *rest = _merge(parts)
    owner = (keys >> np.uint64(32)).astype(np.int64)
    return {int(x): (keys[owner == x] & np.uint64(0xFFFFFFFF), *(c[owner == x] for c in rest)) for x in np.unique(owner)}


def _rows(total: dict[str, Counts]) -> Iterator[pa.RecordBatch]:
    for name, (keys, *rest) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), *map(pa.array, rest)], names=["lang", "gram", "n", "lo", "hi"])


def _slots(g: np.ndarray, size: int) -> list[np.ndarray]:
    """The K slots of each n-gram in a filter of `size` (a power of two)."""
    h = mix(g.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    step = h >> np.uint64(32) | np.uint64(1)
    return [((h + np.uint64(j) * step) & np.uint64(size - 1)).astype(np.int64) for j in range(K)]


def filter_size(n_grams: int) -> int:
    """Slots for a language of so many n-grams."""
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (LOAD * K * max(1, n_grams) - 1).bit_length()))


class Filters:
    """languages; slots: one array of masks for each LANES languages; false: rate of false positives by language."""

    def __init__(self, languages: list[str], slots: list[np.ndarray]):
        self.languages, self.slots = languages, slots
        self.false = np.array([float(np.mean(slots[i // LANES] >> np.uint64(i % LANES) & np.uint64(1))) ** K for i in range(len(languages))])

    def shares(self, g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Corrected share of hits, rows x languages."""
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.languages)))
        at = _slots(g, len(self.slots[0]))
        for w, slots in enumerate(self.slots):
            masks = slots[at[0]]
            for a in at[1:]:
                masks &= slots[a]
            for lane, i in enumerate(range(w * LANES, min(len(self.languages), (w + 1) * LANES))):
                hits = np.concatenate([[0], np.cumsum((masks >> np.uint64(lane) & np.uint64(1)).astype(np.int64))])
                out[:, i] = hits[bounds[1:]] - hits[bounds[:-1]]
        return np.clip((out / np.maximum(n, 1)[:, None] - self.false) / np.maximum(1e-9, 1 - self.false), 0, 1) * (n > 0)[:, None]


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", shared: bool = False) -> Filters:
    """Filters from all labelled rows. The driver gets the languages and at most MOST_SLOTS masks for each LANES of them.

    shared: an n-gram counts for a language only if at least two different texts of it hold it. What the filters say of a row
    they were fitted on then rests on other texts; copies of a text are one text.
    """
    counts = count_ngrams(labelled, lang, text).persist()
    try:
        totals = {r["lang"]: r["t"] for r in counts.groupBy("lang").agg(F.sum("n").alias("t")).collect()}
        languages = sorted(totals)
        slots = [np.zeros(LEAST_SLOTS, np.uint64) for _ in range(0, len(languages), LANES)]
        if languages:
            spark = labelled.sparkSession
            known = spark.createDataFrame([(x, i // LANES, 1 << i % LANES, float(totals[x])) for i, x in enumerate(languages)], "lang string, word int, bit bigint, t double")
            rated = (counts.where("lo <> hi") if shared else counts).join(F.broadcast(known), "lang").withColumn("p", F.col("n") / F.col("t"))
            best = rated.groupBy("gram").agg(F.max("p").alias("top"), F.collect_list(F.struct("word", "bit", "p")).alias("in"))
            chosen = best.select("gram", F.explode(F.filter("in", lambda x: x["p"] >= F.col("top") * SHARE)).alias("x")).select("gram", "x.word", "x.bit")
            size = filter_size(chosen.groupBy("word", "bit").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0)
            slots = [np.zeros(size, np.uint64) for _ in slots]
            kept = chosen.groupBy("gram", "word").agg(F.bit_or("bit").alias("bits"))

            def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    g = batch.column(0).to_numpy().astype(np.uint64)
                    for s in _slots(g, size):
                        yield pa.RecordBatch.from_arrays([pa.array(s), batch.column(1), batch.column(2)], names=["slot", "word", "bits"])

            found = kept.mapInArrow(spread, "slot bigint, word int, bits bigint").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
            at, word, bits = (found.column(c).to_numpy() for c in ("slot", "word", "bits"))
            for w, own in enumerate(slots):
                own[at[word == w]] = bits[word == w].astype(np.uint64)
        return Filters(languages, slots)
    finally:
        counts.unpersist()


def predict(documents: DataFrame, filters: Filters, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, coverage: one row per row of documents; coverage is the winner's corrected share."""
    held = documents.sparkSession.sparkContext.broadcast(filters)
    docs = documents.select(documents[doc_id].alias("doc_id"), documents[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, coverage = classify(held.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(coverage)], names=["doc_id", "lang_pred", "score", "coverage"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, coverage double")


def classify(f: Filters, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    n = len(texts)
    lang, score, coverage = [UNDETERMINED] * n, np.zeros(n), np.zeros(n)
    if not f.languages:
        return lang, score, coverage
    lettered = np.array([bool(x) and bool(_LETTER.search(x)) for x in texts.to_pylist()], bool)
    for row, g, bounds in _groups(text_bytes(texts)):
        shares = f.shares(g, bounds)
        best = shares.argmax(axis=1)
        top = shares[np.arange(len(best)), best]
        second = np.partition(shares, -2, axis=1)[:, -2] if shares.shape[1] > 1 else np.zeros(len(best))
        span = slice(row, row + len(best))
        own = lettered[span]
        coverage[span] = np.where(own, top, 0)
        score[span] = np.where(own, top * top / np.maximum(top + second, 1e-12), 0)
        for i in np.flatnonzero(own):
            lang[row + i] = f.languages[best[i]]
    return lang, score, coverage


def recognised(documents: DataFrame, filters: Filters, min_coverage: float, text: str = "text") -> DataFrame:
    """The rows of documents whose text has a letter and reaches min_coverage in some language, with all their columns."""
    held = documents.sparkSession.sparkContext.broadcast(filters)
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):  # work memory follows some rows, not a batch
                batch = whole.slice(first, ROWS)
                texts = batch.column(at).cast(pa.string())
                if held.value.languages:
                    lang, _, coverage = classify(held.value, texts)
                    keep = (np.array(lang, object) != UNDETERMINED) & (coverage >= min_coverage)
                else:
                    keep = np.array([bool(x) and bool(_LETTER.search(x)) for x in texts.to_pylist()], bool)
                yield batch.filter(pa.array(keep, pa.bool_()))
        pa.default_memory_pool().release_unused()  # a worker that is kept for later stages gives back what it no longer needs

    return documents.mapInArrow(run, documents.schema)

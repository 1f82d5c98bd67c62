"""Audio fingerprints: chroma frames, integral-image filters, packed integers; offset histograms and bit errors align them.

A recording (mono PCM, 16 bit) is cut into overlapping frames; the power of each frame's spectrum is gathered by pitch class. Over
the image of frames x pitch classes, whose integral image gives any rectangle's sum in four look-ups, FILTERS compare two areas
of a window of WIDTH frames; each answer is quantised to two bits (Gray coded, so near answers differ in one bit), and sixteen
answers pack into a 32-bit integer for each window.

Search: recordings with equal fingerprints are one class, under the smallest id. A query rarely starts where the match's frames start, so it is
read at PHASES places within a hop, and of each integer the WEAK bits whose answers were nearest to a threshold are flipped, one at a time: the bits
that another cut or some noise turns first. A window meets those of other classes with an integer it is looked for by; how many do at one offset is
that offset's hits. Queries and recordings are dealt into blocks, each pair of blocks is one group that gets their prints once, and nothing else than
what it accepts leaves it (voted()), so windows that meet, most of them by chance, are rows of no table. Of all offsets with MIN_HITS windows, and those
beside them, the one with the least bit errors over the whole overlap is accepted if at most MAX_ERROR of all bits differ and the overlap has at least
MIN_OVERLAP windows (confirmed()). Nothing is capped. Unrelated recordings still meet by chance, so the comparisons within the groups and the pairs of
blocks grow with the square of the recordings, and so do the links between short overlaps; what a group holds does not.
Prints without probes of their own (search() of a table of prints) are met with each of their 32 bits flipped.

A null, empty or short recording (fewer than WIDTH frames) has no fingerprint, is its own class and links with nothing; so does a
row with a null id, whose class is null. Rows that repeat an id: each has its class, links count once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranges, table

RATE, FRAME, HOP = 2000, 256, 128
CLASSES, WIDTH = 12, 16
LOW_HZ = 110.0
MIN_HITS, MIN_OVERLAP, MAX_ERROR = 2, 16, 0.2
PHASES, WEAK = 8, 6
#: Recordings of an Arrow batch.
BATCH = 256
#: A block of queries has twice so many windows at most, a block of recordings sixteen times: a query's probes are eight times as wide as its prints.
BLOCK = 1 << 17
#: Windows that meet taken at once.
MEETINGS = 1 << 20
#: Windows compared around two that meet, in two halves of four. Of an overlap of MIN_OVERLAP, or one less, each window has a neighbour at 7 or -7.
AROUND = (-32, -24, -16, -7, 7, 16, 24, 32)
#: The bits compared: whether an answer is above the middle threshold, which noise turns least.
HIGH = 0xAAAAAAAA
#: For each number of windows seen by both sides, how many of their bits may differ.
ALLOWED = (-1, *(int(16 * n * MAX_ERROR + 1.3 * math.sqrt(16 * n)) for n in range(1, len(AROUND) + 1)))
#: What a query's integer is xored with where its weak bits aren't known: itself, and each integer one bit away.
FLIPS = (0, *(1 << i for i in range(32)))
THRESHOLDS = (-0.25, 0.0, 0.25)
#: (kind, first pitch class, pitch classes, frames): by rule, four heights, widths and kinds each spread over the classes.
FILTERS = tuple((i % 4, (5 * i) % 12, 1 + i // 4 * 2 % 6, (16, 8, 12, 4)[i // 4]) for i in range(16))


def pitch_bins(rate: int = RATE, frame: int = FRAME) -> np.ndarray:
    """Pitch class of each bin of the spectrum; -1 below LOW_HZ."""
    hz = np.fft.rfftfreq(frame, 1 / rate)
    out = np.full(len(hz), -1)
    used = hz >= LOW_HZ
    out[used] = np.round(CLASSES * np.log2(hz[used] / 440.0)).astype(int) % CLASSES
    return out


def chroma(samples: np.ndarray, rate: int = RATE) -> np.ndarray:
    """recordings x frames x pitch classes, each frame scaled to sum 1, for recordings x samples."""
    if samples.shape[1] < FRAME:
        return np.zeros((len(samples), 0, CLASSES))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME, axis=1)[:, ::HOP]
    power = np.abs(np.fft.rfft(frames * np.hanning(FRAME).astype(np.float32), axis=2)) ** 2
    bins = pitch_bins(rate)
    gather = np.zeros((len(bins), CLASSES))
    gather[np.flatnonzero(bins >= 0), bins[bins >= 0]] = 1
    out = power @ gather
    return out / np.maximum(out.sum(axis=2, keepdims=True), 1e-9)


def fingerprint(frames: np.ndarray) -> np.ndarray:
    """recordings x windows of unsigned 32-bit integers."""
    return fingerprint_weak(frames, 0)[0]


def fingerprint_weak(frames: np.ndarray, weak: int) -> tuple[np.ndarray, np.ndarray]:
    """fingerprint(), and recordings x windows x weak masks of the bits that would turn first, the nearest to its threshold first."""
    n = frames.shape[1] - WIDTH + 1
    if n <= 0:
        return np.zeros((len(frames), 0), np.uint32), np.zeros((len(frames), 0, weak), np.uint32)
    # pitch classes are circular: the image is laid out twice
    image = np.concatenate([frames, frames], axis=2)
    integral = np.zeros((len(frames), frames.shape[1] + 1, 2 * CLASSES + 1))
    integral[:, 1:, 1:] = image.cumsum(axis=1).cumsum(axis=2)
    at = np.arange(n)

    def area(t: int, dt: int, y: int, dy: int) -> np.ndarray:
        a, b = integral[:, at + t], integral[:, at + t + dt]
        return b[:, :, y + dy] - a[:, :, y + dy] - b[:, :, y] + a[:, :, y]

    out = np.zeros((len(frames), n), np.uint32)
    near, masks = np.empty((len(frames), n, len(FILTERS) if weak else 0)), np.empty((len(frames), n, len(FILTERS) if weak else 0), np.uint32)
    for i, (kind, y, dy, dt) in enumerate(FILTERS):
        if kind == 0:  # one band against the next
            p, q = area(0, dt, y, dy), area(0, dt, (y + dy) % CLASSES, dy)
        elif kind == 1:  # earlier against later
            p, q = area(0, dt // 2, y, dy), area(dt // 2, dt // 2, y, dy)
        elif kind == 2:  # a band against the tritone above
            p, q = area(0, dt, y, dy), area(0, dt, (y + 6) % CLASSES, dy)
        else:  # the middle against both ends
            m = dt // 4
            p, q = area(m, 2 * m, y, dy), area(0, m, y, dy) + area(3 * m, m, y, dy)
        value = (p - q) / (p + q + 1e-6)
        level = sum((value > t).astype(np.uint32) for t in THRESHOLDS)
        out = out << np.uint32(2) | level ^ level >> np.uint32(1)
        if weak:  # the outer thresholds turn an answer's low bit, the middle one its high bit
            away = np.abs(value[..., None] - np.array(THRESHOLDS))
            near[..., i] = away.min(axis=2)
            masks[..., i] = np.uint32(1) << (2 * (len(FILTERS) - 1 - i) + (away.argmin(axis=2) == 1)).astype(np.uint32)
    return out, np.take_along_axis(masks, np.argsort(near, axis=2)[..., :weak], axis=2)


def probes(samples: np.ndarray, rate: int = RATE) -> list[list[np.ndarray]]:
    """Of each recording, for each start within a hop, the integer of each window with its weak bits packed above it, for recordings x samples."""
    found: list[list[np.ndarray]] = [[] for _ in samples]
    for shift in range(0, HOP, HOP // PHASES):
        whole, masks = fingerprint_weak(chroma(samples[:, shift:], rate), WEAK)
        packed = whole.astype(np.int64)
        for k in range(WEAK):
            packed |= np.bitwise_count(masks[..., k] - np.uint32(1)).astype(np.int64) << (32 + 5 * k)
        for own, x in zip(found, packed, strict=True):
            own.append(x)
    return found


def fingerprints(recordings: DataFrame, rec_id: str, audio: str, rate: int = RATE, queries: Column | None = None) -> DataFrame:
    """id, prints array<bigint>, digest (null without a print), probes (of the rows that pass queries, a condition on the id): one row per
    row of recordings."""
    rows = recordings.select(recordings[rec_id].alias("id"), recordings[audio].alias("audio"))
    rows = rows.select("id", "audio", F.coalesce(queries, F.lit(False)).alias("asked") if queries is not None else F.lit(False).alias("asked"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for s in range(0, batch.num_rows, 32):
                part = batch.slice(s, 32)
                raw = [x[: len(x) // 2 * 2] if x else b"" for x in part.column(1).to_pylist()]
                prints: list[np.ndarray] = [np.empty(0, np.uint32)] * len(raw)
                looked: list[list[np.ndarray] | None] = [None] * len(raw)
                asked = part.column(2).to_pylist()
                for size in {len(x) for x in raw}:
                    own = [i for i, x in enumerate(raw) if len(x) == size]
                    samples = np.frombuffer(b"".join(raw[i] for i in own), "<i2").reshape(len(own), size // 2).astype(np.float32)
                    for i, p in zip(own, fingerprint(chroma(samples, rate)), strict=True):
                        prints[i] = p
                    wanted = [j for j, i in enumerate(own) if asked[i]]
                    for j, p in zip(wanted, probes(samples[wanted], rate) if wanted else [], strict=True):
                        looked[own[j]] = p
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([p.astype(np.int64) for p in prints], pa.list_(pa.int64())), pa.array([xxhash.xxh3_128_digest(p.tobytes()) if len(p) else None for p in prints], pa.binary()), pa.array(looked, pa.list_(pa.list_(pa.int64())))],
                    names=["id", "prints", "digest", "probes"],
                )

    return rows.mapInArrow(run, f"id {kind}, prints array<bigint>, digest binary, probes array<array<bigint>>")


def _in_small_batches(prints: DataFrame) -> DataFrame:
    """table(prints), which reads the audio: a task holds BATCH recordings at once."""
    conf, name = prints.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, BATCH)
    try:
        return table(prints)
    finally:
        conf.set(name, before)


def _packed(k: int, value):  # noqa: ANN001, ANN202
    """Where the bits of the k-th window of a half go: two windows share 32 bits, as HIGH leaves every other one free."""
    return F.call_function("shiftleft", F.call_function("shiftright", value, F.lit(k % 2)), F.lit(32 * (k // 2)))


def surroundings(prints: str, at: Column) -> list[Column]:
    """seen (a bit for each of AROUND that the recording has), before and after (its bits) of a window of a recording."""
    near = [F.get(prints, at + d) for d in AROUND]
    whole = lambda parts: reduce(lambda a, b: a.bitwiseOR(b), parts)
    seen = whole([F.when(x.isNotNull(), 1 << k).otherwise(0) for k, x in enumerate(near)])
    high = [F.coalesce(x, F.lit(0).cast("bigint")).bitwiseAND(F.lit(HIGH)) for x in near]
    return [seen.cast("int").alias("seen"), *(whole([_packed(k, x) for k, x in enumerate(half)]).alias(name) for name, half in (("before", high[:4]), ("after", high[4:])))]


def agree(a: str, b: str) -> Column:
    """Whether the surroundings a.* and b.* differ in no more bits than ALLOWED: for joins of windows; search() needs none, and compares whole overlaps."""
    masks = [sum(HIGH >> k % 2 << 32 * (k // 2) for k in range(4) if s >> k & 1) for s in range(16)]
    mask = F.array(*(F.lit(int(np.uint64(x).astype(np.int64))) for x in masks))
    of = lambda side, name: F.col(f"{side}.{name}")
    seen = of(a, "seen").bitwiseAND(of(b, "seen"))
    wrong = lambda name, s: F.bit_count(of(a, name).bitwiseXOR(of(b, name)).bitwiseAND(F.get(mask, s)))
    return wrong("before", seen.bitwiseAND(F.lit(15))) + wrong("after", F.shiftright(seen, 4)) <= F.get(F.array(*map(F.lit, ALLOWED)), F.bit_count(seen))


def search(prints: DataFrame, queries) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    """Membership (id, class_id, windows) of all rows, and links (query_class, match_class, offset, hits, bit_error).

    queries: a condition on id. A link's offset is where the query's first window falls in the match.
    """
    if "probes" not in prints.columns:
        prints = prints.withColumn("probes", F.lit(None).cast("array<array<bigint>>"))
    prints = _in_small_batches(prints)
    known = prints.where("id is not null and digest is not null")
    # a class is looked for by the probes of one of its queries
    named = known.groupBy("digest").agg(F.min("id").alias("class_id"), F.max(queries).alias("asked"), F.min(F.when(queries, F.col("id"))).alias("looked"))
    members = prints.join(named.select("digest", "class_id"), "digest", "left").select("id", F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"), F.size("prints").cast("bigint").alias("windows"))
    reps = known.drop("probes").join(named, (known["digest"] == named["digest"]) & (known["id"] == named["class_id"])).select("class_id", "asked", "prints").dropDuplicates(["class_id"])
    reps = table(reps)
    # rows that repeat an id may have other prints, so the digest must agree as well
    asked = named.where("asked").select(F.col("digest").alias("d"), "looked", F.col("class_id").alias("q"))
    own = known.where(queries).select("id", "digest", "prints", "probes").join(asked, (F.col("digest") == F.col("d")) & (F.col("id") == F.col("looked"))).dropDuplicates(["q"])
    links = table(confirmed(table(voted(own.select("q", "prints", "probes"), reps)), reps))
    least = links.groupBy("q", "m").agg(F.min(F.struct("bit_error", (-F.col("hits")).alias("less"), F.abs("offset").alias("far"), "offset")).alias("l"))
    return members, least.select(F.col("q").alias("query_class"), F.col("m").alias("match_class"), F.col("l.offset").cast("bigint").alias("offset"), (-F.col("l.less")).alias("hits"), F.col("l.bit_error").alias("bit_error"))


def sides(group: pa.Table) -> tuple[pa.Table, tuple, pa.Table, tuple]:
    """The queries and the recordings of a pair of blocks, each with all its prints, their starts and their numbers."""
    out = []
    for other in ("m", "q"):
        side = group.filter(pc.and_(pc.is_valid(group.column("prints")), pc.is_null(group.column(other))))
        prints = side.column("prints").combine_chunks()
        n = pc.list_value_length(prints).to_numpy(zero_copy_only=False).astype(np.int64)
        out += [side, (prints.flatten().to_numpy().astype(np.uint32), np.cumsum(n) - n, n)]
    return tuple(out)


def bit_errors(qs: tuple, ms: tuple, q: np.ndarray, m: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Share of the bits that differ over the overlap of each query and recording (numbers within sides()) at an offset; infinite below MIN_OVERLAP."""
    (qp, q_start, q_n), (mp, m_start, m_n) = qs, ms
    first = np.maximum(0, -offset)
    overlap = np.minimum(q_n[q], m_n[m] - offset) - first
    keep = np.flatnonzero(overlap >= MIN_OVERLAP)
    a, b, overlap = (q_start[q] + first)[keep], (m_start[m] + first + offset)[keep], overlap[keep]
    error, total, low = np.full(len(q), np.inf), np.cumsum(overlap), 0
    while low < len(keep):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + (1 << 20), "right")))
        n = overlap[low:high]
        wrong = np.bitwise_count(qp[ranges(a[low:high], n)] ^ mp[ranges(b[low:high], n)])
        error[keep[low:high]] = np.add.reduceat(wrong, np.cumsum(n) - n, dtype=np.int64) / (n * 32.0)
        low = high
    return error


def dealt(reps: DataFrame) -> tuple[Callable, Callable]:
    """The block of an id of a side (q or m), and a row for each block of a side: as few as BLOCK allows, for each block is sent to all of the other
    side, but three pairs of blocks for each core."""
    sizes = reps.agg(*[F.coalesce(F.sum(F.when(c, F.size("prints"))), F.lit(0)).alias(n) for c, n in ((F.col("asked"), "q"), (F.lit(True), "m"))]).first()
    blocks = {"q": -(-sizes["q"] // (2 * BLOCK)) or 1}
    blocks["m"] = max(-(-sizes["m"] // (16 * BLOCK)), -(-3 * reps.sparkSession.sparkContext.defaultParallelism // blocks["q"]))
    return lambda x, c: F.pmod(F.xxhash64(c), F.lit(blocks[x])).cast("int"), lambda x: F.explode(F.sequence(F.lit(0), F.lit(blocks[x] - 1)))


def looked_for(queries: pa.Table, q_prints: tuple, there: np.ndarray) -> np.ndarray:
    """The distinct (window << 32 | integer) by which queries are looked for, ascending; windows are numbered through. Only integers whose slot is there."""
    prints, start, n = q_prints
    column = queries.column("probes").combine_chunks()
    plain = column.is_null().to_numpy(zero_copy_only=False)
    found = [np.empty(0, np.int64)]

    def add(at: np.ndarray, integers: np.ndarray) -> None:
        keep = np.flatnonzero(there[slots(integers)])
        found.append(at[keep] << 32 | integers[keep])

    at = ranges(start[plain], n[plain])
    for x in FLIPS if len(at) else ():
        add(at, prints[at].astype(np.int64) ^ x)
    phases = column.flatten()
    length = pc.list_value_length(phases).to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.flatnonzero(~plain), pc.list_value_length(column.drop_null()).to_numpy(zero_copy_only=False))
    at, packed = ranges(start[of], length), phases.flatten().to_numpy()
    for k in range(-1, WEAK):
        add(at, packed & 0xFFFFFFFF ^ (0 if k < 0 else 1 << (packed >> 32 + 5 * k & 31)))
    return np.unique(np.concatenate(found))


def slots(integers: np.ndarray) -> np.ndarray:
    """A slot of 2^22 for each integer."""
    return (integers.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(10)


def voted(queries: DataFrame, reps: DataFrame) -> DataFrame:
    """q, m, offset, hits: where a query (q, prints, probes) meets a recording in MIN_HITS windows at one offset, and an offset near it has a
    bit error that is accepted.

    A pair of blocks is one group, so windows that meet, as many as they are, are rows of no table: a group takes MEETINGS at a time and keeps the counts
    of the query in hand.
    """
    block, every = dealt(reps)
    kind = reps.schema["class_id"].dataType.simpleString()
    qs = queries.select(block("q", "q").alias("qb"), every("m").alias("mb"), "q", F.lit(None).cast(kind).alias("m"), "prints", "probes")
    ms = reps.select(every("q").alias("qb"), block("m", "class_id").alias("mb"), F.lit(None).cast(kind).alias("q"), F.col("class_id").alias("m"), "prints", F.lit(None).cast("array<array<bigint>>").alias("probes"))

    def run(group: pa.Table) -> pa.Table:
        q_side, q_all, m_side, m_all = sides(group)
        (qp, q_start, q_n), (mp, m_start, m_n) = q_all, m_all
        out: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 4]
        there = np.zeros(1 << 22, bool)
        there[slots(mp)] = True
        looked = looked_for(q_side, q_all, there)
        order = np.argsort(mp, kind="stable")
        integers = (looked & 0xFFFFFFFF).astype(np.uint32)
        low = np.searchsorted(mp[order], integers, "left")
        n = np.searchsorted(mp[order], integers, "right") - low
        looked, low, n = looked[n > 0], low[n > 0], n[n > 0]
        at, total = looked >> 32, np.cumsum(n)
        q_of, m_of = np.repeat(np.arange(len(q_n)), q_n), np.repeat(np.arange(len(m_n)), m_n)
        itself = pc.fill_null(pc.index_in(q_side.column("q"), m_side.column("m")), -1).to_numpy().astype(np.int64)
        # (query, recording, offset) as one number; room for two offsets beyond the least and the largest
        least = int(q_n.max(initial=0)) + 2
        span = least + int(m_n.max(initial=0)) + 3

        def judge(keys: np.ndarray, hits: np.ndarray) -> None:
            # what no offset within two meets in MIN_HITS windows is no link at any offset beside it
            enough = keys[hits >= MIN_HITS]
            close = lambda x, of: np.searchsorted(of, x + 2, "right") > np.searchsorted(of, x - 2, "left")
            tried = keys[close(keys, enough)]
            if not len(tried):
                return
            pair, offset = np.divmod(tried, span)
            q, m = np.divmod(pair, len(m_n))
            good = np.zeros(len(tried), bool)
            for d in (-1, 0, 1):
                good |= bit_errors(q_all, m_all, q, m, offset - least + d) <= MAX_ERROR
            votes = np.flatnonzero(hits >= MIN_HITS)[close(enough, tried[good])]
            pair, offset = np.divmod(keys[votes], span)
            out.append((*np.divmod(pair, len(m_n)), offset - least, hits[votes]))

        keys, hits, s = np.empty(0, np.int64), np.empty(0, np.int64), 0
        while s < len(at):
            e = max(s + 1, int(np.searchsorted(total, (total[s - 1] if s else 0) + MEETINGS, "right")))
            to = order[ranges(low[s:e], n[s:e])]
            here = np.repeat(at[s:e], n[s:e])
            q, m = q_of[here], m_of[to]
            key = ((q * len(m_n) + m) * span + least + (to - m_start[m]) - (here - q_start[q]))[m != itself[q]]
            new, count = np.unique(key, return_counts=True)
            keys, of = np.unique(np.concatenate([keys, new]), return_inverse=True)
            hits = np.bincount(of, np.concatenate([hits, count]), len(keys)).astype(np.int64)
            done = np.searchsorted(keys, q_of[at[e]] * len(m_n) * span) if e < len(at) else len(keys)
            judge(keys[:done], hits[:done])
            keys, hits, s = keys[done:], hits[done:], e
        q, m, offset, hits = map(np.concatenate, zip(*out, strict=True))
        return pa.table({"q": q_side.column("q").take(pa.array(q)), "m": m_side.column("m").take(pa.array(m)), "offset": pa.array(offset.astype(np.int32)), "hits": pa.array(hits)})

    return qs.unionByName(ms).groupBy("qb", "mb").applyInArrow(run, f"q {kind}, m {kind}, offset int, hits bigint")


def confirmed(votes: DataFrame, reps: DataFrame) -> DataFrame:
    """q, m, offset, hits, bit_error of the votes (q, m, offset, hits) whose bit error is accepted at their offset or beside it.

    A pair of blocks is one group: it gets both blocks' prints once and the votes between them, so no vote carries prints.
    """
    # most recordings have no vote
    met = votes.select(F.col("q").alias("class_id")).union(votes.select("m")).distinct()
    reps = table(reps.join(met, "class_id", "left_semi"))
    block, every = dealt(reps)
    kind = reps.schema["class_id"].dataType.simpleString()
    none = lambda t: F.lit(None).cast(t)
    parts = votes.select(block("q", "q").alias("qb"), block("m", "m").alias("mb"), "q", "m", "offset", "hits", none("array<bigint>").alias("prints"))
    qs = reps.where("asked").select(block("q", "class_id").alias("qb"), every("m").alias("mb"), F.col("class_id").alias("q"), none(kind).alias("m"), none("int").alias("offset"), none("bigint").alias("hits"), "prints")
    ms = reps.select(every("q").alias("qb"), block("m", "class_id").alias("mb"), none(kind).alias("q"), F.col("class_id").alias("m"), none("int").alias("offset"), none("bigint").alias("hits"), "prints")

    def run(group: pa.Table) -> pa.Table:
        q_side, q_all, m_side, m_all = sides(group)
        vote = group.filter(pc.is_valid(group.column("offset")))
        q, m = (pc.index_in(vote.column(x), side.column(x)).to_numpy().astype(np.int64) for x, side in (("q", q_side), ("m", m_side)))
        offset, hits = (vote.column(c).to_numpy().astype(np.int64) for c in ("offset", "hits"))
        # a start between two hops has its hits at one offset and its least error at the next
        vote_of, offset = np.tile(np.arange(len(q)), 3), np.concatenate([offset - 1, offset, offset + 1])
        order = np.lexsort((-hits[vote_of], offset, m[vote_of], q[vote_of]))
        vote_of, offset = vote_of[order], offset[order]
        a, b = q[vote_of], m[vote_of]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (offset[1:] != offset[:-1])
        vote_of, offset = vote_of[new], offset[new]
        error = bit_errors(q_all, m_all, q[vote_of], m[vote_of], offset)
        good = np.flatnonzero(error <= MAX_ERROR)
        found = vote.select(["q", "m"]).take(pa.array(vote_of[good]))
        return found.append_column("offset", pa.array(offset[good].astype(np.int32))).append_column("hits", pa.array(hits[vote_of[good]])).append_column("bit_error", pa.array(error[good]))

    return parts.unionByName(qs).unionByName(ms).groupBy("qb", "mb").applyInArrow(run, f"q {kind}, m {kind}, offset int, hits bigint, bit_error double")


#: Samples of a note, two frames; the octave that notes are taken from starts at 440 Hz.
NOTE = FRAME


def melodies(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id, audio: each component of a vector sounds as a note, its pitch class the component's place on a circle of 12 steps.

    Turns numeric vectors into recordings for tables that hold no audio of their own. Null or empty vectors give null.
    """
    rows = vectors.select(vectors[vec_id].alias("id"), vectors[vector].cast("array<double>").alias("v"))
    kind = rows.schema["id"].dataType.simpleString()
    t = np.arange(NOTE) / RATE
    tones = np.stack([np.sin(2 * np.pi * 440.0 * 2 ** (c / CLASSES) * t) for c in range(CLASSES)])
    tones = (tones * np.hanning(NOTE) * 12000).astype("<i2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 64):
                part = batch.slice(s, 64)
                audio = []
                for v in part.column(1).to_pylist():
                    x = np.nan_to_num(np.array([0.0 if c is None else c for c in v or []], float))
                    scale = float(np.sqrt(np.mean(x * x))) if len(x) else 0.0
                    notes = np.floor(3 * x / scale).astype(np.int64) % CLASSES if scale else np.zeros(len(x), np.int64)
                    audio.append(tones[notes].tobytes() if len(x) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(audio, pa.binary())], names=["id", "audio"])

    return rows.mapInArrow(run, f"id {kind}, audio binary")

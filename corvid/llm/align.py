"""Cross-tokenizer alignment: where the tokens of two tokenizers end together in the bytes of a text.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (sentencepiece) the text, to which it adds that space itself. The
ends of the tokens are cumulative sums of their bytes; the common ends (intersect1d) cut both sequences into groups, searchsorted labels
each token with its group, and finds for each A token the B tokens that end with it; links are made by repetition of the A tokens. This runs on
a megabyte of texts at a time, since all texts of a chunk end together in both sequences.

The counts of linked id pairs over the corpus are made in two shuffles, by pair and salt, then by pair. They fit the driver and a broadcast
whatever the corpus: of two tokens that end together one is the other's ending, so a vocabulary has at most as many pairs as its
tokens have bytes, each entry of the other that spells an ending counted (proved_bound). Tokenization runs once: its results wait in a table.

A text that is null or empty, or that a tokenizer doesn't give back byte by byte, has no tokens: zeros and an empty digest. Repeated rows are
rows of their own, and count as often. Very long texts are a chunk of their own: memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ship import ship
from .common import ranges, table
from .tokens import Tokenizer, _byte_symbols

#: Bytes of text that are aligned at once, and salts of the first shuffle.
CHUNK, SALTS = 1 << 20, 16


class ByteLevel:
    """A byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.own = Tokenizer(path)
        self.own.library.encode_special_tokens = True
        symbols = _byte_symbols()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"] | {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelled[i] = bytes(symbols[c] for c in token)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self._ids(x), "<u4").astype(np.int64) for x in texts]

    def _ids(self, text: str) -> bytes:
        """Ids of a space and the text: where the cut into pieces is proved, the first piece stands for a space and itself like the others."""
        pieces = self.own._pieces(text)
        return self.own.ids(" " + text) if pieces is None else b"".join(map(self.own.bytes.__getitem__, pieces))


class Pieces:
    """A sentencepiece model, which adds a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = [bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


class Aligner:
    """Two tokenizers with what is looked up by id."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.sizes = tuple(np.array([len(x) for x in t.spelled], np.int64) for t in (a, b))
        self.n_b = len(b.spelled)
        # decimal ids with what follows them: within a side of a group, at its end
        self.words = [f"{i}{s}" for i in range(len(a.spelled)) for s in ",|"] + [f"{i}{s}" for i in range(self.n_b) for s in ",;"]

    def proved_bound(self) -> int:
        """The most id pairs that can end together."""
        spelled = [Counter(t.spelled) for t in (self.a, self.b)]
        return sum(n * other[s[i:]] for mine, other in (spelled, spelled[::-1]) for s, n in mine.items() for i in range(len(s)))

    def chunk(self, texts: list[str]) -> tuple[dict[str, np.ndarray | list], np.ndarray, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links, groups_sha256 of each text, and its linked pairs: bounds in the arrays of pairs and times."""
        n = len(texts)
        raw = [(" " + x).encode() if x else b"" for x in texts]
        full = [i for i, x in enumerate(texts) if x]
        pairs = list(zip(full, self.a.ids([texts[i] for i in full]), self.b.ids([texts[i] for i in full]), strict=True)) if full else []
        whole = [(i, a, b) for i, a, b in pairs if self._spells(self.a, a, raw[i]) and self._spells(self.b, b, raw[i])]
        out: dict[str, np.ndarray | list] = {x: np.zeros(n, np.int64) for x in ("n_a", "n_b", "n_groups", "n_links")}
        out["groups_sha256"] = [""] * n
        if not whole:
            return out, np.zeros(n + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        row = np.array([i for i, _, _ in whole])
        ids = [np.concatenate([x[s] for x in whole]) for s in (1, 2)]
        counts = [np.array([len(x[s]) for x in whole]) for s in (1, 2)]
        ends = [np.cumsum(size[x]) for size, x in zip(self.sizes, ids, strict=True)]
        texts_end = np.cumsum([len(raw[i]) for i in row])
        cuts = np.intersect1d(*ends, assume_unique=all(size[x].min() > 0 for size, x in zip(self.sizes, ids, strict=True)))
        group = [np.searchsorted(cuts, e) for e in ends]
        low, high = np.searchsorted(ends[1], ends[0], "left"), np.searchsorted(ends[1], ends[0], "right")
        linked_a, linked_b = np.repeat(np.arange(len(low)), high - low), ranges(low, high - low)
        of = np.repeat(np.repeat(np.arange(len(row)), counts[0]), high - low)
        width = len(self.a.spelled) * self.n_b
        codes, times = np.unique(of * width + ids[0][linked_a] * self.n_b + ids[1][linked_b], return_counts=True)
        bounds = np.searchsorted(codes // width, np.arange(len(row) + 1))
        out["n_a"][row], out["n_b"][row] = counts
        out["n_groups"][row] = np.diff(np.searchsorted(cuts, texts_end, "right"), prepend=0)
        out["n_links"][row] = np.bincount(of, minlength=len(row))
        for i, digest in zip(row, self._digests(ids, group, counts), strict=True):
            out["groups_sha256"][i] = digest
        sizes = np.zeros(n + 1, np.int64)
        sizes[row + 1] = np.diff(bounds)
        return out, np.cumsum(sizes), codes % width, times

    @staticmethod
    def _spells(tokenizer: ByteLevel | Pieces, ids: np.ndarray, raw: bytes) -> bool:
        return b"".join(map(tokenizer.spelled.__getitem__, ids.tolist())) == raw

    def _digests(self, ids: list[np.ndarray], group: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[str]:
        """Both sequences dealt into one, a group's A tokens before its B tokens, and each text's part of it hashed."""
        dealt = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        last = [np.append(g[1:] != g[:-1], True) for g in group]
        dealt[np.arange(len(ids[0])) + np.searchsorted(group[1], group[0], "left")] = 2 * ids[0] + last[0]
        dealt[np.arange(len(ids[1])) + np.searchsorted(group[0], group[1], "right")] = 2 * (len(self.a.spelled) + ids[1]) + last[1]
        at = 0
        for n in (counts[0] + counts[1]).tolist():
            yield hashlib.sha256("".join(map(self.words.__getitem__, dealt[at : at + n].tolist()))[:-1].encode()).hexdigest()
            at += n


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _LOADED:
        _LOADED[a, b] = Aligner(ByteLevel(a), Pieces(b))
    return _LOADED[a, b]


def named(a: str, b: str) -> Callable[[], Aligner]:
    """A loader for two files of the installed public_tokenizers; it resolves their paths where it runs."""

    def load() -> Aligner:
        import public_tokenizers

        return aligner(public_tokenizers.path(a), public_tokenizers.path(b))

    return load


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def links(documents: DataFrame, load: Callable[[], Aligner], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and pairs (A id times B's number of ids, plus B id) with times, one row a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.cumsum([len(x) if x else 0 for x in texts])
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK, "right")))
                out, bounds, pairs, times = t.chunk(texts[at:stop])
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int64())) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at), *(pa.array(out[c], pa.int64()) for c in _COUNTS), pa.array(out["groups_sha256"], pa.string()), *lists],
                    names=["doc_id", *_COUNTS, "groups_sha256", "pairs", "times"],
                )
                at = stop

    docs = ship_docs(documents, doc_id, text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", groups_sha256 string, pairs array<bigint>, times array<bigint>")


def ship_docs(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    ship(documents.sparkSession)
    return documents.select(documents[doc_id].alias("doc_id"), documents[text].cast("string").alias("text"))


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n: how many links of the corpus hold each id pair. A frequent pair is summed in SALTS places before it meets in one."""
    each = found.select(F.pmod(F.xxhash64("groups_sha256"), F.lit(SALTS)).alias("salt"), F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    salted = each.groupBy(F.col("x.pairs").alias("pair"), "salt").agg(F.sum("x.times").alias("n"))
    return salted.groupBy("pair").agg(F.sum("n").alias("n"))


def align(documents: DataFrame, load: Callable[[], Aligner], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """links() with n_best, the links whose pair is a most frequent one of its B id, and count_sum, the sum of the links' counts."""
    found = table(links(documents, load, doc_id, text))
    counted = pair_counts(found).toArrow()
    pair, n = (counted.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    n_b = load().n_b
    shared = found.sparkSession.sparkContext.broadcast((pair[order], n[order], _best(pair[order], n[order], n_b)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(known, lists.flatten().to_numpy(zero_copy_only=False))
            bounds = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            sums = [np.append(0, np.cumsum(x)) for x in (times * best[at], times * counts[at])]
            columns = [batch.column(c) for c in ("doc_id", *_COUNTS)] + [pa.array(np.diff(s[bounds]), pa.int64()) for s in sums] + [batch.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string")


def _best(pair: np.ndarray, n: np.ndarray, n_b: int) -> np.ndarray:
    """Whether each pair has its B id's highest count."""
    top = np.zeros(n_b, np.int64)
    np.maximum.at(top, pair % n_b, n)
    return n == top[pair % n_b]

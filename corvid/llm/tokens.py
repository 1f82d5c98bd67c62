"""Token counts and ids of a byte-level BPE tokenizer by the whole-token shortcut.

Offline, once per process, the vocabulary is proved: a string that the pre-tokenizer leaves whole and that the merges turn
into one id is *whole*. A text is cut into pieces that the pre-tokenizer can't join (a space or a line end followed by other
characters); a piece seen before is answered from a cache, a whole one is one token, and of the others only those
pre-tokens that aren't whole go through the merges.

Exactness: the cut is used only where it is proved: no white space other than single spaces and line ends between other
characters, and only characters up to U+024F or in a short list. Any other text, and any text with a special string, goes
to the tokenizers library whole. A null text is empty.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Pieces kept by a process in each of two generations; beyond that the older generation is forgotten. Bounds memory only.
CACHE = 250_000
_FOREIGN = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stand for themselves, the others follow
    from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Cache(dict):
    """piece -> value, computed on a miss, in two generations."""

    def __init__(self, compute: Callable[[str], object], size: int = CACHE):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, piece: str):  # noqa: ANN204
        value = self.old.get(piece)
        if value is None:
            value = self.compute(piece)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = value
        return value


class Tokenizer:
    """One byte-level BPE vocabulary (a tokenizers .json file)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Library.from_file(path)
        self.special = [x["content"] for x in spec["added_tokens"]]
        symbols = _byte_symbols()
        skip = set(self.special)
        ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in skip}
        self.pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the file's pre-tokenizer
        self.merges = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        import regex

        self.cut = regex.compile(self.pattern)
        self.whole = self._prove(ranks)
        self.merge = self.merges._core_bpe.encode_single_piece
        self.merged, self.encoded = Cache(self._merged), Cache(self._encode)  # by pre-token
        self.counts, self.bytes = Cache(self._count), Cache(self._bytes)  # by piece
        self.unproved = ["  ", " \n", "\n ", "\n\n", *"\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0", *self.special]

    def _prove(self, ranks: dict[bytes, int]) -> dict[str, int]:
        """String -> id for the vocabulary strings that encode alone as exactly that id."""
        strings, ids = [], []
        for raw, i in ranks.items():
            try:
                strings.append(raw.decode())
                ids.append(i)
            except UnicodeDecodeError:
                continue
        return {s: i for s, i, e in zip(strings, ids, self.merges.encode_ordinary_batch(strings, num_threads=1), strict=True) if e == [i]}

    def _cut(self, piece: str) -> list[str]:
        """The pre-tokens of a piece. Letters with a separator before and marks after are cut without the expression."""
        body = piece.rstrip(_MARKS)
        if body[1:].isalpha() and (body[0] == " " or body[0].isalpha()):
            return [body, piece[len(body) :]] if len(body) < len(piece) else [piece]
        return self.cut.findall(piece)

    def _text(self, piece: str) -> str:
        return piece if piece[0] == "\n" else " " + piece

    def _count(self, piece: str) -> int:
        return sum(map(self.merged.__getitem__, self._cut(self._text(piece)))) // 4

    def _bytes(self, piece: str) -> bytes:
        return b"".join(map(self.encoded.__getitem__, self._cut(self._text(piece))))

    def _encode(self, pretoken: str) -> bytes:
        one = self.whole.get(pretoken)
        return pack("<I", one) if one is not None else array("I", self.merge(pretoken.encode())).tobytes()

    def _merged(self, pretoken: str) -> int:
        """Bytes of the ids of one pre-token: four for a whole one, which needs no merges."""
        return 4 if pretoken in self.whole else 4 * len(self.merge(pretoken.encode()))

    def _pieces(self, text: str) -> list[str] | None:
        """Pieces that are tokenized independently, or None where the cut isn't proved. All but the first stand for a space
        and themselves, unless they start with a line end, which stands for itself."""
        if text[0].isspace() or text[-1].isspace() or any(x in text for x in self.unproved) or (not text.isascii() and _FOREIGN.search(text)):
            return None
        return text.replace("\n", " \n").split(" ")

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self._pieces(text)
        if pieces is None:
            return len(self.library.encode(text, add_special_tokens=False).ids)
        first = pieces.pop(0)
        return sum(map(self._merged, self._cut(first))) // 4 + sum(map(self.counts.__getitem__, pieces))

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pieces = self._pieces(text)
        if pieces is None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first = pieces.pop(0)
        return b"".join(map(self._encode, self._cut(first))) + b"".join(map(self.bytes.__getitem__, pieces))


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def named(name: str) -> Callable[[], Tokenizer]:
    """A loader for a file of the installed public_tokenizers; it resolves the path where it runs."""

    def load() -> Tokenizer:
        import public_tokenizers

        return tokenizer(public_tokenizers.path(name))

    return load


def count_tokens(documents: DataFrame, load: Callable[[], Tokenizer], limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = np.array([t.count(x) for x in texts], np.int64)
            size = np.array([len(x.encode()) if x else 0 for x in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = documents.select(documents[doc_id].alias("doc_id"), documents[text].cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")

"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

The base kinds (email, ip, card, phone) are fixed: leftmost non-overlapping matches per kind; a match that fails its check is
dropped and not tried again. The added kinds (iban, ssn, secret) go through proposal, validator and a score: the validator sets a
base score, words of the context within WINDOW characters raise it, words that speak against it lower it, and a span
counts from THRESHOLD. Base spans always stay.

A null or empty text has no spans. Whole texts are scanned; every expression is linear on digits-and-letters runs.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW, THRESHOLD = 40, 0.5
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an IBAN without spaces."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in text.split(".")))


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _card(text: str) -> bool:
    d = _digits(text)
    return 14 <= len(d) <= 19 and luhn(d)


def _phone(text: str) -> bool:
    return 10 <= len(_digits(text)) <= 15


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost non-overlapping matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, from each @ outwards: linear
    on long runs without @, where a search from every start would be quadratic."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            floor = m.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


#: The base patterns. ip looks behind so that a long run of digits is tried once; the matches are the same.
BASE: tuple[tuple[str, re.Pattern, Callable[[str], bool], str], ...] = (
    ("ip", re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), _ip, "."),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), _card, ""),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), _phone, "+"),
)


@dataclass(frozen=True)
class Added:
    kind: str
    pattern: re.Pattern
    valid: Callable[[str], bool]
    base: float
    helps: re.Pattern
    hurts: re.Pattern
    group: int = 0


_NONE = re.compile(r"(?!)")


def _ssn(s: str) -> bool:
    a, b, c = s.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


def _varied(s: str) -> bool:
    """A random-looking key: letters and digits, not one character over and over."""
    return len(set(s)) >= 8 and any(c.isdigit() for c in s) and any(c.isalpha() for c in s)


def _iban(s: str) -> bool:
    compact = s.replace(" ", "")
    return 15 <= len(compact) <= 34 and mod97(compact)


ADDED: tuple[Added, ...] = (
    Added("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), _iban, 0.9, re.compile(r"(?i)\b(?:iban|bank|account|konto|cuenta|compte)\b"), _NONE),
    Added("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _ssn, 0.4, re.compile(r"(?i)\b(?:ssn|social security|tax id)\b"), re.compile(r"(?i)\b(?:isbn|order|invoice|part|serial)\b")),
    Added("secret", re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{32,}={0,2})(?![A-Za-z0-9+/_=-])"), _varied, 0.2, re.compile(r"(?i)(?:token|secret|password|passwd|api[_-]?key|bearer|auth)"), re.compile(r"(?i)\b(?:sha\d*|md5|checksum|commit|digest)\b"), 1),
)
ORDER = ("email", *(x[0] for x in BASE)) + tuple(x.kind for x in ADDED)
_RANK = {k: i for i, k in enumerate(ORDER)}

Span = tuple[int, int, int, float]


def base_spans(text: str) -> list[Span]:
    """(start, rank of kind, end, score), sorted."""
    out = [(s, 0, e, 1.0) for s, e in _emails(text)]
    for kind, pattern, valid, needs in BASE:
        if needs and needs not in text:
            continue
        rank = _RANK[kind]
        out += [(m.start(), rank, m.end(), 1.0) for m in pattern.finditer(text) if valid(m.group())]
    out.sort()
    return out


def added_spans(text: str, taken: list[Span]) -> list[Span]:
    """Spans of the added kinds that reach THRESHOLD and overlap no base span."""
    out = []
    starts, reach = [s for s, *_ in taken], list(accumulate((e for _, _, e, _ in taken), max))
    for x in ADDED:
        for m in x.pattern.finditer(text):
            start, end = m.span(x.group)
            if not x.valid(m.group(x.group)):
                continue
            near = text[max(0, start - WINDOW) : start] + " \n " + text[end : end + WINDOW]
            score = x.base + 0.4 * bool(x.helps.search(near)) - 0.4 * bool(x.hurts.search(near))
            before = bisect_left(starts, end)
            if score >= THRESHOLD and not (before and reach[before - 1] > start):
                out.append((start, _RANK[x.kind], end, min(1.0, score)))
    return out


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{ORDER[k]}:{s}:{e}" for s, k, e, _ in spans)


def redact(text: str | None) -> str | None:
    """Each span replaced by its kind in angle brackets; overlapping spans merge under the first one's kind."""
    if not text:
        return text
    spans = find(text)[1]
    if not spans:
        return text
    out, at = [], 0
    for s, k, e, _ in spans:
        if s >= at:
            out += [text[at:s], f"<{ORDER[k]}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def detect(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, spans array<struct<kind,start,end,score,base>> in code points, end exclusive."""
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                base, every = find(t)
                marked = set(base)
                rows.append([{"kind": ORDER[k], "start": s, "end": e, "score": v, "base": (s, k, e, v) in marked} for s, k, e, v in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, spans_type)], names=["doc_id", "spans"])

    docs = documents.select(documents[doc_id].alias("doc_id"), documents[text].cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>")


def redacted(documents: DataFrame, text: str = "text") -> DataFrame:
    """documents with the spans of `text` masked; all columns stay in order."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def mask(column):  # noqa: ANN001, ANN202
        return column.map(redact, na_action="ignore")

    return documents.withColumn(text, mask(F.col(f"`{text}`")))

"""Date scalars. A date is a string: YYYY-MM-DD, or UNPARSED: and the raw value. Offsets are dropped, not converted."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, collapse, first_nonempty

UNPARSED = "UNPARSED:"
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
LONG_DATE = rf"(?:{_MONTHS})\s+[0-9]{{1,2}},\s+20[0-9]{{2}}"
TIMED_DATE = rf"[0-9]{{1,2}}:[0-9]{{2}}\s*[ap]\.m\.,\s*({LONG_DATE})"
#: What partial dates take missing parts from, so that results don't depend on the day they are made.
DEFAULT = datetime(2000, 1, 1)


def long_date(x: Column | str, prefer_timed: bool = True) -> Column:
    """The first long date that follows a clock time; else the first long date; else empty."""
    bare = F.regexp_extract(_c(x), f"({LONG_DATE})", 1)
    return first_nonempty(F.regexp_extract(_c(x), TIMED_DATE, 1), bare) if prefer_timed else first_nonempty(bare)


def timed_date_ready(x: Column | str) -> Column:
    return _c(x).rlike("(?i)" + TIMED_DATE)


def iso_year(x: Column | str) -> Column:
    """The first four characters as a year if all are digits; shorter values of digits count."""
    head = F.left(_c(x), F.lit(4))
    return F.when(head.rlike("^[0-9]+$"), head.try_cast("int"))


def normalize_listed(x: Column | str) -> Column:
    """normalize_date for ISO dates and times, YYYYMMDD and long English dates, inside the JVM; others are UNPARSED."""
    raw = F.coalesce(_c(x), F.lit(""))
    flat = collapse(raw)
    iso = F.when(flat.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"), F.left(flat, F.lit(10)).try_cast("date"))
    packed = F.when(flat.rlike("^[0-9]{8}$"), F.try_to_date(flat, "yyyyMMdd"))
    named = F.when(flat.rlike(rf"^({_MONTHS}) [0-9]{{1,2}}, [0-9]{{4}}$"), F.try_to_date(flat, "MMMM d, yyyy"))
    return F.coalesce(F.date_format(F.coalesce(iso, packed, named), "yyyy-MM-dd"), F.concat(F.lit(UNPARSED), raw))


def parse_any(raw: str | None, default: datetime = DEFAULT) -> str:
    from dateutil import parser

    raw = raw or ""
    if raw.strip():
        try:
            return parser.parse(raw, default=default).date().isoformat()
        except (ValueError, OverflowError, TypeError):
            pass
    return UNPARSED + raw


def normalize_date(x: Column | str, default: datetime = DEFAULT) -> Column:
    """Any date the general parser understands. Common forms are read in the JVM; the parser gets the rest, nulls for what is done."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: parse_any(v, default), na_action="ignore")

    listed = normalize_listed(x)
    left = listed.startswith(UNPARSED)
    return F.coalesce(run(F.when(left, F.coalesce(_c(x), F.lit("")))), listed)


def date_of(*candidates: Column | str) -> Column:
    """The first non-empty candidate."""
    return first_nonempty(*candidates)

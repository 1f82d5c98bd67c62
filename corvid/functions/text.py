"""Text scalars. A missing value is the empty string, never null; whitespace is Python's Unicode whitespace."""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Java class equal to Python's \s.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_HIDDEN = ("script", "style", "template")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_nonempty(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty; else empty."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in columns], F.lit(""))


def collapse(x: Column | str) -> Column:
    """Runs of white space to one space, ends trimmed; null to empty."""
    return F.coalesce(F.trim(F.regexp_replace(_c(x), SPACE + "+", " ")), F.lit(""))


def strip_tags(x: Column | str) -> Column:
    """Tags to spaces, for well-formed markup."""
    return F.regexp_replace(_c(x), "<[^>]*>", " ")


def clean_plain(x: Column | str) -> Column:
    """clean_text for text without markup or entities, in the compatibility-composed form already."""
    return collapse(x)


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in _HIDDEN

    def handle_endtag(self, tag: str) -> None:
        if tag in _HIDDEN and self.hidden:
            self.hidden -= 1

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)


def clean(raw: str | None) -> str:
    """Markup parsed away with a space between text nodes, entities decoded, NFKC, white space collapsed."""
    if not raw:
        return ""
    if "<" in raw or "&" in raw:
        parser = _Text()
        parser.feed(raw)
        parser.close()
        raw = " ".join(parser.parts)
    return " ".join(unicodedata.normalize("NFKC", raw).split())


@F.pandas_udf(StringType())
def _clean_udf(x: pd.Series) -> pd.Series:
    return x.map(clean, na_action="ignore")


@F.pandas_udf(StringType())
def _nfkc_udf(x: pd.Series) -> pd.Series:
    return x.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


#: What needs the parser or normalization: a tag, what may be an entity, a character that isn't known to be its own compatibility form.
_NOT_PLAIN = r"[^\x00-;=-\x7f\u00c0-\u00ff\u2013\u2014\u2018-\u201d]|&[A-Za-z#]"


def clean_text(x: Column | str) -> Column:
    """clean(): plain texts inside the JVM; the parser gets the others, nulls for what is done."""
    rest = F.coalesce(_c(x).rlike(_NOT_PLAIN), F.lit(False))
    return F.when(rest, _clean_udf(F.when(rest, _c(x)))).otherwise(clean_plain(x))


def nfkc(x: Column | str) -> Column:
    return _nfkc_udf(_c(x))


def split_kicker(x: Column | str) -> Column:
    """struct<section, subsection>: the first two non-empty parts between bars, each cleaned."""
    parts = F.filter(F.transform(F.split(_c(x), r"\|"), collapse), lambda p: p != "")
    return F.struct(F.coalesce(F.get(parts, 0), F.lit("")).alias("section"), F.coalesce(F.get(parts, 1), F.lit("")).alias("subsection"))


def strip_by(x: Column | str) -> Column:
    return F.regexp_replace(_c(x), r"(?i)^by" + SPACE + "+", "")


def title_or_aria(text: Column | str, aria: Column | str) -> Column:
    """Anchor text; where empty, its aria-label without a leading "read "."""
    return first_nonempty(text, F.regexp_replace(_c(aria), r"(?i)^read" + SPACE + "+", ""))


def drop_role(x: Column | str) -> Column:
    """What stands before the first comma."""
    return F.trim(F.substring_index(_c(x), ",", 1))


def slug_label(x: Column | str) -> Column:
    """Hyphens to spaces, then a capital at the start of each run of letters and small letters after, as str.title() does."""
    words = F.regexp_extract_all(F.lower(F.replace(_c(x), F.lit("-"), F.lit(" "))), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")


def distinct_names(names: Column | str, by: bool = True) -> Column:
    """Names (array; without a leading "By" if `by`), empties dropped, the first of each spelling regardless of case, in order."""
    plain = F.filter(F.transform(_c(names), strip_by) if by else _c(names), lambda n: n != "")
    kept = F.aggregate(plain, F.array().cast("array<string>"), lambda acc, n: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(n)), acc).otherwise(F.concat(acc, F.array(n))))
    return kept


def join_authors(names: Column | str) -> Column:
    return F.array_join(distinct_names(names), ", ")


#: Words that mark a byline anchor as a role.
ROLE_WORDS = (
    "editor", "chief", "reporter", "manager", "contributor", "columnist", "writer", "photographer", "director", "producer", "designer",
    "staff", "senior", "deputy", "associate", "head", "correspondent", "illustrator", "cartoonist", "developer", "analyst", "intern",
    "fellow", "maroon", "crossword", "podcast", "host",
)
ROLE_PATTERN = r"(?i)\b(" + "|".join(ROLE_WORDS) + r")\b"


def is_person(name: Column | str) -> Column:
    """Neither a role word, nor a bracket, nor a digit (of any script)."""
    n = _c(name)
    return (n != "") & ~n.rlike(ROLE_PATTERN) & ~n.contains("(") & ~n.rlike(r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]")


def byline_people(names: Column | str, raw: Column | str) -> Column:
    """People among the anchors; without any, the raw byline's part before the first comma."""
    people = F.filter(_c(names), is_person)
    return first_nonempty(F.array_join(distinct_names(people, by=False), ", "), drop_role(strip_by(raw)))


def byline_in_text(x: Column | str) -> Column:
    """"By Firstname Lastname" of two to four capitalised words anywhere in a text."""
    return F.regexp_extract(_c(x), r"\bBy\s+([A-Z][a-z]+(?:\s+[A-Z][a-z.\x27-]+){1,3})", 1)


#: Marks of an interstitial page.
CHECKPOINTS = ("Vercel Security Checkpoint", "Enable JavaScript to continue", "We're verifying your browser")


def is_checkpoint(html: Column | str) -> Column:
    out = F.lit(False)
    for mark in CHECKPOINTS:
        out = out | _c(html).contains(mark)
    return out


#: Parts of slugs that place an article rather than classify it.
PLACEMENTS = ("topstory", "newsletter", "featured", "secondary", "carousel")


def real_sections(slugs: Column | str) -> Column:
    return F.filter(_c(slugs), lambda s: ~F.lower(s).rlike("|".join(PLACEMENTS)))


def short_label(x: Column | str, most: int) -> Column:
    """The label, or empty where it is longer than `most` characters."""
    return F.when(F.char_length(_c(x)) <= most, _c(x)).otherwise("")

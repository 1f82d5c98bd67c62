"""URL scalars."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, slug_label


def dated_article(url: Column | str, host: str) -> Column:
    """https://host/YYYY/MM/DD/section/slug, no www."""
    return _c(url).rlike(rf"^https://{re.escape(host)}/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/[^/]+/[^/]+/?$")


def numbered_article(url: Column | str, host: str) -> Column:
    """http(s)://[www.]host/<digits>/section/slug."""
    return _c(url).rlike(rf"^https?://(?:www\.)?{re.escape(host)}/[0-9]+/[^/]+/[^/]+/?$")


def slug_article(url: Column | str) -> Column:
    """Ends in /articles/<slug>; a query string defeats it."""
    return _c(url).rlike(r"(?i)/articles/[a-z0-9][a-z0-9-]+/?$")


def is_game(url: Column | str) -> Column:
    return _c(url).contains("/games/")


def date_in_path(url: Column | str) -> Column:
    """YYYY-MM-DD of the first /YYYY/MM/DD/, not validated; else empty."""
    found = F.regexp_extract(_c(url), r"/([0-9]{4}/[0-9]{2}/[0-9]{2})/", 1)
    return F.replace(found, F.lit("/"), F.lit("-"))


def year_in_path(url: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(url), r"/([0-9]{4})/", 1), F.lit("")).try_cast("int")


def year_in_slug(url: Column | str) -> Column:
    """Year of a closing -YYYYMMDD, a closing slash allowed."""
    digits = F.regexp_extract(F.regexp_replace(_c(url), "/+$", ""), r"-([0-9]{8})$", 1)
    return F.nullif(F.left(digits, F.lit(4)), F.lit("")).try_cast("int")


def date_suffix(url: Column | str) -> Column:
    """YYYYMMDD of a closing -YYYYMMDD, no slash allowed; else empty."""
    return F.regexp_extract(_c(url), r"-([0-9]{8})$", 1)


def path_of(url: Column | str) -> Column:
    return F.regexp_extract(_c(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def segments(url: Column | str) -> Column:
    return F.filter(F.split(path_of(url), "/"), lambda s: s != "")


def section_in_path(url: Column | str) -> Column:
    """Label of the second path segment; empty with fewer."""
    return F.coalesce(slug_label(F.get(segments(url), 1)), F.lit(""))


def origin(url: Column | str) -> Column:
    return F.regexp_extract(_c(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def without_dots(path: Column) -> Column:
    """A path without its . and .. segments; one that ends in such a segment ends in a slash."""
    parts = F.split(path, "/")
    step = lambda kept, x: F.when(x == ".", kept).when(x == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))).otherwise(F.concat(kept, F.array(x)))
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 1, 1), step)
    joined = F.array_join(F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def resolved(base: Column | str, href: Column | str) -> Column:
    """href against base for absolute, scheme-relative, root-relative, fragment, query and relative forms; dot segments of the latter go."""
    b, h = _c(base), _c(href)
    page = F.regexp_extract(b, r"^([^?#]*)", 1)
    path, rest = F.regexp_extract(h, r"^([^?#]*)", 1), F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    folder = F.when(path_of(b) == "", F.lit("/")).otherwise(F.regexp_extract(path_of(b), r"^(.*/)", 1))
    return (
        F.when(h == "", b).when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), h))
        .when(h.startswith("/"), F.concat(origin(b), without_dots(path), rest))
        .when(h.startswith("#"), F.concat(F.regexp_extract(b, r"^([^#]*)", 1), h)).when(h.startswith("?"), F.concat(page, h))
        .otherwise(F.concat(origin(b), without_dots(F.concat(folder, path)), rest))
    )


def listing_page(base: Column | str, page: Column | str) -> Column:
    return F.when(_c(page) <= 1, _c(base)).otherwise(F.concat(_c(base), F.lit("?page="), _c(page).cast("string")))

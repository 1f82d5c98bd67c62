"""Golden cases of the text, URL and date scalars."""

from __future__ import annotations

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from corvid.functions import dates, text, urls
from corvid.plans import catalog


@pytest.fixture(scope="module")
def value(spark):  # noqa: ANN001, ANN201
    def of(column, x="x", schema="x string"):  # noqa: ANN001, ANN202
        return spark.createDataFrame([(x,)], schema).select(column.alias("v")).first()["v"]

    return of


@pytest.mark.parametrize(
    ("raw", "want"),
    [("News | University", ("News", "University")), ("News", ("News", "")), (" | ", ("", "")), ("A|B|C", ("A", "B")), ("", ("", ""))],
)
def test_kicker(value, raw, want) -> None:  # noqa: ANN001
    assert tuple(value(text.split_kicker("x"), raw)) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, ""), ("", ""), ("a  b\x1c\n", "a b"), ("<p>x<b>y</b></p><script>z</script>", "x y"), ("&amp;lt;b&amp;gt;", "&lt;b&gt;"),
        ("ﬁne ①", "fine 1"), ("<!-- c -->t<style>s</style>", "t"),
    ],
)
def test_clean(value, raw, want) -> None:  # noqa: ANN001
    assert text.clean(raw) == want
    assert value(text.clean_text("x"), raw) == want


def test_collapse_is_pythons(value) -> None:  # noqa: ANN001
    raw = "".join(f"a{c}" for c in map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x3000, 0x200B]))
    assert value(text.collapse("x"), raw) == " ".join(raw.split())


@pytest.mark.parametrize(("raw", "want"), [("O'NEIL a&e x2y", "O'Neil A&E X2Y"), ("arts-life", "Arts Life"), ("", ""), ("école-été", "École Été")])
def test_slug_label(value, raw, want) -> None:  # noqa: ANN001
    assert value(text.slug_label("x"), raw) == want == raw.replace("-", " ").title()


def test_names(value) -> None:  # noqa: ANN001
    names = F.array(*map(F.lit, ("By Ann Lee", "ann lee", "Bo Ray", "")))
    assert value(text.join_authors(names)) == "Ann Lee, Bo Ray"
    roles = F.array(*map(F.lit, ("Ann Lee", "Editor-in-Chief (’18)", "Senior Reporter", "Bo 2", "Bo ²")))
    assert value(text.byline_people(roles, F.lit("By X, Staff"))) == "Ann Lee"
    assert value(text.byline_people(F.array(F.lit("Staff Writer")), F.lit("By Xu Li , Staff"))) == "Xu Li"
    assert value(text.drop_role("x"), "Maia Pandey , Editor") == "Maia Pandey"
    assert value(text.strip_by("x"), "BY  Ann") == "Ann" and value(text.strip_by("x"), "Byron") == "Byron"
    assert value(text.title_or_aria(F.lit(""), "x"), "Read The News") == "The News"
    assert value(text.byline_in_text("x"), "x By Ann Lee-O'Neil and") == "Ann Lee-"


def test_byline_behind_a_prefix(spark, tmp_path) -> None:  # noqa: ANN001
    """The query reads the whole text of a document."""
    rows = [(1, "word " * 200 + "By Eva Maria Stone for us"), (2, "word " * 200), (3, "a By Xu Li at once")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["author"] for r in catalog.byline_in_text(spark, str(tmp_path)).collect()}
    assert found == {1: "Eva Maria Stone", 2: "Ann Lee Bo", 3: "Xu Li"}


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Monday, June 15, 2026 x 9:48 a.m., June 9, 2026", "June 9, 2026"), ("Monday, June 15, 2026", "June 15, 2026"), ("June 9, 1999", ""), ("june 9, 2026", ""), ("", ""),
    ],
)
def test_long_date(value, raw, want) -> None:  # noqa: ANN001
    assert value(dates.long_date("x"), raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("August 4, 2016", "2016-08-04"), ("20160804", "2016-08-04"), ("2024-01-01T23:30:00-06:00", "2024-01-01"), ("", "UNPARSED:"), ("junk", "UNPARSED:junk"),
        ("2016-02-31", "UNPARSED:2016-02-31"),
    ],
)
def test_normalize(value, raw, want) -> None:  # noqa: ANN001
    assert value(dates.normalize_listed("x"), raw) == want
    assert value(dates.normalize_date("x"), raw) == want


def test_general_dates(value) -> None:  # noqa: ANN001
    assert value(dates.normalize_date("x"), "12/06/2026") == "2026-12-06"
    assert value(dates.normalize_date("x"), "2016") == "2016-01-01"
    assert value(dates.normalize_date("x"), "June 1, 2020 June 2, 2021").startswith("UNPARSED:")
    assert value(dates.normalize_date("x"), None) == "UNPARSED:"


@pytest.mark.parametrize(("raw", "want"), [("2018-01-02", 2018), ("", None), ("20", 20), ("x018", None)])
def test_iso_year(value, raw, want) -> None:  # noqa: ANN001
    assert value(dates.iso_year("x"), raw) == want


def test_urls(value) -> None:  # noqa: ANN001
    assert value(urls.date_in_path("x"), "https://h/2016/08/04/campus/x/") == "2016-08-04"
    assert value(urls.year_in_slug("x"), "https://h/a-b-20160804/") == 2016 and value(urls.year_in_slug("x"), "https://h/a-b") is None
    assert value(urls.date_suffix("x"), "https://h/a-20160804/") == "" and value(urls.date_suffix("x"), "https://h/a-20160804") == "20160804"
    assert value(urls.section_in_path("x"), "https://h/12/arts-life/x") == "Arts Life" and value(urls.section_in_path("x"), "https://h/12") == ""
    assert value(urls.slug_article("x"), "/a/Articles/ab-c/") and not value(urls.slug_article("x"), "/articles/ab?x")
    assert value(urls.dated_article("x", "h.com"), "https://h.com/2016/08/04/a/b/") and not value(urls.dated_article("x", "h.com"), "http://h.com/2016/08/04/a/b/")
    assert value(urls.numbered_article("x", "h.com"), "http://www.h.com/12/a/b")
    assert [value(urls.listing_page(F.lit("b"), F.lit(p))) for p in (0, 1, 2)] == ["b", "b", "b?page=2"]


def test_first_nonempty(value) -> None:  # noqa: ANN001
    assert value(text.first_nonempty("x", F.lit(None).cast("string"), F.lit("b")), "") == "b"
    assert value(text.first_nonempty("x"), None) == ""


def test_plain_texts_need_no_python(spark) -> None:  # noqa: ANN001
    """clean_text equals clean() for every character alone and between letters, and sends only what needs it to Python."""
    some = [chr(c) for c in range(1, 0x2100)] + ["a & b", "a&amp;b", "&&&", "x &lt y", "&#65;", "A\u030a", "ﬁ", "<b>x</b>", "x < y", "  ", "", "“q” – ‘r’ — é"]
    rows = [(x,) for y in some for x in (y, f"a{y}b {y} c")]
    got = spark.createDataFrame(rows, "x string").select("x", text.clean_text("x").alias("c")).collect()
    assert [r["x"] for r in got if r["c"] != text.clean(r["x"])] == []
    assert spark.createDataFrame([(None,)], "x string").select(text.clean_text("x").alias("c")).first()["c"] == ""
    plain = spark.createDataFrame([("a & b",), ("é “q”",), ("x<y",), ("a&b",)], "x string")
    assert [r[0] for r in plain.where(~F.col("x").rlike(text._NOT_PLAIN)).collect()] == ["a & b", "é “q”"]


def test_resolved_equals_urljoin(spark) -> None:  # noqa: ANN001
    """All forms, dot segments included, against the standard library."""
    bases = ("https://h.org/a/b?q#f", "https://h.org", "https://h.org/", "https://h.org/a/b/c/", "https://h.org/a/../b/c")
    refs = ("/x", "#t", "?z=1", "y", "//k.org/z", "https://m.org/", "https://m.org/a/../b", "", "../d", "../../../d", "./e", "a/./b/../c", ".", "..", "./", "../", "/x/../y", "/..", "/./", "a/..", "a/.?x=../y#../z", "..b/c..", "x/...", "/a.b/.c")
    got = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string").select("b", "r", urls.resolved("b", "r").alias("u")).collect()
    assert [(x["b"], x["r"], x["u"], urljoin(x["b"], x["r"])) for x in got if x["u"] != urljoin(x["b"], x["r"])] == []

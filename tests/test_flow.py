"""Sampling, merging, sources, incremental runs and streaming."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from corvid.operators import discovery, merge, sampling
from corvid.plans import quality
from corvid.plans.run import load_config, main, run, site_config
from corvid.plans.sites import SITES
from corvid.schema import ARTICLE_COLS
from corvid.sources import files, web, xml
from corvid.sources.changelog import ChangeLog
from corvid.streaming.incremental import merge_stream


def model_spread(items: list, n: int) -> list:
    if n <= 0 or not items:
        return []
    if len(items) <= n:
        return items
    if n == 1:
        return [items[len(items) // 2]]
    step = (len(items) - 1) / (n - 1)
    return [items[round(i * step)] for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 8, 12])
def test_even_spread(spark, n) -> None:  # noqa: ANN001
    rows = [(size, k) for size in range(1, 60) for k in range(size)]
    got: dict = {}
    for r in sampling.even_spread(spark.createDataFrame(rows, "g int, k int"), ["g"], ["k"], n).collect():
        got.setdefault(r["g"], []).append(r["k"])
    assert {g: sorted(v) for g, v in got.items()} == {s: v for s in range(1, 60) if (v := model_spread(list(range(s)), n))}


@pytest.mark.parametrize("seed", range(3))
def test_until_quota(spark, seed) -> None:  # noqa: ANN001
    r = random.Random(seed)
    rows = [(i, r.randrange(5), r.random() < 0.6) for i in range(80)]
    done, cap, quota = {0: 2, 1: 5}, 9, 3
    have, want = dict(done), []
    for i, year, ok in rows:
        if len(want) >= cap:
            break
        if have.get(year, 0) < quota and ok:
            have[year] = have.get(year, 0) + 1
            want.append(i)
    df = spark.createDataFrame(rows, "pos int, year int, ok boolean").where("ok")
    got = sampling.until_quota(df, ["year"], ["pos"], quota, cap, spark.createDataFrame(list(done.items()), "year int, count int"))
    assert sorted(x["pos"] for x in got.collect()) == want


@pytest.mark.parametrize("most", [1 << 27, 64])
def test_unknown(spark, monkeypatch, most) -> None:  # noqa: ANN001
    """Exact with and without the filter, nulls and repeated rows included; with it few rows of the large side are left for the join."""
    monkeypatch.setattr(merge, "BLOOM_MOST", most)
    df = spark.range(4000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.col("id").alias("row"), F.lit(1).alias("one")).unionByName(spark.createDataFrame([(None, 7, 1), ("u5", 8, 1), ("new", 9, 1)], "url string, row bigint, one int"))
    held = spark.range(0, 8000, 2).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url")).unionByName(spark.createDataFrame([(None,), ("u2",)], "url string"))
    got = merge.unknown(df, held)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(f"u{i}", i, 1) for i in range(1, 4000, 2)] + [(None, 7, 1), ("u5", 8, 1), ("new", 9, 1)], key=str)
    assert merge.unknown(df, held.limit(0)).count() == df.count() and merge.unknown(df.limit(0), held).count() == 0
    made = merge.bloom(held, "url")
    assert (made is None) == (most == 64)
    if made:
        maybe = df.select("url", F.lit(1).alias("k")).join(F.broadcast(made[0].withColumn("k", F.lit(1))), "k").where(merge.might_hold(F.col("words"), made[1], F.col("url")))
        assert 2000 <= maybe.where("url is not null").count() < 2100


def test_ranks_and_quotas_of_a_large_group(spark) -> None:  # noqa: ANN001
    """Most rows in one group: it is many tasks for ranks, and few rows of a task for quotas; names that clash."""
    df = spark.range(20_000, numPartitions=8).select(F.when(F.col("id") % 10 < 9, 2020).otherwise(F.lit(None)).cast("int").alias("g"), F.hash("id").alias("k"), F.col("id").alias("n"), F.lit("x").alias("row"))
    rows = sampling.ranked(df, ["g"], ["k", "n"])
    got = rows.select("row.g", "row.k", "row.n", F.col("k").alias("rank"), F.col("n").alias("size")).collect()
    for g in (2020, None):
        mine = sorted((r["k"], r["n"], r["rank"], r["size"]) for r in got if r["g"] == g)
        assert [x[2] for x in mine] == list(range(len(mine))) and {x[3] for x in mine} == {len(mine)}
    limited = sampling.until_quota(df, ["g"], ["k"], 3)
    assert "WindowGroupLimit" in limited._jdf.queryExecution().executedPlan().toString() and limited.columns == df.columns
    assert limited.where("g is not null").count() == 3 and limited.where("g is null").count() == 2000
    assert sampling.even_spread(df, ["g"], ["k"], 4).groupBy("g").count().orderBy("g").collect() == [(None, 4), (2020, 4)]


@pytest.mark.parametrize(("mode", "want"), [("literal", [("A", "x"), ("C", "c")]), ("intent", [("A", "x"), ("B", "fresh"), ("C", "c")])])
def test_merge_modes(spark, mode, want) -> None:  # noqa: ANN001
    schema = "url string, text string, pos int"
    old = spark.createDataFrame([("A", "x", 0), ("B", "", 1)], schema)
    new = spark.createDataFrame([("B", "fresh", 0), ("C", "c", 1), ("C", "later", 2)], schema)
    got = merge.merged(old, new, mode).orderBy("src_rank", "pos").collect()
    assert [(r["url"], r["text"]) for r in got] == want


def test_year_pages(spark) -> None:  # noqa: ANN001
    r = random.Random(4)
    for _ in range(4):
        years, page = [], 2026
        for p in range(1, 40):
            page -= r.choice([0, 0, 1, 2])
            years += [(p, page), (p, page + r.choice([0, 1]))]
        listing = spark.createDataFrame(years, "page int, year int")
        lows = {p: min(y for q, y in years if q == p) for p, _ in years}
        got: dict = {}
        for x in discovery.year_pages(listing, spark.createDataFrame([(y,) for y in range(2005, 2027)], "year int"), 2026, 2, 2, 39).collect():
            got.setdefault(x["year"], set()).add(x["page"])
        for y in range(2005, 2027):
            c = max(1, (2026 - y) * 2 + 1)
            around = set(range(max(1, c - 2), c + 3))
            if not any(p in around and v == y for p, v in years):
                c = min((p for p, v in lows.items() if v <= y), default=c)
                around = set(range(max(1, c - 2), max(1, min(39, c + 2)) + 1))
            assert got[y] == around


def test_search_stops_at_a_missing_page(spark) -> None:  # noqa: ANN001
    r = random.Random(9)
    for _ in range(3):
        lows, year = {}, 2026
        for p in range(1, 33):
            year -= r.choice([0, 1, 2])
            if r.random() < 0.85:
                lows[p] = year
        listing = spark.createDataFrame(list(lows.items()), "page int, year int")
        got: dict = {}
        for x in discovery.year_pages(listing, spark.createDataFrame([(y,) for y in range(1990, 2027)], "year int"), 2026, 1, 1, 32).collect():
            got.setdefault(x["year"], set()).add(x["page"])
        for y in range(1990, 2027):
            c = max(1, 2027 - y)
            want = set(range(max(1, c - 1), c + 2))
            if not any(lows.get(p) == y for p in want):
                lo, hi, at = 1, 32, c
                while lo <= hi:
                    mid = (lo + hi) // 2
                    if mid not in lows:
                        break
                    lo, hi, at = (mid + 1, hi, at) if lows[mid] > y else (lo, mid - 1, mid)
                want = set(range(max(1, at - 1), min(32, at + 1) + 1))
            assert got.get(y, set()) == want


def test_rows_without_a_year_have_no_quota(spark) -> None:  # noqa: ANN001
    rows = spark.createDataFrame([(0, None), (1, 2020), (2, 2020), (3, None), (4, None)], "pos int, year int")
    assert sorted(r["pos"] for r in sampling.until_quota(rows, ["year"], ["pos"], 1).collect()) == [0, 1, 3, 4]


def test_main_from_sitemaps_to_csv(spark, tmp_path) -> None:  # noqa: ANN001
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    url = lambda y, i: f"https://n.example.com/{y}/05/0{i}/a/s{i}/"
    entries = "".join(f"<url><loc>{url(y, i)}</loc></url>" for y in (2019, 2020) for i in range(1, 5))
    spark.createDataFrame([(1, f"<urlset>{entries}</urlset>")], "file int, xml string").write.parquet(f"{folder}/n_sitemaps")
    spark.createDataFrame([(url(y, i), BODY.format(i)) for y in (2019, 2020) for i in range(1, 5)], "url string, html string").write.parquet(f"{folder}/n_pages")
    (tmp_path / "c.yaml").write_text("defaults: {max_articles: 9}\nsites:\n  n: {host: n.example.com, year_start: 2019, year_end: 2020, per_year: 2}\n")
    args = ["--site", "n", "--input", folder, "--output", out, "--config", str(tmp_path / "c.yaml"), "--combined"]
    assert main(args) == 0
    rows = files.read_csv(spark, f"{out}/n.csv").collect()
    assert [r["url"] for r in rows] == [url(2019, 1), url(2019, 2), url(2020, 1), url(2020, 2)]
    assert [r["url"] for r in files.read_csv(spark, f"{out}/combined.csv").collect()] == [r["url"] for r in rows]
    cached = files.read_cache(spark, f"{out}/cache/n", "urls", {"host": "n.example.com"})
    assert cached.count() == 8
    # the cache is used while it fits, and rewritten by a refresh
    spark.createDataFrame([(1, f"<urlset><url><loc>{url(2019, 9)}</loc></url></urlset>")], "file int, xml string").write.mode("overwrite").parquet(f"{folder}/n_sitemaps")
    assert main(args) == 0 and files.read_cache(spark, f"{out}/cache/n", "urls").count() == 8
    assert main([*args, "--overwrite"]) == 0 and files.read_cache(spark, f"{out}/cache/n", "urls").count() == 1


def test_cut_off_swap_is_mended(spark, tmp_path) -> None:  # noqa: ANN001
    out = str(tmp_path / "out")
    run(spark, {"n": inputs(spark)}, out, F.lit("t"))
    (tmp_path / "out" / "n.csv").rename(tmp_path / "out" / "n.csv.old")
    assert run(spark, {"n": inputs(spark)}, out, F.lit("t")) == {"n": 2}


def test_xml(spark) -> None:  # noqa: ANN001
    x = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> a </loc><lastmod>2018-01-02</lastmod></url><url><loc> </loc></url><url><loc>b</loc></url><url><loc>a</loc></url></urlset>'
    df = spark.createDataFrame([(x,)], "xml string")
    assert [tuple(r) for r in xml.sitemap_entries(df).select("url", "lastmod").collect()] == [("a", "2018-01-02"), ("b", ""), ("a", "")]
    assert df.select(xml.locs("xml").alias("v")).first()["v"] == ["a", "b", "a"]
    feed = "<rss><channel><item><link>u1</link><title>t</title><category>c1</category><category>c2</category><pubDate>d</pubDate></item><item><title>no</title></item><item><link>u3</link></item></channel></rss>"
    got = xml.feed_items(spark.createDataFrame([(feed,)], "xml string"), 3).orderBy("pos").collect()
    assert [(r["url"], r["section"]) for r in got] == [("u1", "c1"), ("u3", "")]
    assert xml.feed_items(spark.createDataFrame([(feed,)], "xml string"), 2).count() == 1


def test_feed_in_pages(spark, monkeypatch) -> None:  # noqa: ANN001
    """The limit holds over all pages of a feed, in their order; the query's feed is no single document."""
    page = lambda *urls: "<rss><channel>" + "".join(f"<item>{f'<link>{u}</link>' if u else ''}<title>t</title></item>" for u in urls) + "</channel></rss>"
    pages = spark.createDataFrame([(10, page("u6", "u7")), (2, page("u3", "", "u5")), (1, page("u1", "u2")), (3, page())], "page int, xml string").repartition(3)
    took = lambda n: [r["url"] for r in xml.feed_items(pages, n).orderBy("pos").collect()]
    assert took(6) == ["u1", "u2", "u3", "u5", "u6"] and took(2) == ["u1", "u2"] and took(0) == [] and took(99)[-1] == "u7"
    from corvid.plans import site_queries

    given = []
    monkeypatch.setattr(site_queries, "discover", lambda _spark, _site, _config, inputs: given.append(inputs["feed"]))
    customers = spark.range(1000).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("m").alias("c_mktsegment"))
    monkeypatch.setattr(site_queries, "t", lambda *_: customers)
    site_queries.discover_n_feed(spark, "")
    assert sorted(r["xml"].count("<item>") for r in given[0].collect()) == [100] * 10


def test_csv_round_trip(spark, tmp_path) -> None:  # noqa: ANN001
    rows = [tuple("" if c != "url" else f"u{i}" for c in ARTICLE_COLS) for i in range(2)] + [tuple(f' q"{c},\n x ' for c in ARTICLE_COLS)]
    df = spark.createDataFrame(rows, list(ARTICLE_COLS))
    assert files.write_csv(df, str(tmp_path / "a.csv")) == 3
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "a.csv")).collect())) == sorted(rows)
    assert files.write_csv(df.limit(0), str(tmp_path / "b.csv")) == 0
    assert "institution,title" in next((tmp_path / "b.csv").glob("part*")).read_text()
    assert files.read_csv(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "old.csv").write_text('url,text,extra\nx,"a\nb",1\n,c,2\n')
    got = files.read_csv(spark, str(tmp_path / "old.csv")).collect()
    assert [(r["url"], r["text"], r["subsection"]) for r in got] == [("x", "a\nb", "")]


@pytest.mark.parametrize("kind", ["urls", "metas", "pairs"])
def test_caches(spark, tmp_path, kind) -> None:  # noqa: ANN001
    rows = {
        "urls": spark.createDataFrame([(2016, "b"), (2016, "a"), (2016, "a"), (2017, "c")], "year int, url string"),
        "metas": spark.createDataFrame([(2016, "b", "t", "", "", "s"), (2017, "a", "", "", "", "")], "year int, url string, title string, author string, publication_date string, section string"),
        "pairs": spark.createDataFrame([(2016, 1, "b", "2016-01-01"), (2016, 0, "b", "")], "year int, pos int, url string, lastmod string"),
    }[kind]
    folder = str(tmp_path / "c")
    assert files.write_cache(rows, folder, kind, {"year_end": 2026}, "now") and not files.write_cache(rows.limit(0), folder + "x", kind, {}, "now")
    back = files.read_cache(spark, folder, kind, {"year_end": 2026})
    assert {(r["year"], r["url"]) for r in back.collect()} == {(r["year"], r["url"]) for r in rows.collect()}
    assert files.read_cache(spark, folder, kind, {"year_end": 2025}) is None and files.read_cache(spark, folder, "urls" if kind != "urls" else "pairs") is None
    assert not files.write_cache(rows.limit(0), folder, kind, {"year_end": 2026}, "later") and files.read_cache(spark, folder, kind).count() == back.count(), "nothing found replaces nothing"
    # one year anew: the others stay; then all anew
    one = rows.where("year = 2016").limit(1).withColumn("url", F.lit("z"))
    assert files.write_cache(one, folder, kind, {"year_end": 2026}, "later", years_only=True)
    got = {(r["year"], r["url"]) for r in files.read_cache(spark, folder, kind).collect()}
    assert got == {(2016, "z")} | {(r["year"], r["url"]) for r in rows.where("year <> 2016").collect()}
    assert files.write_cache(one, folder, kind, {}, "later") and files.read_cache(spark, folder, kind).count() == 1
    # a writer that died before its manifest
    files.deleted(spark, f"{folder}/manifest")
    assert files.read_cache(spark, folder, kind) is None and files.write_cache(one, folder, kind, {}, "later")
    # the document
    path = str(tmp_path / "c.json")
    assert files.export_cache(rows, path, kind, {"year_end": 2026}, "now") and not files.export_cache(rows.limit(0), path + "x", kind, {}, "now")
    back = files.read_cache(spark, path, kind, {"year_end": 2026})
    assert {(r["year"], r["url"]) for r in back.collect()} == {(r["year"], r["url"]) for r in rows.collect()}
    assert files.read_cache(spark, path, kind, {"year_end": 2025}) is None and files.read_cache(spark, path + "y", kind) is None
    assert json.loads(next((tmp_path / "c.json").glob("part*")).read_text())["cached_at"] == "now"
    (tmp_path / "bad.json").write_text("{nope")
    assert files.read_cache(spark, str(tmp_path / "bad.json"), kind) is None


def test_robots(spark) -> None:  # noqa: ANN001
    robots = spark.createDataFrame([("https://a", 200, "User-agent: *\nDisallow: /x"), ("https://b", 404, "User-agent: *\nDisallow: /"), ("https://c", None, None)], "origin string, status int, body string")
    urls = spark.createDataFrame([(u,) for u in ("https://a/x/1", "https://a/y", "https://b/z", "https://c/z", "https://d/z")], "url string")
    assert {r["url"] for r in web.allowed(urls, robots, "corvid").collect()} == {"https://a/y", "https://b/z", "https://c/z", "https://d/z"}
    reader = web.FetchReader({"urls": "https://a/1\nhttps://b/2\nhttps://a/3"})
    assert [(p.name, p.urls) for p in reader.partitions()] == [("https://a", ("https://a/1", "https://a/3")), ("https://b", ("https://b/2",))]


def test_config(tmp_path) -> None:  # noqa: ANN001
    (tmp_path / "c.yaml").write_text("defaults: {max_articles: 5, rate_limit: {delay_min: 1, delay_max: 3}}\nsites:\n  a: {rate_limit: {delay_min: 6}}\n")
    got = site_config(load_config(str(tmp_path / "c.yaml")), "a")
    assert got == {"max_articles": 5, "rate_limit": {"delay_min": 6, "delay_max": 3}}
    (tmp_path / "e.yaml").write_text("")
    assert load_config(str(tmp_path / "e.yaml")) == {}
    with pytest.raises(KeyError):
        site_config({"sites": {}}, "a")
    with pytest.raises(SystemExit):
        main([])


BODY = '<div id="sno-story-body-content"><p>text {}</p></div>'


def inputs(spark, n: int = 6):  # noqa: ANN001, ANN201
    c = spark.createDataFrame([(i, f"https://h/2020/01/0{i}/a/b{i}/", f"T{i}", "", "2020-01-01", "News", 2020) for i in range(1, n)], "pos int, url string, title string, author string, publication_date string, section string, year int").withColumns({"subtitle": F.lit(""), "subsection": F.lit("")})
    p = spark.createDataFrame([(f"https://h/2020/01/0{i}/a/b{i}/", BODY.format(i) if i != 2 else "<p>none</p>") for i in range(1, n)], "url string, html string")
    return c, p


def test_run_is_incremental(spark, tmp_path) -> None:  # noqa: ANN001
    ts, out = F.lit("2026-01-01T00:00:00+00:00"), str(tmp_path / "out")
    assert run(spark, {"n": inputs(spark)}, out, ts, write_combined=True) == {"n": 2}
    first = files.read_csv(spark, f"{out}/n.csv").collect()
    assert [r["url"][-3:] for r in first] == ["b1/", "b3/"] and first[0]["publication_date"] == "2020-01-01"
    assert run(spark, {"n": inputs(spark)}, out, ts) == {"n": 2}, "the year's quota is met by what is there"
    assert quality.violations(files.read_csv(spark, f"{out}/combined.csv")).count() == 0
    assert run(spark, {"n": inputs(spark)}, out, ts, incremental=False) == {"n": 2}
    with pytest.raises(KeyError):
        run(spark, {"zz": inputs(spark)}, out)


def test_stream(spark, tmp_path) -> None:  # noqa: ANN001
    candidates, pages = inputs(spark, 5)
    source, corpus = str(tmp_path / "in"), str(tmp_path / "corpus")
    pages.where("url like '%b1/'").write.parquet(source)
    stream = lambda ck="ck": merge_stream(spark.readStream.schema(pages.schema).parquet(source), SITES["y"], candidates, corpus, str(tmp_path / ck), F.lit("t")).trigger(availableNow=True).start().awaitTermination()
    stream()
    pages.where("url like '%b3/' or url like '%b1/'").withColumn("html", F.lit("<article><p>z</p></article>")).write.mode("append").parquet(source)
    stream()
    log = ChangeLog(spark, corpus)
    got = log.read().collect()
    assert sorted(r["url"][-3:] for r in got)[-1] == "b3/" and len({r["url"] for r in got}) == len(got)
    # a batch that Spark runs again writes nothing, though its commit is in
    last = max((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    before = log.version()
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    stream()
    assert log.version() == before and sorted(log.read().collect()) == sorted(got)
    # a lost checkpoint starts a new stream, which goes on from what is there
    stream("ck2")
    later = log.read().collect()
    assert {r["url"] for r in got} <= {r["url"] for r in later} and len({r["url"] for r in later}) == len(later)


def test_listing_backfill(spark) -> None:  # noqa: ANN001
    a = spark.createDataFrame([(1, 0, "/article/x-20200101", "", ""), (1, 1, "/article/y", "Y", ""), (1, 2, "/article/x-20200101", "", "Read X"), (2, 0, "/article/x-20200101", "Later", "")], "page int, pos int, href string, text string, aria_label string")
    got = discovery.listing_articles(a, "b").collect()
    assert [(r["url"], r["title"], r["year"]) for r in got] == [("b/article/x-20200101", "X", 2020)]
    assert {r["url"] for r in discovery.recent_articles(a, "b", 1, 5).collect()} == {"b/article/x-20200101", "b/article/y"}


def test_spread_lastmod_modes(spark) -> None:  # noqa: ANN001
    """A URL that a sitemap lists twice takes one place of its year's quota, in literal mode two."""
    rows = [("https://h/1/a/x/", 0, 2020), ("https://h/1/a/x/", 1, 2020), ("https://h/2/b/y/", 2, 2020), ("https://h/3/c/z/", 3, 2020)]
    df = spark.createDataFrame(rows, "url string, pos int, year int")
    once = [(r["url"][10], r["section"]) for r in discovery.spread_lastmod(df, 1, 3).orderBy("url", "pos").collect()]
    twice = [(r["url"][10], r["section"]) for r in discovery.spread_lastmod(df, 1, 3, literal=True).orderBy("url", "pos").collect()]
    # places 0, 2 (round half to even of 1.5) and 3 of the four rows
    assert once == [("1", "A"), ("2", "B"), ("3", "C")] and twice == [("1", "A"), ("2", "B"), ("3", "C")]
    assert [r["pos"] for r in discovery.spread_lastmod(df, 2, 1, literal=True).orderBy("pos").collect()] == [0, 3]
    assert [r["pos"] for r in discovery.spread_lastmod(df.where("pos < 3"), 2, 1).orderBy("pos").collect()] == [0, 2]
    assert [r["pos"] for r in discovery.spread_lastmod(df.where("pos < 2"), 2, 1, literal=True).orderBy("pos").collect()] == [0, 1]

"""Fetching against a server on this machine: rounds, retries, robots rules, lost tasks, and a run from URLs to the corpus."""

from __future__ import annotations

import logging
import os
import signal
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pandas as pd
import pytest

from corvid.plans.run import main
from corvid.sources import files, web


class Site:
    """pages: path -> body, or status, or a list of statuses for one request after the other."""

    def __init__(self, pages: dict):
        self.pages, self.seen, self.times, self.agents = pages, Counter(), [], set()
        site = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:  # noqa: N802
                site.seen[self.path] += 1
                site.times.append(time.monotonic())
                site.agents.add(self.headers["User-Agent"])
                body = site.pages.get(self.path, 404)
                if isinstance(body, list):
                    body = body[min(site.seen[self.path], len(body)) - 1]
                self.send_response(body if isinstance(body, int) else 200)
                self.end_headers()
                self.wfile.write(b"" if isinstance(body, int) else body.encode())

            def log_message(self, *_) -> None:  # noqa: ANN002
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.server.server_port}"


@pytest.fixture
def site():  # noqa: ANN201
    made = []

    def make(pages: dict) -> Site:
        made.append(Site(pages))
        return made[-1]

    yield make
    for s in made:
        s.server.shutdown()


CONFIG = {"user_agent": "corvid-test", "rate_limit": {"delay_min": 0, "delay_max": 0}, "backoff": 0, "retries": 2, "timeout": 5}


def urls_of(spark, *urls: str):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(u,) for u in urls], "url string")


def test_crawl(spark, site, tmp_path, caplog) -> None:  # noqa: ANN001
    s = site({"/robots.txt": "User-agent: *\nDisallow: /private", "/a": "<p>ok</p>", "/busy": [503, 429, "<p>ok</p>"], "/down": 500, **{f"/n{i}": f"{i}" for i in range(7)}})
    asked = [f"{s.base}/{p}" for p in ("a", "busy", "gone", "down", "private/x", *(f"n{i}" for i in range(7)))] + ["http://127.0.0.1:9/none"]
    with caplog.at_level(logging.INFO, "corvid"):
        found = web.crawl(urls_of(spark, *asked, asked[0]), CONFIG, str(tmp_path / "c"), most=4).collect()
    got = {r["url"].rsplit("/", 1)[1]: (r["status"], r["html"]) for r in found}
    assert len(found) == len(asked)
    assert got == {"a": (200, "<p>ok</p>"), "busy": (200, "<p>ok</p>"), "gone": (404, None), "down": (500, None), "x": (None, None), "none": (None, None), **{f"n{i}": (200, str(i)) for i in range(7)}}
    assert s.seen["/busy"] == 3 and s.seen["/down"] == 3 and s.seen["/gone"] == 1 and s.seen["/robots.txt"] == 1 and s.seen["/a"] == 1 and not s.seen["/private/x"]
    assert s.agents == {"corvid-test"}
    levels = {(r.levelname, r.getMessage().split(",")[0]) for r in caplog.records}
    assert ("WARNING", "robots rules of 1 origins") in levels and any(x == "WARNING" and "forbid 1 pages" in y for x, y in levels)
    # what is there isn't asked for again, and a new URL is
    before = sum(s.seen.values())
    assert web.crawl(urls_of(spark, *asked[:6], f"{s.base}/n0?x"), CONFIG, str(tmp_path / "c"), most=4).count() == 7
    assert sum(s.seen.values()) == before + 1


def test_no_robots_rules(spark, site, tmp_path, caplog) -> None:  # noqa: ANN001
    s = site({"/a": "x"})
    with caplog.at_level(logging.INFO, "corvid"):
        assert web.crawl(urls_of(spark, f"{s.base}/a"), CONFIG, str(tmp_path / "c")).first()["html"] == "x"
    assert any(r.levelname == "INFO" and "no robots rules at 1 origins" in r.getMessage() for r in caplog.records)
    assert web.crawl(urls_of(spark), CONFIG, str(tmp_path / "d")).collect() == []


def test_one_request_at_a_time_with_a_delay(spark, site, tmp_path) -> None:  # noqa: ANN001
    s = site({f"/{i}": "x" for i in range(5)})
    web.crawl(urls_of(spark, *(f"{s.base}/{i}" for i in range(5))), {**CONFIG, "rate_limit": {"delay_min": 0.2, "delay_max": 0.3}}, str(tmp_path / "c")).collect()
    pages = sorted(s.times)[1:]  # the first is for the robots rules
    assert len(pages) == 5 and all(b - a >= 0.19 for a, b in zip(pages, pages[1:], strict=False))


def test_pages_leave_one_at_a_time() -> None:
    """A page is handed on before the next one is asked for; a retry waits."""
    seen, waited = [], []
    rows = pd.DataFrame({"url": ["u1", "u2", "u3"], "attempt": [1, 3, 1]})
    answers = web._answers(iter([rows]), lambda url: seen.append(url) or (200, url), lambda attempt: waited.append(attempt) or 0)
    assert next(answers)["html"].tolist() == ["u1"] and seen == ["u1"]
    assert next(answers)["html"].tolist() == ["u2"] and seen == ["u1", "u2"] and waited == [1, 3]
    assert [p.name for p in web.FetchReader({"urls": "https://a/1\nhttps://b/2"}).partitions()] == ["https://a", "https://b"]


def test_a_killed_task_loses_its_round_only(spark, site, tmp_path) -> None:  # noqa: ANN001
    s = site({"/robots.txt": "User-agent: *\nAllow: /", **{f"/{i:02}": f"{i}" for i in range(12)}})
    mark = str(tmp_path / "died")

    def opener(url: str, agent: str, timeout: float) -> tuple:
        found = web.opened(url, agent, timeout)
        if url.endswith("/09") and not os.path.exists(mark):
            open(mark, "w").close()
            os.kill(os.getpid(), signal.SIGKILL)
        return found

    asked = urls_of(spark, *(f"{s.base}/{i:02}" for i in range(12)))
    with pytest.raises(Exception, match="(?i)python worker|killed|crashed|EOF"):
        web.crawl(asked, CONFIG, str(tmp_path / "c"), opener=opener, most=4).count()
    assert {r["html"] for r in web.crawl(asked, CONFIG, str(tmp_path / "c"), opener=opener, most=4).collect()} == {str(i) for i in range(12)}
    assert s.seen["/robots.txt"] == 1 and all(s.seen[f"/{i:02}"] == 1 for i in (*range(8), 10, 11)) and s.seen["/08"] == s.seen["/09"] == 2


BODY = '<div id="sno-story-body-content"><p>text {}</p></div>'


def test_main_fetches(spark, site, tmp_path) -> None:  # noqa: ANN001
    """From a sitemap index to the corpus; a second run asks for nothing that is held."""
    out = str(tmp_path / "out")
    pages: dict = {"/robots.txt": "User-agent: *\nDisallow: /2020/05/02/"}
    s = site(pages)
    paths = [f"/{y}/05/0{i}/a/s{i}/" for y in (2019, 2020) for i in (1, 2)]
    loc = lambda p: f"<url><loc>{s.base}{p}</loc></url>"
    pages |= {"/sitemap.xml": f"<sitemapindex><sitemap><loc>{s.base}/post-sitemap1.xml</loc></sitemap><sitemap><loc>{s.base}/page-sitemap.xml</loc></sitemap></sitemapindex>", "/post-sitemap1.xml": f"<urlset>{''.join(map(loc, paths))}</urlset>"}
    pages |= {p: BODY.format(p) for p in paths}
    # discovery takes https URLs of a host; the test's server speaks http
    rss = "".join(f"<item><link>{s.base}{p}</link><title>T</title><pubDate>2020-05-01</pubDate></item>" for p in paths)
    pages["/feed"] = f"<rss><channel>{rss}</channel></rss>"
    (tmp_path / "c.yaml").write_text(f"defaults: {{user_agent: corvid-test, retries: 0, rate_limit: {{delay_min: 0, delay_max: 0}}}}\nsites:\n  n: {{discovery_mode: rss, rss_url: '{s.base}/feed', sitemap_index: '{s.base}/sitemap.xml', per_year: 5}}\n")
    for extra in ([], ["--log", "--combined"]):
        args = ["--site", "n", "--fetch", "--output", out + "".join(extra), "--config", str(tmp_path / "c.yaml"), *extra]
        s.seen.clear()
        assert main(args) == 0
        rows = files.read_csv(spark, f"{out}{''.join(extra)}/n.csv").collect()
        assert {r["url"] for r in rows} == {f"{s.base}{p}" for p in paths if "2020/05/02" not in p} and all(r["text"].startswith("text /") for r in rows)
        assert s.seen[paths[0]] == 1 and not s.seen["/2020/05/02/a/s2/"]
        assert main(args) == 0 and s.seen[paths[0]] == 1, "what is held isn't asked for again"
    from corvid.plans import live

    found = live.tables(spark, "n", {"sitemap_index": f"{s.base}/sitemap.xml", **CONFIG}, str(tmp_path / "f"))["sitemaps"].collect()
    assert len(found) == 1 and found[0]["xml"] == pages["/post-sitemap1.xml"]

"""Robots rules and polite fetching.

crawl() reads a list of URLs of any length into a folder, in rounds over a frontier: a round takes the next URLs of each origin, an origin is
read by one task, one request at a time with the configured delay, and each page leaves its task as it comes. A round is appended to the folder
when it is done, and what is there is not asked for again: a task or job that is lost repeats its round at most, with the robots rules and the
number of attempts kept. Robots rules are read once for each origin and honoured, with an honest agent name.

corvid_fetch is the same for a few URLs as a data source. Everything else in the package reads captured pages.
"""

from __future__ import annotations

import logging
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.error import HTTPError, URLError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.urls import origin
from ..ship import ship
from .files import exists

log = logging.getLogger("corvid")
RETRIED = (429, 500, 502, 503, 504)


def allowed(candidates: DataFrame, robots: DataFrame, agent: str, url: str = "url") -> DataFrame:
    """candidates whose origin's rules allow them. robots: origin, status, body; no row, an error or a status from 400 on allows."""

    @F.pandas_udf("boolean")
    def may(urls: pd.Series, status: pd.Series, body: pd.Series) -> pd.Series:
        rules: dict[str, RobotFileParser] = {}
        out = []
        for u, s, b in zip(urls, status, body, strict=True):
            if b is None or pd.isna(s) or s >= 400:
                out.append(True)
                continue
            if b not in rules:
                rules[b] = RobotFileParser()
                rules[b].parse(b.splitlines())
            out.append(rules[b].can_fetch(agent, u))
        return pd.Series(out)

    rules = robots.dropDuplicates(["origin"]).select("origin", F.struct(F.col("status").cast("double").alias("status"), "body").alias("rule")).alias("r")
    joined = candidates.alias("c").join(rules, origin(F.col(f"c.{url}")) == F.col("r.origin"), "left")
    return joined.where(may(F.col(f"c.{url}"), F.col("r.rule.status"), F.col("r.rule.body"))).select("c.*")


@dataclass
class Origin(InputPartition):
    name: str
    urls: tuple[str, ...]


class FetchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.agent = options.get("agent", "corvid/1.0")
        self.low, self.high = float(options.get("delay_min", 1)), float(options.get("delay_max", 3))
        self.retries, self.timeout, self.backoff = int(options.get("retries", 3)), float(options.get("timeout", 15)), float(options.get("backoff", 1))

    def partitions(self) -> list[Origin]:
        by: dict[str, list[str]] = {}
        for u in self.urls:
            s = urlsplit(u)
            by.setdefault(f"{s.scheme}://{s.netloc}", []).append(u)
        return [Origin(o, tuple(us)) for o, us in sorted(by.items())]

    def read(self, partition: Origin) -> Iterator[tuple]:
        rules = robots_rules(partition.name, self.get)
        for u in partition.urls:
            if rules is not None and not rules.can_fetch(self.agent, u):
                log.warning("robots rules of %s forbid %s", partition.name, u)
                yield u, None, None
                continue
            time.sleep(random.uniform(self.low, self.high))
            yield (u, *self.get(u))

    def get(self, url: str) -> tuple[int | None, str | None]:
        for attempt in range(self.retries + 1):
            status, body = opened(url, self.agent, self.timeout)
            if status is not None and status not in RETRIED or attempt == self.retries:
                return status, body
            time.sleep(self.backoff * 2**attempt)
        return None, None


def robots_rules(name: str, get: Callable[[str], tuple[int | None, str | None]]) -> RobotFileParser | None:
    status, body = get(f"{name}/robots.txt")
    if status is None or status >= 400 or body is None:
        return None
    rules = RobotFileParser()
    rules.parse(body.splitlines())
    return rules


#: Called with a URL, the agent's name and a timeout; gives a status (None: no answer) and a body (None unless it was answered well).
Opener = Callable[[str, str, float], tuple[int | None, str | None]]


def opened(url: str, agent: str, timeout: float) -> tuple[int | None, str | None]:
    """One request."""
    try:
        with urlopen(Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:  # noqa: S310
            return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
    except HTTPError as e:
        return e.code, None
    except (URLError, TimeoutError, OSError):
        return None, None


#: URLs of an origin in a round, at most: what a lost task repeats.
ROUND = 50
STATE = "url string, attempt int, status int, html string"
RULES = "origin string, status int, body string"


def _agent(config: dict) -> str:
    return config.get("user_agent") or config.get("agent") or "corvid/1.0"


def _answers(batches: Iterator[pd.DataFrame], ask: Callable[[str], tuple[int | None, str | None]], wait: Callable[[int], float]) -> Iterator[pd.DataFrame]:
    """The answers to the rows (url, attempt) of batches, each as it comes: a page is handed on before the next one is asked for."""
    for batch in batches:
        for url, attempt in zip(batch["url"], batch["attempt"], strict=True):
            time.sleep(wait(attempt))
            status, html = ask(url)
            yield pd.DataFrame({"url": [url], "attempt": [attempt], "status": [status], "html": [html]}).astype({"attempt": "int32", "status": "Int32"})


def _asked(rows: DataFrame, config: dict, opener: Opener, delayed: bool = True) -> DataFrame:
    """rows (url, origin, attempt) with status and html. An attempt after the first waits for its back-off besides the delay."""
    limit = config.get("rate_limit") or {}
    low, high = (float(limit.get("delay_min", 1)), float(limit.get("delay_max", 3))) if delayed else (0.0, 0.0)
    timeout, backoff, agent = float(config.get("timeout", 15)), float(config.get("backoff", 1)), _agent(config)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _answers(batches, lambda url: opener(url, agent, timeout), lambda attempt: random.uniform(low, high) + (backoff * 2 ** (attempt - 2) if attempt > 1 else 0))

    # an origin is one task's; how many tasks read at once is configured, one by default
    dealt = rows.repartition(int(limit.get("max_concurrency") or 1), "origin").sortWithinPartitions("origin", "attempt", "url")
    return dealt.select("url", "attempt").mapInPandas(run, STATE)


def robots(origins: DataFrame, config: dict, folder: str, opener: Opener = opened) -> DataFrame:
    """origin, status, body of the robots rules of the origins (column origin), each read once for the folder."""
    spark = ship(origins.sparkSession)
    path = f"{folder}/robots"
    held = spark.read.schema(RULES).parquet(path) if exists(spark, path) else spark.createDataFrame([], RULES)
    new = origins.select("origin").where("origin <> ''").distinct().join(held, "origin", "left_anti")
    asked = new.select(F.concat("origin", F.lit("/robots.txt")).alias("url"), "origin", F.lit(1).alias("attempt"))
    read = _asked(asked, config, opener, delayed=False)
    read.select(F.regexp_replace("url", "/robots[.]txt$", "").alias("origin"), "status", F.col("html").alias("body")).write.mode("append").parquet(path)
    rules = spark.read.schema(RULES).parquet(path)
    for level, note, test in ((logging.INFO, "no robots rules at %d origins, e.g. %s: all is allowed", F.col("status") == 404), (logging.WARNING, "robots rules of %d origins, e.g. %s, could not be read: all is allowed", F.col("status").isNull() | ((F.col("status") >= 400) & (F.col("status") != 404)))):
        told = rules.where(test).agg(F.count("*").alias("n"), F.min("origin").alias("first")).first()
        if told["n"]:
            log.log(level, note, told["n"], told["first"])
    return rules


def crawl(candidates: DataFrame, config: dict, folder: str, url: str = "url", opener: Opener = opened, most: int = ROUND) -> DataFrame:
    """url, status, html of all candidates, however many; status null where there was no answer or robots rules forbid the page.

    config: a site's configuration: user_agent, timeout, retries, backoff, and rate_limit with delay_min, delay_max and max_concurrency (how
    many origins are read at once; 1). folder: the state, shared by driver and executors; a crawl that was cut off goes on from it, a
    new crawl wants a new folder. Redirects are followed; statuses 429 and 5xx and missing answers are asked for again, `retries` times.
    """
    spark = ship(candidates.sparkSession)
    retries, path = int(config.get("retries", 3)), f"{folder}/pages"
    wanted = candidates.select(F.col(url).alias("url"), origin(url).alias("origin")).where("origin <> ''").distinct()
    rules = robots(wanted, config, folder, opener)
    free = allowed(wanted, rules, _agent(config))
    again = F.col("status").isNull() | F.col("status").isin(*RETRIED)
    while True:
        state = spark.read.schema(STATE).parquet(path) if exists(spark, path) else spark.createDataFrame([], STATE)
        last = state.groupBy("url").agg(F.max(F.struct("attempt", "status")).alias("s")).select("url", "s.*")
        left = free.join(last, "url", "left").where(F.col("attempt").isNull() | (again & (F.col("attempt") <= retries)))
        todo = left.select("url", "origin", (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt"))
        # what is new first, then what failed
        turn = todo.withColumn("n", F.row_number().over(Window.partitionBy("origin").orderBy("attempt", "url"))).where(F.col("n") <= most)
        counted = Observation()
        _asked(turn.select("url", "origin", "attempt"), config, opener).observe(counted, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
        if not counted.get["n"]:
            break
        log.info("%d pages asked for", counted.get["n"])
    best = state.groupBy("url").agg(F.max_by(F.struct("status", "html"), "attempt").alias("s"))
    forbidden = wanted.join(free.select("url"), "url", "left_anti").agg(F.count("*").alias("n"), F.min("url").alias("first")).first()
    if forbidden["n"]:
        log.warning("robots rules forbid %d pages, e.g. %s", forbidden["n"], forbidden["first"])
    return wanted.select("url").join(best, "url", "left").select("url", "s.status", "s.html")


class Fetch(DataSource):
    """spark.read.format("corvid_fetch").option("urls", "a\\nb")...: url, status, html; status null where not fetched."""

    @classmethod
    def name(cls) -> str:
        return "corvid_fetch"

    def schema(self) -> str:
        return "url string, status int, html string"

    def reader(self, schema) -> FetchReader:  # noqa: ANN001
        return FetchReader(self.options)

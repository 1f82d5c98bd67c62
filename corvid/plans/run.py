"""Incremental runs: discovery x pages -> articles, merged with what is there."""

from __future__ import annotations

import argparse
import dataclasses
import logging
import sys
import time
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import normalize_date
from ..functions.text import clean_text
from ..operators import merge
from ..operators.sampling import first_rows, until_quota
from ..schema import ARTICLE, ARTICLE_COLS, conform
from ..ship import cut, ship
from ..sources.changelog import ChangeLog
from ..sources.files import deleted, exists, read_csv, write_csv
from . import live as live_input
from .discover import INPUTS, discover
from .quality import metrics
from .sites import SITES, SiteSpec, extract_pages

log = logging.getLogger("corvid")
STAMP = "yyyy-MM-dd'T'HH:mm:ssXXX"


def load_config(path: str) -> dict:
    """YAML configuration; an empty file is an empty one."""
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def site_config(config: dict, key: str) -> dict:
    """Defaults under a site's own values; rate_limit is merged key by key. An unknown site is a KeyError."""
    own, base = config["sites"][key] or {}, config.get("defaults") or {}
    limits = {**(base.get("rate_limit") or {}), **(own.get("rate_limit") or {})}
    return {**base, **own, **({"rate_limit": limits} if limits else {})}


def configured(spec: SiteSpec, config: dict) -> SiteSpec:
    """The site's specification with the quota and cap of its configuration."""
    known = {k: config[k] for k in ("per_year", "max_articles") if k in config}
    return dataclasses.replace(spec, **known) if known else spec


def setup_logging(folder: str, level: int = logging.INFO) -> Path:
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = Path(folder) / time.strftime("run_%Y%m%d_%H%M%S.log")
    logging.basicConfig(level=level, format="%(asctime)s %(levelname)s %(message)s", handlers=[logging.StreamHandler(sys.stdout), logging.FileHandler(path, encoding="utf-8")], force=True)
    return path


def articles(spec: SiteSpec, candidates: DataFrame, pages: DataFrame, run_ts: Column, collected: DataFrame | None = None) -> DataFrame:
    """Articles of candidates (pos, url, title, author, publication_date, section[, year, lastmod]) that aren't collected yet,
    until the quota of each year and the cap, with pos."""
    if collected is not None:
        candidates = merge.unknown(candidates, collected)
    candidates = merge.first_wins(candidates, "url", ["pos"])
    # only candidates' pages are parsed
    wanted = pages.join(candidates.select("url"), "url", "left_semi")
    rows = merge.fields_merged(candidates, extract_pages(wanted, spec), spec.precedence)
    if spec.per_year is not None and "year" in rows.columns:
        done = collected.where("year is not null").groupBy("year").count() if spec.seed_quota and collected is not None and "year" in collected.columns else None
        rows = until_quota(rows, ["year"], ["pos"], spec.per_year, spec.max_articles, done, ["pos"])
    else:
        rows = first_rows(rows, ["pos"], spec.max_articles)
    out = rows.select(
        F.lit(spec.institution).alias("institution"), "title", "subtitle", clean_text("author").alias("author"), normalize_date("publication_date").alias("publication_date"),
        "section", "subsection", "url", "text", run_ts.alias("scraped_at"), "pos",
    )
    return out


def run_site(spec: SiteSpec, candidates: DataFrame, pages: DataFrame, existing: DataFrame | None, run_ts: Column, seen: DataFrame | None = None, incremental: bool = True, mode: str = "intent") -> DataFrame:
    """The site's corpus after a run: article columns with src_rank and pos, which give the order.

    Known URLs with text are skipped; seen holds URLs that earlier sites of the run gave.
    """
    spark = candidates.sparkSession
    held = conform(existing) if existing is not None and incremental else spark.createDataFrame([], ARTICLE)
    held = held.withColumn("pos", F.monotonically_increasing_id())
    filled = held.where(F.trim("text") != "").select("url")
    if spec.seed_quota:
        filled = filled.withColumn("year", F.regexp_extract("url", r"/([0-9]{4})/", 1).try_cast("int"))
    new = articles(spec, candidates, pages, run_ts, filled)
    if seen is not None:
        new = merge.not_in(new, seen)
    return merge.merged(held.select(*ARTICLE_COLS, "pos"), new, mode)


def site_changes(spec: SiteSpec, candidates: DataFrame, pages: DataFrame, held: DataFrame, run_ts: Column, seen: DataFrame | None = None, mode: str = "intent") -> DataFrame:
    """What a run changes of a site's corpus: article columns, pos and gone (see merge.changes). held: url, filled of what is there."""
    filled = held.where("filled").select("url")
    if spec.seed_quota:
        filled = filled.withColumn("year", F.regexp_extract("url", r"/([0-9]{4})/", 1).try_cast("int"))
    new = articles(spec, candidates, pages, run_ts, filled)
    if seen is not None:
        new = merge.not_in(new, seen)
    return merge.changes(held, new, mode)


def run_log(spark: SparkSession, inputs: dict[str, tuple[DataFrame, DataFrame]], out: str, run_ts: Column | None = None, mode: str = "intent", config: dict | None = None, export: bool = False) -> dict[str, int]:
    """Runs the sites of inputs (key -> candidates, pages) in registry order over corpora kept as changes, <out>/log/<key>; gives the rows that each
    run wrote, which are at most those that its pages gave. export: also write <out>/<key>.csv, all of the corpus."""
    ship(spark)
    run_ts = run_ts if run_ts is not None else F.date_format(F.current_timestamp(), STAMP)
    counts, seen = {}, None
    for key in (k for k in SITES if k in inputs):
        spec = configured(SITES[key], site_config(config, key)) if config else SITES[key]
        log_ = ChangeLog(spark, f"{out}/log/{key}")
        found = log_.commit(site_changes(spec, *inputs[key], log_.held(), run_ts, seen, mode), metrics=metrics())
        counts[key] = found["rows"]
        log.info("%s: %s", key, found)
        held = log_.held().select("url")
        seen = held if seen is None else seen.unionByName(held)
        if export:
            path = f"{out}/{key}.csv"
            write_csv(log_.read().orderBy("seq", "pos"), path + ".new")
            _swap(spark, path + ".new", path)
    return counts


def run(spark: SparkSession, inputs: dict[str, tuple[DataFrame, DataFrame]], out: str, run_ts: Column | None = None, incremental: bool = True, write_combined: bool = False, mode: str = "intent", config: dict | None = None) -> dict[str, int]:
    """Runs the sites of inputs (key -> candidates, pages) in registry order; writes <out>/<key>.csv and gives rows by site.

    Each site is written whole; run_log() writes changes only. A site is written beside its old file and then takes its place, so nothing is overwritten while it is read; a run that
    was cut off between the two renames is mended by the next. The combined file keeps the order of sites and, within one, of its file.
    """
    ship(spark)
    for key in inputs:
        SITES[key]  # an unknown site is a KeyError
    run_ts = run_ts if run_ts is not None else F.date_format(F.current_timestamp(), STAMP)
    counts, seen, parts = {}, None, []
    for key in (k for k in SITES if k in inputs):
        path = f"{out}/{key}.csv"
        _mend(spark, path)
        existing = read_csv(spark, path)
        spec = configured(SITES[key], site_config(config, key)) if config else SITES[key]
        result = run_site(spec, *inputs[key], existing, run_ts, seen, incremental, mode)
        found: dict = {}
        counts[key] = write_csv(result.orderBy("src_rank", "pos"), path + ".new", found=found, metrics=metrics())
        _swap(spark, path + ".new", path)
        written = read_csv(spark, path).withColumn("pos", F.monotonically_increasing_id())  # one file: its order
        seen = written.select("url") if seen is None else seen.unionByName(written.select("url"))
        parts.append(written)
        log.info("%s: %d rows, %s", key, counts[key], found)
    if write_combined:
        write_csv(merge.combined(parts).orderBy("site_rank", "pos"), f"{out}/combined.csv.new")
        _mend(spark, f"{out}/combined.csv")
        _swap(spark, f"{out}/combined.csv.new", f"{out}/combined.csv")
    return counts


def _swap(spark: SparkSession, new: str, old: str) -> None:
    """The old file steps aside, the new one takes its place, then the old one goes: one of the two is always whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(new).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = path(old + ".old")
    if fs.exists(path(old)):
        fs.delete(aside, True)
        fs.rename(path(old), aside)
    fs.rename(path(new), path(old))
    fs.delete(aside, True)


def _mend(spark: SparkSession, old: str) -> None:
    """Puts back the file that a cut-off run set aside."""
    if not exists(spark, old) and exists(spark, old + ".old"):
        path = spark._jvm.org.apache.hadoop.fs.Path
        path(old).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(old + ".old"), path(old))


def captured(spark: SparkSession, folder: str, out: str, key: str, config: dict, refresh: bool, now: str) -> tuple[DataFrame, DataFrame]:
    """Candidates and pages of a site: a ready table of candidates, else those discovered from its captured tables, through its cache."""
    pages = spark.read.parquet(f"{folder}/{key}_pages")
    ready = f"{folder}/{key}_candidates"
    if exists(spark, ready):
        return spark.read.parquet(ready), pages
    tables = {name: spark.read.parquet(f"{folder}/{key}_{name}") for name in INPUTS[key] if exists(spark, f"{folder}/{key}_{name}")}
    return discover(spark, key, site_config(config, key), tables, f"{out}/cache/{key}", refresh, now), pages


def live(spark: SparkSession, out: str, key: str, config: dict, refresh: bool, now: str, logged: bool) -> tuple[DataFrame, DataFrame]:
    """Candidates and pages of a site, fetched into <out>/fetched/<key>: a run that was cut off goes on from there."""
    folder = f"{out}/fetched/{key}"
    candidates = cut(discover(spark, key, config, live_input.tables(spark, key, config, folder), f"{out}/cache/{key}", refresh, now))
    if refresh:
        held = spark.createDataFrame([], "url string")
    elif logged:
        held = ChangeLog(spark, f"{out}/log/{key}").held().where("filled").select("url")
    else:
        held = read_csv(spark, f"{out}/{key}.csv").where(F.trim("text") != "").select("url")
    return candidates, live_input.pages(spark, candidates, held, config, folder)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corvid", description="Build the article corpus from captured pages.")
    p.add_argument("--site", required=True, choices=[*sorted(SITES), "all"])
    p.add_argument("--overwrite", action="store_true", help="full refresh instead of an incremental merge")
    p.add_argument("--combined", action="store_true", help="also write the combined corpus")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="folder with <site>_pages and either <site>_candidates or the tables discovery reads, as Parquet")
    source.add_argument("--fetch", action="store_true", help="fetch discovery's tables and the candidates' pages (needs --config)")
    p.add_argument("--config", help="YAML with defaults and sites")
    p.add_argument("--output", default="output")
    p.add_argument("--log", action="store_true", help="keep each corpus as changes and write only what the run changes; with --combined also export the whole as CSV")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    setup_logging(f"{a.output}/logs")
    spark = SparkSession.builder.appName("corvid").getOrCreate()
    keys = list(SITES) if a.site == "all" else [a.site]
    config = load_config(a.config) if a.config else {}
    now = time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())
    ship(spark)
    if a.fetch:
        inputs = {k: live(spark, a.output, k, site_config(config, k), a.overwrite, now, a.log) for k in keys}
    else:
        inputs = {k: captured(spark, a.input, a.output, k, config, a.overwrite, now) for k in keys}
    if a.log:
        if a.overwrite:
            for k in keys:
                deleted(spark, f"{a.output}/log/{k}")
        run_log(spark, inputs, a.output, config=config or None, export=a.combined)
    else:
        run(spark, inputs, a.output, incremental=not a.overwrite, write_combined=a.combined, config=config or None)
    for k in keys if a.fetch else ():  # the next run asks anew
        deleted(spark, f"{a.output}/fetched/{k}")
    return 0

"""A corpus kept as changes: equal to whole rewrites on random histories, cost of a commit, restarts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corvid.operators import merge
from corvid.plans.run import run, run_log
from corvid.schema import ARTICLE_COLS
from corvid.sources import files
from corvid.sources.changelog import ChangeLog

from .test_flow import inputs

SCHEMA = ", ".join(f"{c} string" for c in ARTICLE_COLS) + ", pos int"


def batch(spark, r: random.Random, step: int, n: int):  # noqa: ANN001, ANN201
    rows = []
    for i in range(n):
        url = f"u{r.randrange(25)}"
        rows.append((*[{"url": url, "text": r.choice(["", " ", f"t{step}-{i}"])}.get(c, f"{c}{step}") for c in ARTICLE_COLS], i))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(("mode", "seed"), [("intent", 1), ("intent", 2), ("literal", 3), ("literal", 4)])
def test_equals_whole_rewrites(spark, tmp_path, mode, seed) -> None:  # noqa: ANN001
    """Random histories through folds and compactions; the order of rows too."""
    r = random.Random(seed)
    log = ChangeLog(spark, str(tmp_path / "log"), fold=2, least=r.choice([0, 30_000, 1 << 30]))
    whole: list = []
    for step in range(9):
        new = batch(spark, r, step, r.choice([0, 1, 4, 12])).cache()
        held = spark.createDataFrame([(*row, i) for i, row in enumerate(whole)], SCHEMA)
        whole = [tuple(x[c] for c in ARTICLE_COLS) for x in merge.merged(held, new, mode).orderBy("src_rank", "pos").collect()]
        written = log.commit(merge.changes(log.held(), new, mode))
        assert written["rows"] <= new.count()
        assert [tuple(x[c] for c in ARTICLE_COLS) for x in log.read().orderBy("seq", "pos").collect()] == whole
        assert {(x["url"], x["filled"]) for x in log.held().collect()} == {(w[ARTICLE_COLS.index("url")], w[ARTICLE_COLS.index("text")].strip() != "") for w in whole}
        if step % 4 == 3:
            log.vacuum()


def test_a_commit_writes_what_it_changes(spark, tmp_path) -> None:  # noqa: ANN001
    log = ChangeLog(spark, str(tmp_path / "log"))
    many = spark.range(5000).select(*[F.concat(F.lit(c), F.col("id").cast("string"), F.repeat(F.lit("x"), 50)).alias(c) for c in ARTICLE_COLS], F.col("id").alias("pos"))
    log.commit(merge.changes(log.held(), many))
    log.compact()
    base = files.size(spark, str(tmp_path / "log"))
    few = many.limit(5).withColumn("url", F.concat(F.lit("new"), "url"))
    assert log.commit(merge.changes(log.held(), few), metrics={"blank": F.count_if(F.col("title") == "")}) == {"rows": 5, "gone": 0, "blank": 0}
    assert files.size(spark, str(tmp_path / "log")) - base < base / 10
    plan = log.read()._jdf.queryExecution().executedPlan().toString()
    assert log.read().count() == 5005 and "BroadcastHashJoin" in plan, "the rows of the whole aren't shuffled"
    assert log.commit(merge.changes(log.held(), few))["rows"] == 0 and log.version() == 2, "nothing new, no commit"
    assert log.vacuum() and log.read().count() == 5005


def test_folding_is_bounded(spark, tmp_path) -> None:  # noqa: ANN001
    log = ChangeLog(spark, str(tmp_path / "log"), fold=3)
    r = random.Random(0)
    for step in range(14):
        log.commit(batch(spark, r, step, 3).dropDuplicates(["url"]).withColumn("gone", F.lit(False)), batch=f"s-{step}")
    whole, spans = log._folders()
    assert whole == 0 and len(spans) <= 2 * 3 and spans[0][0] == 1 and spans[-1][1] == 14
    assert log.done("s-13") and log.commit(batch(spark, r, 99, 3).withColumn("gone", F.lit(False)), batch="s-13") == {"rows": 0, "gone": 0}
    (tmp_path / "log" / f"change-{1:09d}-{1:09d}").rename(tmp_path / "gone")
    assert log.version() == 14, "a folded change isn't needed"
    for n in files.children(spark, log.path):
        if n.startswith("change-000000001"):
            files.deleted(spark, f"{log.path}/{n}")
    with pytest.raises(ValueError, match="missing"):
        log.version()


def test_run_log_equals_run(spark, tmp_path) -> None:  # noqa: ANN001
    ts, a, b = F.lit("2026-01-01T00:00:00+00:00"), str(tmp_path / "a"), str(tmp_path / "b")
    for given in ({"n": inputs(spark)}, {"n": inputs(spark, 8), "y": inputs(spark, 4)}):
        run(spark, given, a, ts)
        run_log(spark, given, b, ts, export=True)
        for key in given:
            assert files.read_csv(spark, f"{a}/{key}.csv").collect() == files.read_csv(spark, f"{b}/{key}.csv").collect()
    assert run_log(spark, {"n": inputs(spark)}, b, ts) == {"n": 0}

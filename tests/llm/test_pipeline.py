"""The corpus pipeline on planted cases, stage by stage and as a whole."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from corvid.llm import tokens

from . import brute

PARTS = {"aa": ["the", "ing", "er", "wh", "on"], "bb": ["sch", "ung", "ü", "ei", "ver"]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):  # noqa: ANN001, ANN201
    r = random.Random(11)
    make = lambda lang, n: " ".join("".join(r.choice(PARTS[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))
    items = [(i, make("aa", 30)) for i in range(4)]
    rows = [(i, make(lang, 120), lang) for i, lang in enumerate(["aa", "bb"] * 15)]
    near = rows[3][1].split()
    near[60] = "changed"
    rows += [
        (50, rows[2][1], "aa"), (51, " ".join(near), "bb"), (52, make("aa", 40) + " " + items[1][1] + " " + make("aa", 40), "aa"),
        (53, "write to ann@mail.example.com or +1 (974) 555-3436 " + make("aa", 50), "aa"), (54, "0123 -- 99", None), (55, None, None), (56, "", None), (57, "zqxj vkkp qqzx " * 30, None),
        (58, make("aa", 20) + " " + " ".join(items[2][1].split()[:12]) + " " + make("aa", 60), "aa"), (59, make("bb", 25), None),
    ]
    path = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([(i, t, lang, f"src{i % 3}", len(t) if t else None, "extra") for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, id string")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_stages(spark, folder) -> None:  # noqa: ANN001
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, text = docs.columns, {i: t for i, t, _ in rows}
    expected = {i for i in text if i not in (54, 55, 56, 57)}
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(kept[0]) == expected
    first = brute.near([(i, text[i]) for i in sorted(expected)], 5, 80)
    expected = {i for i, _, c in first if i == c}
    assert set(kept[1]) == expected and {50, 51}.isdisjoint(expected)
    bad = {d for d, _ in brute.contained([(i, text[i]) for i in expected], items, 5, 0.8)}
    expected -= bad
    assert bad == {52} and set(kept[2]) == expected
    assert set(kept[3]) == expected and kept[3][53].startswith("write to <email> or <phone> ")
    assert all(kept[3][i] == text[i] for i in expected - {53})
    sizes = {r["doc_id"]: r["n_chars"] for r in docs.collect()}
    assert all(sizes[i] == len(kept[3][i]) for i in expected)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    count = tokens.named("byte_bpe_50k.json")()
    assert {r["doc_id"] for r in pieces} == expected
    assert sum(r["length"] for r in pieces) == sum(count.count(t) + 1 for t in kept[3].values())


def test_labelled_noise_goes(spark, folder) -> None:  # noqa: ANN001
    """Random letters don't cover themselves, whatever their label, their number or their copies."""
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    r = random.Random(12)
    noise = [(100 + i, "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)), "aa" if i % 2 else "zz") for i in range(20)]
    noise += [(200, noise[0][1], "zz"), (201, noise[1][1], "aa"), (None, noise[2][1], "zz")]
    more = spark.createDataFrame([(i, t, lang, "src", len(t), "extra") for i, t, lang in noise], docs.schema)
    kept = {x["doc_id"] for x in corpus_pipeline.identify_language(spark, docs.union(more), path).collect()}
    assert kept == {i for i, _, _ in rows if i not in (54, 55, 56, 57)}


def test_run_is_the_stages(spark, folder) -> None:  # noqa: ANN001
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, spark.createDataFrame(docs.collect(), docs.schema), path)
    key = lambda r: tuple(r.asDict().items())
    assert sorted(map(key, docs.collect())) == sorted(map(key, corpus_pipeline.run(spark, path).collect()))


def test_empty(spark, folder, tmp_path) -> None:  # noqa: ANN001
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

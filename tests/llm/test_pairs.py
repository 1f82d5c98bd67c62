"""Substring dedup, near-duplicates and decontamination against brute force, and their odd inputs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from corvid.llm import decontam, neardup, substring_dedup
from corvid.llm.fmindex import FMIndex
from corvid.llm.graph import components

from . import brute


def corpus(seed: int, n: int = 120) -> list[tuple[int | None, str | None]]:
    """Copies, near copies in chains, shared passages, periodic texts, empties, nulls, repeated rows."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ñu", "The", "a,"]
    make = lambda k: [r.choice(vocabulary) for _ in range(k)]
    passage, docs = make(70), []
    for i in range(n):
        kind = i % 8
        if kind == 0 or not docs:
            w = make(r.randint(1, 260))
        elif kind == 1:
            w = (r.choice(docs)[1] or "x").split()
        elif kind in (2, 3):
            w = (docs[-1][1] or "x").split()
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
        elif kind == 4:
            w = make(r.randint(0, 40)) + passage + make(r.randint(0, 40))
        elif kind == 5:
            w = make(2) * r.randint(1, 150)
        elif kind == 6:
            w = make(r.randint(1, 5))
        else:
            w = make(60) + passage[:55]
        docs.append((i * 3, r.choice([" ", "  ", "\n"]).join(w)))
    docs += [(None, docs[0][1]), (1000, None), (1001, ""), (1002, " \t\n"), (0, docs[0][1]), (9, docs[4][1]), (1003, " ".join(make(3000)))]
    return docs


@pytest.fixture(scope="module")
def frame(spark):  # noqa: ANN001, ANN201
    def make(rows, schema="doc_id bigint, text string"):  # noqa: ANN001, ANN202
        return spark.createDataFrame(rows, schema).repartition(3)

    return make


def test_fm_index_counts_patterns() -> None:
    r = np.random.default_rng(1)
    text = np.append(r.integers(1, 6, 500), 0)
    index = FMIndex(text, 6, 4)
    patterns = r.integers(1, 6, (300, 4))
    low, high, matched = index.search(patterns)
    windows = np.lib.stride_tricks.sliding_window_view(text, 4)
    for p, lo, hi, m in zip(patterns, low, high, matched, strict=True):
        assert hi - lo == (windows == p).all(axis=1).sum()
        longest = max(j for j in range(5) if j == 0 or (np.lib.stride_tricks.sliding_window_view(text, j) == p[4 - j :]).all(axis=1).any())
        assert m == longest


@pytest.mark.parametrize("hot", [256, 2])
def test_substring_dedup(frame, monkeypatch, hot) -> None:  # noqa: ANN001
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SHARD", 900)
    docs = corpus(1)
    found = substring_dedup.removed(frame(docs), 50).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found), key=str)
    assert got == sorted(brute.substring(docs, 50), key=str)


def test_substring_dedup_of_nothing(frame) -> None:  # noqa: ANN001
    assert substring_dedup.removed(frame([]), 50).collect() == []


@pytest.mark.parametrize(("k", "percent"), [(4, 80), (5, 80), (3, 60)])
def test_near_duplicates(frame, k, percent) -> None:  # noqa: ANN001
    docs = corpus(2)
    found = neardup.classes(frame(docs), k, percent).collect()
    assert len(found) == len(docs)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None}
    want = set(brute.near(docs, k, percent))
    if percent == 80:
        assert got == want
    else:  # banding is made for 0.8; what is found must be right
        assert {x[:2] for x in got} == {x[:2] for x in want}
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found)


def dense(n: int, seed: int, shared: int, slots: int, variants: int) -> list[tuple[int, str]]:
    """Documents with a common part and slots of six words in some variants: many pairs just below the similarity, some above."""
    r = random.Random(seed)
    common = [f"c{i}" for i in range(shared)]
    return [(i, " ".join(common + [f"v{j}-{r.randrange(variants)}-{x}" for j in range(slots) for x in range(6)])) for i in range(n)]


@pytest.mark.parametrize(("shared", "slots", "variants"), [(140, 10, 8), (150, 6, 3)])
def test_crowded_buckets(frame, monkeypatch, shared, slots, variants) -> None:  # noqa: ANN001
    """Buckets of mostly unlinked sets, told apart by their rare shingles; the number of rounds doesn't depend on their size."""
    monkeypatch.setattr(neardup, "FEW_IDS", 10)
    rounds = []
    confirmed = neardup._confirmed
    monkeypatch.setattr(neardup, "_confirmed", lambda *a: rounds.append(1) or confirmed(*a))
    docs = dense(150, 5, shared, slots, variants)
    found = neardup.classes(frame(docs), 1, 80).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == set(brute.near(docs, 1, 80))
    assert len(rounds) <= 2


def test_deduplicated_keeps_columns(frame) -> None:  # noqa: ANN001
    docs = frame([(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, None), (None, "a b c d e f g", "z")], "doc_id bigint, text string, n string")
    left = neardup.deduplicated(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {1, 3, None}


def test_components(frame) -> None:  # noqa: ANN001
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (100, 95), (7, 7)]
    found = {r["node"]: r["component"] for r in components(frame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(1, 41), 0), 100: 90, 95: 90}


def test_decontamination(frame) -> None:  # noqa: ANN001
    r = random.Random(3)
    word = lambda: f"v{r.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(r.randint(1, 60)))) for i in range(25)] + [(None, "a b c d e f"), (99, None), (98, ""), (3, "q w e r t y u")]
    docs = []
    for i in range(60):
        w = [word() for _ in range(r.randint(0, 300))]
        if i % 2:
            x = (r.choice(items)[1] or "").split()
            for _ in range(i % 3):
                if x:
                    x[r.randrange(len(x))] = word()
            at = r.randint(0, len(w))
            w[at:at] = [y.upper() + "," for y in x]
        docs.append((i, " ".join(w)))
    docs += [(None, items[4][1]), (70, None), (71, ""), (5, docs[5][1])]
    b = frame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contained(frame(docs), b).collect()}
    merged = [(i, t) for i, t in items if i != 3] + [(3, None)]
    assert {x for x in got if x[1] != 3} == brute.contained(docs, merged, 5, 0.8)
    left = decontam.clean(frame(docs), b).collect()
    assert sorted((r["doc_id"] for r in left), key=str) == sorted((i for i, _ in docs if i not in {d for d, _ in got}), key=str)
    assert decontam.contained(frame([]), b).collect() == []
    assert decontam.contained(frame(docs), frame([], "item_id bigint, text string")).collect() == []

"""Nearest neighbours and clustering against brute force, and their odd inputs."""

from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import ann, kmeans

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind: str = "double", parts: int = 3):  # noqa: ANN001, ANN201
    """Vectors with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id bigint, embedding array<{kind}>, h int, band string").repartition(parts)


def odd_rows(d: int) -> list:
    ones = [1.0] * d
    return [(901, None), (902, []), (903, [0.0] * d), (904, [*ones[1:], None]), (905, [*ones[1:], NAN]), (906, [*ones[1:], INF]), (907, ones[1:]), (None, ones)]


def brute_nearest(rows: list, queries: set, k: int) -> dict:
    """query -> [(id, score)]: for rows of one length with numbers only."""
    by: dict = {}
    for i, v in rows:
        by.setdefault(i, []).append(v)
    out = {}
    for q in queries & set(by):
        scores = [(max(sum(a * b for a, b in zip(x, y, strict=True)) for x in by[q] for y in by[i]), i) for i in by if i != q]
        out[q] = [(i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def found_nearest(df, k: int = 20) -> dict:  # noqa: ANN001
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in sorted(v)] for q, v in out.items()}


@pytest.mark.parametrize("small", [False, True])
def test_few_vectors_are_exact(spark, monkeypatch, small) -> None:  # noqa: ANN001
    """Ties, copies, repeated rows and ids, odd rows, norms over many bands; small: many cells and blocks, all by the exact way."""
    if small:
        monkeypatch.setattr(ann, "TARGET", 1.0)
        monkeypatch.setattr(ann, "BUCKET", 4)
        monkeypatch.setattr(ann, "CELL", 8)
        monkeypatch.setattr(ann, "BLOCK", 2)
        monkeypatch.setattr(ann, "BEAM", 3)
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.integers(-3, 4, 6)]) for i in range(150)]
    rows = [(i, v) for i, v in rows if any(v)]
    rows += [(200 + i, [1.0, 2.0, 0.0, 0.0, 0.0, -1.0]) for i in range(60)] + [rows[0], rows[20], (20, [2.0, 0.0, 0.0, 0.0, 0.0, 1.0]), (300, [1e6] * 6), (301, [2.0**-20] * 6)]
    got = found_nearest(ann.search(frame(spark, rows + odd_rows(6)), F.col("vec_id") % 20 == 0, 20))
    assert got == brute_nearest(rows, {i for i, _ in rows if i % 20 == 0}, 20)


def test_few_candidates(spark) -> None:  # noqa: ANN001
    some = [(0, [1.0, 0.0]), (20, [0.0, -1.0]), (3, [1.0, 1.0])]
    assert found_nearest(ann.search(frame(spark, some), F.col("vec_id") % 20 == 0)) == brute_nearest(some, {0, 20}, 20)
    assert ann.search(frame(spark, some[:1]), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.search(frame(spark, odd_rows(2)[:1]), F.col("vec_id") % 20 == 0).collect() == []
    empty = ann.search(frame(spark, []), F.col("vec_id") % 20 == 0)
    assert empty.collect() == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_recall(spark) -> None:  # noqa: ANN001
    """Noise without any structure, the hardest case, and clusters."""
    r = np.random.default_rng(8)
    noise = r.standard_normal((3000, 32))
    centres = r.standard_normal((40, 32)) * 2
    clusters = centres[r.integers(0, 40, 3000)] + r.standard_normal((3000, 32)) * 0.6
    for x in (noise, clusters):
        x = x / np.linalg.norm(x, axis=1)[:, None]
        got = found_nearest(ann.search(frame(spark, list(enumerate(x.tolist())), parts=4), F.col("vec_id") % 20 == 0))
        want = {q: set(np.argsort(-np.where(np.arange(len(x)) == q, -9, x @ x[q]))[:20].tolist()) for q in range(0, len(x), 20)}
        assert all(len(v) == 20 for v in got.values()) and set(got) == set(want)
        assert np.mean([len(want[q] & {i for i, _ in got[q]}) / 20 for q in want]) >= 0.9


def test_probes_come_in_order_of_chance() -> None:
    y = np.array([[0.3, 7.9, -2.5]])
    steps, count, enough = ann.probes(y, 0.9, 0.9)
    p = ann.chances(y - np.floor(y), 0.9)[0]
    score = [math.prod(p[i, s + 4] for i, s in enumerate(x)) for x in steps[0].tolist()]
    assert all(a >= b * (1 - 1e-9) for a, b in zip(score, score[1:], strict=False)) and len({tuple(x) for x in steps[0].tolist()}) == 9**3
    assert enough[0] and sum(score[: count[0]]) >= 0.9 > sum(score[: count[0] - 1])
    assert abs(sum(score) - 1) < 1e-3


def brute_clusters(rows: list, k: int, rounds: int, d: int) -> tuple[dict, list]:
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own: dict = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        for j, vs in own.items():
            c[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    out: dict = {}
    for i, v in kept:
        distance, j = near(v)
        out.setdefault(i, []).append((j, distance))
    return out, c


@pytest.mark.parametrize(("n", "block", "leaf"), [(400, 2048, 32), (400, 50, 3), (5, 2048, 32)])
def test_clusters(spark, monkeypatch, n, block, leaf) -> None:  # noqa: ANN001
    monkeypatch.setattr(kmeans, "BLOCK", block)
    monkeypatch.setattr(kmeans.Tree.__init__, "__defaults__", (leaf,))
    r = np.random.default_rng(n + leaf)
    d = 3
    rows = [(i, (r.integers(-2, 3, d) / 4 + r.choice([0, 0, 1 / 4096], d)).tolist()) for i in range(n)]  # many ties
    rows += [(1000 + i, [0.5] * d) for i in range(n // 3)] + [rows[0], (7777, [-0.0] * d), (None, [0.1] * d)] + [x for x in odd_rows(d) if x[0]]
    found, centroids = kmeans.cluster(frame(spark, rows), k=8, rounds=10, d=d)
    want, c = brute_clusters(rows, 8, 10, d)
    assert centroids.tolist() == c
    got: dict = {}
    result = kmeans.with_inertia(found, centroids).collect()
    for x in result:
        got.setdefault(x["vec_id"], []).append((x["cluster"], x["distance"]))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    inertia = {j: sum(e for v in want.values() for i, e in v if i == j) for j in range(8)}
    for x in result:
        assert (x["cluster_inertia"], x["inertia"]) == (inertia[x["cluster"]], sum(inertia.values()))
        assert x["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[x["cluster"]])).encode()).hexdigest()


def test_clusters_of_large_numbers_and_of_nothing(spark) -> None:  # noqa: ANN001
    rows = [(i, [x, -x, 0.0]) for i, x in enumerate([1e30, 1e30, 131071.5, 3.0, -1e300, 2.5])]
    found, _ = kmeans.cluster(frame(spark, rows), k=2, rounds=3, d=3)
    assert found.count() == 6 and found.where("distance is null or distance < 0").count() == 0
    held = [(i, [max(-131072.0, min(131072.0, y)) for y in v]) for i, v in rows]
    assert {r["vec_id"]: [(r["cluster"], r["distance"])] for r in found.collect()} == brute_clusters(held, 2, 3, 3)[0]
    none = kmeans.with_inertia(*kmeans.cluster(frame(spark, odd_rows(3)[:2]), d=3))
    assert none.collect() == [] and "inertia" in none.columns
    assert json.dumps(none.columns) == json.dumps(["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])


def test_whole_nodes_are_used() -> None:
    """Far clusters are assigned without looking at their vectors."""
    r = np.random.default_rng(1)
    points = np.concatenate([r.integers(0, 50, (500, 4)), r.integers(10**6, 10**6 + 50, (500, 4))])
    tree = kmeans.Tree(points)
    nodes, to, rows, _ = kmeans.filtered(tree, np.array([[0] * 4, [10**6] * 4]))
    assert len(rows) == 0 and sorted(zip(tree.stop[nodes] - tree.start[nodes], to, strict=True)) == [(500, 0), (500, 1)]

"""Vantage-point search against brute force: exact, relaxed, and with unusable rows."""

from __future__ import annotations

import numpy as np
import pytest

from isotherm.llm import vptree


def plain(ids: np.ndarray, vectors: np.ndarray, wanted: np.ndarray, k: int) -> dict:
    out = {}
    for q in wanted:
        scores = (vectors * vectors[ids == q][0]).sum(axis=1)
        other = ids != q
        order = np.lexsort((ids[other], -scores[other]))[:k]
        out[int(q)] = list(zip(ids[other][order].tolist(), scores[other][order].tolist()))
    return out


def found_of(frame) -> dict:
    out: dict = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(found: dict, expected: dict) -> bool:
    return found.keys() == expected.keys() and all(
        [v for v, _ in found[q]] == [v for v, _ in expected[q]]
        and np.allclose([s for _, s in found[q]], [s for _, s in expected[q]], rtol=1e-12)
        for q in expected
    )


def clustered(seed: int, n: int, width: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width)) * 3
    return centres[rng.integers(0, 12, n)] + rng.normal(size=(n, width)) * 0.3


@pytest.mark.parametrize("relax", [1.0, 1.2])
def test_tree_prunes_and_keeps_what_it_must(monkeypatch, relax):
    monkeypatch.setattr(vptree, "LEAF_ROWS", 16)
    vectors = clustered(1, 3000, 8)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = np.arange(3000)
    tree, best = vptree.Tree(ids, vectors), vptree.Best(ids[::50], vectors[::50], 10)
    scanned, add = [0], best.add
    monkeypatch.setattr(best, "add", lambda rows, i, v: (scanned.append(len(rows) * len(i)), add(rows, i, v))[1])
    vptree.search(tree, best, relax)
    expected = plain(ids, vectors, ids[::50], 10)
    recall = np.mean([len({v for v, _ in expected[int(q)]} & set(best.ids[i])) / 10 for i, q in enumerate(ids[::50])])
    assert recall == 1.0 if relax == 1.0 else recall >= 0.9
    assert sum(scanned) < 0.6 * 60 * 3000


def test_frame_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 300)  # several shards
    monkeypatch.setattr(vptree, "QUERY_BYTES", 8 * 8 * 30)  # several blocks of queries
    vectors = clustered(2, 1500, 8)
    vectors[1400:] = vectors[100:200]  # ties
    ids = np.random.default_rng(0).permutation(1500)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<double>")
    found = found_of(vptree.nearest(frame, frame.where("vec_id % 20 = 0"), k=7))
    assert same(found, plain(ids, vectors, ids[ids % 20 == 0], 7))


def test_embeddings_exact_and_relaxed(spark, sf_middle):
    frame = spark.read.parquet(f"{sf_middle}/embeddings.parquet")
    rows = frame.collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], float)
    expected = plain(ids, vectors, ids[ids % 20 == 0], 20)
    assert same(found_of(vptree.nearest(frame, frame.where("vec_id % 20 = 0"))), expected)
    loose = found_of(vptree.nearest(frame, frame.where("vec_id % 20 = 0"), relax=3.0))
    recall = np.mean([len({v for v, _ in loose[q]} & {v for v, _ in expected[q]}) / len(expected[q]) for q in expected])
    assert recall >= 0.9


def test_unusable_rows_few_candidates_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (3, [0.5, 0.5], 1), (4, None, 1), (5, [], 1),
        (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [1.0, 2.0, 3.0], 1),
        (None, [9.0, 9.0], 1), (40, None, 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int")
    found = found_of(vptree.nearest(frame, frame.where("vec_id % 20 = 0"), k=5))
    assert found[0] == [(20, 1.0), (20, 1.0), (3, 0.5)]
    assert found[20] == [(0, 1.0), (0, 1.0), (3, 0.5), (3, 0.5)][:: 2 if len(found[20]) == 2 else 1]
    assert 40 not in found
    empty = spark.createDataFrame([], frame.schema)
    assert vptree.nearest(empty, empty).count() == 0
    assert vptree.nearest(frame, empty).count() == 0

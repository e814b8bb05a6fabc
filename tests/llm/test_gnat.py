"""Hyperplane trees and hard negatives against plain search."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

from isotherm.llm import gnat

SCHEMA = "vec_id bigint, embedding array<float>, label int, number string, query int, low int, team string"


def frame_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "x", 1, 2, "z") for i, v, y in rows], SCHEMA)


def plain(rows, width=None):
    sound = []
    for place, (i, v, y) in enumerate(rows):
        if i is None or y is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        sound.append((place, i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * float(np.float32(x))) for x in v]))
    widths = Counter(len(r[3]) for r in sound)
    width = max(widths, key=lambda w: (widths[w], w)) if widths else 0
    sound = [r for r in sound if len(r[3]) == width]
    out = Counter()
    for _, anchor, label, a in sound:
        if anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, p)), i, y) for _, i, y, p in sound if i != anchor)
        for minus, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 30 * -minus <= 100 * -s[0] <= 90 * -minus]
            for rank, (score, negative, _) in enumerate(fit[:10]):
                out[anchor, positive, rank + 1, negative, -minus, -score] += 1
    return out


def mined(frame):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(tuple(r[n] for n in names) for r in gnat.hard_negatives(frame).collect())


def test_hard_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=5) + (i % 3)).tolist(), int(rng.integers(0, 4))) for i in range(900)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0, 0.5], i % 3) for i in range(400)]  # one common vector
    rows += [
        (2000, None, 1), (2100, [], 1), (2200, [1.0, None, 1.0, 1.0, 1.0], 1), (2300, [1.0, math.nan, 1.0, 1.0, 1.0], 1),
        (2400, [1.0, math.inf, 1.0, 1.0, 1.0], 1), (2500, [1.0] * 5, None), (None, [1.0] * 5, 1), (2600, [1.0] * 4, 1),
        (2700, [0.0] * 5, 1), (2800, [-1.0] * 5, 2), (100, rows[100][1], 3), (5, rows[5][1], rows[5][2]),
    ]
    assert mined(frame_of(spark, rows)) == plain(rows)


def test_few_rows_and_none(spark):
    assert mined(frame_of(spark, [])) == Counter()
    assert mined(frame_of(spark, [(100, [1.0, 2.0], 1)])) == Counter()
    rows = [(100, [1.0, 2.0], 1), (1, [2.0, 2.0], 1), (2, [1.0, 1.0], 2), (3, [0.5, 0.5], 2)]
    found = mined(frame_of(spark, rows))
    assert found == plain(rows) and found


def test_trees_prune_and_stay_exact():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 6)) * 400
    points = np.floor(np.repeat(centres, 150, axis=0) + rng.normal(size=(6000, 6)) * 20)
    ids, labels = rng.permutation(6000).astype(np.int64), rng.integers(0, 3, 6000)
    tree = gnat.Tree(ids, labels, points)
    assert sorted(tree.order.tolist()) == list(range(6000)) and len(tree.nodes) > 40
    queries = np.floor(points[rng.integers(0, 6000, 50)] + rng.normal(size=(50, 6)) * 20)
    scores = (queries @ points.T).astype(np.int64)
    high = np.sort(scores, axis=1)[:, -200]
    low = np.sort(scores, axis=1)[:, -900]
    asked = rng.integers(0, 3, 50)
    for same in (True, False):
        search = gnat.Search(np.arange(50), np.full(50, -1), asked, queries, low, high, 7, same)
        scored = []
        plain_leaf = search._leaf

        def counted(tree, rows, members):
            scored.append(len(rows) * len(members))
            plain_leaf(tree, rows, members)

        search._leaf = counted
        search.over(tree)
        assert sum(scored) < 0.6 * 50 * 6000  # subtrees outside the annuli are left out
        for q in range(50):
            fit = [(-int(s), int(i)) for s, i, y in zip(scores[q], ids, labels) if low[q] <= s <= high[q] and (y == asked[q]) == same]
            expected = sorted(fit)[:7]
            assert [(-s, i) for s, i in zip(search.scores[q].tolist(), search.ids[q].tolist()) if s != gnat.NOTHING] == expected


def test_equal_points_make_one_leaf():
    points = np.ones((1000, 3))
    tree = gnat.Tree(np.arange(1000), np.zeros(1000, np.int64), points)
    assert len(tree.nodes) == 1
    search = gnat.Search(np.arange(1), np.array([-1]), np.zeros(1, np.int64), np.ones((1, 3)), np.array([0]), np.array([9]), 5, True)
    search.over(tree)
    assert search.ids[0].tolist() == [0, 1, 2, 3, 4]

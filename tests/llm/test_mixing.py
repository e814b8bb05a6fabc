"""Targets, tilts and copies of the mix; running totals over ranges."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_cases import empty_frame, hard_frame, hard_rows

from isotherm.llm import mixing
from isotherm.llm.batches import in_order


def test_running_totals_restart_in_each_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 0, 1, 1, 1, 1]), i, rng.randint(0, 9)) for i in range(500)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "g bigint, k bigint, x bigint")
    grouped = {r["k"]: r["x_before"] for r in in_order(frame, ["g", "k"], ["x"], "g").collect()}
    whole = {r["k"]: r["x_before"] for r in in_order(frame, ["k"], ["x"]).collect()}
    seen, total = defaultdict(int), 0
    for g, k, x in sorted(rows, key=lambda r: r[1]):
        assert grouped[k] == seen[g] and whole[k] == total
        seen[g] += x
        total += x


def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - 3 * sum(sizes[s] for s in full)
        level = rest / sum(weights[s] for s in names if s not in full)
        more = {s for s in names if s not in full and level * weights[s] > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else level * weights[s] for s in names}
        full |= more


def corpus(seed: int, hot: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = [("big", rng.randint(0, 400)) for _ in range(hot)]
    rows += [(rng.choice([None, "a", "é", "tiny2", "z", "m", "n"]), rng.randint(0, 300)) for _ in range(400)]
    rows += [("tiny", 3), ("tiny", 4), ("none", 0), ("a", 9000)]
    return [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(rows)]


@pytest.mark.parametrize(("seed", "hot"), [(1, 300), (2, 5)])
def test_sources_come_near_their_targets(spark, seed, hot):
    rows = corpus(seed, hot)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    found = {r["doc_id"]: r for r in mixing.mix_sources(frame).collect()}
    sizes: dict = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    targets, taken = plain_targets(sizes), defaultdict(int)
    for i, text, source in rows:
        r = found[i]
        assert r["size"] == len(text.split()) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source])
        assert 0 <= r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(0.01 * target, 3), source
    again = {r["doc_id"]: r for r in mixing.mix_sources(frame.repartition(3)).collect()}
    assert again == found


def test_rates_are_tilted_exponentials_that_meet_the_targets(spark):
    frame = spark.createDataFrame(corpus(4, 200), "doc_id bigint, text string, source string")
    sizes = mixing.sizes_of(frame)
    targets = mixing.targets_of(sizes)
    numbers = targets.select("number", F.col("source").alias("_s"))
    state = mixing.balanced(sizes.join(numbers, F.col("source").eqNullSafe(F.col("_s"))), targets).collect()
    by_source = defaultdict(list)
    for r in sizes.collect():
        by_source[r["source"]].append(r["size"])
    for r in state:
        if r["target"] and not r["limit"]:
            size = np.array(by_source[r["source"]], float)
            rates = np.minimum(3, np.exp(r["tilt"] * size / r["widest"]))
            assert (size * rates).sum() == pytest.approx(r["target"], rel=1e-6)


def test_hard_rows_and_empty_tables(spark):
    found = mixing.mix_sources(hard_frame(spark)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in hard_rows())
    mixed = mixing.mixed_documents(hard_frame(spark))
    assert mixed.columns == hard_frame(spark).columns
    texts = Counter(r["text"] for r in mixed.collect())
    assert texts[None] == 1 and texts[""] == 1 and max(texts.values()) <= 3 * 3
    assert mixing.mix_sources(empty_frame(spark)).count() == 0
    assert mixing.mixed_documents(empty_frame(spark)).count() == 0


def test_helper_names_do_not_clash(spark):
    rows = [(i, "w " * (i % 7), "s", f"r{i}", f"t{i}", f"T{i}", f"c{i}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _row string, _times string, times string, `copy` string")
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    assert set(map(tuple, mixed.collect())) <= set(rows)

"""Hierarchical empirical Bayes against plain arithmetic, held-out accuracy and edge cases."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from llm_cases import empty_frame, hard_frame, hard_rows

from isotherm.llm import site_quality


def plain_strength(groups: dict) -> float:
    n = np.array([len(v) for v in groups.values()], float)
    total = np.array([sum(v) for v in groups.values()])
    squares = sum(x * x for v in groups.values() for x in v)
    inside = (squares - (total**2 / n).sum()) / (n.sum() - len(n)) + 1e-9
    between = (total**2 / n).sum() - total.sum() ** 2 / n.sum() - (len(n) - 1) * inside
    between /= n.sum() - (n**2).sum() / n.sum()
    return min(max(inside / max(between, 1e-12), 1.0), 1e9)


def test_priors_and_held_out_accuracy(spark, sf_middle):
    documents = spark.read.parquet(f"{sf_middle}/documents.parquet")
    labels = spark.read.parquet(f"{sf_middle}/labels.parquet")
    found = {r["doc_id"]: r for r in site_quality.site_quality(documents, labels).collect()}
    site = {r["doc_id"]: (r["source"], r["lang"]) for r in documents.select("doc_id", "source", "lang").collect()}
    assert found.keys() == site.keys()
    hosts, paths = defaultdict(list), defaultdict(list)
    for i, (host, path) in site.items():
        hosts[host].append(found[i]["evidence"])
        paths[host, path].append(found[i]["evidence"])
    mean = np.mean([r["evidence"] for r in found.values()])
    at_host, at_path = plain_strength(hosts), plain_strength(paths)
    for i, (host, path) in site.items():
        p = found[i]["evidence"]
        host_prior = (sum(hosts[host]) - p + at_host * mean) / (len(hosts[host]) - 1 + at_host)
        own = paths[host, path]
        path_prior = (sum(own) - p + at_path * host_prior) / (len(own) - 1 + at_path)
        ratio = p / (1 - p) * path_prior / (1 - path_prior) * (1 - mean) / mean
        assert found[i]["host_prior"] == pytest.approx(host_prior, abs=2e-6)
        assert found[i]["path_prior"] == pytest.approx(path_prior, abs=2e-6)
        assert found[i]["quality"] == pytest.approx(ratio / (1 + ratio), abs=2e-6)
    held = [r for r in labels.collect() if found[r["doc_id"]]["held_out"]]
    right = [found[r["doc_id"]]["kept"] == bool(r["quality"]) for r in held]
    assert len(held) > 50 and np.mean(right) > 0.95


def test_sparse_sites_lean_on_their_parents(spark):
    good = "A plain line of words that ends as lines should end, with a mark."
    bad = "BUY!! BUY!! ### $$$ | | | BUY!! ### %%%"
    rows = [(i, good if i % 2 else bad, "even", "p") for i in range(200)]
    rows += [(1000 + i, bad, "poor", "p") for i in range(60)] + [(2000, good, "new", "q"), (2001, good, "poor", "r")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 2 and i < 1000), 0) for i, *_ in rows], "doc_id bigint, quality int, toxic int")
    found = {r["doc_id"]: r for r in site_quality.site_quality(documents, labels).collect()}
    assert found[2000]["host_prior"] == pytest.approx(found[2000]["path_prior"], abs=1e-6)
    assert found[2001]["host_prior"] < found[2000]["host_prior"]
    assert found[1]["kept"] and not found[0]["kept"] and not found[1000]["kept"]


def test_hard_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 0), (7, None, 1), (None, 1, 1), (6, 0, 0)], "doc_id bigint, quality int, toxic int")
    found = site_quality.site_quality(hard_frame(spark), labels).collect()
    assert len(found) == len(hard_rows()) and all(r["quality"] is not None for r in found)
    none = spark.createDataFrame([], labels.schema)
    unlabelled = site_quality.site_quality(hard_frame(spark), none).collect()
    assert {r["evidence"] for r in unlabelled} == {0.5}
    assert site_quality.site_quality(empty_frame(spark), labels).count() == 0

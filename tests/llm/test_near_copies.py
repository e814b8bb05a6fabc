"""SimHash fingerprints, the trie join, components and near copies against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_cases import empty_frame, hard_frame, hard_rows, noise, prose

from isotherm.llm import hamming, near_copies, simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_labels(values: np.ndarray, budget: int, groups: np.ndarray | None = None) -> np.ndarray:
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    if groups is not None:
        near &= groups[:, None] == groups[None, :]
    return hamming.components(len(values), *np.nonzero(near))


def plain_shingles(text: str | None) -> frozenset[bytes]:
    words = WORD.findall((text or "").encode().lower())
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike_pairs(texts: list[str | None], similarity: float = 0.8) -> list[tuple[int, int]]:
    """All pairs with enough five-word shingles in common, by comparing every two of them that share one."""
    sets = [plain_shingles(t) for t in texts]
    seen: dict[bytes, list[int]] = {}
    met: Counter = Counter()
    for i, shingles in enumerate(sets):
        for shingle in shingles:
            others = seen.setdefault(shingle, [])
            met.update((j, i) for j in others)
            others.append(i)
    pairs = [p for p, n in met.items() if n >= similarity * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    empty = [i for i, s in enumerate(sets) if not s]
    return pairs + [(empty[0], i) for i in empty[1:]]


def plain_groups(texts: list[str | None], budget: int = 4) -> np.ndarray:
    """Labels of the groups that fingerprints or common shingles link."""
    values = np.array([plain_fingerprint(t) for t in texts], np.uint64)
    u, v = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= budget)
    pairs = np.array(alike_pairs(texts), np.int64).reshape(-1, 2)
    return hamming.components(len(texts), np.r_[u, pairs[:, 0]], np.r_[v, pairs[:, 1]])


def clustered(rng, n: int, flips: int) -> np.ndarray:
    centres = rng.integers(0, 2**63, size=max(1, n // 10), dtype=np.uint64) * np.uint64(2)
    values = centres[rng.integers(0, len(centres), n)]
    for _ in range(flips):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return values


@pytest.mark.parametrize("budget", [0, 2, 4])
def test_trie_connects_what_pairs_connect(budget):
    rng = np.random.default_rng(budget)
    for _ in range(40):
        values = clustered(rng, int(rng.integers(1, 300)), int(rng.integers(0, 7)))
        keyed = np.unique(np.stack([rng.integers(0, 3, len(values)).astype(np.uint64), values], 1), axis=0)
        groups, values = keyed[:, 0].astype(int), keyed[:, 1]
        u, v = hamming.linked(values, groups, budget)
        assert len(u) <= len(values)
        assert (hamming.components(len(values), u, v) == plain_labels(values, budget, groups)).all()


@pytest.mark.parametrize("rows", [8192, 20])
def test_links_of_a_frame(spark, monkeypatch, rows):
    monkeypatch.setattr(hamming, "BUCKET_ROWS", rows)  # 20: crowded buckets are cut into parts
    rng = np.random.default_rng(1)
    values = np.unique(np.r_[clustered(rng, 600, 3), clustered(rng, 5, 0) ^ np.uint64(7), np.zeros(1, np.uint64)])
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "value bigint")
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    links = hamming.hamming_links(frame, 4, len(values))
    pairs = [(place[r["u"]], place[r["v"]]) for r in links.collect()]
    u, v = np.array(pairs, np.int64).reshape(-1, 2).T
    assert (hamming.components(len(values), u, v) == plain_labels(values, 4)).all()
    roots = {r["node"]: r["root"] for r in hamming.connected(links).collect()}
    expected = plain_labels(values, 4)
    for a in range(len(values)):
        members = values.view(np.int64)[expected == expected[a]]
        assert roots.get(int(values.view(np.int64)[a]), int(members.min())) == int(members.min())


def test_long_chains_end_at_their_smallest_node(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)], "u bigint, v bigint")
    roots = {r["node"]: r["root"] for r in hamming.connected(links).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_documents_against_brute_force(spark, sf_small):
    documents = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = documents.select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] for r in rows}
    for i, text in enumerate([*noise(2, 20), prose(1, 80), prose(1, 80), "", None, "one two three"]):
        texts[10_000 + i] = text
    found = simhash.near_components(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    ids = np.array(list(texts))
    values = np.array([plain_fingerprint(t) for t in texts.values()], np.uint64)
    labels = plain_labels(values, 4)
    smallest = {label: int(ids[labels == label].min()) for label in set(labels)}
    expected = {int(i): (f"{v:016x}", smallest[label]) for i, v, label in zip(ids, values, labels)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == expected


def test_hard_rows_and_empty_tables(spark):
    found = simhash.near_components(hard_frame(spark)).collect()
    assert len(found) == len(hard_rows())
    component = {r["doc_id"]: r["component_id"] for r in found}
    assert component[1] == component[2] == component[3] == 1 and component[8] == 5 and component[None] is None
    kept = near_copies.one_of_each(hard_frame(spark))
    assert kept.columns == hard_frame(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 9] and ids.count(None) == 2
    assert simhash.near_components(empty_frame(spark)).count() == 0
    assert near_copies.one_of_each(empty_frame(spark)).count() == 0


def test_a_repeated_id_with_different_texts_keeps_each(spark):
    a, b, c = prose(11, 80), prose(12, 80), prose(13, 80)
    rows = [(1, a), (5, a), (5, b), (5, c), (7, c), (5, b)]
    kept = near_copies.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(1, a), (5, b), (5, c)])


def changed(rng: random.Random, text: str, share: float) -> str:
    """A copy with some words replaced: about 5 times the share of its shingles change."""
    return " ".join(w if rng.random() > share else f"w{rng.random():.9f}" for w in text.split(" "))


def test_near_copies_against_all_pairs(spark):
    rng = random.Random(4)
    texts: list[str | None] = [prose(100 + i, rng.randint(30, 300)) for i in range(60)]
    texts += [changed(rng, rng.choice(texts[:60]), rng.choice([0.003, 0.01, 0.02, 0.05])) for _ in range(240)]
    texts += [*noise(5, 10), "", None, "one two", "One two", "one two three four five"]
    frame = spark.createDataFrame(list(enumerate(texts)), "row bigint, text string").selectExpr("row", "row as doc_id", "text")
    found = {r["row"]: r["root"] for r in near_copies.near_copy_groups(frame).collect()}
    expected = plain_groups(texts)
    assert len(set(expected)) < 250
    assert [found[i] for i in range(len(texts))] == [int(np.flatnonzero(expected == e)[0]) for e in expected]


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = prose(3, 400)
    texts = [changed(rng, base, 0.002) for _ in range(600)] + [prose(1000 + i, 60) for i in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = sorted(r["doc_id"] for r in near_copies.one_of_each(frame).collect())
    assert kept == [0, *range(600, 800)]


def test_smallest_by_key_and_salt(spark):
    rows = [(i, i % 3 if i < 900 else None) for i in range(1000)]
    found = near_copies.least_by(spark.createDataFrame(rows, "row bigint, k int").where("k is not null"), ["k"], "row").collect()
    assert len(found) == 900 and all(r["first"] == r["k"] and r["first"] <= r["near"] <= r["row"] for r in found)


def test_helper_names_do_not_clash(spark):
    rows = [(1, "a b c d e f", "s", "r", 5, "t", 6.5), (2, "a b c d e f", None, None, None, None, None), (3, "g", "s", "x", 1, "y", 2.0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _row string, `row_number` int, ROW string, `a.b` double")
    kept = near_copies.one_of_each(frame)
    assert kept.columns == frame.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]

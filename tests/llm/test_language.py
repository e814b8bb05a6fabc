"""The conditional random field: exact marginals, held-out accuracy, code-switched text, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
from llm_cases import empty_frame, hard_frame, hard_rows

from isotherm.llm import language

QUICK = language.Training(documents=200, words=120, rounds=25)


def plain_marginals(emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    n, k = emission.shape
    ahead, state = [], np.ones(k)
    for t in range(n):
        state = (state @ transition) * emission[t]
        state /= state.sum()
        ahead.append(state)
    back, total = np.ones(k), np.zeros(k)
    for t in range(n - 1, -1, -1):
        both = ahead[t] * back
        total += both / both.sum()
        back = transition @ (emission[t] * back)
        back /= back.sum()
    return total


def test_scan_equals_one_step_after_another(monkeypatch):
    rng = np.random.default_rng(0)
    transition, lengths = rng.random((3, 3)) + 0.1, [0, 1, 5, 40, 33, 7, 64, 200]
    offsets = np.r_[0, np.cumsum(lengths)]
    emission = rng.random((offsets[-1], 3)) + 0.05
    for cells in (1 << 22, 64):
        monkeypatch.setattr(language, "CELLS", cells)
        found = language.marginal_sums(emission, transition, offsets)
        for d, n in enumerate(lengths):
            expected = plain_marginals(emission[offsets[d] : offsets[d + 1]], transition) if n else np.zeros(3)
            assert np.allclose(found[d], expected)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    stream = rng.integers(0, 5, (4, 6))
    emission, transition = rng.random((5, 2)) + 0.1, rng.random((2, 2)) + 0.1
    expected, passed = language._expected(stream, emission, transition, 5)
    assert np.isclose(expected.sum(), 24) and np.isclose(passed.sum(), 20)
    by_row = [plain_marginals(emission[row], transition) for row in stream]
    assert np.allclose(expected.sum(axis=0), np.sum(by_row, axis=0))


def test_held_out_accuracy(spark, sf_middle):
    documents = spark.read.parquet(f"{sf_middle}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    found = language.identify(documents, QUICK).collect()
    assert len(found) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert len(held) > 100 and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97


def test_words_of_switched_text_get_their_own_language():
    english, french = ["the house and the garden of that man"] * 40, ["la maison et le jardin de cet homme"] * 40
    runs = [language.words_of(t) for t in english + french]
    model = language.fit(runs, [0] * 40 + [1] * 40, ["en", "fr"], language.Training(run=8, sequence=16))
    mixed = "the house and the garden of that man la maison et le jardin"
    names, score = language.predicted([mixed, "la maison et le jardin the"], model)
    assert names == ["en", "fr"] and 0.55 < score[0] < 0.72 and 0.7 < score[1] < 0.95
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_hard_rows_and_empty_tables(spark):
    found = language.identify(hard_frame(spark), QUICK).collect()
    assert len(found) == len(hard_rows())
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 7} and all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    kept = language.keep_identified(hard_frame(spark), 0.0, QUICK)
    assert kept.columns == hard_frame(spark).columns
    assert not {1, 2, 3, 7} & {r["doc_id"] for r in kept.collect()}
    assert language.identify(empty_frame(spark), QUICK).count() == 0
    unlabelled = hard_frame(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language.identify(unlabelled, QUICK).collect()} == {"und"}
    assert language.keep_identified(unlabelled, settings=QUICK).count() == len(hard_rows())

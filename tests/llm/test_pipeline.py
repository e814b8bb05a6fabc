"""The corpus pipeline against a brute-force version, on hard rows, and its registration."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import empty_frame, hard_frame
from pyspark.sql import functions as F
from test_language import plain_marginals
from test_mixing import plain_targets
from test_near_copies import plain_groups
from test_text_operators import plain_base

import __spark_entry__ as entry
from isotherm.llm import language, quality
from isotherm.sources.scratch import staged


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """The stored rows before and after each stage."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], sf_small), name))
    return out


def rows_of(frame) -> list[dict]:
    return [r.asDict(recursive=True) for r in frame.collect()]


def test_columns_pass_through(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_dedup", "source_mix", "piece_ids"]
    assert all(f.columns == stages[0].columns for f in stages[1:-1])


def test_quality_stage(stages):
    rules, expected = quality.LineRules(), {}
    for r in rows_of(stages[0]):
        n, *_, failed = plain_base(r["text"])
        lines = r["text"].split("\n")
        kept = [x for x in lines if quality.line_verdict(x, rules) is None]
        lost = n - sum(plain_base(x)[0] for x in kept)
        if not failed and lost <= rules.max_lost_share * n:
            text = "\n".join(kept)
            expected[r["doc_id"]] = (text, r["lang"], r["source"], len(text))
    found = {r["doc_id"]: (r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows_of(stages[1])}
    assert found == expected


def test_language_stage(stages):
    labelled = stages[1].where(~language.held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    model = language.train(labelled)
    expected = {}
    for r in rows_of(stages[1]):
        words = language.words_of(r["text"])
        emission = language.emissions(words, model.weights).astype(float)
        emission = np.exp(emission - emission.max(axis=1, keepdims=True))
        total = plain_marginals(emission, np.exp(model.transitions))
        if total.max() / len(words) >= 0.4:
            expected[r["doc_id"]] = (r["text"], model.languages[int(total.argmax())])
    assert {r["doc_id"]: (r["text"], r["lang"]) for r in rows_of(stages[2])} == expected


def test_near_copy_stage(stages):
    rows = rows_of(stages[2])
    ids = np.array([r["doc_id"] for r in rows])
    labels = plain_groups([r["text"] for r in rows])
    keep = {int(ids[labels == label].min()) for label in set(labels)}
    assert sorted(r["doc_id"] for r in rows_of(stages[3])) == sorted(keep) and len(keep) < len(rows)


def test_mix_stage(stages):
    before = {r["doc_id"]: r for r in rows_of(stages[3])}
    after = rows_of(stages[4])
    assert all(r == before[r["doc_id"]] for r in after)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before.values():
        sizes[r["source"]] += len(r["text"].encode().split())
    for r in after:
        taken[r["source"]] += len(r["text"].encode().split())
    targets = plain_targets(sizes)
    assert sum(abs(taken[s] - t) for s, t in targets.items()) < 0.1 * sum(sizes.values())


def test_encoding_stage(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = Counter()
    for r in rows_of(stages[4]):
        ids = library.encode(r["text"], add_bos=True, add_eos=True)
        expected[r["doc_id"], hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), len(ids)] += 1
        assert library.decode(ids) == r["text"]
    found = rows_of(stages[5])
    assert Counter((r["doc_id"], r["ids_sha256"], r["n_tokens"]) for r in found) == expected
    assert all(len(r["ids"]) == r["n_tokens"] for r in found)


@pytest.mark.parametrize("frame", [hard_frame, empty_frame])
def test_hard_rows_and_empty_tables_go_through(spark, sf_small, frame):
    docs = frame(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_small), name)
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() == docs.count()


CLASHING = "_row string, _ROW2 string, `row_number` string, _copy string, Copy string, _times string, times string, root string, `row` string"


def test_columns_with_the_names_of_helpers_come_back(spark, sf_small):
    names = [c.split()[0].strip("`") for c in CLASHING.split(", ")]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_small), name)
    rows = rows_of(docs)
    assert len(rows) > 50 and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in names)


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))

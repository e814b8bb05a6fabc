"""Quality rules, piece codec and token counts against plain Python and the libraries."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import SCHEMA, empty_frame, hard_frame, hard_rows, noise, prose
from tokenizers import Tokenizer

from isotherm.llm import piece_codec, quality, token_counts
from isotherm.llm.batches import pieces

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    same = 0
    for line in text.split("\n"):
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    covered = {i + k for i in range(n - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), same, len(covered), failed


def repeated(seed: int) -> str:
    return " ".join([prose(seed, 9), prose(seed, 9), prose(seed + 1, 30)])


def test_base_counts_equal_plain_python(spark):
    texts = [*noise(3, 300, 200), *[prose(i, 40) for i in range(20)], *[repeated(i) for i in range(20)], "a " * 30]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = quality.judge_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[c] for c in names) for r in found} == {i: plain_base(t) for i, t in rows}


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("Home | News | Sport | About", "navigation"),
        ("We use cookies to show you more.", "boilerplate"),
        ("§&%$ 12 == ++ -- ##", "symbols"),
        ("One%%% two### three*** four$$$ five%%% six.", "symbols"),
        ("BUY THESE GOODS TODAY AND SAVE!", "upper"),
        ("go go go go go go stop", "echo"),
        ("Main page", "punctuation"),
        ("A plain line of prose, with its mark.", None),
        ("", None),
    ],
)
def test_line_rules(line, rule):
    assert quality.line_verdict(line, quality.LineRules()) == rule


@pytest.mark.parametrize(
    "line",
    [
        "தமிழ்நாட்டில் பெய்த கனமழையால் பல்வேறு மாவட்டங்களில் பள்ளிகளுக்கும் கல்லூரிகளுக்கும் விடுமுறை அறிவிக்கப்பட்டுள்ளது.",
        "विद्यार्थियों ने हिन्दी में लिखी हुई कविताएँ पढ़ीं और शिक्षिका ने उन्हें प्रोत्साहित किया।",
    ],
)
def test_vowel_signs_are_parts_of_letters(line):
    rules = quality.LineRules()
    assert sum(map(str.isalpha, line)) < rules.min_letter_share * len("".join(line.split()))
    assert quality.line_verdict(line, rules) is None
    assert quality.line_verdict(line + " = + ~ ^ _" * 16, rules) == "symbols"


def test_lost_lines_leave_the_text_and_too_many_reject_it(spark):
    good = prose(5, 48)
    bars = "Home | News | Sport | Wine\nMore | Less | Next | Last\nUp | Down | Out | In"
    rows = [(1, f"{good}\nHome | News | Sport"), (2, f"A good line it is.\n{bars}")]
    found = {r["doc_id"]: r for r in quality.judge_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1]["kept"] and found[1]["cleaned_text"] == good and found[1]["n_removed_lines"] == 1
    assert not found[2]["kept"] and not found[2]["base_failed"]


def test_hard_rows_and_empty_tables(spark):
    judged = quality.judge_documents(hard_frame(spark)).collect()
    assert len(judged) == len(hard_rows())
    assert all(r["base_failed"] for r in judged if r["doc_id"] in (1, 2, 3))
    cleaned = quality.clean_documents(hard_frame(spark))
    assert cleaned.columns == hard_frame(spark).columns
    assert all(r["kept"] is None and r["size"] == "extra" for r in cleaned.collect())
    assert quality.judge_documents(empty_frame(spark)).count() == 0
    assert quality.clean_documents(empty_frame(spark)).count() == 0


def test_codec_equals_the_library(spark, sf_small):
    texts = [*noise(5, 3000), "", " ", "   ", "▁", "<s>", "</s> a", "a" * 300, " lead", "trail ", "a  b"]
    texts += [r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = piece_codec.load(PIECES)
    ids, offsets = piece_codec.encode_texts(model, texts)
    for i, text in enumerate(texts):
        own = ids[offsets[i] : offsets[i + 1]]
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert own.tolist() == expected, text
        assert model.decode(own) == library.decode(expected), text


def test_decoding_of_any_ids_equals_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = piece_codec.load(PIECES)
    rng = np.random.default_rng(2)
    for _ in range(1000):
        ids = rng.choice([1, 2, *range(3, 600)], size=rng.integers(1, 9))
        assert model.decode(ids) == library.decode(ids.tolist()), ids


def test_codec_frame(spark):
    rows = piece_codec.encode_decode(hard_frame(spark), PIECES).collect()
    assert len(rows) == len(hard_rows())
    texts = Counter((r[0], r[1] or "") for r in hard_rows())
    assert Counter((r["doc_id"], r["decoded"]) for r in rows) == texts
    for r in rows:
        raw = np.array(r["ids"], "<u4").tobytes()
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert next(r for r in rows if r["doc_id"] == 1)["ids"] == [1, 2]
    assert piece_codec.encode_decode(empty_frame(spark), PIECES).count() == 0


def test_counts_equal_the_library(spark, sf_small):
    texts = [*noise(7, 3000), "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "ha" * 300, "\n\n \n x", "a \n b"]
    texts += [r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    library = Tokenizer.from_file(BYTES)
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.load(BYTES).count_texts(texts).tolist() == expected


def test_counts_frame(spark):
    rows = token_counts.count_tokens(hard_frame(spark), BYTES, limit=10).collect()
    assert len(rows) == len(hard_rows())
    for r in rows:
        assert r["over_limit"] == (r["n_tokens"] > 10)
    assert {(r["n_bytes"], r["n_tokens"]) for r in rows if r["doc_id"] in (1, 2)} == {(0, 0)}
    assert token_counts.count_tokens(empty_frame(spark), BYTES).count() == 0


def test_batches_are_cut_by_bytes_without_loss(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n if n else None for n in (5, 0, 50, 1, 1, 9)])})
    cut = list(pieces(batch, "text", limit=10))
    assert [p.num_rows for p in cut] == [2, 1, 2, 1]
    assert SCHEMA

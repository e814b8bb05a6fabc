"""Rows that every operator on documents must bear."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, score double, "
    "size string, n bigint"
)

ALPHABET = "abeThst  \n\t.,é▁<>|s/日本語\U0001f600​�\x00 ́ß'\x1f\x85 0123"


def noise(seed: int, count: int, longest: int = 40) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = ["the", "river", "ran", "under", "old", "stone", "bridges", "while", "people", "slowly", "walked"]
    out = [rng.choice(stems) + rng.choice(["", "ed", "ing", "s", "er"]) for _ in range(words)]
    lines = [" ".join(out[i : i + 12]).capitalize() + "." for i in range(0, words, 12)]
    return "\n".join(lines)


def hard_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, repeated rows; clashing extra columns."""
    long_text = prose(1, 20_000)
    base = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "b", 3),
        (4, long_text, "en", None, len(long_text)),
        (5, prose(2, 60), "en", "b", 1),
        (5, prose(2, 60), "en", "b", 1),
        (None, prose(3, 60), "fr", "c", 2),
        (None, prose(3, 60), "fr", "c", 2),
        (6, "x" * 5000, "de", "a", 5000),
        (7, "1234 5678 !!! ???", "es", "a", None),
        (8, prose(2, 60), None, None, 1),
        (9, "日本語 テキスト です", None, "b", 12),
    ]
    return [(*row, None, 0.5, "extra", 7) for row in base]


def hard_frame(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)

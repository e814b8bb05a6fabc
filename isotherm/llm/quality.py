"""Quality rules, line first: lines are judged one by one, then the document by what it lost."""

from __future__ import annotations

import re
from dataclasses import dataclass
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from isotherm.llm.batches import map_pieces, mixed, offsets_of, sums

SYMBOLS = b"#*$%&|<>"
_SYMBOL_CHARS = SYMBOLS.decode()
_CONTINUATION = bytes(range(0x80, 0xC0))
_TERMINAL = tuple(".!?…:;。！？»”\"')]")
_SEPARATORS = frozenset("|›»>•·/-–—")
_BOILERPLATE = re.compile(
    r"all rights reserved|privacy policy|terms of (?:use|service)|cookie (?:policy|settings|notice)"
    r"|(?:accept|use[s]?) cookies|enable javascript|lorem ipsum|skip to (?:main )?content"
    r"|sign (?:in|up) (?:to|for)|subscribe (?:to|now)|share (?:this|on) |click here|read more$"
    r"|^©|^copyright\b|powered by ",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds. Shares are of a line's characters (letters), of its words, or of a text's words."""

    min_letter_share: float = 0.6
    max_symbols_per_word: float = 0.5
    max_upper_share: float = 0.6
    min_upper_words: int = 3
    max_separator_share: float = 0.2
    max_echo_share: float = 0.4
    min_echo_words: int = 6
    open_line_words: int = 8
    max_lost_share: float = 0.5
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5


def _marks(text: str) -> int:
    """Combining marks: vowel signs and accents, which are parts of letters but not isalpha."""
    return sum(category(c)[0] == "M" for c in text)


def line_verdict(line: str, rules: LineRules) -> str | None:
    """The first rule that the line breaks, or None. Blank lines break none."""
    words = line.split()
    if not words:
        return None
    n = len(words)
    if sum(w in _SEPARATORS for w in words) > rules.max_separator_share * n:
        return "navigation"
    if _BOILERPLATE.search(line):
        return "boilerplate"
    solid = "".join(words)
    letters = sum(map(str.isalpha, solid))
    digits = sum(map(str.isdigit, solid))
    least = rules.min_letter_share * len(solid)
    if letters + digits < least and letters + digits + _marks(solid) < least:
        return "symbols"
    if sum(map(line.count, _SYMBOL_CHARS)) > max(2, rules.max_symbols_per_word * n):
        return "symbols"
    if n >= rules.min_upper_words and sum(map(str.isupper, solid)) > rules.max_upper_share * letters > 0:
        return "upper"
    if n >= rules.min_echo_words and sum(map(str.__eq__, words, words[1:])) > rules.max_echo_share * n:
        return "echo"
    if not line.rstrip().endswith(_TERMINAL) and n < rules.open_line_words and not any(
        mark in line for mark in ".!?,"
    ):
        return "punctuation"
    return None


def repeated_words(ids: np.ndarray, offsets: np.ndarray, width: int = 5) -> np.ndarray:
    """For each text, its words inside a `width`-word window found twice or more in it.

    Windows with equal 64-bit hashes are candidates; those are then compared word by word.
    """
    n = len(ids)
    out = np.zeros(len(offsets) - 1, np.int64)
    if n <= width:
        return out
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
    spread = mixed(ids + 1)
    key = mixed(text[starts])
    for k in range(width):
        key = mixed(key + spread[starts + k] * np.uint64(2 * k + 3))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twin = np.zeros(len(starts), bool)
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    starts = starts[twin]
    if not len(starts):
        return out
    rows = np.stack([text[starts], *(ids[starts + k] for k in range(width))], axis=1)
    _, which, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = starts[count[which.ravel()] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return sums(np.cumsum(edge[:-1]) > 0, offsets)


def _judged(batch: pa.RecordBatch, rules: LineRules, with_text: bool) -> pa.RecordBatch:
    texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
    words = [t.split() for t in texts]  # of bytes: splits at the six ASCII spaces only
    lengths = np.array([len(w) for w in words], np.int64)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for row in words for w in row], np.int64)
    repeated = repeated_words(ids, offsets_of(lengths), rules.window)
    columns: dict[str, list] = {
        k: [] for k in ("word_chars", "n_symbols", "n_dup_lines", "lost_words", "n_removed_lines", "cleaned")
    }
    for raw, row in zip(texts, words):
        joined = b"".join(row)
        columns["word_chars"].append(len(joined.translate(None, _CONTINUATION)))
        columns["n_symbols"].append(len(raw) - len(raw.translate(None, SYMBOLS)))
        lines = raw.split(b"\n")
        solid = [line for line in lines if line.strip()]
        columns["n_dup_lines"].append(len(solid) - len(set(solid)))
        kept, lost, removed, verdicts = [], 0, 0, {}
        for line in lines:
            if line not in verdicts:
                verdicts[line] = line_verdict(line.decode(), rules)
            if verdicts[line] is None:
                kept.append(line)
            else:
                lost += len(line.split())
                removed += 1
        columns["lost_words"].append(lost)
        columns["n_removed_lines"].append(removed)
        columns["cleaned"].append(b"\n".join(kept).decode() if with_text else None)
    lost = np.array(columns["lost_words"], np.int64)
    failed = (lengths < rules.min_words) | (100 * repeated > rules.max_repeat_percent * lengths)
    out = {
        "doc_id": batch.column("doc_id"),
        "n_words": pa.array(lengths),
        "word_chars": pa.array(columns["word_chars"], pa.int64()),
        "n_symbols": pa.array(columns["n_symbols"], pa.int64()),
        "n_dup_lines": pa.array(columns["n_dup_lines"], pa.int64()),
        "n_repeat_words": pa.array(repeated),
        "base_failed": pa.array(failed),
        "kept": pa.array(~failed & (lost <= rules.max_lost_share * lengths)),
        "lost_words": pa.array(lost),
        "n_removed_lines": pa.array(columns["n_removed_lines"], pa.int64()),
    }
    if with_text:
        out["cleaned_text"] = pa.array(columns["cleaned"], pa.string())
    return pa.RecordBatch.from_pydict(out)


def judge_documents(
    documents: DataFrame, rules: LineRules = LineRules(), with_text: bool = True
) -> DataFrame:
    """One row per row of `documents` (doc_id, text): counts, verdict and the cleaned text.

    A line fails by the first of: navigation (separators between words), boilerplate phrases,
    symbols, upper case, echo (a word after itself), punctuation (a short line that neither ends
    nor contains any). Failing lines leave `cleaned_text`. The document is kept if the base rules
    hold (enough words, few repeated windows) and no more than `max_lost_share` of its words went.

    Null or empty text: no words, so `base_failed`. Repeated rows and null ids are judged row by
    row. Other columns, whatever their names, are not read. An empty table gives an empty result.
    Everything happens inside the scan's tasks; nothing is shuffled.
    """
    schema = (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, lost_words bigint, "
        "n_removed_lines bigint" + (", cleaned_text string" if with_text else "")
    )
    return map_pieces(
        documents.select("doc_id", "text"), "text", lambda b: _judged(b, rules, with_text), schema
    )


def clean_documents(documents: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The rows that `judge_documents` keeps, with all their columns and the cleaned text.

    `n_chars`, where there is such a column, is counted anew. Cases as in `judge_documents`.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        verdict = _judged(batch, rules, with_text=True)
        text = verdict.column("cleaned_text")
        columns = dict(zip(batch.schema.names, batch.columns))
        columns["text"] = text
        if "n_chars" in columns:
            columns["n_chars"] = pc.utf8_length(text).cast(batch.schema.field("n_chars").type)
        return pa.RecordBatch.from_pydict(columns).filter(verdict.column("kept"))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return map_pieces(documents, "text", step, fields)

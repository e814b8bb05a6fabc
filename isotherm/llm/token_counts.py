"""Token counts by rank-synchronous merging: ragged arrays of pre-tokens, merged side by side."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from isotherm.llm.batches import map_pieces, offsets_of, sums
from isotherm.llm.spaces import TABLE_LIMIT, byte_level_units

#: How byte-level pre-tokenizers of this kind split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of pre-tokens that are merged side by side.
CELLS = 1 << 21

NO_RANK = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class MergeCounter:
    """Merge ranks of a byte-level BPE file, and counts for the units seen so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        split = content.get("pre_tokenizer") or {}
        if (
            model["type"] != "BPE"
            or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space")
            or content.get("normalizer")
            or model.get("ignore_merges")
        ):
            raise ValueError(f"{path}: only plain byte-level BPE files are counted this way")
        special = [t["content"] for t in content.get("added_tokens", [])]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in content.get("added_tokens", [])):
            raise ValueError(f"{path}: an added token takes its neighbourhood into account")
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        vocab = model["vocab"]
        self.base = max(vocab.values()) + 1
        self.first = np.array([vocab[c] for c in byte_letters()], np.int32)
        keys, merged = [], []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            keys.append(vocab[a] * self.base + vocab[b])
            merged.append(vocab[a + b])
        ranks = np.arange(len(keys), dtype=np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks, self.merged = ranks[order], np.array(merged, np.int32)
        self.pattern = regex.compile(PATTERN)
        self.units: dict[str, int] = {}
        self.tokens: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)

    def count(self, pretokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each pre-token (none is empty).

        In each round every pre-token takes the pair of its lowest rank, and all its places at
        once; where such places overlap, the left one goes first. Later ranks only make tokens
        out of earlier ones, so this is the order of one merge after another.
        """
        lengths = np.array([len(p) for p in pretokens], np.int64)
        out = np.zeros(len(pretokens), np.int64)
        # alike in length: those that finish late are together
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            held = np.cumsum(lengths[order[at:]])
            n = max(1, int(np.searchsorted(held, CELLS, side="right")))
            rows = order[at : at + n]
            out[rows] = self._count_together([pretokens[r] for r in rows], lengths[rows])
            at += n
        return out

    def _count_together(self, pretokens: list[bytes], lengths: np.ndarray) -> np.ndarray:
        out = lengths.copy()
        symbols = self.first[np.frombuffer(b"".join(pretokens), np.uint8)]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        ranks = self._pair_ranks(symbols, owner)
        while len(symbols):
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.append(heads, len(owner)))
            best = np.minimum.reduceat(ranks, heads)
            done = best == NO_RANK
            out[owner[heads[done]]] = sizes[done]
            live = np.repeat(~done, sizes)
            if not live.any():
                break
            symbols, owner, ranks = symbols[live], owner[live], ranks[live]
            places = np.flatnonzero(ranks == np.repeat(best[~done], sizes[~done]))
            # runs of overlapping places: every second one, from the left
            fresh = np.r_[True, np.diff(places) > 1]
            run = np.flatnonzero(fresh)
            inside = np.arange(len(places)) - np.repeat(run, np.diff(np.append(run, len(places))))
            places = places[inside % 2 == 0]
            symbols[places] = self.merged[ranks[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            touched = np.zeros(len(symbols), bool)
            touched[places] = True
            symbols, owner, ranks, touched = symbols[keep], owner[keep], ranks[keep], touched[keep]
            stale = np.flatnonzero(touched | np.r_[touched[1:], False])
            right = np.minimum(stale + 1, len(symbols) - 1)
            same = (right != stale) & (owner[right] == owner[stale])
            ranks[stale] = np.where(same, self.rank(symbols[stale], symbols[right]), NO_RANK)
        return out

    def _pair_ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        out = np.full(len(symbols), NO_RANK, np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        out[inner] = self.rank(symbols[inner], symbols[inner + 1])
        return out

    def add(self, units: set[str]) -> None:
        """Work out the units not seen yet. The tables start anew when they are full."""
        if len(self.units) > TABLE_LIMIT:
            self.units.clear()
        if len(self.tokens) > TABLE_LIMIT:
            self.tokens.clear()
        new = [u for u in units if u not in self.units]
        fixed, split = [], []
        for unit in new:
            parts = self.special.split(unit) if self.special else [unit]
            fixed.append(len(parts) - 1)
            row: list[str] = []
            for part in parts:
                row.extend(self.pattern.findall(part))
            split.append(row)
        unseen = [t for t in set().union(*split) if t not in self.tokens] if split else []
        if unseen:
            self.tokens.update(zip(unseen, self.count([t.encode() for t in unseen]).tolist()))
        known = self.tokens.__getitem__
        self.units.update(zip(new, (n + sum(map(known, row)) for n, row in zip(fixed, split))))

    def count_texts(self, texts: list[str]) -> np.ndarray:
        rows = [byte_level_units(t) for t in texts]
        self.add(set().union(*rows))
        every: list[str] = []
        for row in rows:
            every.extend(row)
        counts = np.array(list(map(self.units.__getitem__, every)), np.int64)
        return sums(counts, offsets_of(np.array([len(r) for r in rows], np.int64)))


@lru_cache(maxsize=2)
def load(path: str) -> MergeCounter:
    return MergeCounter(path)


def _counted(batch: pa.RecordBatch, path: str, limit: int) -> pa.RecordBatch:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    tokens = load(path).count_texts(texts)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id"),
            "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
            "n_tokens": pa.array(tokens),
            "over_limit": pa.array(tokens > limit),
        }
    )


def count_tokens(documents: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit`) for each row.

    Counts equal those of the tokenizer file's own library: no begin or end ids, special strings in
    a text count as their token, nothing is cut. Null text counts as empty: no bytes, no tokens.
    Very long texts and pre-tokens are whole. Repeated rows are counted each; other columns are not
    read. Nothing is shuffled; a worker's tables of seen units are bounded.
    """
    return map_pieces(
        documents.select("doc_id", "text"),
        "text",
        lambda b: _counted(b, path, limit),
        "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )

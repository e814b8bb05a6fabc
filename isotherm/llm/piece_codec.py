"""SentencePiece BPE by a table of prefixes: the last piece of every prefix, then ids backwards."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from isotherm.llm.batches import gathered, map_pieces, mixed, offsets_of, sums
from isotherm.llm.spaces import TABLE_LIMIT

SPACE = "▁"

#: Tested pairs that a worker remembers, as a power of two; bytes of units that advance together.
PAIR_BITS = 20
CELLS = 1 << 20

NO_RANK = np.int64(1) << 40
NOTHING = -1

_RUNS = re.compile(r" +[^ ]*")


class PieceModel:
    """Pieces of a BPE model with byte fallback, identity normalization and a dummy prefix."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        surface: list[bytes] = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                surface.append(b"")
            elif model.is_unknown(i):
                surface.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                surface.append(piece.replace(SPACE, " ").encode())
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        # ties of score cannot occur between different pieces of a trained model; the id decides
        order = sorted(self.ids.values(), key=lambda i: (-model.get_score(i), i))
        self.rank = {self.pieces[i]: r for r, i in enumerate(order)}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError(f"{path}: a piece has a space behind another character")
        if not {c for p in self.ids for c in p} <= set(self.ids):
            raise ValueError(f"{path}: a piece has a character that is not a piece")
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.starts = offsets_of(self.lengths)[:-1]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.spaced = frozenset(i for p, i in self.ids.items() if p.startswith(SPACE))
        self.byte_table = np.array([self.byte_ids[b] for b in range(256)], np.int64)
        self._build_automaton()
        self._build_merges()
        self.alone = np.zeros(size, np.int8)  # 0: not tested, 1: merges to itself, 2: does not
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << PAIR_BITS, bool)
        self.units = UnitTable(self)

    def _build_automaton(self) -> None:
        """Aho-Corasick over the pieces' bytes: a full transition table and chains of matches."""
        child: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for piece, i in self.ids.items():
            node = 0
            for byte in piece.encode():
                step = child[node].get(byte)
                if step is None:
                    step = child[node][byte] = len(child)
                    child.append({})
                node = step
            ends[node] = i
        go = np.zeros((len(child), 256), np.int32)
        fail = np.zeros(len(child), np.int32)
        match = np.full(len(child), -1, np.int32)  # the piece that is the whole state
        longest = np.zeros(len(child), np.int32)  # the longest state ending here that is a piece
        shorter = np.zeros(len(child), np.int32)  # the next shorter one
        for node, i in ends.items():
            match[node] = i
        level = [0]
        while level:
            deeper = []
            for node in level:
                back = int(fail[node])
                if node:
                    go[node] = go[back]
                    shorter[node] = longest[back]
                    longest[node] = node if match[node] >= 0 else longest[back]
                for byte, step in child[node].items():
                    fail[step] = go[back, byte] if node else 0
                    go[node, byte] = step
                    deeper.append(step)
            level = deeper
        self.go, self.match, self.longest, self.shorter = go, match, longest, shorter
        self.n_bytes = np.zeros(len(self.pieces), np.int64)
        for piece, i in self.ids.items():
            self.n_bytes[i] = len(piece.encode())

    def _build_merges(self) -> None:
        """Every split of a piece into two pieces: the key of the pair -> rank and piece."""
        base = len(self.pieces)
        found = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    found[a * base + b] = (self.rank[piece], i)
        keys = sorted(found)
        self.merge_keys = np.array(keys, np.int64)
        self.merge_rank = np.array([found[k][0] for k in keys], np.int64)
        self.merge_piece = np.array([found[k][1] for k in keys], np.int64)
        self.n_chars = np.zeros(base, np.int64)
        chars = []
        for i, piece in enumerate(self.pieces):
            if piece in self.ids:
                self.n_chars[i] = len(piece)
                chars.extend(self.ids[c] for c in piece)
        self.char_ids = np.array(chars, np.int64)
        self.char_starts = offsets_of(self.n_chars)[:-1]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * len(self.pieces) + right
        at = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        hit = (self.merge_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.merge_rank[at], NO_RANK), self.merge_piece[at]

    def merged(self, parts: list[np.ndarray]) -> np.ndarray:
        """Merge the joined characters of the pieces of each row; rows of ids, filled up with -1.

        One merge for each row and round, the best rank and the leftmost of it, as the library does.
        """
        counts = sum(self.n_chars[p] for p in parts)
        rows = len(counts)
        symbols = np.full((rows, int(counts.max()) + 1), -1, np.int64)
        shift = np.zeros(rows, np.int64)
        for p in parts:
            n = self.n_chars[p]
            row = np.repeat(np.arange(rows), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(shift, n)
            symbols[row, at] = gathered(self.char_ids, self.char_starts[p], n)
            shift = shift + n
        ranks, _ = self._ranks(symbols[:, :-1], symbols[:, 1:])
        live = np.arange(rows)
        place = np.arange(symbols.shape[1])
        while len(live):
            at = ranks[live].argmin(axis=1)
            more = ranks[live, at] < NO_RANK
            live, at = live[more], at[more]
            if not len(live):
                break
            _, piece = self._ranks(symbols[live, at], symbols[live, at + 1])
            source = place[None, :] + (place[None, :] > at[:, None])
            source = np.minimum(source, len(place) - 1)
            moved = np.take_along_axis(symbols[live], source, axis=1)
            moved[np.arange(len(live)), at] = piece
            symbols[live] = moved
            source = np.minimum(source[:, :-1], len(place) - 2)
            kept = np.take_along_axis(ranks[live], source, axis=1)
            kept[:, -1] = NO_RANK
            each = np.arange(len(live))
            kept[each, at] = self._ranks(moved[each, at], moved[each, at + 1])[0]
            before = np.maximum(at - 1, 0)
            kept[each, before] = self._ranks(moved[each, before], moved[each, before + 1])[0]
            ranks[live] = kept
        return symbols

    def stand_alone(self, pieces: np.ndarray) -> np.ndarray:
        """Whether merging a piece's characters ends in the piece itself."""
        new = np.unique(pieces[self.alone[pieces] == 0])
        if len(new):
            self.alone[new] = np.where(self.merged([new])[:, 0] == new, 1, 2)
        return self.alone[pieces] == 1

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces side by side merge into exactly these two. Tests are remembered."""
        keys = left * len(self.pieces) + right
        slot = (mixed(keys) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        fits = self.pair_fits[slot]
        new = np.flatnonzero(self.pair_keys[slot] != keys)
        if len(new):
            distinct, which = np.unique(keys[new], return_inverse=True)
            a, b = distinct // len(self.pieces), distinct % len(self.pieces)
            out = self.merged([a, b])
            verdict = (out[:, 0] == a) & (out[:, 1] == b)
            fits[new] = verdict[which]
            slot = (mixed(distinct) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
            self.pair_keys[slot], self.pair_fits[slot] = distinct, verdict
        return fits

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after another, and their offsets.

        Every prefix of a unit has one merging result, hence one last piece: of the matches that
        end there, longest first, the one that goes with the last piece of the prefix before it.
        All units advance by one byte together. A character that no piece covers stands for
        itself. At the end the pieces are read off backwards.
        """
        lengths = np.array([len(u) for u in units], np.int64)
        order = np.argsort(-lengths, kind="stable")
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = 0
        while at < len(order):
            widest = max(int(lengths[order[at]]), 1)
            rows = order[at : at + max(1, CELLS // widest)]
            parts.append((rows, *self._encode_rows([units[r] for r in rows], lengths[rows])))
            at += len(rows)
        counts = np.zeros(len(units), np.int64)
        for rows, n, _ in parts:
            counts[rows] = n
        offsets = offsets_of(counts)
        flat = np.empty(offsets[-1], np.uint32)
        for rows, n, ids in parts:
            flat[gathered(np.arange(offsets[-1]), offsets[:-1][rows], n)] = ids
        return flat, offsets

    def _encode_rows(self, units: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, width = len(units), int(lengths[0])
        text = np.zeros((rows, width + 1), np.uint8)
        text[np.arange(width + 1)[None, :] < lengths[:, None]] = np.frombuffer(b"".join(units), np.uint8)
        last = np.full((rows, width + 1), NOTHING, np.int32)
        state = np.zeros(rows, np.int32)
        alive = np.searchsorted(-lengths, -np.arange(1, width + 1), side="right")
        for p in range(1, width + 1):
            k = alive[p - 1]
            state[:k] = self.go[state[:k], text[:k, p - 1]]
            match = self.longest[state[:k]]
            open_rows = np.flatnonzero(match)
            match = match[open_rows]
            while len(open_rows):
                piece = self.match[match].astype(np.int64)
                before = last[open_rows, p - self.n_bytes[piece]].astype(np.int64)
                joined = before >= 0
                fits = np.empty(len(piece), bool)
                fits[joined] = self.compatible(before[joined], piece[joined])
                fits[~joined] = self.stand_alone(piece[~joined])
                last[open_rows[fits], p] = piece[fits]
                match = self.shorter[match[~fits]]
                open_rows = open_rows[~fits][match > 0]
                match = match[match > 0]
        at, n = lengths.copy(), np.zeros(rows, np.int64)
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        live = np.flatnonzero(at > 0)
        while len(live):
            piece = last[live, at[live]].astype(np.int64)
            size = np.where(piece >= 0, self.n_bytes[piece], 1)
            byte = text[live, at[live] - 1]
            taken.append((live, np.where(piece >= 0, piece, self.byte_table[byte])))
            n[live] += 1
            at[live] -= size
            live = live[at[live] > 0]
        offsets = offsets_of(n)
        ids = np.empty(offsets[-1], np.uint32)
        left = offsets[1:].copy()
        for live, piece in taken:
            left[live] -= 1
            ids[left[live]] = piece
        return n, ids

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes: one leading space goes, a stray byte gives U+FFFD."""
        raw = gathered(self.surface, self.starts[ids], self.lengths[ids]).tobytes()
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decoded_slowly(ids)
        shown = ids[self.lengths[ids] > 0]
        first = len(shown) and shown[0] in self.spaced
        return text[1:] if first else text

    def _decoded_slowly(self, ids: np.ndarray) -> str:
        out, run = [], bytearray()
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.surface[self.starts[i] : self.starts[i] + 1].tobytes()
                continue
            while run:
                for k in (1, 2, 3, 4):
                    try:
                        out.append(run[:k].decode())
                        del run[:k]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    del run[:1]
            if i >= 0:
                out.append(
                    self.surface[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes().decode()
                )
        return "".join(out)


class UnitTable:
    """Units without their first space -> places of their ids. Bounded; starts anew between steps."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._empty()

    def _empty(self) -> None:
        self.places: dict[str, int] = {}
        self.flat, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def add(self, units: set[str]) -> None:
        if len(self.places) > TABLE_LIMIT:
            self._empty()
        new = [u for u in units if u not in self.places]
        flat, offsets = self.model.encode_units([(" " + u).replace(" ", SPACE).encode() for u in new])
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        self.flat = np.concatenate([self.flat, flat])


def units_of(text: str) -> list[str]:
    """Runs of spaces with what follows, each without its first space; the dummy prefix is one."""
    if not text:
        return []
    if SPACE in text:
        text = text.replace(SPACE, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [run[1:] for run in _RUNS.findall(" " + text)]
    return text.split(" ")


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def encode_texts(model: PieceModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another with begin and end ids, and where each text starts."""
    table = model.units
    rows = [units_of(t) for t in texts]
    table.add(set().union(*rows))
    counts = np.array([len(r) for r in rows], np.int64)
    every: list[str] = []
    for row in rows:
        every.extend(row)
    places = np.array(list(map(table.places.__getitem__, every)), np.int64)
    lengths = np.diff(table.offsets)[places]
    body = gathered(table.flat, table.offsets[places], lengths)
    per_text = sums(lengths, offsets_of(counts)) + 2
    offsets = offsets_of(per_text)
    ids = np.empty(offsets[-1], np.uint32)
    inner = np.ones(len(ids), bool)
    inner[offsets[:-1]] = inner[offsets[1:] - 1] = False
    ids[offsets[:-1]], ids[offsets[1:] - 1] = model.begin, model.end
    ids[inner] = body
    return ids, offsets


_TYPES = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "ids_sha256": "string",
    "decoded": "string",
    "decoded_sha256": "string",
}


def _coded(batch: pa.RecordBatch, path: str, keep: tuple[str, ...]) -> pa.RecordBatch:
    model = load(path)
    ids, offsets = encode_texts(model, [t or "" for t in batch.column("text").to_pylist()])
    ids = ids.astype("<u4")
    spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    out: dict = {"doc_id": batch.column("doc_id")}
    decoded = [model.decode(ids[a:b]) for a, b in spans] if any(k.startswith("decoded") for k in keep) else []
    for name in keep:
        if name == "n_tokens":
            out[name] = pa.array(np.diff(offsets))
        elif name == "ids":
            out[name] = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
        elif name == "ids_sha256":
            out[name] = pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in spans], pa.string())
        elif name == "decoded":
            out[name] = pa.array(decoded, pa.string())
        else:
            out[name] = pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())
    return pa.RecordBatch.from_pydict(out)


def encode_decode(documents: DataFrame, model_path: str, keep: tuple[str, ...] = tuple(_TYPES)) -> DataFrame:
    """Encode `text` with begin and end ids, and decode the ids again.

    `keep` names the outputs: n_tokens, ids, ids_sha256 (little-endian unsigned 32-bit), decoded,
    decoded_sha256 (UTF-8). Null text counts as empty, which has the begin and the end id alone.
    Long texts are whole; repeated rows are coded each; other columns are not read. Each task works
    on its own rows with a bounded table of units; nothing is shuffled.
    """
    keep = tuple(keep)
    schema = "doc_id bigint" + "".join(f", {k} {_TYPES[k]}" for k in keep)
    return map_pieces(
        documents.select("doc_id", "text"), "text", lambda b: _coded(b, model_path, keep), schema
    )

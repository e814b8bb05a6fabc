"""Token ids in files of static range asymmetric numeral systems (rANS) blocks.

The format, one Parquet row a section, rows of a part in ascending document order:

    part, section          parts cover ascending ranges of document ids
    first_token            tokens of the part before this section
    doc_ids, n_tokens      the documents of the section, whole, and their token counts
    symbols, counts        the table that the section's blocks share
    longest                steps of the longest block
    blocks                 independent blocks, each with
      n_docs                 its documents, in order
      lanes, steps           its tokens, filled up by repeats of the last, as a matrix
      words                  little-endian unsigned 32-bit words in the order of decoding
      checkpoints            for every CHECKPOINT_STEPS steps: word position, states of the lanes
      crc32                  of its ids as little-endian unsigned 32-bit integers

All lanes of a block share one stream of words. Blocks are independent, and decoding can start at any
checkpoint; a block longer than `WHOLE_STEPS`, which a very long document makes, is decoded in ranges of
checkpoints by several tasks.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isotherm.llm.batches import gathered, offsets_of, pieces, sums
from isotherm.llm.spaces import byte_level_units
from isotherm.llm.token_counts import PATTERN
from isotherm.sources.scratch import briefly_staged, staged

SCALE_BITS = 20
LOWEST = np.uint64(1 << 31)
LANES = 4096
CHECKPOINT_STEPS = 128

#: Tokens of a block, and of a section (the blocks that share a table), before it is closed.
BLOCK_TOKENS = 1 << 19
SECTION_TOKENS = 1 << 22

#: Steps of a block that one task decodes; longer blocks are cut into ranges of so many.
WHOLE_STEPS = 4 * CHECKPOINT_STEPS

#: Text bytes of a step: repeats inside a step are looked up once.
STEP_BYTES = 4 << 20

#: Units between spaces and pre-tokens whose ids a worker remembers.
STRINGS_KEPT = 800_000

#: Pre-tokens that the library gets in one string, apart by a special token.
ASKED_AT_ONCE = 200

#: A space that white space follows, or the end: only then a text is not simply cut before each space.
_OPEN_SPACE = (
    r" ([\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"
)

#: What ends a word as a pre-token of its own.
_STOPS = frozenset(".,;:!?")

#: Below this character, classes of characters are the same in every version of Unicode.
_PLAIN_END = "\u0220"

_BLOCK = pa.struct(
    [
        ("n_docs", pa.int32()),
        ("lanes", pa.int32()),
        ("steps", pa.int32()),
        ("words", pa.binary()),
        ("checkpoints", pa.binary()),
        ("crc32", pa.int64()),
    ]
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("section", pa.int32()),
        ("first_token", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("symbols", pa.binary()),
        ("counts", pa.binary()),
        ("longest", pa.int32()),
        ("blocks", pa.list_(_BLOCK)),
    ]
)
SCHEMA = (
    "part int, section int, first_token bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "symbols binary, counts binary, longest int, blocks array<struct<n_docs int, lanes int, steps int, "
    "words binary, checkpoints binary, crc32 bigint>>"
)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Positive counts turned into frequencies of at least 1 that add up to 2 ** SCALE_BITS."""
    if len(counts) > 1 << (SCALE_BITS - 1):
        raise ValueError("too many different symbols for one table")
    total = 1 << SCALE_BITS
    out = np.maximum(1, np.floor(counts * (total / counts.sum()))).astype(np.int64)
    spare = total - int(out.sum())
    if spare >= 0:
        out[np.argmax(counts)] += spare
    while spare < 0:
        largest = int(np.argmax(out))
        take = min(-spare, int(out[largest]) - int(out[largest]) // 2)
        out[largest] -= take
        spare += take
    return out


class Table:
    """Frequencies of a section's symbols, ready for coding."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols, self.frequencies = symbols, frequencies
        self.freq = frequencies.astype(np.uint64)
        self.start = offsets_of(frequencies)[:-1].astype(np.uint64)

    @staticmethod
    def of(ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        return Table(symbols.astype(np.uint32), scaled(counts[symbols]))

    def encode(self, ids: np.ndarray, lanes: int) -> tuple[np.ndarray, bytes, int]:
        """Words in reading order, checkpoints and the number of steps."""
        steps = -(-len(ids) // lanes)
        full = np.full(steps * lanes, ids[-1], ids.dtype)
        full[: len(ids)] = ids
        place = np.zeros(int(self.symbols[-1]) + 1, np.int64)
        place[self.symbols] = np.arange(len(self.symbols))
        codes = place[full].reshape(steps, lanes)
        state = np.full(lanes, LOWEST, np.uint64)
        chunks: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []
        written, low, bits = 0, np.uint64(32), np.uint64(SCALE_BITS)
        room = np.uint64(63 - SCALE_BITS)
        for step in range(steps - 1, -1, -1):
            f, c = self.freq[codes[step]], self.start[codes[step]]
            over = state >= (f << room)
            if over.any():
                words = state[over].astype(np.uint32)
                chunks.append(words)
                written += len(words)
                state[over] >>= low
            quotient = state // f
            state = (quotient << bits) + (state - quotient * f) + c
            if step % CHECKPOINT_STEPS == 0:
                marks.append((written, state.copy()))
        stream = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.uint32)
        saved = b"".join(
            np.int64(written - at).astype("<i8").tobytes() + s.astype("<u8").tobytes() for at, s in marks[::-1]
        )
        return stream.astype("<u4"), saved, steps

    @property
    def slots(self) -> np.ndarray:
        if not hasattr(self, "_slots"):
            self._slots = np.repeat(np.arange(len(self.symbols), dtype=np.int32), self.frequencies)
        return self._slots

    def decode(self, words: np.ndarray, saved: bytes, lanes: int, first: int, last: int) -> np.ndarray:
        """Ids of the steps `first` (a checkpoint) to `last`, as a matrix."""
        mark = 8 + 8 * lanes
        at = first // CHECKPOINT_STEPS * mark
        position = int(np.frombuffer(saved, "<i8", 1, at)[0])
        state = np.frombuffer(saved, "<u8", lanes, at + 8).astype(np.uint64)
        out = np.empty((last - first, lanes), np.int32)
        mask, bits, low = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
        for row in range(last - first):
            slot = state & mask
            code = self.slots[slot.astype(np.int64)]
            out[row] = code
            state = self.freq[code] * (state >> bits) + slot - self.start[code]
            short = np.flatnonzero(state < LOWEST)
            if position + len(short) > len(words):
                raise ValueError("the words of a damaged block end too early")
            if len(short):
                state[short] = (state[short] << low) | words[position : position + len(short)]
                position += len(short)
        return self.symbols[out]


def _class(pattern: str) -> str:
    """The plain characters that match, as the inside of a character class."""
    plain = map(chr, range(ord(_PLAIN_END)))
    return "".join(f"\\u{ord(c):04x}" for c in plain if regex.fullmatch(pattern, c))


def _plain_pattern() -> re.Pattern:
    """`PATTERN` for texts of plain characters, in the faster of the two engines."""
    letters, digits, spaces = _class(r"\p{L}"), _class(r"\p{N}"), _class(r"\s")
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{spaces}{letters}{digits}]+"
        f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class IdRows:
    """Ids of strings in one flat array; keeps what comes back in later steps when it is full."""

    def __init__(self, limit: int):
        self.limit = limit
        self._empty()

    def _empty(self) -> None:
        self.places: dict[str, int] = {}
        self.flat, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.steps = np.zeros(0, np.int32)  # how many steps have used each entry

    def thin_out(self) -> None:
        """When full, keep what came back in a later step, at most half a table; most words never do."""
        if len(self.places) <= self.limit:
            return
        kept = np.flatnonzero(self.steps > 1)
        if len(kept) > self.limit // 2:
            self._empty()
            return
        names, lengths = list(self.places), np.diff(self.offsets)[kept]
        self.flat = gathered(self.flat, self.offsets[kept], lengths)
        self.offsets, self.steps = offsets_of(lengths), self.steps[kept]
        self.places = {names[i]: place for place, i in enumerate(kept.tolist())}

    def add(self, new: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])
        self.flat = np.concatenate([self.flat, flat])
        self.steps = np.concatenate([self.steps, np.zeros(len(new), np.int32)])

    def found(self, every: list[str]) -> np.ndarray:
        """Places of strings; -1 where there is none."""
        return np.fromiter(map(self.places.get, every, repeat(-1)), np.int64, len(every))

    def ids(self, places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of places one after another, and the number of each of the rows that they fall into."""
        self.steps += np.bincount(places, minlength=len(self.steps)) > 0
        lengths = np.diff(self.offsets)[places]
        return gathered(self.flat, self.offsets[places], lengths), sums(lengths, offsets_of(rows))


class TokenTable:
    """Ids from the tokenizer's library, asked once for each new pre-token.

    Texts are cut at spaces first, which is cheap; only a new unit between spaces is cut into
    pre-tokens. No merge crosses the pre-tokens that the library makes, so it gives the same ids for a
    text and for its pre-tokens one by one. Units and pre-tokens share one table: a unit that is a
    pre-token has the same ids as either.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if added else None
        # a token that the library takes out of a text as it is, whatever stands around it
        plain = [i for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.separator = plain[0] if plain else None
        self.plain, self.pattern = _plain_pattern(), regex.compile(PATTERN)
        self.known = IdRows(STRINGS_KEPT)

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of a text; the string of an added token is one."""
        if not text:
            return []
        plain = text.isascii() or max(text) < _PLAIN_END
        find = self.plain.findall if plain else self.pattern.findall
        for special in self.added:
            if special in text:
                break
        else:
            return find(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out.extend([part] if i % 2 else find(part))
        return out

    def ask(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of pre-tokens, and the number of each."""
        if self.separator is None:
            rows = [e.ids for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]
            counts = np.fromiter(map(len, rows), np.int64, len(rows))
            return np.fromiter(chain.from_iterable(rows), np.uint32, int(counts.sum())), counts
        between = self.tokenizer.id_to_token(self.separator)
        texts = [between.join(pretokens[i : i + ASKED_AT_ONCE]) for i in range(0, len(pretokens), ASKED_AT_ONCE)]
        parts: list[np.ndarray] = []
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            parts += [np.array(e.ids, np.uint32), np.array([self.separator], np.uint32)]
        flat = np.concatenate(parts)
        ends = np.flatnonzero(flat == self.separator)
        return flat[flat != self.separator], np.diff(ends, prepend=-1) - 1

    def learn(self, units: set[str]) -> None:
        """Put new units into the table, and what they are cut into; an empty one has no ids."""
        words, ended, other = [], [], []
        for unit in units:
            body = unit[1:] if unit[:1] == " " else unit
            if body.isalpha() and (unit.isascii() or max(unit) < _PLAIN_END):
                words.append(unit)
            elif unit[-1:] in _STOPS and body[:-1].isalpha() and (unit.isascii() or max(unit) < _PLAIN_END):
                ended.append(unit)
            else:
                other.append(unit)
        stems, stops = [u[:-1] for u in ended], [u[-1] for u in ended]
        rows = list(map(self.cut, other))
        parts = set(chain.from_iterable(rows))
        parts.update(stems, stops)
        unseen = list(parts.difference(self.known.places).union(words))
        special = [t for t in unseen if t in self.added]
        if special:
            self.known.add(special, np.array([self.added[t] for t in special], np.uint32), np.ones(len(special), np.int64))
            unseen = [t for t in unseen if t not in self.added]
        if unseen:
            self.known.add(unseen, *self.ask(unseen))
        if ended:
            both = np.stack([self.known.found(stems), self.known.found(stops)], axis=1).ravel()
            self.known.add(ended, *self.known.ids(both, np.full(len(ended), 2)))
        composed = [(u, r) for u, r in zip(other, rows) if u not in self.known.places]
        if composed:
            every = list(chain.from_iterable(r for _, r in composed))
            sizes = np.array([len(r) for _, r in composed], np.int64)
            self.known.add([u for u, _ in composed], *self.known.ids(self.known.found(every), sizes))

    def places_of(self, every: list[str]) -> np.ndarray:
        """Places of units, new ones included."""
        places = self.known.found(every)
        missing = np.flatnonzero(places < 0).tolist()
        if missing:
            again = [every[i] for i in missing]
            self.learn(set(again))
            places[missing] = self.known.found(again)
        return places

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places and their number for texts that are cut before each space: words meet by their code, not one by one."""
        words = pc.split_pattern(texts, " ")
        starts = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        coded = pc.dictionary_encode(words.flatten())
        units = self.places_of(_strings(pc.binary_join_element_wise("", coded.dictionary, " ")))
        places = units[coded.indices.to_numpy()] if len(units) else np.zeros(0, np.int64)
        first = starts[:-1]  # no space stands before the first word
        places[first] = self.places_of(_strings(words.flatten().take(pa.array(first))))
        return places, np.diff(starts)

    def encode(self, texts: list[str | None] | pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of each; null is empty."""
        self.known.thin_out()
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        is_open = pc.match_substring_regex(column, _OPEN_SPACE)
        odd = np.flatnonzero(is_open.to_numpy(zero_copy_only=False))
        sizes = np.zeros(len(column), np.int64)
        plain, sizes_plain = self._split(column.filter(pc.invert(is_open)))
        rows = list(map(byte_level_units, column.filter(is_open).to_pylist()))
        sizes[odd] = [len(r) for r in rows]
        even = np.ones(len(column), bool)
        even[odd] = False
        sizes[even] = sizes_plain
        places = np.empty(int(sizes.sum()), np.int64)
        of_odd = np.repeat(~even, sizes)
        places[~of_odd] = plain
        places[of_odd] = self.places_of(list(chain.from_iterable(rows)))
        body, counts = self.known.ids(places, sizes)
        if end_id is None:
            return body, counts
        ends = np.cumsum(counts + 1)
        ids = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
        inner = np.ones(len(ids), bool)
        inner[ends - 1] = False
        ids[inner] = body
        return ids, counts + 1


@lru_cache(maxsize=2)
def load(path: str) -> TokenTable:
    return TokenTable(path)


def _section(part: int, section: int, first: int, docs: list, counts: list, ids: np.ndarray) -> pa.RecordBatch:
    """The row of one section. Blocks close at document ends; without ids there is no block."""
    offsets = offsets_of(np.array(counts, np.int64))
    table = Table.of(ids) if len(ids) else None
    blocks, begin = [], 0
    while table and begin < len(docs):
        end = int(np.searchsorted(offsets, offsets[begin] + BLOCK_TOKENS))
        end = min(max(end, begin + 1), len(docs))
        own = ids[offsets[begin] : offsets[end]]
        lanes = int(min(LANES, max(1, len(own) // 64)))
        words, saved, steps = table.encode(own, lanes) if len(own) else (own, b"", 0)
        blocks.append(
            {
                "n_docs": end - begin,
                "lanes": lanes,
                "steps": steps,
                "words": words.tobytes(),
                "checkpoints": saved,
                "crc32": zlib.crc32(own.astype("<u4").tobytes()),
            }
        )
        begin = end
    row = {
        "part": part,
        "section": section,
        "first_token": first,
        "doc_ids": docs,
        "n_tokens": counts,
        "symbols": table.symbols.astype("<u4").tobytes() if table else b"",
        "counts": table.frequencies.astype("<u4").tobytes() if table else b"",
        "longest": max((b["steps"] for b in blocks), default=0),
        "blocks": blocks,
    }
    return pa.RecordBatch.from_pylist([row], schema=_ARROW)


def encoded(documents: DataFrame, tokenizer_path: str, end_id: int | None = None) -> DataFrame:
    """doc_id, n_tokens and `ids`, little-endian unsigned 16- or 32-bit as `wide` says, of each row. Nothing is shuffled."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = load(tokenizer_path).encode(batch.column("text"), end_id)
        wide = bool(len(ids)) and int(ids.max()) >= 1 << 16
        raw = ids.astype("<u4" if wide else "<u2").tobytes()
        bounds = offsets_of(counts) * (4 if wide else 2)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(counts, pa.int64()),
                "wide": pa.array(np.full(len(counts), wide)),
                "ids": pa.Array.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)]
                ).cast(pa.binary()),
            }
        )

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", STEP_BYTES):
                yield step(piece)

    fields = "doc_id bigint, n_tokens bigint, wide boolean, ids binary"
    return documents.select("doc_id", "text").mapInArrow(run, fields)


def _unpacked(batch: pa.RecordBatch) -> np.ndarray:
    """Ids of a batch of `encoded` rows, one after another."""
    wide = batch.column("wide").to_numpy(zero_copy_only=False)
    packed = batch.column("ids")
    if not wide.any() or wide.all():
        at = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
        raw = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        return np.frombuffer(raw.tobytes(), "<u4" if wide.all() and len(wide) else "<u2").astype(np.uint32)
    rows = [np.frombuffer(x.as_buffer(), "<u4" if w else "<u2") for w, x in zip(wide, packed)]
    return np.concatenate(rows).astype(np.uint32)


def write_tokens(documents: DataFrame, tokenizer_path: str, folder: str, end_id: int | None = None) -> None:
    """Encode every text and write the block files of `folder` in ascending order of doc_id.

    Ids are those of the tokenizers library without special tokens added, then `end_id` if given.
    Null or empty text has the end id alone (or no ids). Null ids come first; rows with equal ids stand
    side by side in some order. Texts are encoded where they are read, and only their ids are dealt by
    ranges of doc_id and row, so neither a source nor a hot text nor an id with a third of all rows
    weighs on one task; a task holds one section of ids at a time, or one longer document.
    """
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        docs, counts, held, section, first, size = [], [], [], 0, 0, 0
        for batch in batches:
            numbers = batch.column("n_tokens").to_numpy()
            ends = offsets_of(numbers)
            ids = _unpacked(batch)
            names = batch.column("doc_id").to_pylist()
            begin = 0
            while begin < batch.num_rows:  # up to the document that fills the section
                end = int(np.searchsorted(ends, ends[begin] + SECTION_TOKENS - size))
                end = min(max(end, begin + 1), batch.num_rows)
                docs += names[begin:end]
                counts += numbers[begin:end].tolist()
                held.append(ids[ends[begin] : ends[end]])
                size += int(ends[end] - ends[begin])
                begin = end
                if size >= SECTION_TOKENS:
                    yield _section(part, section, first, docs, counts, np.concatenate(held))
                    section, first = section + 1, first + size
                    docs, counts, held, size = [], [], [], 0
        if docs:
            yield _section(part, section, first, docs, counts, np.concatenate(held))

    rows = encoded(documents, tokenizer_path, end_id).withColumn("row", F.monotonically_increasing_id())
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("row")]
    # stored, so that the sampling of the ranges reads ids and not texts
    with briefly_staged(rows, "ids") as stored:
        stored.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("row").mapInArrow(run, SCHEMA).write.parquet(folder)


def _table(row: dict) -> Table:
    return Table(np.frombuffer(row["symbols"], "<u4"), np.frombuffer(row["counts"], "<u4").astype(np.int64))


def _damaged(row: dict) -> ValueError:
    return ValueError(f"a block of section {row['section']} in part {row['part']} is damaged")


def decoded(row: dict) -> np.ndarray:
    """All ids of a section; every block's checksum must hold."""
    if not row["blocks"]:
        return np.zeros(0, np.uint32)
    table = _table(row)
    out, begin = [], 0
    for block in row["blocks"]:
        n = sum(row["n_tokens"][begin : begin + block["n_docs"]])
        begin += block["n_docs"]
        words = np.frombuffer(block["words"], "<u4").astype(np.uint64)
        ids = np.zeros(0, np.uint32)
        if n:
            ids = table.decode(words, block["checkpoints"], block["lanes"], 0, block["steps"]).ravel()[:n]
        if zlib.crc32(ids.astype("<u4").tobytes()) != block["crc32"]:
            raise _damaged(row)
        out.append(ids)
    return np.concatenate(out)


def joined_crc32(parts: list[tuple[int, int]]) -> int:
    """The checksum of byte strings one after another from (checksum, length) of each.

    A checksum moves over zero bytes by a linear map of its bits; squaring the map doubles their number.
    """

    def apply(columns: list[int], x: int) -> int:
        out = 0
        for column in columns:
            if x & 1:
                out ^= column
            x >>= 1
        return out

    one_bit = [0xEDB88320] + [1 << k for k in range(31)]  # the polynomial of crc32, as zlib has it
    total = parts[0][0]
    for crc, length in parts[1:]:
        shift, left = one_bit, 8 * length
        while left:
            if left & 1:
                total = apply(shift, total)
            shift = [apply(shift, column) for column in shift]
            left >>= 1
        total ^= crc
    return total


_RANGE = (
    "part int, section int, block int, cut int, first int, last int, lanes int, words binary, states binary, "
    "symbols binary, counts binary, doc_ids array<bigint>, n_tokens array<bigint>, first_token bigint, begins bigint, crc32 bigint"
)


def _ranges(batches):
    """The blocks of sections, cut at checkpoints; each range with its words, its lanes' states and the documents of its block."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            done, begin = 0, row["first_token"]
            for number, block in enumerate(row["blocks"]):
                docs = slice(done, done + block["n_docs"])
                lanes, mark, words = block["lanes"], 8 + 8 * block["lanes"], block["words"]
                at = [int(np.frombuffer(block["checkpoints"], "<i8", 1, c)[0]) for c in range(0, len(block["checkpoints"]), mark)]
                out = []
                for cut, first in enumerate(range(0, block["steps"], WHOLE_STEPS) if block["steps"] else [0]):
                    last = min(block["steps"], first + WHOLE_STEPS)
                    places = [at[s // CHECKPOINT_STEPS] if s < block["steps"] else len(words) // 4 for s in (first, last)]
                    place = first // CHECKPOINT_STEPS * mark
                    out.append(
                        {
                            "part": row["part"], "section": row["section"], "block": number, "cut": cut, "first": first, "last": last,
                            "lanes": lanes, "words": words[4 * places[0] : 4 * places[1]] if block["steps"] else b"",
                            "states": block["checkpoints"][place + 8 : place + mark], "symbols": row["symbols"], "counts": row["counts"],
                            "doc_ids": row["doc_ids"][docs], "n_tokens": row["n_tokens"][docs], "first_token": begin,
                            "begins": first * lanes, "crc32": block["crc32"],
                        }
                    )
                begin += sum(row["n_tokens"][docs])
                done += block["n_docs"]
                for one in out:
                    yield pa.RecordBatch.from_pylist([one], schema=_RANGE_ARROW)


_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
_RANGE_ARROW = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in _RANGE.split(", "))])


def _pieces_of_range(with_ids: bool):
    """Ids of a range: for each document in it its place, number and checksum, with the block's checksum at the end."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ends = offsets_of(np.array(row["n_tokens"], np.int64))
                ids = np.zeros(0, np.uint32)
                if row["last"] > row["first"]:
                    words = np.frombuffer(row["words"], "<u4").astype(np.uint64)
                    saved = np.int64(0).tobytes() + row["states"]
                    found = _table(row).decode(words, saved, row["lanes"], 0, row["last"] - row["first"]).ravel()
                    ids = found[: max(0, int(ends[-1]) - row["begins"])]
                low = np.clip(ends[:-1] - row["begins"], 0, len(ids))
                high = np.clip(ends[1:] - row["begins"], 0, len(ids))
                here = np.flatnonzero((high > low) | ((ends[1:] == ends[:-1]) & (row["cut"] == 0)))
                raw = ids.astype("<u4")
                out = {
                    "part": pa.array(np.full(len(here), row["part"], np.int32)),
                    "section": pa.array(np.full(len(here), row["section"], np.int32)),
                    "block": pa.array(np.full(len(here), row["block"], np.int32)),
                    "place": pa.array(here.astype(np.int32)),
                    "cut": pa.array(np.full(len(here), row["cut"], np.int32)),
                    "doc_id": pa.array([row["doc_ids"][d] for d in here], pa.int64()),
                    "inside": pa.array(row["first_token"] + ends[:-1][here]),
                    "n": pa.array((high - low)[here]),
                    "crc": pa.array([zlib.crc32(raw[low[d] : high[d]].tobytes()) for d in here], pa.int64()),
                    "cut_n": pa.array(np.full(len(here), len(ids), np.int64)),
                    "cut_crc": pa.array(np.full(len(here), zlib.crc32(raw.tobytes()), np.int64)),
                    "block_crc": pa.array(np.full(len(here), row["crc32"], np.int64)),
                }
                if with_ids:
                    out["ids"] = pa.array([raw[low[d] : high[d]].astype(np.int32) for d in here], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    return run


def _long_documents(stored: DataFrame, with_ids: bool) -> DataFrame:
    """Documents of the sections with a long block, decoded from checkpoints by several tasks.

    Each task returns counts and checksums; a document's and a block's checksum follow from those of
    their ranges in order, so no task sees all ids of a long document unless the ids are asked for.
    """
    long = stored.where(F.col("longest") > WHOLE_STEPS).mapInArrow(_ranges, _RANGE)
    spread = long.repartition("part", "section", "block", "cut")
    fields = "part int, section int, block int, place int, cut int, doc_id bigint, inside bigint, n bigint, crc bigint, "
    fields += "cut_n bigint, cut_crc bigint, block_crc bigint"
    fields += ", ids array<int>" if with_ids else ""
    found = staged(spread.mapInArrow(_pieces_of_range(with_ids), fields), "ranges")

    def check(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("cut", "ascending"), ("place", "ascending")]).to_pylist()
        cuts = {r["cut"]: (r["cut_crc"], 4 * r["cut_n"]) for r in rows}
        if joined_crc32(list(cuts.values())) != rows[0]["block_crc"]:
            raise _damaged(rows[0])
        docs: dict[int, list[dict]] = {}
        for r in rows:
            docs.setdefault(r["place"], []).append(r)
        out = [
            {
                "part": r[0]["part"], "section": r[0]["section"], "block": r[0]["block"], "place": place, "doc_id": r[0]["doc_id"],
                "inside": r[0]["inside"], "n_tokens": sum(x["n"] for x in r),
                "ids_crc32": joined_crc32([(x["crc"], 4 * x["n"]) for x in r]),
            }
            for place, r in docs.items()
        ]
        names = ("part", "section", "block", "place")
        kinds = [(n, pa.int32()) for n in names] + [(n, pa.int64()) for n in ("doc_id", "inside", "n_tokens", "ids_crc32")]
        return pa.Table.from_pylist(out, schema=pa.schema(kinds))

    keys = ["part", "section", "block"]
    schema = "part int, section int, block int, place int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    whole = found.drop("ids").groupBy(*keys).applyInArrow(check, schema)
    if with_ids:
        parts = found.groupBy(*keys, "place").agg(F.array_sort(F.collect_list(F.struct("cut", "ids"))).alias("cuts"))
        ids = parts.select(*keys, "place", F.flatten(F.transform("cuts", lambda c: c["ids"])).alias("ids"))
        whole = whole.join(ids, [*keys, "place"])
    return whole.drop("section", "block", "place")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and (by choice) ids.

    `start` counts the ids of all documents before it in ascending order of doc_id. Sections are
    decoded where they are read, those with a long block in ranges of checkpoints by several tasks; only
    one total a part is added up beyond that. A damaged block raises.
    """
    stored = spark.read.schema(SCHEMA).parquet(folder)
    totals = stored.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("total")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(  # one row a part
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")
    )
    schema = "part int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                raw = decoded(row).astype("<u4")
                ends = offsets_of(np.array(row["n_tokens"], np.int64))
                out = {
                    "part": pa.array(np.full(len(ends) - 1, row["part"], np.int32)),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "inside": pa.array(row["first_token"] + ends[:-1]),
                    "n_tokens": pa.array(row["n_tokens"], pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])], pa.int64()
                    ),
                }
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(raw.astype(np.int32))
                    )
                yield pa.RecordBatch.from_pydict(out)

    short = stored.where(F.col("longest") <= WHOLE_STEPS).mapInArrow(run, schema)
    rows = short.unionByName(_long_documents(stored, with_ids)).join(offsets, "part")
    return rows.select(
        "doc_id",
        (F.col("offset") + F.col("inside")).alias("start"),
        *["n_tokens", "ids_crc32", *(["ids"] if with_ids else [])],
    )

"""Conversations brought into the order system, user, assistant, user, ... by the cheapest edits.

Edits: keep a message (K, 0), give it the role user or assistant (R, 2), delete it (D, 3; a must for
blank and repeated ones), insert an empty one of user or assistant (I, 2). Messages that end without
`.`, `!` or `?` add 1 unless deleted. The roles' initials must match `(s?(ua)+)?` in the end.

The least cost of what is left is a vector over the four states of that pattern. Less its smallest
entry only a few such vectors exist, so the step over any block of `BLOCK` messages is a table: block and
vector behind it give vector before it and cost. A conversation is read from its end, a lookup for
each block; then, from its start, each block is expanded backward from the vector behind it, which
tells for every message which edits are part of a cheapest repair, and the least letter is taken.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.sources.scratch import staged

#: Messages of a block; the table has 9 ** BLOCK rows.
BLOCK = 4

#: Characters of one conversation that a task holds; a longer one is treated like one on a border.
HELD_CHARACTERS = 8 << 20

# states: nothing yet, after s, after u, after a
NEXT = (2, 2, 3, 2)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
END = (0, 4, 2, 0)
ROLES = {2: "user", 3: "assistant"}

# symbols: a message that must go, or its initial and whether it is truncated
LETTERS = "uaso"
SYMBOLS = 1 + 2 * len(LETTERS)

_PIECE = re.compile(r"I*[DKR]|I+\Z")


def symbol_of(role: str, faulty: bool, truncated: bool) -> int:
    if faulty:
        return 0
    return 1 + 2 * LETTERS.index(role[0] if role[:1] in ("u", "a", "s") else "o") + truncated


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of one message in a state: letter, cost, state behind it; least letter first."""
    out = [("D", 3, state)]
    if symbol:
        letter, late = LETTERS[(symbol - 1) // 2], (symbol - 1) % 2
        if (state, letter) in STEP:
            out.append(("K", late, STEP[state, letter]))
        out.append(("R", 2 + late, NEXT[state]))
    return out


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a message by the costs behind it; at most two insertions before it can help."""
    bare = [min(cost + after[then] for _, cost, then in _edits(symbol, q)) for q in range(4)]
    return tuple(min(bare[q], 2 + bare[NEXT[q]], 4 + bare[NEXT[NEXT[q]]]) for q in range(4))


class Tables:
    """Vectors that occur, and the steps over one message and over a block for each of them."""

    def __init__(self) -> None:
        self.vectors = [END]
        places, rows = {END: 0}, []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                found = _before(symbol, vector)
                least = min(found)
                plain = tuple(c - least for c in found)
                if plain not in places:
                    places[plain] = len(self.vectors)
                    self.vectors.append(plain)
                row.append((places[plain], least))
            rows.append(row)
        steps = np.array(rows, np.int64).transpose(1, 0, 2)
        self.one, self.one_cost = steps[..., 0], steps[..., 1]
        self.block, self.block_cost = self.one, self.one_cost
        for _ in range(BLOCK - 1):  # a message before the block
            later = self.block
            self.block = self.one[:, later].reshape(-1, later.shape[1])
            self.block_cost = (self.block_cost[None] + self.one_cost[:, later]).reshape(-1, later.shape[1])

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """The table row of each whole block."""
        whole = len(symbols) // BLOCK * BLOCK
        return symbols[:whole].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1, dtype=np.int64))

    def backward(self, symbols: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Vector before the messages, cost, and the vector behind each block, for each vector `behind`."""
        codes = self.codes(symbols)
        at, cost = behind, np.zeros(len(behind), np.int64)
        for symbol in symbols[len(codes) * BLOCK :][::-1]:
            cost = cost + self.one_cost[symbol, at]
            at = self.one[symbol, at]
        borders = []
        for code in codes[::-1]:
            borders.append(at)
            cost = cost + self.block_cost[code, at]
            at = self.block[code, at]
        return at, cost, borders[::-1]

    def forward(self, symbols: np.ndarray, behind: int, borders: list[int], state: int) -> tuple[str, int]:
        """The least letters of a cheapest repair from `state` on, and the state behind the messages."""
        out = []
        for begin in range(0, len(symbols), BLOCK):
            block = symbols[begin : begin + BLOCK].tolist()
            at = borders[begin // BLOCK] if begin // BLOCK < len(borders) else behind
            vectors = [at]
            for symbol in block[:0:-1]:
                vectors.append(int(self.one[symbol, vectors[-1]]))
            for symbol, vector in zip(block, vectors[::-1]):
                letters, state = self.decide(symbol, vector, state)
                out.append(letters)
        return "".join(out), state

    @lru_cache(maxsize=None)
    def decide(self, symbol: int, behind: int, state: int) -> tuple[str, int]:
        """Letters for one message: D, I, K, R are tried in this order, the first that is cheapest stays."""
        after = self.vectors[behind]
        before = _before(symbol, after)
        letters = ""
        while True:
            edits = {letter: (cost + after[then], then) for letter, cost, then in _edits(symbol, state)}
            if edits["D"][0] == before[state]:
                return letters + "D", state
            if 2 + before[NEXT[state]] == before[state]:
                letters, state = letters + "I", NEXT[state]
                continue
            letter = "K" if edits.get("K", (None,))[0] == before[state] else "R"
            return letters + letter, edits[letter][1]


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def closing(state: int) -> str:
    """Insertions at the end."""
    return {1: "II", 2: "I"}.get(state, "")


def cheapest(symbols: np.ndarray) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    known = tables()
    at, cost, borders = known.backward(symbols, np.zeros(1, np.int64))
    letters, state = known.forward(symbols, 0, [int(b[0]) for b in borders], 0)
    return int(cost[0]) + known.vectors[int(at[0])][0], letters + closing(state)


class Writer:
    """Repaired messages from letters, one message after another."""

    def __init__(self) -> None:
        self.state = 0

    def messages(self, letters: str, role: str | None, text: str | None) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what the letters of one message (or of the end) leave."""
        for letter in letters:
            if letter == "D":
                continue
            if letter == "K":
                self.state = STEP[self.state, role[0]]
                yield letter, role, text
            else:
                self.state = NEXT[self.state]
                yield letter, ROLES[self.state], "" if letter == "I" else text


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = "".join(f", {c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"
_PASSED = (
    "kind int, key string, part int, pos bigint, turn bigint, role string, text string, is_blank boolean, "
    "is_truncated boolean, edit string" + _RESULT
)
_PASSED_ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("key", pa.string()), ("part", pa.int32()), ("pos", pa.int64()), ("turn", pa.int64()),
        ("role", pa.string()), ("text", pa.string()), ("is_blank", pa.bool_()), ("is_truncated", pa.bool_()),
        ("edit", pa.string()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ]
)
WHOLE, OPEN, MESSAGE = 0, 1, 2


class Run:
    """Counts over messages in order: turns, faults, initials."""

    def __init__(self) -> None:
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_initial = self.last_initial = None
        self.symbols: list[int] = []

    def add(self, turn: int | None, role: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        duplicate = duplicate and not blank
        truncated = truncated and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        initial = role[:1]
        if self.first_initial is None:
            self.first_initial = initial
        else:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        self.last_initial = initial
        self.symbols.append(symbol_of(role, blank or duplicate, truncated))

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def _judged(key: str, rows: list[tuple], part: int, messages: bool) -> list[dict]:
    """What is returned for a conversation that a task holds: turn, role, text, is_blank, is_truncated."""
    run, seen = Run(), set()
    for turn, role, text, blank, truncated in rows:
        run.add(turn, role, blank, (role, text) in seen, truncated)
        seen.add((role, text))
    cost, letters = cheapest(np.array(run.symbols, np.int64))
    writer, pieces = Writer(), _PIECE.findall(letters)
    repaired = []
    for place, piece in enumerate(pieces):
        role, text = rows[place][1:3] if place < len(rows) else (None, None)
        repaired.extend(writer.messages(piece, role, text))
    if messages:
        return [
            {"kind": MESSAGE, "key": key, "part": part, "pos": n, "edit": e, "role": r, "text": t}
            for n, (e, r, t) in enumerate(repaired)
        ]
    body = "\n".join(f"{r}:{t}" for _, r, t in repaired)
    counts = {c: getattr(run, c) for c in _COUNTS if c != "cost"}
    digest = hashlib.sha256(body.encode()).hexdigest()
    return [{"kind": WHOLE, "key": key, **counts, "cost": cost, "audit": letters, "repaired_sha256": digest}]


def _pass(messages: bool, held: int):
    """Over ordered messages: conversations inside a range are judged, those on its borders handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key, rows, size, live, opened, out = None, [], 0, 0, True, []

        def hand_on() -> None:
            nonlocal live
            for turn, role, text, blank, truncated in rows:
                out.append(
                    {
                        "kind": OPEN, "key": key, "part": part, "pos": live, "turn": turn, "role": role, "text": text,
                        "is_blank": blank, "is_truncated": truncated,
                    }
                )
                live += 1
            rows.clear()

        def mark() -> None:  # also for a conversation without messages
            out.append({"kind": OPEN, "key": key, "part": part, "pos": -1})

        first = True
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "gone", "turn", "role", "text", "is_blank", "is_truncated")]
            for k, gone, *row in zip(*columns):
                if k != key:
                    if key is not None:
                        if opened:
                            hand_on()
                        else:
                            out.extend(_judged(key, rows, part, messages))
                            rows.clear()
                    opened = first  # the first one may have begun in the range before
                    key, size, live, first = k, 0, 0, False
                    if opened:
                        mark()
                if not gone:
                    rows.append(tuple(row))
                    size += len(row[1]) + len(row[2])
                if not opened and size > held:
                    opened = True
                    mark()
                if opened:
                    hand_on()
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=_PASSED_ARROW)
                    out.clear()
        if key is not None:  # the last one may go on in the next range
            if not opened:
                mark()
            hand_on()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_PASSED_ARROW)

    return run


def _plain(conversations: DataFrame) -> DataFrame:
    """key, turn, role, text, gone: nulls of role and text are one space, a null conversation is one."""
    space = F.lit(" ")
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("key"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.lit(False).alias("gone"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """`_plain` rows with planted faults, by the checksum of conversation and turn.

    Of 20 remainders: 0 drops the message (the row stays, as `gone`), 1 empties its text, 2 removes its
    `.`, `!` and `?`, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = conversations.select("*", (F.crc32(name.cast("binary")) % 20).alias("kind"))
    kept = F.col("kind")
    text = F.coalesce("text", space)
    rows = kind.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("key"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kept == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kept == 1, F.lit("")).when(kept == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kept == 0).alias("gone"),
        F.explode(F.when(kept == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def _passed(rows: DataFrame, messages: bool, held: int = HELD_CHARACTERS) -> DataFrame:
    """The stored result of one pass over the messages in order of conversation and turn."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.select(
        "*",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("is_blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("is_truncated"),
        F.substring("text", 1, 256).alias("head"),
        F.xxhash64("role", "text").alias("hash"),
        F.xxhash64(F.monotonically_increasing_id()).alias("spread"),  # equal rows may stand in any order
    )
    keys = [
        F.col("key"), F.col("turn").asc_nulls_first(), *[F.col(c) for c in ("role", "head", "hash", "spread")]
    ]
    ordered = marked.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    columns = ordered.select("key", "gone", "turn", "role", "text", "is_blank", "is_truncated")
    return staged(columns.mapInArrow(_pass(messages, held), _PASSED), "conversations")


def _frame(schema: str, rows: list[dict]) -> pa.Table:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    lists = {"array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.Table.from_pylist(rows, schema=pa.schema([(n, (kinds | lists)[t]) for n, t in fields]))


_SEGMENT = (
    "key string, part int, first_turn bigint, last_turn bigint, turns bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, first_initial string, last_initial string, at array<int>, cost array<int>"
)
_RIGHT = "key string, part int, behind int" + "".join(f", {c} bigint" for c in _COUNTS)
_TRACED = "key string, part int, leave array<int>, letters array<string>"
_ENTRY = "key string, part int, entry int, closing string"


def _segment(table: pa.Table) -> pa.Table:
    """One conversation's messages of one range: their counts, and their step for every vector behind them."""
    run = Run()
    columns = ("pos", "turn", "role", "is_blank", "again", "is_truncated")
    for pos, *row in zip(*[table.sort_by("pos").column(c).to_pylist() for c in columns]):
        if pos >= 0:
            run.add(*row)
    known = tables()
    at, cost, _ = known.backward(np.array(run.symbols, np.int64), np.arange(len(known.vectors)))
    names = [f.split()[0] for f in _SEGMENT.split(", ")][2:-2]
    row = {"key": table["key"][0].as_py(), "part": table["part"][0].as_py(), **{c: getattr(run, c) for c in names}}
    return _frame(_SEGMENT, [{**row, "at": at.tolist(), "cost": cost.tolist()}])


def _rights(table: pa.Table) -> pa.Table:
    """The vector behind each range of a conversation, and the conversation's counts; a row for each range."""
    rows = table.sort_by("part").to_pylist()
    known, behind, cost = tables(), 0, 0
    out = []
    for row in rows[::-1]:
        out.append({"key": row["key"], "part": row["part"], "behind": behind})
        cost += row["cost"][behind]
        behind = row["at"][behind]
    counts = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
    counts["cost"] = cost + known.vectors[behind][0]
    initials = [(r["first_initial"], r["last_initial"]) for r in rows if r["first_initial"] is not None]
    counts["illegal"] += sum(a[1] + b[0] not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [(r["first_turn"], r["last_turn"], r["turns"]) for r in rows if r["first_turn"] is not None]
    different = sum(t[2] for t in turns) - sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
    counts["gaps"] = turns[-1][1] - turns[0][0] + 1 - different if turns else 0
    return _frame(_RIGHT, [{**r, **counts} for r in out])


def _traced(table: pa.Table) -> pa.Table:
    """Edits of one range from each of the four states before it, and the state behind it."""
    table = table.sort_by("pos")
    symbols = np.array([s for s, p in zip(table["symbol"].to_pylist(), table["pos"].to_pylist()) if p >= 0], np.int64)
    behind, known = table["behind"][0].as_py(), tables()
    _, _, borders = known.backward(symbols, np.array([behind]))
    found = [known.forward(symbols, behind, [int(b[0]) for b in borders], q) for q in range(4)]
    row = {"key": table["key"][0].as_py(), "part": table["part"][0].as_py()}
    return _frame(_TRACED, [{**row, "leave": [q for _, q in found], "letters": [x for x, _ in found]}])


def _entries(table: pa.Table) -> pa.Table:
    """The state before each range of a conversation, and what is inserted at its end."""
    state, out = 0, []
    for row in table.sort_by("part").to_pylist():
        out.append({"key": row["key"], "part": row["part"], "entry": state, "closing": ""})
        state = row["leave"][state]
    out[-1]["closing"] = closing(state)
    return _frame(_ENTRY, out)


def _over_ranges(opened: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that lie in several ranges: counts and audit of each, and letters for each message.

    A message repeats an earlier one if it is not the first of its role and text, which an aggregate
    finds. Each range of a conversation is reduced to its step for every vector behind it; those steps
    are chained over the ranges, backward for the vectors and forward for the states.
    """
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    place = F.struct("part", "pos")
    first = (
        opened.where("pos >= 0")
        .groupBy("key", content.alias("content"))
        .agg(F.min(place).alias("first"))
        .select("key", "first.part", "first.pos", F.lit(True).alias("is_first"))
    )
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("u", "a", "s"), F.instr(F.lit(LETTERS[:3]), initial)).otherwise(4)
    rows = opened.join(first, ["key", "part", "pos"], "left").select(
        "key", "part", "pos", "turn", "role", "is_blank", F.col("is_first").isNull().alias("again"), "is_truncated",
        F.when(F.col("is_blank") | F.col("is_first").isNull(), 0)
        .otherwise(2 * letter - 1 + F.col("is_truncated").cast("int")).alias("symbol"),
    )
    rows = staged(rows, "symbols")
    segments = rows.groupBy("key", "part").applyInArrow(_segment, _SEGMENT)
    rights = staged(segments.groupBy("key").applyInArrow(_rights, _RIGHT), "behind")
    narrow = rows.select("key", "part", "pos", "symbol").join(rights.select("key", "part", "behind"), ["key", "part"])
    traced = staged(narrow.groupBy("key", "part").applyInArrow(_traced, _TRACED), "traced")
    entries = traced.select("key", "part", "leave").groupBy("key").applyInArrow(_entries, _ENTRY)
    letters = traced.join(entries, ["key", "part"]).select(
        "key", "part", F.concat(F.get("letters", F.col("entry")), F.col("closing")).alias("letters")
    )
    letters = staged(letters, "letters")
    audits = letters.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("part", "letters"))).alias("ranges"))
    audits = audits.select("key", F.array_join(F.transform("ranges", lambda x: x["letters"]), "").alias("audit"))
    counts = rights.groupBy("key").agg(*[F.first(c).alias(c) for c in _COUNTS])
    return counts.join(audits, "key"), letters


def _ordered_edits(opened: DataFrame, letters: DataFrame) -> DataFrame:
    """The messages of conversations in several ranges with their letters, in order inside partitions."""
    pieces = letters.select("key", "part", F.posexplode(F.expr(r"regexp_extract_all(letters, 'I*[DKR]|I+$', 0)")).alias("pos", "edits"))
    met = pieces.withColumn("pos", F.col("pos").cast("bigint")).join(
        opened.where("pos >= 0").select("key", "part", "pos", "role", "text"), ["key", "part", "pos"], "left"
    )
    return met.repartition("key").sortWithinPartitions("key", "part", "pos").select("key", "part", "pos", "edits", "role", "text")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key and digest of each repaired conversation; messages pass one after another."""
    key, digest, writer, begun = None, None, None, False
    for batch in batches:
        keys, hashes = [], []
        for k, edits, role, text in zip(*[batch.column(c).to_pylist() for c in ("key", "edits", "role", "text")]):
            if k != key:
                if key is not None:
                    keys.append(key)
                    hashes.append(digest.hexdigest())
                key, digest, writer, begun = k, hashlib.sha256(), Writer(), False
            for _, new_role, new_text in writer.messages(edits, role, text):
                digest.update((("\n" if begun else "") + f"{new_role}:{new_text}").encode())
                begun = True
        if keys:
            yield pa.RecordBatch.from_pydict({"key": keys, "repaired_sha256": hashes})
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "repaired_sha256": [digest.hexdigest()]})


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired messages in order: key, part, pos, edit, role, text."""
    key, writer, number = None, None, 0
    for batch in batches:
        out = []
        for k, part, edits, role, text in zip(*[batch.column(c).to_pylist() for c in ("key", "part", "edits", "role", "text")]):
            if k != key:
                key, writer, number = k, Writer(), 0
            for edit, new_role, new_text in writer.messages(edits, role, text):
                out.append({"key": k, "pos": number, "edit": edit, "role": new_role, "text": new_text})
                number += 1
        if out:
            yield pa.RecordBatch.from_pylist(
                out, schema=pa.schema([("key", pa.string()), ("pos", pa.int64()), *[(c, pa.string()) for c in ("edit", "role", "text")]])
            )


def _with_id(frame: DataFrame, conversations: DataFrame) -> DataFrame:
    kind = conversations.schema["conv_id"].dataType
    back = F.when(F.col("key") != "null", F.col("key")).cast(kind)
    return frame.select(back.alias("conv_id"), *[c for c in frame.columns if c != "key"])


def audit_conversations(
    conversations: DataFrame, planted: bool = False, held: int = HELD_CHARACTERS
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    `conversations` has conv_id, turn, role and text; with `planted` faults are put in first
    (`damaged`). Messages stand in order of turn, nulls first; equal turns go by role, then by the
    start of the text. A null conv_id is a conversation of its own, null roles and texts are one
    space. `gaps`: turns missing between the smallest and the largest. Each message counts for its
    first fault: blank, duplicate (role and text seen before), truncated. `illegal`: neighbours whose
    initials are not su, ua or au. `cost` and `audit`: the cheapest edits, the least letters on ties;
    an empty role has no initial that fits. `repaired_sha256`: of the repaired `role:text`, joined by
    line feeds. Without messages: zeros, no letters, hash of nothing. Repeated rows are messages;
    other columns are not read; an empty table gives an empty result.

    Messages are dealt by ranges of their order. Conversations inside a range are repaired where they
    are; those on a border, or of more than `held` characters, are reduced to steps of the block tables
    range by range, so one with a third of all messages spans a third of the ranges. Only its hash
    needs its texts one after another: they stream through one task.
    """
    rows = damaged(conversations) if planted else _plain(conversations)
    passed = _passed(rows, False, held)
    opened = passed.where(F.col("kind") == OPEN)
    whole = passed.where(F.col("kind") == WHOLE)
    counts, letters = _over_ranges(opened)
    hashes = _ordered_edits(opened, letters).mapInArrow(_hashed, "key string, repaired_sha256 string")
    nothing = hashlib.sha256(b"").hexdigest()
    joined = counts.join(hashes, "key", "left").withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(nothing)))
    names = ["key", *_COUNTS, "audit", "repaired_sha256"]
    return _with_id(whole.select(names).unionByName(joined.select(names)), conversations)


def repaired_messages(conversations: DataFrame, planted: bool = False) -> DataFrame:
    """conv_id, pos (from 0), edit (K, R or I), role and text of the messages of the repaired conversations.

    The same repair as that of `audit_conversations`, for the same rows; conversations of which nothing
    is left have none.
    """
    rows = damaged(conversations) if planted else _plain(conversations)
    passed = _passed(rows, messages=True)
    opened = passed.where(F.col("kind") == OPEN)
    _, letters = _over_ranges(opened)
    schema = "key string, pos bigint, edit string, role string, text string"
    across = _ordered_edits(opened, letters).mapInArrow(_rewritten, schema)
    inside = passed.where(F.col("kind") == MESSAGE).select("key", "pos", "edit", "role", "text")
    return _with_id(inside.unionByName(across), conversations)

"""Conversation repair: block tables against plain programming and full search, whole tables against a plain version."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np

from isotherm.llm import conversations as c
from isotherm.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, part int, pos int, cost int"
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def plain_best(symbols: list[int]) -> tuple[int, str]:
    """(cost, letters) by a table over messages and states, letters carried along."""
    step = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}

    def inserted(best):
        for _ in range(4):
            for q, (cost, text) in list(best.items()):
                for letter in "ua":
                    if (q, letter) in step:
                        new = (cost + 2, text + "I")
                        then = step[q, letter]
                        if then not in best or new < best[then]:
                            best[then] = new
        return best

    best = inserted({"0": (0, "")})
    for symbol in symbols:
        new: dict = {}
        for q, (cost, text) in best.items():
            options = [(3, "D", q)]
            if symbol:
                letter, late = "uaso"[(symbol - 1) // 2], (symbol - 1) % 2
                if (q, letter) in step:
                    options.append((late, "K", step[q, letter]))
                options += [(2 + late, "R", step[q, x]) for x in "ua" if (q, x) in step]
            for extra, mark, then in options:
                found = (cost + extra, text + mark)
                if then not in new or found < new[then]:
                    new[then] = found
        best = inserted(new)
    return min(best[q] for q in ("0", "3") if q in best)


def full_search(symbols: list[int]) -> tuple[int, str]:
    """Every script of up to two insertions before each message and at the end."""
    choices = []
    for symbol in symbols:
        one = [("D", 3, "")]
        if symbol:
            letter, late = "uaso"[(symbol - 1) // 2], (symbol - 1) % 2
            one += [("K", late, letter), ("R", 2 + late, "u"), ("R", 2 + late, "a")]
        choices.append([(n * "I" + e, 2 * n + cost, "".join(x) + out) for n in range(3) for x in itertools.product("ua", repeat=n) for e, cost, out in one])
    choices.append([(n * "I", 2 * n, "".join(x)) for n in range(3) for x in itertools.product("ua", repeat=n)])
    return min(
        (sum(x[1] for x in script), "".join(x[0] for x in script))
        for script in itertools.product(*choices)
        if re.fullmatch("(s?(ua)+)?", "".join(x[2] for x in script))
    )


def test_block_tables_give_the_cheapest_least_repair():
    for n in range(3):
        for symbols in itertools.product(range(c.SYMBOLS), repeat=n):
            assert c.cheapest(np.array(symbols, np.int64)) == full_search(symbols)
    rng = random.Random(3)
    for _ in range(1500):
        symbols = [rng.choice([0, 1, 1, 2, 3, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randint(0, 40))]
        assert c.cheapest(np.array(symbols, np.int64)) == plain_best(symbols)


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_audit(rows, planted=True):
    """The whole operator on a list of rows; rows with equal turns have the same role and text, or ordered roles."""
    groups = defaultdict(list)
    for conv_id in {r[0] for r in rows}:
        groups[conv_id] = []
    for conv_id, turn, role, text in plain_damage(rows) if planted else rows:
        groups[conv_id].append((turn, role, text))
    out = {}
    for conv_id, messages in groups.items():
        messages.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        counts, seen, symbols = [0, 0, 0], set(), []
        for _, role, text in messages:
            solid = SPACE.findall(text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            initial = "uas".find(role[0]) if role and role[0] in "uas" else 3
            symbols.append(0 if fault in (0, 1) else 1 + 2 * initial + (fault == 2))
        turns = {m[0] for m in messages if m[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:]))
        cost, audit = plain_best(symbols)
        repaired, rest = [], iter(messages)
        for letter in audit:
            message = next(rest) if letter != "I" else None
            last = repaired[-1][0][0] if repaired else ""
            if letter == "K":
                repaired.append(message[1:])
            elif letter in "IR":
                repaired.append(("assistant" if last == "u" else "user", "" if letter == "I" else message[2]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def audited(frame):
    rows = frame.collect()
    found = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in rows}
    assert len(found) == len(rows)
    return found


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["One.", "Two", "", " \t", "One. ", "Why?", "Stop!  \n", None, " ", "a.b", "Ünder.", "x\ny."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "user", "assistant"]
    rows = []
    for conv_id in [None, *range(conversations)]:
        turn = rng.randint(0, 3)
        for _ in range(rng.randint(0, longest)):
            rows.append((conv_id, None if rng.random() < 0.02 and not any(r[0] == conv_id for r in rows[-longest:]) else turn, rng.choice(roles), rng.choice(texts)))
            turn += rng.choice([1, 1, 1, 2])
    return rows


def test_tables_of_many_conversations(spark):
    rows = random_rows(1, 400, 12)
    frame, expected = frame_of(spark, rows), plain_audit(rows)
    assert audited(c.audit_conversations(frame, planted=True)) == expected
    assert audited(c.audit_conversations(frame, planted=True, held=20)) == expected  # most are too long to be held


def test_one_conversation_over_many_ranges(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", "", f"Text {t}.", f"Text {t}"])) for t in range(4000)]
    rows += random_rows(6, 30, 8)
    rows = [r for r in rows if r[0] != 7 or len(r[3] or "") != 2 or r[1] % 3]
    found = audited(c.audit_conversations(frame_of(spark, rows), planted=True))
    assert found == plain_audit(rows)
    passed = c._passed(c.damaged(frame_of(spark, rows)), messages=False)
    assert passed.where("key = '7'").select("part").distinct().count() >= 4  # no single task held it
    messages = c.repaired_messages(frame_of(spark, rows), planted=True).where("conv_id = 7").orderBy("pos").collect()
    assert [m["pos"] for m in messages] == list(range(len(messages)))
    body = "\n".join(f"{m['role']}:{m['text']}" for m in messages)
    assert hashlib.sha256(body.encode()).hexdigest() == found[7][-1]
    assert re.fullmatch("(s?(ua)+)?", "".join(m["role"][0] for m in messages))


def test_equal_rows_and_long_conversations(spark):
    rows = [(1, 5, "user", "Same.")] * 3000 + [(2, 1, "user", "A."), (2, 1, "assistant", "B."), (None, None, None, None)]
    assert audited(c.audit_conversations(frame_of(spark, rows))) == plain_audit([(a, b, r or " ", t or " ") for a, b, r, t in rows], planted=False)


def test_empty_and_dropped(spark):
    assert audited(c.audit_conversations(frame_of(spark, []), planted=True)) == {}
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    rows = [(gone, 0, "user", "Hello.")]
    assert audited(c.audit_conversations(frame_of(spark, rows), planted=True)) == {gone: nothing}
    many = [(i, 0, "user", "Hello.") for i in range(1000)]
    assert audited(c.audit_conversations(frame_of(spark, many), planted=True))[gone] == nothing


def test_registered_query(spark, sf_middle):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_middle}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert audited(queries.QUERIES["op11_four_russians"](spark, sf_middle)) == plain_audit(rows)

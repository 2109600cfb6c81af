"""Repair of conversations against an exhaustive search over the grammar's automaton."""

import hashlib
import itertools
import random
import zlib
from functools import cache

import pytest

from siltstone.llm import structure_repair as sr

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # start, after system, after user, after assistant


def by_automaton(symbols):
    """Cheapest (cost, audit), by trying every edit at every place."""

    @cache
    def rest(i, state, inserted):
        options = []
        if i == len(symbols) and state in (0, 3):
            options.append((0, ""))
        if inserted < 4:
            cost, audit = rest(i, NEXT[state], inserted + 1)
            options.append((cost + 3, "I" + audit))
        if i < len(symbols):
            forced, cut = symbols[i] & sr.FORCED, 3 if symbols[i] & sr.CUT_OFF else 0
            cost, audit = rest(i + 1, state, 0)
            options.append((cost + 4, "D" + audit))
            if not forced:
                initial = symbols[i] & 3
                if initial == 0 and state == 0:
                    cost, audit = rest(i + 1, 1, 0)
                    options.append((cost + cut, "K" + audit))
                to = NEXT[state]
                cost, audit = rest(i + 1, to, 0)
                same = initial == {2: 1, 3: 2}[to]
                options.append((cost + cut + (0 if same else 3), ("K" if same else "R") + audit))
        return min(options, default=(10**9, ""))

    return rest(0, 0, 0)


KINDS = [i | f for i in range(4) for f in (sr.SOUND, sr.CUT_OFF)] + [sr.FORCED | 1]


@pytest.mark.parametrize("turns", [0, 1, 2, 3, 4])
def test_all_short_conversations(turns):
    for symbols in itertools.product(KINDS, repeat=turns):
        assert sr.Alignment(bytes(symbols)).best() == by_automaton(symbols)


def test_longer_conversations():
    rng = random.Random(3)
    for n in [5, 7, 9, 12, 20, 33, 60] * 6:
        regular = [0] * rng.randint(0, 1) + [1, 2] * (n // 2)
        symbols = bytes(
            s if rng.random() < 0.7 else rng.choice(KINDS) for s in regular if rng.random() < 0.9
        )
        assert sr.Alignment(symbols).best() == by_automaton(symbols)


def test_long_conversation():
    rng = random.Random(4)
    symbols = bytes(rng.choice([1, 2]) if rng.random() < 0.05 else 1 + i % 2 for i in range(2000))
    cost, audit = sr.repair(symbols)
    assert sum(e != "I" for e in audit) == 2000
    assert cost == sum({"K": 0, "I": 3, "R": 3, "D": 4}[e] for e in audit) > 0


def expected(rows):
    """Rows of the report from plain Python over (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            fault = zlib.crc32(key.encode()) % 20
            if fault == 1:
                text = ""
            if fault == 2:
                text = "".join(c for c in text if c not in ".!?")
            if fault == 4:
                role = "user"
            turns += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
        turns.sort(key=lambda t: (
            t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()
        ))
        counts, symbols, seen = [0, 0, 0], [], set()
        for _, role, text in turns:
            bare = text.rstrip(" \t\n\v\f\r")
            fault = None
            if not bare:
                fault = 0
            elif (role, text) in seen:
                fault = 1
            elif bare[-1] not in ".!?":
                fault = 2
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            symbols.append(sr.symbol(role, {None: sr.SOUND, 2: sr.CUT_OFF}.get(fault, sr.FORCED)))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        cost, audit = by_automaton(tuple(symbols))
        lines, left, place = [], iter(turns), None
        for edit in audit:
            if edit != "I":
                turn = next(left)
            if edit == "D":
                continue
            if edit == "K" and place is None and turn[1][:1] == "s":
                lines.append(f"{turn[1]}:{turn[2]}")
                place = "s"
                continue
            place = "a" if place == "u" else "u"
            role = {"u": "user", "a": "assistant"}[place]
            lines.append({"K": lambda: f"{turn[1]}:{turn[2]}", "R": lambda: f"{role}:{turn[2]}",
                          "I": lambda: f"{role}:"}[edit]())
        out[conv] = (
            gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def conversations():
    rng = random.Random(9)
    texts = ["Yes.", "No!", "and then", " ", "", None, "Why?", "Tell me more. ", "漢字。", "a.b", "\v\f", " "]
    rows = []
    for conv in range(120):
        n = rng.randint(1, 9)
        for turn in range(n):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.8 else rng.choice(
                ["system", "tool", "", None, "user", "unknown"])
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.6 else f"Number {rng.random()}."))
    rows += [(500, None, "user", "a."), (500, None, "assistant", "b."), (500, 9, "user", "c."), (500, 3, "user", "d.")]
    rows += [(501, 1, "user", "same."), (501, 1, "user", "same."), (501, 1, "assistant", "x."), (501, 2, "user", "same.")]
    rows += [(None, 0, "user", "no id."), (None, None, None, None), (502, None, None, None)]
    rows += [(503, 0, "system", "word " * 200_000 + "."), (503, 1, "user", "q" * 500_000)]
    rows += [(600 + i, 0, "user", "Only one.") for i in range(200)]  # some lose their only row
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_report(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS c", "2 AS copies", "'x' AS digest", "3 AS `a.b`")
    got = {r[0]: tuple(r[1:]) for r in sr.repaired(sr.damaged(df.repartition(5))).collect()}
    want = expected(rows)
    assert got == want
    nothing = hashlib.sha256(b"").hexdigest()
    assert (0, 0, 0, 0, 0, 0, "", nothing) in got.values()


def test_without_damage(spark):
    rows = [("x", 0, "user", "Hi."), ("x", 1, "user", "Hi there."), ("y", 0, "assistant", "Hello.")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r.conv_id: r for r in sr.repaired(sr.turns_of(df)).collect()}
    assert (got["x"].cost, got["x"].audit, got["x"].illegal) == (3, "KR", 1)
    assert (got["y"].cost, got["y"].audit) == (3, "IK")
    assert got["y"].repaired_sha256 == hashlib.sha256(b"user:\nassistant:Hello.").hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert sr.repaired(sr.damaged(df)).collect() == []

"""Conversation structure repair by alignment to the strings of an alternating grammar.

A repaired conversation's role initials are ``(s?(ua)+)?``. Each feasible length of
that grammar gives one target string; the turns are aligned to it by the
Wagner-Fischer recurrence over keeping, re-roling, deleting and inserting turns. The
best cost so far bounds the diagonals that the next target has to visit (Ukkonen), or
rules the target out. Of the cheapest targets, the one whose backtraced audit (the
initials of the edits) comes first in ASCII order is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.llm.common import slices

INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
BLANK_SPACE = "\x20\x09\x0A\x0B\x0C\x0D"
ENDS = ".!?"
#: Kinds of a turn: one symbol each, so that a conversation is a byte string. The
#: lower bits are the role's initial, then the fault that counts.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER_INITIAL = 3
SOUND, CUT_OFF, FORCED = 0, 4, 8
#: Larger than any cost, small enough to be added to.
NEVER = np.int64(1) << 60
ROLE_NAMES = {"u": "user", "a": "assistant"}


def target(system: bool, pairs: int) -> bytes:
    return bytes(([0] if system else []) + [1, 2] * pairs)


class Alignment:
    """Turns given as symbols, aligned to one target after the other."""

    def __init__(self, symbols: bytes):
        self.symbols = symbols
        self.forced = [s & FORCED != 0 for s in symbols]
        self.cut_off = [s & (CUT_OFF | FORCED) == CUT_OFF for s in symbols]
        #: Turns that may stay, before each position: the main diagonal.
        self.free = [0]
        for forced in self.forced:
            self.free.append(self.free[-1] + (not forced))
        self.truncated = sum(self.cut_off)
        #: What any alignment costs: forced deletions and the surcharge of the rest.
        self.floor = DELETE * sum(self.forced) + TRUNCATED * self.truncated

    def deletions_cost(self, n: int) -> int:
        """The least that deleting n free turns adds to the floor."""
        cheap = min(n, self.truncated)
        return cheap * (DELETE - TRUNCATED) + (n - cheap) * DELETE

    def offset_cost(self, offset: int) -> int:
        """The least excess of a path that leaves the diagonal by ``offset``."""
        return INSERT * offset if offset >= 0 else self.deletions_cost(-offset)

    def bound(self, length: int) -> int:
        return self.floor + self.offset_cost(length - self.free[-1])

    def band(self, length: int, most: int) -> tuple[int, int] | None:
        """Least and largest diagonal that a path of cost ``most`` or less may touch."""
        excess, end = most - self.floor, length - self.free[-1]
        if self.offset_cost(end) > excess:
            return None
        low, high = min(0, end), max(0, end)
        while self.deletions_cost(1 - low) + INSERT * (end - low + 1) <= excess:
            low -= 1
        while INSERT * (high + 1) + self.deletions_cost(high + 1 - end) <= excess:
            high += 1
        return low, high

    def costs(self, goal: bytes, band: tuple[int, int]) -> list[tuple[int, np.ndarray]]:
        """For each turn, the first target position in the band and the costs to go."""
        n, length = len(self.symbols), len(goal)
        low, high = band
        roles = np.frombuffer(goal, np.uint8)
        # A system turn is neither inserted nor re-roled to, only kept.
        insert = np.where(roles == 0, NEVER, INSERT).astype(np.int64)
        rerole = np.where(roles == 0, NEVER, REROLE).astype(np.int64)
        to_end = np.concatenate([np.cumsum(insert[::-1])[::-1], [0]])
        first = max(0, self.free[n] + low)
        rows = [(first, np.minimum(to_end[first : min(length, self.free[n] + high) + 1], NEVER))]
        for i in range(n - 1, -1, -1):
            first, last = max(0, self.free[i] + low), min(length, self.free[i] + high)
            after_first, after = rows[-1]
            padded = np.full(last - first + 2, NEVER, np.int64)  # costs to go from turn i + 1
            begin = max(first, after_first)
            end = min(last + 2, after_first + len(after))
            if begin < end:
                padded[begin - first : end - first] = after[begin - after_first : end - after_first]
            here = padded[:-1] + DELETE
            if not self.forced[i]:
                stop = min(last + 1, length)
                extra = TRUNCATED if self.cut_off[i] else 0
                change = np.where(roles[first:stop] == self.symbols[i] & 3, 0, rerole[first:stop])
                here[: stop - first] = np.minimum(
                    here[: stop - first], padded[1 : stop - first + 1] + change + extra
                )
            # Insertions run along the target: cost to go through later positions.
            shift = to_end[first : last + 1]
            here = np.minimum.accumulate((here - shift)[::-1])[::-1] + shift
            rows.append((first, np.minimum(here, NEVER)))
        return rows[::-1]

    def audit(self, goal: bytes, rows: list[tuple[int, np.ndarray]]) -> str:
        """The cheapest edits' initials that come first in ASCII order (D, I, K, R)."""

        def at(i: int, j: int) -> int:
            first, row = rows[i]
            return int(row[j - first]) if 0 <= j - first < len(row) else int(NEVER)

        i, j, out = 0, 0, []
        while i < len(self.symbols) or j < len(goal):
            here = at(i, j)
            if i < len(self.symbols) and here == at(i + 1, j) + DELETE:
                i, edit = i + 1, "D"
            elif j < len(goal) and goal[j] and here == at(i, j + 1) + INSERT:
                j, edit = j + 1, "I"
            else:
                edit = "K" if self.symbols[i] & 3 == goal[j] else "R"
                i, j = i + 1, j + 1
            out.append(edit)
        return "".join(out)

    def best(self) -> tuple[int, str]:
        """Cost and audit over every target."""
        free = self.free[-1]
        # Deleting all is always possible: it bounds how long a target need be.
        most = self.floor + self.deletions_cost(free)
        widest = free + (most - self.floor) // INSERT
        targets = [b""] + [
            target(system, pairs)
            for pairs in range(1, widest // 2 + 1) for system in (False, True)
            if system + 2 * pairs <= widest and (not system or 0 in {s & 3 for s in self.symbols})
        ]
        targets.sort(key=lambda t: (self.bound(len(t)), len(t), t))
        audit = None
        for goal in targets:
            if self.bound(len(goal)) > most:
                break
            # From the diagonal outwards: a narrow band first finds a cost, which
            # then tells how wide the band has to be.
            guess = min(most, self.bound(len(goal)) + 16)
            while True:
                rows = self.costs(goal, self.band(len(goal), guess))
                cost = int(rows[0][1][0]) if rows[0][0] == 0 and len(rows[0][1]) else int(NEVER)
                if cost <= guess or guess == most:
                    break
                guess = min(most, cost, self.floor + 2 * (guess - self.floor) + 16)
            if cost > most:
                continue
            found = self.audit(goal, rows)
            if cost < most or audit is None or found < audit:
                audit = found
            most = cost
        return most, audit


@lru_cache(maxsize=20_000)
def _best_short(symbols: bytes) -> tuple[int, str]:
    return Alignment(symbols).best()


def repair(symbols: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a conversation.

    Conversations of a few turns repeat, so their results are kept.
    """
    return _best_short(symbols) if len(symbols) <= 16 else Alignment(symbols).best()


def symbol(role: str, fault: int) -> int:
    """A turn's symbol. A role that is empty or of another initial cannot be kept."""
    return INITIALS.get(role[:1], OTHER_INITIAL) | fault


class Conversation:
    """What a task holds of a conversation: a symbol per turn, and once the audit is
    known the running digest of the repaired text."""

    def __init__(self, key: int | None):
        self.key = key
        self.symbols = bytearray()
        self.seen: set[tuple[str, bytes]] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last_initial: str | None = None
        self.least = self.most = self.turn = None
        self.turns = 0
        self.edits = None

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, cut_off: bool) -> None:
        if turn is not None:
            self.turns += self.turn != turn
            self.turn = self.most = turn
            self.least = turn if self.least is None else self.least
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        self.last_initial = initial
        if blank:
            fault, self.blank = FORCED, self.blank + 1
        elif (role, digest) in self.seen:
            fault, self.duplicate = FORCED, self.duplicate + 1
        elif cut_off:
            fault, self.truncated = CUT_OFF, self.truncated + 1
        else:
            fault = SOUND
        self.seen.add((role, digest))
        self.symbols.append(symbol(role, fault))

    def settle(self) -> None:
        """Find the repair; texts may follow."""
        self.seen.clear()
        self.cost, self.audit = repair(bytes(self.symbols))
        self.edits = iter(self.audit)
        self.system = bool(self.symbols) and self._begins_with_system()
        self.digest, self.written = hashlib.sha256(), 0

    def _begins_with_system(self) -> bool:
        turn = 0
        for edit in self.audit:
            if edit != "D":
                return edit == "K" and self.symbols[turn] & 3 == 0
            turn += 1
        return False

    def _goal(self) -> str:
        place = self.written - self.system
        return "s" if place < 0 else "ua"[place % 2]

    def _write(self, role: str, text: bytes) -> None:
        self.digest.update(b"\n" * (self.written > 0) + role.encode() + b":" + text)
        self.written += 1

    def text(self, role: str, text: bytes) -> None:
        """The next turn, in order."""
        for edit in self.edits:
            if edit == "I":
                self._write(ROLE_NAMES[self._goal()], b"")
                continue
            if edit == "K":
                self._write(role, text)
            elif edit == "R":
                self._write(ROLE_NAMES[self._goal()], text)
            return

    def row(self) -> tuple:
        for _ in self.edits:  # only insertions are left
            self._write(ROLE_NAMES[self._goal()], b"")
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            self.audit, self.digest.hexdigest(),
        )


REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def turns_of(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", copies: Column | None = None) -> DataFrame:
    """The columns that ``repaired`` reads: ``c, turn, role, text, copies``.

    Null roles and texts are one space. ``copies`` tells how often a turn stands in
    the conversation: a conversation all of whose rows have 0 is still reported.
    """
    return rows.select(
        F.col(conversation).alias("c"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("int").alias("copies"),
    )


def damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``turns_of`` with faults put in, as told by crc32 of ``conversation:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes
    its role user. Nulls are one space, also in the key.
    """
    named = turns_of(rows, conversation, turn, role, text)
    key = F.concat(
        F.coalesce(F.col("c").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    fault = F.crc32(key) % 20
    return named.select(
        "c", "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def repaired(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation: its faults, the cheapest repair and the repaired digest.

    ``turns`` is as ``turns_of`` gives it. Turns go by number, nulls first; equal
    numbers by role, then by the SHA-256 of the text. A turn's first fault counts:
    blank, duplicate (role and text seen earlier), truncated. Rows of a null
    conversation are one conversation. No turns give zeros and the digest of nothing;
    an empty table gives no rows. Other columns are not read.

    The digest runs over one conversation in order, so its turns meet in one task.
    Each turn comes twice: first without its text, which gives the audit from a byte a
    turn (and a digest a turn, for the copies), then with it, to be hashed and let go.
    So no text is held, however long conversations are.
    """
    digest = F.unhex(F.sha2("text", 256))
    last = F.right(F.rtrim("text", F.lit(BLANK_SPACE)), F.lit(1))
    marked = turns.withColumns({"digest": digest, "last": last}).select(
        "c", "turn", "role", "digest", (F.col("last") == "").alias("blank"),
        (~F.col("last").isin(*ENDS)).alias("cut_off"), "copies", "text",
    )
    both = marked.select(
        "c", "turn", "role", "digest", "blank", "cut_off", "copies",
        F.explode(F.when(F.col("copies") > 0, F.array(F.lit(None).cast("string"), F.col("text")))
                  .otherwise(F.array(F.lit(None).cast("string")))).alias("text"),
    ).withColumn("later", F.col("text").isNotNull())
    order = ["c", "later", "turn", "role", "digest"]
    together = both.repartition("c").sortWithinPartitions(*order)
    kind = turns.schema["c"].dataType
    names = [conversation, *(c.split(" ")[0] for c in REPORT.split(", "))]
    schema = f"c {kind.simpleString()}, {REPORT}"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        done: list[tuple] = []
        for batch in slices(batches):
            columns = [batch.column(n).to_pylist() for n in
                       ("c", "turn", "role", "digest", "blank", "cut_off", "copies", "text")]
            for c, turn, role, own, blank, cut_off, copies, text in zip(*columns):
                if now is None or now.key != c:
                    if now is not None:
                        done.append(_finished(now))
                    now = Conversation(c)
                if text is None:
                    for _ in range(copies):
                        now.add(turn, role, own, blank, cut_off)
                    continue
                if now.edits is None:
                    now.settle()
                content = text.encode()
                for _ in range(copies):
                    now.text(role, content)
            if done:
                yield _batch(done)
                done = []
        if now is not None:
            yield _batch([_finished(now)])

    def _finished(conversation: Conversation) -> tuple:
        if conversation.edits is None:
            conversation.settle()
        return conversation.row()

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * 7 + [pa.string()] * 2
        columns = [pa.array(c, t) for c, t in zip(list(zip(*rows))[1:], types[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], to_arrow_type(kind)), *columns],
            names=["c", *names[1:]],
        )

    return together.mapInArrow(walk, schema).withColumnRenamed("c", conversation)


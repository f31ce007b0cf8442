"""Repair of conversation structure by a streamed dynamic program.

A conversation in order is ``(s?(ua)+)?`` over the initials of its roles: an
optional system turn, then user and assistant in turn. Edits: Keep (0), Rerole to
user or assistant (2), Delete (3; blank rows and repetitions must go), Insert an
empty user or assistant turn (2); a truncated row that stays adds 1. The cheapest
edits win, among them those whose initials are least in ASCII.

How the work is split: rows are partitioned by conversation and sorted by turn
inside their partition, and ``mapInPandas`` runs over the Arrow batches. What it
carries from row to row does not grow with the conversation: of four states (no
turn yet, after system, after user, after assistant) the cheapest cost, the order
of their edits, and a running SHA-256 of the text that they would leave. Costs
enter relative to the cheapest and their edits by rank, so the steps are those of
a small automaton that is built as it is met. The way back takes four bytes a
row; every ``SPILL`` rows go to an unnamed scratch file of the task, which
nothing else reads and which ends with it. A repetition of an earlier row is found
without a set of what was seen: (conversation, digest) pairs are aggregated to
their first turn, and only the later ones enter the stream, as marks before the
rows of their turn.

Why the order of edits can be kept by rank: after i rows, strings of edits that
end with the i-th row's letter are never prefixes of one another, so whatever
follows can't change their order.

The SHA-256 of a conversation's repaired text is one chain over its bytes, so one
task reads a conversation, however long; its memory stays bounded.

Edge cases: null roles, texts, turns and conv_ids count as one space where they
are text; rows of the null conv_id are one conversation; null turns come first,
rows with the same turn are ordered by role and text; a conversation of which no
row is left has zeros, an empty audit and the empty string's hash; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import tempfile
from array import array
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.llm import common

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = ("su", "ua", "au")
SPILL = 1 << 20
OUT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after one more user or assistant turn, and that turn's role.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Turns to insert at the end.
CLOSE = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Whatever follows, one state does as well as another for so much more: an inserted turn leads from user to assistant
#: and back, and a conversation that has begun can only not keep one system row. A dearer state is never the cheapest.
SLACK = {START: {ASSISTANT: DELETE, USER: DELETE + INSERT}, SYSTEM: {ASSISTANT: 0, USER: INSERT},
         USER: {ASSISTANT: INSERT}, ASSISTANT: {USER: INSERT}}


def _moves(state: int, initial: str, gone: bool, cut: bool) -> Iterator[tuple[int, int, str]]:
    """(cost, state after it, initials) of the ways over one row: up to two inserted turns, then the row's own edit."""
    for inserted in range(3):
        before, cost = "I" * inserted, INSERT * inserted
        yield cost + DELETE, state, before + "D"
        if not gone:
            if initial == "s" and state == START:
                yield cost + KEEP + TRUNCATED * cut, SYSTEM, before + "K"
            elif initial and initial == ROLE[TURN[state]][0]:
                yield cost + KEEP + TRUNCATED * cut, TURN[state], before + "K"
            yield cost + REROLE + TRUNCATED * cut, TURN[state], before + "R"
        state = TURN[state]


class Automaton:
    """Steps of the dynamic program: (relative costs and ranks of the states, kind of row) -> the same after it."""

    def __init__(self):
        self.steps: list[tuple] = []           # (cost added, next vector, {state: (state before, initials)})
        self.known: dict[tuple, int] = {}

    def step(self, vector: tuple, row: tuple) -> int:
        """Number of the step; ``vector`` holds (state, cost, rank) of the states that can be reached."""
        number = self.known.get((vector, row))
        if number is None:
            best: dict[int, tuple] = {}
            for state, cost, rank in vector:
                for more, after, initials in _moves(state, *row):
                    way = (cost + more, rank, initials, state)
                    if after not in best or way < best[after]:
                        best[after] = way
            best = {s: w for s, w in best.items()
                    if all(w[0] <= best[by][0] + more for by, more in SLACK[s].items() if by in best)}
            least = min(w[0] for w in best.values())
            order = sorted(best, key=lambda s: best[s][1:3])
            after = tuple((s, best[s][0] - least, order.index(s)) for s in sorted(best))
            number = self.known[vector, row] = len(self.steps)
            self.steps.append((least, after, {s: (w[3], w[2]) for s, w in best.items()}))
        return number


FIRST = ((START, 0, 0),)


class Way:
    """Numbers of the steps taken, of which the older ones lie in a scratch file."""

    def __init__(self, spill: int = SPILL):
        self.spill, self.tail, self.file = spill, array("I"), None

    def append(self, number: int) -> None:
        self.tail.append(number)
        if len(self.tail) >= self.spill:
            self.file = self.file or tempfile.TemporaryFile()
            self.tail.tofile(self.file)
            self.tail = array("I")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.tail)
        if self.file:
            size = self.spill * self.tail.itemsize
            for at in range(self.file.seek(0, 2) - size, -1, -size):
                self.file.seek(at)
                block = array("I")
                block.fromfile(self.file, self.spill)
                yield from reversed(block)
            self.file.close()


class Conversation:
    """One conversation as it streams by."""

    def __init__(self, conv: str, automaton: Automaton, spill: int = SPILL):
        self.conv, self.automaton, self.way = conv, automaton, Way(spill)
        self.vector, self.cost, self.hashes = FIRST, 0, {START: sha256()}
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = self.last_digest = self.last_initial = None
        self.turns, self.later = 0, set()

    def _at(self, turn: int | None) -> None:
        if turn != self.turn:
            self.turn, self.last_digest = turn, None
            self.later.clear()

    def mark(self, turn: int | None, digest: bytes) -> None:
        """Rows of this digest at this turn repeat an earlier one."""
        self._at(turn)
        self.later.add(digest)

    def row(self, turn: int | None, role: str, text: str, digest: bytes) -> None:
        self._at(turn)
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        said = text.rstrip(SPACES)
        gone, cut = True, False
        if not said:
            self.blank += 1
        elif digest in self.later or digest == self.last_digest:
            self.duplicate += 1
        else:
            gone, cut = False, said[-1] not in STOPS
            self.truncated += cut
        initial = role[:1]
        self.illegal += self.last_initial is not None and self.last_initial + initial not in LEGAL
        self.last_digest, self.last_initial = digest, initial

        number = self.automaton.step(self.vector, (initial if initial in ("s", "u", "a") else "", gone, cut))
        more, self.vector, ways = self.automaton.steps[number]
        self.cost += more
        self.way.append(number)
        old, self.hashes = self.hashes, {}
        for state, (before, initials) in ways.items():
            self.hashes[state] = _written(old[before], before, initials, role, text)

    def result(self) -> tuple:
        ends = [(cost + INSERT * CLOSE[state], rank, state) for state, cost, rank in self.vector]
        more, _, state = min(ends)
        tail = "I" * CLOSE[state]
        left = _written(self.hashes[state], state, tail)
        audit = [tail]
        for number in self.way.backwards():
            state, initials = self.automaton.steps[number][2][state]
            audit.append(initials)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + more,
                "".join(reversed(audit)), left.hexdigest())


def _written(hashed, state: int, initials: str, role: str = "", text: str = ""):
    """``hashed`` (of what stands in ``state``) with the turns that ``initials`` add."""
    if initials == "D" or not initials:
        return hashed
    hashed = hashed.copy()
    for x in initials:
        if x == "D":
            continue
        after = SYSTEM if x == "K" and state == START and role[:1] == "s" else TURN[state]
        shown = role if x == "K" else ROLE[after]
        hashed.update(f"{'' if state == START else chr(10)}{shown}:{'' if x == 'I' else text}".encode())
        state = after
    return hashed


ROW, MARK = "row", "mark"


def _stream(spill: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, now = Automaton(), None
        names = ["conv", *OUT, "audit", "repaired_sha256"]
        for frame in frames:
            done = []
            for conv, turn, kind, role, text, digest in zip(*[frame[c] for c in ("conv", "turn", "kind", "role", "text", "digest")]):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv, automaton, spill)
                turn = int(turn) if turn else None
                if kind == ROW:
                    now.row(turn, role, text, digest)
                elif kind == MARK:
                    now.mark(turn, digest)
            yield pd.DataFrame(done, columns=names)
        if now is not None:
            yield pd.DataFrame([now.result()], columns=names)
    return run


def repaired(rows: DataFrame, lost: Column | None = None, spill: int = SPILL) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): its faults, the cheapest edits and what they leave.

    Rows where ``lost`` holds only stand for their conversation.
    """
    there = F.lit(True) if lost is None else ~lost
    blank = F.lit(" ")
    own = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, ROW).otherwise("lost").alias("kind"), F.when(there, F.coalesce("role", blank)).alias("role"),
        F.when(there, F.coalesce("text", blank)).alias("text"))
    own = own.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    seen = own.where(F.col("kind") == ROW).select("conv", "digest", "turn").distinct()
    spread = seen.groupBy("conv", "digest").agg(F.min("turn").alias("first"), F.count("turn").alias("known"), F.count(F.lit(1)).alias("turns")
                                                ).where("turns > 1")
    later = seen.join(spread, ["conv", "digest"]).where("turn > first OR (turn IS NOT NULL AND known < turns)")
    marks = later.select("conv", "turn", F.lit(MARK).alias("kind"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), "digest")
    order = ["conv", F.col("turn").asc_nulls_first(), "kind", "role", "text"]
    sorted_rows = own.union(marks).repartition("conv").sortWithinPartitions(*order)
    kind = rows.schema["conv_id"].dataType
    out = sorted_rows.withColumn("turn", F.col("turn").cast("string")).mapInPandas(
        _stream(spill), "conv string, " + ", ".join(f"{c} long" for c in OUT) + ", audit string, repaired_sha256 string")
    return out.select(F.when(F.col("conv") != "", F.col("conv").cast(kind)).alias("conv_id"), *OUT, "audit", "repaired_sha256")


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` with faults by the CRC-32 of ``conv_id:turn`` modulo 20 (nulls: one space), and the mark of lost ones."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hit = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    text = F.coalesce("text", F.lit(" "))
    out = rows.select("conv_id", "turn", hit.alias("hit"), F.when(hit == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                      F.when(hit == 1, "").when(hit == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"))
    twice = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return out.withColumn("copy", twice), F.col("hit") == 0


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its result for every conversation of the damaged table."""
    return repaired(*damage(common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))

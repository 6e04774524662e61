"""Repair of the turn structure of conversations at least cost.

A sound conversation is empty or reads: perhaps a system turn, then pairs of a
user and an assistant turn. Edits make it so: Keep a row (0), Rerole it to user
or assistant (1), Delete it (2; the only edit for blank rows and for repeated
ones), Insert an empty user or assistant turn (5); a truncated row that stays
costs 5 more. Of the cheapest edit strings the ASCII-least is taken.

Rows are dealt by conversation and sorted by turn once; ``mapInPandas`` then
streams them and carries over Arrow batches, per conversation, four states
(nothing yet, after a system turn, after a user turn, after an assistant turn)
with cost, rank among equals and a running digest of the repaired text. A state
that another one surely beats is dropped, so the costs of the states differ by a
few units only and the steps from one row to the next are finitely many: a step
is worked out once and a row's back-pointer is the 16-bit number of its step. Back-pointers beyond a million rows of one
conversation go to a file in the folder that Spark gives the executor for
spilling, and are read backwards at the conversation's end. So the memory of a
task does not grow with a conversation, but for the edit string, a letter a row.
Repeated rows are found before, by a window over (conversation, role, text) on
the same partitioning. One conversation is one task by the method named: its
digest runs over its whole text in order.

Defined cases: a null text or role counts as one blank, a null turn comes first,
a null conversation id is one conversation; rows of one turn follow one another
by role and text, equal ones are interchangeable; other columns are ignored;
conversations of which no row is present give zeros, an empty edit string and
the digest of an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opticart.llm.common import ship

RETAG, DELETE, INSERT, CUT = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}

# states of the output: nothing, ...system, ...user, ...assistant
START, SYSTEM, USER, ASSISTANT = range(4)
_FINAL = (START, ASSISTANT)
_INSERTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: b"user:", ASSISTANT: b"assistant:"}
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
         (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}

GONE = ""                    # kind of a row that has to be deleted
SPILL_AT = 1 << 20           # back-pointers of one conversation held in memory

OUT = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, "
       "cost long, audit string, repaired_sha256 string")


class _Steps:
    """The steps between states, each worked out at its first use.

    A ``position`` gives, for each state reached by an edit of a row, (cost
    above the least, rank among the edit strings), or None. A step holds the
    position after it, the rise of the least cost and, per state, the move that
    led there: (state before, inserts before the row, letter, text before the
    row's own, whether the row keeps its role).
    """

    FIRST = ((0, 0), None, None, None)

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.steps: list[tuple] = []

    def number(self, position: tuple, kind: str) -> int:
        found = self.numbers.get((position, kind))
        if found is None:
            found = self.numbers[position, kind] = len(self.steps)
            self.steps.append(self._work_out(position, kind))
        return found

    @staticmethod
    def ways(position: tuple) -> Iterator[tuple]:
        """(cost, rank, state before, inserts, state, text inserted) of a position."""
        for before, held in enumerate(position):
            if held is None:
                continue
            cost, rank = held
            state, text = before, b""
            for inserts in range(3):
                yield cost + INSERT * inserts, rank, before, inserts, state, text
                text += (b"" if state == START else b"\n") + _ROLE[_INSERTED[state]]
                state = _INSERTED[state]

    def _work_out(self, position: tuple, kind: str) -> tuple:
        best: dict[int, tuple] = {}

        def offer(state: int, key: tuple, move: tuple) -> None:
            if state not in best or key < best[state][0]:
                best[state] = key, move

        for cost, rank, before, inserts, state, text in self.ways(position):
            lead = "I" * inserts
            offer(state, (cost + DELETE, rank, lead + "D"), (before, inserts, "D", text, False))
            if kind == GONE:
                continue
            extra = CUT if kind[1] == "-" else 0
            gap = text + (b"" if state == START else b"\n")
            after = _KEPT.get((state, kind[0]))
            if after is not None:
                offer(after, (cost + extra, rank, lead + "K"), (before, inserts, "K", gap, True))
            after = _INSERTED[state]
            offer(after, (cost + extra + RETAG, rank, lead + "R"),
                  (before, inserts, "R", gap + _ROLE[after], False))
        self._drop_beaten(best)
        least = min(key[0] for key, _ in best.values())
        order = sorted(best, key=lambda s: best[s][0][1:])
        position = tuple((best[s][0][0] - least, order.index(s)) if s in best else None
                         for s in range(4))
        return position, least, tuple(best[s][1] if s in best else None for s in range(4))

    @staticmethod
    def _drop_beaten(best: dict[int, tuple]) -> None:
        """Drop states whose every completion costs more than one of another state.

        After an assistant turn all goes on as at the start, but that a system turn
        cannot stay (2 to delete it), and as after a system turn; inserts lead from
        a user turn to an assistant turn and on.
        """
        cost = {s: best[s][0][0] if s in best else float("inf") for s in range(4)}
        answered = min(cost[ASSISTANT], cost[USER] + INSERT)
        limits = {START: answered + DELETE, SYSTEM: answered, ASSISTANT: answered,
                  USER: min(cost[s] for s in (START, SYSTEM, ASSISTANT)) + INSERT}
        for state, limit in limits.items():
            if state in best and cost[state] > limit:
                del best[state]


_steps = _Steps()


class _Pointers:
    """Step numbers of one conversation, the older ones in a file of the executor."""

    def __init__(self) -> None:
        self.held = array("H")
        self.file = None
        self.blocks = 0

    def append(self, number: int) -> None:
        self.held.append(number)
        if len(self.held) >= SPILL_AT:
            if self.file is None:
                # the folders that Spark hands to its workers for spilled data
                folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
                self.file = tempfile.TemporaryFile(dir=folder)
            self.held.tofile(self.file)
            self.file.flush()
            self.blocks += 1
            self.held = array("H")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.held)
        width = SPILL_AT * self.held.itemsize
        for block in range(self.blocks - 1, -1, -1):
            self.file.seek(block * width)
            numbers = array("H")
            numbers.frombytes(self.file.read(width))
            yield from reversed(numbers)
        if self.file is not None:
            self.file.close()


class _Conversation:
    """What is carried from row to row of one conversation."""

    def __init__(self) -> None:
        self.position, self.cost = _Steps.FIRST, 0
        self.digests: list = [hashlib.sha256(), None, None, None]
        self.pointers = _Pointers()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns = 0
        self.initial: str | None = None

    def row(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.high = turn
                self.turns += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        said = text.rstrip(BLANKS)
        if not said:
            self.blank += 1
            kind = GONE
        elif repeated:
            self.duplicate += 1
            kind = GONE
        else:
            whole = said[-1] in ENDS
            self.truncated += not whole
            kind = (initial if initial in ("s", "u", "a") else "?") + ("+" if whole else "-")
        number = _steps.number(self.position, kind)
        self.pointers.append(number)
        self.position, rise, moves = _steps.steps[number]
        self.cost += rise
        body = None if kind == GONE else text.encode()
        digests = []
        for move in moves:
            if move is None:
                digests.append(None)
                continue
            before, _, letter, lead, own = move
            digest = self.digests[before]
            if letter != "D" or lead:
                digest = digest.copy()
                digest.update(lead)
                if own:
                    digest.update(role.encode() + b":")
                if letter != "D":
                    digest.update(body)
            digests.append(digest)
        self.digests = digests

    def result(self, conv_id: str | None) -> tuple:
        cost, _, state, inserts, _, text = min(
            way for way in _Steps.ways(self.position) if way[4] in _FINAL)
        digest = self.digests[state].copy()
        digest.update(text)
        audit = bytearray(b"I" * inserts)
        for number in self.pointers.backwards():
            state, inserts, letter, _, _ = _steps.steps[number][2][state]
            audit += letter.encode() + b"I" * inserts
        audit.reverse()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                self.cost + cost, audit.decode(), digest.hexdigest())


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One result per conversation from rows that come conversation by conversation."""
    now, at = None, None
    columns = [part.split()[0] for part in OUT.split(", ")]
    for frame in frames:
        done = []
        for conv_id, turn, untimed, role, text, present, repeated in zip(
                *(frame[c].tolist() for c in frame.columns)):
            if now is None or conv_id != at:
                if now is not None:
                    done.append(now.result(at))
                now, at = _Conversation(), conv_id
            if present:
                now.row(None if untimed else turn, role, text, repeated)
        yield pd.DataFrame(done, columns=columns)
    if now is not None:
        yield pd.DataFrame([now.result(at)], columns=columns)


def _rows(convs: DataFrame, present: str | None) -> DataFrame:
    """The operator's own columns, dealt by conversation; ``nth`` counts equal rows."""
    def own(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(" "))

    there = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    rows = convs.select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(there, own("role")).otherwise("").alias("role"),
        F.when(there, own("text")).otherwise("").alias("text"), there.alias("present"))
    same = Window.partitionBy("conv_id", "present", F.xxhash64("role", "text"), "role", "text")
    return rows.repartition("conv_id").withColumn(
        "nth", F.row_number().over(same.orderBy("turn")))


def repair(convs: DataFrame, present: str | None = None) -> DataFrame:
    """Per conversation: its faults, the cheapest edits and the digest of the repaired text.

    ``convs`` has conv_id, turn, role, text. Rows for which the column
    ``present`` is not true only name their conversation.
    """
    ship(convs.sparkSession)
    ordered = (_rows(convs, present)
               .sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
               .select("conv_id", F.coalesce("turn", F.lit(0)).alias("turn"),
                       F.col("turn").isNull().alias("untimed"), "role", "text", "present",
                       (F.col("nth") > 1).alias("repeated")))
    return (ordered.mapInPandas(_stream, OUT)
            .withColumn("conv_id", F.col("conv_id").cast(convs.schema["conv_id"].dataType)))


def repaired_turns(convs: DataFrame, reports: DataFrame, present: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place from 0, edit, role, text.

    ``reports`` is the result of ``repair`` on the same rows.
    """
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy("turn", "role", "text", "nth")
    rows = (_rows(convs, present).where("present")
            .select("conv_id", F.row_number().over(order).alias("at"),
                    F.col("role").alias("own"), "text"))
    so_far = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edits = (reports.where(F.length("audit") > 0)
             .select(F.col("conv_id").cast("string").alias("conv_id"),
                     F.posexplode(F.split("audit", "")).alias("step", "edit"))
             .where(F.col("edit") != "")
             .withColumn("at", F.sum((F.col("edit") != "I").cast("long")).over(so_far))
             .where(F.col("edit") != "D"))
    joined = edits.join(rows.withColumnRenamed("conv_id", "c"),
                        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("edit") != "I")
                        & (edits["at"] == rows["at"]), "left")
    led = (F.col("place") == 0) & (F.col("edit") == "K") & F.col("own").startswith("s")
    placed = (joined.withColumn("place", F.row_number().over(whole.orderBy("step")) - 1)
              .withColumn("lead", F.max(led.cast("int")).over(whole)))
    named = F.when((F.col("place") - F.col("lead")) % 2 == 0, "user").otherwise("assistant")
    return placed.select(
        F.col("conv_id").cast(convs.schema["conv_id"].dataType).alias("conv_id"),
        F.col("place").cast("long").alias("place"), "edit",
        F.when(F.col("edit") == "K", F.col("own")).otherwise(named).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))


def damaged(convs: DataFrame) -> DataFrame:
    """Rows harmed by crc32(conv_id:turn) mod 20: 0 dropped (``present`` false), 1 emptied,
    2 without sentence ends, 3 doubled, 4 made a user's."""
    def own(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn"))) % 20
    return convs.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(own("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(own("text"), "[.!?]", ""))
        .otherwise(own("text")).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")

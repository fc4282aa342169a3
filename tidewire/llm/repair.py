"""Conversation structure repair: the cheapest edits that make roles alternate, as a dynamic programme over sorted turns.

A repaired conversation is empty, or an optional system turn followed by pairs of a user and an assistant turn. Turns are
kept, given another role, or deleted, and empty turns are inserted; see :class:`Costs`.

1. Faults of turns, and each turn's place in its conversation, are window functions over conversations. Text is read there
   and goes no further: what follows sees role initials and faults.
2. Conversations are dealt out, turns sorted by place, and streamed. Only four things can be true of what was put out so
   far (nothing, a system turn, ends with a user, ends with an assistant), so the state is four costs and their order. It is
   carried from batch to batch. One byte per turn and state says where it came from; those of a giant conversation are
   compressed block by block. At the end of a conversation they are followed back.
3. The edits meet the turns again by conversation and place. That join has no hot keys, and the texts never meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches

#: The six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
#: Turns whose backpointers stay uncompressed, and edits put out at once.
BLOCK_TURNS = 1 << 16
#: Faults of a turn, in the order in which they count.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
EDITS = (
    "conv string, place long, at long, edit string, new_role string, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, audit string"
)
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
LARGEST = 2**63 - 1


@dataclass(frozen=True)
class Costs:
    """What edits cost. A truncated turn that is not deleted costs ``truncated`` more; blank and repeated ones must go."""

    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


# What was put out so far.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Edits of one turn with the insertion before it, as they stand in the audit.
LETTERS = ("D", "K", "R", "IK", "IR")


def moves(initial: str) -> list[tuple[int, int, int]]:
    """(state before, state after, number of the edit in :data:`LETTERS`) for a turn with a role of that initial.

    Insertions stand right before a turn that is not deleted or at the end: the same edits with an insertion before a
    deletion cost as much, and come later in the order of audits.
    """
    found = [(state, state, 0) for state in range(4)]
    if initial == "s":
        found.append((NOTHING, SYSTEM, 1))
    for state in range(4):
        follows = ASSISTANT if state == USER else USER
        other = USER if state == USER else ASSISTANT
        named = {"u": USER, "a": ASSISTANT}.get(initial)
        if named == follows:
            found.append((state, follows, 1))
        elif named == other:
            found.append((state, other, 3))
        found += [(state, follows, 2), (state, other, 4)]
    return found


#: Insertions at the end that complete what was put out.
ENDINGS = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
NAMES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}


class Repair:
    """The edits of one conversation, from its turns one after the other."""

    def __init__(self, costs: Costs):
        self.costs = costs
        insert, rerole = costs.insert, costs.rerole
        self.price = (costs.delete, 0, rerole, insert, insert + rerole)
        self.moves: dict[str, list[tuple[int, int, int]]] = {}
        # For each state: the cost, and where the edits so far stand among those of the other states.
        self.live: dict[int, tuple[int, int]] = {NOTHING: (0, 0)}
        self.pointers, self.packed = bytearray(), []
        self.turns = 0

    def add(self, initial: str, fault: int) -> None:
        if initial not in self.moves:
            self.moves[initial] = moves(initial)
        must_go, extra = fault in (BLANK, DUPLICATE), self.costs.truncated * (fault == TRUNCATED)
        best: dict[int, tuple[int, int, str, int, int]] = {}
        for before, after, edit in self.moves[initial]:
            if before in self.live and not (must_go and edit):
                cost, rank = self.live[before]
                offer = (cost + self.price[edit] + extra * (edit > 0), rank, LETTERS[edit], before, edit)
                if after not in best or offer < best[after]:
                    best[after] = offer
        # Edits of two states never begin with one another, as both end with a turn's own letter: so their order is that
        # of the states before, then that of this turn's letters.
        order = sorted(best, key=lambda state: best[state][1:3])
        self.live = {state: (best[state][0], rank) for rank, state in enumerate(order)}
        self.pointers += bytes(best[s][3] << 3 | best[s][4] if s in best else 255 for s in range(4))
        self.turns += 1
        if len(self.pointers) == 4 * BLOCK_TURNS:
            self.packed.append(zstandard.compress(bytes(self.pointers), 1))
            self.pointers = bytearray()

    def end(self) -> tuple[int, np.ndarray, np.ndarray, str]:
        """(cost, edit of each turn, state after each turn, insertions at the end) of the cheapest, least edits."""
        prices = {s: cost + self.costs.insert * len(ENDINGS[s]) for s, (cost, _) in self.live.items()}
        state = last = min(self.live, key=lambda s: (prices[s], self.live[s][1]))
        edits, states = np.empty(self.turns, np.uint8), np.empty(self.turns, np.uint8)
        at = self.turns
        block = bytes(self.pointers)
        while at:
            for row in range(len(block) // 4 - 1, -1, -1):
                at -= 1
                pointer = block[4 * row + state]
                edits[at], states[at] = pointer & 7, state
                state = pointer >> 3
            block = zstandard.decompress(self.packed.pop()) if self.packed else b""
        return prices[last], edits, states, ENDINGS[last]


class Turns:
    """What the report of a conversation says of its turns, and its repair."""

    def __init__(self, conv: str | None, costs: Costs):
        self.conv, self.repair = conv, Repair(costs)
        self.first = self.last = self.before = None
        self.distinct = self.illegal = 0
        self.faults = [0] * 4

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.faults[fault] += 1
        self.repair.add(initial, fault)

    def rows(self) -> Iterator[tuple]:
        """Values of :data:`EDITS`: per turn, per turn inserted at the end, and without a place those of the report."""
        cost, edits, states, ending = self.repair.end()
        at, nothing = 0, (None,) * len(REPORT)
        for low in range(0, len(edits), BLOCK_TURNS):
            own = slice(low, low + BLOCK_TURNS)
            for place, (edit, state) in enumerate(zip(edits[own].tolist(), states[own].tolist()), low + 1):
                # An insertion before a turn takes a number of its own. A kept turn keeps its role, whatever its name.
                at += (edit > 0) + (edit > 2)
                yield self.conv, place, at, LETTERS[edit], NAMES[state] if edit in (2, 4) else None, *nothing
        # After a user comes an assistant, after a system turn alone comes a pair.
        for i, role in enumerate(["user", "assistant"][2 - len(ending) :], 1):
            yield self.conv, len(edits) + i, at + i, "I", role, *nothing
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.distinct, LARGEST)
        faults = (self.faults[f] for f in (BLANK, DUPLICATE, TRUNCATED))
        audit = "".join(map(LETTERS.__getitem__, edits.tolist())) + ending
        yield self.conv, None, None, None, None, gaps, *faults, self.illegal, cost, audit


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Of objects, so that whole numbers beside NULLs stay such."""
    columns = zip(*rows) if rows else [()] * len(names)
    return pd.DataFrame({name: np.array([*cells, None], object)[:-1] for name, cells in zip(names, columns)})


def edit_rows(turns: DataFrame, costs: Costs) -> DataFrame:
    """:data:`EDITS` for (conv, place, turn, initial, fault); a conversation with one row without place has no turns."""

    names = [c.split()[0] for c in EDITS.split(", ")]

    def conversations(batches: Iterator[pd.DataFrame]) -> Iterator[Turns]:
        now: Turns | None = None
        for batch in batches:
            cells = (batch[c].tolist() for c in ("conv", "turn", "timed", "initial", "fault", "gone"))
            for conv, turn, timed, initial, fault, gone in zip(*cells):
                if now is None or conv != now.conv:
                    if now is not None:
                        yield now
                    now = Turns(conv, costs)
                if not gone:
                    now.add(turn if timed else None, initial, fault)
        if now is not None:
            yield now

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for done in conversations(batches):
            for row in done.rows():
                held.append(row)
                if len(held) == BLOCK_TURNS:
                    yield _frame(held, names)
                    held = []
        yield _frame(held, names)

    narrow = turns.select(
        "conv", "place", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("timed"),
        "initial", "fault", "gone",
    )
    return narrow.repartition("conv").sortWithinPartitions("conv", "place").mapInPandas(work, EDITS)


def _judged(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    """Turns with ``place`` (from 1, in their conversation), role initial and fault."""
    missing = F.col(gone) if gone else F.lit(False)
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(conv_id).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"), F.coalesce(missing, F.lit(False)).alias("gone"),
    ).withColumn("_digest", F.unhex(F.sha2("text", 256)))
    order = [F.col("gone"), F.col("turn").asc_nulls_first(), "role", "_digest"]
    # Both windows use the one exchange by conversation.
    again = Window.partitionBy("conv", "gone", "role", "_digest").orderBy(F.col("turn").asc_nulls_first())
    place = Window.partitionBy("conv").orderBy(*order, "_copy")
    words = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(words == "", BLANK).when(F.col("_copy") > 1, DUPLICATE)
        .when(~F.substring(words, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    )
    placed = rows.repartition("conv").withColumn("_copy", F.row_number().over(again))
    placed = placed.withColumn("place", F.row_number().over(place).cast("long"))
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1))
    return placed.select("conv_id", "conv", "turn", "role", "text", "gone", "place", initial.alias("initial"), fault.alias("fault"))


@dataclass(frozen=True)
class Repaired:
    """``turns``: (conv_id, at, role, text, edit) of the repaired conversations, ``at`` from 1; ``report``: a row each."""

    turns: DataFrame
    report: DataFrame


def repair(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: str | None = None,
    costs: Costs = Costs(),
) -> Repaired:
    """The cheapest edits of each conversation, among those the ones whose initials come first in ASCII order.

    Turns stand in order of ``turn``, NULLs first; equal ones in order of role, then of the text's SHA-256. A turn has
    one fault: blank, or role and text as before in its conversation, or truncated (its last character that is no blank is
    none of ``.!?``). A NULL role or text is one space, so NULL, empty and blank texts are blank. A role that is neither
    system, user nor assistant by its initial (NULL and empty ones too) cannot be kept. Rows with a NULL ``conv_id`` are
    one conversation. Rows with ``gone`` are no turns, but their conversations are reported; one without turns has zeros
    and an empty audit. ``gaps`` beyond a long is the largest long. An empty table gives no rows. Other columns are not
    looked at. A giant conversation costs memory of some bytes per turn: for backpointers and for its audit, which is
    one value.
    """
    judged = materialize(_judged(turns, conv_id, turn, role, text, gone), "judged")
    bounded_batches(turns.sparkSession)
    edits = materialize(edit_rows(judged, costs), "edits")
    kind = judged.schema["conv_id"].dataType
    report = edits.where("place IS NULL").select(F.col("conv").cast(kind).alias("conv_id"), *REPORT)
    live = judged.where("NOT gone").select("conv", "place", "role", "text")
    script = edits.where("place IS NOT NULL AND edit != 'D'").select(
        F.coalesce("conv", F.lit("")).alias("_conv"), F.col("conv").isNull().alias("_null"), "place", "at", "edit", "new_role"
    )
    live = live.select(
        F.coalesce("conv", F.lit("")).alias("_conv"), F.col("conv").isNull().alias("_null"), "place", "role", "text"
    )
    met = script.join(live, ["_conv", "_null", "place"], "left")
    given = F.coalesce("new_role", "role")
    inserted = F.struct(
        (F.col("at") - 1).alias("at"),
        F.when(F.substring(given, 1, 1) == "u", "assistant").otherwise("user").alias("role"),
        F.lit("").alias("text"), F.lit("I").alias("edit"),
    )
    own = F.struct("at", given.alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.right("edit", F.lit(1)).alias("edit"))
    both = F.when(F.length("edit") > 1, F.array(inserted, own)).otherwise(F.array(own))
    found = met.select(F.when(~F.col("_null"), F.col("_conv")).cast(kind).alias("conv_id"), F.inline(both))
    return Repaired(found, report)


def _digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of ``role:text`` by newlines. Streamed: a conversation is never held as a whole."""
    names = ["conv", "repaired_sha256"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, running = None, None
        for batch in batches:
            out = []
            for conv, line in zip(batch["conv"].tolist(), batch["line"].tolist()):
                if running is None or conv != now:
                    if running is not None:
                        out.append((now, running.hexdigest()))
                    now, running = conv, hashlib.sha256(line.encode())
                else:
                    running.update(b"\n")
                    running.update(line.encode())
            yield _frame(out, names)
        yield _frame([(now, running.hexdigest())] if running is not None else [], names)

    lines = turns.select(F.col("conv_id").cast("string").alias("conv"), "at", F.concat_ws(":", "role", "text").alias("line"))
    dealt = lines.repartition("conv").sortWithinPartitions("conv", "at").select("conv", "line")
    return dealt.mapInPandas(work, "conv string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with some dropped (``gone``), emptied, without ends of sentences, repeated or given to the user.

    Which ones goes by crc32 of ``conv_id:turn`` modulo 20: 0 to 4 do the above. NULLs are one space.
    """

    def space(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    which = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(which == 1, "").when(which == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(which == 4, "user").otherwise(space("role"))
    times = F.when(which == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (which == 0).alias("gone"), F.explode(times).alias("_copy")
    ).drop("_copy")


def repair_digests(turns: DataFrame) -> DataFrame:
    """Per conversation: the report of its repair after the damage, and the digest of the repaired turns."""
    found = repair(damaged(turns), gone="gone")
    digests = _digests(found.turns)
    report = found.report.withColumn("conv", F.col("conv_id").cast("string"))
    met = report.join(digests.withColumnRenamed("conv", "_of"), F.col("conv").eqNullSafe(F.col("_of")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return met.select("conv_id", *REPORT, F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

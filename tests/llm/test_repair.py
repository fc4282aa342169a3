"""Conversation repair against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from tidewire.llm import repair
from tidewire.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if v is None else str(v) for v in (conv, turn, role, text))
        which, own = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20, out.setdefault(conv, [])
        text = "" if which == 1 else re.sub("[.!?]", "", text) if which == 2 else text
        own += [(turn, "user" if which == 4 else role, text)] * {0: 0, 3: 2}.get(which, 1)
    return out


def plain_repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        words = WORD.findall(text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "cut" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] or " " for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    names = {"u": "user", "a": "assistant"}

    @functools.cache
    def least(i, state, inserted):
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def take(cost, letter, line, rest):
            options.append((cost + rest[0], letter + rest[1], ((line,) if line is not None else ()) + rest[2]))

        for who in "ua":
            if inserted < 3 and state + who in ("u", "su", "ua", "au"):
                take(2, "I", f"{names[who]}:", least(i, who, inserted + 1))
        if i < len(rows):
            take(3, "D", None, least(i + 1, state, 0))
            if faults[i] in ("", "cut"):
                more = faults[i] == "cut"
                if state + initials[i] in ("s", "u", "su", "ua", "au"):
                    take(more, "K", f"{rows[i][1]}:{rows[i][2]}", least(i + 1, initials[i], 0))
                for who in "ua":
                    if state + who in ("u", "su", "ua", "au"):
                        take(2 + more, "R", f"{names[who]}:{rows[i][2]}", least(i + 1, who, 0))
        return min(options, key=lambda o: o[:2], default=(10**9, "~", ()))

    cost, audit, lines = least(0, "", 0)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "cut")), illegal, cost, audit, digest


def odd_conversations():
    rng, rows = random.Random(5), []
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "unit"]
    for conv in range(400):
        for turn in range(rng.randint(0, 9)):
            at = rng.choice([None, turn, turn, turn + 2]) if conv % 3 == 0 else turn
            text = rng.choice([None, "", "  ", "a.", "b", "c! ", "d?\t", "a.", f"e{turn}"])
            rows.append((conv or None, at, rng.choice(roles), text))
    return rows


def check(rows, found):
    expected = {conv: plain_repair(own) for conv, own in plain_damage(rows).items()}
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == expected


def test_repair_is_the_plain_search(spark):
    rows = odd_conversations()
    check(rows, repair.repair_digests(spark.createDataFrame(rows, SCHEMA)))


def test_blocks_of_backpointers(spark, monkeypatch):
    # Any conversation of more than two turns has compressed blocks.
    monkeypatch.setattr(repair, "BLOCK_TURNS", 2)
    machine = repair.Repair(repair.Costs())
    whole = repair.Repair(repair.Costs())
    rng = random.Random(2)
    turns = [(rng.choice("sua t"), rng.randrange(4)) for _ in range(101)]
    for turn in turns:
        machine.add(*turn)
    assert len(machine.packed) == 50
    monkeypatch.setattr(repair, "BLOCK_TURNS", 1 << 16)
    for turn in turns:
        whole.add(*turn)
    first, second = machine.end(), whole.end()
    assert first[0] == second[0] and first[3] == second[3]
    assert first[1].tolist() == second[1].tolist() and first[2].tolist() == second[2].tolist()


def test_batches_cut_conversations(spark):
    rows = odd_conversations()
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "3")
    try:
        check(rows, repair.repair_digests(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.set(key, before)


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "hi."), (1, 1, "user", "cut"), (1, 2, "user", "end."), (2, 0, "system", "be."), (3, 0, "user", " ")]
    wide = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", place long, conv string")
    found = repair.repair(wide)
    turns = sorted((r.conv_id, r["at"], r.role, r.text, r.edit) for r in found.turns.collect())
    # The turn that stops short goes, the rest is kept; what is missing is inserted empty.
    assert [t[1:] for t in turns if t[0] == 1][:2] == [(1, "user", "", "I"), (2, "assistant", "hi.", "K")]
    for conv in (1, 2, 3):
        roles = "".join(t[2][0] for t in turns if t[0] == conv)
        assert re.fullmatch("(s?(ua)+)?", roles)
    report = {r.conv_id: r for r in found.report.collect()}
    assert report[3].audit == "D" and report[3].blank == 1 and report[2].audit == "D"


def test_a_giant_conversation(spark):
    # All turns are the user's: the cheapest edits of two states never come from the same turn.
    rows = [(7, t, "user", f"{t}.") for t in range(3_001)]
    report = repair.repair(spark.createDataFrame(rows, SCHEMA)).report.first()
    assert report.cost == 3_002 and len(report.audit.replace("I", "")) == 3_001


def test_nothing(spark):
    assert repair.repair_digests(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, sf, folder):
    path = sf.replace("sf0.001", folder)
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(rows, QUERIES["op11_repair"](spark, path))

"""Conversation repair against a search from the end over all edits."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from driftline.llm import conversations as cv

BLANK = " \t\n\x0b\x0c\r"
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAME = {"u": "user", "a": "assistant"}


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            own += [(turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:])) for c, own in out.items()}


def solved(rows):
    sys.setrecursionlimit(20_000)
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.rstrip(BLANK)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @lru_cache(None)
    def least(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        ends = i == len(rows)
        cost, edits = (5 if not ends and faults[i] == "truncated" else 0), []
        for letter in "ua":
            if (state, letter) in AFTER:
                if inserted < 3:
                    edits.append((5, "I", f"{NAME[letter]}:", i, AFTER[state, letter], inserted + 1))
                if not ends and faults[i] not in ("blank", "duplicate"):
                    edits.append((1 + cost, "R", f"{NAME[letter]}:{rows[i][2]}", i + 1, AFTER[state, letter], 0))
        if not ends:
            edits.append((2, "D", None, i + 1, state, 0))
            if faults[i] not in ("blank", "duplicate") and (state, rows[i][1][:1]) in AFTER:
                edits.append((cost, "K", f"{rows[i][1]}:{rows[i][2]}", i + 1, AFTER[state, rows[i][1][:1]], 0))
        for own, edit, line, *rest in edits:
            if (after := least(*rest)) is not None:
                found.append((own + after[0], edit + after[1], ((line,) if line is not None else ()) + after[2]))
        return min(found, default=None)

    cost, audit, lines = least(0, 0, 0)
    turns = [t for t, *_ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    deal = random.Random(5)
    out = []
    for conv in range(260):
        for t in range(deal.randint(1, 13)):
            out.append((None if conv == 259 else conv, deal.choice([t, t, t, None, t // 2, t + 3]), deal.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "User", "ux"]), deal.choice(["hi.", "ok?", "no", " ", "", None, "a! ", "same.", "x\ny.", "é…", "b.\x0b\n"])))
    out += [(5000, t, ("user", "assistant")[t % 2], f"hi {t}." if t % 5 else "again.") for t in range(300)]  # longer than a segment
    out += [(5001, t, deal.choice(["user", "assistant"]), deal.choice(["hi.", "no"])) for t in range(90)]
    out += [(6000, 1, "user", "long " * 60_000 + "."), (6001, next(t for t in range(99) if zlib.crc32(f"6001:{t}".encode()) % 20 == 0), "user", "goes.")]
    return out


@pytest.mark.parametrize("segment", [None, 40, 1])
def test_repair_against_a_search(spark, rows, segment):
    turns = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, n long")
    got = cv.repair(cv.damaged(turns), segment).collect()
    want = {c: solved(own) for c, own in damage(rows).items()}
    assert {r.conv_id: tuple(r)[1:9] for r in got} == want and len(got) == len(want)


def test_batches_are_whole_and_empty_tables_have_no_rows(spark, rows, monkeypatch):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {r.conv_id: tuple(r) for r in cv.repair(cv.damaged(turns)).collect()}
    import pyarrow as pa

    monkeypatch.setattr(cv, "BATCH_ROWS", 3)
    ids = [1, 1, 2, 2, 2, 2, 2, None, None, 3]
    batches = [pa.record_batch({"k": pa.array(ids[a : a + 2], pa.int64())}) for a in range(0, 10, 2)]
    cut = [[t.column("k").to_pylist()[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)] for t, begin in cv._wholes(batches, 1)]
    assert [g for c in cut for g in c] == [[1, 1], [2] * 5, [None, None], [3]] and len(cut) > 1
    assert len(want) == len({r[0] for r in rows}) and cv.repair(cv.damaged(turns.limit(0))).count() == 0

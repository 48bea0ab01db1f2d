"""Conversation repair against plain versions of the damage, the faults and the search for edits."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import conversations as conv
from shelfwise.llm import queries

WORDY = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, step int, part string"


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv_id, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (
        r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        found = WORDY.findall(text)
        if not found:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def least_edits(rows, marks):
    """(cost, audit, repaired) by searching all edits in order of (cost, audit)."""
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, i, initials, lines = heapq.heappop(heap)
        tail = (i, initials[:1] == "s", initials[-1:], len(initials) > 0)
        if i == len(rows) and GRAMMAR.match(initials):
            return cost, audit, "\n".join(lines)
        if tail in done:
            continue
        done.add(tail)
        for role in ("user", "assistant"):
            step(heap, cost + 5, audit + "I", i, initials + role[0], (*lines, f"{role}:"))
        if i < len(rows):
            role, text = rows[i][2:]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, initials, lines))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 if marks[i] == "truncated" else 0
                if role:
                    step(heap, cost + more, audit + "K", i + 1, initials + role[0],
                         (*lines, f"{role}:{text}"))
                for new in ("user", "assistant"):
                    step(heap, cost + 1 + more, audit + "R", i + 1, initials + new[0],
                         (*lines, f"{new}:{text}"))
    raise AssertionError


def step(heap, cost, audit, i, initials, lines):
    if re.fullmatch(r"s?(ua)*u?", initials):
        heapq.heappush(heap, (cost, audit, i, initials, lines))


def plain(table):
    out = {}
    after = damaged(table)
    for conv_id in {r[0] for r in table}:
        rows = ordered(r for r in after if r[0] == conv_id)
        marks = faults(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        cost, audit, text = least_edits(rows, marks)
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(marks.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
            cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def found(df):
    rows = conv.repair(df).collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


TEXTS = ["Hi.", "Who?", "cut off", "", " \n", None, "Hi. ", "ok!\t\n", "a . b", "x" * 3000 + "."]
ROLES = ["user", "assistant", "system", None, "", "tool", "summary", "User"]


def random_table(seed: int, convs: int = 60):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(ROLES) if rng.random() < 0.3 else ROLES[turn % 2]
            where = None if rng.random() < 0.05 else turn + (rng.random() < 0.1) * 3
            rows.append((None if c == 0 else c, where, role, rng.choice(TEXTS)))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(3))
def test_repair_agrees_with_a_search_of_all_edits(spark, seed):
    rows = random_table(seed)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    assert found(df) == plain(rows)


def test_repair_of_the_given_conversations(spark):
    df = queries.table(spark, "/root/testdata/sf0.001", "conversations")
    assert found(df) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_no_rows_and_conversations_without_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    dropped = [t for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame([(7, t, "user", "Hi.", 1, "x") for t in dropped], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(df) == {7: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_text_ids(spark):
    rows = [("a", t, ROLES[t % 2], f"line {t}.") for t in range(30)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert found(df) == plain(rows)


def test_a_conversation_of_many_segments(spark, monkeypatch):
    rows = [(1, t, ROLES[(t + (t % 17 == 0)) % 2], TEXTS[t % 3]) for t in range(400)]
    rows += [(1, 200, "user", f"{k}") for k in range(50)] + [(2, 1, "user", "Hi.")] * 300
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = found(df)
    monkeypatch.setattr(conv, "SEGMENT", 7)
    assert found(df) == whole == plain(rows)


def every_split(kinds: str):
    """The chart over all spans and all splits."""
    chart = {(i, i + 1): conv.one_row(kind) for i, kind in enumerate(kinds)}
    for size in range(2, len(kinds) + 1):
        for i in range(len(kinds) - size + 1):
            cells = [conv.join(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
            assert all(cell == cells[0] for cell in cells)
            chart[i, i + size] = cells[0]
    return chart[0, len(kinds)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="dsuaxSUAX", min_size=1, max_size=12))
def test_every_split_of_a_span_gives_the_same_cell(kinds):
    assert conv.parse(kinds) == every_split(kinds)
    half = len(kinds) // 2
    assert conv.upwards([conv.parse(kinds[:half]) if half else conv.EMPTY,
                         conv.parse(kinds[half:])]) == conv.parse(kinds)

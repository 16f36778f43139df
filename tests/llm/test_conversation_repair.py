"""Cheapest edits against a search, the whole query against a plain version, and odd inputs."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from scoutline.llm import conversation_repair as R
from scoutline.llm import queries
from tests.llm.conftest import SF

GRAMMAR = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"(s?(ua)*u?)?")


def search(rows):
    """(cost, edits, role initials) of the cheapest repair: best first over (cost, edits).

    ``rows`` are (initial, must go, truncated). Nothing is known of states: roles are kept as text.
    """
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, roles = heapq.heappop(heap)
        if i == len(rows) and GRAMMAR.fullmatch(roles):
            return cost, edits, roles
        state = i, len(roles) % 2 if not roles.startswith("s") else 2 + len(roles) % 2, roles[:1], roles[-1:]
        if state in seen:
            continue
        seen.add(state)
        steps = [(3, "I", i, r) for r in "ua"]
        if i < len(rows):
            initial, gone, cut = rows[i]
            steps.append((4, "D", i + 1, ""))
            if not gone:
                steps += [(3 + 3 * cut, "R", i + 1, r) for r in "ua"]
                steps.append((3 * cut, "K", i + 1, initial))
        for more, edit, at, role in steps:
            if role in ("", "s", "u", "a") and PREFIX.fullmatch(roles + role):
                heapq.heappush(heap, (cost + more, edits + edit, at, roles + role))


def code(row):
    initial, gone, cut = row
    return ("sua" + initial).index(initial) + R.MUST_GO * gone + R.TRUNCATED * (cut and not gone)


ROW = st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()).map(lambda r: (r[0], r[1], r[2] and not r[1]))


@given(st.lists(ROW, max_size=12))
def test_edits_against_a_search(rows):
    cost, edits, _ = search(rows)
    assert R.cheapest_edits(bytes(map(code, rows))) == (cost, edits)


def test_long_conversation():
    rng = random.Random(1)
    rows = [(rng.choice("ua"), False, rng.random() < 0.1) for _ in range(40)]
    codes = bytes(map(code, rows)) * 5_000
    cost, edits = R.cheapest_edits(codes)
    assert len(edits.replace("I", "")) == len(codes)
    part = R.cheapest_edits(codes[: len(rows) * 2])
    assert part[0] <= cost


def plain(conversations):
    """The contract, row by row."""
    damaged = {}
    for conv_id, turn, role, text in conversations:
        rows = damaged.setdefault(conv_id, [])
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (turn, "user" if fault == 4 else role, text)
        rows += {0: [], 3: [row, row]}.get(fault, [row])
    out = {}
    for conv_id, rows in damaged.items():
        order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
        rows = sorted(rows, key=order)
        turns = [r[0] for r in rows if r[0] is not None]
        seen, faults, coded = set(), [0, 0, 0], []
        for _, role, text in rows:
            kept = re.findall(r"[^\x20\x09-\x0D]", text)
            which = 0 if not kept else 1 if (role, text) in seen else 2 if kept[-1] not in ".!?" else 3
            seen.add((role, text))
            if which < 3:
                faults[which] += 1
            coded.append((role[:1] or "x", which < 2, which == 2))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, edits, roles = search(coded)
        lines, at, place = [], 0, 0
        for edit in edits:
            own = rows[at] if edit != "I" else None
            at += edit != "I"
            if edit == "D":
                continue
            name = own[1] if edit == "K" else {"u": "user", "a": "assistant"}[roles[place]]
            lines.append(f"{name}:{own[2] if own else ''}")
            place += 1
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, *faults, illegal, cost, edits, digest)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def of(df):
    rows = df.collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_against_a_plain_version(spark, tables):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in tables("conversations")]
    assert of(queries.op13_conversation_repair(spark, SF)) == plain(rows)


SCHEMA = "conv_id long, turn long, role string, text string, code string, audit string"


@pytest.mark.parametrize("seed", range(3))
def test_odd_inputs(spark, monkeypatch, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", " ", "", None, "ok! \n", "\x0b", "é?", "long " * 30_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "Sys"]
    rows = [
        (rng.choice([None, 1, 2, 3, 7, 2**60 + 1]), rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts), "x", "y")
        for _ in range(60)
    ]
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert of(R.repair(R.damaged(df))) == plain([r[:4] for r in rows])
    assert R.repair(R.damaged(df.limit(0))).count() == 0


def test_conversation_without_rows(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.", "", "")], SCHEMA)
    assert of(R.repair(R.damaged(df))) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_turns(spark):
    rows = [(5, 0, "assistant", "A."), (5, 1, "user", "Q?"), (5, 2, "user", " "), (6, 0, "user", "a."), (6, 1, "user", "b.")]
    coded = R.coded(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = R.reports(coded)
    got = sorted(tuple(r) for r in R.repaired(coded, found).collect())
    audits = {r.conv_id: r.audit for r in found.collect()}
    assert audits == {5: "IKKDI", 6: "KR"}
    assert got == [
        (5, 0, "I", "user", ""), (5, 1, "K", "assistant", "A."), (5, 2, "K", "user", "Q?"), (5, 3, "I", "assistant", ""),
        (6, 0, "K", "user", "a."), (6, 1, "R", "assistant", "b."),
    ]

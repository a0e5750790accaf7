"""Conversation repair against a search over all edits, and damage against a plain loop."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartwright.llm import queries, repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, audit string, copies int"
NOTHING = hashlib.sha256().hexdigest()


def best_edits(units: str) -> tuple[int, str]:
    """Cheapest (cost, audit) by trying every edit in every state of the grammar."""

    @cache
    def search(i: int, state: str, inserts: int) -> tuple[int, str]:
        options = []
        if i == len(units) and state in ("", "a"):
            options.append((0, ""))

        def take(cost, letter, i, state, inserts=0):
            rest = search(i, state, inserts)
            options.append((cost + rest[0], letter + rest[1]))

        following = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if inserts < 3:
            for w in following:
                if w != "s":
                    take(3, "I", i, w, inserts + 1)
        if i < len(units):
            unit = units[i]
            take(4, "D", i + 1, state)
            if unit != "-":
                extra = 3 if unit.isupper() else 0
                for w in following:
                    if unit.lower() == w:
                        take(extra, "K", i + 1, w)
                    elif w != "s":
                        take(3 + extra, "R", i + 1, w)
        return min(options, default=(10**9, ""))

    for i in range(len(units), -1, -1):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            search(i, state, 0)
    return search(0, "", 0)


UNITS = st.text(alphabet="suaoSUAO-", max_size=11)


@settings(max_examples=400, deadline=None)
@given(UNITS)
def test_alignment_finds_the_best_edits(units):
    assert repair.whole_edits(units) == best_edits(units)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="suaoSUAO-", max_size=16), st.integers(1, 5))
def test_segments_give_the_best_edits(units, length):
    parts = [units[i : i + length] for i in range(0, len(units), length)]
    ways = repair.join_ways([repair.segment_ways(p) for p in parts], (0,), repair.FINAL)
    assert min(ways.values()) == best_edits(units)


def test_long_alignment_is_banded():
    units = "ua" * 100 + "-" + "ua" * 100
    assert repair.cheapest(units, repair.START, repair.AFTER_A) == (4, "K" * 200 + "D" + "K" * 200)


def expected(rows, ids):
    """The contract, row by row. ``rows``: (conv_id, turn, role, text) after damage."""
    found = {i: (0, 0, 0, 0, 0, 0, "", NOTHING) for i in ids}
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role if role is not None else " ", " " if text is None else text))
    for conv, turns in by_conv.items():
        turns.sort(
            key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest())
        )
        seen, units, faults = set(), "", defaultdict(int)
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not body:
                fault, unit = "blank", "-"
            elif (role, text) in seen:
                fault, unit = "duplicate", "-"
            elif body[-1] not in ".!?":
                fault, unit = "truncated", kind.upper()
            else:
                fault, unit = "none", kind
            seen.add((role, text))
            faults[fault] += 1
            units += unit
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:]))
        cost, audit = best_edits(units)
        kept = [t for t, e in zip(turns, audit.replace("I", ""), strict=True) if e != "D"]
        size = len(audit) - audit.count("D")
        roles = re.sub("^(?=.)", "s", "ua" * (size // 2)) if size % 2 else "ua" * (size // 2)
        lines, place, left = [], 0, iter(kept)
        for e in audit.replace("D", ""):
            turn = None if e == "I" else next(left)
            full = {"u": "user", "a": "assistant"}.get(roles[place])
            lines.append(f"{turn[1] if e == 'K' else full}:{turn[2] if turn else ''}")
            place += 1
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = (faults["blank"], faults["duplicate"], faults["truncated"])
        found[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return found


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if v is None else v for v in (role, text))
        action = zlib.crc32(key.encode()) % 20
        if action == 1:
            text = ""
        if action == 2:
            text = re.sub("[.!?]", "", text)
        if action == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(action, 1)
    return out


ODD = [
    (1, 0, "system", "Be kind."),
    (1, 1, "user", "Hi there"),
    (1, 2, "assistant", "Hello."),
    (1, 2, "assistant", "Hello."),
    (1, 9, "tool", "Done."),
    (2, None, "user", "No number?"),
    (2, None, "user", "No number?"),
    (2, 5, None, None),
    (2, 5, "", "No role."),
    (None, 0, "assistant", "No conversation!"),
    (None, 1, "user", " \t\n"),
    (3, -4, "user", "Full stop. \x0b"),
    (3, 4, "assistant", "é"),
    (3, 4, "assistant", "a\nb?"),
    (4, 1, "assistant", "Twice."),
    (4, 3, "assistant", "Twice."),
    (4, 3, "Assistant", "x" * 300_000 + "."),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "odd", 7) for r in rows], SCHEMA)


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in names) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("damage", [False, True])
def test_odd_rows(spark, damage):
    turns = frame(spark, ODD)
    rows = plain_damage(ODD) if damage else ODD
    given_turns = repair.damaged(turns) if damage else turns
    got = results(repair.repair_conversations(given_turns, turns))
    assert got == expected(rows, {r[0] for r in ODD})


def test_a_conversation_over_many_partitions(spark, monkeypatch):
    """Repeats, faults and inserts that meet at the borders of pieces."""
    rows = []
    for i in range(900):
        role = ["user", "assistant", "user", "tool", "assistant", "assistant"][i * 7 % 6]
        text = ["One.", f"Two {i}", f"Three {i}!", "", f"Four {i}."][i * 11 % 5]
        rows.append((5, 2 * i, role, text))
    rows += [(i, 0, "user", f"Small {i}.") for i in range(6, 30)]
    turns = frame(spark, rows)
    monkeypatch.setattr(repair, "SEGMENT", 5)
    audits = repair.audit_conversations(turns)
    # Compare with one alignment in one piece.
    got = {r.conv_id: (r.cost, r.audit, r.gaps, r.illegal, r.duplicate) for r in audits.collect()}
    want = expected(rows, [])
    assert got == {k: (v[5], v[6], v[0], v[4], v[2]) for k, v in want.items()}


def test_repaired_turns(spark):
    turns = frame(spark, [(1, 0, "assistant", "Well."), (1, 1, "tool", "Sure."), (1, 2, "user", "")])
    repaired = repair.apply_audits(turns, repair.audit_conversations(turns))
    got = [(r.place, r.edit, r.role, r.text) for r in repaired.orderBy("place").collect()]
    assert got == [(0, "R", "user", "Well."), (1, "R", "assistant", "Sure.")]


def test_empty_table(spark):
    turns = frame(spark, [])
    assert results(repair.repair_conversations(turns, turns)) == {}


def test_all_turns_dropped(spark):
    turns = frame(spark, [(8, 0, "user", "a.")])
    got = results(repair.repair_conversations(turns.where(F.lit(False)), turns))
    assert got == {8: (0, 0, 0, 0, 0, 0, "", NOTHING)}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = results(queries.op11_target_alignment(spark, SF))
    assert got == expected(plain_damage(rows), {r[0] for r in rows})

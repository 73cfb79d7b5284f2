"""Lightest repairs: brute force over all edit sequences, a plain dynamic
program for long conversations, oracle, odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_check import digest, duck

from waymark.llm import catalog, conversation_repair as repair

ROWS = "conv_id bigint, turn bigint, role string, text string"
GOOD = re.compile("(s?(ua)+)?")
WORD = re.compile("[^\x20\x09-\x0D]")


def faults(rows):
    """First fault of every (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        said = WORD.findall(text)
        out.append(repair.BLANK if not said else repair.DUPLICATE if (role, text) in seen
                   else repair.OK if said[-1] in ".!?" else repair.TRUNCATED)
        seen.add((role, text))
    return out


def brute(turns):
    """Least (cost, audit) over all edit sequences with up to ``len + 2`` insertions."""
    best = None
    choices = []
    for initial, fault in turns:
        options = [("D", "", 4)]
        if fault not in (repair.BLANK, repair.DUPLICATE):
            late = 3 if fault == repair.TRUNCATED else 0
            options += [("K", initial, late), ("R", "u", 3 + late), ("R", "a", 3 + late)]
        choices.append(options)
    places = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for edits in itertools.product(*choices):
        for added in itertools.product(places, repeat=len(turns) + 1):
            roles = audit = ""
            cost = 0
            for (mark, role, price), new in zip([*edits, ("", "", 0)], added, strict=True):
                roles += "".join(new) + (role if mark != "D" else "")
                audit += "I" * len(new) + mark
                cost += 3 * len(new) + price
            if "" not in [o[1] for o in edits if o[0] == "K"] and GOOD.fullmatch(roles):
                best = min(best or (cost, audit), (cost, audit))
    return best


def program(turns):
    """Least (cost, audit) by a plain pass over the turns (whole strings)."""
    after, wanted = repair.AFTER, repair.WANTED
    best = {0: (0, "")}
    for initial, fault in [*turns, (None, None)]:
        for _ in range(4):
            for q, (c, a) in list(best.items()):
                to = after[q, wanted[q]]
                best[to] = min(best.get(to, (c + 3, a + "I")), (c + 3, a + "I"))
        if initial is None:
            return min(best[q] for q in (0, 3) if q in best)
        new = {}
        for q, (c, a) in best.items():
            moves = [(q, c + 4, a + "D")]
            if fault not in (repair.BLANK, repair.DUPLICATE):
                late = c + 3 * (fault == repair.TRUNCATED)
                moves.append((after[q, wanted[q]], late + 3, a + "R"))
                if (q, initial) in after:
                    moves.append((after[q, initial], late, a + "K"))
            for to, *value in moves:
                new[to] = min(new.get(to, tuple(value)), tuple(value))
        best = new


def solved(turns, size):
    """(cost, audit) by agendas over segments of ``size`` turns, joined."""
    segments = []
    for begin in range(0, len(turns), size):
        part, items = turns[begin:begin + size], []
        for entry in range(4) if begin else (0,):
            exits = repair.lightest(part, entry)
            ranks = sorted(a for _, a in exits.values())
            items += [{"entry": entry, "exit": q, "cost": c, "rank": ranks.index(a), "audit": a} for q, (c, a) in exits.items()]
        segments.append(items)
    path, ending = repair.join_segments(segments)
    taken = [next(i for i in items if (i["entry"], i["exit"]) == p) for items, p in zip(segments, path, strict=True)]
    return sum(i["cost"] for i in taken) + 3 * len(ending), "".join(i["audit"] for i in taken) + "I" * len(ending)


TURN = st.tuples(st.sampled_from(["s", "u", "a", " ", "t", ""]), st.sampled_from(range(4)))


@settings(max_examples=50, deadline=None)
@given(st.lists(TURN, min_size=1, max_size=3))
def test_agenda_equals_all_edit_sequences(turns):
    assert solved(turns, 256) == brute(turns) == program(turns)


@settings(max_examples=200, deadline=None)
@given(st.lists(TURN, min_size=1, max_size=40), st.integers(1, 9))
def test_segments_join_to_the_same_derivation(turns, size):
    assert solved(turns, size) == program(turns)


def expect(rows):
    """Report of one conversation's (turn, role, text) in order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    kinds = faults([r[1:] for r in rows])
    cost, audit = program([(r[1][:1], k) for r, k in zip(rows, kinds, strict=True)]) if rows else (0, "")
    lines, state, at = [], 0, 0
    for mark in audit:
        name = repair.ROLE_NAMES[repair.WANTED[state]]
        if mark == "I":
            lines.append(f"{name}:")
            state = repair.AFTER[state, repair.WANTED[state]]
            continue
        _, role, text = rows[at]
        at += 1
        if mark != "D":
            new = role if mark == "K" else name
            lines.append(f"{new}:{text}")
            state = repair.AFTER[state, new[:1]]
    known = [t for t, _, _ in rows if t is not None]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(kinds.count(k) for k in (1, 2, 3)),
            sum(a[1][:1] + b[1][:1] not in repair.LEGAL_PAIRS for a, b in itertools.pairwise(rows)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def expected(rows, ids):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    return {i: expect([r[1:] for r in sorted((r for r in rows if r[0] == i), key=order)]) for i in ids}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = catalog.QUERIES["op12_lightest_repair"](spark, SF001).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r[0]: tuple(r)[1:] for r in got} == expected(damaged(rows), {r[0] for r in rows})


def test_oracle_equals_query(spark):
    df = catalog.QUERIES["op12_lightest_repair"](spark, SF001)
    rel = duck(SF001).sql(catalog.ORACLE["op12_lightest_repair"])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


def odd_rows():
    rng = random.Random(5)
    rows = [(None, 0, "user", "no id."), (None, None, None, None), (3, None, "user", "a."), (3, None, "assistant", "b"),
            (4, 2, "user", None), (5, 1, "", "x."), (5, 1, "", "x."), (6, 9, "tool", "!\x0b \t"), (6, 3, "System", "?"),
            (7, 0, "user", "word " * 40000 + "."), (8, 5, "user", "  "), (8, 7, "assistant", "\n")]
    rows += [(9, k, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", f"{k}!", f"{k}"]))
             for k in range(1500)]
    return rows


def test_nulls_ties_long_conversations_and_repartitioning(spark):
    rows = odd_rows()
    want = expected(damaged(rows), {r[0] for r in rows})
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], ROWS + ", pos int, audit string")
    turns = df.repartition(5)
    got = repair.repair_report(repair.damage(turns), turns).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want


def test_repaired_turns_are_well_formed(spark):
    rows = odd_rows()
    got = repair.repaired_turns(spark.createDataFrame(rows, ROWS)).orderBy("conv_id", "pos", "part").collect()
    for conv in {r[0] for r in rows}:
        mine = [r for r in got if r.conv_id == conv]
        assert GOOD.fullmatch("".join(r.role[:1] for r in mine))
        assert all((r.text == "" and r.turn is None) for r in mine if r.edit == "I")


def test_empty_tables_and_dropped_conversations(spark):
    none = spark.createDataFrame([], ROWS)
    assert repair.repair_report(none, none).count() == 0
    assert repair.repaired_turns(none).count() == 0
    ids = spark.createDataFrame([(1, 0, "user", "x"), (1, 1, "user", "y")], ROWS)
    row = repair.repair_report(none, ids).collect()
    assert [tuple(r) for r in row] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize(("rows", "audit"), [
    ([("user", "Hi."), ("assistant", "Yes.")], "KK"),
    ([("user", "Hi.")], "KI"),
    ([("assistant", "Yes.")], "IK"),
    ([("system", "Be good.")], "D"),
    ([("user", "Hi."), ("user", "Hi."), ("assistant", "Yes.")], "KDK"),
])
def test_small_cases(rows, audit):
    assert program([(r[:1], f) for (r, _), f in zip(rows, faults(rows), strict=True)])[1] == audit

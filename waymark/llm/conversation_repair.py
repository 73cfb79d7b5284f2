"""Repair of conversation structure by lightest derivations.

A well-formed conversation is empty, or an optional system turn and then pairs
of a user and an assistant turn. Turns are kept, given another role or deleted,
and empty turns are inserted, at least total cost.

Items and deductions: an item ``[at, state]`` says that the turns before
``at`` have been edited and what the edited roles end with. An item and the
next turn derive the item after that turn (keep, rerole, delete); an item alone
derives another by an insertion. The value of an item is (cost, audit), the
audit being the initials of the edits; a deduction adds to the cost and extends
the audit, so it never makes a value less and keeps values in order (a superior
function). Knuth's agenda therefore pops items in the order of their values,
and the first value popped for an item is final.

Long conversations are cut into segments of ``SEGMENT`` turns. Each segment is
solved alone for every state it may begin in; a second kind of deduction joins
the item of all turns before a segment with the segment's item. Insertions
stand before a turn, those at the end of a conversation with the goal item, so
audits of one segment end in an edit of its last turn and none is the beginning
of another. Two joined audits compare as their first parts do, and a rank of
the parts stands for the strings: joining a segment is work of constant size
however long the conversation is.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.ordinal import with_ordinal
from waymark.sources.tables import stage_table, table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
RECAST, REMOVE, ADD, CUT_OFF = 3, 4, 3, 3  # costs of rerole, delete, insert, and of a truncated turn that stays
SEGMENT = 256
#: Characters of role and text that order turns of the same number; a hash orders the rest.
TIE_CHARS = 64
#: What the edited roles end with: nothing yet, the system turn, a user turn, an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that may come next by insertion or rerole.
WANTED = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE_NAMES = {"u": "user", "a": "assistant"}
#: Insertions that complete a conversation.
COMPLETION = {EMPTY: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL_PAIRS = ("su", "ua", "au")
SPACE = r"\x20\x09-\x0D"


def lightest(turns: list[tuple[str, int]], entry: int) -> dict[int, tuple[int, str]]:
    """``{exit state: (cost, audit)}`` of the turns (role initial, fault) of a
    segment that begins in state ``entry``."""
    agenda, final, exits = [(0, "", 0, entry)], set(), {}
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(turns):
            exits[state] = (cost, audit)
            continue
        initial, fault = turns[at]
        wanted = AFTER[state, WANTED[state]]
        heapq.heappush(agenda, (cost + ADD, audit + INSERT, at, wanted))
        heapq.heappush(agenda, (cost + REMOVE, audit + DELETE, at + 1, state))
        if fault not in (BLANK, DUPLICATE):
            stays = cost + (CUT_OFF if fault == TRUNCATED else 0)
            heapq.heappush(agenda, (stays + RECAST, audit + REROLE, at + 1, wanted))
            if (state, initial) in AFTER:
                heapq.heappush(agenda, (stays, audit + KEEP, at + 1, AFTER[state, initial]))
    return exits


def steps(turns: list[tuple[str, int]], entry: int, audit: str) -> list[str]:
    """The audit turn by turn, with the roles it gives: insertions before the
    turn as ``u`` or ``a``, then ``K``, ``D``, or the new role ``U`` or ``A``."""
    out, state = [], entry
    for (initial, _), part in zip(turns, re.findall("I*[KRD]", audit), strict=True):
        step = ""
        for _ in part[:-1]:
            step += WANTED[state]
            state = AFTER[state, WANTED[state]]
        if part[-1] == KEEP:
            step, state = step + KEEP, AFTER[state, initial]
        elif part[-1] == REROLE:
            step, state = step + WANTED[state].upper(), AFTER[state, WANTED[state]]
        else:
            step += DELETE
        out.append(step)
    return out


def join_segments(segments: Iterable[list[dict]]) -> tuple[list[tuple[int, int]], str]:
    """Entry and exit state of every segment on the lightest derivation of the
    goal item, and the roles inserted at the end. A segment is a list of items
    ``entry, exit, cost, rank`` (rank of the audit among those of its entry)."""
    best, back = {EMPTY: (0, 0)}, []
    for items in segments:
        found: dict[int, tuple] = {}
        for item in items:
            if item["entry"] in best:
                cost, order = best[item["entry"]]
                value = (cost + item["cost"], order, item["rank"], item["entry"])
                if item["exit"] not in found or value < found[item["exit"]]:
                    found[item["exit"]] = value
        # The audits up to here differ from state to state: renumber their order.
        places = {v[1:3]: k for k, v in enumerate(sorted(found.values(), key=lambda v: v[1:3]))}
        best = {state: (v[0], places[v[1:3]]) for state, v in found.items()}
        back.append(bytes(found[state][3] if state in found else 255 for state in range(4)))
    state = min(best, key=lambda s: (best[s][0] + ADD * len(COMPLETION[s]), best[s][1]))
    ending, path = COMPLETION[state], []
    for entries in reversed(back):
        path.append((entries[state], state))
        state = entries[state]
    return path[::-1], ending


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield dict(zip(names, values, strict=True))


def _flush(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _flush(held, schema)
            held = []
    if held:
        yield _flush(held, schema)


_KEY = [("absent", pa.bool_()), ("conv", pa.string())]
_ITEM = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()),
                   ("steps", pa.list_(pa.string()))])
_SEGMENTS = pa.schema([*_KEY, ("segment", pa.int64()), ("turns", pa.int32()), ("items", pa.list_(_ITEM))])
_PATHS = pa.schema([*_KEY, ("segment", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("ending", pa.string())])


def diagnose(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``absent, conv, pos, turn, role, text, fault``: the turns of every
    conversation numbered from 0 by turn (nulls first), and each one's first
    fault. Null roles and texts are one space. Turns of the same number are
    ordered by role and text (their first 64 characters, then a hash).
    ``conv`` is the id as text, ``absent`` tells that it is null."""
    rows = turns.select(F.col(conv_col).isNull().alias("absent"),
                        F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("conv"),
                        F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    said = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    # The last key lets equal turns of one conversation spread over tasks.
    numbered = with_ordinal(rows.withColumns({"said": said, "row": F.monotonically_increasing_id()}),
                            [F.col("turn").asc_nulls_first(), F.substring("role", 1, TIE_CHARS),
                             F.substring("text", 1, TIE_CHARS), "said", "row"], ["absent", "conv"], "pos")
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    numbered = stage_table(numbered.select("absent", "conv", "pos", "turn", "role", "text", "said", blank.alias("blank")),
                           "repair-turns")
    repeated = (numbered.where("not blank").groupBy("absent", "conv", "said")
                        .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("rows"))
                        .where("rows > 1").drop("rows"))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
              .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), TRUNCATED).otherwise(OK))
    return (numbered.join(repeated, ["absent", "conv", "said"], "left")
                    .select("absent", "conv", "pos", "turn", "role", "text", fault.alias("fault")))


def segment_items(turns: DataFrame) -> DataFrame:
    """``absent, conv, segment, turns, items``: the lightest derivation of
    every segment for each state it can begin and end in."""
    rows = turns.select("absent", "conv", "pos", F.expr(f"pos div {SEGMENT}").alias("segment"),
                        F.substring("role", 1, 1).alias("initial"), "fault")
    rows = (rows.repartition("absent", "conv", "segment")
                .sortWithinPartitions("absent", "conv", "segment", "pos"))

    def solve(batches):
        for (absent, conv, segment), group in groupby(_rows(batches), lambda r: (r["absent"], r["conv"], r["segment"])):
            mine = [(r["initial"], r["fault"]) for r in group]
            items = []
            for entry in (range(4) if segment else (EMPTY,)):
                exits = lightest(mine, entry)
                ranks = {audit: k for k, audit in enumerate(sorted(a for _, a in exits.values()))}
                items += [{"entry": entry, "exit": out, "cost": cost, "rank": ranks[audit],
                           "steps": steps(mine, entry, audit)} for out, (cost, audit) in sorted(exits.items())]
            yield absent, conv, segment, len(mine), items

    return rows.mapInArrow(lambda batches: _in_batches(solve(batches), _SEGMENTS, 64),
                           "absent boolean, conv string, segment bigint, turns int, items array<struct<"
                           "entry: int, exit: int, cost: bigint, rank: int, steps: array<string>>>")


def goal_paths(segments: DataFrame) -> DataFrame:
    """``absent, conv, segment, entry, exit, ending`` of every segment on the
    lightest derivation; a conversation's segments are read in order, and four
    bytes of each are held."""
    rows = (segments.select("absent", "conv", "segment", F.transform("items", lambda i: F.struct(
                i["entry"].alias("entry"), i["exit"].alias("exit"), i["cost"].alias("cost"), i["rank"].alias("rank")))
                .alias("items"))
            .repartition("absent", "conv").sortWithinPartitions("absent", "conv", "segment"))

    def follow(batches):
        for (absent, conv), group in groupby(_rows(batches), lambda r: (r["absent"], r["conv"])):
            path, ending = join_segments(r["items"] for r in group)
            for k, (entry, out) in enumerate(path):
                yield absent, conv, k, entry, out, ending if k + 1 == len(path) else ""

    return rows.mapInArrow(lambda batches: _in_batches(follow(batches), _PATHS),
                           "absent boolean, conv string, segment bigint, entry int, exit int, ending string")


def edits(turns: DataFrame, **columns: str) -> DataFrame:
    """``absent, conv, pos, turn, role, text, fault, step, ending``: every turn
    with its edit as in :func:`steps`, and the roles inserted after the last
    one."""
    rows = stage_table(diagnose(turns, **columns), "repair-faults")
    segments = stage_table(segment_items(rows), "repair-segments")
    paths = goal_paths(segments)
    chosen = F.element_at(F.filter("items", lambda i: (i["entry"] == F.col("entry")) & (i["exit"] == F.col("exit"))), 1)
    solved = stage_table(segments.join(paths, ["absent", "conv", "segment"])
                                 .select("absent", "conv", "segment", "turns", chosen["steps"].alias("steps"), "ending"),
                         "repair-steps")
    at = F.expr(f"cast(pos % {SEGMENT} as int)")
    return (rows.withColumn("segment", F.expr(f"pos div {SEGMENT}")).join(solved, ["absent", "conv", "segment"])
                .select("absent", "conv", "pos", "turn", "role", "text", "fault", F.get("steps", at).alias("step"),
                        F.when(at + 1 == F.col("turns"), F.col("ending")).otherwise("").alias("ending")))


def repaired_turns(turns: DataFrame, **columns: str) -> DataFrame:
    """The repaired conversations: ``conv_id, pos, part, edit, turn, role,
    text``, ordered by ``pos`` (the turn before or after which an inserted one
    stands) and ``part``. Deleted turns are left out; inserted ones have no
    ``turn`` and an empty text. Empty input gives no rows; columns with other
    names are ignored, whatever they are called."""
    kind = turns.schema[columns.get("conv_col", "conv_id")].dataType.simpleString()
    done = edits(turns, **columns)
    parts = F.filter(F.split(F.concat("step", "ending"), ""), lambda c: c != "")
    rows = done.select("absent", "conv", "pos", "turn", "role", "text", F.posexplode(parts).alias("part", "mark"))
    added, new = F.col("mark").isin("u", "a"), F.lower("mark")
    name = F.when(new == "u", "user").otherwise("assistant")
    return rows.where(F.col("mark") != DELETE).select(
        F.when(~F.col("absent"), F.col("conv").cast(kind)).alias("conv_id"), "pos", "part",
        F.when(added, INSERT).when(F.col("mark") == KEEP, KEEP).otherwise(REROLE).alias("edit"),
        F.when(~added, F.col("turn")).alias("turn"),
        F.when(F.col("mark") == KEEP, F.col("role")).otherwise(name).alias("role"),
        F.when(added, "").otherwise(F.col("text")).alias("text"))


class _Report:
    """Figures of one conversation, fed turn by turn."""

    def __init__(self):
        self.faults = [0, 0, 0, 0]
        self.numbers, self.least, self.last = 0, None, None
        self.illegal = self.cost = 0
        self.initial = None
        self.audit, self.digest, self.empty = [], hashlib.sha256(), True

    def _say(self, role: str, text: str) -> None:
        self.digest.update((("" if self.empty else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.empty = False

    def add(self, r: dict) -> None:
        self.faults[r["fault"]] += 1
        if r["turn"] is not None and r["turn"] != self.last:
            self.numbers, self.last = self.numbers + 1, r["turn"]
            self.least = r["turn"] if self.least is None else self.least
        if self.initial is not None and self.initial + r["role"][:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = r["role"][:1]
        for mark in r["step"] + r["ending"]:
            if mark in ROLE_NAMES:
                self.cost += ADD
                self._say(ROLE_NAMES[mark], "")
                self.audit.append(INSERT)
                continue
            self.audit.append(mark if mark in (KEEP, DELETE) else REROLE)
            if mark == DELETE:
                self.cost += REMOVE
                continue
            self.cost += (CUT_OFF if r["fault"] == TRUNCATED else 0) + (0 if mark == KEEP else RECAST)
            self._say(r["role"] if mark == KEEP else ROLE_NAMES[mark.lower()], r["text"])

    def row(self) -> tuple:
        gaps = self.last - self.least + 1 - self.numbers if self.numbers else 0
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


_REPORT = pa.schema([*_KEY, *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])


def reports(done: DataFrame) -> DataFrame:
    """One row per conversation of :func:`edits`: gaps in the numbers, faults,
    illegal neighbours, cost, audit, and a digest of the repaired turns. The
    turns are streamed in order; what is held of a conversation is its audit."""
    rows = (done.withColumn("turn", F.col("turn").cast("bigint")).repartition("absent", "conv")
                .sortWithinPartitions("absent", "conv", "pos"))

    def read(batches):
        for (absent, conv), group in groupby(_rows(batches), lambda r: (r["absent"], r["conv"])):
            report = _Report()
            for r in group:
                report.add(r)
            yield absent, conv, *report.row()

    return rows.mapInArrow(lambda batches: _in_batches(read(batches), _REPORT),
                           "absent boolean, conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
                           "illegal bigint, cost bigint, audit string, repaired_sha256 string")


def repair_report(turns: DataFrame, ids: DataFrame, conv_col: str = "conv_id", **columns: str) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` for every distinct id of ``ids`` (a null id is one too);
    an id without turns has zeros, an empty audit and the hash of nothing.

    Null roles and texts are one space, which is no role (such a turn is
    reroled or deleted) and a blank text. An empty role is none either.
    Rows that repeat are turns of their own and count as duplicates. No ids,
    no rows."""
    kind = ids.schema[conv_col].dataType.simpleString()
    found = reports(edits(turns, conv_col=conv_col, **columns))
    every = ids.select(F.col(conv_col).isNull().alias("absent"),
                       F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, ["absent", "conv"], "left").select(
        F.when(~F.col("absent"), F.col("conv").cast(kind)).alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def damage(turns: DataFrame) -> DataFrame:
    """The damaged rows that ``op12_lightest_repair`` mends: what happens to a
    row follows from the crc32 of its id and turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.where("fate <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))
                .drop("copy"))


def op12_lightest_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    turns = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return repair_report(damage(turns), turns)


def _sql_move(state: str, price: str, mark: str, line: str = "''") -> str:
    return f"{{'c': {state}.c + {price}, 'a': {state}.a || '{mark}', 'o': {state}.o || {line}}}"


def _sql_least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


_FAR = 1_000_000_000
_STAYS = f"CASE WHEN w.f IN ({BLANK}, {DUPLICATE}) THEN {_FAR} WHEN w.f = {TRUNCATED} THEN {CUT_OFF} ELSE 0 END"


def _sql_keep(state: str, initial: str) -> str:
    return _sql_move(state, f"CASE WHEN w.i = '{initial}' THEN {_STAYS} ELSE {_FAR} END", KEEP,
                     "chr(10) || w.role || ':' || w.text")


def _sql_recast(state: str, role: str) -> str:
    return _sql_move(state, f"{RECAST} + {_STAYS}", REROLE, f"chr(10) || '{role}:' || w.text")


#: The same values by a pass over the turns: one (cost, audit, lines) per state
#: (e nothing yet, s, u, a), first with insertions, then with the edits of a turn.
_SQL_INSERTED = ("SELECT g, turns, k, e, s, u, " + _sql_least("a", _sql_move("u", str(ADD), INSERT, "chr(10) || 'assistant:'"))
                 + " AS a FROM (SELECT g, turns, k, e, s, "
                 + _sql_least("u", *[_sql_move(q, str(ADD), INSERT, "chr(10) || 'user:'") for q in "esa"])
                 + " AS u, a FROM SOURCE)")

OP12_SQL = rf"""
WITH RECURSIVE
poly AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
           lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS crcs),
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(
               string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
               lambda ch: CAST(unicode(ch) AS BIGINT))),
             lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS fate
  FROM conversations, poly),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, (SELECT unnest([0, 1]) AS copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged)),
faulty AS (
  SELECT *, substr(role, 1, 1) AS i,
         CASE WHEN NOT regexp_matches(text, '[^{SPACE}]') THEN {BLANK} WHEN nth > 1 THEN {DUPLICATE}
              WHEN NOT regexp_matches(text, '[.!?][{SPACE}]*\z') THEN {TRUNCATED} ELSE {OK} END AS f,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM numbered),
grouped AS (
  SELECT row_number() OVER () AS g, conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (f = {BLANK}) AS blank, count(*) FILTER (f = {DUPLICATE}) AS duplicate,
         count(*) FILTER (f = {TRUNCATED}) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'i': i, 'f': f, 'role': role, 'text': text}} ORDER BY pos) AS turns FROM faulty GROUP BY conv_id),
steps AS (
  SELECT g, turns, 0 AS k, {{'c': 0, 'a': '', 'o': ''}} AS e, {{'c': {_FAR}, 'a': '', 'o': ''}} AS s,
         {{'c': {_FAR}, 'a': '', 'o': ''}} AS u, {{'c': {_FAR}, 'a': '', 'o': ''}} AS a FROM grouped
  UNION ALL
  SELECT g, turns, k + 1, {_sql_move("e", str(REMOVE), DELETE)},
         {_sql_least(_sql_move("s", str(REMOVE), DELETE), _sql_keep("e", "s"))},
         {_sql_least(_sql_move("u", str(REMOVE), DELETE), *[_sql_keep(q, "u") for q in "esa"],
                     *[_sql_recast(q, "user") for q in "esa"])},
         {_sql_least(_sql_move("a", str(REMOVE), DELETE), _sql_keep("u", "a"), _sql_recast("u", "assistant"))}
  FROM (SELECT *, turns[k + 1] AS w FROM ({_SQL_INSERTED.replace("SOURCE", "steps")})) WHERE k < len(turns)),
goal AS (
  SELECT g, {_sql_least("e", "a")} AS best FROM ({_SQL_INSERTED.replace("SOURCE", "steps")}) WHERE k = len(turns)),
found AS (SELECT * FROM grouped JOIN goal USING (g))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN found ON o.conv_id IS NOT DISTINCT FROM found.conv_id
"""

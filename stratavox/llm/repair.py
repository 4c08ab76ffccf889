"""Repair of conversations whose turns are damaged: the cheapest edits that give a legal order of roles.

Nodes of the graph are (turns read, what the roles kept so far allow next), arcs are edits. Least costs from the start and
to the end show which arcs are tight, that is, on a cheapest path; a walk over the frontier of nodes that one text of edits
reaches takes the least letter of the tight arcs at each step.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import SPACE, WORD, batch_of, configure, table

#: Costs of the edits, and what a truncated turn that isn't deleted adds.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: What may come next is told by the last role kept: nothing yet, system, user, assistant; by initial, the state it leads to.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
FINAL = (0, 3)
#: Kinds of turns: the initial of its role, and what is wrong with it.
FINE, TRUNCATED, GONE = 0, 1, 2
INITIALS = ["", "s", "u", "a"]
NEVER = float("inf")
#: Turns of a block, of which only the costs at the end are remembered; characters of a conversation held in memory.
BLOCK, HELD = 4096, 32 << 20
EDITED = "conv_id long, place long, edit string, turn long, role string, text string"
SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _arcs(initial: str, fault: int) -> list[tuple[str, int, int, int, str | None]]:
    """Edits of one turn: letter, state before, state after, cost, and the role that the edit gives."""
    out = [("D", s, s, DELETE, None) for s in range(4)]
    if fault != GONE:
        more = CUT if fault == TRUNCATED else 0
        out += [("K", s, NEXT[s][initial], KEEP + more, None) for s in range(4) if initial in NEXT[s]]
        out += [("R", s, NEXT[s][i], REROLE + more, role) for s in range(4) for i, role in ROLES.items() if i in NEXT[s]]
    return out


#: By code 3 * initial + fault; insertions are the same before any turn and at the end.
ARCS = [_arcs(i, fault) for i in INITIALS for fault in (FINE, TRUNCATED, GONE)]
INSERTS = [("I", s, NEXT[s][i], INSERT, role) for s in range(4) for i, role in ROLES.items() if i in NEXT[s]]


def _inserted(cost: list, forward: bool) -> list:
    """Least costs when turns may be inserted here; a longer run of insertions only repeats a state."""
    for _ in range(3):
        for _, a, b, w, _ in INSERTS:
            if forward:
                cost[b] = min(cost[b], cost[a] + w)
            else:
                cost[a] = min(cost[a], cost[b] + w)
    return cost


def _after(cost: list, code: int) -> list:
    out = [NEVER] * 4
    for _, a, b, w, _ in ARCS[code]:
        out[b] = min(out[b], cost[a] + w)
    return _inserted(out, True)


def _before(cost: list, code: int) -> list:
    out = [NEVER] * 4
    for _, a, b, w, _ in ARCS[code]:
        out[a] = min(out[a], cost[b] + w)
    return _inserted(out, False)


def edits(codes: bytes) -> Iterator[tuple[str, str | None, int]]:
    """The cheapest edits of turns of these codes, in order: letter, the role it gives or None, and its cost.

    Costs to the end are remembered at the ends of blocks and found again within one block at a time. As letters but I go
    to the next turn and I stays, all nodes of a frontier lie before the same turn.
    """
    n = len(codes)
    back = _inserted([0 if s in FINAL else NEVER for s in range(4)], False)
    ends = {}
    for i in range(n, 0, -1):
        if i % BLOCK == 0 or i == n:
            ends[(i - 1) // BLOCK] = back
        back = _before(back, codes[i - 1])
    total, front, frontier = back[0], _inserted([0, NEVER, NEVER, NEVER], True), {0}
    i, block, there = 0, -1, []
    while True:
        if i < n and i // BLOCK != block:
            block = i // BLOCK
            there = [ends[block]]
            for code in reversed(codes[block * BLOCK : (block + 1) * BLOCK]):
                there.append(_before(there[-1], code))
            there.reverse()
        here = there[i - block * BLOCK] if i < n else _inserted([0 if s in FINAL else NEVER for s in range(4)], False)
        tight = [x for x in INSERTS if x[1] in frontier and front[x[1]] + x[3] + here[x[2]] == total]
        if i < n:
            ahead = there[i - block * BLOCK + 1]
            tight += [x for x in ARCS[codes[i]] if x[1] in frontier and front[x[1]] + x[3] + ahead[x[2]] == total]
        if not tight:
            return
        least = min(x[0] for x in tight)
        taken = [x for x in tight if x[0] == least]
        frontier = {x[2] for x in taken}
        yield least, taken[0][4], taken[0][3]
        if least != "I":
            front = _after(front, codes[i])
            i += 1


class Held:
    """The turns of one conversation, in memory up to HELD characters and in a temporary file beyond."""

    def __init__(self):
        self.rows, self.size, self.file = [], 0, None

    def add(self, turn, role: str, text: str) -> None:
        self.rows.append((turn, role, text))
        self.size += len(role) + len(text) + 64
        if self.size > HELD:
            self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115
            pickle.dump(self.rows, self.file)
            self.rows, self.size = [], 0

    def __iter__(self):
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.rows


class Conversation:
    """What the turns of one conversation, in order, amount to."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.turns = conv_id, bytearray(), Held()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.before = None

    def add(self, turn, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if fault != "blank" and self.before == (turn, role, text):
            fault = "duplicate"
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.before is not None:
            self.illegal += self.before[1][:1] + initial not in ("su", "ua", "au")
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        kind = {"": FINE, "truncated": TRUNCATED}.get(fault, GONE)
        self.codes.append(3 * (INITIALS.index(initial) if initial in INITIALS else 0) + kind)
        self.turns.add(turn, role, text)
        self.before = (turn, role, text)

    def repaired(self) -> Iterator[tuple[str, int, int | None, str | None, str | None]]:
        """letter, cost, turn, role and text of each edit; a deleted turn keeps what it had."""
        turns = iter(self.turns)
        for letter, role, cost in edits(bytes(self.codes)):
            if letter == "I":
                yield letter, cost, None, role, ""
            else:
                turn, own, text = next(turns)
                yield letter, cost, turn, role or own, text

    def summary(self) -> tuple:
        digest, audit, cost, some = hashlib.sha256(), [], 0, False
        for letter, paid, _, role, text in self.repaired():
            audit.append(letter)
            cost += paid
            if letter != "D":
                digest.update((("\n" if some else "") + role + ":" + text).encode())
                some = True
        gaps = min(self.last - self.first + 1 - self.distinct, (1 << 63) - 1) if self.distinct else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(audit), digest.hexdigest()


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """Conversations from the sorted rows of ordered(), one at a time."""
    now = None
    for batch in batches:
        for conv_id, turn, role, text, fault, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                now = Conversation(conv_id)
            if not gone:
                now.add(turn, role, text, fault)
    if now is not None:
        yield now


def _batches(rows: Iterator[tuple], ddl: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, str))
        if size > most:
            yield batch_of(ddl, *map(list, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield batch_of(ddl, *map(list, zip(*held, strict=True)))


def summary_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches((c.summary() for c in conversations(batches)), SUMMARY)


def edited_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(((c.conv_id, k, letter, turn, role, text) for c in conversations(batches) for k, (letter, _, turn, role, text) in enumerate(c.repaired())), EDITED)


def _fault(text: Column) -> Column:
    """blank or truncated, whatever else a turn may be."""
    last = F.right(F.rtrim(text, F.lit("".join(chr(i) for i in SPACE.nonzero()[0]))), F.lit(1))
    return F.when(~text.rlike(WORD), "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, fault and gone of every row, a conversation's rows together and in order.

    Where a role and text come back, an aggregate by conversation, role and text's digest, made in part before it is
    shuffled, has the first turn that has them; so no task remembers a conversation's texts. Of rows with one turn and the
    same role and text, which are neighbours then, all but the first are told by the one before.
    """
    rows = turns.withColumn("_key", F.md5("text"))
    same = rows.filter("not gone").groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_key").alias("_k"))
    again = same.agg(F.min("turn").alias("_first"), F.max(F.col("turn").isNull()).alias("_null"), F.count("*").alias("_n")).filter("_n > 1")
    both = rows.join(again, rows["conv_id"].eqNullSafe(again["_c"]) & (rows["role"] == again["_r"]) & (rows["_key"] == again["_k"]), "left")
    late = F.coalesce(F.col("turn").isNotNull() & (F.col("_null") | (F.col("turn") > F.col("_first"))), F.lit(False))
    own = _fault(F.col("text"))
    fault = F.when(own == "blank", own).when(late, "duplicate").otherwise(own)
    out = both.select("conv_id", "turn", "role", "text", fault.alias("fault"), "gone")
    return out.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _rows(turns: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    gone = F.col("gone") if "gone" in turns.columns and dict(turns.dtypes)["gone"] == "boolean" else F.lit(False)
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), F.coalesce(gone, F.lit(False)).alias("gone"))


def repair(turns: DataFrame) -> DataFrame:
    """The edits of every conversation, in order: conv_id, place, edit (D, I, K or R), turn, role and text.

    Takes conv_id, turn, role and text; a null role or text is one space, and rows of a null conv_id are one conversation.
    Turns go in order, nulls first, then by role and text. A row's first fault counts: blank (no word), duplicate (role and
    text were there before), truncated (the last character of a word isn't one of .!?). Blank rows and duplicates are
    deleted; roles that are left spell `(s?(ua)+)?` by their initials. Of the cheapest edits those least in ASCII are taken.
    Repeated rows are duplicates. An empty table gives no rows, nor does a conversation without rows. Other columns are
    ignored, but for a boolean `gone`: such rows only say that their conversation exists. A conversation passes one task as
    a stream, as the hash of its text asks: a byte a turn is in memory, its texts are in a file beyond HELD characters.
    """
    return ordered(_rows(turns)).mapInArrow(edited_rows, EDITED)


def summaries(turns: DataFrame) -> DataFrame:
    """SUMMARY of every conversation, as repair() mends it: faults, gaps between turns, illegal neighbours, cost, edits, hash."""
    return ordered(_rows(turns)).mapInArrow(summary_rows, SUMMARY)


def damage(turns: DataFrame) -> DataFrame:
    """conversations with a part of their rows dropped (gone), emptied, without sentence marks, repeated or given to the user.

    What happens to a row is told by the CRC-32 of `conv_id:turn`, where a null is a space, as it is in role and text.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"), said.alias("text"), (kind == 0).alias("gone"), F.explode(copies).alias("_copy")).drop("_copy")


def op13_repair(spark, sf_dir: str) -> DataFrame:
    """All of `conversations`, damaged and repaired."""
    configure(spark)
    return summaries(damage(table(spark, sf_dir, "conversations")))


_STEP = "list_reduce([i] || list_transform(range(8), lambda k: CAST(k AS BIGINT)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)"
_FIT = "((r.initial = 's' AND p.state = 0) OR (r.initial = 'u' AND p.state <> 2) OR (r.initial = 'a' AND p.state = 2))"
_MORE = f"CASE WHEN r.fault = 'truncated' THEN {CUT} ELSE 0 END"

#: An insertion never pays: to delete the turn that it would go with, and the system turn if nothing else is left, costs at most 4. So it isn't searched here.
OP13_SQL = rf"""
WITH RECURSIVE crc AS (SELECT list({_STEP} ORDER BY i) AS t FROM range(256) x(i)),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
dealt AS (SELECT conv_id, turn, role, text, xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) % 20 AS kind FROM named, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy FROM dealt, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n FROM damaged),
told AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair FROM placed),
paths(conv_id, n, state, best) AS (
SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, struct_pack(cost := CAST(0 AS BIGINT), audit := '', lines := CAST([] AS VARCHAR[])) FROM conversations
UNION ALL
SELECT conv_id, n, state, min(best) FROM (
SELECT p.conv_id, r.n, p.state, struct_pack(cost := p.best.cost + {DELETE}, audit := p.best.audit || 'D', lines := p.best.lines) AS best FROM paths p JOIN told r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1
UNION ALL
SELECT p.conv_id, r.n, CASE r.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, struct_pack(cost := p.best.cost + {KEEP} + {_MORE}, audit := p.best.audit || 'K', lines := list_append(p.best.lines, r.role || ':' || r.text)) FROM paths p JOIN told r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1 WHERE r.fault IN ('', 'truncated') AND {_FIT}
UNION ALL
SELECT p.conv_id, r.n, CASE p.state WHEN 2 THEN 3 ELSE 2 END, struct_pack(cost := p.best.cost + {REROLE} + {_MORE}, audit := p.best.audit || 'R', lines := list_append(p.best.lines, CASE p.state WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text)) FROM paths p JOIN told r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1 WHERE r.fault IN ('', 'truncated')
) GROUP BY conv_id, n, state),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv_id),
every AS (SELECT c.conv_id, coalesce(f.n, 0) AS n, gaps, blank, duplicate, truncated, illegal FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id),
ended AS (SELECT e.conv_id, min(p.best) AS best FROM every e JOIN paths p ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.n = p.n AND p.state IN (0, 3) GROUP BY e.conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
CAST(d.best.cost AS BIGINT) AS cost, d.best.audit AS audit, sha256(array_to_string(d.best.lines, chr(10))) AS repaired_sha256 FROM every e JOIN ended d ON e.conv_id IS NOT DISTINCT FROM d.conv_id
"""

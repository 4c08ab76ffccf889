"""Repair of conversations against a search over all edits and against SQL."""

import hashlib
import heapq
import random
import zlib

import duckdb
import pytest

from stratavox.llm import repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, fault string, place int, _key string"
WHITE = "\t\n\x0b\x0c\r "


def cheapest(rows):
    """rows: (role, text, fault). Dijkstra by (cost, audit) over turns read and roles kept, insertions included."""
    following = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if i == len(rows) and state in (0, 3):
            return cost, audit, "\n".join(lines)
        if (i, state) in done:
            continue
        done.add((i, state))
        go = lambda letter, w, j, s, line=None: heapq.heappush(queue, (cost + w, audit + letter, j, s, lines + ((line,) if line is not None else ())))  # noqa: B023, E731
        for c, role in (("u", "user"), ("a", "assistant")):
            if c in following[state]:
                go("I", 5, i, following[state][c], role + ":")
        if i < len(rows):
            role, text, fault = rows[i]
            go("D", 2, i + 1, state)
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] in following[state]:
                    go("K", more, i + 1, following[state][role[:1]], f"{role}:{text}")
                for c, new in (("u", "user"), ("a", "assistant")):
                    if c in following[state]:
                        go("R", 1 + more, i + 1, following[state][c], f"{new}:{text}")


def brute(rows):
    """SUMMARY of undamaged rows (conv_id, turn, role, text, gone) by plain loops."""
    out = []
    for conv_id in dict.fromkeys(r[0] for r in rows):
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, gone in rows if c == conv_id and not gone]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        told, seen = [], set()
        for _, role, text in own:
            said = text.strip(WHITE)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated"
            seen.add((role, text))
            told.append((role, text, fault))
        cost, audit, text = cheapest(told)
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == x for _, _, f in told) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
        out.append((conv_id, gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv_id, turn, role, text, kind == 0)] * (2 if kind == 3 else 1)
    return out


def some(seed, n):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "cut", "  ", "", None, "Why? \n", "Long one.\x0b", "é…", "." * 3, "a.b"]
    rows = []
    for conv_id in [*range(n), None]:
        turns = [None, None, *range(8)]
        for _ in range(rng.randint(1, 9)):
            rows.append((conv_id, rng.choice(turns), rng.choice(roles), rng.choice(texts)))
    return rows + rows[:5]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "k") for r in rows], SCHEMA)


def test_equals_search(spark):
    rows = some(1, 250)
    assert found(repair.summaries(table(spark, rows))) == brute([(*r, False) for r in rows])
    assert found(repair.summaries(repair.damage(table(spark, rows)))) == brute(damaged(rows))


@pytest.mark.parametrize(("block", "held"), [(1, 0), (3, 200)])
def test_blocks_and_files(spark, monkeypatch, block, held):
    """Within this process, as tasks don't see the patch: long conversations in blocks of few turns, texts in files."""
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "HELD", held)
    rows = [(r[0] % 3 if r[0] is not None else None, *r[1:]) for r in some(2, 40)]
    whole = repair.ordered(repair._rows(table(spark, rows))).coalesce(1).toArrow()
    mine = [tuple(x.values()) for b in repair.summary_rows(iter(whole.to_batches())) for x in b.to_pylist()]
    assert sorted(mine, key=repr) == brute([(*r, False) for r in rows])


def test_real_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "cut off"), (1, 3, "user", "Well?"), (1, 4, "user", "So."), (2, 0, "system", "Be."), (2, 1, "assistant", "No.")]
    out = repair.repair(table(spark, rows)).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.edit, r.role, r.text) for r in out] == [
        (1, "D", "user", "Hi."),
        (1, "D", "user", "Hi."),
        (1, "D", "assistant", "cut off"),
        (1, "K", "user", "Well?"),
        (1, "R", "assistant", "So."),
        (2, "R", "user", "Be."),
        (2, "K", "assistant", "No."),
    ]
    assert repair.summaries(table(spark, rows)).filter("conv_id = 2").first().cost == 1


def test_empty(spark):
    none = table(spark, [])
    assert repair.summaries(repair.damage(none)).collect() == repair.repair(none).collect() == []
    gone = repair.damage(table(spark, [(i, j, "user", "Hi.") for i in range(40) for j in range(1)]))
    empty = [r for r in repair.summaries(gone).collect() if r.audit == ""]
    assert empty and all((r.cost, r.repaired_sha256) == (0, hashlib.sha256(b"").hexdigest()) for r in empty)


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    mine = repair.op13_repair(spark, SF)
    theirs = con.execute(repair.OP13_SQL)
    assert [c[0] for c in theirs.description] == mine.columns
    assert sorted(theirs.fetchall()) == sorted(map(tuple, mine.collect()))

"""Tool calls: written conversations, and the query against DuckDB."""

import json

import duckdb
import pytest

from stratavox.llm import chat

SF = "/root/testdata/sf0.001"


def linked(spark, messages):
    frame = spark.createDataFrame(messages, "conv_id long, turn int, role string, text string, level string, key int")
    schemas = spark.createDataFrame([("add", "a", "integer", True), ("add", "b", "number", True), ("say", "to", "string", False)], "name string, field string, type string, required boolean")
    return {(r.conv_id, r.call_id): r for r in chat.link_calls(chat.tool_calls(frame), chat.tool_results(frame), schemas).collect()}


def call(i, name="add", arguments=None, depends=()):
    return {"id": i, "name": name, "arguments": {"b": 2.5, "a": 1} if arguments is None else arguments, "depends": list(depends)}


def said(conv, turn, *calls):
    return conv, turn, "assistant", json.dumps({"tool_calls": list(calls)}), "x", 1


def answered(conv, turn, i, content):
    return conv, turn, "tool", json.dumps({"tool_call_id": i, "content": content}), "x", 1


def test_calls_meet_results_in_order(spark):
    found = linked(spark, [
        said(1, 0, call("c", depends=["b", "gone"]), call("a")),
        said(1, 1, call("b", depends=["a"])),
        answered(1, 2, "a", "3.5"),
        answered(1, 3, "a", "later"),
        answered(2, 0, "c", "of another conversation"),
        (1, 4, "user", "no json", "x", 1),
        (1, None, None, None, None, None),
    ])
    assert {i: r.level for (_, i), r in found.items()} == {"a": 0, "b": 1, "c": 2}
    assert {i: r.answered for (_, i), r in found.items()} == {"a": True, "b": False, "c": False}
    assert found[1, "a"].json == '{"arguments":{"a":1,"b":2.5},"id":"a","name":"add","result":"3.5"}'


def test_arguments_are_validated(spark):
    cases = {"good": {"a": 1, "b": 2}, "missing": {"a": 1}, "wrong": {"a": "1", "b": 2}, "unknown": {"a": 1, "b": 2, "c": 3}, "text": '{"a": 1, "b": 2}'}
    found = linked(spark, [said(1, 0, *[call(i, arguments=x) for i, x in cases.items()], call("free", name="other", arguments={"z": 1}), call("to", name="say", arguments={}))])
    assert {i: r.problems == 0 for (_, i), r in found.items()} == {"good": True, "missing": False, "wrong": False, "unknown": False, "text": True, "free": True, "to": True}


def test_cycles_and_repeats(spark):
    found = linked(spark, [said(1, 0, call("a", depends=["b"]), call("b", depends=["a"]), call("c", depends=["a"]), call("d")), said(1, 5, call("d", depends=["a"])), said(None, 0, call("e"))])
    assert {i: r.level for (_, i), r in found.items()} == {"a": None, "b": None, "c": None, "d": 0, "e": 0}
    assert linked(spark, [(1, 0, "user", "", None, None)]) == {}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    found = con.execute(chat.OP5_SQL)
    columns = [c[0] for c in found.description]
    mine = chat.op5_chat(spark, SF)
    assert sorted(columns) == sorted(mine.columns)
    assert sorted(map(repr, (tuple(r) for r in mine.select(*columns).collect()))) == sorted(map(repr, found.fetchall()))


def against_sql(spark, path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet/*.parquet'")
    found = con.execute(chat.OP5_SQL)
    columns = [c[0] for c in found.description]
    mine = sorted(map(repr, (tuple(r) for r in chat.op5_chat(spark, str(path)).select(*columns).collect())))
    return mine, sorted(map(repr, found.fetchall()))


def test_a_long_conversation_takes_few_rounds(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(chat, "materialise", lambda df, name, f=chat.materialise: written.append(name) or f(df, name))
    rows = [(7, i, "assistant" if i % 2 else "user", f"said {i}") for i in range(1200)] + [(c, 0, "user", None) for c in range(6)]
    mine, sql = against_sql(spark, tmp_path, rows)
    assert mine == sql and len(mine) == 606
    assert len(written) <= 26  # the order, the calls, and two a round: 2^10 steps reach past 600


def test_repeated_turns_are_calls_of_their_own(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 4, "user", "d"), (2, 3, "user", "e"), (2, 3, "user", "e")]
    mine, sql = against_sql(spark, tmp_path, rows)
    assert mine == sql and len(mine) == 7


@pytest.mark.parametrize("n", [1, 2, 7, 8])
def test_levels_are_longest_walks(spark, n):
    edges = [(f"n{i}", f"n{j}") for i in range(n) for j in (i - 1, i - 3, 0) if 0 <= j < i] + [("x", "y"), ("y", "x"), ("z", "x"), ("z", "n0"), ("n0", "gone")]
    nodes = [(f"n{i}",) for i in range(n)] + [("x",), ("y",), ("z",)]
    found = chat.levels(spark.createDataFrame(edges, "key string, dep string"), spark.createDataFrame(nodes, "key string"))
    assert {r.key: r.level for r in found.collect()} == {f"n{i}": i for i in range(n)} | {"x": None, "y": None, "z": None}


def test_numbers_and_nulls_are_canonical(spark):
    made = [{"a": 1.0, "b": 2.50, "c": None, "d": "1.0 and 2.50, \"3.0\" too"}, [1.0], "no json"]
    found = linked(spark, [said(1, 0, *[call(f"c{i}", arguments=x) for i, x in enumerate(made)], call("e", arguments='{"a": 1e2, "b": 10}'))])
    assert json.loads(found[1, "c0"].json)["arguments"] == made[0] and '{"a":1,"b":2.5,"c":null,' in found[1, "c0"].json
    assert found[1, "e"].json == '{"arguments":{"a":100,"b":10},"id":"e","name":"add"}' and found[1, "e"].problems in (0, 2)
    assert (found[1, "c1"].problems, found[1, "c2"].problems) == (1, 1)


def test_levels_of_graphs_match_brute_force(spark):
    import random

    rng = random.Random(5)
    n = 5000
    edges = [(i, i - 1) for i in range(1, n)] + [(n + i, n + (i + 1) % 7) for i in range(7)] + [(n + 10, n + 3), (n + 20, n + 20), (n + 21, n + 20)]
    edges += [(n + 100 + i, n + 100 + rng.randrange(i)) for i in range(1, 60) for _ in range(3)] + [(n + 21, 5), (n + 200, 4000), (n + 200, n + 150), (n + 300, 10**9)]
    nodes = sorted({x for e in edges for x in e if x < 10**9})
    deps, known = {i: {d for k, d in edges if k == i and d < 10**9} for i in nodes if i >= n}, {i: i for i in range(n)}
    for _ in range(100):
        for i in deps:
            if all(d in known for d in deps[i]):
                known[i] = 1 + max((known[d] for d in deps[i]), default=-1)
    frame = spark.createDataFrame([(str(a), str(b)) for a, b in edges], "key string, dep string")
    found = {int(r.key): r.level for r in chat.levels(frame, spark.createDataFrame([(str(i),) for i in nodes], "key string")).collect()}
    assert found == {i: known.get(i) for i in nodes}

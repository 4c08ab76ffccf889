"""Tool calls of conversations linked to their results, ordered, validated and serialised, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm.common import configure, drop, materialise, table

CALLS = "array<struct<id:string,name:string,arguments:variant,depends:array<string>>>"
#: A level that no chain of calls reaches.
ENDLESS = 1 << 40
JSON_TYPES = {"STRING": "string", "BIGINT": "integer", "DOUBLE": "number", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object", "VOID": "null"}


def tool_calls(messages: DataFrame) -> DataFrame:
    """conv_id, call_id, turn, name, arguments (variant) and depends of the calls in assistant messages.

    A message's text is {"tool_calls": [{"id", "name", "arguments", "depends"}]}; arguments may be an object or the JSON
    text of one. Other messages have no calls.
    """
    found = messages.filter("role = 'assistant'").select("conv_id", "turn", F.explode(F.try_variant_get(F.try_parse_json("text"), "$.tool_calls", CALLS)).alias("c"))
    given = F.try_variant_get("c.arguments", "$", "string")
    own = F.when(F.schema_of_variant("c.arguments") == "STRING", F.try_parse_json(given)).otherwise(F.col("c.arguments"))
    return found.select("conv_id", F.col("c.id").alias("call_id"), "turn", F.col("c.name").alias("name"), own.alias("arguments"), F.coalesce("c.depends", F.array().cast("array<string>")).alias("depends"))


def tool_results(messages: DataFrame) -> DataFrame:
    """conv_id, call_id, turn and content of tool messages, whose text is {"tool_call_id", "content"}."""
    v = F.try_parse_json("text")
    got = messages.filter("role = 'tool'").select("conv_id", F.try_variant_get(v, "$.tool_call_id", "string").alias("call_id"), "turn", F.try_variant_get(v, "$.content", "string").alias("content"))
    return got.filter("call_id is not null")


def levels(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """key and level of every node: 0 without dependencies, else one more than the deepest; null on a cycle or behind one.

    Rounds double the length of the walks in hand (key, dep), so they are logarithmic in the depth. A node that such a
    walk leaves is at least as deep as its length and the deepest of its ends; shorter walks may have given more. A node
    that depends on itself counts as deeper than all others. A walk longer than there are nodes with dependencies
    repeats one. A chain has one walk a node and round; where nodes have many dependencies each, the pairs of a round can
    grow towards all pairs of a conversation.
    """
    every = edges.join(nodes.select(F.col("key").alias("dep")), "dep", "left_semi").select("key", "dep").distinct()
    level = F.max(F.when(F.col("key") == F.col("dep"), ENDLESS).otherwise(0)).cast("long").alias("level")
    known = materialise(every.groupBy("key").agg(level), "chat-levels")
    walks = materialise(every.filter("key <> dep"), "chat-walks")
    most, length = known.count(), 1
    while length <= most and not walks.isEmpty():
        ends = walks.join(known.withColumnRenamed("key", "dep"), "dep", "left").groupBy("key").agg((F.lit(length) + F.max(F.coalesce("level", F.lit(0)))).alias("_deep"))
        deeper = materialise(known.join(ends, "key", "left").select("key", F.greatest("_deep", "level").alias("level")), "chat-levels")
        longer = materialise(walks.join(walks.select(F.col("key").alias("dep"), F.col("dep").alias("_end")), "dep").select("key", F.col("_end").alias("dep")).distinct(), "chat-walks")
        drop(known, walks)
        known, walks, length = deeper, longer, 2 * length
    endless = walks.select("key", F.lit(True).alias("_endless")).distinct()
    found = nodes.select("key").distinct().join(known, "key", "left").join(endless, "key", "left")
    return found.select("key", F.when(F.col("_endless").isNull() & (F.coalesce("level", F.lit(0)) < ENDLESS), F.coalesce("level", F.lit(0))).cast("int").alias("level"))


def canonical(text) -> F.Column:
    """JSON whose numbers have no zeros at the end of their fraction; strings stay as they are."""
    quoted = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|(?<=[0-9])'
    whole = F.regexp_replace(text, quoted + r"\.0++(?![0-9eE])", "$1")
    return F.regexp_replace(whole, quoted + r"(\.[0-9]*?[1-9])0++(?![0-9eE])", "$1$2")


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """key and problems of each call with key, name and arguments; schemas has name, field, type and required.

    A call is checked if its name has a schema: every argument must be known and of its type, an integer also being a
    number, and every required one there; a required one of another type is two problems. Arguments that aren't an object
    are one problem.
    """
    known = schemas.groupBy("name").agg(F.sum(F.col("required").cast("int")).alias("n_required"))
    fields = F.try_variant_get("arguments", "$", "map<string,variant>")
    each = calls.select("key", "name", fields.isNull().alias("_none"), F.explode_outer(fields).alias("field", "value"))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^([A-Z]+)", 1)
    named = F.create_map(*[F.lit(x) for pair in JSON_TYPES.items() for x in pair])[kind]
    each = each.withColumn("got", F.when(kind == "DECIMAL", "number").otherwise(named))
    ok = (F.col("got") == F.col("type")) | (F.col("got").isin("integer") & F.col("type").isin("number"))
    rules = schemas.select(F.col("name").alias("_name"), F.col("field").alias("_field"), "type", "required")
    joined = each.join(rules, (F.col("name") == F.col("_name")) & (F.col("field") == F.col("_field")), "left")
    sums = joined.groupBy("key", "name").agg(F.max("_none").alias("_none"), F.count("field").alias("given"), F.sum(F.when(ok, 1).otherwise(0)).alias("right"), F.sum(F.when(ok & F.col("required"), 1).otherwise(0)).alias("have"))
    both = sums.join(known, "name", "left")
    problems = F.when(F.col("n_required").isNull(), 0).when(F.col("_none"), 1).otherwise(F.col("given") - F.col("right") + F.col("n_required") - F.col("have"))
    return both.select("key", problems.cast("long").alias("problems"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, call_id, turn, name, level, problems, answered and json of every call.

    Calls and results meet by a hash join on conversation and identifier. A call's level is its place in the
    topological order of what it depends on; dependencies that aren't there don't count. json has sorted keys, no
    space, plain numbers and explicit nulls within arguments. Of calls or results with one identifier the earliest turn counts. Calls without a conversation or an
    identifier have level 0 and no result. A call whose arguments aren't JSON has null arguments. Empty tables give no rows.
    A column copy tells calls with one identifier apart, so that all of them count: depends then has identifier, \\x1f
    and copy, and a result goes to each of them.
    """
    key = F.when(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull(), F.concat_ws("\x1f", F.col("conv_id").cast("string"), "call_id"))
    own = F.concat_ws("\x1f", key, F.col("copy").cast("string")) if "copy" in calls.columns else key
    rows = calls.withColumn("ask", key).withColumn("key", F.when(F.col("ask").isNotNull(), own))
    text = F.to_json(F.struct(F.col("arguments").alias("a")))
    plain = rows.withColumn("a", text).drop("arguments")
    first = plain.filter("key is not null").groupBy("key").agg(F.min_by(F.struct("ask", "conv_id", "call_id", "turn", "name", "depends", "a"), F.struct("turn", "name", "a")).alias("c")).select("key", "c.*")
    loose = plain.filter("key is null").select(F.lit(None).cast("string").alias("key"), "ask", "conv_id", "call_id", "turn", "name", "depends", "a")
    one = materialise(first, "chat-calls")
    edges = one.select("key", F.explode("depends").alias("d"), "conv_id").select("key", F.concat_ws("\x1f", F.col("conv_id").cast("string"), "d").alias("dep"))
    level = levels(edges, one.select("key"))
    args = F.try_variant_get(F.try_parse_json("a"), "$.a", "variant")
    checked = validated(one.withColumn("arguments", args), schemas)
    answers = results.filter("conv_id is not null and call_id is not null").groupBy(key.alias("ask")).agg(F.min_by("content", F.struct("turn", "content")).alias("content"), F.lit(True).alias("answered"))
    full = one.join(level, "key", "left").join(checked, "key", "left").join(answers, "ask", "left")
    loose = loose.withColumns({"level": F.lit(0), "problems": F.lit(0).cast("long"), "content": F.lit(None).cast("string"), "answered": F.lit(None).cast("boolean")})
    every = full.unionByName(loose).withColumn("arguments", args)
    fields = F.struct("arguments", F.col("call_id").alias("id"), "name", F.col("content").alias("result"))
    return every.select("conv_id", "call_id", "turn", "name", "level", "problems", F.coalesce("answered", F.lit(False)).alias("answered"), canonical(F.to_json(fields)).alias("json"))


def in_order(rows: DataFrame, *by: str) -> DataFrame:
    """rows with _at, _after and _last: an ascending number by the columns, that of the row before, and that row itself.

    Rows are dealt out by ranges of the columns and a number of their own, so a group of any size, equal rows included,
    spreads over tasks. Numbers follow each other within a range; the first of a range meets the last of the range before.
    """
    spread = rows.withColumn("_own", F.monotonically_increasing_id()).repartitionByRange(*by, "_own").sortWithinPartitions(*by, "_own")
    placed = materialise(spread.drop("_own").withColumn("_at", F.monotonically_increasing_id()), "chat-order")
    part = F.shiftright("_at", 33)
    ends = placed.groupBy(part.alias("_part")).agg(F.min("_at").alias("_at"), F.max("_at").alias("_end"))
    edges = ends.select("_at", F.lag("_end").over(Window.orderBy("_part")).alias("_edge"))
    after = placed.join(F.broadcast(edges), "_at", "left").withColumn("_after", F.when(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) == 0, F.col("_edge")).otherwise(F.col("_at") - 1))
    return after.drop("_edge").join(placed.select(F.col("_at").alias("_after"), F.struct(*by).alias("_last")), "_after", "left")


def op5_chat(spark, sf_dir: str) -> DataFrame:
    """The turns of conversations as calls and results: what isn't an assistant's turn calls for the next turn's answer.

    The length of its text decides how an ask is called. It depends on the ask before it in its conversation, unless its
    length is a multiple of 4; on one that isn't there, if even; on itself, if a multiple of 11. By the remainder by 5
    its arguments are right, lack one, have one of a wrong type, have an unknown null, or aren't an object. Asks repeated
    at one turn are calls of their own, one after the other; of repeated answers the least text counts.
    """
    configure(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    asks = in_order(turns.filter("role <> 'assistant'").withColumn("n", F.char_length("text")), "conv_id", "turn", "role", "n")
    n, given = F.col("n"), lambda *c: F.to_json(F.struct(*c))
    kinds = [given("n", "text", "turn"), given("text", "turn"), given(n.cast("string").alias("n"), "text", "turn"), F.concat(F.lit('{"mood":null,'), F.substring(given("n", "text", "turn"), 2, 2**31 - 1)), F.to_json(F.array("n"))]
    arguments = F.parse_json(F.element_at(F.array(*[F.when(n % 5 == i, k) for i, k in enumerate(kinds)]), n % 5 + 1))
    own, before = (F.concat(F.lit("t"), t, F.lit("\x1f"), at) for t, at in (("turn", "_at"), ("_last.turn", "_after")))
    chained = (F.col("_last.conv_id") == F.col("conv_id")) & (n % 4 != 0)
    depends = F.filter(F.array(F.when(chained, before), F.when(n % 2 == 0, "t-1"), F.when(n % 11 == 0, own)), lambda d: d.isNotNull())
    calls = asks.select("conv_id", F.concat(F.lit("t"), "turn").alias("call_id"), "turn", F.col("role").alias("name"), arguments.alias("arguments"), depends.alias("depends"), F.col("_at").alias("copy"))
    results = turns.filter("role = 'assistant'").select("conv_id", F.concat(F.lit("t"), (F.col("turn") - 1).cast("string")).alias("call_id"), "turn", F.col("text").alias("content"))
    rows = ", ".join(f"('{r}', '{f}', '{k}', true)" for r, number in (("system", "number"), ("user", "integer")) for f, k in (("n", number), ("text", "string"), ("turn", "integer")))
    return link_calls(calls, results, spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, field, type, required)"))


OP5_SQL = """
WITH RECURSIVE asks AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                               row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, length(coalesce(text, ''))) AS k
                        FROM conversations WHERE role <> 'assistant'),
     lv AS (SELECT conv_id, k, 0 AS level FROM asks WHERE n % 11 <> 0 AND (k = 1 OR n % 4 = 0)
            UNION ALL
            SELECT a.conv_id, a.k, lv.level + 1 FROM lv JOIN asks a ON a.conv_id = lv.conv_id AND a.k = lv.k + 1 WHERE a.n % 11 <> 0 AND a.n % 4 <> 0),
     answers AS (SELECT conv_id, turn - 1 AS turn, coalesce(text, '') AS content FROM conversations WHERE role = 'assistant')
SELECT a.conv_id, 't' || a.turn AS call_id, a.turn, a.role AS name, CAST(lv.level AS INTEGER) AS level,
       CAST(CASE a.n % 5 WHEN 0 THEN 0 WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS problems,
       b.content IS NOT NULL AS answered,
       '{"arguments":' || CASE a.n % 5 WHEN 0 THEN '{"n":' || a.n || ',' WHEN 1 THEN '{' WHEN 2 THEN '{"n":"' || a.n || '",' WHEN 3 THEN '{"mood":null,"n":' || a.n || ',' ELSE '[' || a.n || ']' END
       || CASE a.n % 5 WHEN 4 THEN '' ELSE '"text":' || to_json(a.text) || ',"turn":' || a.turn || '}' END
       || ',"id":"t' || a.turn || '","name":"' || a.role || '"' || coalesce(',"result":' || to_json(b.content), '') || '}' AS json
FROM asks a LEFT JOIN lv ON lv.conv_id = a.conv_id AND lv.k = a.k LEFT JOIN answers b ON a.conv_id = b.conv_id AND a.turn = b.turn
"""

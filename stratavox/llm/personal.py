"""Personal data: four base patterns, then bootstrapped contextual extraction, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import configure, drop, materialise, table, text_of

# The contract's patterns. Possessive loops and the look-behinds find the same leftmost matches without backtracking:
# a match that fails at the first character of a run fails at each later one too.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
IP = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
#: What may identify somebody: up to several groups of digits and marks, or a token with a digit or an @. The look-behinds keep the search linear.
TOKEN = r"(?<![^\x20\x09-\x0D])(?:(?=[().+-]*+[0-9])[0-9().+-]++(?:\x20[0-9().+-]++(?![^\x20\x09-\x0D]))++|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)"
#: An instance must have so many digits, or an @ within.
INSTANCE = r"(?:[0-9][^0-9]*+){5}|[^@]@[^@]"
#: Kinds that have no base pattern, and what their seeds look like. A seed is a span only where a context confirms it.
SECRET = r"^(?=[^0-9]*+[0-9])(?=[^a-f]*+[a-f])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
FURTHER = ["secret"]
EVERY = KINDS + FURTHER
#: A pattern needs so many distinct known instances of a kind, and this share of all its distinct instances.
SUPPORT, CONFIDENCE, ROUNDS = 5, 0.8, 3
#: Parts of what one context, instance or document has, as any may be common.
SALTS = 16
#: Offsets are summed up in blocks of so many matches, so that long lists of matches aren't copied once for each.
BLOCK = 128

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
FOUND = "array<struct<start:int,end:int,found:string,left:string,right:string>>"


def _none(kind: str) -> Column:
    return F.from_json(F.lit("[]"), kind)


def _running(lengths: Column) -> Column:
    """The sums of an array before each of its elements. Blocks are summed apart, as growing an array copies it."""
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda acc, x: acc + x)
    sums = lambda xs: F.aggregate(xs, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    n = F.ceil(F.size(lengths) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), n), lambda i: F.slice(lengths, (i - 1) * BLOCK + 1, F.lit(BLOCK)))
    within = F.transform(blocks, lambda xs: F.struct(sums(xs).alias("upto"), total(xs).alias("all")))
    each = F.transform(F.arrays_zip(within.alias("w"), sums(F.transform(within, lambda w: w["all"])).alias("before")), lambda z: F.transform(F.slice(z["w"]["upto"], 1, F.size(z["w"]["upto"]) - 1), lambda x: x + z["before"]))
    return F.when(F.size(lengths) > 0, F.flatten(F.filter(each, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<int>"))


def _matches(text: Column, pattern: str, gate: Column) -> Column:
    """All matches with their code point offsets, the text between them and their neighbours, and these neighbours."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = F.transform(found, lambda m, i: (F.char_length(F.get(between, i)) + F.char_length(m)).cast("int"))
    given = F.struct(found.alias("f"), between.alias("b"), _running(steps).alias("upto"))

    def one(g: Column) -> Column:
        at = lambda xs, i: F.coalesce(F.get(xs, i), F.lit(""))

        def match(m: Column, i: Column) -> Column:
            start = (F.get(g["upto"], i) + F.char_length(F.get(g["b"], i))).cast("int")
            left = F.concat(at(g["f"], i - 2), at(g["b"], i - 1), at(g["f"], i - 1), F.get(g["b"], i))
            right = F.concat(F.get(g["b"], i + 1), at(g["f"], i + 1))
            return F.struct(start.alias("start"), (start + F.char_length(m)).cast("int").alias("end"), m.alias("found"), left.alias("left"), right.alias("right"))

        return F.transform(g["f"], match)

    return F.when(gate, F.get(F.transform(F.array(given), one), 0)).otherwise(_none(FOUND))


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.char_length(digits)
    if kind == "ip":
        return found.rlike(IP)
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """The spans of the four patterns, by start and then by kind as listed."""
    gates = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike(PATTERNS["ip"]), "card": text.rlike(PATTERNS["card"])}
    def of(rank: int, kind: str) -> Column:
        good = F.filter(_matches(text, PATTERNS[kind], gates[kind]), lambda m: _valid(kind, m["found"]))
        return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.sort_array(F.concat(*[of(rank, kind) for rank, kind in enumerate(KINDS)]))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def _scanned(docs: DataFrame) -> DataFrame:
    """A row per document: its id, a hash of its text, base spans, and identifier-like tokens with their context.

    A token goes without the marks around it. Context is the words beside it in the whole text, those with digits too,
    in small letters, with every digit as 0 and without marks, unless they are nothing but marks.
    """
    text = text_of(docs)
    tokens = F.filter(_matches(text, TOKEN, text.rlike(INSTANCE)), lambda m: m["found"].rlike(INSTANCE))
    bare = lambda c: F.regexp_replace(c, r"(?<![^\x20])[^\p{L}\p{N}\x20]++(?=[\p{L}\p{N}])|(?<=[\p{L}\p{N}])[^\p{L}\p{N}\x20]++(?![^\x20])", "")
    word = lambda c, p: bare(F.regexp_replace(F.lower(F.regexp_replace(F.regexp_extract(c, p, 1), "[0-9]", "0")), r"[\x20\x09-\x0D]+", " "))

    def context(m: Column) -> Column:
        ahead = F.char_length(F.regexp_extract(m["found"], r"^[^\p{L}\p{N}+(]*+", 0))
        core = F.regexp_replace(m["found"], r"^[^\p{L}\p{N}+(]++|(?<=[\p{L}\p{N})])[^\p{L}\p{N})]++$", "")
        start = (m["start"] + ahead).cast("int")
        return F.struct(
            start.alias("start"),
            (start + F.char_length(core)).cast("int").alias("end"),
            F.lower(core).alias("instance"),
            word(m["left"], r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++$").alias("left"),
            word(m["left"], r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]++$").alias("left2"),
            word(m["right"], r"^[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)").alias("right"),
        )

    return docs.select("doc_id", F.xxhash64(text).alias("_hash"), base_spans(text).alias("base"), F.transform(tokens, context).alias("tokens"))


def _salted(rows: DataFrame, by: str) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))


def _for_salts(rows: DataFrame) -> DataFrame:
    """Each row once for every salt: the narrow side of a join whose other side may have a common key."""
    return rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _bootstrap(scanned: DataFrame) -> DataFrame:
    """The spans that high-confidence contexts find beyond the base spans: doc_id, _hash, found."""
    one = scanned.select("doc_id", "_hash", "base", F.explode("tokens").alias("t")).select("doc_id", "_hash", "base", "t.*")
    over = F.filter("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    base = F.get(over, 0)["kind"]
    seen = materialise(one.withColumns({"base": base.isNotNull(), "seed": F.coalesce(base, F.when(F.col("instance").rlike(SECRET), "secret"))}), "pii-tokens")
    patterns = F.array(
        F.when(F.col("left2") != "", F.concat(F.lit("ll "), "left2")),
        F.when(F.col("left") != "", F.concat(F.lit("l "), "left")),
        F.when((F.col("left") != "") & (F.col("right") != ""), F.concat_ws(" ", F.lit("lr"), "left", "right")),
        F.when(F.col("right") != "", F.concat(F.lit("r "), "right")),
    )
    edges = seen.select("instance", F.explode(F.filter(patterns, lambda p: p.isNotNull())).alias("pattern")).distinct()
    edges = materialise(edges, "pii-edges")
    kinds = F.array(*map(F.lit, EVERY))
    seeds = materialise(seen.filter("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct(), "pii-seeds")
    learnt = None
    for _ in range(ROUNDS):
        scores = seeds if learnt is None else seeds.unionByName(learnt)
        known = scores.groupBy("instance").agg(*[F.max(F.when(F.col("kind") == k, F.col("score"))).alias(k) for k in EVERY])
        sums = [x for k in EVERY for x in (F.sum(F.coalesce(F.col(k), F.lit(0.0))).alias(f"s_{k}"), F.count(k).alias(f"n_{k}"))]
        rated = _salted(edges, "pattern").join(_for_salts(known), ["instance", "_salt"], "left").groupBy("pattern").agg(F.count("*").alias("n"), *sums)
        best = F.array_max(F.array(*[F.struct((F.col(f"s_{k}") / F.col("n")).alias("conf"), F.col(f"n_{k}").alias("support"), F.lit(k).alias("kind")) for k in EVERY]))
        good = rated.select("pattern", best.alias("b")).filter((F.col("b.support") >= SUPPORT) & (F.col("b.conf") >= CONFIDENCE))
        none = F.log1p(-F.least("b.conf", F.lit(0.99)))
        new = _salted(edges, "instance").join(_for_salts(good), ["pattern", "_salt"]).groupBy("instance", F.col("b.kind").alias("kind")).agg((1 - F.exp(F.sum(none))).alias("score"))
        before, learnt = learnt, materialise(new.filter(F.col("score") >= CONFIDENCE), "pii-scores")
        if before is not None:
            drop(before)
    rank = (F.array_position(kinds, F.col("kind")) - 1).cast("int")
    named = learnt.groupBy("instance").agg(F.max_by("kind", F.struct("score", -rank)).alias("kind"))
    spans = _salted(seen.filter("not base"), "_hash").join(_for_salts(named), ["instance", "_salt"]).select("doc_id", "_hash", F.struct("start", rank.alias("rank"), "end", "kind").alias("span"))
    found = materialise(spans.groupBy("doc_id", "_hash").agg(F.sort_array(F.collect_set("span")).alias("found")), "pii-found")
    drop(seen, edges, seeds, learnt)
    return found


def find_personal(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, a hash of its text (_hash), base spans and further spans found by context.

    The base spans, and tokens that look like a secret, seed a graph of lexical contexts and identifier-like tokens. In
    each of a few rounds a context scores the share of its distinct tokens that are known to be of one kind; contexts
    above a threshold, with enough known tokens, pass their kind on to their other tokens. Tokens that such contexts
    name at the end are spans wherever they occur, unless they overlap a base span. Nulls and empty texts have no
    spans. Repeated rows get equal spans each; an empty table gives no rows.
    """
    scanned = materialise(_scanned(docs), "pii-scanned")
    found = _bootstrap(scanned)
    same = scanned["doc_id"].eqNullSafe(found["doc_id"]) & (scanned["_hash"] == found["_hash"])
    return scanned.join(found, same, "left").select(scanned["doc_id"], scanned["_hash"], "base", F.coalesce("found", _none(SPAN)).alias("found"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    Only texts that could have a span meet the spans: those with an address of four numbers or what an instance must have,
    as every other base span does. The rest pass as they are, without a shuffle.
    """
    text = text_of(docs)
    may = text.rlike(INSTANCE) | text.rlike(PATTERNS["ip"])
    spans = find_personal(docs).filter("size(base) + size(found) > 0").select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), F.sort_array(F.concat("base", "found")).alias("_spans")).distinct()
    spans = materialise(spans, "pii-spans")
    row = docs.filter(may).select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_own"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    both = row.join(spans, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")

    def merge(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), last["rank"].alias("rank"), F.greatest(last["end"], x["end"]).alias("end"), last["kind"].alias("kind"))
        head = F.slice(acc, 1, F.size(acc) - 1)
        return F.when((F.size(acc) > 0) & (x["start"] < last["end"]), F.concat(head, F.array(grown))).otherwise(F.concat(acc, F.array(x)))

    merged = both.withColumn("_spans", F.when(F.col("_spans").isNotNull(), F.aggregate("_spans", _none(SPAN), merge)))

    def piece(x: Column, i: Column) -> Column:
        start = F.coalesce(F.get(F.col("_spans"), i - 1)["end"], F.lit(0))
        return F.concat(F.substring(F.col("_text"), start + 1, x["start"] - start), F.lit("["), F.upper(x["kind"]), F.lit("]"))

    tail = F.substring(F.col("_text"), F.element_at("_spans", -1)["end"] + 1, F.lit(2**31 - 1))
    clean = F.concat(F.concat_ws("", F.transform("_spans", piece)), tail)
    columns = [F.when(F.col("_spans").isNotNull(), clean).otherwise(F.col("_row.text")).alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns]
    return merged.select(*columns).unionByName(docs.filter(~may))


def op3_personal(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    found = find_personal(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in KINDS]
    every = F.sort_array(F.concat("base", "found"))
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"), F.size("found").cast("long").alias("n_found"), F.size(every).cast("long").alias("n_spans"))

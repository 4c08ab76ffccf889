"""Mixing sources to target weights by systematic sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm.common import WORD, configure, materialise, table, text_of

#: Size classes to an octave. Within a class documents are ordered by size, so a class only bounds a task.
CLASSES = 16
#: A task orders at most about one part in so many of all rows.
PARTS = 2000


def _keyed(docs: DataFrame, size) -> DataFrame:
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("s"), docs["source"].cast("string")), F.lit("n")).alias("_src"),
        size.cast("long").alias("_size"),
        F.xxhash64("doc_id").alias("_tie"),
    ).withColumn("_class", F.floor(F.log2(F.col("_size") + 1) * CLASSES).cast("int"))


def source_targets(sizes: DataFrame, share: float = 1.5, weights: tuple = (5, 2, 1), most: float = 2.0) -> DataFrame:
    """sizes has a row per source (_src, source, source_size); returns it with its target.

    Sources by code point, null last, take the weights in turn and share `share` of all sizes; no target is above
    `most` times its source's size, and what that leaves is shared out again by weight. With the sources in order of
    cap to weight, those that reach their cap are a prefix, so running sums find the common level of the others.
    """
    n = len(weights)
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % n + 1).cast("int"))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_src")
    before = F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = (share * F.sum("source_size").over(every) - before) / rest
    return (
        sizes.withColumns({"_w": weight.cast("double"), "_cap": F.col("source_size") * most})
        .withColumns({"_level": level, "_at": F.row_number().over(by_cap)})
        .withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_w"))
        .withColumn("_level", F.min(F.when(~F.col("_full"), F.struct("_at", "_level"))).over(every)["_level"])
        .withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_level") * F.col("_w")))
        .select("_src", "source_size", "target")
    )


def draw(docs: DataFrame, size=None, share: float = 1.5, weights: tuple = (5, 2, 1), most: float = 2.0, seed: int = 7) -> DataFrame:
    """Every row of docs, as the struct _row, with its size, source_size, target and copies.

    A source's documents, ordered by size, each expect target / source_size copies. The running sum of that, from one
    random offset per source, crosses whole numbers; a document is emitted once per number crossed. Ordering by size
    keeps the words taken within about one document of the target. Counts per source, size class and salt give each
    bucket its first rank, so no task orders more than a small part of a source, however large the source is.

    A null text has size 0; a null source is a source of its own; a source without words has target 0 and its
    documents no copies. Repeated rows are rows like any other. An empty table gives an empty result. Further columns,
    whatever their names, stay in _row.
    """
    size = F.regexp_count(text_of(docs), F.lit(WORD)) if size is None else size
    keyed = _keyed(docs, size)
    narrow = materialise(keyed.select("source", "_src", "_size", "_tie", "_class"), "mix-sizes")
    classes = narrow.groupBy("_src", "_class").agg(F.count("*").alias("_n"), F.sum("_size").alias("_words"), F.first("source").alias("source"))
    salts = classes.select("_src", "_class", F.ceil(F.col("_n") * PARTS / F.sum("_n").over(Window.partitionBy())).cast("int").alias("_salts"))
    salts = materialise(salts, "mix-salts")
    salt = F.pmod(F.col("_tie"), F.col("_salts")).cast("int")
    counts = narrow.join(salts, ["_src", "_class"]).groupBy("_src", "_class", salt.alias("_salt")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy("_src").orderBy("_class", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    targets = source_targets(classes.groupBy("_src").agg(F.first("source").alias("source"), F.sum("_words").alias("source_size")), share, weights, most)
    offset = F.pmod(F.xxhash64("_src", F.lit(seed)), F.lit(1 << 32)) / float(1 << 32)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    starts = (
        firsts.groupBy("_src", "_class")
        .agg(F.map_from_entries(F.collect_list(F.struct("_salt", "_first"))).alias("_firsts"), F.max("_salt").alias("_last"))
        .join(salts, ["_src", "_class"])
        .join(targets.withColumns({"_rate": rate, "_offset": offset}), "_src")
    )
    starts = materialise(starts, "mix-starts")
    own = keyed.join(starts, ["_src", "_class"]).withColumn("_salt", salt)
    within = Window.partitionBy("_src", "_class", "_salt").orderBy("_size", "_tie", "doc_id")
    rank = F.row_number().over(within) + F.col("_firsts")[F.col("_salt")]
    crossed = lambda k: F.floor(k * F.col("_rate") + F.col("_offset"))
    return own.withColumn("_rank", rank).select(
        "_row",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (crossed(F.col("_rank")) - crossed(F.col("_rank") - 1)).cast("int").alias("copies"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it was drawn, with the columns of docs."""
    drawn = draw(docs).filter("copies > 0")
    return drawn.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    sized = materialise(docs.select("doc_id", "source", F.regexp_count(text_of(docs), F.lit(WORD)).alias("words")), "mix-documents")
    return draw(sized, F.col("words")).select("_row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))

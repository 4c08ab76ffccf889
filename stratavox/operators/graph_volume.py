"""Volumes of supervoxels under a tree of labels: ancestors at a time, their surfaces, prefixes of their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.functions.codes import unsigned
from stratavox.operators import mesh, relabel, spatial


def tree_at(tree: DataFrame, time: int) -> DataFrame:
    """The links (child, parent, layer) of a tree that hold at a time: valid_from up to, but without, valid_to; a null end is open."""
    held = (F.col("valid_from").isNull() | (F.col("valid_from") <= time)) & (F.col("valid_to").isNull() | (F.col("valid_to") > time))
    return tree.filter(held).select("child", "parent", "layer")


def ancestors(vol: DataFrame, tree: DataFrame, levels: int, time: int | None = None) -> DataFrame:
    """The volume under the labels of so many layers above its supervoxels; those without an ancestor become background."""
    held = tree if time is None else tree_at(tree, time)
    table = spatial.parents(vol.select(F.col("label").alias("node")).distinct(), held, levels)
    return relabel.remap_only(vol, table.select(F.col("node").alias("old"), F.col("ancestor").alias("new")))


def surfaces(vol: DataFrame, tree: DataFrame, levels: int, time: int | None = None) -> DataFrame:
    """Triangles of the ancestors' surfaces: faces between supervoxels of one ancestor are inside."""
    return mesh.triangles(ancestors(vol, tree, levels, time))


def prefixes(spark: SparkSession, layer: int, layer_bits: int = 8, x_bits: int = 10, y_bits: int = 10, length: int = 6) -> DataFrame:
    """The first digits that decimal labels of a layer can have: layer, x and y are their highest bits, in this order."""
    high = layer << (64 - layer_bits)
    base = high - (1 << 64) if high >> 63 else high
    label = F.shiftleft(F.col("id"), 64 - layer_bits - x_bits - y_bits) + F.lit(base).cast("bigint")
    labels = spark.range(1 << (x_bits + y_bits)).select(label.alias("label"))
    return labels.select(F.substring(unsigned("label").cast("string"), 1, length).alias("prefix")).distinct()


def with_prefix(table: DataFrame, length: int = 6) -> DataFrame:
    """A table with the first digits of its labels, read as unsigned: what is merged or listed by prefix meets in one partition or folder."""
    return table.withColumn("prefix", F.substring(unsigned("label").cast("string"), 1, length))


def manifests(fragments: DataFrame, length: int = 6) -> DataFrame:
    """prefix, label, fragments and their names, in order, of each label from rows (label, name); labels of a prefix lie together.

    Only prefixes that labels have are there, so none has to be tried in vain.
    """
    own = fragments.select("label", "name").distinct().groupBy("label").agg(F.sort_array(F.collect_list("name")).alias("names"))
    return with_prefix(own, length).select("prefix", "label", F.size("names").cast("long").alias("fragments"), F.concat_ws(",", "names").alias("names"))


def merge_by_prefix(traced: DataFrame, path: str, length: int = 6) -> None:
    """Skeletons of a graph volume from fragments (see skeleton.forge), merged by label and written with a folder for each prefix: nodes and edges."""
    from stratavox.operators.skeleton import merge

    for name, found in zip(("nodes", "edges"), merge(traced), strict=True):
        with_prefix(found, length).repartition("prefix", "label").sortWithinPartitions("prefix", "label").write.mode("overwrite").partitionBy("prefix").parquet(f"{path}/{name}")

"""Skeletons and meshes of whole labels, merged from fragments and dealt to shards by label, in one call each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.functions.codes import hashed_label, shard_number
from stratavox.operators import mesh, skeleton
from stratavox.operators.select import AXES
from stratavox.plans.scales import ShardSpec
from stratavox.sources.shared import materialise

Size = tuple[int, int, int]


def routed(table: DataFrame, spec: ShardSpec, hashed: bool = False) -> DataFrame:
    """The table with the shard and minishard of its label: of the label's bits, or of its hash's."""
    shard, mini = shard_number(hashed_label(F.col("label")) if hashed else F.col("label"), spec.preshift, spec.minishard, spec.shard)
    return table.withColumns({"shard": shard, "minishard": mini})


def skeletons(
    traced: DataFrame, spec: ShardSpec, dust: float = 0, tick: float = 0, longest: float | None = None, resolution: Size = (1, 1, 1), hashed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of merged skeletons with their shards, without loops, short side branches and short skeletons.

    Skeletons with more cable than `longest` stay as they were merged. A node without edges is a skeleton of length 0.
    """
    edges = materialise(skeleton.merge(traced)[1], "merged-edges")
    nodes = materialise(skeleton.linked_nodes(traced), "merged-nodes")
    rest, whole = edges, None
    if longest is not None:
        whole = skeleton.cable_length(edges, resolution).filter(F.col("length") > longest).select("label")
        rest = edges.join(whole, "label", "left_anti")
    ends = skeleton.without_loops(rest, resolution)
    if tick > 0:
        ends = materialise(skeleton.without_ticks(ends, tick, resolution), "merged-clean")
    if dust > 0:
        ends = ends.join(skeleton.cable_length(ends, resolution).filter(F.col("length") >= dust).select("label"), "label", "left_semi")
    if whole is not None:
        ends = edges.join(whole, "label", "left_semi").unionByName(ends)
    joined = nodes.filter("linked").drop("linked")
    if tick > 0:
        held = ends.select("label", F.explode(F.array("a", "b")).alias("n")).select("label", "n.*").distinct()
        joined = joined.join(held, ["label", *AXES], "left_semi")
    elif dust > 0:
        joined = joined.join(ends.select("label").distinct(), "label", "left_semi")
    if dust <= 0:
        alone = nodes.filter("not linked").drop("linked")
        joined = joined.unionByName(alone.join(edges.select("label").distinct(), "label", "left_anti"))
    return routed(joined, spec, hashed), routed(ends, spec, hashed)


def meshes(pieces: DataFrame, spec: ShardSpec, chunk: int, lods: int = 1, hashed: bool = False) -> DataFrame:
    """Fragments of every level of detail of each label, in the order of a multi-resolution file, with their shards.

    `pieces` are triangles by cell of any size (label and an array of triangles, as mesh.fragments gives them): they are
    taken apart and gathered anew, so fragments of a task's cells become those of the octree. Each level draws corners to
    cells twice as wide. A row holds one fragment, so no task holds a label.
    """
    tris = pieces.select("label", F.explode("triangles").alias("t")).select("label", "t.*")
    tris = materialise(tris, "mesh-pieces")
    out = None
    for lod in range(lods):
        level = mesh.fragments(tris if lod == 0 else mesh.decimated(tris, 1 << lod), chunk, lod)
        out = level if out is None else out.unionByName(level)
    placed = mesh.gathered(out)
    return routed(placed.join(out.select("label", "lod", "code", "triangles"), ["label", "lod", "code"]), spec, hashed)

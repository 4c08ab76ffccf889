"""Labels of graph volumes across chunk borders: chunks with one voxel of overlap, renamed by the lowest layer that all neighbours share.

A voxel belongs to a node of its own chunk (layer 2); nodes have ancestors at layers 3 and up. A chunk's surfaces reach one
voxel into its later neighbours, whose nodes have other names; there a voxel takes the name of the chunk's own node that it
continues.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.operators.ccl import pieces_of
from stratavox.operators.mesh import triangles
from stratavox.operators.select import AXES
from stratavox.sources.shared import drop, materialise

Size = tuple[int, int, int]
AT = ["cx", "cy", "cz"]
#: The layer of the nodes of chunks.
BASE = 2
LABELLED = "cx long, cy long, cz long, x long, y long, z long, label long"


def agreed_layer(fan_out: int, top: int) -> Column:
    """The lowest layer on which the chunk cx, cy, cz and its seven later neighbours have one parent, the top layer at most."""
    out = F.lit(top)
    for k in range(top - BASE, 0, -1):
        same = F.lit(True)
        for c in AT:
            same &= F.floor(F.col(c) / fan_out**k) == F.floor((F.col(c) + 1) / fan_out**k)
        out = F.when(same, F.lit(BASE + k)).otherwise(out)
    return out.cast("int")


def lineage(links: DataFrame, top: int) -> DataFrame:
    """node, layer and root: the ancestors of chunks' nodes at each layer, from links (child, parent, layer of the parent)."""
    step = lambda layer: links.filter(F.col("layer") == layer)
    at = step(BASE + 1).select(F.col("child").alias("node"), F.col("parent").alias("root"))
    out = at.withColumn("layer", F.lit(BASE + 1))
    for layer in range(BASE + 2, top + 1):
        at = at.join(step(layer).select(F.col("child").alias("root"), F.col("parent").alias("up")), "root").select("node", F.col("up").alias("root"))
        out = out.unionByName(at.withColumn("layer", F.lit(layer)))
    return out


def windows(vol: DataFrame, chunk: Size) -> DataFrame:
    """Voxels (x, y, z, node) by chunk with its overlap: cx, cy, cz and whether they are the chunk's own.

    Only voxels on the low sides of a chunk go to an earlier neighbour as well: those of a corner to seven.
    """
    out = vol.select(*AXES, "node", *[F.floor(F.col(a) / s).cast("long").alias(c) for a, s, c in zip(AXES, chunk, AT, strict=True)], F.lit(True).alias("own"))
    for a, s, c in zip(AXES, chunk, AT, strict=True):
        back = F.when((F.pmod(F.col(a), F.lit(s)) == 0) & (F.col(c) > 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        out = out.withColumn("_d", F.explode(back)).withColumn(c, F.col(c) - F.col("_d")).withColumn("own", F.col("own") & (F.col("_d") == 0)).drop("_d")
    return out


def continued(chunk: Size):
    """For applyInArrow by chunk and root: the overlap's voxels of a root that several of the chunk's nodes have.

    Joined pieces of the overlap, corners included, take the least node of this root that one of their voxels continues across
    the chunk's far planes; a piece that continues none is left out.
    """
    size = tuple(c + 1 for c in chunk)

    def run(table: pa.Table) -> pa.Table:
        at = np.array([table[c][0].as_py() for c in AT])
        spots = np.stack([table[a].to_numpy() for a in AXES], axis=1) - at * chunk
        own, node = table["own"].to_numpy(zero_copy_only=False), table["node"].to_numpy()
        place = lambda p: p[:, 0] + size[0] * (p[:, 1] + size[1] * p[:, 2])
        order = np.argsort(place(spots))
        spots, own, node = spots[order], own[order], node[order]
        out = spots[~own]
        if not len(out):
            return pa.Table.from_pylist([], pa.schema([(n.split()[0], pa.int64()) for n in LABELLED.split(", ")]))
        piece = pieces_of(out, size, 26)
        inner, names = place(spots[own]), node[own]
        best = np.full(len(out), np.iinfo(np.int64).max)
        for axis in range(3):
            far = np.flatnonzero(out[:, axis] == chunk[axis])
            there = place(out[far] - np.eye(3, dtype=np.int64)[axis])
            k = np.minimum(np.searchsorted(inner, there), max(len(inner) - 1, 0))
            hit = inner[k] == there if len(inner) else np.zeros(len(far), bool)
            np.minimum.at(best, piece[far[hit]], names[k[hit]])
        label = best[piece]
        keep = label != np.iinfo(np.int64).max
        whole = out[keep] + at * chunk
        columns = [np.full(keep.sum(), c) for c in at] + [whole[:, i] for i in range(3)] + [label[keep]]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[n.split()[0] for n in LABELLED.split(", ")])

    return run


def overlap_labels(vol: DataFrame, links: DataFrame, chunk: Size, top: int, fan_out: int = 2) -> DataFrame:
    """LABELLED rows: the voxels of every chunk and of its overlap, each with the chunk's node that it belongs to or continues.

    A chunk's own voxels keep their node. Roots are ancestors at the agreed layer of the chunk: higher ones would join what
    touches only elsewhere. A root that one of the chunk's nodes has is safe: what has it in the overlap is named by this node. Of a root
    that several nodes have, the overlap's pieces are told apart by what they continue (see continued()). Voxels of other roots
    or without an ancestor are left out of the overlap. Repeated voxels count once.

    Nodes and roots are counted from distinct rows by chunk, so the volume itself is joined to small tables alone; of the
    volume only sides of chunks that have unsafe roots are grouped.
    """
    seen = materialise(windows(vol.distinct(), chunk), "overlap-voxels")
    known = seen.select(*AT, "node", "own").distinct().withColumn("layer", agreed_layer(fan_out, top))
    rooted = materialise(known.join(lineage(links, top), ["node", "layer"], "left").select(*AT, "node", "own", "root"), "overlap-roots")
    counts = rooted.filter("own and root is not null").groupBy(*AT, "root").agg(F.count("*").alias("n"), F.min("node").alias("only"))
    told = rooted.join(counts, [*AT, "root"], "left").withColumn("label", F.when(F.col("own"), F.col("node")).when(F.col("n") == 1, F.col("only")))
    told = materialise(told.select(*AT, "node", "own", "root", "n", "label"), "overlap-told")
    both = seen.join(told, [*AT, "node", "own"])
    sure = both.filter("label is not null").select(*AT, *AXES, "label")
    last = F.lit(False)
    for a, s in zip(AXES, chunk, strict=True):
        last |= F.pmod(F.col(a), F.lit(s)) == s - 1
    unsafe = both.filter((F.col("n") > 1) & (~F.col("own") | last)).select(*AT, *AXES, "node", "own", "root")
    pieces = unsafe.groupBy(*AT, "root").applyInArrow(continued(chunk), LABELLED)
    out = materialise(sure.unionByName(pieces), "overlap-labels")
    drop(seen, rooted, told)
    return out


def chunk_meshes(vol: DataFrame, links: DataFrame, chunk: Size, top: int, fan_out: int = 2, resolution: Size = (1, 1, 1)) -> DataFrame:
    """Triangles of every chunk's nodes with their overlap: cx, cy, cz, label and corners; neighbours' surfaces meet in the overlap."""
    found = overlap_labels(vol, links, chunk, top, fan_out)
    tris = triangles(found.select(F.struct(*AT, "label").alias("label"), *AXES), resolution)
    return tris.select("label.*", "a", "b", "c")

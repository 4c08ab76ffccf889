"""Connected components of a labelled volume: edges, star contraction, relabelling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.operators.relabel import ranked
from stratavox.operators.select import AXES, cell, threshold
from stratavox.operators.stats import voxel_counts
from stratavox.sources.shared import drop, materialise

Size = tuple[int, int, int]


def linear(shape: Size):
    """A voxel's linear id, x fastest."""
    return (F.col("x") + shape[0] * (F.col("y") + shape[1] * F.col("z"))).cast("bigint")


def edges(vol: DataFrame, shape: Size, connectivity: int = 6, label: str | None = None) -> DataFrame:
    """a < b: linear ids of neighbouring voxels, of one label if a label column is named.

    Half of the neighbourhood is enough. Each voxel is sent to its later neighbours' places and joined there.
    """
    steps = _half(connectivity)
    own = [label] if label else []
    offsets = F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, s, strict=True)]) for s in steps])
    out = vol.select(*AXES, *own, linear(shape).alias("a"), F.explode(offsets).alias("s"))
    there = out.select("a", *own, *[(F.col(a) + F.col(f"s.d{a}")).alias(a) for a in AXES])
    return there.join(vol.select(*AXES, *own, linear(shape).alias("b")), [*AXES, *own]).select("a", "b")


def contract(pairs: DataFrame) -> DataFrame:
    """node and root, the least node that edges (a, b) reach, by alternating large and small stars (Kiveris et al. 2014).

    A hub's edges can be split among tasks, as partial aggregation finds the least neighbour. Each round is written to
    the shared folder and takes the place of the one before it.
    """
    now = materialise(pairs.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        root = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = materialise(small.filter("u != v").distinct(), "stars")
        drop(now)
        now = after
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


#: Voxels of a volume are labelled by cells of this size; a group is one cell.
CELL: Size = (128, 128, 64)


def _half(connectivity: int) -> list[Size]:
    """Half of a neighbourhood: the steps to later voxels."""
    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (k, j, i) > (0, 0, 0)]
    return [s for s in steps if sum(map(abs, s)) <= {6: 1, 18: 2, 26: 3}[connectivity]]


def pieces_of(points: np.ndarray, size: Size, connectivity: int, label: np.ndarray | None = None) -> np.ndarray:
    """For points of a cell in the order of their linear ids: the first row of each point's piece."""
    own = points[:, 0] + size[0] * (points[:, 1] + size[1] * points[:, 2])
    ends = []
    for s in _half(connectivity):
        inside = np.flatnonzero(((points + s >= 0) & (points + s < size)).all(axis=1))
        there = own[inside] + s[0] + size[0] * (s[1] + size[1] * s[2])
        at = np.minimum(np.searchsorted(own, there), len(own) - 1)
        met = own[at] == there
        if label is not None:
            met &= label[at] == label[inside]
        ends.append((inside[met], at[met]))
    a, b = (np.concatenate(x) for x in zip(*ends, strict=True))
    root = np.arange(len(own))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        differ = low != high
        if not differ.any():
            return root
        a, b = a[differ], b[differ]
        np.minimum.at(root, high[differ], low[differ])
        while (root[root] != root).any():
            root = root[root]


def parts(vol: DataFrame, shape: Size, connectivity: int = 6, label: str | None = None, size: Size = CELL, dust: int = 0) -> DataFrame:
    """x, y, z, the label column if named, and part of every voxel: the least linear id of its piece within its cell.

    Pieces of fewer than `dust` voxels of the cell are left out. One shuffle brings a cell together.
    """
    names = [*AXES, *([label] if label else [])]
    keyed = vol.select(*[c.alias(n) for n, c in cell(size).items()], *names)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(list(AXES)[::-1], ignore_index=True)
        at = group[list(AXES)].to_numpy()
        local = at - group[["cx", "cy", "cz"]].to_numpy()[:1] * np.array(size)
        root = pieces_of(local, size, connectivity, group[label].to_numpy() if label else None)
        group["part"] = (at[:, 0] + shape[0] * (at[:, 1] + shape[1] * at[:, 2]))[root]
        return group.loc[np.bincount(root, minlength=len(root))[root] >= dust, [*names, "part"]]

    return keyed.groupBy("cx", "cy", "cz").applyInPandas(one, ", ".join(f"{n} long" for n in (*names, "part")))


def faces(found: DataFrame, size: Size = CELL) -> DataFrame:
    """The rows of parts() on the sides of their cells: all that other cells have to know."""
    side = F.lit(False)
    for a, s in zip(AXES, size, strict=True):
        side |= (F.col(a) % s == 0) | (F.col(a) % s == s - 1)
    return found.filter(side)


def links(found: DataFrame, connectivity: int = 6, label: str | None = None, size: Size = CELL) -> DataFrame:
    """a < b: parts of two cells that touch. Only voxels on the sides of cells are shuffled."""
    own = [label] if label else []
    border = faces(found, size)
    out = border.withColumn("s", F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, s, strict=True)]) for s in _half(connectivity)])))
    leaves = F.lit(False)
    for a, s in zip(AXES, size, strict=True):
        leaves |= F.floor((F.col(a) + F.col(f"s.d{a}")) / s) != F.floor(F.col(a) / s)
    there = out.filter(leaves).select(F.col("part").alias("_part"), *own, *[(F.col(a) + F.col(f"s.d{a}")).alias(a) for a in AXES])
    met = there.join(border, [*AXES, *own])
    return met.select(F.least("_part", "part").alias("a"), F.greatest("_part", "part").alias("b")).distinct()


def components(vol: DataFrame, shape: Size, connectivity: int = 6, label: str | None = None, size: Size = CELL, dust: int = 0) -> DataFrame:
    """x, y, z and component of every voxel: the least linear id in its component.

    Cells are labelled apart, and links between the parts of neighbouring cells are contracted; so what the rounds
    shuffle grows with the surface of cells, not with the voxels. Pieces of fewer than `dust` voxels of a cell go first.
    """
    found = materialise(parts(vol, shape, connectivity, label, size, dust), "ccl-parts")
    roots = contract(links(found, connectivity, label, size)).select(F.col("node").alias("part"), "root")
    return found.join(roots, "part", "left").select(*AXES, F.coalesce("root", "part").alias("component"))


def numbered(found: DataFrame) -> DataFrame:
    """component and number from 1, by least linear id."""
    return ranked(found.select("component").distinct(), "component", "number")


def sizes(found: DataFrame) -> DataFrame:
    return voxel_counts(found, "component")


def cell_offsets(grid: Size, size: Size, spark) -> DataFrame:
    """Task number and label offset of each cell of a grid, x fastest, cells overlapping by one voxel."""
    i = F.col("id")
    room = (size[0] + 1) * (size[1] + 1) * (size[2] + 1)
    cells = spark.range(grid[0] * grid[1] * grid[2])
    return cells.select((i % grid[0]).alias("gx"), (F.floor(i / grid[0]) % grid[1]).cast("bigint").alias("gy"), F.floor(i / (grid[0] * grid[1])).cast("bigint").alias("gz"), i.alias("task"), (i * room).alias("label_offset"))


def auto(vol: DataFrame, shape: Size, gte: float | None = None, lte: float | None = None, dust: int = 0, dust_scope: str = "global", size: Size = CELL, connectivity: int = 6) -> DataFrame:
    """Threshold, label, drop dust and number components from 1 in the order of their least voxel.

    dust_scope "cell" drops connected pieces that are small within their grid cell before cells are linked, so results
    depend on the cell; "global" drops components that are small as a whole.
    """
    kept = threshold(vol, gte, lte).filter("v") if gte is not None or lte is not None else vol
    label = "label" if "label" in kept.columns else None
    found = components(kept, shape, connectivity, label, size, dust if dust_scope == "cell" else 0)
    if dust and dust_scope == "global":
        found = found.join(sizes(found).filter(F.col("voxels") >= dust), "component", "left_semi")
    return found.join(numbered(found), "component").select(*AXES, F.col("number").alias("label"))


def fill_holes(vol: DataFrame, shape: Size) -> DataFrame:
    """Background that touches no side of the volume, as x, y, z and the label of a voxel beside it (the smallest)."""
    from stratavox.operators.select import positions

    empty = positions(vol.sparkSession, ((0, 0, 0), shape)).join(vol.select(*AXES), [*AXES], "left_anti")
    found = components(empty, shape)
    side = F.lit(False)
    for a, s in zip(AXES, shape, strict=True):
        side |= (F.col(a) == 0) | (F.col(a) == s - 1)
    holes = found.join(found.filter(side).select("component").distinct(), "component", "left_anti")
    steps = F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, s, strict=True)]) for s in ((1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1))])
    beside = holes.select("component", *AXES, F.explode(steps).alias("s")).select("component", *[(F.col(a) + F.col(f"s.d{a}")).alias(a) for a in AXES])
    of = beside.join(vol.select(*AXES, "label"), [*AXES]).groupBy("component").agg(F.min("label").alias("label"))
    return holes.join(of, "component").select(*AXES, "label")


def tissue_roi(vol: DataFrame, shape: Size, suppress: int, dust: int, factor: Size, connectivity: int = 26) -> DataFrame:
    """Inclusive boxes at level 0 of the bright components of a downsampled image."""
    from stratavox.operators.pool import average

    small = tuple(-(-s // f) for s, f in zip(shape, factor, strict=True))
    bright = average(vol, factor, shape=shape).filter(F.col("v") > suppress)
    found = components(bright, small, connectivity)
    ends = [x for i, a in enumerate(AXES) for x in ((F.min(a) * factor[i]).alias(f"{a}0"), ((F.max(a) + 1) * factor[i] - 1).alias(f"{a}1"))]
    return found.groupBy("component").agg(F.count("*").alias("voxels"), *ends).filter(F.col("voxels") >= dust)

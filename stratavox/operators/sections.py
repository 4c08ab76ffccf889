"""Cross sections of labels: voxels are cut by a plane into polygons, and what is joined with the node is summed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.operators.ccl import pieces_of
from stratavox.operators.select import AXES, Box
from stratavox.sources.shared import drop, materialise

Size = tuple[int, int, int]
#: Sections grow from cell to cell of this many voxels.
CELL: Size = (64, 64, 64)
AT = ["cx", "cy", "cz"]
NORMAL = ["nx", "ny", "nz"]
KEY = ["label", "step"]
#: A section's part in a cell (grown), or what it touches of a neighbouring cell; ids are places within the cell.
PARTS = "label long, step long, x long, y long, z long, nx double, ny double, nz double, cx long, cy long, cz long, grown boolean, area double, sides int, ids binary"
_CORNERS = np.array([(i, j, k) for k in (0, 1) for j in (0, 1) for i in (0, 1)])
_EDGES = np.array([(a, b) for a in range(8) for b in range(a + 1, 8) if np.abs(_CORNERS[a] - _CORNERS[b]).sum() == 1])
_AROUND = np.array([(i, j, k) for k in (-1, 0, 1) for j in (-1, 0, 1) for i in (-1, 0, 1) if (i, j, k) != (0, 0, 0)])
_TYPES = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in PARTS.split(", "))])


def cut_areas(low: np.ndarray, size: np.ndarray, point: np.ndarray, normal: np.ndarray) -> np.ndarray:
    """The area of the polygon that a plane cuts out of each box low .. low + size; a side in the plane counts for the box below it."""
    normal = normal / np.linalg.norm(normal)
    corners = low[:, None, :] + _CORNERS * size
    above = (corners - point) @ normal
    up = above >= 0
    a, b = _EDGES.T
    crossed = up[:, a] != up[:, b]
    t = above[:, a] / np.where(crossed, above[:, a] - above[:, b], 1.0)
    spots = corners[:, a] + t[..., None] * (corners[:, b] - corners[:, a])
    n = crossed.sum(axis=1)
    middle = np.where(crossed[..., None], spots, 0).sum(axis=1) / np.maximum(n, 1)[:, None]
    first = np.cross(normal, np.eye(3)[np.abs(normal).argmin()])
    first /= np.linalg.norm(first)
    u, v = (spots - middle[:, None, :]) @ first, (spots - middle[:, None, :]) @ np.cross(normal, first)
    turn = np.where(crossed, np.arctan2(v, u), np.inf)  # corners that aren't there come last, and are the first one again
    order = np.argsort(turn, axis=1)
    u, v, there = (np.take_along_axis(w, order, axis=1) for w in (u, v, crossed))
    u, v = np.where(there, u, u[:, :1]), np.where(there, v, v[:, :1])
    area = 0.5 * (u * np.roll(v, -1, axis=1) - v * np.roll(u, -1, axis=1)).sum(axis=1)
    return np.where(n > 2, area, 0.0)


def packed_cells(vol: DataFrame, size: Size) -> DataFrame:
    """The voxels of each label in each cell as one row: sorted places within the cell, x fastest."""
    place = sum(F.pmod(F.col(a), F.lit(s)) * int(np.prod(size[:i])) for i, (a, s) in enumerate(zip(AXES, size, strict=True)))
    keyed = vol.select("label", *[F.floor(F.col(a) / s).cast("long").alias(c) for a, s, c in zip(AXES, size, AT, strict=True)], place.cast("long").alias("place"))

    def pack(group: pa.Table) -> pa.Table:
        ids = np.unique(group["place"].to_numpy()).astype("<u4")
        return group.select(["label", *AT]).slice(0, 1).append_column("voxels", pa.array([ids.tobytes()], pa.binary()))

    return keyed.groupBy("label", *AT).applyInArrow(pack, "label long, cx long, cy long, cz long, voxels binary")


def grow(size: Size, resolution: tuple, bounds: Box | None):
    """For mapInArrow over sections in cells (…, voxels, seeds, seen): their parts, and what these touch in other cells."""
    width, res = np.array(size), np.array(resolution, float)
    step = np.array([1, size[0], size[0] * size[1]])

    def one(r: dict) -> Iterator[tuple]:
        head = [r[k] for k in ("label", "step", *AXES, *NORMAL)]
        node, normal, at = np.array(head[2:5]), np.array(head[5:8], float), np.array([r[c] for c in AT])
        ids = np.frombuffer(r["voxels"], "<u4").astype(np.int64)
        spots = np.stack([ids % size[0], ids // size[0] % size[1], ids // (size[0] * size[1])], axis=1)
        centre = (node + 0.5) * res
        apart = np.abs(((spots + at * width + 0.5) * res - centre) @ normal)
        near = np.flatnonzero(apart <= 0.5 * (np.abs(normal) * res).sum() + 1e-9)
        ids, spots = ids[near], spots[near]
        if not len(ids):
            return
        area = cut_areas((spots + at * width) * res, res, centre, normal)
        real = area > 1e-9 * res.min() ** 2
        ids, spots, area = ids[real], spots[real], area[real]
        root = pieces_of(spots, size, 26) if len(ids) else np.zeros(0, np.int64)
        seeds = np.frombuffer(b"".join(r["seeds"]), "<u4")
        seen = np.frombuffer(b"".join(r["seen"] or []), "<u4")
        new = np.isin(root, root[np.isin(ids, seeds)]) & ~np.isin(ids, seen)
        if not new.any():
            return
        ids, spots, area = ids[new], spots[new], area[new]
        sides = 0
        for i in range(3):
            if bounds is not None:
                where = spots[:, i] + at[i] * width[i]
                sides |= (1 << 2 * i) * bool((where == bounds[0][i]).any()) | (2 << 2 * i) * bool((where == bounds[1][i] - 1).any())
        yield (*head, *at, True, float(area.sum()), sides, ids.astype("<u4").tobytes())
        edge = spots[((spots == 0) | (spots == width - 1)).any(axis=1)]
        beside = (edge[:, None, :] + _AROUND).reshape(-1, 3)
        beside = beside[((beside < 0) | (beside >= width)).any(axis=1)]
        cells, inverse = np.unique(beside // width, axis=0, return_inverse=True)
        local = (beside % width) @ step
        for k, c in enumerate(cells):
            yield (*head, *(at + c), False, 0.0, 0, np.unique(local[inverse.ravel() == k]).astype("<u4").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row for r in batch.to_pylist() for row in one(r)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def section_areas(nodes: DataFrame, vol: DataFrame, resolution: tuple = (1, 1, 1), size: Size = CELL, bounds: Box | None = None) -> DataFrame:
    """label, step, area and contact of each node with a normal: label, step, x, y, z, nx, ny, nz.

    The plane goes through the middle of the node's voxel. Each voxel of the label that it cuts adds the area of its polygon,
    in units of the resolution (the normal is in these units too), if it is joined with the node's voxel by cut voxels that
    share a side, an edge or a corner. So further parts of the label in the plane, beyond a gap, don't count. contact has a bit for each
    side of the bounds that the section touches: -x, +x, -y, +y, -z, +z. A node off its label, without a normal or with one
    of length 0 has the area 0.

    A section starts in its node's cell. Where a part of it reaches the cell's side, it goes on in the cells beside it in the
    next round, until none grows; so each looks at the cells that it runs through alone, and the result is that of the uncut
    volume, whatever the cell. Repeated nodes (label, step) with one place and normal count once.
    """
    known = nodes.select(*[F.col(k).cast("long").alias(k) for k in (*KEY, *AXES)], *[F.col(n).cast("double").alias(n) for n in NORMAL]).distinct()
    flat = sum(F.col(n) * F.col(n) for n in NORMAL)
    real = known.filter((flat > 0) & (flat < float("inf")))
    place = sum(F.pmod(F.col(a), F.lit(s)) * int(np.prod(size[:i])) for i, (a, s) in enumerate(zip(AXES, size, strict=True)))
    cells = materialise(packed_cells(vol.join(real.select("label").distinct(), "label", "left_semi"), size), "section-cells")
    seed = F.unhex(_little(place.cast("long")))
    todo = materialise(real.select(*KEY, *AXES, *NORMAL, *[F.floor(F.col(a) / s).cast("long").alias(c) for a, s, c in zip(AXES, size, AT, strict=True)], F.array(seed).alias("seeds")), "section-todo")
    done = []
    where = [*KEY, *AXES, *NORMAL, *AT]
    while not todo.isEmpty():
        before = None
        for d in done:
            own = d.filter("grown").select(*KEY, *AT, "ids")
            before = own if before is None else before.unionByName(own)
        item = todo if before is None else todo.join(before.groupBy(*KEY, *AT).agg(F.collect_list("ids").alias("seen")), [*KEY, *AT], "left")
        item = item if before is not None else item.withColumn("seen", F.lit(None).cast("array<binary>"))
        met = item.join(cells, ["label", *AT]).select(*where, "voxels", "seeds", "seen")
        done.append(materialise(met.mapInArrow(grow(size, resolution, bounds), PARTS), "section-parts"))
        drop(todo)
        todo = materialise(done[-1].filter("not grown").groupBy(*where).agg(F.collect_list("ids").alias("seeds")), "section-todo")
    drop(cells, todo)
    parts = done[0] if done else None
    for d in done[1:]:
        parts = parts.unionByName(d)
    every = known.select(*KEY).distinct()
    if parts is None:
        return every.select(*KEY, F.lit(0.0).alias("area"), F.lit(0).alias("contact"))
    total = parts.filter("grown").groupBy(*KEY).agg(F.sum("area").alias("area"), F.bit_or("sides").alias("contact"))
    return every.join(total, KEY, "left").select(*KEY, F.coalesce("area", F.lit(0.0)).alias("area"), F.coalesce("contact", F.lit(0)).alias("contact"))


def _little(place):
    """Eight hexadecimal digits of a number of 32 bits, its lowest byte first."""
    digits = F.lpad(F.hex(place), 8, "0")
    return F.concat(*[F.substring(digits, 7 - 2 * i, 2) for i in range(4)])

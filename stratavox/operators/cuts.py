"""Triangles cut at the planes of a grid, so that every fragment of a surface ends at its chunk's sides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.operators.mesh import decimated
from stratavox.operators.select import AXES

Size = tuple[int, int, int]
POINT = "struct<x:double,y:double,z:double>"
CUT = f"label long, lod int, cx long, cy long, cz long, a {POINT}, b {POINT}, c {POINT}"
#: What a surface is cut by: its level, the side of that level's cells and where their grid begins.
GRID = "label long, lod int, side double, ox double, oy double, oz double"


def split(points: np.ndarray, origin: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangles (n, 3, 3) cut so that none crosses a plane origin + k * side, and which triangle each comes from.

    A cut point is found from its edge's ends in a fixed order and put on the plane, so triangles that share an edge share it.
    """
    of = np.arange(len(points))
    for axis in range(3):
        done = []
        while len(points):
            w = (points[:, :, axis] - origin[of, axis][:, None]) / side[of][:, None]
            low, high = w.min(axis=1), w.max(axis=1)
            plane = np.floor(low) + 1
            crossed = plane < high
            done.append((points[~crossed], of[~crossed]))
            points, of, w, plane = points[crossed], of[crossed], w[crossed], plane[crossed]
            if not len(points):
                break
            level = origin[of, axis] + plane * side[of]
            sign = np.sign(w - plane[:, None])
            # Turn each triangle so that its first corner is alone on its side, or on the plane with the others on either side.
            alone = np.where((sign == 0).any(axis=1), (sign == 0).argmax(axis=1), (sign == -np.sign(sign.sum(axis=1))[:, None]).argmax(axis=1))
            turn = (alone[:, None] + np.arange(3)) % 3
            points = np.take_along_axis(points, turn[:, :, None], axis=1)
            touching = np.take_along_axis(sign, turn, axis=1)[:, 0] == 0
            a, b, c = points[:, 0], points[:, 1], points[:, 2]
            bc = _between(b[touching], c[touching], level[touching], axis)
            ab, ac = (_between(a[~touching], x[~touching], level[~touching], axis) for x in (b, c))
            flat = [(a[touching], b[touching], bc), (a[touching], bc, c[touching])]
            sharp = [(a[~touching], ab, ac), (ab, b[~touching], c[~touching]), (ab, c[~touching], ac)]
            points = np.concatenate([np.stack(t, axis=1) for t in flat + sharp])
            of = np.concatenate([of[touching]] * 2 + [of[~touching]] * 3)
        points, of = np.concatenate([p for p, _ in done] or [points]), np.concatenate([o for _, o in done] or [of])
    return points, of


def _between(p: np.ndarray, q: np.ndarray, level: np.ndarray, axis: int) -> np.ndarray:
    """Where the edges p, q meet the planes."""
    swap = p[:, axis] > q[:, axis]
    low, high = np.where(swap[:, None], q, p), np.where(swap[:, None], p, q)
    t = (level - low[:, axis]) / (high[:, axis] - low[:, axis])
    out = low + t[:, None] * (high - low)
    out[:, axis] = level
    return out


def _points(column: pa.Array) -> np.ndarray:
    return np.stack([column.field(a).to_numpy(zero_copy_only=False).astype(float) for a in AXES], axis=1)


def _structs(points: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(points[:, i])) for i in range(3)], list(AXES))


def cut(tris: DataFrame) -> DataFrame:
    """CUT rows: triangles (GRID columns and corners a, b, c) cut at their grid's planes, with the cell that each piece lies in.

    Every corner is inside its cell or on its sides, areas add up to those of the whole, and neighbouring cells have the same
    points on the plane between them. Triangles within a plane belong to the cell above it. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([_points(batch.column(k)) for k in ("a", "b", "c")], axis=1)
            side, origin = batch.column("side").to_numpy(), np.stack([batch.column(f"o{a}").to_numpy() for a in AXES], axis=1)
            pieces, of = split(points, origin, side)
            place = np.floor((pieces.mean(axis=1) - origin[of]) / side[of][:, None])
            flat = (pieces == pieces[:, :1]).all(axis=1)  # in a plane across an axis: its own coordinate, not a rounded mean
            place = np.where(flat, np.floor((pieces[:, 0] - origin[of]) / side[of][:, None]), place).astype(np.int64)
            rows = pa.array(of)
            yield pa.RecordBatch.from_arrays([batch.column("label").take(rows), batch.column("lod").take(rows), *[pa.array(place[:, i]) for i in range(3)], *[_structs(pieces[:, i]) for i in range(3)]], names=["label", "lod", "cx", "cy", "cz", "a", "b", "c"])

    return tris.select("label", "lod", "side", "ox", "oy", "oz", "a", "b", "c").mapInArrow(run, CUT)


def on_grid(tris: DataFrame, side: float, lod: int = 0, origin: tuple[float, float, float] = (0, 0, 0)) -> DataFrame:
    """Triangles with one grid for all labels."""
    grid = {"side": side, **{f"o{a}": o for a, o in zip(AXES, origin, strict=True)}}
    return tris.select("label", F.lit(lod).cast("int").alias("lod"), *[F.lit(float(v)).alias(k) for k, v in grid.items()], "a", "b", "c")


def levels(tris: DataFrame, side: int, lods: int) -> DataFrame:
    """CUT rows of every level of detail of each label, from its full surface to the one whose single cell holds it, `lods` levels at most.

    Cells double in size from level to level, and so does the grid that corners are drawn to. A label's grid begins at its own least
    corner, so that its last level is one fragment where lods allow it. The boxes are a row a label, from partial aggregates.
    """
    corners = tris.select("label", F.explode(F.array("a", "b", "c")).alias("p"))
    ends = corners.groupBy("label").agg(*[F.min(f"p.{a}").cast("double").alias(f"o{a}") for a in AXES], *[F.max(f"p.{a}").cast("double").alias(f"e{a}") for a in AXES])
    begin = lambda a, lod: F.floor(F.col(f"o{a}") / (1 << lod)) * float(1 << lod)  # noqa: E731  a coarser level's corners are drawn down to its grid
    top = F.lit(lods - 1)
    for lod in range(lods - 2, -1, -1):
        top = F.when(F.greatest(*[F.col(f"e{a}") - begin(a, lod) for a in AXES]) <= side << lod, F.lit(lod)).otherwise(top)
    boxes = ends.select("label", "ox", "oy", "oz", top.alias("top"))
    out = None
    for lod in range(lods):
        own = tris if lod == 0 else decimated(tris, 1 << lod)
        level = own.join(boxes.filter(F.col("top") >= lod), "label").withColumns({"lod": F.lit(lod), "side": F.lit(float(side << lod))})
        level = level.withColumns({f"o{a}": begin(a, lod) for a in AXES})
        found = cut(level)
        out = found if out is None else out.unionByName(found)
    return out

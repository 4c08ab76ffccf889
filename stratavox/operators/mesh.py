"""Surfaces of labels: exposed voxel faces, their triangles and vertices, levels of detail and octree fragments."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.functions.codes import morton
from stratavox.operators.select import AXES

Size = tuple[int, int, int]
# The six directions, and for each the corners of its face of a unit voxel, counterclockwise from outside.
FACES = {
    (1, 0, 0): ((1, 0, 0), (1, 1, 0), (1, 1, 1), (1, 0, 1)),
    (-1, 0, 0): ((0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 0)),
    (0, 1, 0): ((0, 1, 0), (0, 1, 1), (1, 1, 1), (1, 1, 0)),
    (0, -1, 0): ((0, 0, 0), (1, 0, 0), (1, 0, 1), (0, 0, 1)),
    (0, 0, 1): ((0, 0, 1), (1, 0, 1), (1, 1, 1), (0, 1, 1)),
    (0, 0, -1): ((0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 0)),
}


def exposed_faces(vol: DataFrame) -> DataFrame:
    """label, x, y, z and direction (dx, dy, dz) of each voxel face without the same label behind it.

    A face and its opposite land on one key, so they are found by one grouping, without a join: a face whose plane has
    the label on both sides occurs twice.
    """
    sides = F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, f, strict=True)]) for f in FACES])
    each = vol.select("label", *AXES, F.explode(sides).alias("s"))
    doubled = {f"_{a}": 2 * F.col(a) + F.col(f"s.d{a}") for a in AXES}
    alone = each.withColumns(doubled).groupBy("label", "_x", "_y", "_z").agg(F.count("*").alias("n"), *[F.first(a).alias(a) for a in AXES], F.first("s").alias("s"))
    return alone.filter("n = 1").select("label", *AXES, *[F.col(f"s.d{a}").alias(f"d{a}") for a in AXES])


def surface(vol: DataFrame, resolution: Size = (1, 1, 1)) -> DataFrame:
    """Exposed faces of each label and their area."""
    rx, ry, rz = resolution
    area = F.abs("dx") * ry * rz + F.abs("dy") * rx * rz + F.abs("dz") * rx * ry
    return exposed_faces(vol).groupBy("label").agg(F.count("*").alias("faces"), F.sum(area).cast("bigint").alias("area"))


def triangles(vol: DataFrame, resolution: Size = (1, 1, 1)) -> DataFrame:
    """A closed surface of each label: two triangles for each exposed face, with corners in physical units."""
    return triangles_of(exposed_faces(vol), resolution)


def triangles_of(faces: DataFrame, resolution: Size = (1, 1, 1)) -> DataFrame:
    """The two triangles of each exposed face."""
    quads = None
    for d, corners in FACES.items():
        here = F.lit(True)
        for a, v in zip(AXES, d, strict=True):
            here &= F.col(f"d{a}") == v
        points = F.array(*[F.struct(*[((F.col(a) + c) * r).cast("bigint").alias(a) for a, c, r in zip(AXES, p, resolution, strict=True)]) for p in corners])
        quads = F.when(here, points) if quads is None else quads.when(here, points)
    faces = faces.select("label", quads.alias("q"))
    pick = lambda *i: F.struct(*[F.col("q")[k].alias(n) for k, n in zip(i, "abc", strict=True)])
    return faces.select("label", F.explode(F.array(pick(0, 1, 2), pick(0, 2, 3))).alias("t")).select("label", "t.*")


def vertices(tris: DataFrame) -> DataFrame:
    """The distinct corners of each label's triangles."""
    return tris.select("label", F.explode(F.array("a", "b", "c")).alias("v")).distinct().select("label", "v.*")


def meshes(tris: DataFrame) -> DataFrame:
    """Counts of vertices, edges and triangles of each label, its Euler number and the box of its vertices."""
    item = lambda kind, p, q: F.struct(F.lit(kind).alias("kind"), F.least(p, q).alias("p"), F.greatest(p, q).alias("q"))
    items = F.array(*[item(0, p, p) for p in "abc"], *[item(1, p, q) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))])
    each = tris.select("label", F.explode(items).alias("i")).groupBy("label", "i").agg(F.count("*").alias("n"))
    corner, edge = F.col("i.kind") == 0, F.col("i.kind") == 1
    ends = [f(F.when(corner, F.col(f"i.p.{a}"))).alias(f"{a}{k}") for a in AXES for k, f in ((0, F.min), (1, F.max))]
    counts = each.groupBy("label").agg(F.count_if(corner).alias("vertices"), *ends, F.count_if(edge).alias("edges"), (F.sum(F.when(edge, F.col("n"))) / 3).cast("bigint").alias("triangles"))
    return counts.withColumn("euler", F.col("vertices") - F.col("edges") + F.col("triangles"))


def max_lod(shape: Size, least_chunk: Size, lods: int) -> int:
    """The coarsest useful level of detail of a mesh: each level halves how many chunks it spans."""
    return min(int(max(min(math.log2(s / c) for s, c in zip(shape, least_chunk, strict=True)), 0)), lods)


def target_triangles(count: int, lod: int, chunks: int, most: int = 2_000_000) -> int:
    """How many triangles a level keeps: half of the last, four at least, and not more than its chunks may hold."""
    return max(4, min(count >> lod, chunks * most))


def decimated(tris: DataFrame, cell: int) -> DataFrame:
    """Triangles after corners within a cell of a grid have become one, and those that thereby collapsed are gone."""
    at = lambda p: F.struct(*[(F.floor(F.col(f"{p}.{a}") / cell) * cell).cast("bigint").alias(a) for a in AXES])
    moved = tris.select("label", *[at(p).alias(p) for p in "abc"])
    return moved.filter((F.col("a") != F.col("b")) & (F.col("b") != F.col("c")) & (F.col("a") != F.col("c"))).distinct()


def octree_fragments(tris: DataFrame, chunk: int, lod: int) -> DataFrame:
    """Triangles by fragment: the cell of their first corner at this level, and its place on the Z-order curve."""
    size = chunk << lod
    keyed = tris.withColumns({f"c{a}": F.floor(F.col(f"a.{a}") / size).cast("bigint") for a in AXES})
    return keyed.groupBy("label", "cx", "cy", "cz").agg(F.count("*").alias("triangles")).withColumns({"lod": F.lit(lod), "code": morton("cx", "cy", "cz")})


def fragments(tris: DataFrame, chunk: int, lod: int = 0) -> DataFrame:
    """The triangles themselves by fragment: label, lod, cx, cy, cz, code and an array of triangles; a fragment lies in one chunk."""
    size = chunk << lod
    keyed = tris.select("label", F.struct("a", "b", "c").alias("t"), *[F.floor(F.col(f"a.{a}") / size).cast("bigint").alias(f"c{a}") for a in AXES])
    return keyed.groupBy("label", "cx", "cy", "cz").agg(F.sort_array(F.collect_list("t")).alias("triangles")).withColumns({"lod": F.lit(lod), "code": morton("cx", "cy", "cz")})


def gathered(pieces: DataFrame) -> DataFrame:
    """Fragments of one label's level as a multi-resolution file has them: in Z order, each with its count and first triangle."""
    order = Window.partitionBy("label", "lod").orderBy("code")
    count = F.size("triangles").cast("bigint")
    upto = F.sum(count).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return pieces.select("label", "lod", "cx", "cy", "cz", "code", count.alias("n_triangles"), F.coalesce(upto, F.lit(0)).alias("first"), F.row_number().over(order).cast("bigint").alias("place"))


def levels(tris: DataFrame, chunk: int, shape: Size) -> DataFrame:
    """Fragments of every level of detail, from the full surface to the one whose chunk spans the shape.

    Each level doubles the chunk and the cell that corners are drawn to; all levels share one surface.
    """
    top = max(0, math.ceil(math.log2(max(shape) / chunk)))
    out = octree_fragments(tris, chunk, 0)
    for lod in range(1, top + 1):
        out = out.unionByName(octree_fragments(decimated(tris, 1 << lod), chunk, lod))
    return out


def quantisation(low: float, shape: float, chunks: float, bits: int) -> dict[str, float]:
    """Range, bins and origin that put vertices of a chunk's mesh on a grid of 2^bits - 1 steps; bits is 10 or 16."""
    if bits not in (10, 16):
        raise ValueError("vertices take 10 or 16 bits")
    steps = (1 << bits) - 1
    return {"bits": bits, "range": shape, "bin": shape / steps, "origin": math.floor(low / shape * chunks) * shape / chunks}

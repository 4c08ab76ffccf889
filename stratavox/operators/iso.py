"""Iso-surfaces of labels between voxel centres, and simplification by quadrics of clustered corners."""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.operators.select import AXES
from stratavox.sources.shared import drop, materialise

Size = tuple[int, int, int]
#: Corners of a cube by number, x fastest.
CORNERS = [(i & 1, i >> 1 & 1, i >> 2 & 1) for i in range(8)]
#: Tetrahedra of a cube: the walks from its first to its last corner along each axis once; neighbouring cubes agree on their faces.
TETRAHEDRA = [(0, 1 << p[0], (1 << p[0]) + (1 << p[1]), 7) for p in permutations(range(3))]
NODE = "struct<x:bigint,y:bigint,z:bigint>"


def crossings(mask: int) -> list[tuple[tuple[int, int, int], ...]]:
    """Triangles of a cube whose corners in the mask are inside, corners in half voxels, counterclockwise from outside."""
    at, out = np.array(CORNERS), []
    for tetrahedron in TETRAHEDRA:
        inside = [c for c in tetrahedron if mask >> c & 1]
        outside = [c for c in tetrahedron if not mask >> c & 1]
        if not inside or not outside:
            continue
        middle = lambda i, o: at[i] + at[o]
        if len(inside) == 2:
            (i, j), (o, p) = inside, outside
            found = [(middle(i, o), middle(i, p), middle(j, p)), (middle(i, o), middle(j, p), middle(j, o))]
        else:
            found = [tuple(middle(i, o) for i in inside for o in outside)]
        away = at[outside].mean(axis=0) - at[inside].mean(axis=0)
        for a, b, c in found:
            if np.cross(b - a, c - a) @ away < 0:
                b, c = c, b
            out.append(tuple(tuple(int(v) for v in p) for p in (a, b, c)))
    return out


def iso_triangles(vol: DataFrame, resolution: Size = (1, 1, 1)) -> DataFrame:
    """A closed surface of each label halfway between its voxels' centres and the others': label and corners a, b, c.

    Cubes between eight centres are cut into tetrahedra, whose cases come from a rule. Corners are in half voxels times
    the resolution, from the centre of voxel 0. A cube is one key of one grouping; the table of cases has 254 masks
    whatever the volume, so it is broadcast. Repeated voxels count once.
    """
    corner = F.array(*[F.struct(F.lit(1 << i).alias("bit"), *[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, c, strict=True)]) for i, c in enumerate(CORNERS)])
    each = vol.select("label", *AXES, F.explode(corner).alias("s")).select("label", "s.bit", *[(F.col(a) - F.col(f"s.d{a}")).alias(a) for a in AXES])
    cubes = each.groupBy("label", *AXES).agg(F.bit_or("bit").alias("mask")).filter("mask < 255")
    cases = vol.sparkSession.createDataFrame([(m, *t) for m in range(1, 255) for t in crossings(m)], f"mask int, p {NODE}, q {NODE}, r {NODE}")
    met = cubes.join(F.broadcast(cases), "mask")
    place = lambda p: F.struct(*[((2 * F.col(a) + F.col(f"{p}.{a}")) * r).cast("bigint").alias(a) for a, r in zip(AXES, resolution, strict=True)])
    return met.select("label", *[place(p).alias(n) for p, n in zip("pqr", "abc", strict=True)])


def _clustered(tris: DataFrame, cell: Column) -> DataFrame:
    """tris with the cells of their corners as ka, kb, kc and their edge as cell."""
    at = lambda p: F.struct(*[F.floor(F.col(f"{p}.{a}") / F.col("cell")).cast("bigint").alias(a) for a in AXES])
    return tris.withColumn("cell", cell.cast("bigint")).withColumns({f"k{p}": at(p) for p in "abc"})


def _left(clustered: DataFrame) -> DataFrame:
    """label, cell and the cells k[0..2] of triangles that keep three corners, equal ones once; turning keeps the winding."""
    open_ = clustered.filter("ka != kb and kb != kc and ka != kc")
    first = F.least("ka", "kb", "kc")
    turns = F.when(first == F.col("ka"), F.array("ka", "kb", "kc")).when(first == F.col("kb"), F.array("kb", "kc", "ka")).otherwise(F.array("kc", "ka", "kb"))
    return open_.select("label", "cell", turns.alias("k")).distinct()


def simplified(tris: DataFrame, cell: int | Column) -> DataFrame:
    """Triangles (corners of doubles) after all corners of a label within a cell of a grid have become one point.

    The point is where the planes of the triangles that touch the cell meet best (the least sum of squared distances,
    each weighed by its triangle's squared area, with a slight pull to the mean corner), held within the cell. Sums of
    quadrics combine before the shuffle, so a cell with many triangles is no hot key. `cell` may be a column, so that
    each label has its own. Collapsed triangles go, equal ones are one; an empty table stays empty.
    """
    near = _clustered(tris, cell if isinstance(cell, Column) else F.lit(cell))
    u, v = ([F.col(f"{p}.{a}") - F.col(f"a.{a}") for a in AXES] for p in "bc")
    normal = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    touched = F.array(*[F.struct(F.col(f"k{p}").alias("k"), F.col(p).alias("p")) for p in "abc"])
    corners = near.withColumns({f"n{a}": n.cast("double") for a, n in zip(AXES, normal, strict=True)}).select("label", "cell", *[f"n{a}" for a in AXES], F.explode(touched).alias("t"))
    here = {a: F.col(f"t.p.{a}") - (F.col(f"t.k.{a}") + 0.5) * F.col("cell") for a in AXES}
    corners = corners.withColumns({f"h{a}": e for a, e in here.items()}).withColumn("d", sum(F.col(f"n{a}") * F.col(f"h{a}") for a in AXES))
    pairs = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]
    sums = [F.sum(F.col(f"n{a}") * F.col(f"n{b}")).alias(f"m{a}{b}") for a, b in pairs] + [F.sum(F.col("d") * F.col(f"n{a}")).alias(f"r{a}") for a in AXES] + [F.avg(f"h{a}").alias(f"h{a}") for a in AXES]
    quadrics = corners.groupBy("label", "cell", F.col("t.k").alias("key")).agg(*sums)
    pull = 1e-4 * (F.col("mxx") + F.col("myy") + F.col("mzz")) + 1e-9
    quadrics = quadrics.withColumn("w", pull).withColumns({f"m{a}{a}": F.col(f"m{a}{a}") + F.col("w") for a in AXES} | {f"r{a}": F.col(f"r{a}") + F.col("w") * F.col(f"h{a}") for a in AXES})
    m = lambda a, b: F.col("m" + "".join(sorted(a + b)))
    # Rows of the symmetric matrix; Cramer's rule replaces one column by the right side.
    matrix = [[m(a, b) for b in AXES] for a in AXES]
    right = [F.col(f"r{a}") for a in AXES]
    det = lambda t: t[0][0] * (t[1][1] * t[2][2] - t[1][2] * t[2][1]) - t[0][1] * (t[1][0] * t[2][2] - t[1][2] * t[2][0]) + t[0][2] * (t[1][0] * t[2][1] - t[1][1] * t[2][0])
    solved = [det([[right[i] if j == k else matrix[i][j] for j in range(3)] for i in range(3)]) / F.col("det") for k in range(3)]
    half = F.col("cell") / 2
    held = [((F.col(f"key.{a}") + 0.5) * F.col("cell") + F.greatest(-half, F.least(half, F.coalesce(s, F.col(f"h{a}"))))).alias(a) for a, s in zip(AXES, solved, strict=True)]
    points = quadrics.withColumn("det", F.nullif(det(matrix), F.lit(0.0))).select("label", "cell", "key", F.struct(*held).alias("point"))
    ends = _left(near).select("label", "cell", "k", F.posexplode("k").alias("i", "key")).join(points, ["label", "cell", "key"])
    return ends.groupBy("label", "cell", "k").agg(*[F.max(F.when(F.col("i") == i, F.col("point"))).alias(n) for i, n in enumerate("abc")]).select("label", "a", "b", "c")


def cells_for(tris: DataFrame, factor: int = 100, error: int | None = None, least: int = 4) -> DataFrame:
    """For each label the smallest power of two as cell that leaves 1/factor of its triangles, `least` at least, and how many it leaves.

    A cell never exceeds `error` where given: no corner moves by more than a cell along an axis. Each round doubles the
    cell, reads only what the last round left, and goes on with the labels that still have too many, so rounds are
    logarithmic in the extent and get smaller.
    """
    whole = tris.groupBy("label").agg(F.count("*").alias("triangles")).withColumn("most", F.greatest(F.lit(least), F.floor(F.col("triangles") / factor)))
    found, left, done, cell = materialise(whole, "cells-counts"), tris, None, 1
    while True:
        last = error is not None and 2 * cell > error
        ready = (found if last else found.filter("triangles <= most")).withColumn("cell", F.lit(cell).cast("bigint")).select("label", "cell", "triangles")
        done = ready if done is None else done.unionByName(ready)
        todo = found.filter("triangles > most").select("label", "most")
        if last or todo.isEmpty():
            return done
        halved = _left(_clustered(left.join(todo.select("label"), "label", "left_semi"), F.lit(2)))
        after = materialise(halved.select("label", *[F.col("k")[i].alias(n) for i, n in enumerate("abc")]), "cells-left")
        if cell > 1:
            drop(left)
        left, cell = after, 2 * cell
        counts = left.groupBy("label").agg(F.count("*").alias("k"))
        found = materialise(todo.join(counts, "label", "left").select("label", F.coalesce("k", F.lit(0)).alias("triangles"), "most"), "cells-counts")


def simplified_by(tris: DataFrame, factor: int = 100, error: int | None = None) -> DataFrame:
    """Triangles of each label simplified to 1/factor of their number, or as far as the error allows; see cells_for()."""
    tris = materialise(tris, "cells-whole")
    cells = cells_for(tris, factor, error)
    return simplified(tris.join(cells.select("label", F.col("cell").alias("edge")), "label"), F.col("edge"))

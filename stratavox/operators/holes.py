"""Filling holes of labels in dense chunks: pieces of background, what they touch, and which label takes them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.operators.ccl import components, contract
from stratavox.operators.chunks import AT, OF, _batch, chunk_dilate, local_parts
from stratavox.operators.select import AXES
from stratavox.sources.shared import drop, materialise

Size = tuple[int, int, int]
SIDES = "axis int, px long, py long, pz long, far boolean, labels binary, parts binary"
#: Two touching pieces (label 0), or a piece's faces with a label.
TOUCHES = "part long, other long, label long, faces long"
OPEN = "side int, u long, v long, part long"
FILLED = "cx long, cy long, cz long, dtype string, data binary, holes binary"
#: Levels up to this fill what one label surrounds wholly; each further level asks for a hundredth less of the faces.
STRICT = 3


def least_share(level: int) -> int:
    """Hundredths of a piece's faces that one label must have to take it."""
    return 100 - max(0, level - STRICT)


def _grid(shape: Size, chunk: Size) -> list[int]:
    return [-(-s // c) for s, c in zip(shape, chunk, strict=True)]


def every_chunk(chunks: DataFrame, chunk: Size, shape: Size) -> DataFrame:
    """All chunks of the volume, those that are absent as rows without data."""
    nx, ny, nz = _grid(shape, chunk)
    i = F.col("id")
    grid = chunks.sparkSession.range(nx * ny * nz).select((i % nx).alias("cx"), (F.floor(i / nx) % ny).cast("long").alias("cy"), F.floor(i / (nx * ny)).cast("long").alias("cz"))
    return grid.join(chunks.select(*AT, "dtype", "data"), AT, "left").select(*AT, F.coalesce("dtype", F.lit("<i8")).alias("dtype"), "data")


def _background(at: tuple, dense: np.ndarray, chunk: Size, shape: Size) -> tuple[np.ndarray, np.ndarray]:
    """The number, from 1, of the piece of background that each voxel of a chunk is in, and the pieces' least linear ids."""
    empty = dense == 0
    for axis in range(3):
        empty[tuple(np.s_[max(0, shape[axis] - at[axis] * chunk[axis]) :] if k == OF[axis] else np.s_[:] for k in range(3))] = False
    parts, first = local_parts(empty.astype(np.int8))
    z, y, x = (w + at[a] * chunk[a] for w, a in zip(np.unravel_index(first, dense.shape), (2, 1, 0), strict=True))
    return parts, (x + shape[0] * (y + shape[1] * z)).astype(np.int64)


def _pairs(part: np.ndarray, other: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """TOUCHES columns: how often each triple occurs."""
    if not len(part):
        return [part, other, label, part]
    rows, n = np.unique(np.stack([part, other, label]), axis=1, return_counts=True)
    return [*rows, n]


def _between(parts: tuple, labels: tuple) -> list[np.ndarray]:
    """TOUCHES columns of faces: two arrays of pieces (-1 for none) and of labels on either side."""
    low, high = (np.concatenate([p.ravel(), q.ravel()]) for p, q in (parts, parts[::-1]))
    label = np.concatenate([labels[1].ravel(), labels[0].ravel()])
    half = len(low) // 2
    link = (low >= 0) & (high >= 0) & (low != high) & (np.arange(len(low)) < half)
    touch = (low >= 0) & (label != 0)
    part = np.concatenate([low[link], low[touch]])
    other = np.concatenate([high[link], np.full(touch.sum(), -1)])
    return _pairs(part, other, np.concatenate([np.zeros(link.sum(), np.int64), label[touch]]))


def _dense(work, chunk: Size):
    """work with rows without data as background."""
    return lambda r: work(tuple(r[c] for c in AT), np.frombuffer(r["data"], r["dtype"]).reshape(chunk[::-1]) if r["data"] else np.zeros(chunk[::-1], np.int64))


def _each(chunks: DataFrame, chunk: Size, ddl: str, work) -> DataFrame:
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                for columns in _dense(work, chunk)(r):
                    yield _batch(ddl, columns)

    return chunks.select(*AT, "dtype", "data").mapInArrow(run, ddl)


def touches(chunks: DataFrame, chunk: Size, shape: Size) -> DataFrame:
    """TOUCHES rows of every chunk and of the planes between chunks; only chunks' sides are shuffled, one or two a group."""

    def named(at, dense):
        parts, names = _background(at, dense, chunk, shape)
        return np.append(-1, names)[parts], dense.astype(np.int64)

    def inside(at, dense):
        parts, labels = named(at, dense)
        for axis, k in enumerate(OF):
            cut = lambda w, r, k=k: np.take(w, range(*r), axis=k)
            low, high = (0, chunk[axis] - 1), (1, chunk[axis])
            yield _between((cut(parts, low), cut(parts, high)), (cut(labels, low), cut(labels, high)))

    def sides(at, dense):
        parts, labels = named(at, dense)
        for axis, k in enumerate(OF):
            for far in (False, True):
                place = chunk[axis] - 1 if far else 0
                yield [[axis], *[[p + (far and a == axis)] for a, p in enumerate(at)], [far], *[[np.ascontiguousarray(np.take(w, place, axis=k)).tobytes()] for w in (labels, parts)]]

    def met(group: pa.Table) -> pa.Table:
        rows = {r["far"]: [np.frombuffer(r[c], np.int64) for c in ("labels", "parts")] for r in group.to_pylist()}
        if len(rows) < 2:
            return pa.Table.from_batches([_batch(TOUCHES, [[]] * 4)])
        (la, pa_), (lb, pb) = rows[True], rows[False]
        return pa.Table.from_batches([_batch(TOUCHES, _between((pa_, pb), (la, lb)))])

    own = _each(chunks, chunk, TOUCHES, inside)
    planes = _each(chunks, chunk, SIDES, sides).groupBy("axis", "px", "py", "pz")
    return own.unionByName(planes.applyInArrow(met, TOUCHES))


def side_voxels(chunks: DataFrame, chunk: Size, shape: Size) -> DataFrame:
    """OPEN rows: the background voxels on the sides of the data set, and their pieces; u and v run along the side."""

    def work(at, dense):
        parts, names = _background(at, dense, chunk, shape)
        named = np.append(-1, names)[parts]
        for axis, k in enumerate(OF):
            u, v = (a for a in range(3) if a != axis)
            for far in (0, 1):
                place = (shape[axis] - 1 if far else 0) - at[axis] * chunk[axis]
                if 0 <= place < chunk[axis]:
                    side = np.take(named, place, axis=k)  # rows along v, columns along u
                    q, p = np.nonzero(side >= 0)
                    yield [np.full(len(p), 2 * axis + far), p + at[u] * chunk[u], q + at[v] * chunk[v], side[q, p]]

    return _each(chunks, chunk, OPEN, work)


def open_parts(sides: DataFrame, shape: Size, by_rim: bool) -> DataFrame:
    """part of the pieces that are open: those on a side of the data set, or, by rim, those that reach a side's rim within the side."""
    if not by_rim:
        return sides.select("part").distinct()
    flat = sides.select(F.col("u").alias("x"), F.col("v").alias("y"), (2 * F.col("side")).cast("long").alias("z"), "part")  # sides lie apart
    wide = max(shape)
    found = components(flat.select(*AXES), (wide, wide, 12), size=(128, 128, 1)).join(flat, list(AXES))
    ends = F.array(*[F.array(*[F.lit(shape[a]) for a in range(3) if a != axis]) for axis in range(3)])
    last = lambda i: ends[F.floor(F.col("z") / 4).cast("int")][i] - 1
    rim = found.filter((F.col("x") == 0) | (F.col("y") == 0) | (F.col("x") == last(0)) | (F.col("y") == last(1))).select("component").distinct()
    return found.join(rim, "component", "left_semi").select("part").distinct()


def fill_levels(chunks: DataFrame, chunk: Size, shape: Size, level: int) -> DataFrame:
    """Chunks with their holes filled: cx, cy, cz, dtype, data, and holes, the bytes of a chunk that holds the filled voxels alone.

    Level 0 fills nothing. At level 1 a piece of background (joined by faces) that no side of the data set touches is filled
    if all its faces are with one label. From level 2 on a piece on the data set's sides is filled too, unless its background
    reaches the rim of a side within that side. From level 3 on labels first grow by a voxel. Each level beyond asks for a
    hundredth less of the faces to be with the label that has the most of them (of several, the least), up to level 103.

    Pieces are found within chunks; a chunk's sides alone meet those of its neighbours, links are contracted, and the table of
    faces by piece and label is added up from partial counts. Absent chunks are background, a row each. Chunks that stay
    without a label give no row.
    """
    if not 0 <= level <= 103:
        raise ValueError("levels are 0 to 103")
    dense = chunk_dilate(chunks, chunk, shape) if level >= STRICT else chunks
    if level == 0:
        return dense.select(*AT, "dtype", "data", F.lit(None).cast("binary").alias("holes"))
    every = materialise(every_chunk(dense, chunk, shape), "holes-chunks")
    met = materialise(touches(every, chunk, shape).groupBy("part", "other", "label").agg(F.sum("faces").alias("faces")), "holes-touches")
    roots = materialise(contract(met.filter("label = 0").select(F.col("part").alias("a"), F.col("other").alias("b"))), "holes-roots")
    rooted = lambda df: df.join(roots.select(F.col("node").alias("part"), "root"), "part", "left").withColumn("root", F.coalesce("root", "part"))
    faces = rooted(met.filter("label != 0")).groupBy("root", "label").agg(F.sum("faces").alias("faces"))
    best = faces.groupBy("root").agg(F.max(F.struct("faces", (-F.col("label")).alias("label"))).alias("best"), F.sum("faces").alias("all"))
    shut = rooted(open_parts(side_voxels(every, chunk, shape), shape, level >= 2)).select("root").distinct()
    taken = best.filter(100 * F.col("best.faces") >= least_share(level) * F.col("all")).join(shut, "root", "left_anti").select("root", (-F.col("best.label")).alias("label"))
    nodes = met.select("part").unionByName(met.filter("label = 0").select(F.col("other").alias("part"))).distinct()
    at = {"cx": F.col("part") % shape[0], "cy": F.floor(F.col("part") / shape[0]) % shape[1], "cz": F.floor(F.col("part") / (shape[0] * shape[1]))}
    own = rooted(nodes).join(taken, "root").select("part", "label", *[F.floor(c / s).cast("long").alias(n) for (n, c), s in zip(at.items(), chunk, strict=True)])

    def fill(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():
            place = tuple(r[c] for c in AT)
            data = np.frombuffer(r["data"], r["dtype"]).reshape(chunk[::-1]) if r["data"] else np.zeros(chunk[::-1], r["dtype"])
            holes = np.zeros_like(data)
            if len(right):
                parts, names = _background(place, data, chunk, shape)
                labels = np.zeros(len(names) + 1, data.dtype)
                order = np.argsort(names)
                labels[1 + order[np.searchsorted(names[order], right["part"].to_numpy())]] = right["label"].to_numpy()
                holes = labels[parts]
            whole = data + holes
            if whole.any():
                out.append((*place, r["dtype"], whole.tobytes(), holes.tobytes()))
        return pa.Table.from_batches([_batch(FILLED, list(map(list, zip(*out, strict=True))) or [[]] * 6)])

    filled = materialise(every.groupBy(*AT).cogroup(own.groupBy(*AT)).applyInArrow(fill, FILLED), "holes-filled")
    drop(every, met, roots)
    return filled

"""Hole filling by levels against a plain search over the whole volume."""

import itertools
from collections import Counter

import numpy as np
import pytest

from stratavox.operators import chunks, holes, select
from stratavox.sources.volume import to_chunks, to_voxels

SHAPE = (13, 11, 9)
STEPS = [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)]


def table(spark, dense):
    rows = [(*map(int, p), int(dense[tuple(p)])) for p in np.argwhere(dense)]
    return spark.createDataFrame(rows, "x long, y long, z long, v long")


def spread(cells, steps):
    """The sets of cells joined by steps."""
    left, out = set(cells), []
    while left:
        piece, queue = set(), [left.pop()]
        while queue:
            p = queue.pop()
            piece.add(p)
            near = {tuple(np.add(p, s)) for s in steps} & left
            left -= near
            queue += near
        out.append(piece)
    return out


def brute(dense, level):
    """The array and its holes after filling."""
    if level >= 3:
        wide = np.pad(dense, 1)
        moved = [wide[1 + i : 1 + i + dense.shape[0], 1 + j : 1 + j + dense.shape[1], 1 + k : 1 + k + dense.shape[2]] for i, j, k in itertools.product((-1, 0, 1), repeat=3)]
        least = np.min([np.where(m == 0, 99, m) for m in moved], axis=0)
        dense = np.where((dense == 0) & (least < 99), least, dense)
    shape, found = dense.shape, np.zeros_like(dense)
    empty = set(map(tuple, np.argwhere(dense == 0)))
    closed = set()  # (axis, end, voxel) of pieces of a side that keep off its rim
    for axis, end in itertools.product(range(3), (0, 1)):
        at = (shape[axis] - 1) * end
        flat = [s for s in STEPS if not s[axis]]
        for piece in spread([p for p in empty if p[axis] == at], flat):
            if level >= 2 and all(0 < p[a] < shape[a] - 1 for p in piece for a in range(3) if a != axis):
                closed |= {(axis, end, p) for p in piece}
    for piece in spread(empty, STEPS):
        sides = [(a, e, p) for p in piece for a in range(3) for e in (0, 1) if p[a] == (shape[a] - 1) * e]
        beside = (tuple(np.add(p, s)) for p in piece for s in STEPS)
        faces = Counter(int(dense[q]) for q in beside if all(0 <= x < n for x, n in zip(q, shape, strict=True)) and dense[q])
        if faces and all(s in closed for s in sides):
            n, label = max((n, -label) for label, n in faces.items())
            if n >= (1 - 0.01 * max(0, level - 3)) * faces.total() - 1e-9:
                for p in piece:
                    found[p] = -label
    return dense + found, found


def volume(seed, share, labels):
    rng = np.random.default_rng(seed)
    return rng.integers(1, labels + 1, SHAPE) * (rng.random(SHAPE) < share)


def shell():
    """A box with a cavity, a hole that opens on a side of the data set, and one that opens on an edge of it."""
    dense = np.ones(SHAPE, np.int64)
    dense[3:10, 3:8, 3:6] = 0
    dense[5, 0:2, 4] = 0
    dense[11:, 5, 0] = 0
    dense[6, 5, 4] = 2
    return dense


def check(spark, dense, size, level):
    out = holes.fill_levels(to_chunks(table(spark, dense), size, "int64"), size, SHAPE, level)
    whole, found = brute(dense, level)
    as_set = lambda a: {(*map(int, p), int(a[tuple(p)])) for p in np.argwhere(a)}
    assert set(map(tuple, to_voxels(out, size).collect())) == as_set(whole)
    assert set(map(tuple, to_voxels(out.drop("data").withColumnRenamed("holes", "data"), size).collect())) == as_set(found)


@pytest.mark.parametrize("level", [1, 2, 3, 50])
def test_levels(spark, level):
    check(spark, volume(level, 0.8, 3 if level > 3 else 1), (4, 5, 3), level)


@pytest.mark.parametrize(("level", "size"), [(1, (4, 4, 4)), (2, (16, 16, 16)), (2, (5, 3, 4)), (53, (4, 4, 4))])
def test_cavities(spark, level, size):
    check(spark, shell(), size, level)


def test_shares():
    assert [holes.least_share(level) for level in (1, 3, 4, 53, 103)] == [100, 100, 99, 50, 0]


def test_dilation_of_chunks(spark):
    dense = volume(9, 0.1, 4)
    dense[:8, :8, :] = 0  # chunks that are absent take part
    vol = table(spark, dense)
    size = (4, 4, 4)
    found = to_voxels(chunks.chunk_dilate(to_chunks(vol, size, "int64"), size, SHAPE), size)
    told = select.dilate(vol.withColumnRenamed("v", "label")).filter(" and ".join(f"{a} between 0 and {n - 1}" for a, n in zip("xyz", SHAPE, strict=True)))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, told.select("x", "y", "z", "label").collect()))


def test_nothing(spark):
    size = (4, 4, 4)
    none = to_chunks(table(spark, np.eye(3, dtype=np.int64)[:, :, None]).filter("v > 5"), size, "int64")
    assert holes.fill_levels(none, size, SHAPE, 2).collect() == []
    with pytest.raises(ValueError, match="levels"):
        holes.fill_levels(none, size, SHAPE, 104)

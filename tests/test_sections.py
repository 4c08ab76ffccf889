"""Cross sections against solids whose sections are known, and against a search over the whole volume."""

import itertools
import math

import numpy as np
import pytest

from stratavox.operators import sections

NODES = "label long, step long, x long, y long, z long, nx double, ny double, nz double"
SIZES = [(64, 64, 64), (4, 3, 2)]


def table(spark, points, label=1):
    return spark.createDataFrame([(*map(int, p), label) for p in points], "x long, y long, z long, label long")


def measured(spark, rows, vol, **options):
    return {r.step: r for r in sections.section_areas(spark.createDataFrame(rows, NODES), vol, **options).collect()}


def brute(points, node, normal, resolution):
    """All cut voxels of the volume in one search from the node."""
    res, normal = np.array(resolution, float), np.array(normal, float)
    area = dict(zip(map(tuple, points), sections.cut_areas(np.array(points) * res, res, (np.array(node) + 0.5) * res, normal), strict=True))
    reached, queue = set(), [tuple(node)]
    while queue:
        p = queue.pop()
        if p in reached or area.get(p, 0) < 1e-9:
            continue
        reached.add(p)
        queue += [tuple(np.add(p, d)) for d in itertools.product((-1, 0, 1), repeat=3)]
    return sum(area[p] for p in reached)


def test_polygons_of_a_box():
    low, size, middle = np.zeros((1, 3)), np.array([2.0, 3.0, 5.0]), np.array([1.0, 1.5, 2.5])
    cut = lambda n, p=middle: sections.cut_areas(low, size, np.array(p, float), np.array(n, float))[0]
    assert cut((1, 0, 0)) == pytest.approx(15) and cut((0, -7, 0)) == pytest.approx(10) and cut((0, 0, 1)) == pytest.approx(6)
    assert sections.cut_areas(low, np.ones(3), np.full(3, 0.5), np.ones(3))[0] == pytest.approx(3 * math.sqrt(3) / 4)  # a regular hexagon
    assert cut((1, 1, 0)) == pytest.approx(2 * math.sqrt(2) * 5)
    assert cut((1, 0, 0), (9, 0, 0)) == 0
    assert [sections.cut_areas(low + [d, 0, 0], np.ones(3), np.array([1.0, 0.5, 0.5]), np.array([1.0, 0, 0]))[0] for d in (0, 1)] == [1.0, 0.0]  # a side in the plane


@pytest.mark.parametrize("seed", range(3))
def test_polygons_fill_a_solid(seed):
    """The polygons of all unit boxes of a large box add up to the large box's polygon."""
    rng = np.random.default_rng(seed)
    shape = np.array([4, 5, 6])
    low = np.argwhere(np.ones(shape))
    point, normal = rng.random(3) * shape, rng.normal(size=3)
    whole = sections.cut_areas(np.zeros((1, 3)), shape.astype(float), point, normal)[0]
    assert sections.cut_areas(low.astype(float), np.ones(3), point, normal).sum() == pytest.approx(whole)


@pytest.mark.parametrize("size", SIZES)
def test_known_solids(spark, size):
    beam = table(spark, itertools.product(range(5), range(5), range(40)))
    rows = [(1, 0, 2, 2, 20, 0.0, 0.0, 1.0), (1, 1, 2, 2, 20, 0.0, 1.0, 1.0), (1, 2, 2, 2, 20, 0.0, 0.0, 0.0), (1, 3, 9, 9, 9, 0.0, 0.0, 1.0), (1, 4, 2, 2, 20, 0.0, None, 1.0)]
    found = measured(spark, rows, beam, size=size)
    assert [found[k].area for k in range(5)] == [pytest.approx(25), pytest.approx(25 * math.sqrt(2)), 0, 0, 0]
    found = measured(spark, rows[:2], beam, size=size, resolution=(3, 4, 10))
    assert found[0].area == pytest.approx(25 * 12)


@pytest.mark.parametrize("size", SIZES)
def test_what_lies_beyond_a_gap_does_not_count(spark, size):
    rods = table(spark, [(x, 0, z) for x in (0, 2) for z in range(9)])
    assert measured(spark, [(1, 0, 0, 0, 4, 0.0, 0.0, 1.0)], rods, size=size)[0].area == pytest.approx(1)
    ring = [(x, y, 0) for x in range(21) for y in range(21) if x in (0, 20) or y in (0, 20)]  # goes through cells and comes back
    found = measured(spark, [(1, 0, 0, 0, 0, 0.0, 0.0, 1.0)], table(spark, [*ring, (10, 10, 0)]), size=size, bounds=((0, -5, 0), (21, 21, 9)))
    assert found[0].area == pytest.approx(80) and found[0].contact == 0b011011


@pytest.mark.parametrize("size", [(7, 5, 3), (64, 64, 64)])
def test_equals_one_search(spark, size):
    rng = np.random.default_rng(3)
    res = (2, 3, 5)
    points = {k: np.argwhere(rng.random((14, 13, 12)) < share) - 4 for k, share in ((1, 0.35), (2, 0.6))}
    rows = [(k, i, *map(int, points[k][rng.integers(len(points[k]))]), *map(float, rng.normal(size=3))) for k in points for i in range(12)]
    vol = table(spark, points[1]).unionByName(table(spark, points[2], 2))
    found = {(r.label, r.step): r.area for r in sections.section_areas(spark.createDataFrame([*rows, rows[0]], NODES), vol, res, size).collect()}
    assert len(found) == 24
    for r in rows:
        assert found[r[:2]] == pytest.approx(brute(points[r[0]], r[2:5], r[5:], res))


def test_nothing(spark):
    none = table(spark, [(0, 0, 0)]).limit(0)
    assert measured(spark, [(1, 0, 0, 0, 0, 0.0, 0.0, 1.0)], none)[0].area == 0
    assert sections.section_areas(spark.createDataFrame([], NODES), none).collect() == []

"""Surfaces cut at the planes of a grid."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from stratavox.operators import cuts, iso, mesh


def area(t):
    return np.linalg.norm(np.cross(t[:, 1] - t[:, 0], t[:, 2] - t[:, 0]), axis=1) / 2


@pytest.mark.parametrize("whole", [True, False])
def test_split(whole):
    """Whole coordinates make many corners and edges lie on the planes."""
    rng = np.random.default_rng(whole)
    points = rng.integers(-9, 10, (400, 3, 3)).astype(float) if whole else rng.normal(size=(400, 3, 3)) * 6
    origin, side = np.tile([1.0, -2.0, 0.5], (400, 1)), np.full(400, 3.0)
    pieces, of = cuts.split(points, origin, side)
    w = (pieces - origin[0]) / 3
    assert (np.ceil(w.max(axis=1) - 1e-9) - np.floor(w.min(axis=1) + 1e-9) <= 1).all()
    assert np.bincount(of, area(pieces), 400) == pytest.approx(area(points))
    normal = lambda t: np.cross(t[:, 1] - t[:, 0], t[:, 2] - t[:, 0])
    assert ((normal(pieces) * normal(points)[of]).sum(axis=1) >= -1e-9).all()


def ball(spark, radius=6):
    r = range(-radius, radius + 1)
    rows = [(x + 9, y + 9, z + 9, 1) for x in r for y in r for z in r if x * x + y * y + z * z <= radius * radius]
    return spark.createDataFrame([*rows, (40, 3, 3, 2)], "x long, y long, z long, label long")


def corners(rows):
    return [tuple(tuple(p) for p in (r.a, r.b, r.c)) for r in rows]


def test_fragments_end_at_planes(spark):
    tris = iso.iso_triangles(ball(spark)).filter("label = 1")
    rows = cuts.cut(cuts.on_grid(tris, 7)).collect()
    cells = defaultdict(list)
    for r in rows:
        cells[r.cx, r.cy, r.cz] += corners([r])
        for t in corners([r]):
            assert all(7 * c <= w <= 7 * c + 7 for p in t for w, c in zip(p, (r.cx, r.cy, r.cz), strict=True))
    assert len(cells) > 8
    edges = Counter(frozenset(e) for t in corners(rows) for e in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])))
    assert set(edges.values()) == {2}  # closed across all planes: neighbours have the same points on them
    before = corners(tris.collect())
    assert area(np.array(corners(rows))).sum() == pytest.approx(area(np.array(before, float)).sum())


def test_levels_end_in_one_fragment(spark):
    tris = mesh.triangles(ball(spark))
    found = cuts.levels(tris, 4, 8).groupBy("label", "lod", "cx", "cy", "cz").count().collect()
    per = defaultdict(set)
    for r in found:
        per[r.label, r.lod].add((r.cx, r.cy, r.cz))
    assert {k[1] for k in per if k[0] == 1} == {0, 1, 2} and {k[1] for k in per if k[0] == 2} == {0}
    assert per[1, 2] == {(0, 0, 0)} and len(per[1, 0]) > len(per[1, 1]) > 1
    assert {k[1] for k in {(r.label, r.lod) for r in cuts.levels(tris, 4, 2).collect()}} == {0, 1}


def test_nothing(spark):
    none = mesh.triangles(ball(spark).filter("label > 5"))
    assert cuts.levels(none, 4, 3).collect() == [] and cuts.cut(cuts.on_grid(none, 7)).collect() == []

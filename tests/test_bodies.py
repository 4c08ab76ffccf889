"""Tracing of labels with a cell body."""

from collections import Counter

import pytest

from stratavox.operators import skeleton

ARMS = [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1)]


def body(spark, arms, radius=9, reach=30):
    r = range(-radius, radius + 1)
    rows = {(x, y, z) for x in r for y in r for z in r if x * x + y * y + z * z <= radius * radius}
    rows |= {tuple(a * k for a in arm) for arm in arms for k in range(reach)}
    return spark.createDataFrame([(1, *(a + 40 for a in p)) for p in sorted(rows)], "label long, x long, y long, z long")


def tips(rows):
    """Voxels that no other comes after, but the root."""
    before = Counter((r.px, r.py, r.pz) for r in rows)
    return {(r.x, r.y, r.z) for r in rows if not before[r.x, r.y, r.z]}


@pytest.mark.parametrize("n", [1, 3, 5])
def test_a_branch_for_each_arm(spark, n):
    rows = skeleton.forge(body(spark, ARMS[:n]), (128, 128, 128), soma=6).collect()
    ends = {tuple(40 + 29 * a for a in arm) for arm in ARMS[:n]}
    assert tips(rows) == ends
    assert [(r.x, r.y, r.z) for r in rows if (r.x, r.y, r.z) == (r.px, r.py, r.pz)] == [(40, 40, 40)]


def test_thin_labels_have_no_body(spark):
    vol = body(spark, ARMS[:2])
    plain = sorted(map(tuple, skeleton.forge(vol, (128, 128, 128)).collect()))
    assert sorted(map(tuple, skeleton.forge(vol, (128, 128, 128), soma=99).collect())) == plain
    roots = {(r.x, r.y, r.z) for r in skeleton.forge(vol, (128, 128, 128)).collect() if (r.x, r.y, r.z) == (r.px, r.py, r.pz)}
    assert roots <= {(69, 40, 40), (11, 40, 40)}


def test_a_body_alone_is_one_voxel(spark):
    rows = skeleton.forge(body(spark, []), (128, 128, 128), soma=6).collect()
    assert [(r.x, r.y, r.z) for r in rows] == [(40, 40, 40)]

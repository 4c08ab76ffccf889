"""Merges into shards, targets of skeletons and graph volumes, on small volumes."""

import math
import random

import pandas as pd
import pytest

from stratavox.operators import graph_volume, mesh, sharded, skeleton
from stratavox.plans.scales import ShardSpec

SPEC = ShardSpec(0, 1, 2)
POINT = "struct<x: bigint, y: bigint, z: bigint>"


def voxels(spark, points):
    return spark.createDataFrame(points, "label long, x long, y long, z long")


def traced(spark, steps):
    """Rows of traced voxels from (label, voxel, voxel before it)."""
    return spark.createDataFrame([(n, 0, 0, 0, *a, *b, 1.0) for n, a, b in steps], skeleton.TRACED)


def line(label, length, at=0):
    return [(label, (i, at, 0), (max(i - 1, 0), at, 0)) for i in range(length)]


def test_skeletons_are_cleaned_and_dealt_to_shards(spark):
    branch = [(5, (4, 1, 0), (4, 0, 0))]
    square = [(6, (0, 0, 0), (0, 0, 0)), (6, (1, 0, 0), (0, 0, 0)), (6, (1, 1, 0), (1, 0, 0)), (6, (0, 1, 0), (1, 1, 0)), (6, (0, 0, 0), (0, 1, 0))]
    rows = traced(spark, line(5, 9) + branch + square + line(7, 2) + line(8, 40) + [(8, (20, 1, 0), (20, 0, 0))])
    nodes, edges = sharded.skeletons(rows, SPEC, dust=2, tick=2, longest=30)
    counts = {r.label: r["count"] for r in edges.groupBy("label").count().collect()}
    assert counts == {5: 8, 6: 3, 8: 40}  # the branch of 5, one edge of the square and all of 7 go; 8 is long and stays whole
    assert {r.label: r["count"] for r in nodes.groupBy("label").count().collect()} == {5: 9, 6: 4, 8: 41}
    assert {(r.label, r.shard, r.minishard) for r in nodes.select("label", "shard", "minishard").distinct().collect()} == {(5, 2, 1), (6, 3, 0), (8, 0, 0)}


def test_skeletons_of_one_voxel_and_of_nothing(spark):
    rows = traced(spark, [(1, (3, 3, 3), (3, 3, 3))])
    nodes, edges = sharded.skeletons(rows, SPEC)
    assert [(r.label, r.x) for r in nodes.collect()] == [(1, 3)] and edges.count() == 0
    assert sharded.skeletons(rows, SPEC, dust=1)[0].count() == 0
    assert sharded.skeletons(rows.limit(0), SPEC, hashed=True)[0].count() == 0


def test_meshes_of_shards_keep_every_triangle(spark):
    box = voxels(spark, [(3, x, y, z) for x in range(10) for y in range(4) for z in range(4)])
    tris = mesh.triangles(box)
    found = sharded.meshes(mesh.fragments(tris, 3), SPEC, 4, lods=2).collect()
    first = [r for r in found if r.lod == 0]
    assert sorted(t for r in first for t in r.triangles) == sorted((r.a, r.b, r.c) for r in tris.collect())
    assert {(r.shard, r.minishard) for r in found} == {(1, 1)}
    for lod in (0, 1):
        level, at = sorted((r for r in found if r.lod == lod), key=lambda r: r.place), 0
        assert [r.code for r in level] == sorted({r.code for r in level})
        for r in level:
            assert r.first == at and r.n_triangles == len(r.triangles)
            at += r.n_triangles
        assert 0 < at and (lod == 0 or at < tris.count())
    assert sharded.meshes(mesh.fragments(tris.limit(0), 3), SPEC, 4).count() == 0


def test_targets_get_paths_and_kinds(spark):
    slab = voxels(spark, [(1, x, y, 0) for x in range(12) for y in range(9)])
    points = spark.createDataFrame([(1, 6, 11, 0, 2), (1, 6, 30, 0, 1), (2, 6, 8, 0, 1)], "label long, x long, y long, z long, kind int")
    wanted = skeleton.nearest_voxels(points, slab, 4)
    assert [tuple(r) for r in wanted.collect()] == [(1, 6, 8, 0, 2)]  # one is too far, one of a label without voxels
    nodes, _ = skeleton.merge(skeleton.forge(slab, (16, 16, 16)))
    assert nodes.filter("x = 6 and y = 8").count() == 0
    nodes, edges = skeleton.merge(skeleton.forge(slab, (16, 16, 16), targets=wanted))
    kinds = {(r.x, r.y): r.kind for r in skeleton.typed(nodes, wanted).collect()}
    assert kinds[6, 8] == 2 and sum(kinds.values()) == 2
    assert edges.count() == nodes.count() - 1  # the path joins the tree
    off = wanted.selectExpr("label", "x + 100 as x", "y", "z")
    assert skeleton.merge(skeleton.forge(slab, (16, 16, 16), targets=off))[0].filter("x > 11").count() == 0


def test_targets_add_no_voxels_to_a_trace():
    bar = pd.DataFrame([(1, 0, 0, 0, x, 0, 0, False) for x in range(6)], columns=["label", "cx", "cy", "cz", "x", "y", "z", "target"])
    aside = pd.concat([bar, bar.head(1).assign(y=7, target=True)], ignore_index=True)
    pd.testing.assert_frame_equal(skeleton.trace(bar), skeleton.trace(aside))


@pytest.mark.parametrize("time, want", [(0, {1: 10, 2: 20, 3: 30}), (4, {1: 10, 2: 20, 3: 30}), (5, {1: 20, 3: 30}), (9, {1: 20, 3: 30})])
def test_ancestors_hold_for_a_time(spark, time, want):
    tree = spark.createDataFrame(
        [(1, 10, 1, 0, 5), (1, 20, 1, 5, None), (2, 20, 1, None, 5), (3, 30, 1, None, None)], "child long, parent long, layer int, valid_from long, valid_to long"
    )
    vol = voxels(spark, [(n, n, 0, 0) for n in (1, 2, 3, 4)])
    assert {r.x: r.label for r in graph_volume.ancestors(vol, tree, 1, time).collect()} == want


def test_faces_between_supervoxels_are_inside(spark):
    tree = spark.createDataFrame([(1, 9, 1), (2, 9, 1)], "child long, parent long, layer int")
    vol = voxels(spark, [(1, 0, 0, 0), (2, 1, 0, 0)])
    assert mesh.triangles(vol).count() == 24 and graph_volume.surfaces(vol, tree, 1).count() == 20


def test_prefixes_are_those_of_all_labels(spark):
    want = {str((200 << 56) + (x << 52) + (y << 48))[:4] for x in range(16) for y in range(16)}
    assert {r.prefix for r in graph_volume.prefixes(spark, 200, 8, 4, 4, 4).collect()} == want


def forest(rows):
    """Kruskal over (label, a, b): edges by length, then by ends."""
    up, kept = {}, set()

    def root(v):
        while up.get(v, v) != v:
            v = up[v]
        return v

    for label, a, b in sorted({(n, min(a, b), max(a, b)) for n, a, b in rows if a != b}, key=lambda e: (math.dist(e[1], e[2]), e)):
        p, q = root((label, a)), root((label, b))
        if p != q:
            up[p] = q
            kept.add((label, a, b))
    return kept


@pytest.mark.parametrize("most", [1 << 18, 40])
def test_loops_of_small_labels_take_one_table(spark, monkeypatch, most):
    rng, written = random.Random(most), []
    spot = lambda: (rng.randrange(200), rng.randrange(5), 0)
    rows = [(k % 3 and k % 9, spot(), spot()) for k in range(400)]
    rows += rows[:20]

    def kept(df, name, write=skeleton.materialise):
        written.append(name)
        return write(df, name)

    monkeypatch.setattr(skeleton, "materialise", kept)
    monkeypatch.setattr(skeleton, "EDGES", most, raising=False)
    edges = spark.createDataFrame(rows, "label long, a struct<x:long,y:long,z:long>, b struct<x:long,y:long,z:long>")
    assert sorted((r.label, tuple(r.a), tuple(r.b)) for r in skeleton.without_loops(edges).collect()) == sorted(forest(rows))
    assert (len(written) == 1) == (most > 400)


def test_nodes_and_edges_are_written_once(spark, monkeypatch):
    written = []

    def kept(df, name, write=sharded.materialise):
        written.append(name)
        return write(df, name)

    monkeypatch.setattr(sharded, "materialise", kept)
    monkeypatch.setattr(skeleton, "materialise", kept)
    rows = [(1, 0, 0, 0, 0, 0, 0, 1.0), (1, 1, 0, 0, 0, 0, 0, 1.0), (1, 9, 9, 9, 9, 9, 9, 1.0), (2, 5, 5, 5, 5, 5, 5, 2.0)]
    nodes, edges = sharded.skeletons(spark.createDataFrame(rows, skeleton.TRACED.replace(" cx long, cy long, cz long,", "")), SPEC)
    assert sorted((r.label, r.x) for r in nodes.collect()) == [(1, 0), (1, 1), (2, 5)]  # a voxel apart in a label with edges is none
    assert edges.count() == 1 and written == ["merged-edges", "merged-nodes", "loops-thin"]

"""Labels across the borders of a graph volume's chunks, against a plain walk over each chunk."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import graph_chunks, mesh

CHUNK, SHAPE, TOP = (4, 4, 3), (12, 8, 6), 5


def chunk_of(p):
    return tuple(a // c for a, c in zip(p, CHUNK, strict=True))


def brute(nodes, parents):
    """nodes: voxel to node; parents: node to its ancestors by layer. The rows of overlap_labels."""
    out = set()
    chunks = {chunk_of(p) for p in nodes} | {tuple(np.subtract(chunk_of(p), d)) for p in nodes for d in np.ndindex(2, 2, 2)}
    for c in chunks:
        window = {p: n for p, n in nodes.items() if all(k * s <= a <= (k + 1) * s for a, k, s in zip(p, c, CHUNK, strict=True))}
        own = {p: n for p, n in window.items() if chunk_of(p) == c}
        if min(c) < 0:
            continue
        layer = next((k + 2 for k in range(1, TOP - 1) if all(a // 2**k == (a + 1) // 2**k for a in c)), TOP)
        root = lambda n: parents.get(n, {}).get(layer)  # noqa: B023, E731
        having = defaultdict(set)
        for n in own.values():
            having[root(n)].add(n)
        out |= {(*c, *p, n) for p, n in own.items()}
        rest = defaultdict(set)
        for p, n in window.items():
            if p not in own and root(n) is not None and having.get(root(n)):
                if len(having[root(n)]) == 1:
                    out.add((*c, *p, min(having[root(n)])))
                else:
                    rest[root(n)].add(p)
        for r, left in rest.items():
            while left:
                piece, queue = set(), [left.pop()]
                while queue:
                    p = queue.pop()
                    piece.add(p)
                    near = {q for q in left if max(abs(a - b) for a, b in zip(p, q, strict=True)) == 1}
                    left -= near
                    queue += near
                found = set()
                for p in piece:
                    for axis in range(3):
                        if p[axis] == (c[axis] + 1) * CHUNK[axis]:
                            q = tuple(a - (i == axis) for i, a in enumerate(p))
                            found |= {own[q]} & having[r] if q in own else set()
                if found:
                    out |= {(*c, *p, min(found)) for p in piece}
    return out


@pytest.mark.parametrize(("seed", "share", "kinds"), [(0, 0.9, 4), (1, 0.5, 6), (2, 0.7, 12)])
def test_equals_walk(spark, seed, share, kinds):
    rng = np.random.default_rng(seed)
    nodes, parents = {}, {}
    for p in np.ndindex(*SHAPE):
        if rng.random() < share:
            c, kind = chunk_of(p), int(rng.integers(kinds))
            node = 1 + kind + 100 * (c[0] + 10 * c[1] + 100 * c[2])
            nodes[p] = node
            if kind:  # nodes of kind 0 have no ancestors
                parents[node] = {3: 10**6 + kind // 2 + 100 * (c[0] // 2), 4: 2 * 10**6 + kind // 2, 5: 3 * 10**6 + kind // 4}
    links = {(child, parent, 3) for child, up in parents.items() for parent in [up[3]]} | {(up[k], up[k + 1], k + 1) for up in parents.values() for k in (3, 4)}
    vol = spark.createDataFrame([(*p, n) for p, n in nodes.items()], "x long, y long, z long, node long")
    tree = spark.createDataFrame(sorted(links), "child long, parent long, layer int")
    found = graph_chunks.overlap_labels(vol.unionByName(vol.limit(5)), tree, CHUNK, TOP)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(nodes, parents)


def test_split_roots_stay_apart(spark):
    """Two arms of one root in a chunk go on in the next one as one node: each arm's surface keeps its own half."""
    arms = [(x, y, 0, 1 + y // 2 if x < 4 else 9) for x in range(8) for y in (0, 2)]
    vol = spark.createDataFrame(arms, "x long, y long, z long, node long")
    tree = spark.createDataFrame([(n, 50, 3) for n in (1, 2, 9)], "child long, parent long, layer int")
    found = {tuple(r) for r in graph_chunks.overlap_labels(vol, tree, CHUNK, 3).filter("cx = 0 and x = 4").collect()}
    assert found == {(0, 0, 0, 4, 0, 0, 1), (0, 0, 0, 4, 2, 0, 2)}
    tris = graph_chunks.chunk_meshes(vol, tree, CHUNK, 3).filter("cx = 0").groupBy("label").count().collect()
    box = mesh.triangles(spark.createDataFrame([(x, 0, 0, 1) for x in range(5)], "x long, y long, z long, label long")).count()
    assert {r.label: r["count"] for r in tris} == {1: box, 2: box}


def test_layers(spark):
    at = spark.createDataFrame([(0, 0, 0), (1, 0, 0), (3, 0, 0), (2, 2, 7)], "cx long, cy long, cz long")
    assert [r.n for r in at.select(graph_chunks.agreed_layer(2, 9).alias("n")).collect()] == [3, 4, 5, 6]
    assert at.select(F.max(graph_chunks.agreed_layer(2, 4)).alias("n")).first().n == 4


def arms(spark):
    """Two arms that touch all along and are joined at one end only: they are two nodes in their chunk, and one in the next."""
    rows = [(1, 1 + (y > 1), x, y, 1) for x in range(1, 16) for y in range(1, 3)] + [(1, 3, x, y, 1) for x in range(16, 20) for y in range(1, 3)]
    return spark.createDataFrame(rows, "label long, node long, x long, y long, z long")


def test_touching_arms_stay_apart(spark):
    from stratavox.operators import skeleton

    free = {(r.x, r.y, r.px, r.py) for r in skeleton.forge(arms(spark), (64, 64, 8)).collect()}
    kept = {(r.x, r.y, r.px, r.py) for r in skeleton.forge(arms(spark), (64, 64, 8), chunk=(16, 16, 16)).collect()}
    crossing = lambda paths: {p for p in paths if p[1] != p[3] and max(p[0], p[2]) < 15}
    assert not crossing(kept) and {x for x, *_ in kept} >= set(range(2, 15))
    tips = {y for x, y, *_ in kept if x == 1}
    assert tips == {1, 2} and len({y for x, y, *_ in free if x == 1}) == 1  # without the graph one path covers both


def test_bits_are_the_rule(spark):
    from stratavox.operators import skeleton

    rng = np.random.default_rng(4)
    dense = rng.integers(0, 3, (9, 8, 7))
    node = rng.integers(0, 2, dense.shape) + 10 * (np.indices(dense.shape) // 4).sum(axis=0)
    vol = spark.createDataFrame([(int(dense[p]), int(node[p]), *map(int, p)) for p in np.ndindex(*dense.shape) if dense[p]], "label long, node long, x long, y long, z long")
    found = {(r.x, r.y, r.z): r.bits for r in skeleton.graph_bits(vol.unionByName(vol.limit(3)), (4, 4, 4)).collect()}
    for p in np.ndindex(*dense.shape):
        if dense[p]:
            told = 0
            for k, s in enumerate(skeleton.STEPS.tolist()):
                q = tuple(np.add(p, s))
                if all(0 <= a < n for a, n in zip(q, dense.shape, strict=True)) and dense[q] == dense[p] and (any(a % 4 in (0, 3) for a in p) or node[p] == node[q]):
                    told |= 1 << k
            assert found[p] == told


def test_merge_by_prefix(spark, tmp_path):
    from stratavox.operators import graph_volume, skeleton

    traced = skeleton.forge(arms(spark).withColumn("label", F.lit(123456789)), (8, 64, 8))
    graph_volume.merge_by_prefix(traced, str(tmp_path))
    nodes, edges = skeleton.merge(traced)
    back = spark.read.parquet(f"{tmp_path}/nodes")
    assert {r.prefix for r in back.select("prefix").distinct().collect()} == {123456} and back.count() == nodes.count()
    assert spark.read.parquet(f"{tmp_path}/edges").count() == edges.count()

"""Operators on small made-up volumes, where the right answer is known or an invariant holds."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratavox import registry
from stratavox.functions.codes import hashed_label, label_of, murmur3_labels
from stratavox.operators import ccl, iso, mesh, pool, relabel, select, skeleton, stats
from stratavox.sources import volume
from stratavox.streaming import ingest


def voxels(spark, points, columns="x long, y long, z long, label long"):
    return spark.createDataFrame(points, columns)


def checkerboard(side=8, block=2):
    n = side // block
    return [(x, y, z, 1 + x // block + n * (y // block + n * (z // block))) for x in range(side) for y in range(side) for z in range(side)]


def test_components_of_a_checkerboard_are_its_blocks(spark):
    vol = voxels(spark, checkerboard())
    found = ccl.auto(vol, (8, 8, 8))
    assert sorted(r[0] for r in found.select("label").distinct().collect()) == list(range(1, 65))
    assert {r[0] for r in ccl.sizes(ccl.components(vol, (8, 8, 8), label="label")).select("voxels").collect()} == {8}


def union_find(points, shape, reach):
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            parent[p] = parent[parent[p]]
            p = parent[p]
        return p

    order = lambda p: p[0] + shape[0] * (p[1] + shape[1] * p[2])
    for x, y, z in points:
        for i, j, k in [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if 0 < abs(i) + abs(j) + abs(k) <= reach]:
            q = (x + i, y + j, z + k)
            if q in parent:
                a, b = sorted((root((x, y, z)), root(q)), key=order)
                parent[b] = a
    return {p: order(root(p)) for p in points}


@pytest.mark.parametrize("connectivity,reach", [(6, 1), (18, 2), (26, 3)])
def test_components_match_union_find(spark, connectivity, reach):
    rng = np.random.default_rng(connectivity)
    points = [tuple(map(int, p)) for p in np.argwhere(rng.random((9, 8, 7)) < 0.25)]
    found = ccl.components(voxels(spark, points, "x long, y long, z long"), (9, 8, 7), connectivity)
    assert {(r.x, r.y, r.z): r.component for r in found.collect()} == union_find(points, (9, 8, 7), reach)


def test_components_of_nothing(spark):
    assert ccl.components(voxels(spark, [], "x long, y long, z long"), (4, 4, 4)).count() == 0


def test_local_dust_depends_on_the_cell_and_global_does_not(spark):
    vol = voxels(spark, [(3, 0, 0, 1), (4, 0, 0, 1), (0, 5, 0, 2)])
    assert select.local_dust(vol, 2, (4, 4, 4)).count() == 0
    assert select.local_dust(vol, 2, (8, 8, 8)).count() == 2
    assert select.global_dust(vol, stats.voxel_counts(vol), 2).count() == 2


def test_holes_are_filled(spark):
    box = [(x, y, z, 5) for x in range(1, 4) for y in range(1, 4) for z in range(1, 4) if (x, y, z) != (2, 2, 2)]
    assert [tuple(r) for r in ccl.fill_holes(voxels(spark, box), (5, 5, 5)).collect()] == [(2, 2, 2, 5)]


def test_levels_of_averages_equal_one_average(spark):
    rng = np.random.default_rng(1)
    points = [(x, y, 0, int(rng.integers(1, 255))) for x in range(16) for y in range(16)]
    vol = voxels(spark, points, "x long, y long, z long, v long")
    levels = pool.pyramid(vol, (2, 2, 1), 3, "image", shape=(16, 16, 1))
    top = {(r.x, r.y): r.v for r in levels.filter("mip = 3").collect()}
    dense = np.zeros((16, 16), int)
    for x, y, _, v in points:
        dense[x, y] = v
    assert top == {(i, j): int(dense[8 * i : 8 * i + 8, 8 * j : 8 * j + 8].mean()) for i in range(2) for j in range(2)}


def test_odd_sizes_average_what_is_there(spark):
    vol = voxels(spark, [(x, 0, 0, 10) for x in range(3)], "x long, y long, z long, v long")
    assert {r.x: r.v for r in pool.average(vol, (2, 2, 1), shape=(3, 1, 1)).collect()} == {0: 10, 1: 10}


def test_methods():
    assert pool.method_for("image") == pool.Method.AVERAGE and pool.method_for("segmentation") == pool.Method.MODE
    assert pool.method_for("affinities") == pool.Method.STRIDING and pool.method_for("image", pool.Method.MAX) == pool.Method.MAX


def test_strict_reads_and_arrays_raise(spark):
    vol = voxels(spark, [(0, 0, 0, 9)])
    assert select.touch(vol, (4, 4, 4), (2, 2, 2), fill_missing=True).count() == 8
    with pytest.raises(Exception, match="missing"):
        select.touch(vol, (4, 4, 4), (2, 2, 2)).collect()
    with pytest.raises(Exception, match="outside"):
        relabel.remap_array(vol, spark.createDataFrame([(0, 1)], "position long, value long")).collect()
    with pytest.raises(ValueError):
        select.reorder(vol, {0: 1}, 2)


def test_boxes_snap_outward_and_clamp():
    assert select.snap(((3, 5, 0), (70, 64, 9)), (64, 64, 8), ((0, 0, 0), (100, 100, 10))) == ((0, 0, 0), (100, 64, 10))
    assert select.to_mip(((3, 5, 1), (9, 8, 2)), (2, 2, 1), 1) == ((1, 2, 1), (5, 4, 2))


def test_threshold_identity_and_bounds(spark):
    vol = spark.createDataFrame([(0, 0, 0, v) for v in range(5)], "x long, y long, z long, v long")
    assert select.threshold(vol) is vol
    assert [r.v for r in select.threshold(vol, gte=2, lte=3).collect()] == [False, False, True, True, False]


def test_sampled_histogram_at_full_coverage_is_the_histogram(spark):
    rng = np.random.default_rng(3)
    vol = voxels(spark, [(x, y, z, int(rng.integers(0, 9))) for x in range(8) for y in range(8) for z in range(2)], "x long, y long, z long, v long")
    full = {tuple(r) for r in stats.histogram(vol).collect()}
    assert {tuple(r) for r in stats.sampled_histogram(vol, 4, 1.0, (8, 8)).collect()} == full
    assert stats.sampled_histogram(vol, 4, 0.5, (8, 8)).agg(F.sum("n")).first()[0] == 64


def test_surfaces_are_closed(spark):
    cube = voxels(spark, [(x, y, z, 2) for x in range(3) for y in range(3) for z in range(3)])
    r = mesh.meshes(mesh.triangles(cube)).first()
    assert (r.vertices, r.triangles, r.euler) == (56, 108, 2)
    tris = mesh.triangles(cube)
    ends = F.array(*[F.array(p, q) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))])
    directed = tris.select(F.explode(ends).alias("e"))
    back = directed.select(F.array(F.col("e")[1], F.col("e")[0]).alias("e"))
    assert directed.exceptAll(back).count() == 0  # every edge is walked once each way
    assert mesh.surface(cube, (1, 2, 3)).first().area == 9 * 2 * (6 + 3 + 2)


def fragments(vol, chunk, lods):
    """Fragments of the levels of voxels {(x, y, z): label} as (label, cx, cy, cz, triangles, lod, code), by brute force."""
    out = Counter()
    for lod in range(lods):
        seen = set()
        for at, label in vol.items():
            for d, corners in mesh.FACES.items():
                if vol.get(tuple(p + q for p, q in zip(at, d, strict=True))) == label:
                    continue
                p = [tuple((v + c) >> lod << lod for v, c in zip(at, k, strict=True)) for k in corners]
                seen |= {(label, *t) for t in ((p[0], p[1], p[2]), (p[0], p[2], p[3])) if len(set(t)) == 3}
        out.update((label, lod, *[v // (chunk << lod) for v in a]) for label, a, _, _ in seen)
    code = lambda *c: sum((c[k] >> i & 1) << (3 * i + k) for i in range(10) for k in range(3))
    return {(label, *c, n, lod, code(*c)) for (label, lod, *c), n in out.items()}


FRAGMENT = ("label", "cx", "cy", "cz", "triangles", "lod", "code")


def test_every_level_of_detail_matches_brute_force(spark):
    rng = random.Random(3)
    vol = {(x, y, z): rng.choice([3, 40, 5000]) for x in range(20) for y in range(9) for z in range(5) if rng.random() < 0.7}
    found = mesh.levels(mesh.triangles(voxels(spark, [(*p, v) for p, v in vol.items()])), 4, (20, 9, 5))
    want = fragments(vol, 4, 4)
    assert {tuple(r) for r in found.select(*FRAGMENT).collect()} == want
    assert {r[5] for r in want} == {0, 1, 2, 3}


def test_mesh_lods_has_every_label_and_level(spark):
    d = "/root/testdata/sf0.01"
    vol = {(r.x, r.y, r.z): r.label for r in registry.seg(spark, d).select("x", "y", "z", "label").collect()}
    found = [tuple(r) for r in registry.queries()["mesh_lods"](spark, d).select(*FRAGMENT).collect()]
    assert max(vol.values()) > 80
    assert len(found) == len(set(found)) and set(found) == fragments(vol, 16, 4)


def test_whole_volume_queries_leave_nothing_out(spark):
    d = "/root/testdata/sf0.01"
    vol, run = registry.seg(spark, d), lambda name: registry.queries()[name](spark, d)
    assert run("unsigned_labels_whole").count() == vol.select("label").distinct().count()
    assert {r.layer for r in run("common_layer_whole").select("layer").distinct().collect()} == {1, 2, 3, 4, -1}
    assert run("common_layer_whole").count() == vol.count()
    same = run("dilate27_whole").join(vol.select("x", "y", "z", "label"), ["x", "y", "z", "label"], "left_semi")
    assert same.count() == vol.count()
    cells = {(r.x // 32, r.y // 32) for r in registry.fixture(spark, d, "points").filter("z between 0 and 6").collect()}
    want = {(r.x // 2, r.y // 2, r.z) for r in vol.collect() if (r.x // 32, r.y // 32) in cells}
    assert {(r.x, r.y, r.z) for r in run("fix_up_pool_whole").collect()} == want


def test_levels_of_detail():
    assert mesh.max_lod((512, 512, 512), (64, 64, 64), 5) == 3 and mesh.max_lod((512, 512, 512), (64, 64, 64), 2) == 2
    assert mesh.target_triangles(100, 1, 1) == 50 and mesh.target_triangles(5, 3, 1) == 4
    with pytest.raises(ValueError):
        mesh.quantisation(0, 1, 1, 12)


def test_skeletons_are_trees_on_their_labels(spark):
    bar = voxels(spark, [(x, y, z, 1) for x in range(24) for y in range(3) for z in range(3)])
    traced = skeleton.forge(bar, (16, 16, 16))
    nodes, edges = skeleton.merge(traced)
    inside = {(r.x, r.y, r.z) for r in bar.collect()}
    assert {(r.x, r.y, r.z) for r in nodes.collect()} <= inside
    assert skeleton.cable_length(edges).first().length >= 18
    one = traced.filter("cx = 0")
    assert one.filter("x = px AND y = py AND z = pz").count() == 1  # a root; each other voxel has one before it


def test_searches_within_a_cell_find_least_costs():
    import heapq

    rng = np.random.default_rng(5)
    for _ in range(6):
        points = np.argwhere(rng.random((7, 6, 5)) < 0.45) + rng.integers(-5, 5, 3)
        cost, rows = 1 + rng.random(len(points)) * 50, {tuple(p): i for i, p in enumerate(points)}
        body = skeleton._Body(points)
        far, heap = np.full(len(points), np.inf), [(0.0, 0)]
        far[0] = 0
        while heap:
            d, u = heapq.heappop(heap)
            for s in skeleton.STEPS:
                v = rows.get(tuple(points[u] + s))
                if v is not None and (n := d + np.sqrt((s**2).sum()) * cost[v]) < far[v]:
                    far[v] = n
                    heapq.heappush(heap, (n, v))
        found, before = body.distances(np.array([0]), cost)
        assert np.allclose(found, far)
        reached = np.flatnonzero(np.isfinite(far) & (np.arange(len(far)) > 0))
        assert np.allclose(far[before[reached]] + np.sqrt(((points[reached] - points[before[reached]]) ** 2).sum(axis=1)) * cost[reached], far[reached])


def test_traces_do_not_depend_on_the_order_of_voxels():
    at = np.argwhere(np.add.outer(np.add.outer((np.arange(19) - 9) ** 2, (np.arange(9) - 4) ** 2), (np.arange(9) - 4) ** 2) < 40)
    group = pd.DataFrame(at, columns=list("xyz")).assign(label=1, cx=0, cy=0, cz=0)
    one, other = skeleton.trace(group), skeleton.trace(pd.concat([group, group]).sample(frac=1, random_state=3))
    assert one.equals(other)


def test_cells_of_skeletons_are_bounded(spark):
    with pytest.raises(ValueError):
        skeleton.forge(voxels(spark, [(0, 0, 0, 1)]), (512, 512, 512))


def test_chunks_shards_and_files(spark, tmp_path):
    vol = voxels(spark, [(x, y, z, 1 + (x * y + z) % 200) for x in range(10) for y in range(9) for z in range(3)], "x long, y long, z long, v long")
    chunks = volume.to_chunks(vol, (4, 4, 4))
    assert {tuple(r) for r in volume.to_voxels(chunks, (4, 4, 4)).collect()} == {tuple(r) for r in vol.collect()}
    spec = volume.ShardSpec(1, 1, 3)
    sharded = volume.with_shards(chunks, spec, (3, 3, 1))
    volume.write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == chunks.count()
    volume.write_volume(vol.withColumn("mip", F.lit(0)), str(tmp_path / "v"))
    assert volume.read_volume(spark, str(tmp_path / "v"), 0, ((0, 0, 0), (2, 2, 1))).count() == 4
    dense = np.zeros((3, 4, 2), np.uint8)
    dense[2, 3, 1] = 7
    np.save(tmp_path / "a.npy", dense)
    assert [tuple(r) for r in volume.import_npy(spark, str(tmp_path / "a.npy"), (4, 4, 4), (3, 4, 2)).collect()] == [(2, 3, 1, 7)]


def test_info_goes_through_json():
    scale = volume.Scale("16_16_40", (512, 512, 64), (16, 16, 40), (64, 64, 64), sharding=volume.ShardSpec(3, 0, 4))
    info = volume.VolumeInfo("segmentation", "uint64", (scale,), rois=(((0, 0, 0), (5, 5, 5)),)).processed(task="count", by="x")
    assert volume.VolumeInfo.from_json(info.to_json()) == info
    assert volume.compression_for("jpeg") == "none" and volume.compression_for("raw") == "gzip" and volume.compression_for("raw", "zstd") == "zstd"


def test_names(spark):
    df = spark.createDataFrame([("12:0:0-1_0-1_0-1",), ("info",)], "name string")
    assert [r[0] for r in df.select(label_of(F.col("name"))).collect()] == [12, None]


def test_murmur_is_even_and_stable(spark):
    labels = np.arange(1 << 14, dtype=np.uint64)
    counts = np.bincount((murmur3_labels(labels) & np.uint64(15)).astype(int), minlength=16)
    assert counts.min() > 900 and len(set(murmur3_labels(labels).tolist())) == len(labels)
    df = spark.range(5).select("id", hashed_label(F.col("id")).alias("h"))
    assert [r.h for r in df.orderBy("id").collect()] == murmur3_labels(np.arange(5, dtype=np.uint64)).view(np.int64).tolist()


def test_ingest_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, 0, 1, 0), (1, 0, 0, 2, 0)], "x long, y long, z long, label long, mip int")
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.read_chunks(spark, str(tmp_path / "in"), rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    for k in range(2):  # the second time under a new checkpoint: the same batch number overwrites
        ingest.ingest(stream, str(tmp_path / "out"), str(tmp_path / f"c{k}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    counts = ingest.arriving_counts(stream).writeStream.format("memory").queryName("arrived").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination()
    assert {tuple(r) for r in spark.table("arrived").collect()} == {(1, 1), (2, 1)}


def test_cells_of_any_size_give_the_same_components(spark):
    import random

    rng = random.Random(2)
    rows = [(x, y, z, rng.choice([1, 2])) for x in range(9) for y in range(8) for z in range(5) if rng.random() < 0.6]
    vol = spark.createDataFrame(rows, "x long, y long, z long, label long")
    for connectivity in (6, 18, 26):
        one, many, thin = (sorted(map(tuple, ccl.components(vol, (9, 8, 5), connectivity, "label", size).collect())) for size in ((9, 8, 5), (2, 3, 2), (1, 1, 1)))
        assert one == many == thin and len(one) == len(rows)


def test_small_pieces_of_a_cell_go_before_labelling(spark):
    line, speck = [(x, 0, 0, 9) for x in range(6)], [(3, 3, 0, 9)]
    vol = spark.createDataFrame(line + speck, "x long, y long, z long, v long")
    found = lambda **k: {(r.x, r.y, r.z) for r in ccl.auto(vol, (6, 6, 1), gte=5, dust_scope="cell", **k).collect()}
    assert found(dust=2, size=(6, 6, 1)) == {(x, 0, 0) for x in range(6)}
    assert found(dust=2, size=(5, 6, 1)) == {(x, 0, 0) for x in range(5)} and len(found(dust=1)) == 7


def test_kernels_see_their_halo(spark):
    from stratavox.operators.kernel import apply_cells

    vol = spark.createDataFrame([(3, 0, 0, 8), (4, 0, 0, 1)], "x long, y long, z long, v long")
    shift = lambda dense: np.roll(dense, 1, axis=0)
    assert sorted(map(tuple, apply_cells(vol, (4, 2, 1), (1, 0, 0), shift).collect())) == [(4, 0, 0, 8.0), (5, 0, 0, 1.0)]
    with pytest.raises(ValueError):
        apply_cells(vol, (4, 2, 1), (4, 0, 0), shift)
    assert apply_cells(vol.limit(0), (4, 2, 1), (1, 0, 0), shift).count() == 0


def test_fragments_hold_every_triangle_in_z_order(spark):
    vol = spark.createDataFrame([(x, y, z, 1 + x // 3) for x in range(6) for y in range(5) for z in range(4)], "x long, y long, z long, label long")
    tris = mesh.triangles(vol)
    pieces = mesh.fragments(tris, 2)
    assert pieces.selectExpr("label", "inline(triangles)").exceptAll(tris).count() == 0
    rows = sorted(mesh.gathered(pieces).collect(), key=lambda r: (r.label, r.place))
    for label in (1, 2):
        own = [r for r in rows if r.label == label]
        assert [r.code for r in own] == sorted(r.code for r in own) and own[0]["first"] == 0
        assert all(a["first"] + a.n_triangles == b["first"] for a, b in zip(own, own[1:], strict=False))
    assert sum(r.n_triangles for r in rows) == tris.count()


def test_a_transfer_may_leave_levels_out(spark):
    vol = spark.createDataFrame([(x, 0, 0, 4) for x in range(8)], "x long, y long, z long, v long")
    mips = lambda **k: {r.mip for r in pool.transferred(vol, (2, 1, 1), 2, **k).collect()}
    assert mips() == {0, 1, 2} and mips(skip_first=True) == {1, 2} and mips(skip_downsamples=True) == {0}


def test_texts_for_people():
    from stratavox.functions.people import ago_text, size_text

    assert [size_text(n) for n in (0, 999, 1000, 2_345_678, 10**18)] == ["0 B", "999 B", "1.00 kB", "2.35 MB", "1.00 EB"]
    assert [ago_text(n) for n in (0, 1, 59, 60, 7200, 90_000)] == ["just now", "1 second ago", "59 seconds ago", "1 minute ago", "2 hours ago", "1 day ago"]


def test_short_side_branches_go(spark):
    trunk = [((x, 0, 0), (x + 1, 0, 0)) for x in range(20)]
    twig, limb = [((5, y, 0), (5, y + 1, 0)) for y in range(2)], [((12, y, 0), (12, y + 1, 0)) for y in range(7)]
    alone = [((0, 50, 0), (1, 50, 0))]
    frame = spark.createDataFrame([(1, *e) for e in trunk + twig + limb + alone], "label long, a struct<x:long,y:long,z:long>, b struct<x:long,y:long,z:long>")
    left = {(tuple(r.a), tuple(r.b)) for r in skeleton.without_ticks(frame, 4.0).collect()}
    assert left == set(trunk + limb + alone)
    assert skeleton.without_ticks(frame.limit(0), 4.0).count() == 0


def signed_volume(rows):
    """Six times the volume within a surface of triangles, from the corners' determinants."""
    return sum(np.linalg.det(np.array([tuple(r.a), tuple(r.b), tuple(r.c)], float)) for r in rows)


def ball(radius):
    at = range(-radius, radius + 1)
    return [(x + 20, y + 20, z + 20, 1) for x in at for y in at for z in at if x * x + y * y + z * z <= radius * radius]


def test_iso_surfaces_are_closed_and_face_outwards(spark):
    ring = [(x, y, z, 2) for x in range(5) for y in range(5) for z in range(2) if not (1 < x < 3 and 1 < y < 3)]
    tris = iso.iso_triangles(voxels(spark, ball(4) + ring + ring[:3]))
    found = {r.label: r for r in mesh.meshes(tris).collect()}
    assert {k: r.euler for k, r in found.items()} == {1: 2, 2: 0}
    assert all(2 * r.edges == 3 * r.triangles for r in found.values())
    sides = Counter((r.label, p, q) for r in tris.collect() for p, q in ((r.a, r.b), (r.b, r.c), (r.c, r.a)))
    assert all(sides[label, q, p] == n for (label, p, q), n in sides.items())  # as often one way as the other
    volume_of = signed_volume(tris.filter("label = 1").collect()) / 6 / 8
    assert 0.8 < volume_of / len(ball(4)) < 1.1
    assert iso.iso_triangles(voxels(spark, ball(1)).limit(0)).count() == 0


def test_every_mask_of_a_cube_has_the_surface_of_its_complement_turned():
    for mask in range(1, 255):
        own, other = iso.crossings(mask), iso.crossings(255 - mask)
        assert len(own) == len(other) and {frozenset(v for t in own for v in t)} == {frozenset(v for t in other for v in t)}


def test_simplified_surfaces_keep_flat_sides_and_volume(spark):
    box = voxels(spark, [(x, y, z, 1) for x in range(16) for y in range(16) for z in range(16)])
    flat = iso.simplified(mesh.triangles(box), 6).collect()
    assert 0 < len(flat) < 3072 / 10 and abs(signed_volume(flat) / 6 - 4096) < 1  # quadrics keep the box's corners and edges
    tris = mesh.triangles(voxels(spark, ball(9)))
    before = tris.count()
    cells = iso.cells_for(tris, 10).first()
    kept = iso.simplified_by(tris, 10).collect()
    assert len(kept) == cells.triangles <= before // 10
    assert 0.75 < signed_volume(kept) / 6 / len(ball(9)) < 1.1
    assert iso.cells_for(tris, 100, error=2).first().cell == 2
    assert iso.simplified_by(tris.limit(0), 10).count() == 0


def test_loops_are_cut_at_their_longest_edges(spark):
    rng = random.Random(8)
    nodes = [(rng.randrange(12), rng.randrange(12), rng.randrange(3)) for _ in range(60)]
    links = {(label, *sorted(rng.sample(nodes, 2))) for label in (1, 2) for _ in range(90)}
    links = {e for e in links if e[1] != e[2]}
    root = {}

    def top(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n

    want = set()
    for label, a, b in sorted(links, key=lambda e: (sum((p - q) ** 2 for p, q in zip(e[1], e[2], strict=True)), e)):
        if top((label, a)) != top((label, b)):
            root[top((label, a))] = top((label, b))
            want.add((label, a, b))
    turned = [(label, b, a) for label, a, b in list(links)[:20]] + [(1, nodes[0], nodes[0])]
    frame = spark.createDataFrame([*links, *turned], "label long, a struct<x:long,y:long,z:long>, b struct<x:long,y:long,z:long>")
    assert {(r.label, tuple(r.a), tuple(r.b)) for r in skeleton.without_loops(frame).collect()} == want
    assert skeleton.without_loops(frame.limit(0)).count() == 0


def test_ranks_over_many_ranges(spark):
    from stratavox.operators.relabel import ranked

    rng = np.random.default_rng(6)
    keys = [int(k) for k in np.unique(rng.integers(-(1 << 62), 1 << 62, 5000))]
    df = spark.createDataFrame([(k, str(k)) for k in rng.permutation(keys).tolist()], "k long, t string").repartition(7)
    found = {r.k: (r.n, r.t) for r in ranked(df, "k", "n").collect()}
    assert found == {k: (i + 1, str(k)) for i, k in enumerate(keys)}
    assert ranked(df.limit(0), "k", "n").collect() == []


def test_files_of_skeletons_indexes_and_copies(spark, tmp_path):
    from stratavox.sources.volume import read_volume, transfer, write_index, write_swc, write_volume

    nodes = spark.createDataFrame([(1, 2, 5, 6, 7, 1.5, 1), (1, 1, 4, 6, 7, 2.0, -1), (9, 1, 0, 0, 0, 1.0, -1)], "label long, node long, x long, y long, z long, radius double, parent long")
    write_swc(skeleton.swc_lines(nodes), f"{tmp_path}/swc")
    read = lambda label: [line for f in sorted((tmp_path / f"swc/label={label}").glob("part-*")) for line in f.read_text().splitlines()]
    assert read(1) == ["1 0 4 6 7 2.0 -1", "2 0 5 6 7 1.5 1"] and read(9) == ["1 0 0 0 0 1.0 -1"]
    index = spark.createDataFrame([(1, 0, 5), (2, 3, 4)], "label long, x0 long, x1 long")
    write_index(index, path=f"{tmp_path}/index")
    write_index(index, path=f"{tmp_path}/index")  # takes the place of the first
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/index").collect())) == [(1, 0, 5), (2, 3, 4)]
    vol = voxels(spark, [(x, x + 1, 0, 3) for x in range(4)])
    write_volume(transfer(vol).withColumn("mip", F.lit(0)), f"{tmp_path}/copy")
    assert sorted(map(tuple, read_volume(spark, f"{tmp_path}/copy", 0).select(vol.columns).collect())) == sorted(map(tuple, vol.collect()))


def test_full_cells_have_a_row_of_no_background(spark):
    cube = [(x, y, z, 3 if z else None) for x in range(4) for y in range(4) for z in range(2)]
    vol = spark.createDataFrame(cube, "x long, y long, z long, label long")
    found = {tuple(r) for r in stats.cell_counts(vol, (4, 4, 2), (8, 4, 2)).collect()}
    assert found == {(0, 0, 0, 3, 16), (0, 0, 0, None, 16), (0, 0, 0, 0, 0), (1, 0, 0, 0, 32)}


def test_nearest_voxels_send_nothing_to_the_driver(spark):
    points = spark.createDataFrame([(1, 0, 0, 0, "a"), (1, 0, 0, 0, None), (1, 9, 0, 0, "a"), (2, 0, 0, 0, "a")], "label long, x long, y long, z long, kind string")
    vol = spark.createDataFrame([(1, 2, 0, 0), (1, 0, 2, 0), (1, 0, 0, 4), (3, 0, 0, 0)], "label long, x long, y long, z long")
    found = skeleton.nearest_voxels(points, vol, 3)
    assert sorted(map(str, found.collect())) == sorted(map(str, [Row(label=1, x=2, y=0, z=0, kind=k) for k in ("a", None)]))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()

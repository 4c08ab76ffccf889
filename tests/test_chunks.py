"""Operators on dense chunks against those on voxel rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import ccl, chunks, mesh, pool, stats
from stratavox.operators.pool import Method
from stratavox.sources.volume import to_chunks, to_voxels

SHAPE, CHUNK = (21, 13, 9), (8, 8, 4)


def voxels(spark, seed, labels=4, empty=0.3):
    rng = np.random.default_rng(seed)
    dense = rng.integers(1, labels + 1, SHAPE) * (rng.random(SHAPE) > empty)
    dense[8:16, :8, :4] = 0  # a whole chunk of background
    at = np.argwhere(dense)
    rows = [(*map(int, p), int(dense[tuple(p)])) for p in at]
    return spark.createDataFrame(rows, "x long, y long, z long, v long").cache()


def same(a, b):
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))


@pytest.mark.parametrize("method", [Method.AVERAGE, Method.MODE, Method.MIN, Method.MAX, Method.STRIDING])
@pytest.mark.parametrize("sparse", [False, True])
@pytest.mark.parametrize("factor", [(2, 2, 1), (2, 2, 2)])
def test_pyramid(spark, method, sparse, factor):
    vol = voxels(spark, 1, 5 if method == Method.MODE else 200, 0.1)
    layer = "segmentation" if method == Method.MODE else "image"
    found = chunks.chunk_pyramid(to_chunks(vol, CHUNK, "int64"), CHUNK, factor, 2, layer, method, sparse, SHAPE)
    told = pool.pyramid(vol.withColumnRenamed("v", "label") if method == Method.MODE else vol, factor, 2, layer, method, sparse, SHAPE)
    told = told.withColumnRenamed("label", "v").filter("v != 0")
    for mip in (1, 2):
        same(to_voxels(found.filter(F.col("mip") == mip), CHUNK), told.filter(F.col("mip") == mip).drop("mip"))


def test_many_voxels_to_a_window(spark):
    vol = voxels(spark, 2, 3)
    found = chunks.chunk_pyramid(to_chunks(vol, CHUNK, "uint16"), CHUNK, (4, 4, 2), 1, "segmentation", shape=SHAPE)
    same(to_voxels(found, CHUNK), pool.mode(vol.withColumnRenamed("v", "label"), (4, 4, 2), shape=SHAPE).withColumnRenamed("label", "v"))
    with pytest.raises(ValueError, match="multiples"):
        chunks.chunk_pyramid(found, (6, 8, 4), (4, 4, 2), 1)


def test_counts_boxes_and_surfaces(spark):
    vol = voxels(spark, 3)
    labels, dense = vol.withColumnRenamed("v", "label"), to_chunks(vol, CHUNK, "int64")
    same(chunks.chunk_counts(dense, CHUNK), stats.voxel_counts(labels))
    ends = [f(a).alias(f"{a}{k}") for a in "xyz" for k, f in ((0, F.min), (1, F.max))]
    same(chunks.chunk_boxes(dense, CHUNK), labels.groupBy("label").agg(*ends, F.count("*").alias("voxels")))
    same(chunks.chunk_surface(dense, CHUNK, (3, 5, 7)), mesh.surface(labels, (3, 5, 7)))
    same(chunks.chunk_faces(dense, CHUNK), mesh.exposed_faces(labels))
    same(chunks.chunk_triangles(dense, CHUNK, (3, 5, 7)), mesh.triangles(labels, (3, 5, 7)))


@pytest.mark.parametrize(("seed", "labels", "empty"), [(4, 1, 0.55), (5, 2, 0.1), (6, 1, 0.0)])
def test_components(spark, seed, labels, empty):
    vol = voxels(spark, seed, labels, empty)
    found = to_voxels(chunks.chunk_components(to_chunks(vol, CHUNK, "int64"), CHUNK, SHAPE), CHUNK)
    told = ccl.components(vol.withColumnRenamed("v", "label"), SHAPE, label="label")
    same(found.select("x", "y", "z", (F.col("v") - 1).alias("component")), told)


def test_nothing(spark):
    none = to_chunks(voxels(spark, 7).filter("v > 99"), CHUNK, "int64")
    for found in (chunks.chunk_counts(none, CHUNK), chunks.chunk_boxes(none, CHUNK), chunks.chunk_surface(none, CHUNK), chunks.chunk_faces(none, CHUNK), chunks.chunk_pyramid(none, CHUNK, (2, 2, 2), 2), chunks.chunk_components(none, CHUNK, SHAPE)):
        assert found.collect() == []


def test_background_chunks(spark):
    """A chunk that is there but holds background alone gives nothing."""
    zero = spark.createDataFrame([(0, 0, 0, "int64", bytearray(8 * 8 * 8 * 4))], "cx long, cy long, cz long, dtype string, data binary")
    for found in (chunks.chunk_counts(zero, CHUNK), chunks.chunk_boxes(zero, CHUNK), chunks.chunk_surface(zero, CHUNK), chunks.chunk_pyramid(zero, CHUNK, (2, 2, 2), 2), chunks.chunk_components(zero, CHUNK, SHAPE)):
        assert found.collect() == []


def test_only_sides_are_shuffled(spark):
    """What neighbours exchange are six planes a chunk, whatever lies inside."""
    dense = to_chunks(voxels(spark, 8), CHUNK, "int64")
    planes = chunks._over(dense, CHUNK, chunks.SIDES, chunks._sides(CHUNK)).collect()
    assert len(planes) <= 6 * dense.count() and max(len(r.labels) for r in planes) == 8 * 8 * 8


def test_levels_and_shards_in_one_exchange(spark, tmp_path):
    from stratavox.plans.scales import ShardSpec

    vol = voxels(spark, 11, 200)
    dense = to_chunks(vol, CHUNK, "uint8")
    path = str(tmp_path / "chunks")
    dense.write.parquet(path)
    back = spark.read.parquet(path)
    specs = {0: (ShardSpec(0, 1, 3), (3, 2, 3)), 1: (ShardSpec(0, 1, 2), (2, 1, 3)), 2: (ShardSpec(0, 0, 2), (1, 1, 3))}
    found = chunks.sharded_pyramid(back, CHUNK, (2, 2, 1), 2, specs, keep=True, shape=SHAPE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    chunks.write_sharded(found, str(tmp_path / "shards"))
    written = spark.read.parquet(str(tmp_path / "shards"))
    for mip in (1, 2):
        same(to_voxels(written.filter(F.col("mip") == mip), CHUNK), pool.pyramid(vol, (2, 2, 1), 2, shape=SHAPE).filter(f"mip = {mip} and v > 0").drop("mip"))
    same(to_voxels(written.filter("mip = 0"), CHUNK), vol)
    for _, own in written.toPandas().groupby(["mip", "shard"]):
        order = list(zip(own["minishard"], own["code"], strict=True))
        assert order == sorted(order)


def test_moved_blocks(spark):
    from stratavox.plans.scales import ShardSpec
    from stratavox.sources.volume import transfer

    vol, box, shift = voxels(spark, 12), ((2, 1, 0), (20, 12, 8)), (5, 3, 2)
    found = chunks.sharded_transfer(to_chunks(vol, CHUNK, "uint16"), CHUNK, (5, 7, 3), box, ShardSpec(1, 1, 5), (5, 3, 4), shift)
    same(to_voxels(found, (5, 7, 3)), transfer(vol, box, shift))

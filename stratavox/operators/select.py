"""Projections, filters and element-wise operators over voxel tables (x, y, z and value or label columns)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Box = tuple[tuple[int, int, int], tuple[int, int, int]]
AXES = ("x", "y", "z")


def inside(box: Box) -> Column:
    """Whether a voxel lies in a half-open box."""
    out = F.lit(True)
    for axis, low, high in zip(AXES, *box, strict=True):
        out &= (F.col(axis) >= low) & (F.col(axis) < high)
    return out


def cell(size: tuple[int, int, int], prefix: str = "c") -> dict[str, Column]:
    """Columns with the grid cell of a voxel."""
    return {f"{prefix}{axis}": F.floor(F.col(axis) / s).cast("bigint") for axis, s in zip(AXES, size, strict=True)}


def positions(spark, box: Box) -> DataFrame:
    """Every voxel position of a box, made on the executors."""
    (x0, y0, z0), (x1, y1, z1) = box
    nx, ny, nz = x1 - x0, y1 - y0, z1 - z0
    i = F.col("id")
    return spark.range(nx * ny * nz).select((i % nx + x0).alias("x"), (F.floor(i / nx) % ny + y0).cast("bigint").alias("y"), (F.floor(i / (nx * ny)) + z0).cast("bigint").alias("z"))


def snap(box: Box, chunk: tuple[int, int, int], bounds: Box) -> Box:
    """A box grown outward to whole chunks, counted from the bounds' corner, and clamped to the bounds."""
    low, high = [], []
    for a, b, c, lo, hi in zip(*box, chunk, *bounds, strict=True):
        low.append(max(lo, lo + (a - lo) // c * c))
        high.append(min(hi, lo - -(b - lo) // c * c))
    return tuple(low), tuple(high)


def to_mip(box: Box, factor: tuple[int, int, int], mips: int) -> Box:
    """A box at a coarser level: its corner rounded down, its far corner up."""
    scale = [f**mips for f in factor]
    return tuple(a // s for a, s in zip(box[0], scale, strict=True)), tuple(-(-b // s) for b, s in zip(box[1], scale, strict=True))


def cutout(vol: DataFrame, box: Box) -> DataFrame:
    return vol.filter(inside(box))


def threshold(vol: DataFrame, gte: float | None = None, lte: float | None = None, value: str = "v") -> DataFrame:
    """Without bounds the volume itself; else a boolean column of that name in the value's place."""
    if gte is None and lte is None:
        return vol
    test = F.lit(True)
    if gte is not None:
        test &= F.col(value) >= gte
    if lte is not None:
        test &= F.col(value) <= lte
    return vol.withColumn(value, test)


def quantize(chunks: DataFrame, data: str = "data") -> DataFrame:
    """Values of 0 to 1 as truncated bytes, chunk by chunk."""
    return chunks.withColumn(data, F.transform(data, lambda v: F.floor(v * 255).cast("int")))


def blackout(vol: DataFrame, box: Box, value: int = 0, column: str = "v") -> DataFrame:
    """Every voxel of the box gets the value, those that the sparse table lacks too; the value 0 leaves none."""
    rest = vol.filter(~inside(box)).select(*AXES, column)
    return rest if value == 0 else rest.unionByName(positions(vol.sparkSession, box).withColumn(column, F.lit(value).cast("bigint")))


def missing_chunks(vol: DataFrame, shape: tuple[int, int, int], chunk: tuple[int, int, int]) -> DataFrame:
    """Chunks of the grid over the shape that hold no voxel; a strict read raises if there are any."""
    grid = tuple(-(-s // c) for s, c in zip(shape, chunk, strict=True))
    every = positions(vol.sparkSession, ((0, 0, 0), grid)).select(*[F.col(a).alias(f"c{a}") for a in AXES])
    return every.join(vol.select(*[c.alias(n) for n, c in cell(chunk).items()]).distinct(), ["cx", "cy", "cz"], "left_anti")


def touch(vol: DataFrame, shape: tuple[int, int, int], chunk: tuple[int, int, int], fill_missing: bool = False) -> DataFrame:
    """Voxels counted by chunk, as a check that all can be read; absent chunks raise unless they may be filled."""
    counts = vol.groupBy(*[c.alias(n) for n, c in cell(chunk).items()]).agg(F.count("*").alias("voxels"))
    missing = missing_chunks(vol, shape, chunk).withColumn("voxels", F.lit(0).cast("bigint"))
    if not fill_missing:
        missing = missing.withColumn("voxels", F.raise_error(F.concat(F.lit("chunk is missing: "), F.concat_ws(",", "cx", "cy", "cz"))).cast("bigint"))
    return counts.unionByName(missing)


def delete(chunks: DataFrame, box: Box, factor: tuple[int, int, int], chunk: tuple[int, int, int], bounds: Box, mips: int) -> DataFrame:
    """Chunks (mip, cx, cy, cz, ...) without those of the box at mips 0 to mips, the box being rounded out to chunks at each."""
    gone = F.lit(False)
    for mip in range(mips + 1):
        own = snap(to_mip(box, factor, mip), chunk, to_mip(bounds, factor, mip))
        if any(a >= b for a, b in zip(*own, strict=True)):
            continue
        at = F.col("mip") == mip
        for axis, low, high, size in zip(AXES, *own, chunk, strict=True):
            at &= F.col(f"c{axis}").between(low // size, -(-high // size) - 1)
        gone |= at
    return chunks.filter(~gone)


def translate(vol: DataFrame, by: tuple[int, int, int]) -> DataFrame:
    return vol.withColumns({a: F.col(a) + d for a, d in zip(AXES, by, strict=True)})


def rechunk(vol: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """The voxel table with the keys of another chunking."""
    return vol.withColumns(cell(chunk))


def mask_except(vol: DataFrame, ids: DataFrame) -> DataFrame:
    """Only voxels of the listed labels."""
    return vol.join(ids.select("label"), "label", "left_semi")


def mask(vol: DataFrame, ids: DataFrame) -> DataFrame:
    """Voxels of all labels but the listed ones."""
    return vol.join(ids.select("label"), "label", "left_anti")


def local_dust(vol: DataFrame, least: int, size: tuple[int, int, int]) -> DataFrame:
    """Voxels whose label has at least so many voxels within their grid cell."""
    keyed = vol.withColumns(cell(size))
    keep = keyed.groupBy("cx", "cy", "cz", "label").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least)
    return keyed.join(keep, ["cx", "cy", "cz", "label"], "left_semi").drop("cx", "cy", "cz")


def global_dust(vol: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """Voxels of labels other than 0 that have at least so many voxels in all, by a table of counts (label, voxels)."""
    return vol.join(counts.filter((F.col("voxels") >= least) & (F.col("label") != 0)), "label", "left_semi")


def reorder(vol: DataFrame, mapping: Mapping[int, int], depth: int) -> DataFrame:
    """Slices moved by a sparse mapping of z; one that would lose a slice or leave the range is an error."""
    target = [mapping.get(z, z) for z in range(depth)]
    if sorted(target) != list(range(depth)):
        raise ValueError("the mapping loses a slice or leaves the volume")
    moved = F.create_map(*[F.lit(x) for z, to in mapping.items() for x in (z, to)]) if mapping else None
    return vol if moved is None else vol.withColumn("z", F.coalesce(moved[F.col("z").cast("int")].cast("bigint"), F.col("z")))


def consensus(vol: DataFrame, agreed: DataFrame, volume_id: int) -> DataFrame:
    """Agreed ids (old, new) where there are any, else the label with the volume's id in the bits from 16 up; 0 stays 0."""
    own = F.col("label").bitwiseOR(F.lit(volume_id << 16))
    joined = vol.join(agreed.withColumnsRenamed({"old": "label", "new": "_agreed"}), "label", "left")
    return joined.withColumn("label", F.when(F.col("label") == 0, 0).otherwise(F.coalesce("_agreed", own)).cast("bigint")).drop("_agreed")


def affinity_mask(vol: DataFrame, coarse: DataFrame, levels: int, value: str = "v") -> DataFrame:
    """Values times a mask (x, y, z, m) that is `levels` halvings coarser in x and y; no mask voxel means 0."""
    factor = 1 << levels
    at = coarse.select(F.col("x").alias("_x"), F.col("y").alias("_y"), "z", "m")
    keyed = vol.withColumns({"_x": F.floor(F.col("x") / factor).cast("bigint"), "_y": F.floor(F.col("y") / factor).cast("bigint")})
    return keyed.join(at, ["_x", "_y", "z"]).withColumn(value, F.col(value) * F.col("m")).filter(F.col(value) != 0).drop("_x", "_y", "m")


def non_face_rails(vol: DataFrame, size: tuple[int, int, int]) -> DataFrame:
    """Voxels but those on two or more of a cell's overlap planes, so that only faces join neighbouring cells."""
    planes = sum(((F.col(a) % s == 0) & (F.col(a) > 0)).cast("int") for a, s in zip(AXES, size, strict=True))
    return vol.filter(planes < 2)


def close_edges(vol: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """The volume with a plane of label 0 beside each voxel on a side of the dataset."""
    outer = []
    for axis, s in zip(AXES, shape, strict=True):
        for side, to in ((0, -1), (s - 1, s)):
            outer.append(vol.filter(F.col(axis) == side).withColumns({axis: F.lit(to).cast("bigint"), "label": F.lit(0).cast("bigint")}))
    for part in outer:
        vol = vol.unionByName(part)
    return vol


def dilate(vol: DataFrame, column: str = "label") -> DataFrame:
    """A 3 x 3 x 3 dilation of labels: a free voxel takes the smallest label around it; labelled ones keep theirs.

    Each voxel is sent to its 27 places once, and the places are grouped: one shuffle, with partial aggregation.
    """
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    spread = vol.select(*AXES, column, F.explode(steps).alias("s"))
    own = F.when((F.col("s.i") == 0) & (F.col("s.j") == 0) & (F.col("s.k") == 0), F.col(column))
    placed = spread.select((F.col("x") + F.col("s.i")).alias("x"), (F.col("y") + F.col("s.j")).alias("y"), (F.col("z") + F.col("s.k")).alias("z"), F.col(column), own.alias("_own"))
    return placed.groupBy(*AXES).agg(F.coalesce(F.max("_own"), F.min(column)).alias(column))

"""Downsampling: grouped aggregation of voxel windows, one level at a time, on sparse tables where 0 is absent."""

from __future__ import annotations

from enum import IntEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.operators.select import AXES

Factor = tuple[int, int, int]
AXIS_FACTOR = {"x": (1, 2, 2), "y": (2, 1, 2), "z": (2, 2, 1)}


class Method(IntEnum):
    AUTO = 1
    AVERAGE = 2
    MODE = 3
    MIN = 4
    MAX = 5
    STRIDING = 6


def method_for(layer: str, method: Method = Method.AUTO) -> Method:
    """AUTO means averages for images, modes for segmentations and striding for the rest."""
    if method != Method.AUTO:
        return method
    return {"image": Method.AVERAGE, "segmentation": Method.MODE}.get(layer, Method.STRIDING)


def window(factor: Factor) -> list[Column]:
    return [F.floor(F.col(a) / f).cast("bigint").alias(a) for a, f in zip(AXES, factor, strict=True)]


def _full(factor: Factor, shape: Factor | None) -> Column:
    """Voxels of a window; those at the far edge of the shape are smaller."""
    out = F.lit(1)
    for i, a in enumerate(AXES):
        side = F.lit(factor[i])
        if shape is not None:
            side = F.least(side, F.lit(shape[i]) - F.col(a) * factor[i])
        out = out * side
    return out.cast("bigint")


def average(vol: DataFrame, factor: Factor, value: str = "v", sparse: bool = False, shape: Factor | None = None) -> DataFrame:
    """The floor of a window's mean; sparse means over its nonzero voxels. Sums of several levels equal one of the product."""
    sums = vol.groupBy(*window(factor)).agg(F.sum(value).alias("_s"), F.count(F.when(F.col(value) != 0, 1)).alias("_n"))
    divisor = F.col("_n") if sparse else _full(factor, shape)
    return sums.filter("_n > 0").select(*AXES, F.floor(F.col("_s") / divisor).cast("bigint").alias(value))


def mode(vol: DataFrame, factor: Factor, label: str = "label", sparse: bool = False, shape: Factor | None = None) -> DataFrame:
    """A window's most frequent label, of ties the smallest; sparse leaves 0 out. Two partial aggregations, no sort."""
    counts = vol.filter(F.col(label) != 0).groupBy(*window(factor), label).agg(F.count("*").alias("_n"))
    best = counts.groupBy(*AXES).agg(F.max(F.struct(F.col("_n"), (-F.col(label)).alias("_l"))).alias("_b"), F.sum("_n").alias("_all"))
    picked = best.select(*AXES, (-F.col("_b._l")).alias(label), F.col("_b._n").alias("_n"), "_all")
    if not sparse:
        picked = picked.filter(_full(factor, shape) - F.col("_all") < F.col("_n"))
    return picked.select(*AXES, label)


def least(vol: DataFrame, factor: Factor, value: str = "v", shape: Factor | None = None) -> DataFrame:
    pooled = vol.filter(F.col(value) != 0).groupBy(*window(factor)).agg(F.min(value).alias(value), F.count("*").alias("_n"))
    return pooled.filter(F.col("_n") == _full(factor, shape)).select(*AXES, value)


def most(vol: DataFrame, factor: Factor, value: str = "v") -> DataFrame:
    return vol.groupBy(*window(factor)).agg(F.max(value).alias(value))


def stride(vol: DataFrame, factor: Factor, value: str = "v") -> DataFrame:
    """The first voxel of each window; no shuffle."""
    first = F.lit(True)
    for a, f in zip(AXES, factor, strict=True):
        first &= F.col(a) % f == 0
    return vol.filter(first).select(*window(factor), value)


def pyramid(vol: DataFrame, factor: Factor, levels: int, layer: str = "image", method: Method = Method.AUTO, sparse: bool = False, shape: Factor | None = None) -> DataFrame:
    """Levels 1 to `levels` with their mip, each from the level below; averages carry sums and counts upward, not rounded means."""
    kind, column = method_for(layer, method), "label" if layer == "segmentation" else "v"
    out, below, sizes = None, vol, shape
    for mip in range(1, levels + 1):
        whole = tuple(f**mip for f in factor)
        if kind == Method.AVERAGE:
            own = (F.sum(column), F.count(F.when(F.col(column) != 0, 1))) if mip == 1 else (F.sum("_s"), F.sum("_n"))
            sums = below.groupBy(*window(factor)).agg(own[0].alias("_s"), own[1].alias("_n"))
            divisor = F.col("_n") if sparse else _full(whole, shape)
            level = sums.filter("_n > 0").select(*AXES, F.floor(F.col("_s") / divisor).cast("bigint").alias(column))
        elif kind == Method.MODE:
            level = mode(below, factor, column, sparse, sizes)
        elif kind == Method.MIN:
            level = least(vol, whole, column, shape)
        else:
            level = most(below, factor, column) if kind == Method.MAX else stride(below, factor, column)
        below = sums if kind == Method.AVERAGE else level
        sizes = tuple(-(-s // f) for s, f in zip(sizes, factor, strict=True)) if sizes else None
        level = level.withColumn("mip", F.lit(mip).cast("bigint"))
        out = level if out is None else out.unionByName(level)
    return out


def fix_up(vol: DataFrame, points: DataFrame, size: Factor, factor: Factor, **options) -> DataFrame:
    """The averages of those task cells only that hold one of the points (x, y, z)."""
    cells = points.select(*[F.floor(F.col(a) / s).alias(f"_{a}") for a, s in zip(AXES, size, strict=True)]).distinct()
    keyed = vol.withColumns({f"_{a}": F.floor(F.col(a) / s) for a, s in zip(AXES, size, strict=True)})
    return average(keyed.join(cells, ["_x", "_y", "_z"], "left_semi"), factor, **options)


def countless(vol: DataFrame, label: str = "label") -> DataFrame:
    """The 2 x 2 x 1 pick by matching pairs: a label that two of the four share, else the last of them; 0 is a label too."""
    slot = (F.col("x") % 2 + 2 * (F.col("y") % 2)).cast("int")
    four = vol.groupBy(*window((2, 2, 1))).agg(*[F.coalesce(F.max(F.when(slot == i, F.col(label))), F.lit(0)).alias(f"_{i}") for i in range(4)])
    a, b, c, d = (F.col(f"_{i}") for i in range(4))
    pick = F.when((a == b) | (a == c), a).when(b == c, b).otherwise(d)
    return four.select(*AXES, pick.alias(label)).filter(F.col(label) != 0)


def transferred(vol: DataFrame, factor: Factor, levels: int, box=None, shift: Factor = (0, 0, 0), skip_first: bool = False, skip_downsamples: bool = False, **options) -> DataFrame:
    """A copy cut out and moved (see transfer) with its pyramid in one go: level 0 unless skip_first, and levels 1 to `levels`."""
    from stratavox.sources.volume import transfer

    level = transfer(vol, box, shift)
    column = "label" if options.get("layer") == "segmentation" else "v"
    first = level.select(*AXES, column, F.lit(0).cast("bigint").alias("mip"))
    if skip_downsamples:
        return first
    above = pyramid(level, factor, levels, **options)
    return above if skip_first else first.unionByName(above)

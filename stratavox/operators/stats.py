"""Counts, histograms, clip bounds, contrast and boxes of voxel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.operators.select import AXES, cell

Size = tuple[int, int, int]


def voxel_counts(vol: DataFrame, by: str = "label") -> DataFrame:
    """Voxels of each label: partial sums meet in one shuffle of as many rows as there are labels in a task."""
    return vol.groupBy(by).agg(F.count("*").alias("voxels"))


def cell_counts(vol: DataFrame, size: Size, shape: Size) -> DataFrame:
    """Voxels of each label in each grid cell, label 0 being what a cell's volume has left, 0 in a full cell; every cell has that row."""
    counts = vol.filter(~F.col("label").eqNullSafe(0)).groupBy(*[c.alias(n) for n, c in cell(size).items()], "label").agg(F.count("*").alias("voxels"))
    grid = tuple(-(-s // c) for s, c in zip(shape, size, strict=True))
    cells = vol.sparkSession.range(grid[0] * grid[1] * grid[2])
    i = F.col("id")
    at = {"cx": i % grid[0], "cy": F.floor(i / grid[0]) % grid[1], "cz": F.floor(i / (grid[0] * grid[1]))}
    room = F.lit(1)
    for k, name in enumerate(at):
        room = room * F.least(F.lit(size[k]), F.lit(shape[k]) - F.col(name) * size[k])
    cells = cells.select(*[c.cast("bigint").alias(n) for n, c in at.items()]).withColumn("_room", room.cast("bigint"))
    used = counts.groupBy("cx", "cy", "cz").agg(F.sum("voxels").alias("_used"))
    empty = cells.join(used, ["cx", "cy", "cz"], "left").select("cx", "cy", "cz", F.lit(0).cast("bigint").alias("label"), (F.col("_room") - F.coalesce("_used", F.lit(0))).alias("voxels"))
    return counts.unionByName(empty)


def sum_counts(partial: DataFrame) -> DataFrame:
    """Voxels of each label from counts by cell."""
    return partial.groupBy("label").agg(F.sum("voxels").alias("voxels"))


def histogram(vol: DataFrame, area: int | None = None) -> DataFrame:
    """Voxels of each value in each slice; with the area of a slice, absent voxels count as value 0."""
    counts = vol.groupBy("z", "v").agg(F.count("*").alias("n"))
    if area is None:
        return counts
    rest = counts.groupBy("z").agg((F.lit(area) - F.sum(F.when(F.col("v") != 0, F.col("n")).otherwise(0))).cast("bigint").alias("n"))
    return counts.filter("v != 0").unionByName(rest.select("z", F.lit(0).cast("bigint").alias("v"), "n"))


def sampled_histogram(vol: DataFrame, patch: int, coverage: float, shape: tuple[int, int], seed: int = 0) -> DataFrame:
    """A histogram over patches picked by a hash in each slice until they cover the share asked for: reruns agree."""
    nx, ny = (-(-s // patch) for s in shape)
    grid = vol.sparkSession.range(nx * ny).select((F.col("id") % nx).alias("_px"), F.floor(F.col("id") / nx).alias("_py"))
    slices = vol.select("z").distinct()
    rank = F.row_number().over(Window.partitionBy("z").orderBy(F.xxhash64("z", "_px", "_py", F.lit(seed)), "_px", "_py"))
    picked = slices.join(F.broadcast(grid)).withColumn("_r", rank).filter(F.col("_r") <= max(1, -(-int(nx * ny * coverage * 1e6) // 1_000_000)))
    keyed = vol.withColumns({"_px": F.floor(F.col("x") / patch), "_py": F.floor(F.col("y") / patch)})
    return histogram(keyed.join(picked.select("z", "_px", "_py"), ["z", "_px", "_py"], "left_semi"))


def levels_file(counts: DataFrame, bins: int = 256) -> DataFrame:
    """A dense array of `bins` counts for each slice."""
    pairs = F.map_from_entries(F.collect_list(F.struct(F.col("v").cast("int"), "n")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.col("_m")[i], F.lit(0).cast("bigint")))
    return counts.groupBy("z").agg(pairs.alias("_m")).select("z", dense.alias("levels"))


def clip_bounds(counts: DataFrame, lower: float, upper: float, bins: int = 256) -> DataFrame:
    """lower and upper of each slice: the last bin whose share of all counts, bin 0 left out, is at most the fraction.

    A bin that is absent shares the running total of the one below it, so each bin stands for all up to the next.
    """
    zero = counts.select("z").distinct().withColumns({"v": F.lit(0).cast("bigint"), "n": F.lit(0).cast("bigint")})
    w = Window.partitionBy("z").orderBy("v")
    run = counts.filter("v != 0").unionByName(zero).withColumns({"_sum": F.sum("n").over(w), "_to": F.coalesce(F.lead("v").over(w) - 1, F.lit(bins - 1).cast("bigint")), "_all": F.sum("n").over(Window.partitionBy("z"))})
    bound = lambda f: F.coalesce(F.max(F.when(F.col("_sum") <= F.col("_all") * f, F.col("_to"))), F.lit(0))
    empty = F.max("_all") == 0
    return run.groupBy("z").agg(F.when(empty, 0).otherwise(bound(lower)).cast("bigint").alias("lower"), F.when(empty, 0).otherwise(bound(upper)).cast("bigint").alias("upper"))


def contrast_stretch(vol: DataFrame, bounds: DataFrame, maxval: int = 255, minval: int = 0) -> DataFrame:
    """Values stretched from each slice's bounds to the whole range, rounded half to even and clipped."""
    scaled = F.bround((F.col("v") - F.col("lower")).cast("double") * (F.lit(float(maxval)) / (F.col("upper") - F.col("lower"))))
    clipped = F.greatest(F.lit(float(minval)), F.least(F.lit(float(maxval)), scaled)).cast("bigint")
    return vol.join(F.broadcast(bounds), "z").withColumn("v", F.when(F.col("lower") == F.col("upper"), F.col("v")).otherwise(clipped)).drop("lower", "upper")


def tile_luts(vol: DataFrame, tile: int, clip: float, bins: int = 256) -> DataFrame:
    """The clipped histogram's lookup (z, tx, ty, v, to) of each tile: counts above the limit are dealt out evenly."""
    keyed = vol.select("z", F.floor(F.col("x") / tile).cast("bigint").alias("tx"), F.floor(F.col("y") / tile).cast("bigint").alias("ty"), "v")
    counts = keyed.groupBy("z", "tx", "ty", "v").agg(F.count("*").alias("n"))
    own = Window.partitionBy("z", "tx", "ty")
    total = F.sum("n").over(own)
    limit = F.greatest(F.lit(1), F.floor(F.lit(clip) * F.col("_all") / bins))
    capped = counts.withColumn("_all", total).withColumn("_limit", limit).withColumn("_over", F.sum(F.greatest(F.lit(0), F.col("n") - F.col("_limit"))).over(own))
    upto = F.sum(F.least("n", "_limit")).over(own.orderBy("v")) + F.floor(F.col("_over") * (F.col("v") + 1) / bins)
    return capped.select("z", "tx", "ty", "v", F.floor(upto * (bins - 1) / F.col("_all")).cast("bigint").alias("to"))


def clahe(vol: DataFrame, tile: int, clip: float, bins: int = 256) -> DataFrame:
    """Contrast-limited equalisation: each voxel blends the lookups of the four tiles around it by distance.

    Where a neighbouring tile lacks the value, the lookup of the nearest lower value there counts, or 0.
    """
    luts = tile_luts(vol, tile, clip, bins)
    own = Window.partitionBy("z", "tx", "ty").orderBy("v")
    spans = luts.withColumn("_end", F.coalesce(F.lead("v").over(own), F.lit(bins).cast("bigint")))
    dense = spans.select("z", "tx", "ty", F.explode(F.sequence(F.col("v"), F.col("_end") - 1)).alias("v"), "to")
    at = {a: (F.col(a) + 0.5) / tile - 0.5 for a in ("x", "y")}
    corners = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    four = vol.withColumn("_c", F.explode(corners))
    low = {a: F.floor(at[a]) for a in at}
    part = {a: F.when(F.col(f"_c.{n}") == 1, at[a] - low[a]).otherwise(1 - (at[a] - low[a])) for a, n in (("x", "i"), ("y", "j"))}
    last = vol.agg(*[F.max(F.floor(F.col(a) / tile)).alias(f"_m{a}") for a in ("x", "y")])
    keyed = four.join(F.broadcast(last)).withColumns({f"t{a}": F.least(F.greatest(low[a] + F.col(f"_c.{n}"), F.lit(0)), F.col(f"_m{a}")).cast("bigint") for a, n in (("x", "i"), ("y", "j"))})
    mixed = keyed.withColumn("_w", part["x"] * part["y"]).join(dense, ["z", "tx", "ty", "v"], "left")
    return mixed.groupBy(*AXES).agg(F.round(F.sum(F.col("_w") * F.coalesce("to", F.lit(0)))).cast("bigint").alias("v"))


def boxes(vol: DataFrame, resolution: Size = (1, 1, 1), by: tuple[str, ...] = ("label",)) -> DataFrame:
    """The box of each label in physical units, its far corner outside."""
    ends = [x for i, a in enumerate(AXES) for x in ((F.min(a) * resolution[i]).alias(f"{a}0"), ((F.max(a) + 1) * resolution[i]).alias(f"{a}1"))]
    return vol.groupBy(*by).agg(*ends)


def max_label(vol: DataFrame) -> DataFrame:
    return vol.agg(F.max("label").alias("max_label"))


def labels(vol: DataFrame) -> DataFrame:
    return vol.select("label").distinct()


def bounds(vol: DataFrame) -> DataFrame:
    """The box of all voxels."""
    return vol.agg(*[f.alias(n) for a in AXES for f, n in ((F.min(a), f"{a}0"), (F.max(a) + 1, f"{a}1"))])

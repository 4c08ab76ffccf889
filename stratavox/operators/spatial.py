"""Spatial index, box and range joins, octree parents, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.functions.codes import box_name
from stratavox.operators.select import AXES, Box, cell
from stratavox.operators.stats import boxes

Size = tuple[int, int, int]


def spatial_index(vol: DataFrame, size: Size, resolution: Size = (1, 1, 1)) -> DataFrame:
    """The box of each label in each grid cell, a cell reaching one voxel into the next ones.

    Only voxels on a cell's low sides are sent to further cells; a voxel goes to eight at most.
    """
    low = [F.when((F.col(a) % s == 0) & (F.col(a) > 0), F.array(F.lit(0), F.lit(-1))).otherwise(F.array(F.lit(0))) for a, s in zip(AXES, size, strict=True)]
    sent = vol.withColumn("_i", F.explode(low[0])).withColumn("_j", F.explode(low[1])).withColumn("_k", F.explode(low[2]))
    own = cell(size)
    keyed = sent.withColumns({"cx": own["cx"] + F.col("_i"), "cy": own["cy"] + F.col("_j"), "cz": own["cz"] + F.col("_k")})
    return boxes(keyed, resolution, ("cx", "cy", "cz", "label"))


def index_json(index: DataFrame) -> DataFrame:
    """One JSON object of boxes by label for each cell."""
    ends = F.array("x0", "y0", "z0", "x1", "y1", "z1")
    return index.groupBy("cx", "cy", "cz").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("label").cast("string"), ends))))).alias("index"))


def query_box(index: DataFrame, box: Box, size: Size, resolution: Size = (1, 1, 1)) -> DataFrame:
    """Labels whose boxes meet a physical box. The cells that it can touch are read first, then boxes are compared."""
    test = F.lit(True)
    for a, low, high, s, r in zip(AXES, *box, size, resolution, strict=True):
        test &= F.col(f"c{a}").between(low // (s * r) - 1, high // (s * r))
        test &= (F.col(f"{a}0") < high) & (F.col(f"{a}1") > low)
    return index.filter(test).select("label").distinct()


def label_cells(index: DataFrame, labels: DataFrame) -> DataFrame:
    """The cells that hold each of the labels, in the order of their names."""
    name = F.concat_ws("_", "cx", "cy", "cz")
    return index.join(labels.select("label"), "label", "left_semi").groupBy("label").agg(F.sort_array(F.collect_set(name)).alias("cells"))


def points_in_boxes(points: DataFrame, regions: DataFrame, size: Size) -> DataFrame:
    """Points within half-open boxes (box, x0 to z1): both go to grid cells, meet there, and are then compared."""
    spread = regions
    for a, s in zip(AXES, size, strict=True):
        spread = spread.withColumn(f"c{a}", F.explode(F.sequence(F.floor(F.col(f"{a}0") / s), F.floor((F.col(f"{a}1") - 1) / s))))
    joined = points.withColumns(cell(size)).join(spread, ["cx", "cy", "cz"])
    for a in AXES:
        joined = joined.filter((F.col(a) >= F.col(f"{a}0")) & (F.col(a) < F.col(f"{a}1")))
    return joined.select(*points.columns, "box")


def points_near(points: DataFrame, centers: DataFrame, radius: int) -> DataFrame:
    """Pairs of a centre (center, x, y, z) and a point at most radius away, met by cells as wide as the radius."""
    around = F.sequence(F.lit(-1), F.lit(1))
    keyed = points.withColumns(cell((radius,) * 3))
    spread = centers.select("center", *[F.col(a).alias(f"_{a}") for a in AXES])
    for a in AXES:
        spread = spread.withColumn("_d", F.explode(around)).withColumn(f"c{a}", (F.floor(F.col(f"_{a}") / radius) + F.col("_d")).cast("bigint"))
    far = sum((F.col(a) - F.col(f"_{a}")) * (F.col(a) - F.col(f"_{a}")) for a in AXES)
    return keyed.join(spread.drop("_d"), ["cx", "cy", "cz"]).filter(far <= radius * radius).select("center", *points.columns)


def fragments(vol: DataFrame, size: Size, lod: int = 0) -> DataFrame:
    """label and name (label:lod:box) of each label's part in each grid cell."""
    own = cell(size)
    at = vol.select("label", *[c.alias(n) for n, c in own.items()]).distinct()
    ends = {f"{a}{i}": (F.col(f"c{a}") + i) * s for a, s in zip(AXES, size, strict=True) for i in (0, 1)}
    return at.withColumns(ends).select("label", F.concat_ws(":", F.col("label").cast("string"), F.lit(str(lod)), box_name()).alias("name"))


def manifests(names: DataFrame) -> DataFrame:
    """The manifest of each label: its fragments' names, in order, as JSON."""
    listed = F.sort_array(F.collect_list("name"))
    return names.groupBy("label").agg(F.to_json(F.struct(listed.alias("fragments"))).alias("manifest"))


def with_prefix(names: DataFrame, prefix: str) -> DataFrame:
    """Names that start with a prefix, for partial deletes and transfers."""
    return names.filter(F.col("name").startswith(prefix))


def parents(nodes: DataFrame, tree: DataFrame, levels: int) -> DataFrame:
    """node and the ancestor that tree (child, parent, layer) gives it after so many layers."""
    out = nodes.withColumn("ancestor", F.col("node"))
    for layer in range(1, levels + 1):
        step = tree.filter(F.col("layer") == layer).select(F.col("child").alias("ancestor"), "parent")
        out = out.join(step, "ancestor").select("node", F.col("parent").alias("ancestor"))
    return out


def common_layer(points: DataFrame, fan_out: int, layers: int) -> DataFrame:
    """The lowest octree layer whose chunk holds the cells of both ends (c*, d*) of each row; null beyond the top."""
    same = None
    for layer in range(layers - 1, -1, -1):
        size = fan_out**layer
        meet = F.lit(True)
        for a in AXES:
            meet &= F.floor(F.col(f"c{a}") / size) == F.floor(F.col(f"d{a}") / size)
        same = F.when(meet, layer) if same is None else F.when(meet, layer).otherwise(same)
    return points.withColumn("layer", same.cast("bigint"))


def cells_of_labels(index: DataFrame, labels: DataFrame) -> DataFrame:
    """Grid cells that hold any of the labels: what a task over few labels has to read."""
    return index.join(labels.select("label"), "label", "left_semi").select("cx", "cy", "cz").distinct()

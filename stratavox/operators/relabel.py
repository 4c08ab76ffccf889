"""Label remapping by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.sources.shared import materialise


def remap_keep(vol: DataFrame, table: DataFrame) -> DataFrame:
    """Labels by the table (old, new); those that it lacks stay."""
    joined = vol.join(table.withColumnRenamed("old", "label"), "label", "left")
    return joined.withColumn("label", F.coalesce("new", "label")).drop("new")


def remap_only(vol: DataFrame, table: DataFrame) -> DataFrame:
    """Labels by the table (old, new); voxels of those that it lacks become background, and so leave a sparse table."""
    return vol.join(table.withColumnRenamed("old", "label"), "label").withColumn("label", F.col("new")).drop("new").filter("label != 0")


def remap_array(vol: DataFrame, values: DataFrame) -> DataFrame:
    """Labels as indices into a dense table (position, value); an index outside it is an error."""
    joined = vol.join(values.withColumnRenamed("position", "label"), "label", "left")
    bad = F.raise_error(F.concat(F.lit("label outside the array: "), F.col("label"))).cast("bigint")
    return joined.withColumn("label", F.coalesce("value", bad)).drop("value")


def renumber(vol: DataFrame) -> DataFrame:
    """label and number, counting the labels other than 0 from 1 in their order.

    Ranks come from counts of ranges of labels, so no task sorts all labels.
    """
    distinct = vol.select("label").filter("label != 0").distinct()
    return ranked(distinct, "label", "number")


def ranked(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with the rank of a distinct key, from 1.

    Rows are dealt out by ranges of the key and numbered within each; a range's ranks begin after the counts of those before
    it. Ranges are the session's shuffle partitions, so their number grows with what the session is set up for, and the
    counts that are broadcast are a row for each.
    """
    spread = rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(spread, "ranked")
    part = F.shiftright("_at", 33)  # an id is its partition's number and, in 33 bits, the row's within it
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_first"))
    own = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(first), "_part").withColumn(name, (F.col("_first") + own + 1).cast("bigint"))
    return numbered.select(*rows.columns, name)

"""Incremental volumes: chunks that arrive as files, counted and written as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_chunks(spark: SparkSession, path: str, schema: str, files: int = 64) -> DataFrame:
    """Voxel or chunk tables as they arrive in a folder, so many files in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def ingest(chunks: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write arriving voxels by mip. A batch that is tried again overwrites what it wrote before, so nothing doubles."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("mip", "batch").parquet(path)

    return chunks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arriving_counts(voxels: DataFrame) -> DataFrame:
    """Voxels of each label so far, for outputMode update or complete."""
    return voxels.groupBy("label").agg(F.count("*").alias("voxels"))


def windowed(points: DataFrame, time: str, width: str, late: str) -> DataFrame:
    """Points of each segment in tumbling windows; those later than the watermark are left out. An extra of this library."""
    return points.withWatermark(time, late).groupBy(F.window(time, width), "segid").agg(F.count("*").alias("points"))

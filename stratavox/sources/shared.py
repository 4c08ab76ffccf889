"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset a local session gets a temporary folder; a cluster has no such folder, so it fails."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext._jsc.sc()
        if context.getCheckpointDir().isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratavox-"))
        found = context.getCheckpointDir().get()
    return found.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and it outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that materialise() gave, once nothing reads them any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)

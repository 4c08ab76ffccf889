"""Volumes and tables derived from the driver's tables, as Spark SQL that DuckDB also runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Extent of the two volumes, x, y, z.
SEG_SHAPE, CCL_SHAPE = (128, 128, 7), (48, 48, 7)

SQL = {
    "vol_seg": """SELECT CAST(l_partkey % 128 AS BIGINT) AS x, CAST(l_orderkey % 128 AS BIGINT) AS y, CAST(l_linenumber - 1 AS BIGINT) AS z,
        CAST(max(l_quantity) AS BIGINT) * 5 AS v, CAST(min(l_suppkey) + 1 AS BIGINT) AS label FROM lineitem GROUP BY 1, 2, 3""",
    "vol_ccl": """SELECT CAST(l_partkey % 48 AS BIGINT) AS x, CAST(l_orderkey % 48 AS BIGINT) AS y, CAST(l_linenumber - 1 AS BIGINT) AS z,
        CAST(min(l_quantity) AS BIGINT) * 5 AS v FROM lineitem GROUP BY 1, 2, 3""",
    "points": """SELECT CAST(user_id AS BIGINT) AS x, CAST(event_id % 128 AS BIGINT) AS y, CAST(day(ts) - 1 AS BIGINT) AS z, CAST(user_id AS BIGINT) AS segid,
        event_type AS swc_label, CAST(event_id AS BIGINT) AS point FROM events""",
    "remap": "SELECT CAST(s_suppkey + 1 AS BIGINT) AS old, CAST(s_nationkey AS BIGINT) + 1 AS new FROM supplier",
    "ids": "SELECT CAST(s_suppkey + 1 AS BIGINT) AS label FROM supplier WHERE s_acctbal > 0",
}
TABLES = {"vol_seg": "lineitem", "vol_ccl": "lineitem", "points": "events", "remap": "supplier", "ids": "supplier"}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables over the driver's tables in sf_dir."""
    base = TABLES[name]
    return spark.sql(SQL[name].replace(f"FROM {base}", f"FROM {{{base}}}"), **{base: spark.read.parquet(f"{sf_dir}/{base}.parquet")})


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as dense chunks of 8 x 8 x 1 voxels: z and the 64 values of a chunk, x fastest."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("cast(vec_id as bigint) as z", "embedding as data")

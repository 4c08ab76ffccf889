"""Volumes as tables: chunk tables for scale, voxel tables for SQL, their metadata, and files in and out."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.operators.select import AXES, Box, inside
from stratavox.plans.scales import ShardSpec
from stratavox.functions.codes import compressed_morton, shard_number

Size = tuple[int, int, int]
VOXELS = "cx long, cy long, cz long, x long, y long, z long, v long"
CHUNKS = "cx long, cy long, cz long, dtype string, data binary"
#: Encodings whose bytes do not shrink further; others are gzipped unless told otherwise.
COMPRESSED = frozenset({"png", "jpeg", "jpegxl", "jxl", "kempressed", "fpzip", "zfpc"})


@dataclass(frozen=True)
class Scale:
    key: str
    size: Size
    resolution: tuple
    chunk: Size
    offset: Size = (0, 0, 0)
    encoding: str = "raw"
    sharding: ShardSpec | None = None


@dataclass(frozen=True)
class VolumeInfo:
    """What a volume is, apart from its voxels; JSON both ways."""

    layer: str
    dtype: str
    scales: tuple[Scale, ...]
    channels: int = 1
    rois: tuple[Box, ...] = ()
    provenance: tuple[dict, ...] = field(default=())

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> VolumeInfo:
        raw = json.loads(text)
        scales = tuple(Scale(**{k: tuple(v) if isinstance(v, list) else ShardSpec(**v) if isinstance(v, dict) else v for k, v in s.items()}) for s in raw.pop("scales"))
        rois = tuple(tuple(map(tuple, r)) for r in raw.pop("rois"))
        return VolumeInfo(scales=scales, rois=rois, provenance=tuple(raw.pop("provenance")), **raw)

    def processed(self, **step) -> VolumeInfo:
        """The info with one more step of its history."""
        return VolumeInfo(self.layer, self.dtype, self.scales, self.channels, self.rois, (*self.provenance, step))


def compression_for(encoding: str, wanted: str | None = None) -> str:
    """The byte compression of files in an encoding."""
    return wanted or ("none" if encoding in COMPRESSED else "gzip")


def to_chunks(vol: DataFrame, chunk: Size, dtype: str = "uint8") -> DataFrame:
    """Dense chunks of a voxel table (x, y, z, v), x fastest; a group is one chunk."""
    keyed = vol.select(*[F.floor(F.col(a) / s).cast("bigint").alias(f"c{a}") for a, s in zip(AXES, chunk, strict=True)], *AXES, "v")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        c = [int(group[f"c{a}"].iloc[0]) for a in AXES]
        dense = np.zeros(chunk[::-1], np.dtype(dtype))
        at = [group[a].to_numpy() - k * s for a, k, s in zip(AXES, c, chunk, strict=True)]
        dense[at[2], at[1], at[0]] = group["v"].to_numpy()
        return pd.DataFrame({"cx": [c[0]], "cy": [c[1]], "cz": [c[2]], "dtype": [dtype], "data": [dense.tobytes()]})

    return keyed.groupBy("cx", "cy", "cz").applyInPandas(pack, CHUNKS)


def to_voxels(chunks: DataFrame, chunk: Size, background: int = 0) -> DataFrame:
    """The voxels of dense chunks other than the background."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                dense = np.frombuffer(row.data, row.dtype).reshape(chunk[::-1])
                z, y, x = np.nonzero(dense != background)
                own = {"cx": row.cx, "cy": row.cy, "cz": row.cz}
                out = pd.DataFrame({"x": x + row.cx * chunk[0], "y": y + row.cy * chunk[1], "z": z + row.cz * chunk[2], "v": dense[z, y, x].astype(np.int64)})
                yield out.assign(**own)[[c.split()[0] for c in VOXELS.split(", ")]]

    return chunks.select("cx", "cy", "cz", "dtype", "data").mapInPandas(unpack, VOXELS).select(*AXES, "v")


def write_volume(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A chunk or voxel table with a mip column, a folder for each mip; only the mips at hand are overwritten."""
    table.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("mip").parquet(path)


def read_volume(spark: SparkSession, path: str, mip: int, box: Box | None = None) -> DataFrame:
    """The voxels of a level within a box; the filters reach the Parquet scan."""
    found = spark.read.parquet(path).filter(F.col("mip") == mip)
    return found if box is None else found.filter(inside(box))


def with_shards(chunks: DataFrame, spec: ShardSpec, grid: Size) -> DataFrame:
    """Chunks with their Morton code, shard and minishard."""
    shard, mini = shard_number(F.col("code"), spec.preshift, spec.minishard, spec.shard)
    return chunks.withColumn("code", compressed_morton("cx", "cy", "cz", grid)).withColumns({"shard": shard, "minishard": mini})


def write_shards(chunks: DataFrame, path: str) -> None:
    """One folder for each shard, its chunks in the order of minishard and code."""
    chunks.repartition("shard").sortWithinPartitions("shard", "minishard", "code").write.mode("overwrite").partitionBy("shard").parquet(path)


def import_npy(spark: SparkSession, path: str, chunk: Size, shape: Size) -> DataFrame:
    """Voxels of a .npy array of up to three axes (x, y, z). Files come whole, as Spark reads binary files."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for batch in batches:
            for content in batch["content"]:
                dense = np.atleast_3d(np.load(io.BytesIO(content), allow_pickle=False))
                for z in range(dense.shape[2]):
                    x, y = np.nonzero(dense[:, :, z])
                    yield pd.DataFrame({"x": x, "y": y, "z": z, "v": dense[x, y, z].astype(np.int64)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(load, "x long, y long, z long, v long")


def transfer(vol: DataFrame, box: Box | None = None, shift: Size = (0, 0, 0), chunk: Size | None = None) -> DataFrame:
    """A copy: cut out, moved, and keyed by another chunking; without any of these the table itself, which copies as it is."""
    out = vol if box is None else vol.filter(inside(box))
    if any(shift):
        out = out.withColumns({a: F.col(a) + d for a, d in zip(AXES, shift, strict=True)})
    return out if chunk is None else out.withColumns({f"c{a}": F.floor(F.col(a) / s).cast("bigint") for a, s in zip(AXES, chunk, strict=True)})


def write_index(index: DataFrame, url: str | None = None, table: str = "spatial_index", path: str | None = None) -> None:
    """The spatial index to a database over JDBC, or to Parquet."""
    if url:
        index.write.mode("overwrite").jdbc(url, table)
    else:
        index.write.mode("overwrite").parquet(path)


def write_swc(lines: DataFrame, path: str) -> None:
    """SWC files: a folder for each label, lines in the order of their nodes."""
    lines.repartition("label").sortWithinPartitions("label", "node").select("label", F.col("line").alias("value")).write.mode("overwrite").partitionBy("label").text(path)

"""What the operators of this subpackage share: reading, shared intermediate tables and text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.sources.shared import drop, materialise  # noqa: F401

#: A word is a run of characters other than the ASCII white space of the contracts.
WORD = r"[^\x20\x09-\x0D]+"
#: Text is handled in pieces of about so many bytes, so that numpy's temporaries stay small.
PIECE_BYTES = 2 << 20
#: Bytes in an Arrow batch; long documents then come in small batches.
BATCH_BYTES = 16 << 20


def configure(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, and free a query's shuffle files when it has ended.

    Only the registered queries and the pipeline call this; operators leave the settings of their caller's session alone.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame) -> Column:
    """The text column, a null being empty."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and len + 1 offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows holding about `most` bytes each; a longer row is alone in its range."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end


def space_table() -> np.ndarray:
    """True for the bytes that separate words."""
    out = np.zeros(256, bool)
    out[[32, *range(9, 14)]] = True
    return out


SPACE = space_table()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(start, start + length)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat "name type, ..." list, for use within tasks."""
    return pa.schema([(name, ARROW[kind]) for name, kind in (x.split() for x in ddl.split(","))])


def batch_of(ddl: str, *arrays) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) and a.type == f.type else pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

"""Label chunks as blocks with palettes: each block has a table of its labels and indices into it of as few bits as that takes.

The bytes of a chunk: the blocks' directory (bits, where the table begins, how many labels it has, where the indices begin), then
tables and packed indices. Blocks with equal tables share one. A block is read by its directory entry alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Size = tuple[int, int, int]
#: Voxels of a block along each axis, and the widths that indices may have: whole divisors of a word.
BLOCK, WIDTHS = 8, (0, 1, 2, 4, 8, 16)
ENTRY = np.dtype([("bits", "<u4"), ("table", "<u4"), ("labels", "<u4"), ("data", "<u4")])
PALETTES = "cx long, cy long, cz long, dtype string, palettes binary"
CHUNKS = "cx long, cy long, cz long, dtype string, data binary"


def _pack(index: np.ndarray, bits: int) -> bytes:
    if not bits:
        return b""
    each = 32 // bits
    words = np.zeros(-(-len(index) // each) * each, np.uint32)
    words[: len(index)] = index
    return np.bitwise_or.reduce(words.reshape(-1, each) << (np.arange(each, dtype=np.uint32) * np.uint32(bits)), axis=1).astype("<u4").tobytes()


def _unpack(raw: bytes, offset: int, bits: int, n: int) -> np.ndarray:
    if not bits:
        return np.zeros(n, np.uint32)
    each = 32 // bits
    words = np.frombuffer(raw, "<u4", -(-n // each), offset)
    return (words[:, None] >> (np.arange(each, dtype=np.uint32) * np.uint32(bits)) & np.uint32((1 << bits) - 1)).ravel()[:n]


def blocks_of(shape: Size) -> Size:
    """How many blocks an array of z, y, x extents has along each."""
    return tuple(-(-s // BLOCK) for s in shape)


def encode(dense: np.ndarray) -> bytes:
    """The bytes of a label array in z, y, x order; blocks at its end are filled with their last labels."""
    nz, ny, nx = blocks_of(dense.shape)
    whole = np.pad(dense, [(0, n * BLOCK - s) for n, s in zip((nz, ny, nx), dense.shape, strict=True)], mode="edge")
    blocks = whole.reshape(nz, BLOCK, ny, BLOCK, nx, BLOCK).transpose(0, 2, 4, 1, 3, 5).reshape(nz * ny * nx, -1)
    head, body, known = np.zeros(len(blocks), ENTRY), [], {}
    at = head.nbytes
    for k, block in enumerate(blocks):
        labels, index = np.unique(block, return_inverse=True)
        bits = next(w for w in WIDTHS if len(labels) <= 1 << w)
        table = labels.astype(labels.dtype.newbyteorder("<")).tobytes()
        if table not in known:
            known[table] = at
            body.append(table)
            at += len(table)
            body.append(b"\0" * (-at % 4))
            at += -at % 4
        packed = _pack(index, bits)
        head[k] = (bits, known[table], len(labels), at)
        body.append(packed)
        at += len(packed)
    return head.tobytes() + b"".join(body)


def block_at(raw: bytes, dtype: str, shape: Size, place: Size) -> np.ndarray:
    """One block of an encoded array, in z, y, x order, without reading the others; place counts blocks along z, y and x."""
    _, ny, nx = blocks_of(shape)
    z, y, x = place
    entry = np.frombuffer(raw, ENTRY, 1, ((z * ny + y) * nx + x) * ENTRY.itemsize)[0]
    labels = np.frombuffer(raw, np.dtype(dtype).newbyteorder("<"), int(entry["labels"]), int(entry["table"]))
    block = labels[_unpack(raw, int(entry["data"]), int(entry["bits"]), BLOCK**3)].reshape(BLOCK, BLOCK, BLOCK)
    return block[tuple(np.s_[: s - p * BLOCK] for s, p in zip(shape, place, strict=True))]


def decode(raw: bytes, dtype: str, shape: Size) -> np.ndarray:
    """The whole array."""
    out = np.empty(shape, dtype)
    for place in np.ndindex(*blocks_of(shape)):
        out[tuple(np.s_[p * BLOCK : (p + 1) * BLOCK] for p in place)] = block_at(raw, dtype, shape, place)
    return out


def _mapped(table: DataFrame, column: str, ddl: str, work) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array([work(raw, dtype) for raw, dtype in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], out], names=[x.split()[0] for x in ddl.split(", ")])

    return table.select("cx", "cy", "cz", "dtype", column).mapInArrow(run, ddl)


def encode_chunks(chunks: DataFrame, chunk: Size) -> DataFrame:
    """A chunk table with palettes in place of data: whole numbers of any width, without loss. No shuffle."""
    return _mapped(chunks, "data", PALETTES, lambda raw, dtype: encode(np.frombuffer(raw, dtype).reshape(chunk[::-1])))


def decode_chunks(encoded: DataFrame, chunk: Size) -> DataFrame:
    """The chunk table again."""
    return _mapped(encoded, "palettes", CHUNKS, lambda raw, dtype: decode(raw, dtype, chunk[::-1]).tobytes())

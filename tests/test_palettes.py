"""Label chunks as blocks with palettes."""

import numpy as np
import pytest

from stratavox.sources import palettes
from stratavox.sources.volume import to_chunks

SHAPE = (19, 8, 21)  # z, y, x


@pytest.mark.parametrize("kinds", [1, 2, 3, 5, 17, 300, 100_000])
@pytest.mark.parametrize("dtype", ["uint8", "<i8", "uint32"])
def test_round_trip(kinds, dtype):
    rng = np.random.default_rng(kinds)
    names = rng.integers(0, min(np.iinfo(dtype).max, 1 << 62), kinds).astype(dtype)
    dense = names[rng.integers(0, kinds, SHAPE)]
    raw = palettes.encode(dense)
    assert (palettes.decode(raw, dtype, SHAPE) == dense).all()
    for place in np.ndindex(*palettes.blocks_of(SHAPE)):
        cut = tuple(np.s_[8 * p : 8 * p + 8] for p in place)
        assert (palettes.block_at(raw, dtype, SHAPE, place) == dense[cut]).all()


def test_blocks_of_few_labels_are_small():
    dense = np.zeros((64, 64, 64), np.int64)
    assert len(palettes.encode(dense)) == 512 * 16 + 8  # a directory and one shared table
    dense[:32] = 1 << 60
    dense[0, 0, 0] = 5
    assert len(palettes.encode(dense)) == 512 * 16 + 8 + 8 + 16 + 64


def test_one_block_reads_its_own_bytes():
    """Bytes that belong to other blocks may be anything."""
    rng = np.random.default_rng(3)
    dense = rng.integers(0, 9, (16, 16, 16)) + 10 * (np.indices((16, 16, 16)) // 8).sum(axis=0)
    raw = bytearray(palettes.encode(dense))
    first = np.frombuffer(bytes(raw), palettes.ENTRY, 2)
    raw[int(first[1]["table"]) :] = b"\xff" * (len(raw) - int(first[1]["table"]))
    assert (palettes.block_at(bytes(raw), "<i8", dense.shape, (0, 0, 0)) == dense[:8, :8, :8]).all()


def test_chunk_tables(spark):
    rows = [(x, y, z, 7 + x // 3) for x in range(13) for y in range(9) for z in range(3)]
    chunks = to_chunks(spark.createDataFrame(rows, "x long, y long, z long, v long"), (8, 8, 4), "int64")
    back = palettes.decode_chunks(palettes.encode_chunks(chunks, (8, 8, 4)), (8, 8, 4))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, chunks.collect()))
    assert palettes.encode_chunks(chunks.limit(0), (8, 8, 4)).collect() == []

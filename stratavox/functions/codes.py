"""Column functions: Morton codes, shard numbers, names of boxes, unsigned values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def morton(x: str, y: str, z: str, bits: int = 10) -> Column:
    """Bits of three columns interleaved, x lowest."""
    out = F.lit(0).cast("bigint")
    for i in range(bits):
        for k, c in enumerate((x, y, z)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(F.col(c).cast("bigint"), i).bitwiseAND(F.lit(1).cast("bigint")), 3 * i + k))
    return out


def compressed_morton(x: str, y: str, z: str, grid: tuple[int, int, int]) -> Column:
    """The same, but an axis takes part only in as many bits as its grid needs."""
    need = [max(0, (g - 1).bit_length()) for g in grid]
    out, at = F.lit(0).cast("bigint"), 0
    for i in range(max(need)):
        for c, n in zip((x, y, z), need, strict=True):
            if i < n:
                out = out.bitwiseOR(F.shiftleft(F.shiftright(F.col(c).cast("bigint"), i).bitwiseAND(F.lit(1).cast("bigint")), at))
                at += 1
    return out


def shard_number(code: Column, preshift: int, minishard: int, shard: int) -> tuple[Column, Column]:
    """Shard and minishard of a code."""
    low = F.shiftright(code, preshift)
    return F.shiftright(low, minishard).bitwiseAND(F.lit((1 << shard) - 1)), low.bitwiseAND(F.lit((1 << minishard) - 1))


def box_name(axes: tuple[str, str, str] = ("x", "y", "z")) -> Column:
    """x0-x1_y0-y1_z0-z1."""
    return F.concat_ws("_", *[F.concat_ws("-", F.col(f"{a}0").cast("string"), F.col(f"{a}1").cast("string")) for a in axes])


def label_of(name: Column) -> Column:
    """The label before the first colon of a fragment's name; null for other names."""
    found = F.regexp_extract(name, r"^(\d+):", 1)
    return F.when(found != "", found.cast("bigint"))


def unsigned(label: str) -> Column:
    """A 64-bit label, kept as a signed long, as the unsigned number."""
    wide = F.col(label).cast("decimal(20,0)")
    return F.when(F.col(label) < 0, wide + F.expr("18446744073709551616")).otherwise(wide)


def _fmix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return h ^ h >> np.uint32(16)


def murmur3_labels(labels: np.ndarray) -> np.ndarray:
    """The low 64 bits of MurmurHash3 x86 128, seed 0, of labels as 8 little-endian bytes: the tail-only case, for whole columns."""
    k1, k2 = (labels & np.uint64(0xFFFFFFFF)).astype(np.uint32), (labels >> np.uint64(32)).astype(np.uint32)
    turn = lambda x, r: x << np.uint32(r) | x >> np.uint32(32 - r)
    h2 = turn(k2 * np.uint32(0xAB0E9789), 16) * np.uint32(0x38B34AE5)
    h1 = turn(k1 * np.uint32(0x239B961B), 15) * np.uint32(0xAB0E9789)
    h1, h2 = h1 ^ np.uint32(8), h2 ^ np.uint32(8)
    h3 = h4 = np.full(len(labels), 8, np.uint32)
    h1 = h1 + h2 + h3 + h4
    h2, h3, h4 = h2 + h1, h3 + h1, h4 + h1
    h1, h2, h3, h4 = _fmix(h1), _fmix(h2), _fmix(h3), _fmix(h4)
    h1 = h1 + h2 + h3 + h4
    h2 = h2 + h1
    return h1.astype(np.uint64) | h2.astype(np.uint64) << np.uint64(32)


def hashed_label(column: Column) -> Column:
    """murmur3_labels as a column function, over Arrow batches."""

    @F.pandas_udf("bigint")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(murmur3_labels(batch.to_numpy(np.int64).view(np.uint64)).view(np.int64))

    return hashed(column)

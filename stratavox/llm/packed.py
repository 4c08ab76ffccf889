"""Counting 64-bit hashes over all rows, with the hashes of a batch packed by bucket so that rows stay few.

A batch of rows gives, for each bucket of the hash space it touches, one row: its distinct hashes, how often each
occurs, and what belongs to them (a payload that stays behind). Buckets add up the counts, so a hash that half of all
rows share reaches its bucket once per batch, and answer each batch with the hashes that occur twice or more.

Buckets grow with the input, but a batch is cut into FAN rows at most, as a row costs the same however few hashes it has.
Beyond that the exchange has two levels: rows of a coarse bucket from many batches are merged and cut again, so that rows
of either level stay long, and answers go back the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import batch_of

#: Bytes of text in a batch, and bytes of input for each bucket.
BATCH, PER_BUCKET, LEAST = 12 << 20, 8 << 20, 64
#: Rows that a batch is cut into at most, and rows that are merged at least before they are cut again.
FAN, MERGED = 1024, 64
#: Parts of the rows of one key, where a key may be common.
SALTS = 64
PACKED = "bucket long, batch long, hashes binary, counts binary, payload binary"
ANSWER = "bucket long, batch long, at binary, hashes binary, counts binary"


def buckets_for(n_bytes: int | None) -> int:
    """A number of buckets that grows with the input's bytes, as counted."""
    return int(min(max(LEAST, (n_bytes or 0) // PER_BUCKET), 1 << 20))


class Fan:
    """Buckets in two levels: `coarse` ones, each of `per` of the `fine` ones; rows of a coarse bucket are merged in `groups`."""

    def __init__(self, buckets: int, most: int = FAN, per_batch: int = BATCH):
        self.coarse = min(buckets, most)
        self.per = -(-buckets // self.coarse)
        self.fine = self.coarse * self.per
        self.groups = max(1, self.fine * PER_BUCKET // per_batch // max(self.per, MERGED))

    def group(self, *by: str):
        """The group of a row, by what names it."""
        return F.pmod(F.xxhash64(*by), F.lit(self.groups))


def batch_number(k: int) -> int:
    return (TaskContext.get().partitionId() << 24) | k


def press(x: np.ndarray) -> bytes:
    """An array without its type: byte planes, each compressed well where it varies little."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpress(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def press_sorted(x: np.ndarray) -> bytes:
    return press(np.diff(x.astype(np.uint64), prepend=np.uint64(0)))


def unpress_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpress(raw, np.uint64), dtype=np.uint64)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def by_bucket(hashes: np.ndarray, buckets: int):
    """Ranges of sorted hashes that lie in one bucket: bucket, start, end."""
    if not len(hashes):
        return iter(())
    bucket = bucket_of(hashes, buckets)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return zip(bucket[cuts].tolist(), cuts.tolist(), np.append(cuts[1:], len(hashes)).tolist(), strict=True)


def add_up(table: pa.Table) -> pa.Table:
    """For applyInArrow by bucket: for each batch, the places, values and total counts of its hashes that occur twice or more."""
    lists = [unpress_sorted(x.as_py()) for x in table["hashes"]]
    counts = np.concatenate([unpress(x.as_py(), np.uint32) for x in table["counts"]])
    every = np.concatenate(lists)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    cuts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    total = np.empty(len(every), np.int64)
    total[order] = np.repeat(np.add.reduceat(counts[order].astype(np.int64), cuts), np.diff(np.append(cuts, len(every))))
    out, first = [], 0
    for hashes in lists:
        mine = total[first : first + len(hashes)]
        at = np.flatnonzero(mine > 1)
        out.append((press_sorted(at), press_sorted(hashes[at]), press(np.minimum(mine[at], 65535).astype(np.uint16))))
        first += len(hashes)
    return pa.Table.from_batches([batch_of(ANSWER, table["bucket"].combine_chunks(), table["batch"].combine_chunks(), *map(list, zip(*out, strict=True)))])


def cut_again(fine: int):
    """For applyInArrow by coarse bucket and group: the hashes of all its batches, counts added, by fine bucket; the group stands for the batch."""

    def run(table: pa.Table) -> pa.Table:
        every = np.concatenate([unpress_sorted(x.as_py()) for x in table["hashes"]])
        counts = np.concatenate([unpress(x.as_py(), np.uint32) for x in table["counts"]])
        order = np.argsort(every, kind="stable")
        every = every[order]
        cuts = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        total = np.minimum(np.add.reduceat(counts[order].astype(np.int64), cuts), 2**32 - 1).astype(np.uint32)
        every, group = every[cuts], table["group"][0].as_py()
        rows = [(bucket, group, press_sorted(every[i:j]), press(total[i:j])) for bucket, i, j in by_bucket(every, fine)]
        return pa.Table.from_batches([batch_of("bucket long, batch long, hashes binary, counts binary", *map(list, zip(*rows, strict=True)))])

    return run


def hand_back(left: pa.Table, right: pa.Table) -> pa.Table:
    """For cogroup by coarse bucket and group, of batches and of their group's answers: each batch's own answer."""
    known = np.concatenate([np.zeros(0, np.uint64), *(unpress_sorted(x.as_py()) for x in right["hashes"])])
    total = np.concatenate([np.zeros(0, np.uint16), *(unpress(x.as_py(), np.uint16) for x in right["counts"])])
    order = np.argsort(known)
    known, total, out = np.append(known[order], np.uint64(0)), np.append(total[order], np.uint16(0)), []
    for bucket, batch, raw in zip(left["bucket"].to_pylist(), left["batch"].to_pylist(), left["hashes"].to_pylist(), strict=True):
        hashes = unpress_sorted(raw)
        place = np.searchsorted(known[:-1], hashes)
        at = np.flatnonzero((known[place] == hashes) & (place < len(known) - 1))
        out.append((bucket, batch, press_sorted(at), press_sorted(hashes[at]), press(total[place[at]])))
    return pa.Table.from_batches([batch_of(ANSWER, *(map(list, zip(*out, strict=True)) if out else [[]] * 5))])


def shared(packed: DataFrame, fan: Fan) -> DataFrame:
    """ANSWER rows of a table of PACKED rows, whose buckets are the coarse ones of fan."""
    light = packed.select("bucket", "batch", "hashes", "counts")
    if fan.per == 1:
        return light.groupBy("bucket").applyInArrow(add_up, ANSWER)
    grouped = light.withColumn("group", fan.group("batch"))
    cut = grouped.groupBy("bucket", "group").applyInArrow(cut_again(fan.fine), "bucket long, batch long, hashes binary, counts binary")
    found = cut.groupBy("bucket").applyInArrow(add_up, ANSWER)
    back = found.select(F.floor(F.col("bucket") / fan.per).cast("long").alias("bucket"), F.col("batch").alias("group"), "hashes", "counts")
    return grouped.groupBy("bucket", "group").cogroup(back.groupBy("bucket", "group")).applyInArrow(hand_back, ANSWER)


def with_salt(rows: DataFrame, *by: str) -> DataFrame:
    """rows with a salt by these columns, which splits a key's rows among SALTS tasks."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(*by, F.lit(5)), F.lit(SALTS)).cast("int"))


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return (keys.view(np.uint64) % np.uint64(blocks)).astype(np.int64)


def block_column(key, blocks: int):
    """The same as block_of, for a long column."""
    low = F.pmod(F.col(key).bitwiseAND(F.lit((1 << 63) - 1)), F.lit(blocks))
    return F.when(F.col(key) < 0, F.pmod(low + F.lit((1 << 63) % blocks), F.lit(blocks))).otherwise(low).cast("long")

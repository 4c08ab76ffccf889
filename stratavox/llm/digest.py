"""Quartile bucket digests of documents: counts of hashed byte triplets, coded by quartile, with the length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm.common import arrow_schema, buffer, configure, materialise, pieces, table, text_of

#: Buckets of a digest, two bits each, and the byte distances that make a triplet: neighbours, and pairs further apart.
BUCKETS, TRIPLETS = 256, ((1, 2), (1, 3), (2, 4))
#: The most that the lengths of two texts, in eighths of an octave, can take from their likeness.
LENGTH_STEPS = 32
#: Bytes of text in a range of documents.
RANGE_BYTES = 16 << 20
EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
WALKED = EDITED + ", edge int, part long, text string"


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many triplets of each row fall into each bucket; triplets do not cross rows."""
    n, out = len(offsets) - 1, np.zeros((len(offsets) - 1) * BUCKETS, np.int64)
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    wide = data.astype(np.uint32)
    for k, (a, b) in enumerate(TRIPLETS):
        if len(data) <= b:
            continue
        h = (wide[:-b] * np.uint32(0x9E3779B1) + wide[a : len(wide) - b + a] * np.uint32(0x85EBCA77) + wide[b:] * np.uint32(0xC2B2AE3D) + np.uint32(k)) * np.uint32(0x27D4EB2F)
        inside = row[:-b] == row[b:]
        out += np.bincount((row[:-b].astype(np.int64) * BUCKETS + ((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)))[inside], minlength=len(out))
    return out.reshape(n, BUCKETS)


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of bytes for each text: its length class, then two bits for each bucket's quartile.

    The quartile of a bucket is how many of the three quartile counts of its text it exceeds.
    """
    counts = bucket_counts(data, offsets)
    ordered = np.sort(counts, axis=1)
    quartiles = ordered[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts[:, :, None] > quartiles[:, None, :]).sum(axis=2).astype(np.uint8)
    packed = code[:, 0::4] | code[:, 1::4] << 2 | code[:, 2::4] << 4 | code[:, 3::4] << 6
    length = np.minimum(np.round(8 * np.log2(np.diff(offsets) + 1.0)), 255).astype(np.uint8)
    return np.concatenate([length[:, None], packed], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the difference score of digests, row by row: 0 to 1, and 1 for equal ones.

    Buckets differ by 0 to 3 quartiles, 3 counting double; unrelated codes differ by 1.375 on average, which is
    likeness 0. The lengths take at most a tenth.
    """
    x, y = ((d[:, 1:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3 for d in (a, b))
    step = np.array([0, 1, 2, 6])[np.abs(x.astype(np.int8) - y)].sum(axis=(1, 2))
    score = np.minimum(step / (1.375 * BUCKETS), 1.0)
    far = np.minimum(np.abs(a[:, 0].astype(int) - b[:, 0]), LENGTH_STEPS) / LENGTH_STEPS
    return np.clip(1 - np.minimum(score + 0.1 * far, 1.0), 0.0, 1.0)


def text_digests(texts: list[bytes]) -> np.ndarray:
    out = []
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]) if texts else np.zeros(1, np.int64)
    for a, b in pieces(offsets):
        out.append(digests(np.frombuffer(b"".join(texts[a:b]), np.uint8), offsets[a : b + 1] - offsets[a]))
    return np.concatenate(out) if out else np.zeros((0, 1 + BUCKETS // 4), np.uint8)


def fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("doc_id long, n_bytes long, fingerprint string")
    for batch in batches:
        data, offsets = buffer(batch.column(1))
        for a, b in pieces(offsets):
            own = digests(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(np.diff(offsets[a : b + 1])), pa.array([x.tobytes().hex() for x in own])], schema=schema)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and fingerprint of every row of docs; a null text counts as empty. Equal texts have equal ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(fingerprint_rows, "doc_id long, n_bytes long, fingerprint string")


def edited(ids, texts: list[str], after: list[str], nearby: np.ndarray | None = None) -> pa.RecordBatch:
    """EDITED rows of texts, each with the text after it; nearby: the digests of those, where they are at hand."""
    half = [len(x) // 2 for x in texts]
    changed = [(x[: len(x) - h] + y[:h]).encode() for x, y, h in zip(texts, after, half, strict=True)]
    own = text_digests([x.encode() for x in texts])
    if nearby is None:
        nearby = text_digests([x.encode() for x in after])
    else:  # the digest of each text is that of the one before it's next
        nearby = np.concatenate([own[1:], nearby]) if len(own) else nearby
    other = text_digests(changed)
    arrays = [
        ids,
        pa.array([len(x) for x in texts], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in changed]),
        pa.array([x.tobytes().hex() for x in own]),
        pa.array([x.tobytes().hex() for x in other]),
        pa.array(likeness(own, other)),
        pa.array(likeness(own, nearby)),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema(EDITED))


def edited_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, text, next_text): EDITED rows."""
    for batch in batches:
        _, offsets = buffer(batch.column(1))
        for a, b in pieces(offsets):
            yield edited(batch.column(0)[a:b], batch.column(1)[a:b].to_pylist(), batch.column(2)[a:b].to_pylist())


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over a sorted partition of (doc_id, text): WALKED rows.

    Each row but the last is done (edge 0), with the row after it in hand. The first and the last row of the partition
    are also given with their texts (edges 1 and 2), for the pairs that partitions share.
    """
    part, last = TaskContext.get().partitionId(), None
    schema = arrow_schema(WALKED)

    def edge(kind: int, doc, text: str) -> pa.RecordBatch:
        values = {"doc_id": doc, "edge": kind, "part": part, "text": text}
        return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    def done(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.zeros(n), pa.int32()), pa.array(np.full(n, part), pa.int64()), pa.nulls(n, pa.string())], schema=schema)

    for batch in batches:
        _, offsets = buffer(batch.column(1))
        for a, b in pieces(offsets):
            ids, texts = batch.column(0)[a:b].to_pylist(), batch.column(1)[a:b].to_pylist()
            if last is None:
                yield edge(1, ids[0], texts[0])
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            if len(texts) > 1:
                nearby = text_digests([texts[-1].encode()])
                yield done(edited(pa.array(ids[:-1], pa.int64()), texts[:-1], texts[1:], nearby))
            last = ids[-1], texts[-1]
    if last is not None:
        yield edge(2, *last)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how near they and the next document's are.

    The last half of a text's code points gives way to the first as many of the next document, by descending doc_id;
    rows with equal ids come by the hash of their text, and a null id is last. A null text counts as empty; a single
    document follows itself; an empty table gives no rows. Other columns are ignored.

    Ranges of the order, split within equal rows too, are sorted and walked through once; where one ends, its last
    document meets the first of the next range that has any. A range holds about RANGE_BYTES of text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2, int(n_bytes // RANGE_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.desc_nulls_last("doc_id"), F.asc("_hash"), F.asc("_own")]
    placed = rows.withColumns({"_hash": F.xxhash64("text"), "_own": F.monotonically_increasing_id()}).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    walked = materialise(placed.select("doc_id", "text").mapInArrow(walk, WALKED), "digest-walked")
    heads, lasts = (walked.filter(F.col("edge") == k) for k in (1, 2))
    around = Window.orderBy("part")  # a row for each range
    after = heads.select("part", F.coalesce(F.lead("part").over(around), F.min("part").over(Window.partitionBy())).alias("_to"))
    met = lasts.select("part", "doc_id", "text").join(after, "part").join(heads.select(F.col("part").alias("_to"), F.col("text").alias("next_text")), "_to")
    names = [x.split()[0] for x in EDITED.split(", ")]
    return walked.filter("edge = 0").select(*names).unionByName(met.select("doc_id", "text", "next_text").mapInArrow(edited_rows, EDITED))


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    return edited_fingerprints(table(spark, sf_dir, "documents"))

"""Packing tokenised documents into fixed windows: two passes of prefix sums, then cuts at the windows' edges."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm.common import arrow_schema, SPACE, buffer, configure, materialise, mix64, pieces, ranges, table, text_of

#: Ids in a window, and the id that ends a document.
WINDOW, END = 4096, 2
#: Words of which a Python worker remembers the ids; beyond that it starts anew.
REMEMBER = 1_000_000
#: Totals are broadcast up to so many; beyond that the ids are shuffled to them.
MOST_TOTALS = 500_000
#: Bytes of words that are hashed at a time.
HASHED = 1 << 19
#: Stands between the words of one call of the tokenizer; words that hold it themselves are encoded alone.
MARK = "•"
TOKENS = "doc_id long, part long, at long, n_ids int, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, boundary boolean"
_encoders: dict = {}


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run data[start:end]; runs may overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    upto = np.concatenate([[0], np.cumsum(lengths)])
    if len(starts) > 1 and upto[-1] > HASHED:  # a part at a time, as the work needs many times the text's bytes
        return np.concatenate([word_hashes(data, starts[a:b], ends[a:b]) for a, b in pieces(upto, HASHED)])
    powers = np.multiply.accumulate(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    at = ranges(np.zeros(len(starts), np.int64), lengths)
    values = (data[ranges(starts, lengths)].astype(np.uint64) + np.uint64(1)) * powers[at]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix64(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in data, and how many each row has; no word crosses rows."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = np.unique(offsets[1:-1])
    within = cuts[(cuts > 0) & (cuts < len(data))]
    within = within[(inside[within] == 1) & (inside[within + 1] == 1)]  # a row ends inside what looks like one word
    if len(within):
        starts, ends = np.sort(np.concatenate([starts, within])), np.sort(np.concatenate([ends, within]))
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


class Encoder:
    """Ids of words, each word encoded once: the tokenizer splits at white space before anything else."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self._plain([MARK])[0]
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and how many each has."""
        marked = [i for i, x in enumerate(texts) if MARK in x]
        own = {i: x for i, x in zip(marked, self._plain([texts[i] for i in marked]), strict=True)}
        usual = [x for i, x in enumerate(texts) if i not in own] if own else texts
        joined = [f" {MARK} ".join(usual[i : i + 2000]) + f" {MARK}" for i in range(0, len(usual), 2000)]
        ids = np.array([y for x in self._plain(joined) for y in x], np.uint32)
        marks = np.flatnonzero(ids == self.mark)
        if len(marks) != len(usual):
            raise ValueError("the tokenizer doesn't split at white space first")
        counts = np.diff(marks, prepend=-1) - 1
        ids = ids[ids != self.mark]
        if not own:
            return ids, counts
        every = iter(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else [])
        lists = [np.array(own[i], np.uint32) if i in own else next(every) for i in range(len(texts))]
        return np.concatenate(lists), np.array([len(x) for x in lists], np.int64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in turn, and how many each word has."""
        hashes, sample, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBER:
            self.forget()
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if new.any():
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)]
            ids, counts = self._encode(texts)
            first = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, ids])
            known = np.concatenate([self.known, hashes[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.first, self.count = np.concatenate([self.first, first])[order], np.concatenate([self.count, counts])[order]
            at = np.searchsorted(self.known, hashes)
        count = self.count[at][inverse]
        return self.ids[ranges(self.first[at][inverse], count)], count


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_rows(path: str):
    """For mapInArrow over (doc_id, text): TOKENS rows, with `at` counting the ids before a document in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = _encoder(path), TaskContext.get().partitionId(), 0
        schema = arrow_schema(TOKENS)
        for batch in batches:
            data, offsets = buffer(batch.column(1))
            for a, b in pieces(offsets, 3 << 20):
                own, cut = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                starts, ends, n_words = words(own, cut)
                ids, per_word = encode(own, starts, ends)
                upto = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], np.cumsum(n_words)])]
                ids = np.insert(ids, upto[1:], END).astype("<u4")
                n = np.diff(upto) + 1
                blob = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((np.concatenate([[0], np.cumsum(n)]) * 4).astype(np.int32)), pa.py_buffer(ids)])
                first = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(np.full(len(n), part)), pa.array(first), pa.array(n.astype(np.int32)), blob], schema=schema)

    return run


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, first, n_ids, ids): a row for each window that a document lies in."""
    schema = arrow_schema(PIECES)
    for batch in batches:
        first, n = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64)
        data, offsets = buffer(batch.column(3))
        low = first // WINDOW
        count = (first + n - 1) // WINDOW - low + 1
        row = np.repeat(np.arange(len(n)), count)
        window = ranges(low, count)
        begin, end = np.maximum(window * WINDOW, first[row]), np.minimum((window + 1) * WINDOW, (first + n)[row])
        start, raw = begin - first[row], data.tobytes()
        byte = offsets[row] + 4 * start
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(byte.tolist(), (byte + 4 * (end - begin)).tolist(), strict=True)]
        doc = batch.column(0).take(pa.array(row))
        arrays = [doc, start, end - begin, np.array(crc, np.int64), n[row], window, begin - window * WINDOW, end < (first + n)[row]]
        yield pa.RecordBatch.from_arrays([arrays[0], *(pa.array(x) for x in arrays[1:])], schema=schema)


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Concatenate the ids of all documents, each ended by id 2, and cut the whole into windows of 4096.

    Only the last window of all is not full. The first pass tokenises, numbers ids within each partition and totals
    the partitions; running sums over those totals make the numbers global; the second pass cuts. A piece whose
    document goes on in the next window is marked as boundary. A null or empty text is the one id 2. Repeated rows
    are packed each. An empty table gives no rows. Other columns are ignored. Words are known by a 64-bit hash within a
    task: of a million words two share one by chance once in about 4 * 10^7 tasks.
    """
    import public_tokenizers

    path = path or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    tokens = materialise(rows.mapInArrow(token_rows(path), TOKENS), "pack-tokens")
    totals = materialise(tokens.groupBy("part").agg(F.sum("n_ids").alias("_n")), "pack-totals")
    before = F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("part", F.coalesce(before, F.lit(0)).alias("_before"))
    if totals.count() <= MOST_TOTALS:  # a row for each task of the first pass
        starts = F.broadcast(starts)
    placed = tokens.join(starts, "part")
    return placed.select("doc_id", (F.col("_before") + F.col("at")).alias("first"), "n_ids", "ids").mapInArrow(cut_rows, PIECES)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    return pack(table(spark, sf_dir, "documents"))

"""Exact removal of repeated byte strings, by blockwise suffix sorting with a difference cover.

Every string of SPAN bytes has an anchor, its least hashed K-gram, so equal strings meet in the bucket of their anchor.
Only anchors of two documents or more matter. For those, documents ship segments: the text of all strings that share an
anchor. Buckets then sort their suffixes, one part of the bucket at a time: by the first bytes, then, where those tie,
by ranks of a difference cover's sample that were computed before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import batch_of, buffer, configure, drop, materialise, mix64, pieces, ranges, table, text_of
from stratavox.llm.packed import FAN, PACKED, Fan, batch_number, block_column, block_of, bucket_of, buckets_for, by_bucket, press, press_sorted, shared, unpress, unpress_sorted, with_salt
from stratavox.llm.packing import word_hashes

#: Bytes of a repeated string, and of an anchor within it.
SPAN, K = 50, 20
#: The cover's period, its residues (every difference mod PERIOD occurs among them), and the bytes of text sorted at a time.
PERIOD, COVER, PART = 8, np.array([0, 1, 2, 4]), 1 << 20
#: Records that a task gathers before it packs them.
GATHER = 1 << 21
#: From a position to the next sampled one that is at least 2 on, by residue.
STEP = np.array([next(d for d in range(2, 10) if (r + d) % PERIOD in COVER) for r in range(PERIOD)])
NOTES = "block long, kind int, doc long, blob binary"
SEGMENTS = "bucket long, block long, segments binary, owners binary"
REPEATS = "bucket long, block long, runs binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: Beyond so many documents an anchor's strings are told apart by SIDE more bytes before or after it.
HOT, SIDE = 1000, (SPAN - K) // 2

_bytes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def bundle(*arrays: np.ndarray) -> bytes:
    """Arrays pressed one after another, after their sizes."""
    raw = [press(x) for x in arrays]
    return np.array([len(x) for x in raw], "<i8").tobytes() + b"".join(raw)


def runs_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of runs of equal ones, and how long each run is."""
    cuts = np.flatnonzero(np.append(True, x[1:] != x[:-1]))[: len(x)]
    return x[cuts], np.diff(np.append(cuts, len(x))).astype(np.uint32)


def unbundle(raw: bytes, *kinds) -> list[np.ndarray]:
    sizes = np.frombuffer(raw, "<i8", len(kinds))
    ends = 8 * len(kinds) + np.cumsum(sizes)
    return [unpress(raw[e - s : e], k) for s, e, k in zip(sizes, ends, kinds, strict=True)]


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each anchor: its row, the first string it stands for, how many follow each other, its place in the first, its hash."""
    windows = np.maximum(np.diff(offsets) - SPAN + 1, 0)
    starts = ranges(offsets[:-1], windows)
    if not len(starts):
        return (*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    base = 0x2545F4914F6CDD1D
    one = _bytes[data]
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    join = lambda a, b, n: a[: len(b) - n] * power(n) + b[n:]
    two = join(one, one, 1)
    four = join(two, two, 2)
    eight = join(four, four, 4)
    sixteen = join(eight, eight, 8)
    h = mix64(sixteen[: len(four) - 16] * power(4) + four[16:])
    width = SPAN - K + 1
    rows = -(-len(h) // width)
    coded = np.full(rows * width, np.uint64(2**64 - 1))
    coded[: len(h)] = h & ~np.uint64(63) | (np.arange(len(h)) % width).astype(np.uint64)
    coded = coded.reshape(rows, width)
    prefix = np.minimum.accumulate(coded, axis=1).ravel()
    suffix = np.minimum.accumulate(coded[:, ::-1], axis=1)[:, ::-1].ravel()
    left, last = suffix[starts], starts + width - 1
    right = prefix[last]
    of_left = left >> np.uint64(6) <= right >> np.uint64(6)
    at = np.where(of_left, starts // width * width + (left & np.uint64(63)).astype(np.int64), last // width * width + (right & np.uint64(63)).astype(np.int64))
    row = np.repeat(np.arange(len(windows)), windows)
    cuts = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (row[1:] != row[:-1])))
    first = starts[cuts]
    return row[cuts], first - offsets[row[cuts]], np.diff(np.append(cuts, len(at))), at[cuts] - first, h[at[cuts]]


def anchor_rows(buckets: int):
    """For mapInArrow over (row, text): PACKED rows, the payload being where each anchor stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = 0
        for batch in batches:
            data, offsets = buffer(batch.column(1))
            ids = batch.column(0).to_numpy()
            for a, b in pieces(offsets, 4 << 20):
                found = [anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in ((a + x, a + y) for x, y in pieces(offsets[a : b + 1] - offsets[a], 1 << 20))]
                base = np.cumsum([0] + [y - x for x, y in pieces(offsets[a : b + 1] - offsets[a], 1 << 20)])[:-1]
                row = np.concatenate([f[0] + x for f, x in zip(found, base, strict=True)])
                start, count, place, h = (np.concatenate([f[i] for f in found]) for i in range(1, 5))
                order = np.argsort(h, kind="stable")
                row, start, count, place, h = row[order], start[order], count[order], place[order], h[order]
                number, out = batch_number(k), []
                for bucket, i, j in by_bucket(h, buckets):
                    cuts = np.flatnonzero(np.append(True, h[i + 1 : j] != h[i : j - 1]))
                    times = np.diff(np.append(cuts, j - i)).astype(np.uint32)
                    new = np.append(True, (h[i + 1 : j] != h[i : j - 1]) | (row[i + 1 : j] != row[i : j - 1]))
                    docs = np.add.reduceat(new.astype(np.uint32), cuts)
                    used, inverse = np.unique(row[i:j], return_inverse=True)
                    payload = bundle(ids[a + used], times, inverse.astype(np.uint32), start[i:j].astype(np.uint32), count[i:j].astype(np.uint8), place[i:j].astype(np.uint8))
                    out.append((bucket, number, press_sorted(h[i:j][cuts]), press(docs.astype(np.uint32)), payload))
                k += 1
                if out:
                    yield batch_of(PACKED, *map(list, zip(*out, strict=True)))

    return run


def note_batch(found: list, blocks: int) -> pa.RecordBatch:
    """NOTES rows of lists of (row, hash, start, count, anchor, hot) arrays, one for each block of documents."""
    row, h, start, count, anchor, hot = (np.concatenate(x) for x in zip(*found, strict=True))
    block = block_of(row, blocks)
    order = np.lexsort((row, block))
    row, h, start, count, anchor, hot, block = (x[order] for x in (row, h, start, count, anchor, hot, block))
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    ends = np.append(cuts[1:], len(row))
    return batch_of(NOTES, *map(list, zip(*[(block[i], 0, None, bundle(*runs_of(row[i:j]), h[i:j], start[i:j], count[i:j], anchor[i:j], hot[i:j])) for i, j in zip(cuts, ends, strict=True)], strict=True)))


def noted(blobs: list[bytes]) -> list[tuple]:
    """The arrays of notes of kind 0."""
    parts = [unbundle(x, np.int64, np.uint32, np.uint64, np.uint32, np.uint8, np.uint8, np.uint8) for x in blobs]
    return [(np.repeat(x[0], x[1]), *x[2:]) for x in parts]


def notes_again(blocks: int):
    """For applyInArrow by coarse block and group: NOTES rows of fine blocks."""
    return lambda table_: pa.Table.from_batches([note_batch(noted(table_["blob"].to_pylist()), blocks)])


def note_rows(blocks: int, most: int):
    """For mapInArrow over answered batches: the anchors that two documents share, by block of documents (kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            cols = batch.to_pydict()
            for payload, at_raw, hashes_raw, counts_raw in zip(cols["payload"], cols["at"], cols["hashes"], cols["counts"], strict=True):
                ids, times, place, start, count, anchor = unbundle(payload, np.int64, np.uint32, np.uint32, np.uint32, np.uint8, np.uint8)
                at, hashes = unpress_sorted(at_raw).astype(np.int64), unpress_sorted(hashes_raw)
                times = times.astype(np.int64)
                if not len(at):
                    continue
                own = ranges((np.cumsum(times) - times)[at], times[at])
                hot = (unpress(counts_raw, np.uint16) > most).astype(np.uint8)
                found.append((ids[place[own]], np.repeat(hashes, times[at]), start[own], count[own], anchor[own], np.repeat(hot, times[at])))
                held += len(own)
                if held > GATHER:
                    yield note_batch(found, blocks)
                    found, held = [], 0
        if found:
            yield note_batch(found, blocks)

    return run


def _docs(left: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, in order, their doc_ids, and bytes and offsets of the texts of a block; of equal rows the first.

    A block always has the same rows, so their places in this order name them.
    """
    rows = left["row"].to_numpy()
    rows, keep = np.unique(rows, return_index=True)
    data, offsets = buffer(left["text"].combine_chunks().take(pa.array(keep)))
    return rows, left["doc_id"].combine_chunks().fill_null(0).to_numpy()[keep], data, offsets


def apart(h: np.ndarray, count: np.ndarray, anchor: np.ndarray, begin: np.ndarray, hot: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments with those of hot anchors cut in two and keyed anew: of which note, hash, count, anchor, begin.

    Strings whose anchor has SIDE bytes before it go by those, the others by the SIDE bytes after it; either lie within
    the string, so equal strings still meet, while a common phrase in unlike surroundings spreads over many keys.
    """
    note = np.arange(len(h))
    cold, hot = np.flatnonzero(hot == 0), np.flatnonzero(hot)
    if not len(hot):
        return note, h, count, anchor, begin
    early = np.clip(anchor[hot] - SIDE + 1, 0, count[hot])
    parts = [(cold, h[cold], count[cold], anchor[cold], begin[cold])]
    for k, (skip, n) in enumerate(((np.zeros(len(hot), np.int64), early), (early, count[hot] - early))):
        some = np.flatnonzero(n > 0)
        of, skip, n = hot[some], skip[some], n[some]
        place = begin[of] + anchor[of] + (K if k else -SIDE)
        parts.append((of, mix64(h[of] ^ word_hashes(data, place, place + SIDE) + np.uint64(k)), n, anchor[of] - skip, begin[of] + skip))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def segment_rows(buckets: int):
    """For cogroup by block of documents and notes: distinct segments by bucket, with their least and last owners."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        kinds = right["kind"].to_numpy() if len(right) else np.zeros(0)
        blobs = right.filter(pa.array(kinds == 0))["blob"].to_pylist()
        if blobs and len(left):
            rows, ids, data, offsets = _docs(left)
            copies = right.filter(pa.array(kinds == 1))["doc"].to_numpy()
            row, h, start, count, anchor, hot = (np.concatenate(x) for x in zip(*noted(blobs), strict=True))
            keep = ~np.isin(row, copies)
            row, h, start, count, anchor, hot = row[keep], h[keep], start[keep].astype(np.int64), count[keep].astype(np.int64), anchor[keep].astype(np.int64), hot[keep]
            at = np.searchsorted(rows, row)
            note, h, count, anchor, begin = apart(h, count, anchor, offsets[at] + start, hot, data)
            at = at[note]
            doc, start = ids[at], begin - offsets[at]
            content = np.empty(len(h), np.uint64)
            for a, b in pieces(np.concatenate([[0], np.cumsum(count + SPAN - 1)])):
                content[a:b] = word_hashes(data, begin[a:b], begin[a:b] + count[a:b] + SPAN - 1)
            order = np.lexsort((doc, content, h))
            at, doc, h, start, count, anchor, begin, content = (x[order] for x in (at, doc, h, start, count, anchor, begin, content))
            for bucket, i, j in by_bucket(h, buckets):
                cuts = i + np.flatnonzero(np.append(True, (h[i + 1 : j] != h[i : j - 1]) | (content[i + 1 : j] != content[i : j - 1])))
                ends = np.append(cuts[1:], j)
                size = count[cuts] + SPAN - 1
                segments = bundle(h[cuts], count[cuts].astype(np.uint8), anchor[cuts].astype(np.uint8), doc[cuts], doc[ends - 1], content[cuts], data[ranges(begin[cuts], size)])
                out.append((bucket, left["block"][0].as_py(), segments, bundle((ends - cuts).astype(np.uint32), at[i:j].astype(np.uint32), doc[i:j], start[i:j].astype(np.uint32))))
        return pa.Table.from_batches([batch_of(SEGMENTS, *(map(list, zip(*out, strict=True)) if out else [[]] * 4))])

    return run


def _rank(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1].astype(np.uint64)


def sort_suffixes(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of text at starts in the order of their first SPAN bytes, and whether each differs from the one before it.

    text ends with 64 bytes to spare. The sample has the positions whose residue is in COVER. Ranks of 40 bytes at the
    sample come from ranks of 8, 16 and 32, as the sample is closed under steps of 8. A suffix is sorted by its first 8
    bytes; ties go by the rank at the next sampled position and by the last 8 bytes, which cover all of it. Suffixes
    of equal strings have equal residues, for segments are laid out with their anchors in step.
    """
    bytes_at = np.lib.stride_tricks.sliding_window_view(text, 8)
    word = lambda at: np.ascontiguousarray(bytes_at[at]).view(">u8").ravel().astype(np.uint64)
    groups = len(bytes_at) // PERIOD - 1
    sample = (np.arange(groups)[:, None] * PERIOD + COVER).ravel()
    n = len(COVER)
    late = lambda r, k: np.concatenate([r[n * k :], np.zeros(min(n * k, len(r)), np.uint64)])
    r8 = _rank(word(sample))
    r16 = _rank(r8 << np.uint64(32) | late(r8, 1))
    r32 = _rank(r16 << np.uint64(32) | late(r16, 2))
    r40 = _rank(r32 << np.uint64(32) | late(r8, 4))
    next_ = starts + STEP[starts % PERIOD]
    slot = np.searchsorted(COVER, next_ % PERIOD)
    tie = r40[next_ // PERIOD * n + slot] << np.uint64(3) | (starts % PERIOD).astype(np.uint64)
    head, tail = word(starts), word(starts + SPAN - 8)
    order = np.lexsort((tail, tie, head))
    new = np.ones(len(order), bool)
    new[1:] = (head[order[1:]] != head[order[:-1]]) | (tie[order[1:]] != tie[order[:-1]]) | (tail[order[1:]] != tail[order[:-1]])
    return order, new


def least_owner(count: np.ndarray, anchor: np.ndarray, least: np.ndarray, raw: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For the strings of distinct segments in turn, the least document that has the string."""
    size = count + SPAN - 1
    gap = -anchor % PERIOD
    room = (gap + size + PERIOD - 1) // PERIOD * PERIOD
    place = np.cumsum(room) - room + gap  # anchors in step
    text = np.zeros(int(room.sum()) + 64, np.uint8)
    text[ranges(place, size)] = raw[ranges(begin, size)]
    order, new = sort_suffixes(text, ranges(place, count))
    lead = np.flatnonzero(new)
    low = np.minimum.reduceat(np.repeat(least, count)[order], lead)
    found = np.empty(len(order), np.int64)
    found[order] = np.repeat(low, np.diff(np.append(lead, len(order))))
    return found


def repeated_runs(h: np.ndarray, count: np.ndarray, anchor: np.ndarray, least: np.ndarray, last: np.ndarray, content: np.ndarray, begin: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of strings that a document smaller than a segment's last owner has: segment, that document, first string, length.

    Segments are whole anchors, in order of h and content.
    """
    other = np.append(True, h[1:] != h[:-1])
    new = other | np.append(True, content[1:] != content[:-1])
    one, same, of = np.flatnonzero(new), np.cumsum(new) - 1, np.cumsum(other) - 1
    low, n = np.minimum.reduceat(least, one), count[one]
    strings, first = np.repeat(low, n), np.cumsum(n) - n
    todo = np.bincount(of, new)[of[one]] > 1  # an anchor whose segments are all alike needs no sorting
    if todo.any():
        pick = one[todo]
        strings[ranges(first[todo], n[todo])] = least_owner(count[pick], anchor[pick], low[todo], raw, begin[pick])
    seg = np.repeat(np.arange(len(h), dtype=np.int32), count)
    owner = strings[ranges(first[same], count)]
    j = ranges(np.zeros(len(count), np.int64), count)
    hit = np.flatnonzero(owner < last[seg])
    seg, owner, j = seg[hit], owner[hit], j[hit]
    if not len(seg):
        return seg, owner, j, j
    cut = np.flatnonzero(np.append(True, (seg[1:] != seg[:-1]) | (owner[1:] != owner[:-1]) | (j[1:] != j[:-1] + 1)))
    return seg[cut], owner[cut], j[cut], np.diff(np.append(cut, len(seg)))


KINDS = (np.uint64, np.uint8, np.uint8, np.int64, np.int64, np.uint64, np.uint8)


def _dealt(segments: list[bytes], fine: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Segments of many rows in the order of their fine buckets: columns, texts, these buckets, and the place of each among all."""
    parts = [unbundle(x, *KINDS) for x in segments]
    cols = [np.concatenate([p[i] for p in parts]) for i in range(6)]
    raw, size = np.concatenate([p[6] for p in parts]), cols[1].astype(np.int64) + SPAN - 1
    bucket = bucket_of(cols[0], fine)
    order = np.argsort(bucket, kind="stable")
    text = raw[ranges((np.cumsum(size) - size)[order], size[order])]
    return [c[order] for c in cols], np.split(text, np.cumsum(size[order])[:-1]) if len(order) else [], bucket[order], order


def _by_block(table_: pa.Table) -> tuple[list[int], list[bytes]]:
    """Blocks and segments of SEGMENTS rows in the order of blocks: a shuffle brings a group's rows in any order, another one each time."""
    order = np.argsort(table_["block"].to_numpy(), kind="stable").tolist()
    blocks, segments = table_["block"].to_pylist(), table_["segments"].to_pylist()
    return [blocks[i] for i in order], [segments[i] for i in order]


def segments_again(fine: int):
    """For applyInArrow by coarse bucket and group of blocks: its segments by fine bucket; the group stands for the block."""

    def run(table_: pa.Table) -> pa.Table:
        cols, texts, bucket, _ = _dealt(_by_block(table_)[1], fine)
        cuts, out, group = np.flatnonzero(np.diff(bucket, prepend=-1)), [], table_["group"][0].as_py()
        for i, j in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
            out.append((bucket[i], group, bundle(*(c[i:j] for c in cols), np.concatenate(texts[i:j]))))
        return pa.Table.from_batches([batch_of("bucket long, block long, segments binary", *map(list, zip(*out, strict=True)))])

    return run


def runs_back(fine: int):
    """For cogroup by coarse bucket and group, of blocks' segments and of the runs found in fine buckets: REPEATS rows of each block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            blocks, segments = _by_block(left)
            _, _, bucket, order = _dealt(segments, fine)
            sizes = [len(unbundle(x, *KINDS)[0]) for x in segments]
            found = []
            for at, raw in zip(right["fine"].to_pylist(), right["runs"].to_pylist(), strict=True):
                seg, owner, j, length = unbundle(raw, np.uint32, np.int64, np.uint8, np.uint8)
                found.append((order[np.searchsorted(bucket, at) + seg], owner, j, length))
            seg, owner, j, length = (np.concatenate(x) for x in zip(*found, strict=True))
            first = np.concatenate([[0], np.cumsum(sizes)])
            of = np.searchsorted(first, seg, "right") - 1
            by = np.argsort(of, kind="stable")
            seg, owner, j, length, of = (x[by] for x in (seg, owner, j, length, of))
            cuts = np.flatnonzero(np.diff(of, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(of)), strict=True):
                out.append((left["bucket"][0].as_py(), blocks[of[a]], bundle((seg[a:b] - first[of[a]]).astype(np.uint32), owner[a:b], j[a:b], length[a:b])))
        return pa.Table.from_batches([batch_of(REPEATS, *(map(list, zip(*out, strict=True)) if out else [[]] * 3))])

    return run


def repeats(segments: DataFrame, fan: Fan) -> DataFrame:
    """REPEATS rows of SEGMENTS rows, whose buckets are the coarse ones of fan."""
    light = segments.select("bucket", "block", "segments")
    if fan.per == 1:
        return light.groupBy("bucket").applyInArrow(find_repeats, REPEATS)
    grouped = light.withColumn("group", fan.group("block"))
    cut = grouped.groupBy("bucket", "group").applyInArrow(segments_again(fan.fine), "bucket long, block long, segments binary")
    found = cut.groupBy("bucket").applyInArrow(find_repeats, REPEATS)
    back = found.select(F.floor(F.col("bucket") / fan.per).cast("long").alias("bucket"), F.col("block").alias("group"), F.col("bucket").alias("fine"), "runs")
    return grouped.groupBy("bucket", "group").cogroup(back.groupBy("bucket", "group")).applyInArrow(runs_back(fan.fine), REPEATS)


def find_repeats(table_: pa.Table) -> pa.Table:
    """For applyInArrow by bucket: runs of strings of each block's segments that a smaller document than some owner has."""
    h, count, anchor, least, last, content, raw, begin, origin, number = ([] for _ in range(10))
    base = 0
    for k, blob in enumerate(table_["segments"]):
        a, b, c, d, e, f, g = unbundle(blob.as_py(), *KINDS)
        size = b.astype(np.int64) + SPAN - 1
        for x, y in zip((h, count, anchor, least, last, content, raw), (a, b.astype(np.int64), c.astype(np.int64), d, e, f, g), strict=True):
            x.append(y)
        begin.append(base + np.cumsum(size) - size)
        origin.append(np.full(len(a), k))
        number.append(np.arange(len(a)))
        base += len(g)
    h, count, anchor, least, last, content, raw, begin, origin, number = map(np.concatenate, (h, count, anchor, least, last, content, raw, begin, origin, number))
    order = np.lexsort((content, h))
    h, count, anchor, least, last, content, begin, origin, number = (x[order] for x in (h, count, anchor, least, last, content, begin, origin, number))
    cuts = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h))
    spent = np.concatenate([[0], np.cumsum(count + SPAN - 1)])[cuts]
    found = []
    for x, y in pieces(spent, PART):  # whole anchors, about PART bytes at a time
        a, b = cuts[x], cuts[y]
        part = repeated_runs(*(z[a:b] for z in (h, count, anchor, least, last, content, begin)), raw)
        found.append((part[0] + a, *part[1:]))
    seg, owner, j, length = (np.concatenate(x) for x in zip(*found, strict=True))
    out = []
    for k, block in enumerate(table_["block"]):
        mine = origin[seg] == k
        if mine.any():
            out.append((table_["bucket"][0].as_py(), block.as_py(), bundle(number[seg[mine]].astype(np.uint32), owner[mine], j[mine].astype(np.uint8), length[mine].astype(np.uint8))))
    return pa.Table.from_batches([batch_of(REPEATS, *(map(list, zip(*out, strict=True)) if out else [[]] * 3))])


def removal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over owners and runs: what goes from each document, by block (kind 2)."""
    for batch in batches:
        out, cols = [], batch.to_pydict()
        for block, owners, runs in zip(cols["block"], cols["owners"], cols["runs"], strict=True):
            times, at, doc, start = unbundle(owners, np.uint32, np.uint32, np.int64, np.uint32)
            seg, owner, j, length = unbundle(runs, np.uint32, np.int64, np.uint8, np.uint8)
            times = times.astype(np.int64)
            own = ranges((np.cumsum(times) - times)[seg], times[seg])
            of = np.repeat(np.arange(len(seg)), times[seg])
            later = doc[own] > owner[of]
            own, of = own[later], of[later]
            out.append((block, 2, None, bundle(at[own], start[own] + j[of].astype(np.uint32), length[of])))
        if out:
            yield batch_of(NOTES, *map(list, zip(*out, strict=True)))


def _gone(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows of a block, their bytes and offsets, and which bytes go."""
    rows, _, data, offsets = _docs(left)
    size = np.diff(offsets)
    kinds = right["kind"].to_numpy() if len(right) else np.zeros(0)
    edges = np.zeros(len(data) + 1, np.int32)
    copies = np.searchsorted(rows, right.filter(pa.array(kinds == 1))["doc"].to_numpy()) if len(right) else np.zeros(0, np.int64)
    copies = np.unique(copies[size[copies] >= SPAN])
    np.add.at(edges, offsets[copies], 1)
    np.add.at(edges, offsets[copies + 1], -1)
    for blob in right.filter(pa.array(kinds == 2))["blob"].to_pylist() if len(right) else ():
        place, start, length = unbundle(blob, np.uint32, np.uint32, np.uint8)
        at = offsets[place] + start
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length.astype(np.int64) + SPAN - 1, -1)
    return rows, data, offsets, np.cumsum(edges[:-1]) > 0


def remover(with_text: bool):
    """For cogroup by block of documents and notes: RESULT rows, with what is left of the text if asked for."""
    ddl = RESULT + (", kept binary" if with_text else "")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left):
            rows, data, offsets, gone = _gone(left, right)
            begins = gone & np.append(True, ~gone[:-1])[: len(gone)]
            inner = offsets[:-1][np.diff(offsets) > 0]
            begins[inner] = gone[inner]
            upto, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begins))
            kept = data[~gone].tobytes()
            keep_upto = np.arange(len(upto)) - upto
            for doc, i in zip(left["doc_id"].to_pylist(), np.searchsorted(rows, left["row"].to_numpy()).tolist(), strict=True):
                a, b = offsets[i], offsets[i + 1]
                own = kept[keep_upto[a] : keep_upto[b]]
                out.append((doc, b - a, upto[b] - upto[a], spans[b] - spans[a], hashlib.sha256(own).hexdigest(), *([own] if with_text else [])))
        return pa.Table.from_batches([batch_of(ddl, *(map(list, zip(*out, strict=True)) if out else [[]] * len(ddl.split(","))))])

    return run, ddl


def remove_repeats(docs: DataFrame, with_text: bool = True, hot: int = HOT, fan_out: int = FAN) -> DataFrame:
    """RESULT rows of docs: each document without the bytes of SPAN-byte strings that a document of smaller doc_id has.

    with_text adds the bytes that are left, as kept; hot (at most 65534) is what HOT says, fan_out what FAN of packed says. Strings are judged on the input. Nulls count as empty. Whole copies
    are found by their digest first; a copy of at least SPAN bytes goes whole. Every row has its own result: rows of one
    doc_id with unlike texts take nothing from each other, equal rows fare alike, and a row without a doc_id, which no
    order places, stays whole and takes nothing from others. Rows go by a 64-bit hash of doc_id and text. Other columns
    are ignored; an empty table gives no rows.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = own.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    digest = materialise(rows.filter("doc_id is not null").select("row", "doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("n")), "suffix-digests")
    fan = Fan(2 * buckets_for(digest.agg(F.sum("n")).first()[0]), fan_out, 4 << 20)
    blocks = fan.fine
    packed = materialise(rows.filter("doc_id is not null").select("row", "text").mapInArrow(anchor_rows(fan.coarse), PACKED), "suffix-anchors")
    answer = materialise(shared(packed, fan), "suffix-answer")
    answered = packed.select("bucket", "batch", "payload").join(answer, ["bucket", "batch"])
    notes = answered.select("payload", "at", "hashes", "counts").mapInArrow(note_rows(fan.coarse, hot), NOTES)
    if fan.per > 1:
        notes = notes.withColumn("group", fan.group("blob")).groupBy("block", "group").applyInArrow(notes_again(blocks), NOTES)
    notes = materialise(notes, "suffix-notes")
    drop(packed, answer)
    salted = with_salt(digest, "row")
    cells = salted.groupBy("sha", "salt").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    first = cells.groupBy("sha").agg(F.min("least").alias("first"), F.max("most").alias("last")).filter("first < last").select("sha", "first")
    first = cells.select("sha", "salt").join(first, "sha")
    later = salted.join(first, ["sha", "salt"]).filter("doc_id > first").select(block_column("row", blocks).alias("block"), F.lit(1).alias("kind"), F.col("row").alias("doc"), F.lit(None).cast("binary").alias("blob"))
    later = materialise(later, "suffix-copies")
    placed = rows.withColumn("block", block_column("row", blocks)).select("block", "row", "doc_id", "text").groupBy("block")
    segments = materialise(placed.cogroup(notes.unionByName(later).groupBy("block")).applyInArrow(segment_rows(fan.coarse), SEGMENTS), "suffix-segments")
    drop(notes, digest)
    runs = materialise(repeats(segments, fan), "suffix-runs")
    gone = materialise(segments.select("bucket", "block", "owners").join(runs, ["bucket", "block"]).select("block", "owners", "runs").mapInArrow(removal_rows, NOTES), "suffix-removals")
    drop(segments, runs)
    return placed.cogroup(gone.unionByName(later).groupBy("block")).applyInArrow(*remover(with_text))


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)

"""FLAC columns: mono 8-bit streams written and read for many rows at once, all their frames in step."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import batch_of, buffer, configure, pieces, ranges, table, text_of

#: Samples in a frame, the rate that headers state, and to what multiple of bytes payloads are padded.
BLOCK, RATE, UNIT = 1024, 8000, 64
#: Bits of a predictor's coefficient and of its shift.
PRECISION, SHIFT = 8, 5
ENCODED = "doc_id long, n_bytes long, media binary"
BLOCKS = "doc_id long, block long, sample_offset long, n_samples long, pcm binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_blocks long"
FIXED = np.array([[0, 0, 0, 0], [1, 0, 0, 0], [2, -1, 0, 0], [3, -3, 1, 0], [4, -6, 4, -1]], np.int32)
_ZEROS = np.array([16 - int(x).bit_length() for x in range(1 << 16)], np.uint8)
_crc: dict = {}


def _crc_table(bits: int, poly: int, length: int) -> np.ndarray:
    """Row d: the check value of each byte followed by d zero bytes. Check values are linear, so they add up by xor."""
    have = _crc.get(bits)
    if have is None or len(have) < length:
        top, mask = 1 << (bits - 1), (1 << bits) - 1
        one = np.arange(256, dtype=np.uint32) << (bits - 8)
        for _ in range(8):
            one = np.where(one & top, one << 1 ^ poly, one << 1) & mask
        rows = np.empty((max(length, 1200), 256), np.uint16)
        row = one
        for d in range(len(rows)):
            rows[d] = row
            row = (row << 8 & mask) ^ one[row >> (bits - 8)]
        _crc[bits] = have = rows
    return have


def crc(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int, poly: int) -> np.ndarray:
    """The check value of each run data[start:end]."""
    if not len(starts):
        return np.zeros(0, np.uint16)
    size = ends - starts
    table_ = _crc_table(bits, poly, int(size.max()))
    first = np.cumsum(size) - size
    left = np.repeat(size, size) - 1 - ranges(np.zeros(len(size), np.int64), size)
    return np.bitwise_xor.reduceat(table_[left, data[ranges(starts, size)]], first)


class _Bits:
    """A row of bits that fields are put into, many at a time."""

    def __init__(self, n: int):
        self.bits = np.zeros(n, np.uint8)

    def put(self, at: np.ndarray, value: np.ndarray, width: int) -> np.ndarray:
        value = np.broadcast_to(np.asarray(value, np.int64), at.shape)
        for j in range(width):
            self.bits[at + j] = value >> (width - 1 - j) & 1
        return at + width


def _utf8(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The coded frame number, as a value and its count of bytes."""
    size = 1 + (number >= 0x80) + (number >= 0x800) + (number >= 0x10000) + (number >= 0x200000)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0, 0xF8])[size]
    out = np.where(size == 1, number, lead | number >> np.minimum(6 * (size - 1), 62))
    for k in range(4, 0, -1):
        out = np.where(size > k, out << 8 | 0x80 | number >> 6 * (k - 1) & 0x3F, out)
    return out, size


def encode_frames(samples: np.ndarray, starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all frames in turn and their sizes. Each takes the cheapest of three predictors, or none."""
    n = len(starts)
    x = samples.astype(np.int32)
    index = np.repeat(np.arange(n, dtype=np.int32), sizes)
    one, two = np.concatenate([[0], x[:-1]]).astype(np.int32), np.concatenate([[0, 0], x[:-2]]).astype(np.int32)
    second = starts[sizes > 1] + 1
    one[starts], two[starts], two[second] = 0, 0, 0
    r0, r1, r2 = (np.add.reduceat(x * z, starts).astype(np.float64) for z in (x, one, two))
    det = r0 * r0 - r1 * r1 + 1e-9
    most = (1 << (PRECISION - 1)) - 1
    coef = np.clip(np.round(np.stack([r1 * (r0 - r2), r0 * r2 - r1 * r1], axis=1) / det[:, None] * (1 << SHIFT)), -most, most).astype(np.int32)
    residuals = [x, x - one, x - ((coef[index, 0] * one + coef[index, 1] * two) >> SHIFT)]
    orders, cost, params, coded = [0, 1, 2], [], [], []
    for r, order in zip(residuals, orders, strict=True):
        zz = r << 1 ^ r >> 31  # 0, -1, 1, -2 ... as 0, 1, 2, 3 ...
        if order:
            zz[starts] = 0
        if order > 1:
            zz[second] = 0
        total, left = np.add.reduceat(zz, starts), np.maximum(sizes - order, 0)
        k = np.clip(np.floor(np.log2(np.maximum(total / np.maximum(left, 1) * 0.75, 1))), 0, 14).astype(np.int32)
        cost.append((total >> k) + (k + 1) * left + 8 * order + (9 + 2 * PRECISION) * (order == 2))
        params.append(k)
        coded.append(zz)
    cost = np.stack(cost)
    best = cost.argmin(axis=0).astype(np.int32)
    constant = np.minimum.reduceat(samples, starts) == np.maximum.reduceat(samples, starts)
    plain = (cost.min(axis=0) + 10 >= 8 * sizes) & ~constant
    rice = ~plain & ~constant
    order = np.where(rice, best, 0)
    k = np.stack(params)[best, np.arange(n)]
    mine = best[index]
    zz = np.where(mine == 0, coded[0], np.where(mine == 1, coded[1], coded[2]))
    skip = ~rice[index]
    skip[starts[order > 0]] = True
    skip[starts[order > 1] + 1] = True
    keep = np.flatnonzero(~skip)
    zz, own = zz[keep], index[keep]
    kk = k[own]
    length = (zz >> kk) + 1 + kk
    spent = np.bincount(own, length, n).astype(np.int64)
    coded_number, number_size = _utf8(numbers.astype(np.int64))
    whole = sizes == BLOCK
    head = 4 + number_size + np.where(whole, 0, 2) + 1
    before = 8 + np.where(rice, 10 + 8 * order + (9 + 2 * PRECISION) * (order == 2), 0)
    body = before + np.where(constant, 8, np.where(plain, 8 * sizes, spent))
    size = head + (body + 7) // 8 + 2
    begin = np.cumsum(size) - size
    out = _Bits(8 * int(size.sum()))
    code = 8 * (begin + head) + before - (np.cumsum(spent) - spent)  # where a frame's codes begin, less all codes before
    ends = np.cumsum(length) + code[own]
    value = (1 << kk) | zz & ((1 << kk) - 1)
    # From the highest bit down: what a short code writes too far left is written over by the codes and fields there.
    for j in range(int(kk.max(initial=-1)), -1, -1):
        out.bits[ends - 1 - j] = value >> j & 1
    at = out.put(8 * begin, 0xFFF8, 16)
    at = out.put(at, np.where(whole, 10, 7), 4)
    at = out.put(at, 4, 4)
    at = out.put(at, 1 << 1, 8)
    for m in np.unique(number_size):
        mine = number_size == m
        out.put(at[mine], coded_number[mine], 8 * int(m))
    at = at + 8 * number_size
    out.put(at[~whole], sizes[~whole] - 1, 16)
    at = 8 * (begin + head)
    at = out.put(at, np.where(constant, 0, np.where(plain, 1, np.where(order == 2, 32 + 1, 8 + order))) << 1, 8)
    out.put(at[constant], x[starts[constant]] & 255, 8)
    for p in np.flatnonzero(plain):
        out.bits[at[p] : at[p] + 8 * sizes[p]] = np.unpackbits((x[starts[p] : starts[p] + sizes[p]] & 255).astype(np.uint8))
    for j in range(2):
        mine = order > j
        out.put((at + 8 * j)[mine], x[starts[mine] + j] & 255, 8)
    at = at + 8 * order
    linear = np.flatnonzero(order == 2)
    p = out.put(at[linear], PRECISION - 1, 4)
    p = out.put(p, SHIFT, 5)
    for j in range(2):
        p = out.put(p, coef[linear, j] & ((1 << PRECISION) - 1), PRECISION)
    at[linear] = p
    out.put(at[rice], k[rice], 10)
    raw = np.packbits(out.bits)
    raw[begin + head - 1] = crc(raw, begin, begin + head - 1, 8, 0x07)
    check = crc(raw, begin, begin + size - 2, 16, 0x8005)
    raw[begin + size - 2], raw[begin + size - 1] = check >> 8, check & 255
    return raw, size


def encode(payload: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A FLAC stream for each row of 8-bit samples, with a seek point for every frame."""
    length = np.diff(offsets)
    count = -(-length // BLOCK)
    number = ranges(np.zeros(len(count), np.int64), count)
    row = np.repeat(np.arange(len(count)), count)
    starts = offsets[:-1][row] + number * BLOCK
    sizes = np.minimum(BLOCK, offsets[1:][row] - starts)
    raw, frame = encode_frames((payload.astype(np.int16) - 128).astype(np.int8), starts, sizes, number)
    ends = np.cumsum(frame)
    first = np.cumsum(count) - count
    points = np.zeros(len(number), [("sample", ">u8"), ("byte", ">u8"), ("size", ">u2")])
    points["sample"], points["size"] = number * BLOCK, sizes
    points["byte"] = (ends - frame) - np.repeat((ends - frame)[first], count)
    data, seek, signed = raw.tobytes(), points.tobytes(), (payload ^ 128).tobytes()
    out = []
    for i in range(len(length)):
        a, b = first[i], first[i] + count[i]
        smallest, largest = int(frame[a:b].min()), int(frame[a:b].max())
        least = int(sizes[a:b][:-1].min()) if b - a > 1 else int(sizes[a])
        packed = RATE << 44 | 7 << 36 | int(length[i])
        info = least.to_bytes(2, "big") + int(sizes[a:b].max()).to_bytes(2, "big") + smallest.to_bytes(3, "big") + largest.to_bytes(3, "big") + packed.to_bytes(8, "big")
        info += hashlib.md5(signed[offsets[i] : offsets[i + 1]]).digest()
        table_ = seek[18 * a : 18 * b]
        out.append(b"fLaC\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table_).to_bytes(3, "big") + table_ + data[ends[a] - frame[a] : ends[b - 1]])
    return out


class Corrupt(ValueError):
    """A stream that breaks the format, a check value or its digest, or that isn't mono with 8 bits."""


def decode_frames(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Samples of all frames in turn, their sizes and numbers. Frames decode in step: sample t of each at a time."""
    if crc(data, starts, ends, 16, 0x8005).any():
        raise Corrupt("a frame's check value is wrong")
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    if (padded[starts] != 0xFF).any() or (padded[starts + 1] & 0xFE != 0xF8).any() or (padded[starts + 3] & 0xFE != 2).any():
        raise Corrupt("not a frame of one channel with 8 bits")
    code, rate = padded[starts + 2] >> 4, padded[starts + 2] & 15
    lead = padded[starts + 4].astype(np.int64)
    more = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [0, 1, 2, 3, 4, 5], 6)
    number = np.where(more == 0, lead, lead & (0x3F >> more))
    for j in range(1, 7):
        number = np.where(more >= j, number << 6 | padded[np.minimum(starts + 4 + j, len(padded) - 1)] & 0x3F, number)
    at = starts + 5 + more
    size = np.where(code >= 8, 256 << (code.astype(np.int64) & 7), np.where(code == 1, 192, 576 << np.clip(code.astype(np.int64) - 2, 0, 3)))
    size = np.where(code == 6, padded[at] + 1, np.where(code == 7, (padded[at].astype(np.int64) << 8 | padded[at + 1]) + 1, size))
    at = at + np.select([code == 6, code == 7], [1, 2], 0) + np.select([rate == 12, (rate == 13) | (rate == 14)], [1, 2], 0)
    if (crc(data, starts, at, 8, 0x07) != padded[at]).any():
        raise Corrupt("a frame header's check value is wrong")
    kind = padded[at + 1] >> 1
    if (padded[at + 1] & 0x81).any():
        raise Corrupt("a subframe with wasted bits")
    order = np.select([kind >= 32, (kind >= 8) & (kind <= 12)], [kind - 31, kind - 8], 0).astype(np.int64)
    rank = np.argsort(-size, kind="stable")
    at, kind, order, size_ = at[rank] + 2, kind[rank], order[rank], size[rank]
    n, most = len(rank), int(size.max())
    word = padded[:-3].astype(np.uint32) << 24 | padded[1:-2].astype(np.uint32) << 16 | padded[2:-1].astype(np.uint32) << 8 | padded[3:]
    end_word = len(word) - 1
    bit = 8 * at

    def look(where: np.ndarray) -> np.ndarray:
        return word[np.minimum(where >> 3, end_word)] << (where & 7).astype(np.uint32)

    out = np.zeros((most, n), np.int32)
    plain, constant = np.flatnonzero(kind == 1), np.flatnonzero(kind == 0)
    for i in plain:
        out[: size_[i], i] = padded[at[i] : at[i] + size_[i]].view(np.int8)
    out[:, constant] = padded[at[constant]].view(np.int8)
    if ((kind > 1) & (kind < 8) | (kind > 12) & (kind < 32)).any():
        raise Corrupt("a subframe of a reserved kind")
    rice = np.flatnonzero(kind > 1)
    bit, order, lengths, kinds = bit[rice], order[rice], size_[rice], kind[rice]
    width = max(4, int(order.max(initial=0)))
    coef, shift = np.zeros((width, len(rice)), np.int32), np.zeros(len(rice), np.int32)
    for j in range(int(order.max(initial=0))):
        own = np.flatnonzero(order > j)
        out[j, rice[own]] = (look(bit[own]) >> 24).astype(np.uint8).view(np.int8)
        bit[own] += 8
    fixed = np.flatnonzero(kinds < 32)
    coef[:4, fixed] = FIXED[order[fixed]].T
    linear = np.flatnonzero(kinds >= 32)
    if len(linear):
        head = look(bit[linear])
        precision = (head >> 28).astype(np.int64) + 1
        shift[linear] = (head >> 23 & 31).astype(np.int32)
        bit[linear] += 9
        for j in range(int(order[linear].max())):
            own = order[linear] > j
            value = (look(bit[linear[own]]) >> (32 - precision[own]).astype(np.uint32)).astype(np.int64)
            coef[j, linear[own]] = np.where(value >> (precision[own] - 1) & 1, value - (1 << precision[own]), value)
            bit[linear[own]] += precision[own]
    head = look(bit)
    if (head >> 30).any():
        raise Corrupt("residuals of another coding")
    part = lengths >> (head >> 26 & 15).astype(np.int64)
    bit += 6
    k, raw_bits = np.zeros(len(rice), np.uint32), np.zeros(len(rice), bool)
    deepest = int(order.max(initial=0))
    all_rice = len(rice) == n
    for t in range(int(lengths.max(initial=0))):
        m = int(np.searchsorted(-lengths, -t, "left"))
        live = slice(0, m)
        fresh = np.flatnonzero((t == order[live]) | (t > order[live]) & (t % np.maximum(part[live], 1) == 0)) if t <= deepest or (part[live] < lengths[live]).any() else ()
        if len(fresh):
            k[fresh] = look(bit[fresh]) >> 28
            bit[fresh] += 4
            raw_bits[fresh] = k[fresh] == 15
            if raw_bits[fresh].any():
                raise Corrupt("escaped residuals")
        v = look(bit[live])
        q = _ZEROS[v >> 16].astype(np.int64)
        if (far := np.flatnonzero(q == 16)).size:
            while far.size:
                again = _ZEROS[look(bit[far] + q[far]) >> 16].astype(np.int64)
                q[far] += again
                far = far[again == 16]
                if far.size and q[far].max() > 1 << 20:
                    raise Corrupt("an endless residual")
        after = bit[live] + q + 1
        kk = k[live]
        low = (look(after) >> 1 >> (np.uint32(31) - kk)).astype(np.int64)
        coded = (q << kk.astype(np.int64) | low).astype(np.int32)
        value = (coded >> 1) ^ -(coded & 1)
        target = out[t, :m] if all_rice else out[t, rice[:m]]
        if t < deepest:
            ready = t >= order[live]
            value = np.where(ready, value, target)
            bit[live] = np.where(ready, after + kk, bit[live])
        else:
            bit[live] = after + kk
            ready = None
        guess = 0
        for j in range(min(t, deepest)):
            before = out[t - 1 - j, :m] if all_rice else out[t - 1 - j, rice[:m]]
            guess = guess + coef[j, :m] * before
        guess = guess >> shift[:m] if deepest and t else 0
        value = np.where(ready, value + guess, value) if ready is not None else value + guess
        if all_rice:
            out[t, :m] = value
        else:
            out[t, rice[:m]] = value
    back = np.argsort(rank, kind="stable")
    rows = out.T[back]
    return rows[np.arange(most) < size[:, None]].astype(np.int8), size, number


def decode(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Samples as bytes and their offsets by stream; sizes and counts of the frames. Seek points locate the frames."""
    starts, ends, counts, base, digests, totals = [], [], [], 0, [], []
    for s in streams:
        if s[:4] != b"fLaC":
            raise Corrupt("no stream marker")
        at, last, points = 4, False, None
        while not last:
            last, kind, size = bool(s[at] & 0x80), s[at] & 0x7F, int.from_bytes(s[at + 1 : at + 4], "big")
            if kind == 0:
                totals.append(int.from_bytes(s[at + 14 : at + 22], "big") & (1 << 36) - 1)
                digests.append(s[at + 22 : at + 38])
            elif kind == 3:
                points = np.frombuffer(s, [("sample", ">u8"), ("byte", ">u8"), ("size", ">u2")], size // 18, at + 4)
            at += 4 + size
        if points is None or not len(points) or int(points["size"].sum()) != totals[-1]:
            raise Corrupt("a stream without a seek point for every frame")
        if (points["sample"] != np.cumsum(points["size"].astype(np.int64)) - points["size"]).any() or points["byte"][0] or (np.diff(points["byte"].astype(np.int64)) <= 0).any():
            raise Corrupt("seek points that don't follow one another")
        first = points["byte"].astype(np.int64) + base + at
        starts.append(first)
        ends.append(np.append(first[1:], base + len(s)))
        counts.append(len(first))
        base += len(s)
    data = np.frombuffer(b"".join(streams), np.uint8)
    samples, size, number = decode_frames(data, np.concatenate(starts), np.concatenate(ends))
    counts = np.array(counts)
    if (number != ranges(np.zeros(len(counts), np.int64), counts)).any():
        raise Corrupt("frames out of order")
    upto = np.concatenate([[0], np.cumsum(size)])
    offsets = upto[np.concatenate([[0], np.cumsum(counts)])]
    signed = samples.view(np.uint8)
    raw = signed.tobytes()
    for i, (digest, total) in enumerate(zip(digests, totals, strict=True)):
        if offsets[i + 1] - offsets[i] != total or hashlib.md5(raw[offsets[i] : offsets[i + 1]]).digest() != digest:
            raise Corrupt("the samples don't match the stream's digest")
    return signed ^ 128, offsets, size, counts


def pad(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows padded with bytes 0 to a positive multiple of UNIT."""
    length = np.diff(offsets)
    padded = np.maximum(-(-length // UNIT), 1) * UNIT
    upto = np.concatenate([[0], np.cumsum(padded)])
    out = np.zeros(int(upto[-1]), np.uint8)
    out[ranges(upto[:-1], length)] = data
    return out, upto


def media_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffer(batch.column(1))
        for a, b in pieces(offsets, 1 << 20):
            payload, upto = pad(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield batch_of(ENCODED, batch.column(0)[a:b], np.diff(offsets[a : b + 1]), encode(payload, upto))


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets = buffer(batch.column(1))
        for a, b in pieces(offsets):
            samples, _, size, counts = decode(batch.column(1)[a:b].to_pylist())
            ends = np.cumsum(size)
            raw = samples.tobytes()
            block = ranges(np.zeros(len(counts), np.int64), counts)
            row = np.repeat(np.arange(b - a), counts)
            first = (ends - size)[(np.cumsum(counts) - counts)[row]]
            pcm = [raw[x:y] for x, y in zip((ends - size).tolist(), ends.tolist(), strict=True)]
            yield batch_of(BLOCKS, batch.column(0)[a:b].take(pa.array(row)), block, ends - size - first, size, pcm)


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets = buffer(batch.column(2))
        for a, b in pieces(offsets):
            media = batch.column(2)[a:b].to_pylist()
            samples, upto, _, counts = decode(media)
            raw, x, n = samples.tobytes(), samples.astype(np.float64) - 128, np.diff(upto)
            total, square = np.add.reduceat(x, upto[:-1]), np.add.reduceat(x * x, upto[:-1])
            turn = np.append(False, (samples[1:] ^ samples[:-1]) >= 128)
            turn[upto[:-1]] = False
            turns = np.add.reduceat(turn.astype(np.int64), upto[:-1])
            low, high = np.minimum.reduceat(samples, upto[:-1]), np.maximum.reduceat(samples, upto[:-1])
            feature = [f"mean={t / m:.4f};rms={(s / m) ** 0.5:.4f};turns={c};low={l - 128};high={h - 128}" for t, s, m, c, l, h in zip(total, square, n, turns, low.astype(int), high.astype(int), strict=True)]
            rows = [raw[i:j] for i, j in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
            yield batch_of(
                FEATURES, batch.column(0)[a:b], batch.column(1)[a:b], n, [hashlib.sha256(r).hexdigest() for r in rows], [zlib.crc32(r[-64:]) for r in rows],
                [len(m) for m in media], [hashlib.sha256(m).hexdigest() for m in media], feature, counts,
            )


def encode_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media, the FLAC stream of the text's bytes padded with 0 to a positive multiple of 64.

    Null and empty texts give a stream of 64 samples. Repeated rows are kept, equal texts have equal streams, and
    other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(media_rows, ENCODED)


def decode_media(media: DataFrame) -> DataFrame:
    """A row per PCM block of each stream: doc_id, block, sample_offset to seek by, n_samples and the samples as bytes.

    Check values of headers and frames and the stream's digest are verified; a stream that fails raises Corrupt.
    """
    return media.filter("media is not null").select("doc_id", "media").mapInArrow(block_rows, BLOCKS)


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of each stream's samples as read back: FEATURES rows."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(feature_rows, FEATURES)


def op4_media(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    return media_features(encode_media(table(spark, sf_dir, "documents")))

"""Planning of scales, task shapes and shard bits: plain arithmetic, done once on the driver."""

from __future__ import annotations

import math
from dataclasses import dataclass

from stratavox.operators.pool import AXIS_FACTOR

Triple = tuple[int, int, int]


def levels_that_fit(shape: Triple, factor: Triple, chunk: Triple, volume: Triple) -> int:
    """How many downsamples of a task's shape still fill whole chunks; one more where the volume is smaller than a chunk."""
    used = [i for i in range(3) if factor[i] != 1]
    if not used:
        return 0
    room = min(math.log(shape[i] / chunk[i], factor[i]) for i in used) + 1e-4
    if room < 1e-4:
        return 0
    whole = math.floor(room)
    small = all(volume[i] / factor[i] ** math.ceil(room) < chunk[i] for i in used)
    return whole + (small and room - whole > 0.05)


def decimals(x: float) -> int:
    """Digits after the point of a number."""
    text = f"{x}"
    return len(text.partition(".")[2]) if not float(x).is_integer() else 0


def resolutions(base: tuple, shape: Triple, chunk: Triple, volume: Triple, factor: Triple | None = None, axis: str = "z") -> list[tuple]:
    """The resolution of each further level, rounded to the digits of the first."""
    factor = factor or AXIS_FACTOR[axis]
    shape = tuple(min(a, b) for a, b in zip(shape, volume, strict=True))
    digits = max(map(decimals, base))
    out, now = [], base
    for _ in range(levels_that_fit(shape, factor, chunk, volume)):
        now = tuple(round(r * f, digits) if digits else int(r * f) for r, f in zip(now, factor, strict=True))
        out.append(now)
    return out


def plane_scales(size: Triple, keep: str = "z", most: float = 64, least: int = 128, scales: float = math.inf) -> list[Triple]:
    """Halvings of the two axes other than `keep` while the shorter stays at least `least` long."""
    k = "xyz".index(keep)
    side = min(size[i] for i in range(3) if i != k)
    if min(size) <= 0 or side < least:
        return [(1, 1, 1)]
    count = int(min(math.log2(side / least), scales, math.log2(most)))
    return [tuple(1 if i == k else 2**n for i in range(3)) for n in range(count + 1)]


def isotropic_scales(size: Triple, voxel: tuple, axes: tuple[int, ...] = (0, 1, 2), most: float = 64, least: float = 128, scales: float = math.inf) -> list[Triple]:
    """Scales that bring voxels near to cubes: the finest axis doubles, and each other that thereby comes nearer to it."""
    out = [(1, 1, 1)]
    while len(out) < scales:
        now = out[-1]
        if math.prod(now) >= most or any(s / n <= least or s % n for s, n in zip(size, now, strict=True)):
            break
        width = [v * n for v, n in zip(voxel, now, strict=True)]
        finest = min(axes, key=lambda i: width[i])
        goal = 2 * width[finest]
        double = {i for i in axes if i == finest or abs(2 * width[i] - goal) < abs(width[i] - goal)}
        out.append(tuple(n * 2 if i in double else n for i, n in enumerate(now)))
    return out


def flat_scales(size: Triple, voxel: tuple, most: float = 64, least: float = 128, scales: int = 10) -> list[tuple]:
    """Scales of the xy, xz and yz tiles together, until each of them is small enough."""
    each = [isotropic_scales(size, voxel, axes, math.inf, 0, min(scales, 10)) for axes in ((0, 1), (0, 2), (1, 2))]
    more = lambda s: math.prod(s) < most and max(a / b for a, b in zip(size, s, strict=True)) > least
    out = []
    for level in zip(*each, strict=False):
        if out and not any(map(more, level)):
            break
        out.append(level)
    return out


def pyramid_bytes(volume: float, factor: Triple) -> float:
    """Bytes of a level with all levels below it."""
    f = math.prod(factor)
    return volume * f / (f - 1)


def shape_for_memory(width: int, chunk: Triple, factor: Triple, target: float, most: float = math.inf) -> Triple:
    """The largest task shape, a power of two of chunks each way, whose pyramid stays within the target of bytes."""
    if target <= 0 or min(chunk) <= 0:
        raise ValueError(f"no shape for {target} bytes and chunks of {chunk}")
    if factor == (1, 1, 1):
        n = int(math.sqrt(target / width / math.prod(chunk)))
        out = (n * chunk[0], int(n * chunk[0] / chunk[1]) * chunk[1], chunk[2])
    elif factor in ((2, 2, 1), (2, 2, 2)):
        axes = [i for i in range(3) if factor[i] == 2]
        side = math.prod(chunk[i] for i in axes)
        if side == 1:
            n = int(math.log2(round((target / (1 if len(axes) == 3 else chunk[2])) ** (1 / len(axes)), 5)))
            out = tuple(2**n if i in axes else chunk[i] for i in range(3))
        else:
            voxels = target / pyramid_bytes(1, factor) / width / (1 if len(axes) == 3 else chunk[2])
            share = math.log2(voxels) / math.log2(side)  # each axis gets its own length to this power
            grown = lambda c: c * 2 ** int(min(math.log2(c) * (share - 1), most))
            out = tuple(grown(chunk[i]) if i in axes else chunk[i] for i in range(3))
    else:
        raise ValueError(f"no rule for the factor {factor}")
    if any(a < b for a, b in zip(out, chunk, strict=True)):
        raise ValueError(f"{target} bytes do not hold a chunk of {chunk}")
    return out


def levels_for_memory(target: float, width: int, chunk: Triple, channels: int, factor: Triple) -> int:
    """How many levels a task can build within the target of bytes; at least one."""
    chunks = target / width / channels // math.prod(chunk)
    side = pyramid_chunks = chunks / pyramid_bytes(1, factor)
    if pyramid_chunks <= 0:
        return 1
    side = pyramid_chunks ** (1 / math.log2(math.prod(factor)))
    levels = math.log2(side)
    return max(1, math.ceil(levels) if math.ceil(levels) - levels <= 0.01 else int(levels))


def hashed_shard_bits(labels: int, shard_index: int = 2**13, minishard_index: int = 2**15, least: int = 1) -> Triple:
    """(shard, minishard, preshift) bits for evenly hashed labels, by how large the two kinds of index may grow.

    An entry of a shard index is two words of 8 bytes, one of a minishard index three. A shard may be a tenth fuller
    than that where the next number of shards would leave them half empty.
    """
    if labels <= 0:
        return 0, 0, 0
    minis, per_mini = shard_index / 16, minishard_index / 24
    up = lambda x: max(0, math.ceil(math.log2(x)))
    full = labels >= minis * per_mini
    mini = up(minis) if full else up(labels / per_mini) if labels >= per_mini else 0
    shard = up(labels / (per_mini * 2 ** up(minis))) if full else 0
    if labels / (minis * per_mini * 2**shard) <= 0.55:
        shard = max(shard - 1, 0)
    more = max(0, round(math.log2(least)) - shard)
    return shard + more, max(0, mini - more), 0


@dataclass(frozen=True)
class ShardSpec:
    """Bits of a Morton code, from the low end: preshift, minishard, shard."""

    preshift: int
    minishard: int
    shard: int


def image_shard_spec(size: Triple, chunk: Triple, width: int, target: float = 3.5e9, per_minishard: int = 4000, shard_index: int = 8192) -> ShardSpec:
    """Bits by which the chunks of an image are grouped into shards of at most the target of bytes."""
    grid = [-(-s // c) for s, c in zip(size, chunk, strict=True)]
    total = sum(math.ceil(math.log2(g)) for g in grid)
    if total > 64:
        raise ValueError(f"{total} bits do not fit a code of 64")
    within = min(total, int(math.log2(max(1, math.ceil(target / (math.prod(chunk) * width))))))
    mini = min(max(0, math.ceil(math.log2(2**within / per_minishard))), int(math.log2(shard_index / 16)))
    return ShardSpec(within - mini, mini, total - within)


def shard_shape(spec: ShardSpec, size: Triple, chunk: Triple) -> Triple:
    """Voxels that a shard spans: its bits are dealt to the axes in turn, an axis dropping out once it is covered."""
    left = spec.preshift + spec.minishard
    if left >= 64:
        raise ValueError("too many bits within a shard")
    need = [math.ceil(math.log2(-(-s // c))) for s, c in zip(size, chunk, strict=True)]
    got = [0, 0, 0]
    while left and any(g < n for g, n in zip(got, need, strict=True)):
        for i in range(3):
            if left and got[i] < need[i]:
                got[i] += 1
                left -= 1
    return tuple(c << g for c, g in zip(chunk, got, strict=True))

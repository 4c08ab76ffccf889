"""Operators on dense chunks: one array a row, numpy within a row, and only the sides of chunks exchanged between neighbours.

A chunk table has cx, cy, cz, dtype and data: the bytes of `chunk` voxels, x fastest. Chunks that are absent are background,
and so is the part of a chunk beyond the volume's end. Labels and values of 0 are background.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.functions.codes import compressed_morton, shard_number
from stratavox.operators.ccl import contract, links
from stratavox.operators.mesh import triangles_of
from stratavox.operators.pool import Method, method_for
from stratavox.operators.select import AXES
from stratavox.plans.scales import ShardSpec
from stratavox.sources.shared import materialise

Size = tuple[int, int, int]
AT = ["cx", "cy", "cz"]
BLOCKS = "mip long, cx long, cy long, cz long, ox int, oy int, oz int, dtype string, size array<int>, data binary"
SIDES = "axis int, px long, py long, pz long, far boolean, labels binary"
FACES = "label long, x long, y long, z long, dx int, dy int, dz int"
#: An axis of x, y, z is this axis of an array in z, y, x order.
OF = (2, 1, 0)
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}


def _batch(ddl: str, columns: list) -> pa.RecordBatch:
    schema = pa.schema([(name, _TYPES[kind]) for name, kind in (x.split() for x in ddl.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def each_chunk(chunk: Size, ddl: str, work: Callable[[tuple[int, int, int], np.ndarray], Iterator[list]]):
    """For mapInArrow over a chunk table: the columns that work gives for a chunk's place and its array, in z, y, x order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cx, cy, cz, dtype, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                for columns in work((cx, cy, cz), np.frombuffer(data, dtype).reshape(chunk[::-1])):
                    yield _batch(ddl, columns)

    return run


def _over(chunks: DataFrame, chunk: Size, ddl: str, work) -> DataFrame:
    return chunks.select(*AT, "dtype", "data").mapInArrow(each_chunk(chunk, ddl, work), ddl)


def chunk_counts(chunks: DataFrame, chunk: Size) -> DataFrame:
    """label and voxels: each chunk is counted where it lies, so a label is shuffled once for each chunk that has it."""

    def work(_, dense):
        labels, n = np.unique(dense, return_counts=True)
        yield [labels[labels != 0].astype(np.int64), n[labels != 0]]

    return _over(chunks, chunk, "label long, voxels long", work).groupBy("label").agg(F.sum("voxels").alias("voxels"))


def chunk_boxes(chunks: DataFrame, chunk: Size) -> DataFrame:
    """The inclusive box of each label, x0, x1, y0, y1, z0 and z1, and its voxels."""

    def work(at, dense):
        place = np.flatnonzero(dense)
        own = dense.ravel()[place]
        order = np.argsort(own, kind="stable")
        own, place = own[order], place[order]
        cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))[: len(own)]
        ends = []
        for axis, k in enumerate(OF):
            w = np.unravel_index(place, dense.shape)[k] + at[axis] * chunk[axis]
            ends += [np.minimum.reduceat(w, cuts), np.maximum.reduceat(w, cuts)] if len(cuts) else [cuts, cuts]
        yield [own[cuts].astype(np.int64), np.diff(np.append(cuts, len(own))), *ends]

    names = [f"{a}{k}" for a in AXES for k in (0, 1)]
    found = _over(chunks, chunk, "label long, voxels long, " + ", ".join(f"{n} long" for n in names), work)
    return found.groupBy("label").agg(*[(F.max if n.endswith("1") else F.min)(n).alias(n) for n in names], F.sum("voxels").alias("voxels"))


def _windows(dense: np.ndarray, factor: Size) -> np.ndarray:
    """An array's windows, as the last axis; its sides are multiples of the factor."""
    (z, y, x), (fx, fy, fz) = dense.shape, factor
    return dense.reshape(z // fz, fz, y // fy, fy, x // fx, fx).transpose(0, 2, 4, 1, 3, 5).reshape(z // fz, y // fy, x // fx, -1)


def _rooms(at: tuple, chunk: Size, factor: Size, shape: Size | None) -> np.ndarray | int:
    """How many voxels of the volume each window of a chunk has."""
    if shape is None:
        return int(np.prod(factor))
    sides = []
    for axis in range(3):
        first = at[axis] * chunk[axis] + np.arange(0, chunk[axis], factor[axis])
        sides.append(np.clip(shape[axis] - first, 0, factor[axis]))
    return sides[2][:, None, None] * sides[1][None, :, None] * sides[0][None, None, :]


def pooled(windows: np.ndarray, kind: Method, rooms, sparse: bool) -> np.ndarray:
    """One level of windows (last axis) by mode, least, most or first value; 0 is background."""
    if kind == Method.MAX:
        return windows.max(axis=-1)
    if kind == Method.STRIDING:
        return windows[..., 0]
    if kind == Method.MIN:
        return windows.min(axis=-1)
    best, least = np.zeros(windows.shape[:-1], np.int64), np.zeros(windows.shape[:-1], windows.dtype)
    n = windows.shape[-1]
    if n <= 16:  # each value against each
        counts = [(windows == windows[..., i : i + 1]).sum(axis=-1) for i in range(n)]
        pairs = ((windows[..., i], counts[i]) for i in range(n))
    else:
        ordered = np.sort(windows, axis=-1)
        counts = [(ordered == ordered[..., i : i + 1]).sum(axis=-1) for i in range(n)]
        pairs = ((ordered[..., i], counts[i]) for i in range(n))
    for value, count in pairs:
        better = (value != 0) & ((count > best) | ((count == best) & (value < least)))
        best, least = np.where(better, count, best), np.where(better, value, least)
    if sparse:
        return least
    used = (windows != 0).sum(axis=-1)
    return np.where(rooms - used < best, least, 0).astype(windows.dtype)


def pooled_blocks(chunks: DataFrame, chunk: Size, factor: Size, levels: int, layer: str = "image", method: Method = Method.AUTO, sparse: bool = False, shape: Size | None = None, keep: bool = False) -> DataFrame:
    """BLOCKS rows: what each chunk gives to levels 1 to `levels`, and its own voxels as level 0 if kept. No shuffle.

    A chunk is pooled through all levels where it lies, as its sides are multiples of factor^levels. Averages carry sums and
    counts upward and are floors over the voxels that the volume has in a window, or over those that aren't 0 if sparse.
    Blocks of background alone are absent.
    """
    if any(c % f**levels for c, f in zip(chunk, factor, strict=True)):
        raise ValueError("a chunk's sides must be multiples of factor ** levels")
    kind = method_for(layer, method)

    def work(at, dense):
        below, count = dense.astype(np.int64) if kind == Method.AVERAGE else dense, None
        if keep and dense.any():
            yield [[0], *[[a] for a in at], [0], [0], [0], [dense.dtype.str], [list(dense.shape)], [dense.tobytes()]]
        for mip in range(1, levels + 1):
            whole = tuple(f**mip for f in factor)
            if kind == Method.AVERAGE:
                count = (_windows(below, factor) != 0).sum(axis=-1) if count is None else _windows(count, factor).sum(axis=-1)
                below = _windows(below, factor).sum(axis=-1)
                level = below // np.maximum(count if sparse else _rooms(at, chunk, whole, shape), 1)
            elif kind == Method.MIN:
                below = pooled(_windows(below, factor), kind, None, sparse)
                level = below
                if shape is not None:  # a window at the volume's end has less to be full
                    inside = [np.minimum(np.maximum(shape[a] - at[a] * chunk[a], 0), chunk[a]) for a in range(3)]
                    padded = np.full(dense.shape, np.iinfo(dense.dtype).max if dense.dtype.kind in "iu" else np.inf, dense.dtype)
                    padded[: inside[2], : inside[1], : inside[0]] = dense[: inside[2], : inside[1], : inside[0]]
                    level = np.where(_rooms(at, chunk, whole, shape) > 0, _windows(padded, whole).min(axis=-1), 0).astype(dense.dtype)
            else:
                step = tuple(-(-s // f ** (mip - 1)) for s, f in zip(shape, factor, strict=True)) if shape else None
                small = tuple(c // f ** (mip - 1) for c, f in zip(chunk, factor, strict=True))
                below = pooled(_windows(below, factor), kind, _rooms(at, small, factor, step), sparse)
                level = below
            if level.any():
                level = np.ascontiguousarray(level, dense.dtype)
                place = [at[a] * (chunk[a] // whole[a]) for a in range(3)]
                yield [[mip], *[[p // c] for p, c in zip(place, chunk, strict=True)], *[[p % c] for p, c in zip(place, chunk, strict=True)], [level.dtype.str], [list(level.shape)], [level.tobytes()]]

    return _over(chunks, chunk, BLOCKS, work)


def _whole(rows: list[dict], chunk: Size) -> np.ndarray:
    """The array of a chunk from its blocks."""
    out = np.zeros(chunk[::-1], rows[0]["dtype"])
    for r in rows:
        nz, ny, nx = r["size"]
        out[r["oz"] : r["oz"] + nz, r["oy"] : r["oy"] + ny, r["ox"] : r["ox"] + nx] = np.frombuffer(r["data"], r["dtype"]).reshape(nz, ny, nx)
    return out


def chunk_pyramid(chunks: DataFrame, chunk: Size, factor: Size, levels: int, layer: str = "image", method: Method = Method.AUTO, sparse: bool = False, shape: Size | None = None) -> DataFrame:
    """Levels 1 to `levels` as chunk tables with their mip: chunks of the same size, of which each holds several of the level below.

    The blocks of a level (see pooled_blocks(), which has the options) meet by the chunk that they lie in; what is shuffled is the levels themselves.
    """

    def join(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        first = rows[0]
        return pa.Table.from_batches([_batch("mip long, cx long, cy long, cz long, dtype string, data binary", [[first["mip"]], [first["cx"]], [first["cy"]], [first["cz"]], [first["dtype"]], [_whole(rows, chunk).tobytes()]])])

    return pooled_blocks(chunks, chunk, factor, levels, layer, method, sparse, shape).groupBy("mip", *AT).applyInArrow(join, "mip long, cx long, cy long, cz long, dtype string, data binary")


SHARDED = "mip long, shard long, minishard long, code long, cx long, cy long, cz long, dtype string, data binary"


def in_shards(blocks: DataFrame, chunk: Size, specs: dict[int, tuple[ShardSpec, Size]]) -> DataFrame:
    """SHARDED rows of BLOCKS rows: whole chunks by level and shard, in the order of minishard and code. One shuffle.

    specs has the bits and the grid of chunks of each level. A group is one shard, which its bits bound; its chunks are put
    together one after another.
    """
    code, shard, mini = F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for mip, (spec, grid) in specs.items():
        own = compressed_morton(*AT, grid)
        high, low = shard_number(own, spec.preshift, spec.minishard, spec.shard)
        code, shard, mini = (F.when(F.col("mip") == mip, new).otherwise(old) for new, old in ((own, code), (high, shard), (low, mini)))

    def join(group: pa.Table) -> pa.Table:
        found: dict = {}
        for r in group.to_pylist():
            found.setdefault((r["minishard"], r["code"]), []).append(r)
        out = []
        for (mini, code), rows in sorted(found.items()):
            out.append((rows[0]["mip"], rows[0]["shard"], mini, code, *[rows[0][c] for c in AT], rows[0]["dtype"], _whole(rows, chunk).tobytes()))
        return pa.Table.from_batches([_batch(SHARDED, list(map(list, zip(*out, strict=True))))])

    return blocks.withColumns({"code": code, "shard": shard, "minishard": mini}).groupBy("mip", "shard").applyInArrow(join, SHARDED)


def sharded_pyramid(chunks: DataFrame, chunk: Size, factor: Size, levels: int, specs: dict[int, tuple[ShardSpec, Size]], keep: bool = False, **options) -> DataFrame:
    """All levels of a pyramid dealt to the shards of each level, in one pass with one shuffle; level 0 too if kept.

    A task pools its chunks through all levels, and every level's blocks go straight to their shard.
    """
    return in_shards(pooled_blocks(chunks, chunk, factor, levels, keep=keep, **options), chunk, specs)


def moved_blocks(chunks: DataFrame, chunk: Size, to: Size, box: tuple[Size, Size], shift: Size = (0, 0, 0)) -> DataFrame:
    """BLOCKS rows, at level 0, of the voxels within a box, moved by shift and cut by chunks of another size. No shuffle."""

    def work(at, dense):
        low = [max(box[0][a], at[a] * chunk[a]) for a in range(3)]
        high = [min(box[1][a], (at[a] + 1) * chunk[a]) for a in range(3)]
        if any(p >= q for p, q in zip(low, high, strict=True)):
            return
        cells = [range((low[a] + shift[a]) // to[a], (high[a] + shift[a] - 1) // to[a] + 1) for a in range(3)]
        for place in itertools.product(*cells):
            first = [max(low[a] + shift[a], place[a] * to[a]) for a in range(3)]
            last = [min(high[a] + shift[a], (place[a] + 1) * to[a]) for a in range(3)]
            cut = dense[tuple(np.s_[first[a] - shift[a] - at[a] * chunk[a] : last[a] - shift[a] - at[a] * chunk[a]] for a in (2, 1, 0))]
            if cut.any():
                yield [[0], *[[p] for p in place], *[[first[a] - place[a] * to[a]] for a in range(3)], [dense.dtype.str], [list(cut.shape)], [np.ascontiguousarray(cut).tobytes()]]

    return _over(chunks, chunk, BLOCKS, work)


def sharded_transfer(chunks: DataFrame, chunk: Size, to: Size, box: tuple[Size, Size], spec: ShardSpec, grid: Size, shift: Size = (0, 0, 0)) -> DataFrame:
    """A copy cut out, moved (to places of 0 and more), cut by other chunks and dealt to shards, with one shuffle."""
    return in_shards(moved_blocks(chunks, chunk, to, box, shift), to, {0: (spec, grid)})


def write_sharded(shards: DataFrame, path: str) -> None:
    """A folder for each level and shard, written where a shard lies: no further shuffle; its chunks are in order."""
    shards.write.mode("overwrite").partitionBy("mip", "shard").parquet(path)


def _own_faces(at: tuple, dense: np.ndarray, chunk: Size, axis: int):
    """Faces within a chunk across an axis: arrays of label, z, y, x and direction, of either side of each border."""
    k = OF[axis]
    low, high = (np.take(dense, range(*r), axis=k) for r in ((0, chunk[axis] - 1), (1, chunk[axis])))
    place = np.flatnonzero(low != high)
    z, y, x = np.unravel_index(place, low.shape)
    spot = [x + at[0] * chunk[0], y + at[1] * chunk[1], z + at[2] * chunk[2]]
    for side, sign in ((low, 1), (high, -1)):
        own = side.ravel()[place]
        keep = own != 0
        here = [w[keep] for w in spot]
        if sign < 0:
            here[axis] = here[axis] + 1
        yield own[keep].astype(np.int64), here, sign


def _sides(chunk: Size):
    """For each_chunk: the six sides of a chunk, keyed by the plane between it and its neighbour; empty ones aren't sent."""

    def work(at, dense):
        for axis, k in enumerate(OF):
            for far in (False, True):
                side = np.take(dense, chunk[axis] - 1 if far else 0, axis=k).astype(np.int64)
                if side.any():
                    plane = [p + (far and a == axis) for a, p in enumerate(at)]
                    yield [[axis], *[[p] for p in plane], [far], [side.tobytes()]]

    return work


def _met(chunk: Size, ddl: str, columns):
    """For applyInArrow by plane: what columns gives for the labels below and above it, absent ones being 0."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        axis, plane = rows[0]["axis"], [rows[0][p] for p in ("px", "py", "pz")]
        flat = tuple(c for a, c in enumerate(chunk) if a != axis)[::-1]
        below, above = np.zeros(flat, np.int64), np.zeros(flat, np.int64)
        for r in rows:
            side = np.frombuffer(r["labels"], np.int64).reshape(flat)
            if r["far"]:
                below = side
            else:
                above = side
        return pa.Table.from_batches([_batch(ddl, columns(axis, plane, below, above))])

    return run


def chunk_surface(chunks: DataFrame, chunk: Size, resolution: Size = (1, 1, 1)) -> DataFrame:
    """Exposed faces of each label and their area: counted within chunks, and across the planes where two chunks' sides meet."""
    areas = [resolution[1] * resolution[2], resolution[0] * resolution[2], resolution[0] * resolution[1]]
    ddl = "label long, faces long, area long"

    def count(below, above, area):
        differ = below != above
        labels, n = np.unique(np.concatenate([below[differ], above[differ]]), return_counts=True)
        return [labels[labels != 0].astype(np.int64), n[labels != 0], n[labels != 0] * area]

    def work(_, dense):
        for axis, k in enumerate(OF):
            yield count(*(np.take(dense, range(*r), axis=k) for r in ((0, chunk[axis] - 1), (1, chunk[axis]))), areas[axis])

    own = _over(chunks, chunk, ddl, work)
    planes = _over(chunks, chunk, SIDES, _sides(chunk)).groupBy("axis", "px", "py", "pz")
    between = planes.applyInArrow(_met(chunk, ddl, lambda axis, _, below, above: count(below, above, areas[axis])), ddl)
    return own.unionByName(between).groupBy("label").agg(F.sum("faces").alias("faces"), F.sum("area").alias("area"))


def chunk_faces(chunks: DataFrame, chunk: Size) -> DataFrame:
    """The exposed faces themselves, as mesh.exposed_faces gives them: label, x, y, z and direction."""

    def columns(labels, spot, axis, sign):
        zero, way = np.zeros(len(labels), np.int32), np.full(len(labels), sign, np.int32)
        return [labels, *spot, *[way if a == axis else zero for a in range(3)]]

    def work(at, dense):
        for axis in range(3):
            for labels, spot, sign in _own_faces(at, dense, chunk, axis):
                yield columns(labels, spot, axis, sign)

    def across(axis, plane, below, above):
        v, u = np.nonzero(below != above)
        rest = [a for a in range(3) if a != axis]
        parts = []
        for side, sign in ((below, 1), (above, -1)):
            own = side[v, u]
            keep = own != 0
            spot = [None] * 3
            spot[rest[0]], spot[rest[1]] = u[keep] + plane[rest[0]] * chunk[rest[0]], v[keep] + plane[rest[1]] * chunk[rest[1]]
            spot[axis] = np.full(keep.sum(), plane[axis] * chunk[axis] - (sign > 0))
            parts.append(columns(own[keep], spot, axis, sign))
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    own = _over(chunks, chunk, FACES, work)
    planes = _over(chunks, chunk, SIDES, _sides(chunk)).groupBy("axis", "px", "py", "pz")
    return own.unionByName(planes.applyInArrow(_met(chunk, FACES, across), FACES))


def chunk_triangles(chunks: DataFrame, chunk: Size, resolution: Size = (1, 1, 1)) -> DataFrame:
    """A closed surface of each label, as mesh.triangles gives it, from chunks."""
    return triangles_of(chunk_faces(chunks, chunk), resolution)


def local_parts(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of one label joined by faces: for each voxel its piece's number from 1, 0 for background, and each piece's first voxel.

    Runs along x are joined, so that only runs take part in the rounds.
    """
    z, y, x = dense.shape
    new = np.ones(dense.shape, bool)
    new[:, :, 1:] = dense[:, :, 1:] != dense[:, :, :-1]
    run = np.cumsum(new.ravel()).reshape(dense.shape) - 1
    n = int(run[-1, -1, -1]) + 1
    ends = []
    for low, high in ((np.s_[:-1, :, :], np.s_[1:, :, :]), (np.s_[:, :-1, :], np.s_[:, 1:, :])):
        same = (dense[low] == dense[high]) & (dense[low] != 0)
        a, b = run[low][same], run[high][same]
        keep = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        ends.append((a[keep], b[keep]))
    a, b = (np.concatenate(e) for e in zip(*ends, strict=True))
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        differ = low != high
        if not differ.any():
            break
        a, b = a[differ], b[differ]
        np.minimum.at(root, high[differ], low[differ])
        while (root[root] != root).any():
            root = root[root]
    first = np.flatnonzero(new.ravel())  # of each run
    real = (dense.ravel()[first] != 0) & (root == np.arange(n))
    number = np.zeros(n, np.int32)
    number[real] = np.arange(1, real.sum() + 1)
    of = np.where(dense.ravel()[first] != 0, number[root], 0).astype(np.int32)
    return of[run], first[real]


def chunk_components(chunks: DataFrame, chunk: Size, shape: Size) -> DataFrame:
    """Chunks whose labels are components joined by faces: the least linear id in the volume of each, plus 1.

    Each chunk is labelled where it lies. Voxels on chunks' sides alone are compared with neighbours, links between pieces are
    contracted, and each chunk gets the roots of its pieces back: a number for each piece.
    """
    linear = lambda x, y, z: x + shape[0] * (y + shape[1] * z)

    def named(at, dense):
        parts, first = local_parts(dense)
        z, y, x = np.unravel_index(first, dense.shape)
        return parts, linear(x + at[0] * chunk[0], y + at[1] * chunk[1], z + at[2] * chunk[2])

    def label(at, dense):
        parts, names = named(at, dense)
        if len(names):
            yield [*[[p] for p in at], [parts.tobytes()], [names.astype(np.int64).tobytes()]]

    def sides(at, dense):
        parts, names = named(at, dense)
        edge = np.zeros(dense.shape, bool)
        for k in range(3):
            edge[tuple(np.s_[:] if i != k else [0, -1] for i in range(3))] = True
        z, y, x = np.nonzero(edge & (parts > 0))
        yield [x + at[0] * chunk[0], y + at[1] * chunk[1], z + at[2] * chunk[2], dense[z, y, x].astype(np.int64), names[parts[z, y, x] - 1]]

    local = materialise(_over(chunks, chunk, "cx long, cy long, cz long, parts binary, names binary", label), "chunk-parts")
    border = materialise(_over(chunks, chunk, "x long, y long, z long, label long, part long", sides), "chunk-sides")
    roots = contract(links(border, 6, "label", chunk))
    pieces = border.select(*[F.floor(F.col(a) / s).cast("long").alias(c) for a, s, c in zip(AXES, chunk, AT, strict=True)], F.col("part").alias("node")).distinct()
    known = pieces.join(roots, "node")

    def relabel(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():
            names = np.frombuffer(r["names"], np.int64)
            order = np.argsort(names)
            root = names.copy()
            root[order[np.searchsorted(names[order], right["node"].to_numpy())]] = right["root"].to_numpy()
            dense = np.append(0, root + 1)[np.frombuffer(r["parts"], np.int32)]
            out.append((r["cx"], r["cy"], r["cz"], "<i8", dense.astype("<i8").tobytes()))
        return pa.Table.from_batches([_batch("cx long, cy long, cz long, dtype string, data binary", list(map(list, zip(*out, strict=True))) or [[]] * 5)])

    return local.groupBy(*AT).cogroup(known.groupBy(*AT)).applyInArrow(relabel, "cx long, cy long, cz long, dtype string, data binary")


PIECES = "cx long, cy long, cz long, ox int, oy int, oz int, dtype string, size array<int>, data binary"
CHUNKS = "cx long, cy long, cz long, dtype string, data binary"


def with_halo(chunks: DataFrame, chunk: Size, shape: Size, work: Callable[[np.ndarray], np.ndarray], halo: int = 1) -> DataFrame:
    """Chunks after work on each with `halo` voxels of its neighbours around it; only these are sent, to chunks within the shape.

    Chunks that are absent but have something beside them take part. work gets an array in z, y, x order with the halo around it, and gives
    one without; what it puts beyond the shape is dropped, and so are chunks of background alone.
    """
    grid = [-(-s // c) for s, c in zip(shape, chunk, strict=True)]
    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]

    def spread(at, dense):
        for d in steps:
            to = [a + b for a, b in zip(at, d, strict=True)]
            part = dense[tuple({-1: np.s_[:halo], 0: np.s_[:], 1: np.s_[-halo:]}[d[a]] for a in (2, 1, 0))]
            if all(0 <= t < g for t, g in zip(to, grid, strict=True)) and (d == (0, 0, 0) or part.any()):
                first = [{-1: halo + chunk[a], 0: halo, 1: 0}[d[a]] for a in range(3)]
                yield [*[[t] for t in to], *[[f] for f in first], [dense.dtype.str], [list(part.shape)], [np.ascontiguousarray(part).tobytes()]]

    def join(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        whole = np.zeros([c + 2 * halo for c in chunk[::-1]], rows[0]["dtype"])
        for r in rows:
            nz, ny, nx = r["size"]
            whole[r["oz"] : r["oz"] + nz, r["oy"] : r["oy"] + ny, r["ox"] : r["ox"] + nx] = np.frombuffer(r["data"], r["dtype"]).reshape(nz, ny, nx)
        out = work(whole).copy()
        for axis, c in enumerate(AT):
            out[tuple(np.s_[max(0, shape[axis] - rows[0][c] * chunk[axis]) :] if k == OF[axis] else np.s_[:] for k in range(3))] = 0
        some = [[rows[0][c]] for c in AT] + [[out.dtype.str], [np.ascontiguousarray(out).tobytes()]] if out.any() else [[]] * 5
        return pa.Table.from_batches([_batch(CHUNKS, some)])

    return _over(chunks, chunk, PIECES, spread).groupBy(*AT).applyInArrow(join, CHUNKS)


def grown(whole: np.ndarray) -> np.ndarray:
    """An array without its halo of 1, whose background has taken the least label beside it, corners included."""
    top = np.iinfo(whole.dtype).max
    far = np.where(whole == 0, top, whole)
    for k in range(3):  # the least of three along each axis
        n = far.shape[k]
        far = np.minimum.reduce([np.take(far, range(i, n - 2 + i), axis=k) for i in range(3)])
    own = whole[1:-1, 1:-1, 1:-1]
    return np.where((own == 0) & (far != top), far, own)


def chunk_dilate(chunks: DataFrame, chunk: Size, shape: Size) -> DataFrame:
    """Background voxels beside a label, corners included, take it, the least of several; as select.dilate, within the shape."""
    return with_halo(chunks, chunk, shape, grown)

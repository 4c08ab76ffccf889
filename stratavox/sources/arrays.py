"""Large array files (.npy, .nrrd, .nii) as voxels: a data source whose partitions are ranges of a file's bytes."""

from __future__ import annotations

import ast
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a partition, unless told otherwise, and of what a task reads at a time.
PIECE, READ = 64 << 20, 8 << 20
#: Bytes in which a header's end must lie.
HEAD = 1 << 20
# Fixed values of the formats: names of types in NRRD headers, and numbers of types in NIfTI ones.
NRRD = {"int8": "i1", "signed char": "i1", "uint8": "u1", "unsigned char": "u1", "uchar": "u1", "int16": "i2", "short": "i2", "uint16": "u2", "unsigned short": "u2", "ushort": "u2", "int32": "i4", "int": "i4", "uint32": "u4", "unsigned int": "u4", "uint": "u4", "int64": "i8", "uint64": "u8", "float": "f4", "double": "f8"}
NIFTI = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8"}


@dataclass(frozen=True)
class Layout:
    """Where and how an array's numbers lie in a file: x, y, z extents, and whether x is the axis that varies fastest."""

    dtype: str
    shape: tuple[int, int, int]
    x_first: bool
    offset: int

    def places(self, first: int, n: int) -> list[np.ndarray]:
        """x, y and z of n numbers from the first on."""
        i = np.arange(first, first + n)
        a, b, c = self.shape if self.x_first else self.shape[::-1]
        out = [i % a, i // a % b, i // (a * b)]
        return out if self.x_first else out[::-1]


def _three(sizes) -> tuple[int, int, int]:
    sizes = [int(s) for s in sizes]
    while len(sizes) > 3 and sizes[-1] == 1:
        sizes.pop()
    if len(sizes) > 3:
        raise ValueError(f"an array of up to three axes is wanted, not {sizes}")
    return tuple(sizes + [1] * (3 - len(sizes)))


def _npy(head: bytes) -> Layout:
    wide = head[6] > 1
    size = struct.unpack("<I" if wide else "<H", head[8 : 12 if wide else 10])[0]
    begin = 12 if wide else 10
    told = ast.literal_eval(head[begin : begin + size].decode("latin1"))
    dtype = np.dtype(told["descr"])
    if dtype.kind not in "biuf":
        raise ValueError(f"numbers are wanted, not {dtype}")
    return Layout(dtype.str, _three(told["shape"]), told["fortran_order"], begin + size)


def _nrrd(head: bytes) -> Layout:
    end = min(k + len(e) for e in (b"\n\n", b"\r\n\r\n") if (k := head.find(e)) >= 0)
    lines = head[:end].decode("ascii", "replace").splitlines()
    told = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x and not x.startswith("#") and ":=" not in x)}
    if told.get("encoding", "").lower() != "raw" or "data file" in told or "datafile" in told:
        raise ValueError("only raw numbers in the file itself can be read in parts")
    return Layout(np.dtype(NRRD[told["type"].lower()]).newbyteorder(">" if told.get("endian") == "big" else "<").str, _three(told["sizes"].split()), True, end)


def _nii(head: bytes) -> Layout:
    end = "<" if struct.unpack("<i", head[:4])[0] == 348 else ">"
    dim = struct.unpack(f"{end}8h", head[40:56])
    kind = struct.unpack(f"{end}h", head[70:72])[0]
    if kind not in NIFTI:
        raise ValueError(f"numbers are wanted, not type {kind}")
    return Layout(np.dtype(NIFTI[kind]).newbyteorder(end).str, _three(dim[1 : 1 + dim[0]]), True, int(struct.unpack(f"{end}f", head[108:112])[0]))


def layout_of(path: str) -> Layout:
    """The layout of an array file, from its header alone."""
    where, name = _file(path)
    with where.open_input_stream(name) as f:
        head = f.read(HEAD)
    if head[:6] == b"\x93NUMPY":
        return _npy(head)
    if head[:4] == b"NRRD":
        return _nrrd(head)
    if head[344:347] in (b"n+1", b"ni1"):
        return _nii(head)
    raise ValueError(f"{path} is no .npy, .nrrd or .nii file that can be read in parts")


def _file(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class Range(InputPartition):
    """The numbers from first up to, but without, last."""

    first: int
    last: int


class ArrayReader(DataSourceReader):
    def __init__(self, path: str, piece: int):
        self.path, self.piece, self.layout = path, piece, layout_of(path)

    def partitions(self) -> list[Range]:
        total, step = int(np.prod(self.layout.shape)), max(1, self.piece // np.dtype(self.layout.dtype).itemsize)
        return [Range(i, min(i + step, total)) for i in range(0, total, step)] or [Range(0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        dtype = np.dtype(self.layout.dtype)
        where, name = _file(self.path)
        with where.open_input_file(name) as f:
            f.seek(self.layout.offset + part.first * dtype.itemsize)
            for first in range(part.first, part.last, READ // dtype.itemsize):
                n = min(READ // dtype.itemsize, part.last - first)
                raw = f.read(n * dtype.itemsize)
                if len(raw) < n * dtype.itemsize:
                    raise ValueError(f"{self.path} ends before its array does")
                values = np.frombuffer(raw, dtype)
                some = np.flatnonzero(values)
                at = [w[some] for w in self.layout.places(first, n)]
                kind = np.float64 if dtype.kind == "f" else np.int64
                yield pa.RecordBatch.from_arrays([pa.array(w) for w in (*at, values[some].astype(kind))], names=["x", "y", "z", "v"])


class ArraySource(DataSource):
    """Voxels other than 0 of an array file; v is a double for floating numbers, else a long (unsigned ones of 64 bits wrap)."""

    @classmethod
    def name(cls) -> str:
        return "array_voxels"

    def schema(self) -> str:
        kind = np.dtype(layout_of(self.options["path"]).dtype).kind
        return f"x long, y long, z long, v {'double' if kind == 'f' else 'long'}"

    def reader(self, schema) -> ArrayReader:
        return ArrayReader(self.options["path"], int(self.options.get("piece", PIECE)))


def import_array(spark: SparkSession, path: str, piece: int = PIECE) -> DataFrame:
    """x, y, z and v of the voxels of a .npy, .nrrd or .nii array of up to three axes that aren't 0, in tasks of `piece` bytes each.

    The driver reads the header; a task reads its own range of bytes and nothing else, so files of any size are shared out. Paths
    may be local or URIs that Arrow's file systems know. Compressed files, arrays of other kinds and files that end early are errors.
    """
    spark.dataSource.register(ArraySource)
    return spark.read.format(ArraySource.name()).option("piece", str(piece)).load(path)

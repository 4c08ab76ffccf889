"""Array files read in ranges of bytes."""

import struct

import numpy as np
import pytest

from stratavox.sources import arrays

KINDS = {"u1": (2, "uint8"), "<i2": (4, "short"), "<u4": (768, "uint32"), "<f4": (16, "float"), "<i8": (1024, "int64")}


def volume(dtype, shape=(23, 17, 11)):
    rng = np.random.default_rng(1)
    return (rng.integers(0, 100, shape) * (rng.random(shape) > 0.4)).astype(dtype)


def write(path, kind, dense):
    dtype = dense.dtype.str.replace("|", "")
    raw = dense.tobytes(order="F")
    if kind == "nrrd":
        sizes = " ".join(map(str, dense.shape))
        head = f"NRRD0004\n# a comment: no field\ntype: {KINDS[dtype][1]}\ndimension: {dense.ndim}\nsizes: {sizes}\nencoding: raw\nendian: little\nkey:=value\n\n"
        path.write_bytes(head.encode() + raw)
    elif kind == "nii":
        head = bytearray(352)
        struct.pack_into("<i", head, 0, 348)
        struct.pack_into("<8h", head, 40, dense.ndim, *dense.shape, *[1] * (7 - dense.ndim))
        struct.pack_into("<h", head, 70, KINDS[dtype][0])
        struct.pack_into("<f", head, 108, 352)
        head[344:348] = b"n+1\0"
        path.write_bytes(bytes(head) + raw)
    else:
        np.save(path, np.asfortranarray(dense) if kind == "npy-f" else np.ascontiguousarray(dense))
    return str(path)


@pytest.mark.parametrize("kind", ["npy-c", "npy-f", "nrrd", "nii"])
@pytest.mark.parametrize("dtype", list(KINDS))
def test_round_trip(spark, tmp_path, kind, dtype):
    dense = volume(dtype)
    path = write(tmp_path / f"a.{kind[:4].rstrip('-')}", kind, dense)
    found = arrays.import_array(spark, path, piece=1000)
    assert found.rdd.getNumPartitions() == len(range(0, dense.size, 1000 // dense.itemsize))
    assert {(r.x, r.y, r.z): r.v for r in found.collect()} == {tuple(map(int, p)): dense[tuple(p)] for p in np.argwhere(dense)}


def test_fewer_axes_and_uris(spark, tmp_path):
    path = write(tmp_path / "a.npy", "npy-c", np.array([[0, 5], [7, 0]], "u1"))
    assert sorted(map(tuple, arrays.import_array(spark, f"file://{path}").collect())) == [(0, 1, 0, 5), (1, 0, 0, 7)]
    assert arrays.import_array(spark, write(tmp_path / "b.npy", "npy-c", np.zeros((0, 3), "u1"))).collect() == []


def test_large_files_are_shared_out(spark, tmp_path):
    """A file with holes on disk: many tasks, each with its range."""
    path = tmp_path / "large.npy"
    dense = np.lib.format.open_memmap(path, "w+", "<u2", (1024, 1024, 512), fortran_order=True)  # 1 GB
    dense[3, 4, 5] = dense[1023, 1023, 511] = 9
    dense.flush()
    found = arrays.import_array(spark, str(path))
    assert found.rdd.getNumPartitions() == 16
    assert sorted(map(tuple, found.collect())) == [(3, 4, 5, 9), (1023, 1023, 511, 9)]
    path.unlink()


def test_what_cannot_be_read(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"no array" * 100)
    with pytest.raises(Exception, match="no .npy"):
        arrays.import_array(spark, str(tmp_path / "a.txt")).collect()
    path = tmp_path / "short.npy"
    write(path, "npy-c", volume("u1"))
    path.write_bytes(path.read_bytes()[:-5])
    with pytest.raises(Exception, match="ends before"):
        arrays.import_array(spark, str(path)).collect()
    with pytest.raises(ValueError, match="three axes"):
        arrays.layout_of(write(tmp_path / "four.npy", "npy-c", np.zeros((2, 2, 2, 2))))
    with pytest.raises(ValueError, match="raw numbers"):
        arrays._nrrd(b"NRRD0004\ntype: uchar\nsizes: 2 2\nencoding: gzip\n\n")

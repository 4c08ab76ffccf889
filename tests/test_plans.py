"""Planning arithmetic. Inputs and results below are fixed values: other planners of such volumes give the same."""

import pytest

from stratavox.plans import scales as P


def test_plane_scales():
    assert P.plane_scales((2048, 2048, 512)) == [(1, 1, 1), (2, 2, 1), (4, 4, 1), (8, 8, 1), (16, 16, 1)]
    assert P.plane_scales((357, 2048, 512)) == [(1, 1, 1), (2, 2, 1)]
    assert P.plane_scales((0, 2048, 512)) == [(1, 1, 1)]
    for x in (512, 64):
        assert P.plane_scales((x, 2048, 2048), "x") == [(1, 1, 1), (1, 2, 2), (1, 4, 4), (1, 8, 8), (1, 16, 16)]


@pytest.mark.parametrize(
    "width,chunk,factor,target,shape",
    [
        (1, (1, 1, 1), (1, 1, 1), 16, (4, 4, 1)),
        (2, (1, 1, 1), (1, 1, 1), 16, (2, 2, 1)),
        (1, (2, 1, 1), (1, 1, 1), 16, (4, 4, 1)),
        (1, (256, 256, 64), (1, 1, 1), 20e6, (512, 512, 64)),
        (8, (256, 256, 64), (1, 1, 1), 35e6, (256, 256, 64)),
        (8, (256, 256, 64), (1, 1, 1), 3.5e9, (2560, 2560, 64)),
        (1, (1, 1, 1), (2, 2, 1), 16, (4, 4, 1)),
        (1, (1, 1, 1), (2, 2, 2), 64, (4, 4, 4)),
        (8, (128, 128, 64), (2, 2, 1), 3.5e9, (2048, 2048, 64)),
        (1, (128, 128, 64), (2, 2, 1), 3.5e9, (4096, 4096, 64)),
        (8, (128, 128, 64), (2, 2, 2), 3.5e9, (512, 512, 256)),
        (4, (100, 100, 50), (2, 2, 1), 3.5e9, (3200, 3200, 50)),
    ],
)
def test_shapes(width, chunk, factor, target, shape):
    assert P.shape_for_memory(width, chunk, factor, target) == shape


@pytest.mark.parametrize("args", [(1, (0, 1, 1), (2, 2, 1), 16), (1, (1, 1, 1), (2, 2, 1), 0), (8, (128, 128, 64), (2, 2, 1), 100), (1, (1, 1, 1), (3, 1, 1), 99)])
def test_shapes_that_cannot_be(args):
    with pytest.raises(ValueError):
        P.shape_for_memory(*args)


@pytest.mark.parametrize(
    "target,width,factor,levels",
    [(0, 1, (2, 2, 1), 1), (100e6, 1, (2, 2, 1), 3), (100e6, 2, (2, 2, 1), 2), (100e6, 4, (2, 2, 1), 2), (100e6, 8, (2, 2, 1), 1), (3.5e9, 8, (2, 2, 1), 4), (12e9, 8, (2, 2, 1), 5), (800e6, 1, (2, 2, 2), 3), (500e6, 1, (2, 2, 2), 2), (100e6, 1, (2, 2, 2), 2), (50e6, 1, (2, 2, 2), 1)],
)
def test_levels(target, width, factor, levels):
    assert P.levels_for_memory(target, width, (128, 128, 64), 1, factor) == levels


@pytest.mark.parametrize(
    "labels,shard,mini,least,bits",
    [(10**9, 2**13, 2**15, 1, (11, 9, 0)), (10**6, 2**13, 2**15, 1, (1, 9, 0)), (10**7, 2**13, 2**15, 1, (4, 9, 0)), (1000, 2**13, 2**15, 1, (0, 0, 0)), (1000, 2**13, 2**15, 1000, (10, 0, 0)), (0, 0, 0, 1, (0, 0, 0)), (10000, 2**13, 2**15, 1, (0, 3, 0)), (10**9, 2**10, 2**15, 1, (14, 6, 0)), (10**9, 2**13, 2**13, 1, (13, 9, 0))],
)
def test_hashed_bits(labels, shard, mini, least, bits):
    assert P.hashed_shard_bits(labels, shard, mini, least) == bits


def test_image_bits_cover_the_grid():
    spec = P.image_shard_spec((10240, 10240, 990), (128, 128, 20), 1)
    assert spec.preshift + spec.minishard + spec.shard == 20
    shape = P.shard_shape(spec, (10240, 10240, 990), (128, 128, 20))
    assert all(s % c == 0 for s, c in zip(shape, (128, 128, 20), strict=True))
    assert 2**spec.shard >= (10240 / shape[0]) * (10240 / shape[1]) * (990 / shape[2])


def test_factors_and_resolutions():
    assert P.levels_that_fit((1024, 1024, 64), (2, 2, 1), (64, 64, 64), (4096, 4096, 64)) == 4
    assert P.levels_that_fit((1024, 1024, 64), (1, 1, 1), (64, 64, 64), (4096, 4096, 64)) == 0
    assert P.resolutions((4, 4, 40), (256, 256, 64), (64, 64, 64), (512, 512, 64)) == [(8, 8, 40), (16, 16, 40)]
    assert P.resolutions((0.25, 0.25, 1), (128, 128, 64), (64, 64, 64), (512, 512, 64)) == [(0.5, 0.5, 1)]


def test_isotropic_scales():
    found = P.isotropic_scales((8192, 8192, 1024), (4, 4, 40))
    assert found[:4] == [(1, 1, 1), (2, 2, 1), (4, 4, 1), (8, 8, 1)]
    assert P.flat_scales((8192, 8192, 1024), (4, 4, 40))[0] == ((1, 1, 1),) * 3
    assert P.pyramid_bytes(3, (2, 2, 1)) == 4

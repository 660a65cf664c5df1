"""Tiles made and read as columns are those of the row-by-row writer and reader, byte by byte."""

import numpy as np
import pytest

from tests.test_functions import decoded
from tilewright.functions import tile_arrays, wire


def random_tiles(seed, tiles, rows, most):
    rng = np.random.default_rng(seed)
    at = np.unique(np.stack([rng.integers(0, tiles, rows), rng.integers(-64, 576, rows) // 8 * 8, rng.integers(-64, 576, rows), rng.choice([0, 3, 199203, 200108, 99907, 1000001, 50, -5, 1900], rows)]), axis=1)
    return *at, rng.integers(1, most, at.shape[1])


@pytest.mark.parametrize("seed, tiles, rows, most, batch", [(1, 1, 40, 3, 10), (2, 30, 3000, 40, 100), (3, 3, 30_000, 10**12, 5000), (4, 200, 5000, 2, 300_000)])
def test_encoding_is_that_of_the_writer(monkeypatch, seed, tiles, rows, most, batch):
    monkeypatch.setattr(tile_arrays, "BATCH_ROWS", batch)
    tile, x, y, bor, n = random_tiles(seed, tiles, rows, most)
    shuffled = np.random.default_rng(seed).permutation(len(n))
    whose = np.unique(tile, return_inverse=True)[1]
    made = tile_arrays.encode(whose[shuffled], tile_arrays.pack(x, y, bor, n, 64)[shuffled], whose.max() + 1, 512, 64)
    for k, data in enumerate(made):
        mine = whose == k
        pixels = [{"x": a, "y": b, "features": [{"borYear": c, "occCount": d}]} for a, b, c, d in zip(*[v[mine].tolist() for v in (x, y, bor, n)], strict=True)]
        assert data == wire.vector_tile(pixels)
        rows = told([data])
        assert [r[1:] for r in rows] == wire.read_vector_tile(data)
        if k == 0:
            assert decoded(data) and {name for _, name, *_ in rows} == set(decoded(data))
    assert told(made) == [(k, *r) for k, data in enumerate(made) for r in wire.read_vector_tile(data)]


def told(tiles):
    return [
        (t, layers[a], b, c, years[d], e)
        for at, layers, layer, x, y, years, year, n in tile_arrays.read(tiles)
        for t, a, b, c, d, e in zip(*[v.tolist() for v in (at, layer, x, y, year, n)], strict=True)
    ]


def test_an_empty_tile_is_read():
    assert told([b""]) == [] and told([]) == []


def test_layers_in_another_form_are_read():
    data = wire.tagged(3, 2, wire.tagged(1, 2, "Å".encode()) + wire.tagged(2, 2, wire.tagged(2, 2, b"\0\0") + wire.tagged(4, 2, b"\x09\x02\x03")) + wire.tagged(3, 2, b"1999") + wire.tagged(4, 2, wire.tagged(4, 0, 7)))
    assert told([data]) == [(0, "Å", 1, -2, "1999", 7)]


def test_a_large_tile_is_made_and_read_in_a_few_seconds():
    import time

    k = np.arange(400_000)
    began = time.time()
    [data] = tile_arrays.encode(k * 0, tile_arrays.pack(k % 640 - 64, k // 640 - 64, k * 0 + 200003, k, 64), 1, 512, 64)
    [found] = tile_arrays.read([data])
    assert time.time() - began < 3 and (found[-1] == k[np.lexsort((k // 640, k % 640))]).all()


def test_a_large_layer_is_read_in_parts(monkeypatch):
    k = np.arange(5000)
    [data] = tile_arrays.encode(k * 0, tile_arrays.pack(k % 640 - 64, k // 640 - 64, k * 0 + 200003, k, 64), 1, 512, 64)
    monkeypatch.setattr(tile_arrays, "BATCH_ROWS", 300)
    assert max(len(found[-1]) for found in tile_arrays.read([data])) <= 600 and told([data]) == [(0, *r) for r in wire.read_vector_tile(data)]

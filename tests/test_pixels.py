"""Resizing against a two-dimensional convolution, tiles against boxes, band vectors against the padded matrix."""

from __future__ import annotations

import numpy as np
import pytest

from reelspan.functions import pixels
from reelspan.operators import messages, vectors


def kernel(x):
    x = abs(x)
    return 1.5 * x**3 - 2.5 * x**2 + 1 if x < 1 else -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2 if x < 2 else 0.0


def convolved(image, width, height):
    """Every new pixel as a weighted mean over all old ones, without bytes between."""
    h, w, _ = image.shape
    out = np.zeros((height, width, 3))
    sx, sy = w / width, h / height
    for j in range(height):
        for i in range(width):
            total = np.zeros(3)
            mass = 0.0
            for y in range(h):
                for x in range(w):
                    k = kernel((x + 0.5 - (i + 0.5) * sx) / max(sx, 1)) * kernel((y + 0.5 - (j + 0.5) * sy) / max(sy, 1))
                    total, mass = total + k * image[y, x], mass + k
            out[j, i] = total / mass
    return np.clip(out, 0, 255)


@pytest.mark.parametrize("size", [(9, 7, 4, 3), (5, 5, 11, 8), (6, 9, 6, 4), (1, 1, 3, 2), (12, 3, 5, 9)])
def test_resize_by_convolution(size):
    w, h, width, height = size
    image = np.random.default_rng(w).integers(60, 190, (h, w, 3)).astype(np.uint8)  # so that nothing is clipped between the passes
    assert np.abs(pixels.resized(image, width, height) - convolved(image, width, height)).max() <= 1.3
    flat = np.full((h, w, 3), 77, np.uint8)
    assert (pixels.resized(flat, width, height) == 77).all()
    assert (pixels.resized(image, w, h) == image).all()


def test_tiles_follow_boxes(spark):
    r = np.random.default_rng(2)
    images = {i: r.integers(0, 256, (h, w, 3), dtype=np.uint8) for i, (w, h) in enumerate([(30, 20), (16, 16), (9, 40)])}
    df = spark.createDataFrame([(i, x.shape[1], x.shape[0], x.tobytes()) for i, x in images.items()] + [(9, 4, 4, b"short"), (10, None, 4, b""), (11, 4, 4, None)], "id int, width int, height int, pixels binary")
    grid = messages.tile_grid(df, size=16)
    got = pixels.tiles(grid, "id", 16).collect()
    boxes = {(b.id, b.tile): b for b in messages.tile_boxes(grid.filter("id < 9"), 16).collect()}
    assert {(t.id, t.tile) for t in got} == set(boxes)
    for t in got:
        b, x = boxes[t.id, t.tile], images[t.id]
        if t.tile < 0:
            want = pixels.resized(x, 16, 16)
        else:
            want = pixels.resized(x, b.cols * 16, b.rows * 16)[b.y0 : b.y1, b.x0 : b.x1]
            assert (t.x0, t.y0) == (b.x0, b.y0)
        assert bytes(t.pixels) == want.tobytes()
    assert pixels.resize(df, 3, 3).filter("resized is null").count() == 3
    v = pixels.normalised(df.filter("id = 1"), (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)).first()["values"]
    assert np.allclose(np.array(v).reshape(3, 16, 16), ((images[1] / 255 - [0.485, 0.456, 0.406]) / [0.229, 0.224, 0.225]).transpose(2, 0, 1), atol=1e-5)


@pytest.mark.parametrize("n", [1, 24, 50, 51, 75, 76, 149, 230])
def test_band_by_the_padded_matrix(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 8)).astype(np.float32)
    df = spark.createDataFrame([("v", i, [float(y) for y in x[i]]) for i in range(n)], "video_id string, frame_idx int, embedding array<float>").repartition(3)
    got = {r.frame_idx: np.array(r.band) for r in vectors.band_vectors(df, "video_id").collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for w in range(-(-n // 50)):
        frames = np.clip(np.arange(w * 50 - 25, w * 50 + 75), 0, n - 1)
        padded = np.pad(unit[frames] @ unit[frames].T, ((0, 0), (50, 50)))
        for s in range(25, 75):
            if w * 50 + s - 25 < n:
                want[w * 50 + s - 25] = padded[s, s : s + 101]
    assert sorted(got) == sorted(want) == list(range(n))
    assert all(np.allclose(got[i], want[i], atol=1e-6) for i in want)


def test_mean_vectors(spark):
    r = np.random.default_rng(5)
    rows = [(k, j, i, [float(v) for v in r.normal(size=4)]) for i in range(300) for k, j in [(["a", "b", None][i % 3], i % 2)]]
    df = spark.createDataFrame(rows, "k string, j int, i int, embedding array<double>").repartition(7)
    got = {(x.k, x.j): np.array(x["mean"]) for x in vectors.mean_vectors(df, ["k", "j"]).collect()}
    for key in {(k, j) for k, j, _, _ in rows}:
        assert np.allclose(got[key], np.mean([v for k, j, _, v in rows if (k, j) == key], axis=0))
    assert len(got) == 6 and vectors.mean_vectors(df.limit(0), ["k", "j"]).count() == 0

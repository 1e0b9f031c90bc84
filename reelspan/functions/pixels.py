"""Images as 8-bit RGB bytes in row order: bicubic resizing, tiles by content, normalising."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: the sharpness of the bicubic kernel.
SHARPNESS = -0.5


def cubic(x: np.ndarray, a: float = SHARPNESS) -> np.ndarray:
    x = np.abs(x)
    return np.where(x < 1, ((a + 2) * x - (a + 3)) * x * x + 1, np.where(x < 2, (((x - 5) * x + 8) * x - 4) * a, 0.0))


@lru_cache(maxsize=256)
def weights(n: int, m: int) -> np.ndarray:
    """(m, n): how much each of n pixels of a line counts for each of the m of the resized one.

    The kernel is as wide as a new pixel where the line shrinks, so that none of the old ones is passed over.
    """
    scale = n / m
    wide = max(scale, 1.0)
    centre = (np.arange(m) + 0.5) * scale
    low, high = np.maximum(np.floor(centre - 2 * wide + 0.5), 0), np.minimum(np.floor(centre + 2 * wide + 0.5), n)
    at = np.arange(n)
    w = np.where((at >= low[:, None]) & (at < high[:, None]), cubic((at[None, :] + 0.5 - centre[:, None]) / wide), 0.0)
    return w / w.sum(1, keepdims=True)


def to_bytes(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(x + 0.5), 0, 255).astype(np.uint8)


def resized(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """(height, width, 3) of an image of the same form: lines first, then columns, with bytes between; a side that stays is not touched."""
    if image.shape[1] != width:
        image = to_bytes(np.einsum("mw,hwc->hmc", weights(image.shape[1], width), image))
    if image.shape[0] != height:
        image = to_bytes(np.einsum("mh,hwc->mwc", weights(image.shape[0], height), image))
    return image


def image_of(width: int | None, height: int | None, pixels: bytes | None) -> np.ndarray | None:
    """The pixels as an array; None where their number does not fit the size, or there are none."""
    if pixels is None or not width or not height or len(pixels) != 3 * width * height:
        return None
    return np.frombuffer(pixels, np.uint8).reshape(height, width, 3)


def resize(images: DataFrame, width: int, height: int, out: str = "resized") -> DataFrame:
    """images(width, height, pixels, ...) with `out`: the pixels at the new size, null where they do not fit theirs.  A task holds one batch of images."""
    names, at = images.columns, [images.columns.index(c) for c in ("width", "height", "pixels")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [None if (x := image_of(*(b.column(i)[r].as_py() for i in at))) is None else resized(x, width, height).tobytes() for r in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.binary())], [*names, out])

    return images.mapInArrow(run, T.StructType([*images.schema.fields, T.StructField(out, T.BinaryType())]))


def tiles(images: DataFrame, key: str, size: int = 448, thumbnail: bool = True) -> DataFrame:
    """(key, tile, x0, y0, pixels): images(key, width, height, pixels, cols, rows) resized to their grid and cut into tiles of size x size.

    Tile -1 is the whole image at that size, where there are several.  An image whose pixels do not fit its size has no rows.
    """
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own, width, height, pixels, cols, rows in zip(*(b.column(i).to_pylist() for i in range(6))):
                image = image_of(width, height, pixels)
                if image is None:
                    continue
                whole = resized(image, cols * size, rows * size)
                made = [(i, i % cols * size, i // cols * size, np.ascontiguousarray(whole[i // cols * size : (i // cols + 1) * size, i % cols * size : (i % cols + 1) * size]).tobytes()) for i in range(cols * rows)]
                if thumbnail and cols * rows > 1:
                    made.append((-1, 0, 0, resized(image, size, size).tobytes()))
                tile, x, y, data = zip(*made)
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(made), b.schema.field(0).type), pa.array(tile, pa.int32()), pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(data, pa.binary())], [key, "tile", "x0", "y0", "pixels"])

    given = images.select(key, "width", "height", "pixels", "cols", "rows")
    return given.mapInArrow(run, f"{key} {kind}, tile int, x0 int, y0 int, pixels binary")


def normalised(images: DataFrame, mean: tuple[float, float, float], deviation: tuple[float, float, float], pixels: str = "pixels", out: str = "values") -> DataFrame:
    """images with `out`: channel by channel, the lines of (byte / 255 - mean) / deviation, as a model takes them."""
    names, at = images.columns, images.columns.index(pixels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for x in b.column(at):
                data = x.as_py()
                made.append(None if data is None else ((np.frombuffer(data, np.uint8).reshape(-1, 3) / 255.0 - mean) / deviation).T.astype(np.float32).ravel())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.list_(pa.float32()))], [*names, out])

    return images.mapInArrow(run, T.StructType([*images.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))]))

"""Image measures in NumPy, as pandas UDFs over Spark's image struct or plain arrays."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lanczos(pixels: np.ndarray, height: int, width: int, a: int = 3) -> np.ndarray:
    """Resampled with the Lanczos kernel, widened when shrinking."""

    def weights(source: int, target: int) -> np.ndarray:
        scale = max(1.0, source / target)
        centre = (np.arange(target) + 0.5) * source / target
        x = (np.arange(source)[None] + 0.5 - centre[:, None]) / scale
        w = np.where(np.abs(x) < a, np.sinc(x) * np.sinc(x / a), 0.0)
        return w / w.sum(axis=1, keepdims=True)

    return weights(pixels.shape[0], height) @ pixels @ weights(pixels.shape[1], width).T


def dct_matrix(n: int) -> np.ndarray:
    """The orthonormal DCT-II."""
    k, x = np.arange(n)[:, None], np.arange(n)[None]
    m = np.sqrt(2.0 / n) * np.cos((2 * x + 1) * k * np.pi / (2 * n))
    m[0] = np.sqrt(1.0 / n)
    return m


def phash(grey: np.ndarray) -> str:
    """64-bit perceptual hash: low DCT block of the 32 x 32 image against the median of its AC terms, as 16 hex digits."""
    small = lanczos(np.asarray(grey, float), 32, 32) if grey.shape != (32, 32) else np.asarray(grey, float)
    m = dct_matrix(32)
    low = (m @ small @ m.T)[:8, :8].ravel()
    bits = low > np.median(low[1:])
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


#: Shares of red, green and blue in the luma (fixed values).
LUMA = np.array([0.2126, 0.7152, 0.0722])


def luma(rgb: np.ndarray) -> np.ndarray:
    """Brightness of the last axis' first three channels."""
    return np.asarray(rgb, float)[..., : len(LUMA)] @ LUMA


def alpha_box(alpha: np.ndarray, threshold: int = 16) -> list[int] | None:
    """Left, top, width, height of the pixels above the threshold."""
    ys, xs = np.nonzero(np.asarray(alpha) > threshold)
    if not len(xs):
        return None
    return [int(xs.min()), int(ys.min()), int(xs.max() - xs.min() + 1), int(ys.max() - ys.min() + 1)]


def mask_metrics(mask: np.ndarray) -> dict[str, float]:
    """Area, fill and side ratios, and how much of the border the mask touches."""
    mask = np.asarray(mask, bool)
    box = alpha_box(mask.astype(np.uint8), 0)
    area = int(mask.sum())
    if box is None:
        return {"area_ratio": 0.0, "fill_ratio": 0.0, "width_ratio": 0.0, "height_ratio": 0.0, "edge_touch": 0.0}
    border = np.concatenate([mask[0], mask[-1], mask[1:-1, 0], mask[1:-1, -1]])
    return {
        "area_ratio": area / mask.size,
        "fill_ratio": area / (box[2] * box[3]),
        "width_ratio": box[2] / mask.shape[1],
        "height_ratio": box[3] / mask.shape[0],
        "edge_touch": float(border.mean()),
    }


#: Widths of border and corner, and the limits above the centre (fixed values).
BORDER, CORNER, CORNER_LIMIT, BORDER_LIMIT = 24, 72, 13, 18


def bright_edges(grey: np.ndarray) -> tuple[float, float, bool]:
    """Is the rim of a picture lit? Returns (corner excess, border excess, risk).

    Both excesses are against the median of the middle half in each direction: the brightest of the four corner medians,
    and the 95th percentile of the four border strips, in which a pixel counts once for each strip that it lies in.
    """
    picture = np.asarray(grey, float)
    middle = np.median(picture[tuple(slice(n // 4, 3 * n // 4) for n in picture.shape)])
    # The corners are the same corner of the four mirror images.
    mirrored = (np.flip(picture, axes) for axes in ((), 0, 1, (0, 1)))
    corner = max(np.median(view[:CORNER, :CORNER]) for view in mirrored) - middle

    def strips(n: int) -> np.ndarray:
        """How many of the two strips across an axis hold each of its positions."""
        place = np.arange(n)
        return (place < BORDER).astype(int) + (place >= n - BORDER)

    hits = np.add.outer(*map(strips, picture.shape))
    border = np.percentile(np.repeat(picture, hits.ravel()), 95) - middle
    return float(corner), float(border), bool(corner > CORNER_LIMIT or border > BORDER_LIMIT)


class MaskProvider(Protocol):
    """What a segmentation model must offer; none is shipped."""

    def mask(self, image: np.ndarray, box: tuple[int, int, int, int]) -> tuple[np.ndarray, float]: ...


def decode(image: dict) -> np.ndarray:
    """Spark's image struct (BGR bytes) as height x width x channels in RGB order."""
    pixels = np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["nChannels"])
    return pixels[..., [2, 1, 0, *range(3, pixels.shape[2])]] if pixels.shape[2] >= 3 else pixels


def phash_of(values: Column, side: int) -> Column:
    """The hash of an image given as a flat array of side * side grey values."""

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda v: None if v is None or len(v) != side * side else phash(np.asarray(v, float).reshape(side, side)))

    return run(values)


def mask_area_of(values: Column, side: int) -> Column:
    """The share of positive values of an image given as a flat array."""

    @F.pandas_udf("double")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda v: None if v is None or len(v) != side * side else mask_metrics(np.asarray(v, float).reshape(side, side) > 0)["area_ratio"])

    return run(values)


def measured(image: Column, measure: Callable[[np.ndarray], float]) -> Column:
    """A number for each image struct."""

    @F.pandas_udf("double")
    def run(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([float(measure(decode(r))) for r in rows.to_dict("records")])

    return run(image)


def out_of_range(target: tuple[int, int, int], tolerance: int = 15, rgb: str = "rgb") -> tuple[Column, Column]:
    """Two faults of a background's mean colour: a channel beyond the tolerance, and blue not above red."""
    c = [F.get(F.col(rgb), F.lit(i)) for i in range(3)]
    far = F.lit(False)
    for have, want in zip(c, target, strict=True):
        far = far | (F.abs(have - want) > tolerance)
    return far, c[2] <= c[0]

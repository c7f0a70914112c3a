"""Masks and cut-outs in NumPy: regions, holes, morphology, white balance, overlap measures."""

from __future__ import annotations

import numpy as np

from .images import alpha_box


def components(mask: np.ndarray, diagonal: bool = True) -> np.ndarray:
    """Numbers from 1 for the connected regions, 0 elsewhere: the runs of each row are joined with those they touch above."""
    mask = np.asarray(mask, bool)
    turns = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(turns == 1)
    ends = np.nonzero(turns == -1)[1]
    reach = int(diagonal)
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(rows, np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        above, here = first[y - 1], first[y]
        while above < first[y] and here < first[y + 1]:
            if starts[above] < ends[here] + reach and starts[here] < ends[above] + reach:
                parent[root(here)] = root(above)
            if ends[above] < ends[here]:
                above += 1
            else:
                here += 1
    _, names = np.unique([root(i) for i in range(len(rows))], return_inverse=True)
    out = np.zeros(mask.shape, np.int64)
    for y, a, b, name in zip(rows, starts, ends, names, strict=True):
        out[y, a:b] = name + 1
    return out


def remove_small(mask: np.ndarray, least: int) -> np.ndarray:
    """Without the regions of fewer pixels."""
    regions = components(mask)
    keep = np.bincount(regions.ravel()) >= least
    keep[0] = False
    return keep[regions]


def fill_holes(mask: np.ndarray) -> np.ndarray:
    """With the background that no path along sides connects to the picture's border."""
    mask = np.asarray(mask, bool)
    outside = components(~mask, diagonal=False)
    rim = np.unique(np.concatenate([outside[0], outside[-1], outside[:, 0], outside[:, -1]]))
    return mask | ~np.isin(outside, rim[rim > 0])


#: The least region as pixels and as a share of the box, the weight of the overlap, and the most that area counts (fixed values).
LEAST_PIXELS, LEAST_SHARE, OVERLAP_WEIGHT, AREA_CAP = 24, 0.08, 2.0, 1.5


def best_region(mask: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    """The region that fits the box (left, top, width, height) best; none where all are too small. Ties: the first."""
    regions = components(mask)
    x, y, w, h = box
    size = max(1, w * h)
    least = max(LEAST_PIXELS, round(size * LEAST_SHARE))

    def score(name: int) -> float:
        region = regions == name
        a, b, c, d = alpha_box(region, 0)
        across, down = min(a + c, x + w) - max(a, x), min(b + d, y + h) - max(b, y)
        return OVERLAP_WEIGHT * max(0, across) * max(0, down) / (c * d) + min(region.sum() / size, AREA_CAP)

    areas = np.bincount(regions.ravel())
    fit = [n for n in range(1, len(areas)) if areas[n] >= least]
    return regions == max(fit, key=score) if fit else np.zeros(regions.shape, bool)


def _windows(values: np.ndarray, side: int, edge: int) -> np.ndarray:
    padded = np.pad(np.asarray(values), side // 2, constant_values=edge)
    return np.lib.stride_tricks.sliding_window_view(padded, (side, side))


def erode(mask: np.ndarray, side: int = 3) -> np.ndarray:
    """The least value in each square; beyond the border nothing counts. Also for alpha channels."""
    mask = np.asarray(mask)
    return _windows(mask, side, True if mask.dtype == bool else np.iinfo(mask.dtype).max).min(axis=(2, 3))


def dilate(mask: np.ndarray, side: int = 3) -> np.ndarray:
    mask = np.asarray(mask)
    return _windows(mask, side, False if mask.dtype == bool else np.iinfo(mask.dtype).min).max(axis=(2, 3))


def cleaned(mask: np.ndarray, box: tuple[int, int, int, int], side: int = 3) -> np.ndarray:
    """Opened, closed, reduced to the best region, holes filled."""
    opened = dilate(erode(np.asarray(mask, bool), side), side)
    closed = erode(dilate(opened, side), side)
    return fill_holes(best_region(closed, box))


#: Pixels above this alpha count, at least so many of them, and the bounds of a channel's gain (fixed values).
SOLID, SOLID_PIXELS, GAINS = 24, 20, (0.92, 1.08)


def white_balance(rgba: np.ndarray) -> np.ndarray:
    """Channels drawn towards their common mean over the solid pixels; a picture with few of them stays as it is."""
    solid = rgba[..., 3] > SOLID
    if solid.sum() < SOLID_PIXELS:
        return rgba
    mean = np.maximum(rgba[solid][:, :3].mean(axis=0, dtype=float), 1.0)
    out = rgba.copy()
    out[..., :3] = np.clip(rgba[..., :3] * np.clip(mean.mean() / mean, *GAINS), 0, 255).astype(rgba.dtype)
    return out


def trimmed(rgba: np.ndarray, padding: int = 5, threshold: int = 2) -> np.ndarray:
    """Cut to the pixels above the threshold and a padding; all of it where there are none."""
    box = alpha_box(rgba[..., 3], threshold)
    if box is None:
        return rgba
    x, y, w, h = box
    return rgba[max(0, y - padding) : y + h + padding, max(0, x - padding) : x + w + padding]


def channel_stats(pixels: np.ndarray) -> dict[str, list[float]]:
    """Mean, least and greatest value of each channel."""
    flat = np.asarray(pixels, float).reshape(-1, np.shape(pixels)[-1])
    return {"mean": flat.mean(axis=0).tolist(), "min": flat.min(axis=0).tolist(), "max": flat.max(axis=0).tolist()}


def mask_iou(a: np.ndarray, b: np.ndarray) -> float:
    """0 where both are empty."""
    either = np.logical_or(a, b).sum()
    return float(np.logical_and(a, b).sum() / either) if either else 0.0


def boundary(mask: np.ndarray, width: int = 1) -> np.ndarray:
    """The mask's pixels within `width` of its edge; the picture's border is an edge."""
    mask = np.asarray(mask, bool)
    return mask & ~_windows(mask, 2 * width + 1, False).min(axis=(2, 3))


def boundary_iou(a: np.ndarray, b: np.ndarray, width: int = 1) -> float:
    return mask_iou(boundary(a, width), boundary(b, width))

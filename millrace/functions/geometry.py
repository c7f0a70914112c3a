"""Bounding boxes as column algebra: no UDFs, so predicates and products stay in generated code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """A box by its left, top, width and height columns."""

    x: Column
    y: Column
    w: Column
    h: Column

    @classmethod
    def of(cls, prefix: str = "", suffix: str = "") -> Box:
        return cls(*[F.col(f"{prefix}{c}{suffix}") for c in "xywh"])

    @classmethod
    def array(cls, bbox: Column) -> Box:
        return cls(*[F.get(bbox, F.lit(i)) for i in range(4)])

    def strict(self, width: Column, height: Column) -> Column:
        """Wholly within the image, with positive sides."""
        inside = (self.x >= 0) & (self.y >= 0) & (self.w > 0) & (self.h > 0) & (self.x + self.w <= width) & (self.y + self.h <= height)
        return F.coalesce(inside, F.lit(False))

    def loose(self, width: Column, height: Column) -> Column:
        """Overlaps the image; may extend beyond it."""
        meets = (self.w > 0) & (self.h > 0) & (self.x < width) & (self.y < height) & (self.x + self.w > 0) & (self.y + self.h > 0)
        return F.coalesce(meets, F.lit(False))

    def error_code(self, width: Column, height: Column) -> Column:
        """The first fault: invalid_dimensions, invalid_bbox, non_positive, out_of_bounds; null if none."""
        missing = self.x.isNull() | self.y.isNull() | self.w.isNull() | self.h.isNull()
        return (
            F.when(width.isNull() | height.isNull() | (width <= 0) | (height <= 0), "invalid_dimensions")
            .when(missing, "invalid_bbox")
            .when((self.x < 0) | (self.y < 0) | (self.w <= 0) | (self.h <= 0), "non_positive")
            .when((self.x + self.w > width) | (self.y + self.h > height), "out_of_bounds")
        )

    def intersection(self, other: Box) -> Column:
        across = F.least(self.x + self.w, other.x + other.w) - F.greatest(self.x, other.x)
        down = F.least(self.y + self.h, other.y + other.h) - F.greatest(self.y, other.y)
        zero = F.lit(0)
        return F.greatest(across, zero) * F.greatest(down, zero)

    def union(self, other: Box) -> Column:
        return self.w * self.h + other.w * other.h - self.intersection(other)

    def iou(self, other: Box) -> Column:
        """Intersection over union; 0 where the union is not positive."""
        whole = self.union(other)
        return F.when(whole > 0, self.intersection(other) / whole).otherwise(0.0)

    def side(self) -> Column:
        return F.sqrt(F.greatest(self.w * self.h, F.lit(0)))

    def relative_area(self, width: Column, height: Column) -> Column:
        return self.w * self.h / F.greatest(width * height, F.lit(1))

    def expanded(self, width: Column, height: Column, margin: Column) -> list[Column]:
        """Left, top, right, bottom grown by the margin: floor and ceiling, clamped to the image."""
        zero = F.lit(0).cast("long")
        return [
            F.greatest(F.floor(self.x - margin), zero),
            F.greatest(F.floor(self.y - margin), zero),
            F.least(F.ceil(self.x + self.w + margin), width.cast("long")),
            F.least(F.ceil(self.y + self.h + margin), height.cast("long")),
        ]

    def ratio_margin(self, ratio: float = 0.07, least: int = 2) -> Column:
        """Half-even rounded share of the longer side."""
        return F.greatest(F.lit(least).cast("double"), F.bround(F.greatest(self.w, self.h) * F.lit(ratio), 0))

    def fraction_margin(self, fraction: float = 0.18, least: float = 10.0) -> Column:
        return F.greatest(F.lit(least), F.greatest(self.w, self.h) * F.lit(fraction))


def bilinear(top_left: Column, top_right: Column, bottom_left: Column, bottom_right: Column, dx: Column, dy: Column) -> Column:
    """The value at a fractional position between four neighbours."""
    top = top_left * (1 - dx) + top_right * dx
    return top * (1 - dy) + (bottom_left * (1 - dx) + bottom_right * dx) * dy


#: Cell paddings of the two grid variants (fixed values).
CELL_PADDING = {"wide": (72, 92), "tight": (64, 86)}


def grid_cells(size: Column, width: int = 976, height: int = 1280, padding: str = "wide") -> Column:
    """The placement cells of a combination of 2, 3 or else 4 objects, as an array of (x0, y0, x1, y1)."""
    px, py = CELL_PADDING[padding]
    mid_x, mid_y = width // 2, height // 2
    left, right, upper, lower = (px, mid_x - px), (mid_x, width - px), (py, mid_y), (mid_y, height - py)

    def cells(*spans: tuple[tuple[int, int], tuple[int, int]]) -> Column:
        return F.array(*[F.struct(F.lit(x[0]).alias("x0"), F.lit(y[0]).alias("y0"), F.lit(x[1]).alias("x1"), F.lit(y[1]).alias("y1")) for x, y in spans])

    tall, centre = (py, height - py), (width // 4, width * 3 // 4)
    return (
        F.when(size == 2, cells((left, tall), (right, tall)))
        .when(size == 3, cells((left, upper), (right, upper), (centre, lower)))
        .otherwise(cells((left, upper), (right, upper), (left, lower), (right, lower)))
    )

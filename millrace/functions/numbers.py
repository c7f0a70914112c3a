"""Numeric helpers whose rounding and guards are part of their meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamped_quota(n: Column, ratio: float = 0.10, least: int = 24, most: int = 128) -> Column:
    """min(most, max(least, n * ratio rounded half to even))."""
    return F.least(F.lit(most), F.greatest(F.lit(least), F.bround(n * F.lit(ratio), 0).cast("int")))


def effective_weight(n: Column, beta: float = 0.9999) -> Column:
    """(1 - beta) / (1 - beta ** n); 0 for a class without rows."""
    return F.when(n > 0, F.lit(1 - beta) / (1 - F.pow(F.lit(beta), n))).otherwise(0.0)


def wilson_lower(hits: Column, n: Column, z: float = 1.96) -> Column:
    """The lower end of the Wilson score interval; 0 for no trials."""
    p, zz = hits / F.greatest(n, F.lit(1)), z * z
    low = (p + zz / (2 * n) - z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)
    return F.when(n > 0, low).otherwise(0.0)


def piecewise(u: Column, points: list[tuple[float, float]]) -> Column:
    """Linear interpolation between points (u, value) in order of u; the last value beyond them."""
    out = F.lit(float(points[-1][1]))
    for (a, x), (b, y) in reversed(list(zip(points, points[1:], strict=False))):
        out = F.when((u >= a) & (u <= b), F.lit(x) + F.lit(y - x) * ((u - F.lit(a)) / F.lit(b - a))).otherwise(out)
    return out


def pearson(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Correlation from sums; 0 where undefined."""
    top = n * sxy - sx * sy
    below = F.sqrt(F.greatest(n * sxx - sx * sx, F.lit(0.0))) * F.sqrt(F.greatest(n * syy - sy * sy, F.lit(0.0)))
    return F.coalesce(F.when(below > 0, top / below), F.lit(0.0))

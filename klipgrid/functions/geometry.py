"""Boxes, landmarks and histograms as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOSE_TIP = 1  # landmark index


def iou(ax0: Column, ay0: Column, ax1: Column, ay1: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Intersection over union of two boxes; 0 where the union is empty."""
    w = F.greatest(F.lit(0.0), F.least(ax1, bx1) - F.greatest(ax0, bx0))
    h = F.greatest(F.lit(0.0), F.least(ay1, by1) - F.greatest(ay0, by0))
    both = w * h
    union = (ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def bhattacharyya(a: Column, b: Column) -> Column:
    """Distance of two histograms: sqrt(max(0, 1 - sum sqrt(ab) / sqrt(sum a * sum b)))."""
    common = _sum(F.zip_with(a, b, lambda x, y: F.sqrt(x * y)))
    scale = F.sqrt(_sum(a) * _sum(b))
    return F.sqrt(F.greatest(F.lit(0.0), 1 - F.when(scale > 0, common / scale).otherwise(F.lit(1.0))))


def landmark_box(points: Column) -> Column:
    """(x0, y0, x1, y1) around points <x, y>."""
    x, y = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def smoothed(series: Column, k: int) -> Column:
    """Moving mean of an array with its ends repeated; k <= 1 or one value: unchanged."""
    n = F.size(series)
    at = lambda i: F.element_at(series, F.greatest(F.lit(1), F.least(n, i)))
    mean = lambda i: sum((at(i + 1 + j) for j in range(-(k // 2), k - k // 2)), F.lit(0.0)) / k
    out = F.transform(F.sequence(F.lit(0), n - 1), mean)
    return series if k <= 1 else F.when(n > 1, out).otherwise(series)


def crop_side(widths: Column, scale: float = 1.6) -> Column:
    """Side of the crop: ``scale`` times the median extent over the frames."""
    s = F.array_sort(widths)
    n = F.size(s)
    mid = (F.element_at(s, F.floor((n + 1) / 2).cast("int")) + F.element_at(s, F.floor((n + 2) / 2).cast("int"))) / 2
    return mid * scale


def int_box(cx: Column, cy: Column, side: Column) -> tuple[Column, Column, Column]:
    """Pixel box that is cropped, rounded half to even."""
    return F.rint(cx - side / 2).cast("int"), F.rint(cy - side / 2).cast("int"), F.rint(side).cast("int")


def pad_fraction(x0: Column, y0: Column, side: Column, width: Column, height: Column) -> Column:
    """Share of a box that lies outside the picture."""
    zero = F.lit(0)
    l, t = F.greatest(zero, -x0), F.greatest(zero, -y0)
    r, b = F.greatest(zero, x0 + side - width), F.greatest(zero, y0 + side - height)
    return 1 - ((side - l - r) * (side - t - b)).cast("double") / (side * side)


def to_clip(p: Column, origin: Column, side: Column, size: int) -> Column:
    """A source coordinate in clip pixels."""
    return (p - origin) * (F.lit(float(size)) / side)


def euler_angles(m: Column) -> tuple[Column, Column, Column]:
    """(pitch, yaw, roll) in degrees of the rotation in a row-major 4 x 4 (or 3 x 3) matrix.

    Columns are divided by their length first, so a uniform scale changes nothing.
    At a yaw of 90 degrees pitch and roll turn about one axis; all of it is pitch then.
    """
    wide = F.when(F.size(m) == 16, 4).otherwise(3)
    at = lambda i, j: F.try_element_at(m, (F.lit(i) * wide + j + 1).cast("int")).cast("double")
    size = [F.sqrt(sum((at(i, j) * at(i, j) for i in range(3)), F.lit(0.0))) for j in range(3)]
    r = lambda i, j: F.when(size[j] > 0, at(i, j) / size[j])
    flat = F.sqrt(r(2, 1) * r(2, 1) + r(2, 2) * r(2, 2))
    locked = flat < 1e-9
    pitch = F.when(locked, F.atan2(-r(1, 2), r(1, 1))).otherwise(F.atan2(r(2, 1), r(2, 2)))
    roll = F.when(locked, F.lit(0.0)).otherwise(F.atan2(r(1, 0), r(0, 0)))
    return F.degrees(pitch), F.degrees(F.atan2(-r(2, 0), flat)), F.degrees(roll)


def scale_720(width: Column, height: Column) -> Column:
    """Factor that brings the shorter side to 720."""
    return F.lit(720.0) / F.least(width, height)

"""Boxes: validity, transforms under the eight symmetries, text forms of formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_box(box: Column) -> Column:
    """Four finite numbers (x, y, w, h), not negative, of some size, within the unit square."""
    finite = F.forall(box, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) & (v >= 0))
    x, y, w, h = (F.get(box, i) for i in range(4))
    return F.coalesce((F.size(box) == 4) & finite & (w > 0) & (h > 0) & (x + w <= 1 + 1e-9) & (y + h <= 1 + 1e-9), F.lit(False))


def turn_box(box: Column, mirrored: bool, quarter_turns: int) -> Column:
    """The box after an optional mirroring and counter-clockwise quarter turns, to five decimals."""
    x, y, w, h = (F.get(box, i) for i in range(4))
    if mirrored:
        x = 1 - x - w
    for _ in range(quarter_turns % 4):
        x, y, w, h = y, 1 - x - w, h, w
    return F.array(*(F.round(v, 5) for v in (x, y, w, h)))


def yolo_line(cls: Column, box: Column) -> Column:
    """``class xc yc w h`` of a unit box given by its corner."""
    x, y, w, h = (F.get(box, i) for i in range(4))
    return F.format_string("%d %.6f %.6f %.6f %.6f", cls, x + w / 2, y + h / 2, w, h)


def pixel_box(box: Column, width: Column, height: Column) -> Column:
    return F.array(F.get(box, 0) * width, F.get(box, 1) * height, F.get(box, 2) * width, F.get(box, 3) * height)

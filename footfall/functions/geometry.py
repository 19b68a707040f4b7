"""Box arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The analysis grid, 10 x 10 cells of a 1280 x 720 picture.
CELL_W = 128.0
CELL_H = 72.0

BOX = ["x1", "y1", "x2", "y2"]


def box(prefix: str = "") -> Column:
    """A box struct from four columns sharing a prefix."""
    return F.struct(*[F.col(prefix + c).cast("double").alias(c) for c in BOX])


def centre(lo: Column, hi: Column) -> Column:
    return (lo.cast("double") + hi.cast("double")) / F.lit(2.0)


def cell(position: Column, size: float) -> Column:
    """Grid cell of a pixel position; not clipped to the picture."""
    return F.floor(position / F.lit(size)).cast("int")


def area(b: Column) -> Column:
    zero = F.lit(0.0)
    return F.greatest(zero, b["x2"] - b["x1"]) * F.greatest(zero, b["y2"] - b["y1"])


def iou(a: Column, b: Column) -> Column:
    """Overlap of two boxes over their union; 0 when they do not overlap."""
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(zero, F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    inter = w * h
    union = area(a) + area(b) - inter
    return F.when((inter > 0) & (union > 0), inter / union).otherwise(zero)


def clip(b: Column, width: Column, height: Column) -> Column:
    """Box moved inside the picture and at least one pixel wide and high. Where a corner or a size of the
    picture is missing there is no box: all corners are NULL."""
    zero, one = F.lit(0.0), F.lit(1.0)
    w, h = width.cast("double"), height.cast("double")
    x1 = F.greatest(zero, F.least(w - one, b["x1"]))
    y1 = F.greatest(zero, F.least(h - one, b["y1"]))
    x2 = F.greatest(x1 + one, F.least(w, b["x2"]))
    y2 = F.greatest(y1 + one, F.least(h, b["y2"]))
    known = w.isNotNull() & h.isNotNull()
    for c in BOX:
        known = known & b[c].isNotNull()
    return F.struct(*[F.when(known, c).alias(name) for name, c in zip(BOX, (x1, y1, x2, y2))])

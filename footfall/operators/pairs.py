"""All pairs of overlapping boxes of a frame, by a grid join.

Boxes are put on grids whose cells double in size. A box's own grid is the first with cells no smaller
than its longer side, so it lies in at most four cells of that grid and of every coarser one. Two
boxes meet on the coarser of their two grids, in every cell they share; the pair is reported in one of
them only, the one with the upper left corner of their common area. So work follows the boxes that
lie near each other, whatever their number, and a crowded frame is spread over as many tasks as it has
cells.

Equal boxes are folded into the best of them before the join and counted, so a thousand copies of a
box are one row, not half a million pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import geometry as geo
from footfall.operators.geometry import BOX, FRAME_KEY, _leaders, _null_safe_join, _prepare

FINEST = 3  # log2 of the smallest cell, in pixels


def _cells(low: Column, high: Column, size: Column) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def _on_grids(boxes: DataFrame, levels: Column) -> DataFrame:
    """``boxes`` once for each cell they touch on the grids ``levels``."""
    rows = boxes.withColumn("grid", F.explode(levels)).withColumn("size", F.pow(F.lit(2.0), F.col("grid")))
    rows = rows.withColumn("cx", F.explode(_cells(F.col("x1"), F.col("x2"), F.col("size"))))
    return rows.withColumn("cy", F.explode(_cells(F.col("y1"), F.col("y2"), F.col("size"))))


def _candidates(leaders: DataFrame, group: list[str]) -> DataFrame:
    """Pairs of different boxes that share the cell of their common corner: structs ``a`` and ``b``."""
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    level = F.greatest(F.ceil(F.log2(side)).cast("int"), F.lit(FINEST))
    placed = leaders.withColumn("level", level)
    # One row a grid that is in use; there are no more grids than a double has exponents.
    grids = sorted(r[0] for r in placed.select("level").distinct().collect())
    used = F.array(*map(F.lit, grids)) if grids else F.array().cast("array<int>")
    box = F.struct(*BOX, "rank", "det_id", "n", "level")
    cell = [*group, "grid", "cx", "cy"]
    coarse = _on_grids(placed, F.array("level")).select(*cell, "size", box.alias("b"))
    fine = _on_grids(placed, F.filter(used, lambda g: g >= F.col("level"))).select(*cell, box.alias("a"))
    met = _null_safe_join(coarse, fine, cell, "inner")
    a, b = F.col("a"), F.col("b")
    once = (a["level"] < b["level"]) | ((a["level"] == b["level"]) & (a["rank"] < b["rank"]))
    corner = ((F.floor(F.greatest(a["x1"], b["x1"]) / F.col("size")) == F.col("cx"))
              & (F.floor(F.greatest(a["y1"], b["y1"]) / F.col("size")) == F.col("cy")))
    return met.where(once & corner)


def overlapping_pairs(
    boxes: DataFrame,
    frame_key: list[str] | None = None,
    order: list[str] | None = None,
    least: float = 0.0,
) -> DataFrame:
    """Each pair of boxes of one frame and class that overlap, by ``least`` or more of their union.

    ``det_id`` is the better ranked box (by confidence, then ``order``) and ``other_id`` the other;
    each stands for all boxes with its corners, and ``pairs`` says for how many pairs. Boxes with copies
    also give a row with themselves (``iou`` 1). Boxes without area or with a missing corner overlap nothing.
    """
    order = order or ["det_id"]
    group, _, typed, solid = _prepare(boxes, frame_key or FRAME_KEY, order)
    leaders = _leaders(typed.where(solid), group, order, ["det_id"]).withColumn("det_id", F.col("row.det_id")).drop("row")
    iou = geo.iou(F.col("a"), F.col("b"))
    first = F.col("a.rank") < F.col("b.rank")
    pairs = _candidates(leaders, group).withColumn("iou", iou).where((F.col("iou") > 0) & (F.col("iou") >= least)).select(
        *group,
        F.when(first, F.col("a.det_id")).otherwise(F.col("b.det_id")).alias("det_id"),
        F.when(first, F.col("b.det_id")).otherwise(F.col("a.det_id")).alias("other_id"),
        "iou", (F.col("a.n") * F.col("b.n")).alias("pairs"))
    copies = leaders.where("n > 1").select(
        *group, "det_id", F.col("det_id").alias("other_id"), F.lit(1.0).alias("iou"),
        (F.col("n") * (F.col("n") - 1) / 2).cast("bigint").alias("pairs"))
    return pairs.unionByName(copies)

"""Gold: six aggregate tables over Silver.

``variant="stream"`` works on pixel boxes and whole seconds,
``variant="batch"`` on the recorded centroid and milliseconds.
Distinct counts are exact; Spark plans them as a partial aggregate on
(group, track) first, so one busy camera does not end in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.cleaning import seconds_between, trunc_to
from footfall.functions.geometry import CELL_H, CELL_W, cell, centre
from footfall.schemas import columns_of

CAMERA = ["store_id", "camera_id"]
ZONE = [*CAMERA, "zone_x", "zone_y"]


def position(variant: str) -> tuple[Column, Column]:
    """Where a detection stands, in pixels."""
    if variant == "batch":
        return F.col("centroid_x"), F.col("centroid_y")
    return (
        centre(F.col("bbox_x1"), F.col("bbox_x2")),
        centre(F.col("bbox_y1"), F.col("bbox_y2")),
    )


def with_zone(silver: DataFrame, variant: str = "stream") -> DataFrame:
    cx, cy = position(variant)
    return silver.withColumns({
        "cx": cx, "cy": cy, "zone_x": cell(cx, CELL_W), "zone_y": cell(cy, CELL_H),
    })


def area_ratio() -> Column:
    """Share of the picture a box covers; NULL when the picture size is unknown."""
    w = F.col("bbox_x2").cast("double") - F.col("bbox_x1").cast("double")
    h = F.col("bbox_y2").cast("double") - F.col("bbox_y1").cast("double")
    picture = F.col("img_w").cast("double") * F.col("img_h").cast("double")
    return w * h / F.nullif(picture, F.lit(0.0))


def with_time(rows: DataFrame, unit: str) -> DataFrame:
    """Adds the start of the ``unit`` (``ts_minute``, ``ts_hour``), unless it is there: rows that
    lie together by it then stay where they are."""
    name = f"ts_{unit}"
    return rows if name in rows.columns else rows.withColumn(name, trunc_to(unit, "capture_ts"))


def gold_minute_by_cam(silver: DataFrame) -> DataFrame:
    return (
        with_time(silver, "minute")
        .withColumn("ratio", area_ratio())
        .groupBy(*CAMERA, "ts_minute")
        .agg(
            F.count(F.lit(1)).alias("detection_count"),
            F.count_distinct("track_id").alias("unique_tracks"),
            F.avg("conf").alias("avg_conf"),
            F.avg("ratio").alias("bbox_area_ratio_avg"),
        )
    )


def gold_hour_by_cam(silver: DataFrame) -> DataFrame:
    return (
        with_time(silver, "hour")
        .groupBy(*CAMERA, "ts_hour")
        .agg(
            F.count(F.lit(1)).alias("detection_count"),
            F.count_distinct("track_id").alias("unique_tracks"),
            F.avg("conf").alias("avg_conf"),
        )
    )


def gold_people_per_minute(silver: DataFrame) -> DataFrame:
    return (
        with_time(silver, "minute")
        .groupBy(*CAMERA, "ts_minute")
        .agg(
            F.count(F.lit(1)).alias("detections"),
            F.count_distinct("track_id").alias("unique_people"),
        )
    )


def gold_zone_heatmap(silver: DataFrame, variant: str = "stream") -> DataFrame:
    return with_zone(silver, variant).groupBy(*ZONE).agg(
        F.count(F.lit(1)).alias("hits"),
        F.count_distinct("track_id").alias("unique_tracks"),
    )


def dwell_of_visits(visits: DataFrame, whole_seconds: bool) -> DataFrame:
    """Zone dwell from one row per (track, zone) with its first and last time."""
    stay = seconds_between(F.col("start_time"), F.col("end_time"), whole_seconds)
    return visits.withColumn("dwell", stay).groupBy(*ZONE).agg(
        F.count(F.lit(1)).alias("visits"),
        F.sum("dwell").alias("total_dwell_seconds"),
        F.avg("dwell").alias("avg_dwell_seconds"),
    )


def gold_zone_dwell(silver: DataFrame, variant: str = "stream") -> DataFrame:
    visits = with_zone(silver, variant).groupBy(*ZONE, "track_id").agg(
        F.min("capture_ts").alias("start_time"),
        F.max("capture_ts").alias("end_time"),
    )
    return dwell_of_visits(visits, whole_seconds=variant == "stream")


def gold_track_summary(silver: DataFrame, variant: str = "stream") -> DataFrame:
    cx, cy = position(variant)
    extent = (
        silver.withColumns({"cx": cx, "cy": cy})
        .groupBy(*CAMERA, "track_id")
        .agg(
            F.count(F.lit(1)).alias("frames"),
            F.min("capture_ts").alias("start_time"),
            F.max("capture_ts").alias("end_time"),
            F.min("cx").alias("min_x"),
            F.max("cx").alias("max_x"),
            F.min("cy").alias("min_y"),
            F.max("cy").alias("max_y"),
            F.avg("cx").alias("avg_x"),
            F.avg("cy").alias("avg_y"),
            F.avg("conf").alias("avg_conf"),
        )
    )
    return finish_track_summary(extent, whole_seconds=variant == "stream")


def finish_track_summary(extent: DataFrame, whole_seconds: bool) -> DataFrame:
    """Adds duration and movement to per-track extremes."""
    return extent.withColumns({
        "duration_seconds": seconds_between(F.col("start_time"), F.col("end_time"), whole_seconds),
        "delta_x": F.col("max_x") - F.col("min_x"),
        "delta_y": F.col("max_y") - F.col("min_y"),
    }).select(*columns_of("gold_track_summary"))


GOLD = {
    "gold_minute_by_cam": gold_minute_by_cam,
    "gold_hour_by_cam": gold_hour_by_cam,
    "gold_people_per_minute": gold_people_per_minute,
    "gold_zone_heatmap": gold_zone_heatmap,
    "gold_zone_dwell": gold_zone_dwell,
    "gold_track_summary": gold_track_summary,
}

"""Dashboard queries over the Gold tables.

Cards that read one table are answered in one pass.  Top-k panels break ties
by key.  ``at`` narrows any panel's input to a store or camera.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.gold import CAMERA


def at(gold: DataFrame, store_id: str | None = None, camera_id: str | None = None) -> DataFrame:
    if store_id is not None:
        gold = gold.where(F.col("store_id") == store_id)
    if camera_id is not None:
        gold = gold.where(F.col("camera_id") == camera_id)
    return gold


def _or_zero(c: Column, zero: float = 0) -> Column:
    return F.coalesce(c, F.lit(zero))


def _zone_label() -> Column:
    return F.concat(
        F.lit("Zone ("), F.col("zone_x").cast("string"), F.lit(","),
        F.col("zone_y").cast("string"), F.lit(")"),
    )


def _track_label() -> Column:
    return F.concat(F.lit("Track #"), F.col("track_id").cast("string"))


def people_totals(people: DataFrame) -> DataFrame:
    return people.agg(
        _or_zero(F.sum("detections")).alias("total_detections"),
        _or_zero(F.sum("unique_people")).alias("unique_tracks"),
        F.count_distinct("camera_id").alias("active_cameras"),
        _or_zero(F.avg("detections"), 0.0).alias("avg_detections_per_min"),
    )


def people_series(people: DataFrame) -> DataFrame:
    return people.select(
        F.col("ts_minute").alias("time"), F.col("camera_id").alias("metric"),
        F.col("detections").alias("value"),
    ).orderBy("time")


def people_by_camera(people: DataFrame) -> DataFrame:
    return people.groupBy(F.col("camera_id").alias("metric")).agg(
        F.sum("detections").alias("value")
    ).orderBy(F.desc("value"), "metric")


def people_table(people: DataFrame, k: int = 100) -> DataFrame:
    return people.select("ts_minute", *CAMERA, "detections", "unique_people").orderBy(
        "ts_minute", *CAMERA
    ).limit(k)


def track_totals(tracks: DataFrame) -> DataFrame:
    return tracks.agg(
        F.count(F.lit(1)).alias("total_tracks"),
        _or_zero(F.avg("duration_seconds"), 0.0).alias("avg_duration"),
        _or_zero(F.avg("avg_conf"), 0.0).alias("avg_confidence"),
        _or_zero(F.sum("frames")).alias("total_frames"),
    )


def track_series(tracks: DataFrame) -> DataFrame:
    return tracks.select(
        F.col("end_time").alias("time"), F.col("track_id").cast("string").alias("metric"),
        F.col("duration_seconds").alias("value"),
    ).orderBy("time")


def track_top(tracks: DataFrame, measure: str, k: int = 15) -> DataFrame:
    """Top tracks by ``duration_seconds`` or ``avg_conf``."""
    return tracks.orderBy(F.desc(measure), *CAMERA, "track_id").limit(k).select(
        _track_label().alias("track"), measure
    )


def tracks_by_camera(tracks: DataFrame) -> DataFrame:
    return tracks.groupBy("camera_id").agg(F.count(F.lit(1)).alias("tracks")).orderBy(
        F.desc("tracks"), "camera_id"
    )


def track_table(tracks: DataFrame, k: int = 100) -> DataFrame:
    return tracks.select(
        *CAMERA, "track_id", "frames", "duration_seconds", "delta_x", "delta_y", "avg_conf"
    ).orderBy("frames", *CAMERA, "track_id").limit(k)


def zone_totals(dwell: DataFrame) -> DataFrame:
    return dwell.agg(
        _or_zero(F.sum("visits")).alias("total_visits"),
        _or_zero(F.avg("avg_dwell_seconds"), 0.0).alias("avg_dwell"),
        F.count(F.lit(1)).alias("active_zones"),
        _or_zero(F.max("avg_dwell_seconds"), 0.0).alias("hotspot_dwell"),
    )


def zone_top(dwell: DataFrame, measure: str, name: str, k: int = 15) -> DataFrame:
    """Top zones by ``avg_dwell_seconds`` or ``visits``."""
    return dwell.orderBy(F.desc(measure), *CAMERA, "zone_x", "zone_y").limit(k).select(
        _zone_label().alias("zone"), F.col(measure).alias(name)
    )


def heatmap_table(heatmap: DataFrame, k: int = 50) -> DataFrame:
    return heatmap.orderBy(F.desc("hits"), *CAMERA, "zone_x", "zone_y").limit(k).select(
        "zone_x", "zone_y", "hits", "unique_tracks"
    )


def zone_table(dwell: DataFrame, k: int = 50) -> DataFrame:
    return dwell.orderBy(F.desc("visits"), *CAMERA, "zone_x", "zone_y").limit(k).select(
        *CAMERA, "zone_x", "zone_y", "visits", "total_dwell_seconds", "avg_dwell_seconds"
    )

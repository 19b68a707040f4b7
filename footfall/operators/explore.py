"""Exploration queries over Silver and Gold.

``silver`` is either variant of the Silver table unless centroids are used,
which only the batch variant has.  Queries that the analyst reads as a report
take ``limit``; everything else returns all groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.cleaning import millis_between, trunc_to
from footfall.functions.geometry import CELL_H, CELL_W
from footfall.operators.gold import CAMERA


def _gap(a, b):
    return millis_between(a, b) / F.lit(1000.0)


def silver_totals(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_detections"),
        F.count_distinct("frame_index").alias("total_frames"),
        F.count_distinct("track_id").alias("total_tracks"),
    )


def missing_frames(silver: DataFrame) -> DataFrame:
    """How many frame numbers between the first and the last are absent."""
    span = F.max("frame_index") - F.min("frame_index") + F.lit(1)
    return silver.select("frame_index").distinct().agg(
        F.min("frame_index").alias("min_frame"),
        F.max("frame_index").alias("max_frame"),
        F.count(F.lit(1)).alias("frame_count"),
        span.alias("expected_frames"),
        (span - F.count(F.lit(1))).alias("missing_frames"),
    )


def people_per_frame(silver: DataFrame, limit: int | None = None) -> DataFrame:
    counts = silver.groupBy("frame_index").agg(F.count(F.lit(1)).alias("num_person"))
    return counts.orderBy("frame_index").limit(limit) if limit else counts


def conf_percentiles(
    silver: DataFrame, points: tuple[float, ...] = (0.1, 0.5, 0.9), accuracy: int = 100_000
) -> DataFrame:
    """Confidence percentiles: the smallest value that covers a share of the rows, off by
    at most one in ``accuracy`` of the ranks. One pass, merged from partial sketches."""
    return silver.agg(*[
        F.percentile_approx("conf", p, accuracy).alias(f"p{round(100 * p)}") for p in points])


def ts_gaps(silver: DataFrame, first: int = 20) -> DataFrame:
    """Gaps between the first rows in time order.

    Only ``first`` rows matter, so they are taken with a distributed top-k and
    the global window sees nothing else.
    """
    head = silver.select("capture_ts").orderBy("capture_ts").limit(first)
    before = F.lag("capture_ts").over(Window.orderBy("capture_ts"))
    return head.withColumn("prev_ts", before).withColumn(
        "gap_seconds", _gap(F.col("prev_ts"), F.col("capture_ts"))
    )


def ts_gaps_by_camera(silver: DataFrame, first: int | None = None) -> DataFrame:
    """The same per camera, for all rows or the ``first`` of each.

    A camera may hold most of the rows, so windows run over its days: the first
    row of a day takes the last time of the day before and goes on from its
    count. With ``first`` the row-number filter is applied before the shuffle.
    """
    order = ["capture_ts", "frame_index", "det_id"]
    rows = silver.select(*CAMERA, *order)
    if first is not None:
        per_camera = Window.partitionBy(*CAMERA)
        head = rows.withColumn("rn", F.row_number().over(per_camera.orderBy(*order))).where(F.col("rn") <= first)
        numbered = head.withColumn("prev_ts", F.lag("capture_ts").over(per_camera.orderBy("rn")))
    else:
        day = [*CAMERA, "day"]
        rows = rows.withColumn("day", F.col("capture_ts").cast("date"))
        in_order = Window.partitionBy(*CAMERA).orderBy("day")
        days = rows.groupBy(*day).agg(F.count(F.lit(1)).alias("n"), F.max("capture_ts").alias("last")).select(
            *day, F.lag("last").over(in_order).alias("last"),
            F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("n"))
        per_day = Window.partitionBy(*day).orderBy(*order)
        numbered = rows.withColumns({
            "place": F.row_number().over(per_day), "before": F.lag("capture_ts").over(per_day),
        }).join(days, day).withColumns({
            "rn": (F.col("n") + F.col("place")).cast("int"), "prev_ts": F.coalesce("before", "last")})
    return numbered.select(
        *CAMERA, "rn", "capture_ts", "prev_ts",
        _gap(F.col("prev_ts"), F.col("capture_ts")).alias("gap_seconds"),
    )


def track_stats(silver: DataFrame) -> DataFrame:
    return silver.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("frames_visible"),
        F.min("capture_ts").alias("start_time"),
        F.max("capture_ts").alias("end_time"),
    ).withColumn("duration_seconds", _gap(F.col("start_time"), F.col("end_time")))


def track_timeline(silver: DataFrame) -> DataFrame:
    return track_stats(silver).drop("frames_visible")


def track_mean_position(silver: DataFrame) -> DataFrame:
    return silver.groupBy("track_id").agg(
        F.avg("centroid_x").alias("avg_x"), F.avg("centroid_y").alias("avg_y")
    )


def track_extent(silver: DataFrame) -> DataFrame:
    """Smallest and largest position per track and their distance."""
    return silver.groupBy("track_id").agg(
        F.min("centroid_x").alias("min_x"), F.max("centroid_x").alias("max_x"),
        F.min("centroid_y").alias("min_y"), F.max("centroid_y").alias("max_y"),
    ).withColumns({
        "delta_x": F.col("max_x") - F.col("min_x"),
        "delta_y": F.col("max_y") - F.col("min_y"),
    })


def track_movement(silver: DataFrame) -> DataFrame:
    """Sideways movement; ``start_x`` and ``end_x`` are the smallest and largest x."""
    return silver.groupBy("track_id").agg(
        F.min("centroid_x").alias("start_x"), F.max("centroid_x").alias("end_x")
    ).withColumn("movement_x", F.col("end_x") - F.col("start_x"))


def _grid(silver: DataFrame) -> DataFrame:
    return silver.withColumns({
        "gx": F.floor(F.col("centroid_x") / F.lit(CELL_W)).cast("double"),
        "gy": F.floor(F.col("centroid_y") / F.lit(CELL_H)).cast("double"),
    })


def heatmap_grid(silver: DataFrame) -> DataFrame:
    return _grid(silver).groupBy("gx", "gy").agg(F.count(F.lit(1)).alias("hits"))


def dwell_top_stays(silver: DataFrame, k: int = 20) -> DataFrame:
    stays = _grid(silver).groupBy("track_id", "gx", "gy").agg(
        F.min("capture_ts").alias("start_time"), F.max("capture_ts").alias("end_time")
    ).withColumn("duration_seconds", _gap(F.col("start_time"), F.col("end_time")))
    return stays.orderBy(F.desc("duration_seconds"), "track_id", "gx", "gy").limit(k)


def people_per_second(silver: DataFrame) -> DataFrame:
    return silver.groupBy(trunc_to("second", "capture_ts").alias("sec")).agg(
        F.count(F.lit(1)).alias("detections"),
        F.count_distinct("track_id").alias("unique_people"),
    )


def silver_class_track_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("class_name", "track_id").agg(F.count(F.lit(1)).alias("total"))


def top_tracks_duration(tracks: DataFrame, k: int = 10) -> DataFrame:
    return tracks.select(*CAMERA, "track_id", "duration_seconds").orderBy(
        F.desc("duration_seconds"), *CAMERA, "track_id"
    ).limit(k)


def top_tracks_dx(tracks: DataFrame, k: int = 10) -> DataFrame:
    return tracks.select(*CAMERA, "track_id", "delta_x", "delta_y").orderBy(
        F.desc("delta_x"), *CAMERA, "track_id"
    ).limit(k)


def gold_latest(gold: DataFrame, ts: str, k: int = 20) -> DataFrame:
    """The newest buckets of a minute or hour table."""
    return gold.orderBy(F.desc(ts), *CAMERA).limit(k)

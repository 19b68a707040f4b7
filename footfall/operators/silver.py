"""Silver: one clean row per detection.

Two rule sets share the code.  ``stream`` fills defaults (track -1, confidence 0,
capture time now) and rounds boxes to pixels; ``batch`` reads values as they are
and so drops detections without a track.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import cleaning as clean
from footfall.schemas import FRAME_BATCH, FRAME_STREAM, columns_of, struct_of

MIN_CONF = 0.4
DEDUP_KEY = ["store_id", "camera_id", "frame_index", "det_id"]
_JSON_OPTIONS = {"allowNonNumericNumbers": "false"}


def _detections(bronze: DataFrame, schema: str, keep: list[str]) -> DataFrame:
    """Bronze columns ``keep`` x the detections of each payload.

    The parsed frame leaves the first generator as plain columns.  Filters on
    them stop there, so the payload is parsed once; over a projected struct
    Catalyst would copy the parser into every filter it pushes down.  A payload
    without a detection list gives no row.
    """
    frame = F.from_json("payload", struct_of(schema), _JSON_OPTIONS)
    known = [F.col(c).alias(f"b_{c}") for c in keep]
    return bronze.select(*known, F.inline(F.array(frame))).withColumn("det", F.explode("detections"))


def parse_detections(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Payload to typed detections under the ``stream`` rules."""
    instant = F.current_timestamp() if now is None else now
    box = {c: clean.pixel(f"det.bbox.{c}") for c in ("x1", "y1", "x2", "y2")}
    keep = ["schema_version", "pipeline_run_id", "store_id", "camera_id"]
    return _detections(bronze, FRAME_STREAM, keep).select(
        F.col("b_schema_version").alias("schema_version"),
        F.coalesce("b_pipeline_run_id", "pipeline_run_id").alias("pipeline_run_id"),
        F.col("b_store_id").alias("store_id"),
        F.col("b_camera_id").alias("camera_id"),
        F.col("frame_index").try_cast("bigint").alias("frame_index"),
        clean.capture_time("capture_ts", instant).alias("capture_ts"),
        clean.whole_number("image_size.width", 0).alias("img_w"),
        clean.whole_number("image_size.height", 0).alias("img_h"),
        F.col("det.det_id").alias("det_id"),
        clean.normalize_class("det.class").alias("class_name"),
        clean.whole_number("det.class_id", -1).alias("class_id"),
        clean.confidence("det.conf").alias("conf"),
        box["x1"].alias("bbox_x1"),
        box["y1"].alias("bbox_y1"),
        F.greatest(box["x1"], box["x2"]).alias("bbox_x2"),
        F.greatest(box["y1"], box["y2"]).alias("bbox_y2"),
        clean.whole_number("det.track_id", -1, "bigint").alias("track_id"),
    )


def read_detections(bronze: DataFrame) -> DataFrame:
    """Payload to detections as written, the ``batch`` rules."""
    return _detections(bronze, FRAME_BATCH, ["camera_id", "store_id", "ingest_ts"]).select(
        F.col("frame_index").try_cast("bigint").alias("frame_index"),
        clean.batch_time("capture_ts").alias("capture_ts"),
        F.col("b_camera_id").alias("camera_id"),
        F.col("b_store_id").alias("store_id"),
        F.col("det.det_id").alias("det_id"),
        F.col("det.class").alias("class"),
        F.col("det.class_id").try_cast("int").alias("class_id"),
        clean.number("det.conf").alias("conf"),
        clean.number("det.bbox.x1").alias("bbox_x1"),
        clean.number("det.bbox.y1").alias("bbox_y1"),
        clean.number("det.bbox.x2").alias("bbox_x2"),
        clean.number("det.bbox.y2").alias("bbox_y2"),
        clean.number("det.centroid.x").alias("centroid_x"),
        clean.number("det.centroid.y").alias("centroid_y"),
        F.col("det.track_id").try_cast("bigint").alias("track_id"),
        F.col("b_ingest_ts").alias("ingest_ts"),
    )


def silver_clean(detections: DataFrame, min_conf: float = MIN_CONF) -> DataFrame:
    """Rows with a complete key and enough confidence."""
    complete = F.lit(True)
    for c in [*DEDUP_KEY, "capture_ts", "track_id", "conf"]:
        complete = complete & F.col(c).isNotNull()
    return detections.where(complete & (F.col("conf") >= min_conf))


def ranking(columns: list[str], key: list[str]) -> list[Column]:
    """Best first: confidence, then the latest time, then every other column.

    The last part only settles ties, so that the same row wins on every run.
    """
    newest = "ingest_ts" if "ingest_ts" in columns else "capture_ts"
    lead = ["conf", newest]
    rest = [c for c in columns if c not in lead and c not in key and c != "processing_ts"]
    return [F.col(c).desc_nulls_last() for c in lead + rest]


def silver_dedup(detections: DataFrame, run_scoped: bool = False) -> DataFrame:
    """The best row per (store, camera, frame, detection).

    ``rn = 1`` lets Catalyst drop losers before the shuffle, so many copies of
    one detection never travel to one task.  ``run_scoped`` also separates
    runs, whose frame numbers restart at 1.
    """
    key = DEDUP_KEY + (["pipeline_run_id"] if run_scoped else [])
    best = Window.partitionBy(*key).orderBy(*ranking(detections.columns, key))
    return detections.withColumn("rn", F.row_number().over(best)).where("rn = 1").drop("rn")


def silver_rows(bronze: DataFrame, now: Column | None = None, min_conf: float = MIN_CONF) -> DataFrame:
    """Clean ``stream`` rows before de-duplication."""
    known = bronze.where(F.col("camera_id").isNotNull() & F.col("store_id").isNotNull())
    return silver_clean(parse_detections(known, now), min_conf)


def silver_stream(
    bronze: DataFrame,
    now: Column | None = None,
    min_conf: float = MIN_CONF,
    run_scoped: bool = False,
) -> DataFrame:
    """Bronze to ``silver_detections``."""
    instant = F.current_timestamp() if now is None else now
    rows = silver_dedup(silver_rows(bronze, now, min_conf), run_scoped)
    return rows.withColumn("processing_ts", instant).select(*columns_of("silver_detections"))


def silver_batch(bronze: DataFrame, min_conf: float = MIN_CONF) -> DataFrame:
    """Bronze to ``silver_detections_v2``."""
    known = bronze.where(F.col("camera_id").isNotNull() & F.col("store_id").isNotNull())
    return silver_dedup(silver_clean(read_detections(known), min_conf)).select(
        *columns_of("silver_detections_v2")
    )

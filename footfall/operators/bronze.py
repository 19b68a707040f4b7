"""Bronze: raw payloads with the routing columns beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.cleaning import ntz_from_instant

# Fixed value: the version mark the table carries, independent of the payload's.
TABLE_VERSION = "v1"


def _scalar(text: Column) -> Column:
    """NULL where an object or a list stands in place of a value."""
    return F.when(~text.startswith("{") & ~text.startswith("["), text)


def bronze_ingest(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Raw text (column ``value``) to Bronze rows; malformed text is kept.

    The payload is parsed once for both routing columns.
    """
    routing = F.from_json("value", "source struct<store_id:string, camera_id:string>")
    instant = F.current_timestamp() if now is None else now
    return raw.select("value", routing.alias("r")).select(
        F.lit(TABLE_VERSION).alias("schema_version"),
        F.lit(None).cast("string").alias("pipeline_run_id"),
        F.lit(None).cast("bigint").alias("frame_index"),
        F.col("value").alias("payload"),
        _scalar(F.col("r.source.camera_id")).alias("camera_id"),
        _scalar(F.col("r.source.store_id")).alias("store_id"),
        ntz_from_instant(instant).alias("ingest_ts"),
    )


def bronze_sample(bronze: DataFrame, n: int = 10) -> DataFrame:
    """A look at ``n`` rows, whichever are found first; order before it for the same ones."""
    return bronze.limit(n)


def bronze_json_extract(bronze: DataFrame) -> DataFrame:
    """Capture time and detection list of each payload as JSON text."""
    return bronze.select(F.json_tuple("payload", "capture_ts", "detections").alias("ts", "dets"))


def bronze_frame_counts(bronze: DataFrame) -> DataFrame:
    """Frame index, capture time and number of detections per payload."""
    frame = F.from_json("payload", "frame_index string, capture_ts string, detections array<string>")
    return bronze.select("camera_id", "store_id", "ingest_ts", frame.alias("f")).select(
        F.col("f.frame_index").alias("frame_index"),
        F.col("f.capture_ts").alias("capture_ts_str"),
        F.when(F.col("f.detections").isNotNull(), F.size("f.detections")).alias("num_person"),
        "camera_id", "store_id", "ingest_ts",
    )

"""Schemas of the frame record and of every stored table."""

from __future__ import annotations

from pyspark.sql.types import StructType

# The complete frame record as the camera side writes it.
FRAME_RECORD = """
    schema_version string, pipeline_run_id string,
    source struct<store_id:string, camera_id:string, stream_id:string>,
    frame_index bigint, capture_ts string,
    image_size struct<width:int, height:int>,
    detections array<struct<
        det_id:string, class:string, class_id:int, conf:double,
        bbox:struct<x1:double, y1:double, x2:double, y2:double>,
        bbox_norm:struct<x:double, y:double, w:double, h:double>,
        centroid:struct<x:int, y:int>, centroid_norm:struct<x:double, y:double>,
        track_id:bigint>>,
    runtime struct<model_name:string, tracker_type:string, conf_thres:double,
        class_filter:array<int>>,
    source_uri string
"""

# What the two Silver variants read back, nothing more.  Leaves are text so that
# one odd value turns into a default instead of spoiling its neighbours; in the
# stream form ``conf`` alone must be a JSON number.
FRAME_STREAM = """
    pipeline_run_id string, frame_index string, capture_ts string,
    image_size struct<width:string, height:string>,
    detections array<struct<
        det_id:string, class:string, class_id:string, conf:double,
        bbox:struct<x1:string, y1:string, x2:string, y2:string>, track_id:string>>
"""
FRAME_BATCH = """
    frame_index string, capture_ts string,
    detections array<struct<
        det_id:string, class:string, class_id:string, conf:string,
        bbox:struct<x1:string, y1:string, x2:string, y2:string>,
        centroid:struct<x:string, y:string>, track_id:string>>
"""

# Names and types of the stored tables.
TABLES = {
    "bronze_raw": """
        schema_version string, pipeline_run_id string, frame_index bigint,
        payload string, camera_id string, store_id string, ingest_ts timestamp_ntz""",
    "silver_detections": """
        schema_version string, pipeline_run_id string, store_id string,
        camera_id string, frame_index bigint, capture_ts timestamp_ntz,
        img_w int, img_h int, det_id string, class_name string, class_id int,
        conf double, bbox_x1 int, bbox_y1 int, bbox_x2 int, bbox_y2 int,
        track_id bigint, processing_ts timestamp""",
    "silver_detections_v2": """
        frame_index bigint, capture_ts timestamp_ntz, camera_id string,
        store_id string, det_id string, class string, class_id int, conf double,
        bbox_x1 double, bbox_y1 double, bbox_x2 double, bbox_y2 double,
        centroid_x double, centroid_y double, track_id bigint,
        ingest_ts timestamp_ntz""",
    "gold_minute_by_cam": """
        store_id string, camera_id string, ts_minute timestamp_ntz,
        detection_count bigint, unique_tracks bigint, avg_conf double,
        bbox_area_ratio_avg double""",
    "gold_hour_by_cam": """
        store_id string, camera_id string, ts_hour timestamp_ntz,
        detection_count bigint, unique_tracks bigint, avg_conf double""",
    "gold_people_per_minute": """
        store_id string, camera_id string, ts_minute timestamp_ntz,
        detections bigint, unique_people bigint""",
    "gold_zone_heatmap": """
        store_id string, camera_id string, zone_x int, zone_y int,
        hits bigint, unique_tracks bigint""",
    "gold_zone_dwell": """
        store_id string, camera_id string, zone_x int, zone_y int,
        visits bigint, total_dwell_seconds double, avg_dwell_seconds double""",
    "gold_track_summary": """
        store_id string, camera_id string, track_id bigint, frames bigint,
        start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds double,
        min_x double, max_x double, delta_x double,
        min_y double, max_y double, delta_y double,
        avg_x double, avg_y double, avg_conf double""",
}

# Columns that identify one row of each keyed table.
KEYS = {
    "gold_minute_by_cam": ["store_id", "camera_id", "ts_minute"],
    "gold_hour_by_cam": ["store_id", "camera_id", "ts_hour"],
    "gold_people_per_minute": ["store_id", "camera_id", "ts_minute"],
    "gold_zone_heatmap": ["store_id", "camera_id", "zone_x", "zone_y"],
    "gold_zone_dwell": ["store_id", "camera_id", "zone_x", "zone_y"],
    "gold_track_summary": ["store_id", "camera_id", "track_id"],
}


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(" ".join(ddl.split()))


def table_schema(name: str) -> StructType:
    return struct_of(TABLES[name])


def columns_of(name: str) -> list[str]:
    return table_schema(name).fieldNames()

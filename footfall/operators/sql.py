"""The cleaning rules as SQL functions, and the one table function of the jobs.

``register`` makes them known to a session, so that a job may be written in SQL as a whole:

    SELECT b.store_id, d.* FROM bronze_raw b, LATERAL parse_detections(b.payload) d

They are SQL functions, which Spark replaces by their bodies: no Python runs, and the payload is
parsed once, with the fields that are used. The rules are those of ``functions.cleaning`` and
``operators.silver`` (``stream``).

Spark joins the rows of a LATERAL table function back to its argument, the whole payload, and may broadcast
them: right for a few payloads. The jobs (``detections_sql``, ``silver_sql``) unfold the parsed frame in lateral
views instead, which need no join.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from footfall.functions.cleaning import DEFAULT_CLASS, EMPTY_CLASS_WORDS, INT_MAX, ZONED_ISO
from footfall.schemas import FRAME_STREAM

_WORDS = ", ".join(f"'{w}'" for w in EMPTY_CLASS_WORDS)
_FRAME = " ".join(FRAME_STREAM.split())

SCALARS = {
    "clean_class": f"""(name STRING) RETURNS STRING RETURN
        CASE WHEN trim(name) IS NULL OR lower(trim(name)) IN ({_WORDS}) THEN '{DEFAULT_CLASS}' ELSE trim(name) END""",
    "clean_pixel": f"""(value STRING) RETURNS INT RETURN
        CAST(least(greatest(floor(coalesce(nanvl(try_cast(value AS DOUBLE), 0D), 0D) + 0.5D), 0), {INT_MAX}) AS INT)""",
    "clean_int": """(value STRING, fallback INT) RETURNS INT RETURN
        coalesce(try_cast(value AS INT), try_cast(try_cast(value AS DOUBLE) AS INT), fallback)""",
    "clean_bigint": """(value STRING, fallback BIGINT) RETURNS BIGINT RETURN
        coalesce(try_cast(value AS BIGINT), try_cast(try_cast(value AS DOUBLE) AS BIGINT), fallback)""",
    "clean_conf": """(value DOUBLE) RETURNS DOUBLE RETURN
        least(greatest(nanvl(coalesce(value, 0D), 0D), 0D), 1D)""",
    "clean_time": f"""(value STRING, otherwise TIMESTAMP) RETURNS TIMESTAMP_NTZ RETURN
        timestampadd(MILLISECOND, unix_millis(coalesce(
          CASE WHEN value RLIKE r'{ZONED_ISO}' THEN try_cast(value AS TIMESTAMP) END, otherwise)),
          TIMESTAMP_NTZ'1970-01-01')""",
}

# The detection ``d`` of the frame ``f``, cleaned.
CLEANED = """try_cast(f.frame_index AS BIGINT) AS frame_index, clean_time(f.capture_ts, {otherwise}) AS capture_ts,
      clean_int(f.image_size.width, 0) AS img_w, clean_int(f.image_size.height, 0) AS img_h,
      t.d.det_id AS det_id, clean_class(t.d.class) AS class_name, clean_int(t.d.class_id, -1) AS class_id,
      clean_conf(t.d.conf) AS conf, clean_pixel(t.d.bbox.x1) AS bbox_x1, clean_pixel(t.d.bbox.y1) AS bbox_y1,
      greatest(clean_pixel(t.d.bbox.x1), clean_pixel(t.d.bbox.x2)) AS bbox_x2,
      greatest(clean_pixel(t.d.bbox.y1), clean_pixel(t.d.bbox.y2)) AS bbox_y2,
      clean_bigint(t.d.track_id, -1) AS track_id"""
_PARSED = f"from_json({{payload}}, '{_FRAME}', map('allowNonNumericNumbers', 'false'))"

PARSE_DETECTIONS = f"""(payload STRING, otherwise TIMESTAMP DEFAULT current_timestamp())
    RETURNS TABLE (pipeline_run_id STRING, frame_index BIGINT, capture_ts TIMESTAMP_NTZ, img_w INT, img_h INT,
      det_id STRING, class_name STRING, class_id INT, conf DOUBLE,
      bbox_x1 INT, bbox_y1 INT, bbox_x2 INT, bbox_y2 INT, track_id BIGINT)
    RETURN SELECT f.pipeline_run_id, {CLEANED.format(otherwise="otherwise")}
    FROM inline(array({_PARSED.format(payload="payload")})) AS f, LATERAL explode(f.detections) AS t(d)"""


def register(spark: SparkSession) -> None:
    """The functions as temporary functions of the session."""
    for name, body in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION parse_detections{PARSE_DETECTIONS}")


SILVER = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, camera_id, frame_index, det_id
      ORDER BY conf DESC NULLS LAST, capture_ts DESC NULLS LAST, schema_version DESC NULLS LAST,
        pipeline_run_id DESC NULLS LAST, img_w DESC, img_h DESC, class_name DESC, class_id DESC,
        bbox_x1 DESC, bbox_y1 DESC, bbox_x2 DESC, bbox_y2 DESC, track_id DESC) AS rn
  FROM {detections}
  WHERE store_id IS NOT NULL AND camera_id IS NOT NULL AND frame_index IS NOT NULL AND det_id IS NOT NULL AND conf >= 0.4)
SELECT * EXCEPT (rn) FROM ranked WHERE rn = 1"""

DETECTIONS = """
SELECT b.schema_version, coalesce(b.pipeline_run_id, f.run) AS pipeline_run_id, b.store_id, b.camera_id,
  {cleaned}
FROM {bronze} b
  LATERAL VIEW inline(array({parsed})) f AS run, frame_index, capture_ts, image_size, detections
  LATERAL VIEW explode(f.detections) t AS d"""


def detections_sql(bronze: str, otherwise: str | None = None) -> str:
    """The detections of a Bronze table or view, as SQL text; ``otherwise`` is the time of unreadable ones."""
    return DETECTIONS.format(
        bronze=bronze, parsed=_PARSED.format(payload="b.payload"), cleaned=CLEANED.format(otherwise=otherwise or "current_timestamp()"))


def silver_sql(bronze: str, otherwise: str | None = None) -> str:
    """Silver as SQL text: the best copy of each clean detection."""
    return SILVER.format(detections=f"({detections_sql(bronze, otherwise)})")

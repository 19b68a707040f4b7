"""Projections of the ``events`` table to detections.

The same SQL text runs in Spark and in the oracle engine; only the text type
and the epoch-to-timestamp call differ.  ``F1`` carries the dirty cases the
cleaning rules deal with, ``F2`` carries overlapping boxes and moving tracks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.bronze import bronze_ingest
from footfall.sources.frames import frame_records

IMG_W, IMG_H = 1280, 720
NOW = "2025-06-01T00:00:00Z"

F1 = """
SELECT *,
 CASE WHEN e % 47 = 0 THEN x1 - 10 ELSE x1 + 20 + e % 60 END AS x2,
 y1 + 40 + e % 100 AS y2
FROM (
 SELECT *,
  CASE WHEN fr % 89 = 0 THEN NULL ELSE 'store_0' || CAST(1 + fr % 2 AS {S}) END AS store_id,
  CASE WHEN fr % 97 = 0 THEN NULL ELSE 'cam_0' || CAST(1 + fr % 3 AS {S}) END AS camera_id,
  {TS:1735689600000 + fr * 1037} AS capture_ts,
  CASE WHEN e % 61 = 0 THEN NULL ELSE CAST(fr AS {S}) || '-' || CAST(e % 3 AS {S}) END AS det_id,
  CASE WHEN e % 31 = 0 THEN NULL WHEN e % 29 = 0 THEN ' None '
       WHEN e % 17 = 0 THEN 'bottle' ELSE 'person' END AS cls,
  CASE WHEN e % 31 = 0 THEN NULL WHEN e % 17 = 0 THEN 39 ELSE 0 END AS cls_id,
  CASE WHEN e % 53 = 0 THEN NULL
       ELSE CAST((e * 37) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) END AS conf,
  CASE WHEN e % 43 = 0 THEN CAST(-5 AS DOUBLE)
       ELSE CAST((e * 7919) % 1200 AS DOUBLE) + CAST(e % 2 AS DOUBLE) / CAST(2 AS DOUBLE) END AS x1,
  CAST((e * 104729) % 600 AS DOUBLE) AS y1,
  CASE WHEN u % 25 = 0 THEN NULL ELSE u END AS track_id
 FROM (SELECT event_id AS e, user_id AS u,
       CAST(floor(CAST(event_id AS DOUBLE) / CAST(4 AS DOUBLE)) AS BIGINT) + 1 AS fr
       FROM {EVENTS}) t) z
"""

F2 = """
SELECT e, fr, store_id, camera_id, {TS:1735689600000 + fr * 1037} AS capture_ts,
 CAST(fr AS {S}) || '-' || CAST(e % 16 AS {S}) AS det_id,
 CASE WHEN e % 7 = 0 THEN 'bottle' ELSE 'person' END AS class_name,
 CASE WHEN e % 7 = 0 THEN 39 ELSE 0 END AS class_id,
 CAST((e * 37) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS conf,
 u AS track_id, x1, y1,
 CASE WHEN e % 59 = 0 THEN CAST(1300 AS DOUBLE) WHEN e % 41 = 0 THEN x1 ELSE x1 + 60 + e % 13 END AS x2,
 y1 + 120 + e % 19 AS y2
FROM (
 SELECT *, 'store_0' || CAST(1 + fr % 2 AS {S}) AS store_id,
  'cam_0' || CAST(1 + fr % 3 AS {S}) AS camera_id,
  CASE WHEN e % 43 = 0 THEN CAST(-5 AS DOUBLE)
       ELSE CAST(spot * 200 + (e * 7) % 23 AS DOUBLE) + CAST(e % 2 AS DOUBLE) / CAST(2 AS DOUBLE) END AS x1,
  CAST(spot * 100 + (e * 5) % 17 AS DOUBLE) AS y1
 FROM (
  SELECT event_id AS e, user_id AS u,
   CAST(floor(CAST(event_id AS DOUBLE) / CAST(16 AS DOUBLE)) AS BIGINT) + 1 AS fr,
   (user_id + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) % 5 AS spot
  FROM {EVENTS}) t) z
"""


def render(template: str, dialect: str, events: str) -> str:
    """Projection text for ``spark`` or ``duckdb``."""
    text, stamp = ("STRING", "timestampadd(MILLISECOND, {}, TIMESTAMP_NTZ'1970-01-01')")
    if dialect == "duckdb":
        text, stamp = "VARCHAR", "epoch_ms({})"
    out = template.replace("{S}", text).replace("{EVENTS}", events)
    while "{TS:" in out:
        start = out.index("{TS:")
        end = out.index("}", start)
        out = out[:start] + stamp.format(out[start + 4:end]) + out[end + 1:]
    return out


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id")


def project(spark: SparkSession, template: str, events_df: DataFrame) -> DataFrame:
    return spark.sql(render(template, "spark", "{events}"), events=events_df)


def f1_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as emitter input; frame parts and the case columns stay beside it."""
    return project(spark, F1, events(spark, sf_dir)).select(
        F.lit("run_01").alias("pipeline_run_id"),
        "store_id", "camera_id", F.lit("stream_01").alias("stream_id"),
        F.when(F.col("fr") % 83 != 0, F.col("fr")).alias("frame_index"),
        "capture_ts",
        F.lit(IMG_W).alias("img_w"), F.lit(IMG_H).alias("img_h"),
        F.col("e").alias("det_order"), "det_id", F.col("cls").alias("class"),
        F.col("cls_id").alias("class_id"), "conf", "x1", "y1", "x2", "y2",
        F.col("track_id"), "fr",
        F.floor(F.col("e") % 4 / 2).cast("int").alias("part"),
    )


def f1_records(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    """JSON frame records of F1, every 79th one broken.

    ``split`` sends each frame as two records (column ``part``), so that copies
    of one detection can arrive apart.
    """
    keep = ["fr"] + (["part"] if split else [])
    records = frame_records(
        f1_boxes(spark, sf_dir),
        runtime={"model_name": "detector", "tracker_type": "tracker"},
        keep=keep,
    )
    broken = F.col("fr") % 79 == 0
    return records.withColumn("value", F.when(broken, F.lit("{bad")).otherwise(F.col("value")))


def f1_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 records with further faults by frame: no capture time, a number as text, an undeclared field,
    confidences as text."""
    text = F.col("value")
    for modulus, rest, pattern, becomes in (
        (5, 1, r'"capture_ts":"[^"]*",', ""),
        (7, 2, r'"frame_index":(\d+)', r'"frame_index":"$1"'),
        (11, 3, r"^\{", r'{"weather":1,'),
        (13, 4, r'"conf":([0-9.E-]+)', r'"conf":"$1"'),
    ):
        hit = (F.col("fr") % modulus == rest) & (F.col("fr") % 79 != 0)
        text = F.when(hit, F.regexp_replace(text, pattern, becomes)).otherwise(text)
    return f1_records(spark, sf_dir).withColumn("value", text)


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def f1_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of F1.

    A broken payload has no readable routing, so its store and camera are NULL.
    """
    return bronze_ingest(f1_records(spark, sf_dir), now())


def f2_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, F2, events(spark, sf_dir)).withColumns({
        "img_w": F.lit(IMG_W), "img_h": F.lit(IMG_H),
    })

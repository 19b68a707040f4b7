"""Registered queries: name -> function(spark, sf_dir) -> DataFrame.

Every query runs over the whole ``events`` table, through the layer it belongs
to.  Doubles that come out of sums are rounded to nine digits here, not in the
operators, because their last bits depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from footfall.functions.labels import label_lookup, labels
from footfall.operators import bronze as b
from footfall.operators import contract
from footfall.operators import explore as x
from footfall.operators import geometry as geo
from footfall.operators import gold as g
from footfall.operators import panels as p
from footfall.operators import quality as q
from footfall.operators import silver as s
from footfall.operators import sql
from footfall.operators.pairs import overlapping_pairs
from footfall.operators.smoothing import smooth_bbox
from footfall.plans import fixtures as fx
from footfall.plans import live
from footfall.plans.layers import layers
from footfall.schemas import FRAME_RECORD
from footfall.session import shared_dir
from footfall.sources import frames, tables

F2_FRAME = ["store_id", "camera_id", "fr"]
F2_TRACK = ["store_id", "camera_id", "track_id"]

Query = Callable[[SparkSession, str], DataFrame]


def settled(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _bronze(op) -> Query:
    return lambda spark, d: op(layers(spark, d).bronze())


def _parsed(op) -> Query:
    return lambda spark, d: op(s.parse_detections(layers(spark, d).bronze(), fx.now()))


def _silver(op) -> Query:
    return lambda spark, d: settled(op(layers(spark, d).silver()))


def _silver2(op) -> Query:
    return lambda spark, d: settled(op(layers(spark, d).silver_v2()))


def _gold(name: str, op=lambda t: t) -> Query:
    return lambda spark, d: settled(op(settled(layers(spark, d).gold(name))))


def _gold2(name: str, op) -> Query:
    return lambda spark, d: settled(op(layers(spark, d).gold_batch(name)))


def _boxes(op) -> Query:
    return lambda spark, d: op(fx.f2_boxes(spark, d))


def _live(name: str) -> Query:
    return lambda spark, d: settled(live.live(spark, d).view(name))


def frames_to_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the records as JSON lines, reads them back, flattens them."""
    path = shared_dir(spark, "jsonl")
    frames.write_jsonl(fx.f1_records(spark, sf_dir), path)
    record = F.from_json("value", FRAME_RECORD).alias("f")
    det = frames.read_jsonl(spark, path).select(record).withColumn("d", F.explode("f.detections"))
    return det.select(
        "f.pipeline_run_id", "f.source.store_id", "f.source.camera_id", "f.frame_index",
        "f.capture_ts", "d.det_id", "d.class", "d.class_id", "d.conf",
        "d.bbox.x1", "d.bbox.y1", "d.bbox.x2", "d.bbox.y2", "d.track_id",
    )


def with_digest(bronze: DataFrame) -> DataFrame:
    """Bronze with the time and the number of detections in place of the payload's text."""
    return bronze.withColumns({
        "ts": F.get_json_object("payload", "$.capture_ts"),
        "num_dets": F.json_array_length(F.get_json_object("payload", "$.detections")),
    }).drop("payload")


def bronze_json_extract(bronze: DataFrame) -> DataFrame:
    """The extracted list is compared by its length, its text by the parse queries."""
    return b.bronze_json_extract(bronze).select(
        "ts", F.json_array_length("dets").alias("num_dets"))


def gold_silver_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation against a Gold copy with planted damage: every fifth minute
    is missing and every fifth counts one too many."""
    return q.gold_silver_diff(
        _damaged(layers(spark, sf_dir).gold("gold_minute_by_cam")), layers(spark, sf_dir).silver(), as_of())


def as_of() -> Column:
    return F.lit("2025-01-01 12:00:00").cast("timestamp_ntz")


def _damaged(gold: DataFrame) -> DataFrame:
    phase = F.minute("ts_minute") % 5
    return gold.where(phase != 1).withColumn(
        "detection_count", F.col("detection_count") + (phase == 2).cast("bigint"))


def stored_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = layers(spark, sf_dir)
    stored.silver()
    found = q.stored_partitions(spark, stored.path("silver_detections"), ["store_id", "capture_date"])
    return found.select("store_id", F.col("capture_date").cast("string").alias("capture_date"), "record_count")


def bucketed_tables(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, str, str]:
    """Silver and minute Gold as catalog tables cut alike, and a session that uses it."""
    stored, work = layers(spark, sf_dir), shared_dir(spark, "bucketed")
    before = spark.catalog.currentDatabase()
    tables.create_database(spark, "footfall_buckets", use=False)
    names = []
    for name, rows in (("silver_detections", stored.silver()), ("gold_minute_by_cam", stored.gold("gold_minute_by_cam"))):
        names.append(f"footfall_buckets.{name}_{work.rsplit('-', 1)[1]}")
        tables.publish_bucketed(rows, name, names[-1], f"{work}/{name}")
    spark.catalog.setCurrentDatabase(before)
    return tables.co_located(spark), *names


def gold_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, silver, _ = bucketed_tables(spark, sf_dir)
    return settled(g.gold_minute_by_cam(own.table(silver)))


def diff_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation of ``gold_silver_diff`` between tables cut alike."""
    own, silver, gold = bucketed_tables(spark, sf_dir)
    return q.gold_silver_diff(_damaged(own.table(gold)), own.table(silver), as_of())


def contract_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared schema against records with planted faults of every kind."""
    return contract.fault_report(fx.f1_faulty(spark, sf_dir), payload="value")


def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records by their number and how many faults they have."""
    found = contract.rejects(fx.f1_faulty(spark, sf_dir), payload="value")
    return found.select("fr", F.size("faults").alias("faults"))


def catalog_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold published to catalog tables and read back by name, with what the catalog says of them."""
    database, work = "footfall_gold", shared_dir(spark, "catalog")
    before = spark.catalog.currentDatabase()
    tables.create_database(spark, database, use=False)
    parts = []
    for name in ("gold_minute_by_cam", "gold_people_per_minute"):
        table = f"{database}.{name}_{work.rsplit('-', 1)[1]}"
        tables.publish(layers(spark, sf_dir).gold(name), name, table, f"{work}/{name}")
        count = {"gold_minute_by_cam": "detection_count", "gold_people_per_minute": "detections"}[name]
        parts.append(spark.table(table).select(
            F.lit(name).alias("table_name"), "store_id", "camera_id", "ts_minute", F.col(count).alias("detections"),
            F.lit(tables.describe_table(spark, table).count()).alias("columns")))
    spark.catalog.setCurrentDatabase(before)
    return parts[0].unionByName(parts[1])


def _in_sql(text) -> Query:
    """A job written in SQL over a view of Bronze."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql.register(spark)
        view = f"bronze_{shared_dir(spark, 'v').rsplit('-', 1)[1]}"
        layers(spark, sf_dir).bronze().createTempView(view)
        return spark.sql(text(view, f"TIMESTAMP'{fx.NOW}'"))
    return run


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_lookup(layers(spark, sf_dir).silver().select("class_id"), labels(spark))
    return rows.groupBy("class_id", "label").agg(F.count(F.lit(1)).alias("detections"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to minute aggregates in one lazy plan, no stored layer between."""
    silver = s.silver_stream(fx.f1_bronze(spark, sf_dir), fx.now())
    return settled(g.gold_minute_by_cam(silver))


def queries() -> dict[str, Query]:
    stored = "processing_ts", "capture_date"
    out: dict[str, Query] = {
        # Bronze
        "bronze_ingest": lambda sp, d: with_digest(fx.f1_bronze(sp, d)),
        "bronze_sample": _bronze(lambda t: b.bronze_sample(t.orderBy("payload")).select(
            "store_id", "camera_id", F.get_json_object("payload", "$.capture_ts").alias("ts"))),
        "bronze_json_extract": _bronze(bronze_json_extract),
        "bronze_frame_counts": _bronze(b.bronze_frame_counts),
        "frames_to_jsonl": frames_to_jsonl,
        # Silver
        "parse_detections": _parsed(lambda t: t),
        "parse_detections_sql": _in_sql(sql.detections_sql),
        "silver_sql": _in_sql(sql.silver_sql),
        "parse_capture_ts": _parsed(
            lambda t: t.groupBy("frame_index", "capture_ts").agg(F.count(F.lit(1)).alias("detections"))),
        "normalize_class": _parsed(
            lambda t: t.groupBy("class_name").agg(F.count(F.lit(1)).alias("detections"))),
        "normalize_bbox": _parsed(
            lambda t: t.select("det_id", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")),
        "silver_stream": lambda sp, d: s.silver_stream(layers(sp, d).bronze(), fx.now()).drop(*stored),
        "silver_dedup": _parsed(
            lambda t: s.silver_dedup(s.silver_clean(t)).select(*s.DEDUP_KEY, "conf", "track_id")),
        "silver_batch": _bronze(s.silver_batch),
        "catalog_gold": catalog_gold,
        "describe_silver": lambda sp, d: q.describe(layers(sp, d).silver()),
        "label_lookup": label_counts,
        # Gold
        **{name: _silver(make) for name, make in g.GOLD.items()},
        "gold_batch_people_per_minute": _silver2(g.gold_people_per_minute),
        "gold_batch_zone_heatmap": _silver2(lambda t: g.gold_zone_heatmap(t, "batch")),
        "gold_batch_zone_dwell": _silver2(lambda t: g.gold_zone_dwell(t, "batch")),
        "gold_batch_track_summary": _silver2(lambda t: g.gold_track_summary(t, "batch")),
        # Exploration
        "silver_totals": _silver2(x.silver_totals),
        "missing_frames": _silver2(x.missing_frames),
        "people_per_frame": _silver2(x.people_per_frame),
        "conf_percentiles": _silver2(x.conf_percentiles),
        "ts_gaps": _silver2(x.ts_gaps),
        "ts_gaps_by_camera": _silver2(x.ts_gaps_by_camera),
        "track_stats": _silver2(x.track_stats),
        "track_timeline": _silver2(x.track_timeline),
        "track_mean_position": _silver2(x.track_mean_position),
        "track_extent": _silver2(x.track_extent),
        "track_movement": _silver2(x.track_movement),
        "heatmap_grid": _silver2(x.heatmap_grid),
        "dwell_top_stays": _silver2(x.dwell_top_stays),
        "people_per_second": _silver2(x.people_per_second),
        "silver_class_track_counts": _silver(x.silver_class_track_counts),
        "top_tracks_duration": _gold2("gold_track_summary", x.top_tracks_duration),
        "top_tracks_dx": _gold2("gold_track_summary", x.top_tracks_dx),
        "gold_latest_minutes": _gold("gold_minute_by_cam", lambda t: x.gold_latest(t, "ts_minute")),
        "gold_latest_hours": _gold("gold_hour_by_cam", lambda t: x.gold_latest(t, "ts_hour")),
        # Quality
        "gold_silver_diff": gold_silver_diff,
        "silver_status_matrix": _silver(q.silver_status_matrix),
        "partition_stats": _silver(lambda t: q.partition_stats(t, ["store_id", "capture_date"]).withColumn(
            "capture_date", F.col("capture_date").cast("string"))),
        "stored_partitions": stored_partitions,
        "gold_bucketed": gold_bucketed,
        "diff_bucketed": diff_bucketed,
        "contract_report": _bronze(q.contract_report),
        "contract_faults": contract_faults,
        "contract_rejects": contract_rejects,
        # Panels
        "panel_people_totals": _gold("gold_people_per_minute", p.people_totals),
        "panel_people_series": _gold("gold_people_per_minute", p.people_series),
        "panel_people_by_camera": _gold("gold_people_per_minute", p.people_by_camera),
        "panel_people_table": _gold("gold_people_per_minute", p.people_table),
        "panel_track_totals": _gold("gold_track_summary", p.track_totals),
        "panel_track_series": _gold("gold_track_summary", p.track_series),
        "panel_track_top_duration": _gold("gold_track_summary", lambda t: p.track_top(t, "duration_seconds")),
        "panel_track_top_conf": _gold("gold_track_summary", lambda t: p.track_top(t, "avg_conf")),
        "panel_tracks_by_camera": _gold("gold_track_summary", p.tracks_by_camera),
        "panel_track_table": _gold("gold_track_summary", p.track_table),
        "panel_zone_totals": _gold("gold_zone_dwell", p.zone_totals),
        "panel_zone_top_dwell": _gold(
            "gold_zone_dwell", lambda t: p.zone_top(t, "avg_dwell_seconds", "dwell_seconds")),
        "panel_zone_top_visits": _gold("gold_zone_dwell", lambda t: p.zone_top(t, "visits", "visits")),
        "panel_heatmap_table": _gold("gold_zone_heatmap", p.heatmap_table),
        "panel_zone_table": _gold("gold_zone_dwell", p.zone_table),
        # Geometry
        "detection_geometry": _boxes(lambda t: frames.detection_geometry(t).select(
            "det_id", "track_id", "cx", "cy", "box_w", "box_h", "norm_x", "norm_y", "norm_w", "norm_h",
            "centroid_x", "centroid_y", "centroid_norm_x", "centroid_norm_y")),
        "active_zone_filter": _boxes(lambda t: geo.active_zone_filter(t).select("det_id", "x1", "x2")),
        "class_filter": _boxes(lambda t: geo.class_filter(t).select("det_id", "class_id", "conf")),
        "clip_bbox": _boxes(lambda t: geo.clip_bbox(t).select("det_id", *geo.BOX)),
        "nms_per_frame": _boxes(lambda t: geo.nms_per_frame(t, F2_FRAME, ["e"]).select(
            *F2_FRAME, "class_id", "det_id")),
        "iou_pairs": _boxes(lambda t: settled(geo.suppressed_pairs(t, F2_FRAME, ["e"]))),
        "overlap_pairs": _boxes(lambda t: settled(overlapping_pairs(t, F2_FRAME, ["e"]))),
        "smooth_bbox": _boxes(lambda t: settled(smooth_bbox(
            t.select(*F2_TRACK, "fr", "e", "det_id", "img_w", "img_h", *geo.BOX), F2_TRACK, ["fr", "e"],
        ).select(*F2_TRACK, "det_id", *geo.BOX))),
        # Streaming
        "stream_bronze": live.stream_bronze,
        "stream_topic_replay": live.stream_topic_replay,
        "stream_silver": live.stream_silver,
        "stream_gold_minute": _live("gold_minute_by_cam"),
        "stream_gold_hour": _live("gold_hour_by_cam"),
        "stream_gold_people": _live("gold_people_per_minute"),
        "stream_gold_heatmap": _live("gold_zone_heatmap"),
        "stream_gold_dwell": _live("gold_zone_dwell"),
        "stream_gold_track": _live("gold_track_summary"),
        "stream_gold_all": lambda sp, d: settled(live.stream_gold_all(sp, d)),
        "stream_gold_switch": lambda sp, d: settled(live.stream_gold_switch(sp, d)),
        "upsert_latest": live.upsert_latest,
        "stream_smooth": lambda sp, d: settled(live.stream_smooth(sp, d)),
        "stream_state_silver": live.stream_state_silver,
        "stream_state_people": live.stream_state_people,
        "stream_state_dwell": lambda sp, d: settled(live.stream_state_dwell(sp, d)),
        "stream_smooth_ordered": lambda sp, d: settled(live.stream_smooth_ordered(sp, d)),
    }
    return out

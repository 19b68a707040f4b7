"""The registered streaming queries.

The records of ``events`` arrive in two waves, each frame half in the first and
half in the second, so later copies of a detection revise earlier ones.  The
streams run over what is available, stop, and go on from their checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.bronze import bronze_ingest
from footfall.operators.geometry import BOX
from footfall.operators.gold import ZONE, gold_people_per_minute
from footfall.plans import fixtures as fx
from footfall.plans.layers import layers
from footfall.schemas import KEYS, table_schema
from footfall.session import shared_dir
from footfall.sources import frames, topic
from footfall.streaming.jobs import VIEWS, Pipeline
from footfall.streaming.keyed import KeyedTable
from footfall.streaming import stateful
from footfall.streaming.smooth import smooth_in_order, smooth_stream, start_smooth

_LIVE: dict[tuple[str, str], "Live"] = {}

# The Gold tables in one form, to compare the multi-sink job in one result: the columns
# that stand for ``ts, zone_x, zone_y, track_id`` and for the measures ``a`` to ``d``.
ONE_FORM = {
    "gold_minute_by_cam": (("ts_minute", None, None, None),
                           ("detection_count", "unique_tracks", "avg_conf", "bbox_area_ratio_avg")),
    "gold_hour_by_cam": (("ts_hour", None, None, None), ("detection_count", "unique_tracks", "avg_conf", None)),
    "gold_people_per_minute": (("ts_minute", None, None, None), ("detections", "unique_people", None, None)),
    "gold_zone_heatmap": ((None, "zone_x", "zone_y", None), ("hits", "unique_tracks", None, None)),
    "gold_zone_dwell": ((None, "zone_x", "zone_y", None),
                        ("visits", "total_dwell_seconds", "avg_dwell_seconds", None)),
    "gold_track_summary": (("start_time", None, None, "track_id"), ("frames", "duration_seconds", "avg_x", "avg_conf")),
}
FORM_KINDS = {"ts": "timestamp_ntz", "zone_x": "int", "zone_y": "int", "track_id": "bigint",
              "a": "double", "b": "double", "c": "double", "d": "double"}


def live(spark: SparkSession, sf_dir: str) -> "Live":
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LIVE:
        _LIVE[key] = Live(spark, sf_dir)
    return _LIVE[key]


class Live:
    """Landing folder plus a pipeline; each layer is streamed on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.landing = shared_dir(spark, "landing")
        self.pipeline = Pipeline(spark, shared_dir(spark, "live"), now=fx.now())
        self.done: set[str] = set()
        records = fx.f1_records(spark, sf_dir, split=True)
        for wave in (0, 1):
            frames.write_jsonl(records.where(F.col("part") == wave), self.landing, compression="gzip")
            self.pipeline.start_bronze(frames.stream_jsonl(spark, self.landing)).awaitTermination()
            self.pipeline.start_silver().awaitTermination()

    def view(self, name: str) -> DataFrame:
        source = VIEWS[name].source
        if source != "silver":
            self.view(source)
        if name not in self.done:
            self.pipeline.start_view(name).awaitTermination()
            self.done.add(name)
        return self.pipeline.view(name)


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_digest(live(spark, sf_dir).pipeline.bronze())


def bronze_digest(bronze: DataFrame) -> DataFrame:
    """The stored rows, with the payload's time and number of detections for its text."""
    return bronze.select(
        "schema_version", "camera_id", "store_id", "ingest_ts",
        F.get_json_object("payload", "$.capture_ts").alias("ts"),
        F.json_array_length(F.get_json_object("payload", "$.detections")).alias("num_dets"))


def stream_topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from a message log: records of a camera in one partition, a query that is stopped in the middle
    of the log and restarted, and a second wave that arrives in between."""
    log, out = shared_dir(spark, "topic"), shared_dir(spark, "topic-bronze")
    records = fx.f1_records(spark, sf_dir).withColumn("key", F.get_json_object("value", "$.source.camera_id"))
    second = F.pmod(F.xxhash64("value"), F.lit(2)) == 1
    topic.write_topic(records.where(~second), log)
    most = -(-records.count() // 3)
    for turn in range(5):
        if turn == 1:
            topic.write_topic(records.where(second), log)
        lines = topic.stream_topic(spark, log, "bronze", most=most)
        bronze_ingest(lines.select("value"), fx.now()).writeStream.format("parquet").option("path", f"{out}/rows").option(
            "checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return bronze_digest(spark.read.parquet(f"{out}/rows"))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live(spark, sf_dir).pipeline.silver().drop("processing_ts")


def stream_gold_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the six tables from one query, in one form."""
    job = Pipeline(spark, shared_dir(spark, "all"), now=fx.now())
    job.tables["silver"] = live(spark, sf_dir).pipeline.tables["silver"]
    job.start_all().awaitTermination()
    return one_form(job)


def stream_gold_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job per table for the first wave, one job for the second, on the same root."""
    landing, records = shared_dir(spark, "switch-landing"), fx.f1_records(spark, sf_dir, split=True)
    job = Pipeline(spark, shared_dir(spark, "switch"), now=fx.now())
    for wave in (0, 1):
        frames.write_jsonl(records.where(F.col("part") == wave), landing, compression="gzip")
        job.start_bronze(frames.stream_jsonl(spark, landing)).awaitTermination()
        job.start_silver().awaitTermination()
        for name in VIEWS if wave == 0 else ():
            job.start_view(name).awaitTermination()
    job.start_all().awaitTermination()
    return one_form(job)


def one_form(job: Pipeline) -> DataFrame:
    out = None
    for name, (keys, measures) in ONE_FORM.items():
        columns = [(F.col(c) if c else F.lit(None)).cast(kind).alias(form)
                   for (form, kind), c in zip(FORM_KINDS.items(), (*keys, *measures))]
        rows = job.view(name).select(F.lit(name).alias("table_name"), "store_id", "camera_id", *columns)
        out = rows if out is None else out.unionByName(rows)
    return out


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of growing per-minute counts into one keyed table, the first
    two folded into a base."""
    name = "gold_people_per_minute"
    table = KeyedTable(shared_dir(spark, "upsert"), table_schema(name), KEYS[name]).create(spark)
    silver = layers(spark, sf_dir).silver()
    for batch in range(3):
        table.write(batch, gold_people_per_minute(silver.where(F.col("frame_index") % 3 <= batch)))
        if batch == 1:
            table.compact(spark, batch)
    return table.current(spark)


def stream_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes in two waves, the older frames first."""
    track = ["store_id", "camera_id", "track_id"]
    boxes = fx.f2_boxes(spark, sf_dir).select(*track, "fr", "e", "det_id", "img_w", "img_h", *[
        F.col(c).cast("double").alias(c) for c in BOX])
    half = boxes.agg((F.min("fr") + F.max("fr")) / 2).first()[0]
    landing, out = shared_dir(spark, "boxes"), shared_dir(spark, "smoothed")
    for wave in (F.col("fr") <= half, F.col("fr") > half):
        boxes.where(wave).write.mode("append").parquet(landing)
        stream = smooth_stream(spark.readStream.schema(boxes.schema).parquet(landing), track, ["fr", "e"])
        start_smooth(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows").select(*track, "det_id", *BOX)


def _stateful(spark: SparkSession, sf_dir: str, further) -> DataFrame:
    """All changes that a chain of stateful operators makes of the two waves."""
    landing, out = shared_dir(spark, "state-landing"), shared_dir(spark, "state")
    records = fx.f1_records(spark, sf_dir, split=True)
    for wave in (0, 1):
        frames.write_jsonl(records.where(F.col("part") == wave), landing, compression="gzip")
        lines = bronze_ingest(frames.stream_jsonl(spark, landing), fx.now())
        changes = further(stateful.detection_changes(lines, fx.now()))
        stateful.start_changes(changes, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def stream_state_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.winners(_stateful(spark, sf_dir, lambda c: c)).drop("processing_ts")


def stream_state_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.latest(_stateful(spark, sf_dir, stateful.people_changes), stateful.GROUP, "detections")


def stream_state_dwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.latest(_stateful(spark, sf_dir, stateful.dwell_changes), ZONE, "visits")


DISORDER = 40  # frames by which a row may come late


def stream_smooth_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes in four waves in which rows are up to ``DISORDER`` frames out of order, then frames without
    boxes: the first moves the watermark behind all rows, with the second the held rows come out."""
    track = ["store_id", "camera_id", "track_id"]
    boxes = fx.f2_boxes(spark, sf_dir).select(*track, "fr", "e", "capture_ts", "det_id", "img_w", "img_h", *[
        F.col(c).cast("double").alias(c) for c in BOX])
    last, end = boxes.agg(F.max("fr"), F.max("capture_ts") + F.expr("INTERVAL 1 HOUR")).first()
    shifted = F.col("fr") + F.pmod(F.col("e") * 7, F.lit(DISORDER))
    wave = F.least(F.floor(shifted * 4 / (last + DISORDER + 1)), F.lit(3))
    landing, out = shared_dir(spark, "disorder"), shared_dir(spark, "ordered")
    beat = spark.range(1).select(*[
        F.lit(end if c == "capture_ts" else None).cast(kind).alias(c) for c, kind in boxes.dtypes])
    for part in [boxes.where(wave == i) for i in range(4)] + [beat, beat]:
        part.write.mode("append").parquet(landing)
        stream = smooth_in_order(
            spark.readStream.schema(boxes.schema).parquet(landing), track, "capture_ts", ["fr", "e"],
            late=f"{2 * DISORDER} seconds")
        start_smooth(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows").where("det_id IS NOT NULL").select(*track, "det_id", *BOX)

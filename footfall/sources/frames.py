"""Frame records: building them, writing and reading JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_VERSION = "1.0"
FRAME_COLUMNS = [
    "pipeline_run_id", "store_id", "camera_id", "stream_id",
    "frame_index", "capture_ts", "img_w", "img_h",
]


def detection_geometry(boxes: DataFrame) -> DataFrame:
    """Derived geometry of tracker boxes.

    Adds size, centre, the normalised box, the whole-pixel and normalised
    centroid, and turns a negative tracker id into NULL.
    """
    x1, y1, x2, y2 = (F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2"))
    w, h = F.col("img_w"), F.col("img_h")
    return (
        boxes.withColumns({"box_w": x2 - x1, "box_h": y2 - y1})
        .withColumns({
            "cx": x1 + F.col("box_w") / F.lit(2.0),
            "cy": y1 + F.col("box_h") / F.lit(2.0),
        })
        .withColumns({
            "norm_x": x1 / w, "norm_y": y1 / h,
            "norm_w": F.col("box_w") / w, "norm_h": F.col("box_h") / h,
            "centroid_x": F.col("cx").cast("int"), "centroid_y": F.col("cy").cast("int"),
            "centroid_norm_x": F.col("cx") / w, "centroid_norm_y": F.col("cy") / h,
            "track_id": F.when(F.col("track_id") >= 0, F.col("track_id")),
        })
    )


def _detection() -> Column:
    def part(*pairs: tuple[str, str]) -> Column:
        return F.struct(*[F.col(src).alias(dst) for src, dst in pairs])

    return F.struct(
        F.col("det_order"),
        F.struct(
            F.col("det_id"), F.col("class"), F.col("class_id"), F.col("conf"),
            part(("x1", "x1"), ("y1", "y1"), ("x2", "x2"), ("y2", "y2")).alias("bbox"),
            part(("norm_x", "x"), ("norm_y", "y"), ("norm_w", "w"), ("norm_h", "h")).alias("bbox_norm"),
            part(("centroid_x", "x"), ("centroid_y", "y")).alias("centroid"),
            part(("centroid_norm_x", "x"), ("centroid_norm_y", "y")).alias("centroid_norm"),
            F.col("track_id"),
        ).alias("det"),
    )


def frame_records(
    detections: DataFrame,
    runtime: dict[str, str] | None = None,
    source_uri: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """One JSON frame record (column ``value``) per frame.

    ``detections`` holds boxes with ``det_order`` giving their place in the
    frame.  Absent values are left out of the JSON, and so are an empty
    ``runtime`` and ``source_uri``.
    """
    keep = keep or []
    frames = (
        detection_geometry(detections)
        .groupBy(*FRAME_COLUMNS, *keep)
        .agg(F.array_sort(F.collect_list(_detection())).alias("dets"))
    )
    fields = [
        F.lit(RECORD_VERSION).alias("schema_version"),
        F.col("pipeline_run_id"),
        F.struct("store_id", "camera_id", "stream_id").alias("source"),
        F.col("frame_index"),
        iso_utc(F.col("capture_ts")).alias("capture_ts"),
        F.struct(F.col("img_w").alias("width"), F.col("img_h").alias("height")).alias("image_size"),
        F.transform("dets", lambda d: d["det"]).alias("detections"),
    ]
    if runtime:
        fields.append(F.struct(*[F.lit(v).alias(k) for k, v in runtime.items()]).alias("runtime"))
    if source_uri:
        fields.append(F.lit(source_uri).alias("source_uri"))
    return frames.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00"))


FILE_RECORDS = 50_000  # records of a compressed file, which one task reads as a whole


def write_jsonl(records: DataFrame, path: str, mode: str = "append", compression: str | None = None) -> None:
    """Append one record per line, UTF-8; ``compression`` (such as gzip) writes files of ``FILE_RECORDS``."""
    writer = records.select("value").write.mode(mode)
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS)
    writer.text(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-blank line."""
    return _no_blank(spark.read.text(path))


def stream_jsonl(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming form: every file below ``path`` from the earliest on."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _no_blank(reader.text(path))


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Message topic source from the earliest offset, raw text payload.

    Needs the Kafka package on the cluster; offsets live in the query's checkpoint.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def _no_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.trim("value") != "")

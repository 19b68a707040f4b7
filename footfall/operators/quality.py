"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.cleaning import trunc_to
from footfall.operators.gold import CAMERA
from footfall.schemas import FRAME_RECORD, struct_of
from footfall.sources.tables import from_folders


def gold_silver_diff(gold: DataFrame, silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Minutes since the start of ``as_of``'s day whose stored count is not Silver's.

    Empty on consistent tables.
    """
    moment = F.current_timestamp() if as_of is None else as_of
    day = trunc_to("day", moment)
    keys = [*CAMERA, "ts_minute"]
    g = gold.where(F.col("ts_minute") >= day).select(*keys, F.col("detection_count").alias("g"))
    recent = silver.where(F.col("capture_ts") >= day)
    if "capture_date" in silver.columns:  # folders of a stored table
        recent = recent.where(F.col("capture_date") >= day.cast("date"))
    s = (
        recent
        .groupBy(*CAMERA, trunc_to("minute", "capture_ts").alias("ts_minute"))
        .agg(F.count(F.lit(1)).alias("s"))
    )
    g_cnt, s_cnt = F.coalesce("g", F.lit(0)), F.coalesce("s", F.lit(0))
    return (
        g.join(s, keys, "full_outer")
        .where(g_cnt != s_cnt)
        .select(*keys, g_cnt.alias("g_cnt"), s_cnt.alias("s_cnt"), (g_cnt - s_cnt).alias("diff"))
        .orderBy(F.desc("ts_minute"), *CAMERA)
    )


def silver_status_matrix(silver: DataFrame) -> DataFrame:
    """Counts per state of the cleaned class and track columns."""
    # The names of the states.
    name, track = F.col("class_name"), F.col("track_id")
    return silver.groupBy(
        F.when(name.isNull(), "NULL_VALUE").when(name == "", "EMPTY_STRING")
        .otherwise(name).alias("class_name_status"),
        F.when(track == -1, "CLEANED_TRACK_ID").when(track.isNull(), "NULL_TRACK_ID")
        .otherwise("VALID_TRACK_ID").alias("track_id_status"),
    ).agg(F.count(F.lit(1)).alias("total"))


def partition_stats(table: DataFrame, columns: list[str], k: int = 10, files: bool = False) -> DataFrame:
    """Largest partitions by record count, with file counts where asked for."""
    measures = [F.count(F.lit(1)).alias("record_count")]
    if files:
        table = table.withColumn("_file", F.col("_metadata.file_path"))
        measures.append(F.count_distinct("_file").alias("file_count"))
    return table.groupBy(*columns).agg(*measures).orderBy(F.desc("record_count"), *columns).limit(k)


def stored_partitions(spark: SparkSession, path: str, columns: list[str], k: int = 10) -> DataFrame:
    """Largest partitions of a stored table by record count, with their files and bytes, from metadata alone.

    Counts come from the Parquet footers (aggregate push-down of the second form of the source), files and
    bytes from the listing: no row is read. Both run in a session of their own with that source.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = own.read.parquet(path).groupBy(*columns).agg(F.count(F.lit(1)).alias("record_count"))
    listing = own.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    zero = F.lit(0).cast("bigint")
    both = counts.select(*columns, "record_count", zero.alias("file_count"), zero.alias("bytes")).unionByName(
        listing.select(*columns, zero.alias("record_count"), F.lit(1).cast("bigint").alias("file_count"), F.col("length").alias("bytes")))
    measures = ("record_count", "file_count", "bytes")
    return from_folders(both, columns).groupBy(*columns).agg(*[F.sum(m).alias(m) for m in measures]).orderBy(
        F.desc("record_count"), *columns).limit(k)


def describe(table: DataFrame) -> DataFrame:
    """Places, names and types of a table's columns, and how many rows fill each."""
    return table.agg(F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.count(f.name).alias("filled"),
        ) for i, f in enumerate(table.schema.fields)
    ]).alias("c")).select(F.inline("c"))


# Fields every record must have; track_id, runtime and source_uri may be absent.
REQUIRED_FRAME = [
    "schema_version", "pipeline_run_id", "frame_index", "capture_ts",
    "source.store_id", "source.camera_id", "source.stream_id",
    "image_size.width", "image_size.height", "detections",
]
REQUIRED_DETECTION = [
    "det_id", "class", "class_id", "conf", "bbox.x1", "bbox.y1", "bbox.x2", "bbox.y2",
    "bbox_norm.x", "bbox_norm.y", "bbox_norm.w", "bbox_norm.h",
    "centroid.x", "centroid.y", "centroid_norm.x", "centroid_norm.y",
]


def contract_report(bronze: DataFrame) -> DataFrame:
    """How often each required field is missing or of the wrong type.

    One pass: per payload the gaps are counted inside the array, then summed.
    """
    f = bronze.select(F.from_json("payload", struct_of(FRAME_RECORD)).alias("f"))
    counts = []
    for path in REQUIRED_FRAME:
        gap = F.col(f"f.{path}").isNull().cast("bigint")
        counts.append((path, F.sum(gap), F.count(F.lit(1))))
    total = F.coalesce(F.sum(F.when(F.col("f.detections").isNotNull(), F.size("f.detections"))), F.lit(0))

    def absent(path: str) -> Column:
        def is_null(d: Column) -> Column:
            for step in path.split("."):
                d = d[step]
            return d.isNull()
        found = F.size(F.filter("f.detections", is_null))
        return F.coalesce(F.sum(F.when(F.col("f.detections").isNotNull(), found)), F.lit(0))

    for path in REQUIRED_DETECTION:
        counts.append((f"detections[].{path}", absent(path), total))
    report = f.agg(F.array(*[
        F.struct(
            F.lit(name).alias("field"),
            missing.cast("bigint").alias("missing"),
            seen.cast("bigint").alias("total"),
        ) for name, missing, seen in counts
    ]).alias("r"))
    return report.select(F.inline("r"))

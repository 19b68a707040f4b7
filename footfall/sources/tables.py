"""Stored tables: catalog DDL, layout on disk, reading and writing.

A folder name cannot hold an empty text: it would come back as NULL.  Text columns
that name folders are therefore written with a mark in front where they are empty
(or start with the mark), and read back without it.  Catalog tables, which are read
by name, have no folders of text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from footfall.schemas import TABLES, table_schema

# How each table is cut into folders; the date is derived from capture_ts.
PARTITIONS = {
    "bronze_raw": ["store_id"],
    "silver_detections": ["store_id", "capture_date"],
    "silver_detections_v2": ["store_id", "capture_date"],
}


FOLDER_MARK = "~"


def _text_columns(df: DataFrame, columns: list[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in columns if kinds[c] == "string"]


def to_folders(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the texts of ``columns`` in the form that names folders."""
    return df.withColumns({
        c: F.when((F.col(c) == "") | F.col(c).startswith(FOLDER_MARK), F.concat(F.lit(FOLDER_MARK), c))
        .otherwise(F.col(c)) for c in _text_columns(df, columns)})


def from_folders(df: DataFrame, columns: list[str]) -> DataFrame:
    """The inverse; filters on these columns still prune folders."""
    return df.withColumns({
        c: F.when(F.col(c).startswith(FOLDER_MARK), F.substring(c, 2, 1 << 30)).otherwise(F.col(c))
        for c in _text_columns(df, columns)})


def stored_schema(name: str) -> StructType:
    schema = table_schema(name)
    if "capture_date" in PARTITIONS.get(name, []):
        schema = schema.add("capture_date", DateType())
    return schema


def laid_out(df: DataFrame, name: str) -> DataFrame:
    """Rows with their partition columns, spread evenly over tasks.

    The rebalance hint merges small pieces per partition and splits a partition
    that holds far more rows than the others.
    """
    parts = PARTITIONS.get(name, [])
    if "capture_date" in parts:
        df = df.withColumn("capture_date", F.col("capture_ts").cast("date"))
    return df.hint("rebalance", *parts) if parts else df.hint("rebalance")


def write_table(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> None:
    parts = PARTITIONS.get(name, [])
    to_folders(laid_out(df, name), parts).write.mode(mode).partitionBy(*parts).parquet(path)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return from_folders(spark.read.schema(stored_schema(name)).parquet(path), PARTITIONS.get(name, []))


# The column of the bucket and the number of buckets of the Silver layout.
BUCKETS = 16
BUCKETED = ["store_id", "camera_id"]

# A join on (store, camera, ...) may use a layout by (store, camera): its keys need not all be those of the layout.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.enabled": "true"}


def co_located(spark: SparkSession) -> SparkSession:
    """A session, with the tables of ``spark``, whose plans use the buckets of both sides of a join."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for key, value in CO_LOCATED.items():
        own.conf.set(key, value)
    return own


def publish_bucketed(df: DataFrame, name: str, table: str, location: str, buckets: int = BUCKETS) -> None:
    """The rows as catalog table ``table``, cut by date where it has one and into buckets by store and camera,
    replacing what it held.

    Aggregates by (store, camera, ...) and joins of tables cut alike need no shuffle. A camera with far more rows
    than others is written as several files of one bucket, and its bucket is read by one task: choose
    ``buckets`` and the dates read so that a bucket fits a task.
    """
    spark = df.sparkSession
    ddl, by = TABLES[name], ""
    if "capture_date" in PARTITIONS.get(name, []):
        df, by = df.withColumn("capture_date", F.col("capture_ts").cast("date")), "PARTITIONED BY (capture_date)"
        ddl += ", capture_date date"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet {by} "
              f"CLUSTERED BY ({', '.join(BUCKETED)}) INTO {buckets} BUCKETS LOCATION '{location}'")
    spread = df.hint("rebalance", *BUCKETED)
    spread.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def create_database(spark: SparkSession, database: str, use: bool = True) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if use:
        spark.catalog.setCurrentDatabase(database)


def create_table(spark: SparkSession, name: str, table: str | None = None, location: str | None = None) -> None:
    """Create table ``name`` of the data model unless it exists; cut by date alone."""
    ddl, by = TABLES[name], ""
    if "capture_date" in PARTITIONS.get(name, []):
        ddl += ", capture_date date"
        by = "PARTITIONED BY (capture_date)"
    place = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table or name} ({ddl}) USING parquet {by} {place}")


def insert_into(df: DataFrame, name: str, table: str | None = None, overwrite: bool = False) -> None:
    """Insert-select into a catalog table of the data model."""
    target = df.sparkSession.table(table or name)
    laid_out(df, name).select(*target.columns).write.insertInto(table or name, overwrite=overwrite)


def publish(df: DataFrame, name: str, table: str, location: str | None = None) -> None:
    """The rows as catalog table ``table`` of the data model, replacing what it held, so that
    dashboards can name it. For a streamed table pass its latest rows (``Pipeline.view``)."""
    create_table(df.sparkSession, name, table, location)
    insert_into(df, name, table, overwrite=True)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")

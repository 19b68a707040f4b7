"""Catalog tables, table maintenance queries and plan shapes."""

import pytest
from pyspark.sql import functions as F

from footfall.functions.labels import coco_names
from footfall.operators import explore as x
from footfall.operators import gold as g
from footfall.operators import quality as q
from footfall.operators.silver import silver_stream
from footfall.plans import fixtures as fx
from footfall.plans.layers import layers
from footfall.schemas import TABLES, columns_of, table_schema
from footfall.session import shared_dir
from footfall.sources import frames, tables
from tests.oracle import TESTDATA

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return layers(spark, SF).silver()


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_catalog_tables_are_created_filled_and_described(spark, silver):
    path = shared_dir(spark, "db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{path}'")
    tables.create_database(spark, "shop")
    try:
        for name in TABLES:
            tables.create_table(spark, name)
            tables.create_table(spark, name)
        assert {r.tableName for r in tables.list_tables(spark, "shop").collect()} == set(TABLES)
        described = [r.col_name for r in tables.describe_table(spark, "gold_zone_dwell").collect()]
        assert described == columns_of("gold_zone_dwell")
        tables.insert_into(silver, "silver_detections")
        assert spark.table("silver_detections").count() == silver.count()
        stored = spark.table("silver_detections")
        for _ in range(2):
            tables.insert_into(g.gold_zone_dwell(stored), "gold_zone_dwell", overwrite=True)
        assert spark.table("gold_zone_dwell").count() == g.gold_zone_dwell(silver).count()
    finally:
        spark.sql("DROP DATABASE shop CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_partition_stats_counts_files(silver):
    stats = q.partition_stats(silver, ["store_id", "capture_date"], files=True).collect()
    assert sum(r.record_count for r in stats) == silver.count()
    assert all(r.file_count >= 1 for r in stats)


def test_reconciliation_is_empty_on_clean_data(silver):
    as_of = F.lit("2025-01-01 12:00:00").cast("timestamp_ntz")
    assert q.gold_silver_diff(g.gold_minute_by_cam(silver), silver, as_of).isEmpty()


def test_emitter_leaves_out_what_is_empty(spark):
    boxes = fx.f1_boxes(spark, SF).where("fr = 1")
    bare = frames.frame_records(boxes).first().value
    full = frames.frame_records(boxes, {"model_name": "m"}, "file:a").first().value
    assert "runtime" not in bare and "source_uri" not in bare and '"schema_version":"1.0"' in bare
    assert '"runtime":{"model_name":"m"}' in full and '"source_uri":"file:a"' in full


def test_label_list():
    names = coco_names()
    assert len(names) == 80 and names[0] == "person" and names[39] == "bottle" and names[79] == "toothbrush"


def test_scans_are_pruned_and_pushed(silver):
    text = plan(g.gold_hour_by_cam(silver.where("store_id = 'store_01' AND conf > 0.5")))
    assert any("PartitionFilters" in line and "= store_01" in line for line in text.splitlines())
    assert "GreaterThan(conf,0.5)" in text
    assert "bbox_x1" not in text.split("ReadSchema")[1].split("\n")[0]


def test_payload_is_parsed_once(spark):
    text = plan(silver_stream(layers(spark, SF).bronze(), fx.now()))
    arguments = [line for line in text.splitlines() if "from_json(" in line and line.startswith("Arguments")]
    assert len(arguments) == 1
    assert not [line for line in text.splitlines() if line.startswith("Condition") and "from_json" in line]


def test_hot_keys_are_cut_down_before_the_shuffle(spark, silver):
    """Copies of one detection, and one camera's rows, are limited on the map side."""
    for df in (silver_stream(layers(spark, SF).bronze(), fx.now()), x.ts_gaps_by_camera(silver, first=20)):
        text = plan(df).split("(1) Scan")[0]
        assert text.count("WindowGroupLimit") == 2
        assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_reconciliation_reads_the_days_it_compares(silver):
    as_of = F.lit("2025-01-01 12:00:00").cast("timestamp_ntz")
    text = plan(q.gold_silver_diff(g.gold_minute_by_cam(silver), silver, as_of))
    assert any("PartitionFilters" in line and "capture_date" in line for line in text.splitlines())


def test_gaps_of_a_camera_go_on_over_days(spark):
    times = ["2025-01-01 23:59:58", "2025-01-01 23:59:59", "2025-01-02 00:00:03", "2025-01-04 00:00:00"]
    rows = spark.createDataFrame([("s", "c", t, i, "d") for i, t in enumerate(times)] + [("s", "e", times[2], 9, "d")],
                                 "store_id string, camera_id string, t string, frame_index long, det_id string")
    got = x.ts_gaps_by_camera(rows.withColumn("capture_ts", F.col("t").cast("timestamp_ntz"))).collect()
    assert sorted((r.camera_id, r.rn, r.gap_seconds) for r in got if r.prev_ts) == [
        ("c", 2, 1.0), ("c", 3, 4.0), ("c", 4, 172797.0)]
    assert sorted((r.camera_id, r.rn) for r in got if not r.prev_ts) == [("c", 1), ("e", 1)]


@pytest.mark.parametrize("name", ["bronze_raw", "silver_detections"])
def test_empty_and_marked_stores_come_back_from_folders(spark, name):
    rows = spark.range(4).select(*[
        F.element_at(F.array(F.lit(""), F.lit("~a"), F.lit("b"), F.lit(None).cast("string")), F.col("id").cast("int") + 1)
        .alias("store_id") if c.name == "store_id" else F.lit(None).cast(c.dataType).alias(c.name)
        for c in table_schema(name).fields])
    path = shared_dir(spark, "odd-stores")
    tables.write_table(rows, path, name)
    stored = tables.read_table(spark, path, name)
    assert {r.store_id for r in stored.collect()} == {"", "~a", "b", None}
    assert stored.where("store_id = ''").count() == 1


def test_distinct_counts_shuffle_on_group_and_track_first(silver):
    text = plan(g.gold_minute_by_cam(silver))
    first = [line for line in text.splitlines() if "hashpartitioning(" in line][0]
    assert "track_id" in first


def test_percentiles_against_a_sorted_list(spark):
    values = [((i * 7919) % 1000) / 1000 for i in range(997)] + [0.25] * 500
    table = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias("conf"))
    got = x.conf_percentiles(table, points=(0.01, 0.1, 0.5, 0.9, 1.0)).first()
    values.sort()
    assert list(got) == [values[-(-int(p * 1000) * len(values) // 1000) - 1] for p in (0.01, 0.1, 0.5, 0.9, 1.0)]


def test_top_k_is_not_a_full_sort(silver):
    text = plan(x.ts_gaps(silver))
    assert "TakeOrderedAndProject" in text or "GlobalLimit" in text

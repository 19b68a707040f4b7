"""All overlapping pairs against a double loop; the rules as SQL functions against the DataFrame form."""

import itertools
import json
import random

from pyspark.sql import functions as F

from footfall.functions.ema import overlap
from footfall.operators import pairs as P
from footfall.operators import sql
from footfall.operators.bronze import bronze_ingest
from footfall.operators.silver import parse_detections, silver_stream
from footfall.schemas import columns_of
from tests.test_streaming import rows

FRAME = ["store_id", "camera_id", "frame_index"]
SCHEMA = ("store_id string, camera_id string, frame_index long, class_id int, det_id string, conf double, "
          "x1 double, y1 double, x2 double, y2 double")


def brute(values, least=0.0):
    """Copies stand as the best of them; every pair of a frame and class is compared."""
    folded = {}
    for v in values:
        key, box = v[:4], v[6:]
        if None not in box and box[2] > box[0] and box[3] > box[1]:
            folded.setdefault((key, box), []).append((-(v[5] or 0.0), v[4]))
    frames = {}
    for (key, box), members in folded.items():
        frames.setdefault(key, []).append((min(members), box, len(members)))
    out = []
    for key, boxes in frames.items():
        out += [(*key, lead[1], lead[1], 1.0, n * (n - 1) // 2) for lead, _, n in boxes if n > 1]
        for (a, box, n), (b, other, m) in itertools.combinations(sorted(boxes), 2):
            iou = overlap(box, other)
            if iou > 0 and iou >= least:
                out.append((*key, a[1], b[1], round(iou, 9), n * m))
    return sorted(out, key=repr)


def test_pairs_against_a_double_loop(spark):
    rng = random.Random(4)
    values = []
    for f in range(12):
        for i in range(60):
            # Sides from a pixel to the whole picture, corners on and off the cells, negative ones too.
            x, y = rng.choice([rng.uniform(-50, 1280), 64.0 * rng.randrange(0, 20)]), rng.choice([rng.uniform(-50, 720), 32.0 * rng.randrange(20)])
            w, h = (rng.choice([0.0, 0.5, 8.0, rng.uniform(1, 40), 64.0, rng.uniform(100, 1300)]) for _ in range(2))
            values.append(("s" if f % 3 else None, "c", f if f % 5 else None, rng.choice([0, 39, None]), f"{f}-{i}",
                           rng.choice([0.5, 0.9, None]), x, y, x + w, y + h))
            if i % 9 == 0:
                values += [(*values[-1][:4], f"{f}-{i}c{k}", 0.7, *values[-1][6:]) for k in range(3)]
    values.append(("s", "c", 1, 0, "null", 0.9, None, 1.0, 5.0, 5.0))
    boxes = spark.createDataFrame(values, SCHEMA)
    for least in (0.0, 0.3):
        found = P.overlapping_pairs(boxes, FRAME, least=least)
        got = sorted(((*r[:6], round(r.iou, 9), r.pairs) for r in found.collect()), key=repr)
        assert got == brute(values, least)
    assert P.overlapping_pairs(boxes.limit(0), FRAME).count() == 0


def test_a_crowded_frame_is_linear_in_its_pairs(spark):
    """100,000 boxes of one frame; the join meets few more pairs than there are."""
    cell = lambda c, n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("double") / c
    boxes = spark.range(100_000).select(
        F.lit("s").alias("store_id"), F.lit("c").alias("camera_id"), F.lit(1).alias("frame_index"), F.lit(0).alias("class_id"),
        F.col("id").cast("string").alias("det_id"), F.lit(0.5).alias("conf"),
        cell(10, 12_800, 1).alias("x1"), cell(10, 7_200, 2).alias("y1"))
    boxes = boxes.withColumn("x2", F.col("x1") + 4 + F.col("det_id").cast("int") % 3).withColumn("y2", F.col("y1") + 5)
    group, _, typed, _ = P._prepare(boxes, FRAME, ["det_id"])
    leaders = P._leaders(typed, group, ["det_id"], ["det_id"]).withColumn("det_id", F.col("row.det_id")).drop("row")
    met, found = P._candidates(leaders, group).count(), P.overlapping_pairs(boxes, FRAME).count()
    assert found > 300_000 and met < 4 * found


DIRTY = [
    {"conf": 0.9, "class": " None ", "class_id": "12", "track_id": "7.9", "bbox": {"x1": "1.5", "y1": -4, "x2": "NaN", "y2": 3e12}},
    {"conf": 1.7, "class": None, "track_id": None, "bbox": {"x1": 10, "x2": 2}},
    {"conf": "0.9", "class": "Bottle", "class_id": "x", "bbox": None},
    {"conf": -1, "det_id": "d", "class_id": 2.7, "track_id": 12345678901, "bbox": {"x1": 0.5, "y1": 0.49, "x2": 7, "y2": 1}},
]


def payloads():
    times = ["2025-01-01T10:00:00.500+00:00", "2025-01-01T10:00", "2025-01-01T12:00Z", "soon", None]
    for i, at in enumerate(times):
        for size in ({"width": "1280", "height": 720.9}, None):
            yield json.dumps({"source": {"store_id": "s", "camera_id": "c"}, "frame_index": i, "capture_ts": at,
                              "pipeline_run_id": "r", "image_size": size,
                              "detections": [{"det_id": f"{i}-{j}", **d} for j, d in enumerate(DIRTY)]})
    yield from ("{bad", "{}", '{"source":{"store_id":"s","camera_id":"c"},"detections":[]}')


def test_sql_functions_are_the_rules(spark):
    sql.register(spark)
    now = F.lit("2025-06-01T00:00:00Z").cast("timestamp")
    bronze = bronze_ingest(spark.createDataFrame([(p,) for p in payloads()], "value string"), now)
    bronze.createOrReplaceTempView("dirty_bronze")
    at = "TIMESTAMP'2025-06-01T00:00:00Z'"
    found = spark.sql(sql.detections_sql("dirty_bronze", at))
    expected = parse_detections(bronze, now)
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert rows(found, found.columns) == rows(expected, found.columns) and found.count() == 40
    columns = [c for c in columns_of("silver_detections") if c != "processing_ts"]
    assert rows(spark.sql(sql.silver_sql("dirty_bronze", at)), columns) == rows(silver_stream(bronze, now), columns)


def test_the_table_function_runs_without_python_and_parses_once(spark):
    sql.register(spark)
    bronze = bronze_ingest(spark.createDataFrame([(p,) for p in payloads()], "value string"))
    bronze.createOrReplaceTempView("plain_bronze")
    plan = spark.sql(sql.silver_sql("plain_bronze"))._jdf.queryExecution().optimizedPlan().toString()
    assert "ython" not in plan and plan.count("frame_index,StringType") == 1


def test_sql_jobs_do_not_join_on_payloads(spark):
    sql.register(spark)
    bronze = bronze_ingest(spark.createDataFrame([(p,) for p in payloads()], "value string"))
    bronze.createOrReplaceTempView("joined_bronze")
    for text in (sql.detections_sql, sql.silver_sql):
        plan = spark.sql(text("joined_bronze"))._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


def test_table_function_gives_the_rows_of_the_job(spark):
    sql.register(spark)
    now = F.lit("2025-06-01T00:00:00Z").cast("timestamp")
    bronze = bronze_ingest(spark.createDataFrame([(p,) for p in payloads()], "value string"), now)
    bronze.createOrReplaceTempView("table_bronze")
    at = "TIMESTAMP'2025-06-01T00:00:00Z'"
    job = spark.sql(sql.detections_sql("table_bronze", at)).drop("schema_version", "store_id", "camera_id")
    found = spark.sql(f"SELECT d.* FROM table_bronze b, LATERAL parse_detections(b.payload, {at}) d")
    assert found.schema.simpleString() == job.schema.simpleString()
    assert rows(found, found.columns) == rows(job, found.columns)

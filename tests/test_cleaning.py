"""Literal payloads for each cleaning rule."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from footfall.operators.bronze import bronze_ingest
from footfall.operators.silver import parse_detections, silver_batch, silver_stream

NOW = datetime(2025, 6, 1)


def now():
    return F.lit("2025-06-01T00:00:00Z").cast("timestamp")


def payload(dets, **over):
    frame = {
        "schema_version": "1.0", "pipeline_run_id": "r1",
        "source": {"store_id": "s1", "camera_id": "c1", "stream_id": "x"},
        "frame_index": 7, "capture_ts": "2025-01-01T00:00:01.2345+00:00",
        "image_size": {"width": 1280, "height": 720}, "detections": dets,
    }
    frame.update(over)
    return json.dumps({k: v for k, v in frame.items() if v is not ...})


def det(**over):
    d = {"det_id": "7-0", "class": "person", "class_id": 0, "conf": 0.9,
         "bbox": {"x1": 10.0, "y1": 20.0, "x2": 30.0, "y2": 60.0},
         "centroid": {"x": 20, "y": 40}, "track_id": 3}
    d.update(over)
    return {k: v for k, v in d.items() if v is not ...}


def bronze(spark, *payloads):
    values = F.array(*[F.lit(p) for p in payloads])
    return bronze_ingest(spark.range(1).select(F.explode(values).alias("value")), now())


def parsed(spark, *payloads):
    return parse_detections(bronze(spark, *payloads), now()).collect()


def test_bronze_keeps_broken_text_and_constants(spark):
    rows = bronze(spark, "{bad", payload([])).orderBy("payload").collect()
    good, bad = rows[0], rows[1]
    assert (bad.payload, bad.store_id, bad.camera_id) == ("{bad", None, None)
    assert (good.schema_version, good.pipeline_run_id, good.frame_index) == ("v1", None, None)
    assert (good.store_id, good.camera_id, good.ingest_ts) == ("s1", "c1", NOW)


@pytest.mark.parametrize("over, column, want", [
    ({"conf": ...}, "conf", 0.0),
    ({"conf": "0.9"}, "conf", 0.0),
    ({"conf": 1.7}, "conf", 1.0),
    ({"conf": -1}, "conf", 0.0),
    ({"conf": 1}, "conf", 1.0),
    ({"track_id": ...}, "track_id", -1),
    ({"track_id": None}, "track_id", -1),
    ({"track_id": "12"}, "track_id", 12),
    ({"track_id": "x"}, "track_id", -1),
    ({"class_id": ...}, "class_id", -1),
    ({"class_id": 3.7}, "class_id", 3),
    ({"class": ...}, "class_name", "person"),
    ({"class": "  "}, "class_name", "person"),
    ({"class": " NULL "}, "class_name", "person"),
    ({"class": "None"}, "class_name", "person"),
    ({"class": " dog "}, "class_name", "dog"),
    ({"det_id": ...}, "det_id", None),
    ({"bbox": ...}, "bbox_x2", 0),
    ({"bbox": {"x1": "10.5", "y1": 0, "x2": 20, "y2": 1}}, "bbox_x1", 11),
    ({"bbox": {"x1": 10.49, "y1": 0, "x2": 20, "y2": 1}}, "bbox_x1", 10),
    ({"bbox": {"x1": "junk", "y1": 0, "x2": 20, "y2": 1}}, "bbox_x1", 0),
    ({"bbox": {"x1": -8, "y1": 0, "x2": 20, "y2": 1}}, "bbox_x1", 0),
    ({"bbox": {"x1": 50, "y1": 0, "x2": 20, "y2": 1}}, "bbox_x2", 50),
    ({"bbox": {"x1": 5, "y1": 9, "x2": 20, "y2": 1}}, "bbox_y2", 9),
    ({"bbox": {"x1": 1e18, "y1": 9, "x2": 20, "y2": 1}}, "bbox_x1", 2147483647),
])
def test_detection_defaults(spark, over, column, want):
    (row,) = parsed(spark, payload([det(**over)]))
    assert row[column] == want
    assert row["frame_index"] == 7 and row["bbox_x2"] >= row["bbox_x1"]


@pytest.mark.parametrize("text, want", [
    ("2025-01-01T00:00:01.2345+00:00", datetime(2025, 1, 1, 0, 0, 1, 234000)),
    ("2025-01-01T07:00:01+07:00", datetime(2025, 1, 1, 0, 0, 1)),
    ("2025-01-01T00:00:01Z", datetime(2025, 1, 1, 0, 0, 1)),
    ("2025-01-01T00:00:01", NOW),
    ("2025-01-01 00:00:01Z", NOW),
    ("yesterday", NOW),
    (None, NOW),
    (..., NOW),
])
def test_capture_time(spark, text, want):
    (row,) = parsed(spark, payload([det()], capture_ts=text))
    assert row.capture_ts == want


def test_capture_time_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        (row,) = parsed(spark, payload([det()]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.capture_ts == datetime(2025, 1, 1, 0, 0, 1, 234000)


def test_image_size_and_missing_lists(spark):
    (row,) = parsed(spark, payload([det()], image_size=...))
    assert (row.img_w, row.img_h) == (0, 0)
    assert parsed(spark, payload(...), payload("x"), payload([]), payload(None), "{bad", "") == []


def test_stream_keeps_trackless_rows_and_batch_drops_them(spark):
    rows = bronze(spark, payload([det(track_id=None), det(det_id="7-1")]))
    assert silver_stream(rows, now()).count() == 2
    assert [r.det_id for r in silver_batch(rows).collect()] == ["7-1"]


def test_incomplete_and_weak_rows_are_dropped(spark):
    weak = payload([det(conf=0.39), det(det_id=...), det(det_id="ok", conf=0.4)])
    lost = [payload([det()], frame_index=...), payload([det()], source={"store_id": "s1"})]
    rows = silver_stream(bronze(spark, weak, *lost), now()).collect()
    assert [r.det_id for r in rows] == ["ok"]


def test_best_copy_wins_and_runs_can_be_kept_apart(spark):
    rows = bronze(
        spark,
        payload([det(conf=0.5, track_id=1), det(conf=0.8, track_id=2)]),
        payload([det(conf=0.8, track_id=4)], pipeline_run_id="r2", capture_ts="2025-01-01T00:00:02Z"),
    )
    (best,) = silver_stream(rows, now()).collect()
    assert (best.track_id, best.pipeline_run_id) == (4, "r2")
    assert {r.track_id for r in silver_stream(rows, now(), run_scoped=True).collect()} == {2, 4}


def test_batch_reads_values_as_written(spark):
    text = payload([det(**{"class": " None ", "bbox": {"x1": 10.25, "y1": 1, "x2": 5, "y2": 2}})])
    (row,) = silver_batch(bronze(spark, text)).collect()
    assert (row["class"], row.bbox_x1, row.bbox_x2, row.centroid_x) == (" None ", 10.25, 5.0, 20.0)
    assert row.capture_ts == datetime(2025, 1, 1, 0, 0, 1, 234000)
    assert silver_batch(bronze(spark, payload([det()], capture_ts="x"))).count() == 0


def test_batch_takes_text_confidence_and_times_without_a_zone(spark):
    def batch(time="2025-01-01T00:00:01Z", **more):
        return [(r.conf, r.capture_ts) for r in silver_batch(bronze(spark, payload([det(**more)], capture_ts=time))).collect()]

    assert batch(conf="0.9")[0][0] == 0.9
    assert batch(conf="NaN") == batch(conf="high") == []
    assert batch("2025-01-01T05:06:07.9876")[0][1] == datetime(2025, 1, 1, 5, 6, 7, 987000)
    assert batch("2025-01-01")[0][1] == datetime(2025, 1, 1)
    assert batch("2025-01-01T02:00:00+02:00")[0][1] == datetime(2025, 1, 1)
    assert batch("01/02/2025") == []


def test_stream_keeps_text_confidence_out(spark):
    assert silver_stream(bronze(spark, payload([det(conf="0.9")])), now()).count() == 0


def test_an_object_is_no_routing_value(spark):
    rows = bronze(spark, payload([], source={"store_id": {"a": 1}, "camera_id": ["c"]}), payload([])).collect()
    assert (rows[0].store_id, rows[0].camera_id) == (None, None) and rows[1].store_id is not None

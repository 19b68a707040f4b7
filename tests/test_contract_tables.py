"""Faults told apart; partition statistics from metadata; buckets that need no shuffle."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall.operators import contract as C
from footfall.operators import gold as g
from footfall.operators import quality as q
from footfall.schemas import FRAME_RECORD, columns_of, struct_of, table_schema
from footfall.session import shared_dir
from footfall.sources import tables as T
from tests.test_streaming import rows


def whole():
    det = {"det_id": "1-0", "class": "person", "class_id": 0, "conf": 0.5,
           "bbox": {"x1": 1, "y1": 2.5, "x2": 3.0, "y2": 4}, "bbox_norm": {"x": 0.1, "y": 0.1, "w": 0.1, "h": 0},
           "centroid": {"x": 1, "y": 2}, "centroid_norm": {"x": 0.5, "y": 0.5}, "track_id": 3}
    return {"schema_version": "1.0", "pipeline_run_id": "r", "source": {"store_id": "s", "camera_id": "c", "stream_id": "t"},
            "frame_index": 1, "capture_ts": "x", "image_size": {"width": 1, "height": 2}, "detections": [det, dict(det)],
            "runtime": {"model_name": "m", "tracker_type": "t", "conf_thres": 0.2, "class_filter": [0, 39]}, "source_uri": "u"}


def brute(value, kind, path=""):
    """Faults of a parsed value against the declared type, by recursion."""
    name, at = kind.simpleString(), path.removesuffix(".")
    if name.startswith("struct"):
        if not isinstance(value, dict):
            return [(at or "record", "wrong_type" if at else "unreadable")]
        out = [(path + k, "unknown") for k in value if k not in kind.fieldNames()]
        for f in kind.fields:
            if value.get(f.name) is None:
                out += [(path + f.name, "missing")] if path + f.name not in C.OPTIONAL else []
            else:
                out += brute(value[f.name], f.dataType, f"{path}{f.name}.")
        return out
    if name.startswith("array"):
        if not isinstance(value, list):
            return [(at, "wrong_type")]
        return [x for item in value for x in brute(item, kind.elementType, f"{at}[].")]
    fits = {"string": isinstance(value, str), "double": isinstance(value, (int, float)) and not isinstance(value, bool)}
    return [] if fits.get(name, isinstance(value, int) and not isinstance(value, bool)) else [(at, "wrong_type")]


def damaged(rng):
    """A record with a few values taken out, replaced or added anywhere."""
    record = whole()
    for _ in range(rng.randrange(4)):
        node = record
        while True:
            key = rng.choice(list(node) if isinstance(node, dict) else range(len(node)))
            if isinstance(node[key], (dict, list)) and node[key] and rng.random() < 0.7:
                node = node[key]
                continue
            break
        what = rng.randrange(4)
        if what == 0 and isinstance(node, dict):
            del node[key]
        elif what == 1 and isinstance(node, dict):
            node[rng.choice(["weather", "z"])] = rng.choice([1, {"a": 1}, None])
        else:
            node[key] = rng.choice([None, "text", 7, 2.5, True, [1], {"q": 1}, []])
    return record


def test_faults_against_a_recursive_check(spark):
    rng = random.Random(9)
    records = [whole(), {**whole(), "detections": []}] + [damaged(rng) for _ in range(400)]
    texts = [json.dumps(r) for r in records] + ["{bad", "[1]", "7", "", None]
    schema = struct_of(FRAME_RECORD)
    expected = [sorted(brute(r, schema)) for r in records] + [[("record", "unreadable")]] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    found = {r["n"]: sorted((f.field, f.problem) for f in r["faults"]) for r in C.with_faults(df).collect()}
    assert [found[i] for i in range(len(texts))] == expected
    faults = Counter(x for own in expected for x in own)
    in_records = Counter(x for own in expected for x in set(own))
    report = {(r.field, r.problem): (r.faults, r.records) for r in C.fault_report(df).collect()}
    assert report == {k: (n, in_records[k]) for k, n in faults.items()}
    assert {p for _, p in report} == {"missing", "wrong_type", "unknown", "unreadable"}
    assert C.accepted(df).count() == sum(not x for x in expected) and C.rejects(df).count() == sum(map(bool, expected))
    assert C.accepted(df).columns == df.columns


def test_one_parse_and_no_python(spark):
    df = spark.createDataFrame([(json.dumps(whole()),)], "payload string")
    plan = C.with_faults(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "ython" not in plan
    with pytest.raises(ValueError, match="lists of objects"):
        C.with_faults(df, schema="a array<struct<b: array<struct<c: int>>>>")


def silver(spark):
    names = [f"cam_{i % 7}" for i in range(2000)]
    values = [("v1", "r", f"s{i % 3}" if i % 50 else "", names[i], i, f"{i}-0", 0.5 + (i % 5) / 10, i % 11) for i in range(2000)]
    df = spark.createDataFrame(values, "schema_version string, pipeline_run_id string, store_id string, camera_id string, "
                                       "frame_index long, det_id string, conf double, track_id long")
    at = F.timestamp_add("SECOND", F.col("frame_index") * 70, F.lit("2025-01-01").cast("timestamp_ntz"))
    box = {c: (F.col("frame_index") % n).cast("int") for c, n in (("bbox_x1", 900), ("bbox_y1", 500), ("bbox_x2", 1200), ("bbox_y2", 700))}
    df = df.withColumns({"capture_ts": at, "img_w": F.lit(1280), "img_h": F.lit(720), "class_name": F.lit("person"),
                         "class_id": F.lit(0), "processing_ts": F.current_timestamp(), **box})
    return df.select(*columns_of("silver_detections"))


def test_partition_statistics_read_no_row(spark):
    path, rows_in = shared_dir(spark, "t-parts"), silver(spark)
    T.write_table(rows_in, path, "silver_detections")
    found = q.stored_partitions(spark, path, ["store_id", "capture_date"], k=50)
    stored = T.read_table(spark, path, "silver_detections")
    expected = q.partition_stats(stored, ["store_id", "capture_date"], k=50, files=True)
    assert rows(found, expected.columns) == rows(expected, expected.columns)
    assert found.where("bytes <= 0").count() == 0 and found.where("store_id = ''").count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<length:bigint>" in plan


def test_tables_cut_alike_need_no_shuffle(spark):
    rows_in, work = silver(spark), shared_dir(spark, "t-buckets")
    before = spark.catalog.currentDatabase()
    T.create_database(spark, "footfall_test", use=False)
    tag = work.rsplit("-", 1)[1]
    names = {}
    for name, df in (("silver_detections", rows_in), ("gold_minute_by_cam", g.gold_minute_by_cam(rows_in))):
        names[name] = f"footfall_test.{name}_{tag}"
        T.publish_bucketed(df, name, names[name], f"{work}/{name}", buckets=4)
        T.publish_bucketed(df, name, names[name], f"{work}/{name}", buckets=4)  # replaces
    assert spark.catalog.currentDatabase() == before
    own = T.co_located(spark)
    stored, gold = own.table(names["silver_detections"]), own.table(names["gold_minute_by_cam"])
    for make in (g.gold_minute_by_cam, g.gold_zone_dwell, g.gold_track_summary):
        found = make(stored)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found, found.columns) == rows(make(rows_in), found.columns)
    as_of = F.lit("2025-01-01 12:00:00").cast("timestamp_ntz")
    diff = q.gold_silver_diff(gold.where("minute(ts_minute) <> 3"), stored, as_of)
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 4 out of 4" in plan and "hashpartitioning" not in plan
    expected = q.gold_silver_diff(g.gold_minute_by_cam(rows_in).where("minute(ts_minute) <> 3"), rows_in, as_of)
    assert diff.count() > 0 and rows(diff, diff.columns) == rows(expected, diff.columns)
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


def test_clean_objects_are_told_without_building_faults(spark):
    places = C._places(struct_of("a int, b struct<x:double>, o string"))
    texts = {'{"a":1,"b":{"x":0.5}}': True, '{"a":1,"b":{"x":2},"o":"t"}': True, '{"a":1,"b":{"x":2},"o":null}': True,
             '{"a":1,"b":{"x":2},"o":3}': False, '{"a":1,"b":{"x":2},"z":null}': False, '{"a":1,"b":{"x":2,"y":1}}': False,
             '{"a":null,"b":{"x":2}}': False, '{"b":{"x":2}}': False, '{"a":1,"b":[]}': False, '{"a":"1","b":{"x":2}}': False,
             '[1]': False, '7': False, '{}': False}
    value = F.parse_json("t")
    seen = C._seen(value, C._names(value, places), places, {})
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", seen.alias("seen"))
    found = rows.select("t", C._clean(F.col("seen"), places, "i[].", frozenset({"i[].o"})).alias("clean")).collect()
    assert {r.t: r.clean for r in found} == texts

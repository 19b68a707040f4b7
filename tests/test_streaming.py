"""Streams must end in what the batch functions give for the same payloads."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from footfall.operators import gold as g
from footfall.operators.bronze import bronze_ingest
from footfall.operators.silver import silver_stream
from footfall.schemas import KEYS, columns_of, struct_of
from footfall.session import shared_dir
from footfall.sources.frames import stream_jsonl
from footfall.streaming import jobs
from footfall.streaming.jobs import STAGE, VIEWS, Pipeline
from footfall.streaming.keyed import KeyedTable


def now():
    return F.lit("2025-06-01T00:00:00Z").cast("timestamp")


def frame(index, second, dets, store="s1", camera="c1"):
    return json.dumps({
        "source": {"store_id": store, "camera_id": camera}, "frame_index": index, "pipeline_run_id": "r",
        "capture_ts": f"2025-01-01T10:{second // 60:02d}:{second % 60:02d}.500+00:00",
        "image_size": {"width": 1280, "height": 720},
        "detections": [
            {"det_id": f"{index}-{j}", "class": "person", "class_id": 0, "conf": conf, "track_id": track,
             "bbox": {"x1": x, "y1": 100.0, "x2": x + 50, "y2": 220.0}}
            for j, conf, track, x in dets],
    })


# Later waves hold better copies (other minute, other zone, other track), a late
# frame, an exact repeat, a weaker copy and broken text.
WAVES = [
    [frame(i, 10 * i, [(0, 0.6, i % 3, 20.0 * i), (1, 0.7, None, 300.0)], f"s{i % 2}") for i in range(12)] + ["{bad"],
    [
        frame(4, 200, [(0, 0.9, 1, 20.0 * 4)], "s0"),      # moves to another minute
        frame(5, 50, [(0, 0.8, 2, 900.0)], "s1"),           # moves to another zone
        frame(6, 60, [(1, 0.95, 8, 300.0)], "s0"),          # gets a track
        frame(7, 70, [(0, 0.5, 1, 20.0)], "s1"),            # weaker, ignored
        frame(8, 80, [(0, 0.6, 2, 160.0), (1, 0.7, None, 300.0)], "s0"),  # repeat
    ],
    [
        frame(0, 0, [(0, 0.99, 0, 640.0)], "s0"),           # late and better
        frame(4, 40, [(0, 0.97, 1, 80.0)], "s0"),           # moves back
        frame(90, 3700, [(0, 0.5, 4, 10.0)], "s1"),
        frame(91, 5, [(0, 0.5, 4, 10.0)], "s1"),            # late
        frame(92, 6, [(0, 0.5, 4, 10.0)], ""),              # a store without a name
    ],
]


def lines(spark, texts):
    return spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in texts])).alias("value")).coalesce(1)


def rows(df, columns):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module", autouse=True)
def tiny_data(spark):
    """Compiling a plan takes far longer than running it on a few rows."""
    keys = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def expected(spark):
    silver = silver_stream(bronze_ingest(lines(spark, sum(WAVES, [])), now()), now()).cache()
    columns = [c for c in columns_of("silver_detections") if c != "processing_ts"]
    out = {name: rows(make(silver), columns_of(name)) for name, make in g.GOLD.items()}
    return {"silver": rows(silver, columns), **out}


def check(pipeline, expected):
    columns = [c for c in columns_of("silver_detections") if c != "processing_ts"]
    assert rows(pipeline.silver(), columns) == expected["silver"]
    for name in KEYS:
        assert rows(pipeline.view(name), columns_of(name)) == expected[name], name


@pytest.mark.parametrize("form", ["own_jobs", "one_job", "ranges"])
def test_layers_run_in_turn_and_end_like_batch(spark, expected, form, monkeypatch):
    """Every layer runs between the waves, so Gold has counted rows that change later.
    Each wave goes on from the checkpoints of the one before."""
    if form == "ranges":  # more folders than a list of names may have
        monkeypatch.setattr(jobs, "PRUNE_LIST", 1)
    landing, root = shared_dir(spark, "t-land"), shared_dir(spark, "t-live")
    pipeline = None
    for wave in WAVES:
        lines(spark, wave).write.mode("append").text(landing)
        pipeline = Pipeline(spark, root, now=now())
        pipeline.start_bronze(stream_jsonl(spark, landing)).awaitTermination()
        pipeline.start_silver().awaitTermination()
        if form != "own_jobs":
            pipeline.start_all().awaitTermination()
        else:
            for name in VIEWS:
                pipeline.start_view(name).awaitTermination()
    check(pipeline, expected)
    dead = pipeline.tables["gold_minute_by_cam"].versions(spark).where("is_deleted").count()
    assert dead > 0 and pipeline.bronze().count() == sum(len(w) for w in WAVES)


def run_wave(spark, pipeline, landing, wave, views=True):
    lines(spark, wave).write.mode("append").text(landing)
    pipeline.start_bronze(stream_jsonl(spark, landing)).awaitTermination()
    pipeline.start_silver().awaitTermination()
    for name in VIEWS if views else ():
        pipeline.start_view(name).awaitTermination()


def test_queries_may_take_turns(spark, expected):
    """Views, then one job, then views again, on one root."""
    landing, pipeline = shared_dir(spark, "t-land"), Pipeline(spark, shared_dir(spark, "t-turns"), now=now())
    for n, wave in enumerate(WAVES):
        run_wave(spark, pipeline, landing, wave, views=n != 1)
        if n == 1:
            pipeline.start_all().awaitTermination()
    check(pipeline, expected)


def test_a_lost_checkpoint_goes_on_above_what_is_stored(spark, expected):
    landing, root = shared_dir(spark, "t-land"), shared_dir(spark, "t-lost")
    first = Pipeline(spark, root, now=now())
    for wave in WAVES[:2]:
        run_wave(spark, first, landing, wave)
    lines(spark, WAVES[2]).write.mode("append").text(landing)
    first.start_bronze(stream_jsonl(spark, landing)).awaitTermination()
    second = Pipeline(spark, root, now=now(), checkpoints=f"{root}/_new")
    second.start_silver().awaitTermination()
    for name in VIEWS:
        second.start_view(name).awaitTermination()
    check(second, expected)


def test_a_late_commit_fails_and_is_tried_again(spark, expected, monkeypatch):
    landing, pipeline = shared_dir(spark, "t-land"), Pipeline(spark, shared_dir(spark, "t-late"), now=now())
    for wave in WAVES[:-1]:
        run_wave(spark, pipeline, landing, wave)
    run_wave(spark, pipeline, landing, WAVES[-1], views=False)
    finished = KeyedTable.finished
    for name in VIEWS:
        if VIEWS[name].how != "recompute":
            with monkeypatch.context() as late:
                late.setattr(jobs, "COMMIT_WAIT", 0.0)
                late.setattr(KeyedTable, "finished", lambda table, *a: finished(table, *a) - 1)
                with pytest.raises(StreamingQueryException):
                    pipeline.start_view(name).awaitTermination()
        pipeline.start_view(name).awaitTermination()
    check(pipeline, expected)


def test_one_job_looks_silver_up_once_in_a_batch(spark, expected, monkeypatch):
    landing, pipeline = shared_dir(spark, "t-land"), Pipeline(spark, shared_dir(spark, "t-once"), now=now())
    for wave in WAVES:
        run_wave(spark, pipeline, landing, wave, views=False)
        looked, current = [], KeyedTable.current
        with monkeypatch.context() as counted:
            counted.setattr(KeyedTable, "current", lambda t, *a, **k: looked.append(t.path) or current(t, *a, **k))
            pipeline.start_all().awaitTermination()
        assert looked.count(pipeline.tables["silver"].path) == 1
    check(pipeline, expected)


def test_rows_of_a_camera_minute_are_aggregated_where_they_lie(spark, monkeypatch):
    """The look-up spreads Silver's rows by camera and minute; aggregates by these need no further shuffle."""
    landing, pipeline = shared_dir(spark, "t-land"), Pipeline(spark, shared_dir(spark, "t-place"), now=now())
    plans, write = {}, KeyedTable.write

    def kept(table, n, out):
        plans[table.path] = out._jdf.queryExecution().executedPlan().toString()
        write(table, n, out)

    run_wave(spark, pipeline, landing, WAVES[0], views=False)
    monkeypatch.setattr(KeyedTable, "write", kept)
    pipeline.start_view("gold_minute_by_cam").awaitTermination()
    plan = plans[pipeline.tables["gold_minute_by_cam"].path]
    own = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert sum("frame_index" in line.split("hashpartitioning(")[-1].split(")")[0] for line in own) == 0
    assert sum("track_id" in line.split("hashpartitioning(")[-1].split(")")[0] for line in own) == 0


def test_two_running_writers_are_refused(spark):
    landing, pipeline = shared_dir(spark, "t-land"), Pipeline(spark, shared_dir(spark, "t-two"), now=now())
    run_wave(spark, pipeline, landing, WAVES[0], views=False)
    running = pipeline.start_view("gold_minute_by_cam", "1 hour")
    try:
        with pytest.raises(RuntimeError, match="same tables"):
            pipeline.start_all()
        with pytest.raises(RuntimeError, match="same tables"):
            pipeline.start_view("gold_minute_by_cam")
    finally:
        running.stop()


@pytest.mark.parametrize("fold", [False, True])
def test_replay_and_compaction_change_nothing(spark, expected, fold):
    root = shared_dir(spark, "t-replay")
    pipeline = Pipeline(spark, root, now=now())
    silver = pipeline.tables["silver"].create(spark)
    for n, wave in enumerate(WAVES):
        batch = bronze_ingest(lines(spark, wave), now())
        for _ in range(1 + n % 2):  # the second batch is replayed
            pipeline.merge_silver(batch, n)
        for name, view in VIEWS.items():
            pipeline.tables[name].create(spark)
            for _ in range(1 + n % 2):
                if view.how == "recompute":
                    pipeline.refresh(name, silver.batches(spark, n - 1, n), n)
                else:
                    pipeline.apply(name, n, n - 1, n)
        for table in pipeline.tables.values() if fold else ():
            table.compact(spark, n)
            table.vacuum(spark)
    check(pipeline, expected)
    assert pipeline.view(STAGE).agg(F.sum("hits")).first()[0] == len(expected["silver"])
    left = [silver.batches(spark, -1, 9).count(), silver.versions(spark).count()]
    assert left == [0, len(expected["silver"])] if fold else left[0] > len(expected["silver"])


def test_keyed_table_reads_the_newest_row_and_hides_deleted_ones(spark):
    table = KeyedTable(shared_dir(spark, "t-keyed"), struct_of("k string, v int"), ["k"]).create(spark)
    table.write(0, spark.sql("SELECT * FROM VALUES ('a', 1), ('b', 2), ('c', 3) AS t(k, v)"))
    table.write(1, spark.sql("SELECT * FROM VALUES ('a', 10, false), ('b', 2, true) AS t(k, v, is_deleted)"))
    assert rows(table.current(spark), ["k", "v"]) == [("a", 10), ("c", 3)]
    assert rows(table.current(spark, before=1), ["k", "v"]) == [("a", 1), ("b", 2), ("c", 3)]
    table.compact(spark, 1)
    table.vacuum(spark)
    table.write(2, spark.sql("SELECT * FROM VALUES ('b', 7) AS t(k, v)"))
    assert rows(table.current(spark), ["k", "v"]) == [("a", 10), ("b", 7), ("c", 3)]

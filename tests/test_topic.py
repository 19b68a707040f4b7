"""The message log: order, offsets, restarts, subscriptions, expiry."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.session import shared_dir
from footfall.sources import frames
from footfall.sources import topic as T


def numbers(spark, start, stop):
    return spark.range(start, stop, numPartitions=3).select(
        F.col("id").cast("string").alias("value"), (F.col("id") % 7).cast("string").alias("key"))


def run(spark, log, out, checkpoint="c", **how):
    query = T.stream_topic(spark, log, **how).writeStream.format("parquet").option("path", f"{out}/rows").option(
        "checkpointLocation", f"{out}/{checkpoint}").trigger(availableNow=True).start()
    query.awaitTermination()
    found = [int(r.value) for r in spark.read.parquet(f"{out}/rows").select("value").collect()]
    return sorted(found)


def test_batch_offsets_have_no_gap_and_keys_keep_their_order(spark):
    log = shared_dir(spark, "t-topic")
    for start in (0, 100):
        T.write_topic(numbers(spark, start, start + 100).coalesce(1), log, partitions=3)
    rows = T.read_topic(spark, log).collect()
    assert sorted(int(r.value) for r in rows) == list(range(200))
    for p in range(3):
        own = sorted((r.offset, r.key, int(r.value)) for r in rows if r.partition == p)
        assert [o for o, _, _ in own] == list(range(len(own)))
        for key in {k for _, k, _ in own}:
            values = [v for _, k, v in own if k == key]
            assert values == sorted(values)
    assert len({(r.key, r.partition) for r in rows}) == len({r.key for r in rows})


def test_restarts_in_the_middle_of_the_log_lose_and_repeat_nothing(spark):
    log, out = shared_dir(spark, "t-topic"), shared_dir(spark, "t-out")
    T.write_topic(numbers(spark, 0, 90), log)
    seen, sizes = [], []
    for turn in range(6):
        if turn == 2:
            T.write_topic(numbers(spark, 90, 150), log)
        seen = run(spark, log, out, subscription="s", most=40)
        sizes.append(len(seen))
        assert len(set(seen)) == len(seen)
    assert seen == list(range(150)) and all(b - a <= 44 for a, b in zip([0, *sizes], sizes)) and sizes[1] < 90


def test_a_plan_that_was_never_run_is_not_skipped(spark):
    log, out = shared_dir(spark, "t-topic"), shared_dir(spark, "t-out")
    T.write_topic(numbers(spark, 0, 60), log)
    run(spark, log, out, subscription="s", most=20)
    reader = T._StreamReader({"path": log, "subscription": "s", "maxoffsetspertrigger": "20"})
    reader.latestOffset()  # planned, and the driver dies before it is in the checkpoint
    for _ in range(3):
        seen = run(spark, log, out, subscription="s", most=20)
    assert seen == list(range(60))


def test_subscriptions_outlive_a_checkpoint_and_let_segments_expire(spark):
    log, out = shared_dir(spark, "t-topic"), shared_dir(spark, "t-out")
    T.write_topic(numbers(spark, 0, 50), log)
    run(spark, log, out, subscription="s")
    T.write_topic(numbers(spark, 50, 60), log)
    run(spark, log, out, subscription="s")     # commits the first stretch
    assert T.expire(log) > 0 and T.read_topic(spark, log).count() == 10
    T.write_topic(numbers(spark, 60, 70), log)
    other = shared_dir(spark, "t-out")
    assert run(spark, log, other, subscription="s") == list(range(50, 70))  # a new query, committed offsets
    with pytest.raises(StreamingQueryException, match="expired"):
        late = shared_dir(spark, "t-out")
        T.Log(log).commit("t", {p: 0 for p in range(T.PARTITIONS)})
        run(spark, log, late, subscription="t")


def test_latest_blank_messages_and_an_empty_log(spark):
    log, out = shared_dir(spark, "t-topic"), shared_dir(spark, "t-out")
    T.Log(log).create(2)
    assert T.read_topic(spark, log).count() == 0
    blank = spark.createDataFrame([(" ",), (None,), ("7",)], "value string")
    T.write_topic(blank, log)
    assert run(spark, log, out) == [7]
    fresh = shared_dir(spark, "t-out")
    query = T.stream_topic(spark, log, starting="latest").writeStream.format("noop").option(
        "checkpointLocation", f"{fresh}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert not query.recentProgress or query.lastProgress["numInputRows"] == 0


def test_one_writer_at_a_time_and_bad_options(spark):
    log = shared_dir(spark, "t-topic")
    T.write_topic(numbers(spark, 0, 3), log)
    held = T.Log(log)
    held.fs.open_output_stream(held.at("_lock")).close()
    with pytest.raises(Exception, match="another writer"):
        T.write_topic(numbers(spark, 3, 6), log)
    held.fs.delete_file(held.at("_lock"))
    assert T.read_topic(spark, log).count() == 3
    with pytest.raises(Exception, match="column value"):
        spark.range(1).write.format(T.NAME).mode("append").save(log)
    with pytest.raises(ValueError, match="subscription"):
        T._StreamReader({"path": log, "maxoffsetspertrigger": "5"})


def test_a_segment_is_written_and_read_a_few_rows_at_a_time(tmp_path, monkeypatch):
    monkeypatch.setattr(T, "GROUP_BYTES", 1500)
    monkeypatch.setattr(T, "READ_ROWS", 4)
    schema = StructType().add("value", "string")
    writer = T._Writer({"path": str(tmp_path), "partitions": "1"}, schema)
    texts = [None if i == 50 else f"{i}" for i in range(100)]
    writer.commit([writer.write(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])]))])
    log = T.Log(str(tmp_path))
    assert log.segments(0) == [(0, 100)]
    assert pq.ParquetFile(log.file(0, 0, 100)).num_row_groups > 5
    for first, following in ((0, 100), (13, 14), (37, 81), (99, 100)):
        batches = list(T._rows(log, T.Stretch(0, log.file(0, 0, 100), 0, first, following)))
        assert max(b.num_rows for b in batches) <= 4
        assert [v for b in batches for v in b.column(3).to_pylist()] == texts[first:following]
        assert [o for b in batches for o in b.column(1).to_pylist()] == list(range(first, following))


def test_compressed_lines_are_read_back(spark, monkeypatch):
    monkeypatch.setattr(frames, "FILE_RECORDS", 40)
    path = shared_dir(spark, "t-lines")
    frames.write_jsonl(numbers(spark, 0, 100).coalesce(1), path, compression="gzip")
    assert sorted(int(r.value) for r in frames.read_jsonl(spark, path).collect()) == list(range(100))
    assert sum(n.endswith(".txt.gz") for n in os.listdir(path)) == 3

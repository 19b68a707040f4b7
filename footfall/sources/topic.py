"""A message log with offsets on a shared folder, as a Spark data source.

A topic is a folder with one subfolder for each partition. A partition is a sequence of segment
files named by the offsets they hold, ``<first>-<next>.parquet``; so the ends of the log and the
segments of a range are known from names, and a task opens only the segments it reads.

* **Batch write** (``df.write.format("folder_topic")``): rows ``value``, and ``key`` where there is one.
  Rows of one key go to one partition, in the order of the task. Tasks write segments aside;
  the driver gives them offsets and moves them in, after all tasks have ended. One writer at a
  time: a lock file is held from the first move to the last.
* **Batch read**: the whole log with ``partition, offset, key, value``.
* **Stream read**: partitions are read from ``startingOffsets`` (``earliest``, the default, or
  ``latest``); Spark's checkpoint holds the offsets, so a query goes on where it stopped, without
  loss or repeat. ``maxOffsetsPerTrigger`` bounds a micro-batch over all partitions; it needs a
  subscription, where the source notes how far it has planned, because Spark does not tell a restarted
  source where its query stands. (After a crash between the two a micro-batch may take twice as much.)
* **Named subscription** (one query at a time): with ``subscription`` the offsets that a query has committed are kept beside
  the log as well. A new query of that name (a lost checkpoint) starts there, and ``expire`` deletes
  segments that all subscriptions have passed.

Options: ``path`` (a folder or a URI that Arrow's file systems know), ``partitions`` (of a new topic).
"""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from footfall.session import carry_to_workers

carry_to_workers(__name__)

NAME = "folder_topic"
SCHEMA = "partition int, offset bigint, key string, value string"
PARTITIONS = 4
SEGMENT_ROWS = 100_000
GROUP_BYTES = 4 << 20  # texts that a task holds for a partition before they go to its open segment
READ_ROWS = 1024       # rows of a segment that a task holds at a time
_FILES = pa.schema([("key", pa.string()), ("value", pa.string())])


class Log:
    """The folder of a topic."""

    def __init__(self, path: str):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = path[len("file:"):]
        found = pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)
        self.fs, self.root = found

    def at(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def _names(self, *parts: str) -> list[str]:
        return [f.base_name for f in self.fs.get_file_info(pafs.FileSelector(self.at(*parts), allow_not_found=True))]

    def create(self, partitions: int) -> None:
        for p in range(partitions):
            self.fs.create_dir(self.at(f"partition={p}"), recursive=True)

    def partitions(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in self._names() if n.startswith("partition="))

    def segments(self, partition: int) -> list[tuple[int, int]]:
        """(first, next) offsets of a partition's segments, in order."""
        return sorted(tuple(map(int, n.removesuffix(".parquet").split("-"))) for n in self._names(f"partition={partition}"))

    def file(self, partition: int, first: int, following: int) -> str:
        return self.at(f"partition={partition}", f"{first:020d}-{following:020d}.parquet")

    def ends(self) -> dict[int, tuple[int, int]]:
        """For each partition the first offset that is there and the one behind the last."""
        found = {p: self.segments(p) for p in self.partitions()}
        # Where all segments have expired, the log goes on behind the last of them.
        return {p: (s[0][0], max(x[1] for x in s)) if s else (self._expired(p),) * 2 for p, s in found.items()}

    def _read(self, *parts: str) -> dict | None:
        if self.fs.get_file_info(self.at(*parts)).type == pafs.FileType.NotFound:
            return None
        with self.fs.open_input_stream(self.at(*parts)) as stream:
            return json.loads(stream.read() or b"{}")

    def _write(self, content: dict, *parts: str) -> None:
        """Written aside and moved in, so that readers see whole files."""
        self.fs.create_dir(posixpath.dirname(self.at(*parts)), recursive=True)
        aside = self.at(*parts) + f".{uuid.uuid4().hex}"
        with self.fs.open_output_stream(aside) as stream:
            stream.write(json.dumps(content).encode())
        self.fs.move(aside, self.at(*parts))

    def _expired(self, partition: int) -> int:
        return int((self._read("_expired", f"{partition}") or {}).get("next", 0))

    def committed(self, subscription: str) -> dict[int, int] | None:
        found = self._read("_subscriptions", subscription)
        return None if found is None else {int(p): n for p, n in found.items()}

    def commit(self, subscription: str, offsets: dict[int, int]) -> None:
        self._write({str(p): n for p, n in offsets.items()}, "_subscriptions", subscription)

    def planned(self, subscription: str) -> dict[int, int] | None:
        found = self._read("_planned", subscription)
        return None if found is None else {int(p): n for p, n in found.items()}

    def plan(self, subscription: str, offsets: dict[int, int]) -> None:
        self._write({str(p): n for p, n in offsets.items()}, "_planned", subscription)

    def expire(self) -> int:
        """Deletes the segments that every subscription has passed; how many those were."""
        names = [n for n in self._names("_subscriptions") if "." not in n]
        if not names:
            return 0
        deleted = 0
        for p in self.partitions():
            passed = min((self.committed(n) or {}).get(p, 0) for n in names)
            for first, following in self.segments(p):
                if following <= passed:
                    self._write({"next": following}, "_expired", f"{p}")
                    self.fs.delete_file(self.file(p, first, following))
                    deleted += 1
        return deleted


@dataclass
class Stretch(InputPartition):
    """Offsets ``first`` to ``following`` - 1 of one segment file."""
    partition: int
    file: str
    base: int
    first: int
    following: int

    def __post_init__(self) -> None:
        self.value = None  # the base class' slot


def _stretches(log: Log, start: dict[int, int], end: dict[int, int]) -> list[Stretch]:
    found = []
    for p, stop in end.items():
        begin = start.get(p, 0)
        held = log.segments(p) if begin < stop else []
        if held and held[0][0] > begin:
            raise ValueError(f"offsets {begin} to {held[0][0] - 1} of partition {p} have expired")
        for first, following in held:
            a, b = max(first, begin), min(following, stop)
            if a < b:
                found.append(Stretch(p, log.file(p, first, following), first, a, b))
    return found


def _rows(log: Log, stretch: Stretch) -> Iterator[pa.RecordBatch]:
    """The stretch's rows, a batch at a time."""
    with log.fs.open_input_file(stretch.file) as source:
        file, offset = pq.ParquetFile(source), stretch.base
        groups = []  # the row groups that hold the stretch
        for i in range(file.num_row_groups):
            following = offset + file.metadata.row_group(i).num_rows
            if offset < stretch.following and stretch.first < following:
                groups.append((i, offset))
            offset = following
        offset = groups[0][1]
        for batch in file.iter_batches(READ_ROWS, [i for i, _ in groups], ["key", "value"]):
            a, b = max(stretch.first - offset, 0), min(stretch.following - offset, batch.num_rows)
            if a < b:
                piece = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([stretch.partition] * len(piece), pa.int32()),
                     pa.array(range(offset + a, offset + b), pa.int64()), piece.column(0), piece.column(1)],
                    ["partition", "offset", "key", "value"])
            offset += batch.num_rows


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[Stretch]:
        log = Log(self.path)
        ends = log.ends()
        return _stretches(log, {p: a for p, (a, _) in ends.items()}, {p: b for p, (_, b) in ends.items()})

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        return _rows(Log(self.path), partition) if partition is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.subscription = options["path"], options.get("subscription")
        self.most = int(options.get("maxoffsetspertrigger", 0))
        self.latest_first = options.get("startingoffsets", "earliest") == "latest"
        if self.most and not self.subscription:
            raise ValueError("maxOffsetsPerTrigger needs a subscription")
        self.at: dict[int, int] | None = None  # where the next micro-batch begins

    def initialOffset(self) -> dict:
        log = Log(self.path)
        known = log.committed(self.subscription) if self.subscription else None
        self.at = {p: (known or {}).get(p, b if self.latest_first and known is None else a)
                   for p, (a, b) in log.ends().items()}
        return {str(p): n for p, n in self.at.items()}

    def latestOffset(self) -> dict:
        log = Log(self.path)
        ends = {p: b for p, (_, b) in log.ends().items()}
        if not self.most:
            return {str(p): n for p, n in ends.items()}
        if self.at is None:  # a restarted query: no offset of its checkpoint is beyond what was planned
            self.at = log.planned(self.subscription) or {p: a for p, (a, _) in log.ends().items()}
        # A micro-batch takes like shares of what the partitions hold.
        waiting = {p: max(0, n - self.at.get(p, 0)) for p, n in ends.items()}
        total = sum(waiting.values())
        self.at = {p: self.at.get(p, 0) + (-(-w * min(self.most, total) // total) if w else 0) for p, w in waiting.items()}
        log.plan(self.subscription, self.at)
        return {str(p): n for p, n in self.at.items()}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        start, end = ({int(p): n for p, n in offsets.items()} for offsets in (start, end))
        return _stretches(Log(self.path), start, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _rows(Log(self.path), partition)

    def commit(self, end: dict) -> None:
        if self.subscription:
            Log(self.path).commit(self.subscription, {int(p): n for p, n in end.items()})


class _Segment:
    """A segment that a task writes aside, in row groups of ``GROUP_BYTES``."""

    def __init__(self, log: Log):
        self.file = log.at("_aside", f"{uuid.uuid4().hex}.parquet")
        log.fs.create_dir(log.at("_aside"), recursive=True)
        self.sink = log.fs.open_output_stream(self.file)
        self.out = pq.ParquetWriter(self.sink, _FILES)
        self.rows = self.size = 0
        self.keys: list[str | None] = []
        self.values: list[str | None] = []

    def add(self, key: str | None, value: str | None) -> None:
        self.keys.append(key)
        self.values.append(value)
        self.rows += 1
        self.size += len(key or "") + len(value or "") + 100  # of Python's own for a row
        if self.size >= GROUP_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.values:
            self.out.write_table(pa.table([pa.array(self.keys, pa.string()), pa.array(self.values, pa.string())], schema=_FILES))
            self.keys, self.values, self.size = [], [], 0

    def close(self) -> str:
        self._flush()
        self.out.close()
        self.sink.close()
        return self.file


@dataclass
class Written(WriterCommitMessage):
    """Segments that a task has written aside: (partition, file, rows)."""
    segments: list


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.names = options["path"], schema.fieldNames()
        self.count = int(options.get("partitions", PARTITIONS))
        if "value" not in self.names:
            raise ValueError("a topic takes rows with a column value")
        if not Log(self.path).partitions():
            Log(self.path).create(self.count)
        self.partitions = Log(self.path).partitions()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows go to the open segment of their partition a few megabytes at a time."""
        log, turn = Log(self.path), 0
        held: dict[int, _Segment] = {}
        done = []

        def close(p: int) -> None:
            segment = held.pop(p)
            done.append((p, segment.close(), segment.rows))

        for batch in iterator:
            values = batch.column(self.names.index("value")).to_pylist()
            keys = batch.column(self.names.index("key")).to_pylist() if "key" in self.names else [None] * len(values)
            for key, value in zip(keys, values):
                turn += 1
                at = turn if key is None else zlib.crc32(key.encode())
                p = self.partitions[at % len(self.partitions)]
                if p not in held:
                    held[p] = _Segment(log)
                held[p].add(key, value)
                if held[p].rows >= SEGMENT_ROWS:
                    close(p)
        for p in list(held):
            close(p)
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        log = Log(self.path)
        lock = log.at("_lock")
        if log.fs.get_file_info(lock).type != pafs.FileType.NotFound:
            raise RuntimeError(f"another writer holds {lock}")
        log.fs.open_output_stream(lock).close()
        try:
            nexts = {p: b for p, (_, b) in log.ends().items()}
            for message in messages:
                for p, aside, rows in message.segments if message else ():
                    log.fs.move(aside, log.file(p, nexts[p], nexts[p] + rows))
                    nexts[p] += rows
        finally:
            log.fs.delete_file(lock)

    def abort(self, messages: list[Written | None]) -> None:
        log = Log(self.path)
        for message in messages:
            for _, aside, _ in message.segments if message else ():
                log.fs.delete_file(aside)


class FolderTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options)

    def streamReader(self, schema: StructType) -> _StreamReader:
        return _StreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options, schema)


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(FolderTopic)


def write_topic(records: DataFrame, path: str, partitions: int = PARTITIONS) -> None:
    """Appends rows ``value`` (and ``key``) to the topic; a new one gets ``partitions`` partitions."""
    _registered(records.sparkSession)
    columns = [c for c in ("key", "value") if c in records.columns]
    records.select(*columns).write.format(NAME).option("partitions", partitions).mode("append").save(path)


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """All messages with their partition and offset."""
    _registered(spark)
    return spark.read.format(NAME).load(path)


def stream_topic(spark: SparkSession, path: str, subscription: str | None = None, starting: str = "earliest",
                 most: int | None = None) -> DataFrame:
    """Messages as they come; non-blank ``value`` as the other sources give it, with partition and offset."""
    _registered(spark)
    reader = spark.readStream.format(NAME).option("startingOffsets", starting)
    if subscription:
        reader = reader.option("subscription", subscription)
    if most:
        reader = reader.option("maxOffsetsPerTrigger", most)
    return reader.load(path).where("trim(value) <> ''")


def expire(path: str) -> int:
    """Deletes the segments that every named subscription has read; how many those were."""
    return Log(path).expire()

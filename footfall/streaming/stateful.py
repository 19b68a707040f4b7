"""Silver and Gold as chained stateful operators: the state is the table.

The form in ``jobs`` keeps stored tables and looks older rows up in them. Here each operator
keeps what it needs in its state store and passes on *changes*; nothing reads Silver
or lists a log:

* ``BestDetection`` holds the winning row of each detection. A better copy leaves as two
  rows, the old winner taken back (``change`` -1) and the new one (+1).
* ``CountDistinct`` holds, per group, how many rows each track has in it (a map). A row taken
  back lowers its track's count; a track at zero is no longer counted. So the distinct count
  is exact under revisions.
* ``PartOfVisit`` holds how often each capture time occurs in one hour of a visit (track and zone) and
  passes on the hour's first and last time when they change; ``Visit`` holds those of its hours
  and passes on the change of the whole stay; ``ZoneSum`` adds the changes up. A trackless visit
  may hold a large share of all rows: its hours are keys of their own, so no task takes it whole.

The chain runs in one query, in append mode, so all operators move in the same micro-batch. Rows of the
result carry a ``version`` that grows with every change of their group; ``latest`` gives the newest
of each group, and leaves out groups that have become empty.

**Bounds.** State grows with the number of live keys. With ``late`` rows are bounded in time: a row that
is older than the newest capture time by more than ``late`` is dropped, and what no accepted row can
change any more is forgotten: detections, minutes and hours as a whole; a visit keeps its first and
last time alone. Copies of one detection whose capture times lie further apart than ``late`` then
count apart. Without ``late`` nothing is ever dropped or forgotten.

Keys are many and small, so the state store holds them in blocks (``blocks``): frames, minutes, an hour's
visits, or tracks of one camera that lie together are one value, read and written once in a micro-batch.

Losers among copies of one detection are dropped before the shuffle, batch by batch, so many copies
of one detection do not travel to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from footfall.functions.cleaning import seconds_between, trunc_to
from footfall.operators import gold as g
from footfall.operators import silver as s
from footfall.schemas import columns_of, struct_of, table_schema
from footfall.session import carry_to_workers
from footfall.streaming.blocks import in_blocks

carry_to_workers(__name__)

CHANGE = "change"
VERSION = "version"
GROUP = [*g.CAMERA, "ts_minute"]
VISIT = [*g.ZONE, "track_id"]
PART = [*VISIT, "ts_hour"]
SECOND = 1_000_000  # times travel as microseconds

CHANGES = """store_id string, camera_id string, ts_minute timestamp_ntz,
    detections bigint, unique_people bigint, version bigint"""
PARTS = """store_id string, camera_id string, zone_x int, zone_y int, track_id bigint, ts_hour timestamp_ntz,
    first bigint, last bigint, seen timestamp"""
STAYS = """store_id string, camera_id string, zone_x int, zone_y int, visits bigint, seconds bigint, seen timestamp"""
SUMS = """store_id string, camera_id string, zone_x int, zone_y int, visits bigint,
    total_dwell_seconds double, avg_dwell_seconds double, version bigint"""
EVENT = "seen"  # event time of the rows between operators

# Keys of a camera that are kept in one value of the state store (``blocks``).
FRAMES = 10   # detections of 2^10 frames
MINUTES = 10  # counts of ten minutes
SPREAD = 8    # an eighth of the visits of an hour
TRACKS = 10   # stays of 2^10 track numbers in one zone


def _order(row: Row | dict, rank: list[str]) -> tuple:
    """Larger is better; a missing value is worse than any other."""
    return tuple((row[c] is not None, row[c]) if row[c] is not None else (False,) for c in rank)


class _Forgetting(StatefulProcessor):
    """An operator whose state of a key ends with a timer, ``late`` milliseconds and the length of the
    key's span of time behind its newest row. ``late`` None keeps it for ever."""

    late: int | None = None
    span_ms = 0

    def keep_until(self, newest_ms: int) -> None:
        if self.late is None:
            return
        end = newest_ms + self.late + self.span_ms
        for timer in list(self.handle.listTimers()):
            if timer >= end:
                return
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.forget()
        return iter(())

    def forget(self) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _row(ddl: str, *values) -> Row:
    return Row(**{part.split()[0]: value for part, value in zip(ddl.split(","), values)})


def _millis(rows: list) -> int:
    return max(int(r[EVENT].timestamp() * 1000) for r in rows)


class BestDetection(_Forgetting):
    """The best row of a detection; a new winner takes the old one back."""

    def __init__(self, schema: StructType, rank: list[str], late: int | None):
        self.schema, self.rank, self.late = schema, rank, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)
        names = self.schema.fieldNames()
        new = (rows[0] if len(rows) == 1 else max(rows, key=lambda r: _order(r, self.rank))).asDict()
        old = self.best.get()
        self.keep_until(_millis(rows))
        if old is not None:
            old = dict(zip(names, old))
            if _order(new, self.rank) <= _order(old, self.rank):
                return
            yield Row(**{**old, EVENT: new[EVENT]}, change=-1)  # the time of the change, which is not late
        self.best.update(tuple(new[c] for c in names))
        yield Row(**{c: new[c] for c in names}, change=1)

    def forget(self) -> None:
        self.best.clear()


class CountDistinct(_Forgetting):
    """Rows and distinct tracks of a minute, with the group's key in front of the result."""

    span_ms = 60_000

    def __init__(self, late: int | None):
        self.late = late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracks = handle.getMapState("tracks", "track_id bigint", "rows bigint")
        self.total = handle.getValueState("total", "rows bigint, tracks bigint, version bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        delta: dict[int, int] = {}
        rows = list(rows)
        for r in rows:
            delta[r["track_id"]] = delta.get(r["track_id"], 0) + r[CHANGE]
        total, distinct, version = self.total.get() or (0, 0, 0)
        for track, change in delta.items():
            if not change:
                continue
            held = self.tracks.getValue((track,)) if self.tracks.containsKey((track,)) else (0,)
            now = held[0] + change
            distinct += (now > 0) - (held[0] > 0)
            total += change
            if now:
                self.tracks.updateValue((track,), (now,))
            else:
                self.tracks.removeKey((track,))
        self.total.update((total, distinct, version + 1))
        self.keep_until(_millis(rows))
        yield _row(CHANGES, *key, total, distinct, version + 1)

    def forget(self) -> None:
        self.tracks.clear()
        self.total.clear()


class PartOfVisit(_Forgetting):
    """First and last capture time of an hour of a visit; both None once it has no row left."""

    span_ms = 3_600_000

    def __init__(self, late: int | None):
        self.late = late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getMapState("times", "at bigint", "rows bigint")
        self.span = handle.getValueState("span", "first bigint, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        delta: dict[int, int] = {}
        rows = list(rows)
        for r in rows:
            delta[r["at"]] = delta.get(r["at"], 0) + r[CHANGE]
        old = self.span.get()
        first, last = old or (None, None)
        gone = False
        for at, change in delta.items():
            if not change:
                continue
            held = self.times.getValue((at,)) if self.times.containsKey((at,)) else (0,)
            if held[0] + change:
                self.times.updateValue((at,), (held[0] + change,))
                first = at if first is None else min(first, at)
                last = at if last is None else max(last, at)
            else:
                self.times.removeKey((at,))
                gone = gone or at in (first, last)
        if gone:  # an end of the span has been taken back: the next one is in the map
            first = last = None
            for (at,) in self.times.keys():
                first = at if first is None else min(first, at)
                last = at if last is None else max(last, at)
        self.keep_until(_millis(rows))
        if (first, last) == (tuple(old) if old else (None, None)):
            return
        if first is None:
            self.span.clear()
        else:
            self.span.update((first, last))
        yield _row(PARTS, *key, first, last, max(r[EVENT] for r in rows))

    def forget(self) -> None:
        self.times.clear()
        self.span.clear()


def _join(spans) -> tuple[int | None, int | None]:
    spans = [span for span in spans if span is not None]
    return min((a for a, _ in spans), default=None), max((b for _, b in spans), default=None)


class Visit(_Forgetting):
    """Changes of a whole stay: visits gained or lost and seconds gained or lost. Hours that can no
    longer change are folded into one span."""

    span_ms = 3_600_000

    def __init__(self, late: int | None):
        self.late = late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hours = handle.getMapState("hours", "hour bigint", "first bigint, last bigint")
        self.span = handle.getValueState("span", "first bigint, last bigint")
        self.closed = handle.getValueState("closed", "first bigint, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)
        old = self.span.get() or (None, None)
        new, again = old, False
        for r in rows:
            hour = (int(r["ts_hour"].timestamp()),)
            before = self.hours.getValue(hour) if self.hours.containsKey(hour) else None
            # A span that had an end in this hour may have shrunk.
            again = again or (before is not None and (before[0] == old[0] or before[1] == old[1]))
            if r["first"] is None:
                if before is not None:
                    self.hours.removeKey(hour)
            else:
                self.hours.updateValue(hour, (r["first"], r["last"]))
                new = _join([new if new[0] is not None else None, (r["first"], r["last"])])
        if again:
            new = _join([self.closed.get(), *self.hours.values()])
        self.keep_until(_millis(rows))
        stay = lambda span: 0 if span[0] is None else (span[1] - span[0]) // SECOND
        visits = int(new[0] is not None) - int(old[0] is not None)
        if new[0] is None:
            self.span.clear()
        else:
            self.span.update(new)
        if visits or stay(new) != stay(old):
            yield _row(STAYS, *key[:-1], visits, stay(new) - stay(old), max(r[EVENT] for r in rows))

    def forget(self) -> None:
        closed = _join([self.closed.get(), *self.hours.values()])
        self.hours.clear()
        if closed[0] is not None:
            self.closed.update(closed)


class ZoneSum(_Forgetting):
    """Visits and dwell of a zone. There are as many zones as cameras have cells, so the sums are kept."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "visits bigint, seconds bigint, version bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        visits, seconds, version = self.sums.get() or (0, 0, 0)
        for r in rows:
            visits, seconds = visits + r["visits"], seconds + r["seconds"]
        self.sums.update((visits, seconds, version + 1))
        yield _row(SUMS, *key, visits, float(seconds), seconds / visits if visits else None, version + 1)


# ------------------------------------------------------------------ the chain


def _local_best(key: list[str], rank: list[str]):
    """Drops, within a batch, copies that another copy of the same detection beats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                order = [(c, "ascending") for c in key] + [(c, "descending") for c in rank]
                at = pc.sort_indices(table, sort_keys=order, null_placement="at_end")
                table = table.take(at)
                new = None
                for c in key:
                    column = table[c].combine_chunks()
                    other = pc.not_equal(column[1:], column[:-1])
                    new = other if new is None else pc.or_(new, other)
                first = pa.concat_arrays([pa.array([True]), new.combine_chunks() if isinstance(new, pa.ChunkedArray) else new])
                yield from table.filter(first).combine_chunks().to_batches()
    return run


def _stateful(rows: DataFrame, block: list[str], part: Column, key: list[str], processor: StatefulProcessor,
              schema: StructType | str, late: int | None) -> DataFrame:
    schema = struct_of(schema) if isinstance(schema, str) else schema
    time = {} if late is None else {"eventTimeColumnName": EVENT} if EVENT in schema.fieldNames() else {}
    return in_blocks(rows, block, part, key, processor, schema, timeMode="none" if late is None else "eventTime", **time)


def _late_ms(late: str | None) -> int | None:
    if late is None:
        return None
    amount, unit = late.split()
    scale = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]
    return int(amount) * scale


def detection_changes(bronze: DataFrame, now: Column | None = None, late: str | None = None) -> DataFrame:
    """Clean detections of streamed Bronze rows as changes: each new winner +1, the one it replaces -1."""
    rows = s.silver_rows(bronze, now).withColumn("processing_ts", F.current_timestamp() if now is None else now)
    rows = rows.select(*columns_of("silver_detections"), F.to_timestamp_ltz(F.col("capture_ts")).alias(EVENT))
    rank = _rank(rows.columns)
    rows = rows.mapInArrow(_local_best(s.DEDUP_KEY, rank), rows.schema)
    if late is not None:
        rows = rows.withWatermark(EVENT, late)
    schema = StructType(rows.schema.fields)
    out = StructType([*schema.fields, *struct_of(f"{CHANGE} int").fields])
    frames = F.shiftright("frame_index", FRAMES)
    return _stateful(rows, g.CAMERA, frames, s.DEDUP_KEY, BestDetection(schema, rank, _late_ms(late)), out, _late_ms(late))


def _rank(columns: list[str]) -> list[str]:
    lead = ["conf", "capture_ts"]
    return lead + [c for c in columns if c not in lead and c not in s.DEDUP_KEY and c not in ("processing_ts", EVENT)]


def people_changes(changes: DataFrame, late: str | None = None) -> DataFrame:
    """``gold_people_per_minute`` with versions, from changes of detections."""
    rows = changes.withColumn("ts_minute", trunc_to("minute", "capture_ts")).select(*GROUP, "track_id", CHANGE, EVENT)
    minutes = F.floor(F.unix_seconds(F.to_timestamp_ltz(F.col("ts_minute"))) / (60 * MINUTES))
    return _stateful(rows, g.CAMERA, minutes, GROUP, CountDistinct(_late_ms(late)), CHANGES, _late_ms(late))


def dwell_changes(changes: DataFrame, late: str | None = None) -> DataFrame:
    """``gold_zone_dwell`` with versions, from changes of detections."""
    ms = _late_ms(late)
    rows = g.with_zone(changes).withColumns({
        "ts_hour": trunc_to("hour", "capture_ts"),
        "at": F.unix_micros(F.to_timestamp_ltz(F.col("capture_ts")))})
    rows = rows.select(*PART, "at", CHANGE, EVENT)
    spread = F.pmod(F.xxhash64("zone_x", "zone_y", "track_id"), F.lit(SPREAD))
    parts = _stateful(rows, [*g.CAMERA, "ts_hour"], spread, PART, PartOfVisit(ms), PARTS, ms)
    stays = _stateful(parts, g.ZONE, F.shiftright("track_id", TRACKS), VISIT, Visit(ms), STAYS, ms)
    return _stateful(stays, g.ZONE, F.lit(0), g.ZONE, ZoneSum(), SUMS, ms)


def start_changes(changes: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends the changes to a folder, each once."""
    writer = changes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def latest(versions: DataFrame, key: list[str], count: str) -> DataFrame:
    """The newest version of each group that is not empty."""
    rest = [c for c in versions.columns if c not in [*key, VERSION]]
    newest = versions.groupBy(*key).agg(F.max_by(F.struct(*rest), VERSION).alias("row"))
    return newest.select(*key, "row.*").where(F.col(count) > 0)


def winners(changes: DataFrame) -> DataFrame:
    """The detections that hold, from all changes: those added and not taken back."""
    columns = [c for c in columns_of("silver_detections")]
    return changes.groupBy(*columns).agg(F.sum(CHANGE).alias(CHANGE)).where(F.col(CHANGE) > 0).drop(CHANGE)

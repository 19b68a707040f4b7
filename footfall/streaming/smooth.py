"""Smoothing of live boxes with one small state per track, those of neighbouring tracks in one value (``blocks``).

``smooth_stream`` answers at once: a row that arrives in a later batch is blended with the
newest state, wherever it belongs. ``smooth_in_order`` waits for the watermark: rows are held
until nothing older can arrive and then smoothed in their order, so the result is that of the
batch operator however the rows were dealt to batches. Rows later than the watermark allows
are dropped (``numRowsDroppedByWatermark`` of the query's progress counts them).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from footfall.functions.ema import ALPHA, MIN_IOU, smooth
from footfall.operators.geometry import BOX, clip_bbox
from footfall.session import carry_to_workers
from footfall.streaming.blocks import in_blocks

carry_to_workers(__name__, "footfall.functions.ema")

_STATE = StructType([StructField(c, DoubleType()) for c in BOX])


TRACKS = 16  # track numbers whose states are kept together (``blocks``)


def _place(row: dict, order: list[str]) -> list[tuple]:
    """Sort key of a row; a missing value comes first."""
    return [(row[c] is not None, row[c] if row[c] is not None else 0) for c in order]


class SmoothTrack(StatefulProcessor):
    """Keeps the last smoothed box of a track.

    Rows of a micro-batch are put in order; a row that arrives in a later batch
    is blended with the newest state even if it belongs earlier.
    """

    def __init__(self, columns: list[str], order: list[str], alpha: float, min_iou: float):
        self.columns, self.order, self.alpha, self.min_iou = columns, order, alpha, min_iou

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch = sorted((r.asDict() for r in rows), key=lambda r: _place(r, self.order))
        state = self.last.get()
        boxes = (tuple(r[c] for c in BOX) for r in batch)
        for row, box in zip(batch, smooth(boxes, state and tuple(state), self.alpha, self.min_iou)):
            row.update(zip(BOX, box))
            yield Row(**{c: row[c] for c in self.columns})
        self.last.update(box)

    def close(self) -> None:
        pass


class SmoothInOrder(StatefulProcessor):
    """Holds a track's rows until the watermark has passed them, then smooths them in order.

    A timer stands at the oldest held row. When it fires, all rows that the watermark has
    passed are released; the next timer stands at the oldest one left. ``idle_ms`` after its last row
    a track is forgotten; if it comes back, it starts anew. None never forgets a track.
    """

    def __init__(self, columns: list[str], schema: StructType, time: str, order: list[str], alpha: float, min_iou: float,
                 idle_ms: int | None):
        self.columns, self.schema, self.time = columns, schema, time
        self.order, self.alpha, self.min_iou, self.idle_ms = order, alpha, min_iou, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)
        self.last = handle.getValueState("last", StructType([*_STATE.fields, StructField("at", LongType())]))
        self.due = handle.getValueState("due", "at bigint")

    def _millis(self, row) -> int:
        return int(row[self.time].timestamp() * 1000)

    def _wake(self, at: int) -> None:
        due = self.due.get()
        if due is None or at < due[0]:
            self.due.update((at,))
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.schema.fieldNames()
        new = [tuple(map(r.asDict().__getitem__, names)) for r in rows]
        self.held.appendList(new)
        time = names.index(self.time)
        self._wake(min(int(r[time].timestamp() * 1000) for r in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        names = self.schema.fieldNames()
        rows = [dict(zip(names, r)) for r in self.held.get()] if self.held.exists() else []
        ready = [r for r in rows if self._millis(r) <= passed]
        rest = [r for r in rows if self._millis(r) > passed]
        self.due.clear()
        if ready:
            ready.sort(key=lambda r: _place(r, [self.time, *self.order]))
            last = self.last.get()
            boxes = smooth((tuple(r[c] for c in BOX) for r in ready), last and tuple(last)[:4], self.alpha, self.min_iou)
            for row, box in zip(ready, boxes):
                row.update(zip(BOX, box))
                yield Row(**{c: row[c] for c in self.columns})
            self.last.update((*box, self._millis(ready[-1])))
            if rest:
                self.held.put([tuple(r[c] for c in names) for r in rest])
            else:
                self.held.clear()
        if rest:
            self._wake(min(map(self._millis, rest)))
        elif self.idle_ms is not None and self.last.exists():
            end = self.last.get()[4] + self.idle_ms
            if end < passed:
                self.last.clear()
            else:
                self._wake(end)

    def close(self) -> None:
        pass


def smooth_in_order(
    boxes: DataFrame, track_key: list[str], time: str, order: list[str], late: str,
    alpha: float = ALPHA, min_iou: float = MIN_IOU, idle_ms: int | None = None,
) -> DataFrame:
    """Streaming boxes smoothed along (``time``, ``order``), rows up to ``late`` behind the newest one taken
    at their place. Rows without a track or a time are clipped alone; rows without a box keep none. The last
    rows of a track come out once later rows of any track (or frames without boxes) have moved the watermark."""
    columns = boxes.columns
    clipped = clip_bbox(boxes)
    follows = F.coalesce(F.col(track_key[-1]) >= 0, F.lit(False)) & F.col(time).isNotNull()
    for c in [*track_key, *BOX]:
        follows = follows & F.col(c).isNotNull()
    event = "_event"
    marked = clipped.withColumn(event, F.to_timestamp_ltz(F.col(time))).withWatermark(event, late)
    # One condition that names the event time stays above the watermark, which so sees all rows.
    tracked = marked.where(F.when(F.col(event).isNotNull(), follows).otherwise(F.lit(False)))
    processor = SmoothInOrder(columns, tracked.schema, event, order, alpha, min_iou, idle_ms)
    part = F.floor(F.col(track_key[-1]) / TRACKS)
    smoothed = in_blocks(tracked, track_key[:-1], part, track_key, processor, clipped.schema, timeMode="eventTime")
    return smoothed.unionByName(clipped.where(~follows))


def smooth_stream(
    boxes: DataFrame, track_key: list[str], order: list[str],
    alpha: float = ALPHA, min_iou: float = MIN_IOU,
) -> DataFrame:
    """Streaming boxes clipped and smoothed; rows without a track are clipped alone, rows without a
    box keep none."""
    clipped = clip_bbox(boxes)
    has_track = F.coalesce(F.col(track_key[-1]) >= 0, F.lit(False))
    for c in BOX:
        has_track = has_track & F.col(c).isNotNull()
    tracked = clipped.where(has_track)
    processor = SmoothTrack(tracked.columns, order, alpha, min_iou)
    part = F.floor(F.col(track_key[-1]) / TRACKS)
    smoothed = in_blocks(tracked, track_key[:-1], part, track_key, processor, tracked.schema, timeMode="none")
    return smoothed.unionByName(clipped.where(~has_track))


def start_smooth(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()

"""Chained stateful operators: equal to batch under revisions, bounded with a watermark."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from footfall.functions.geometry import BOX
from footfall.operators import gold as g
from footfall.operators.bronze import bronze_ingest
from footfall.operators.silver import silver_stream
from footfall.operators.smoothing import smooth_bbox
from footfall.schemas import columns_of
from footfall.session import shared_dir
from footfall.sources.frames import stream_jsonl
from footfall.streaming import stateful as S
from footfall.streaming.smooth import smooth_in_order, smooth_stream, start_smooth
from tests.test_streaming import WAVES, frame, lines, now, rows, tiny_data  # noqa: F401


class Cell:
    """State of one key, in memory."""

    def __init__(self):
        self.held = {}

    def get(self):
        return self.held.get("v")

    def exists(self):
        return bool(self.held)

    def update(self, value):
        self.held["v"] = value

    def clear(self):
        self.held.clear()

    def getValue(self, key):
        return self.held[key]

    def containsKey(self, key):
        return key in self.held

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]

    def keys(self):
        return iter(list(self.held))

    def values(self):
        return iter(list(self.held.values()))


class Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, *_):
        return Cell()

    getMapState = getValueState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def listTimers(self):
        return iter(sorted(self.timers))


class Keyed:
    """One processor for each key, as the engine keeps them apart."""

    def __init__(self, make):
        self.make, self.of = make, {}

    def feed(self, key, batch):
        if key not in self.of:
            self.of[key] = self.make()
            self.of[key].init(Handle())
        return list(self.of[key].handleInputRows(key, iter(batch), None))


START = dt.datetime(2025, 1, 1, 10)
detections = st.lists(st.lists(st.tuples(
    st.integers(0, 5), st.integers(0, 3 * 3600), st.integers(0, 2), st.integers(0, 9)), min_size=1, max_size=8),
    min_size=1, max_size=6)


@given(detections)
@settings(max_examples=200, deadline=None)
def test_processors_follow_every_revision(batches):
    """Copies of six detections, each with a time, a track and a confidence, in several batches."""
    names = ["det_id", "conf", "capture_ts", "track_id", S.EVENT]
    schema = type("Schema", (), {"fieldNames": lambda self: names})()
    best = Keyed(lambda: S.BestDetection(schema, ["conf", "capture_ts", "track_id"], None))
    count = Keyed(lambda: S.CountDistinct(None))
    part, visit, zone = Keyed(lambda: S.PartOfVisit(None)), Keyed(lambda: S.Visit(None)), Keyed(S.ZoneSum)
    seen, counted, summed = {}, {}, None
    for batch in batches:
        by_det = defaultdict(list)
        for det, second, track, conf in batch:
            at = START + dt.timedelta(seconds=second)
            by_det[det].append(Row(det_id=det, conf=conf, capture_ts=at, track_id=track, seen=at))
            new = (conf, at, track)
            seen[det] = max(seen.get(det, new), new)
        changes = [r for det, own in by_det.items() for r in best.feed((det,), own)]
        groups, parts = defaultdict(list), defaultdict(list)
        for r in changes:
            minute, hour = r.capture_ts.replace(second=0), r.capture_ts.replace(second=0, minute=0)
            groups[minute].append(r)
            parts[r.track_id, hour].append(Row(at=int(r.capture_ts.timestamp() * S.SECOND), change=r.change, seen=r.seen))
        for minute, own in groups.items():
            for out in count.feed(("s", "c", minute), own):
                counted[minute] = (out.detections, out.unique_people)
        spans = defaultdict(list)
        for (track, hour), own in parts.items():
            for out in part.feed(("s", "c", 0, 0, track, hour), own):
                spans[track].append(out)
        stays = [out for track, own in spans.items() for out in visit.feed(("s", "c", 0, 0, track), own)]
        if stays:
            (summed,) = zone.feed(("s", "c", 0, 0), stays)
    minutes, tracks, times = Counter(), defaultdict(set), defaultdict(list)
    for _, at, track in seen.values():
        minutes[at.replace(second=0)] += 1
        tracks[at.replace(second=0)].add(track)
        times[track].append(at)
    assert {m: c for m, c in counted.items() if c[0]} == {m: (n, len(tracks[m])) for m, n in minutes.items()}
    dwell = sum(int((max(t) - min(t)).total_seconds()) for t in times.values())
    assert (summed.visits, summed.total_dwell_seconds) == (len(times), dwell)


def test_closed_hours_are_one_span():
    visit = S.Visit(1000)
    visit.init(Handle())
    key = ("s", "c", 0, 0, 1)
    row = lambda hour, first, last: Row(
        ts_hour=START + dt.timedelta(hours=hour), first=first, last=last, seen=START + dt.timedelta(hours=hour))
    list(visit.handleInputRows(key, [row(0, 10 * S.SECOND, 20 * S.SECOND)], None))
    list(visit.handleExpiredTimer(key, None, None))
    assert not visit.hours.held and visit.closed.get() == (10 * S.SECOND, 20 * S.SECOND)
    (out,) = visit.handleInputRows(key, [row(1, 3700 * S.SECOND, 3705 * S.SECOND)], None)
    assert (out.visits, out.seconds) == (0, 3685)
    (out,) = visit.handleInputRows(key, [row(1, None, None)], None)  # the second hour is taken back
    assert (out.visits, out.seconds) == (0, -3685)


def run(spark, texts, landing, out, further, late=None):
    if texts:
        lines(spark, texts).write.mode("append").text(landing)
    changes = S.detection_changes(bronze_ingest(stream_jsonl(spark, landing), now()), now(), late)
    query = S.start_changes(further(changes), f"{out}/rows", f"{out}/checkpoint")
    query.awaitTermination()
    return query


def test_chains_end_like_batch(spark):
    """Later waves move detections to other minutes, zones and tracks."""
    silver = silver_stream(bronze_ingest(lines(spark, sum(WAVES, [])), now()), now()).cache()
    chains = {
        "winners": (lambda c: c, S.winners, silver, [c for c in columns_of("silver_detections") if c != "processing_ts"]),
        "people": (S.people_changes, lambda v: S.latest(v, S.GROUP, "detections"), g.gold_people_per_minute(silver),
                   columns_of("gold_people_per_minute")),
        "dwell": (S.dwell_changes, lambda v: S.latest(v, g.ZONE, "visits"), g.gold_zone_dwell(silver), columns_of("gold_zone_dwell")),
    }
    for further, result, expected, columns in chains.values():
        landing, out = shared_dir(spark, "t-land"), shared_dir(spark, "t-state")
        for wave in WAVES:
            run(spark, wave, landing, out, further)
        assert rows(result(spark.read.parquet(f"{out}/rows")), columns) == rows(expected, columns)


def test_state_does_not_grow_with_a_bound(spark):
    """Six waves, eight minutes apart, in any order within. What is behind the bound is dropped and forgotten."""
    landing, out = shared_dir(spark, "t-land"), shared_dir(spark, "t-state")
    texts, held = [], []
    for turn in range(6):
        wave = [frame(100 * turn + i, 480 * turn + 10 * i, [(0, 0.9, i, 20.0 * i)]) for i in (1, 0, 3, 2, 4)]
        texts += wave
        late = [frame(7000 + turn, 480 * (turn - 2), [(0, 0.9, 77, 5.0)])] if turn > 1 else []
        query = run(spark, wave + late, landing, out, lambda c: S.people_changes(c, "20 seconds"), "20 seconds")
        held.append([op["numRowsTotal"] for op in query.lastProgress["stateOperators"]])
    assert all(max(x) <= 2 * max(held[1]) for x in held[1:]), held
    silver = silver_stream(bronze_ingest(lines(spark, texts), now()), now())
    columns = columns_of("gold_people_per_minute")
    found = rows(S.latest(spark.read.parquet(f"{out}/rows"), S.GROUP, "detections"), columns)
    assert found == rows(g.gold_people_per_minute(silver), columns)


TRACK = ["camera_id", "track_id"]


def boxes(spark, values):
    return spark.createDataFrame(values, "camera_id string, track_id long, fr long, at timestamp_ntz, det_id string, "
                                         "img_w int, img_h int, x1 double, y1 double, x2 double, y2 double")


def box(fr, track=1, x=10.0, tag="", **other):
    row = {"camera_id": "c", "track_id": track, "fr": fr, "at": START + dt.timedelta(seconds=fr), "det_id": f"{fr}-{track}{tag}",
           "img_w": 1280, "img_h": 720, "x1": x + fr, "y1": 10.0, "x2": x + fr + 50, "y2": 100.0}
    return tuple({**row, **other}.values())


def smoothed(spark, waves, make):
    landing, out = shared_dir(spark, "t-boxes"), shared_dir(spark, "t-smooth")
    for wave in waves:
        df = boxes(spark, wave).coalesce(1)
        df.write.mode("append").parquet(landing)
        query = start_smooth(make(spark.readStream.schema(df.schema).parquet(landing)), f"{out}/rows", f"{out}/checkpoint")
        query.awaitTermination()
    return spark.read.parquet(f"{out}/rows"), query


WHOLE = ["det_id", *BOX]


def test_rows_out_of_order_are_smoothed_in_order(spark):
    values = [box(fr, track, x=10.0 * track) for fr in range(12) for track in (1, 2)]
    odd = [box(3, 1, tag="n", x1=None), box(4, None, tag="u"), box(5, -1, tag="u"), box(6, 1, tag="t", at=None),
           box(7, 2, tag="w", img_w=None)]
    order = [values[i] for i in (3, 0, 7, 1, 9, 2, 5, 4, 8, 6)] + odd
    beats = [box(100, None, tag="b"), box(101, None, tag="b")]
    waves = [order, values[:9:-1], beats[:1], beats[1:]]
    make = lambda s: smooth_in_order(s, TRACK, "at", ["fr"], "30 seconds")
    found, _ = smoothed(spark, waves, make)
    timeless = {"6-1t"}  # a box without a time is clipped alone
    batch = boxes(spark, values + [o for o in odd if o[4] not in timeless] + beats)
    expected = smooth_bbox(batch, TRACK, ["fr", "det_id"])
    assert rows(found.where("det_id <> '6-1t'"), WHOLE) == rows(expected, WHOLE)
    assert rows(found.where("det_id = '6-1t'"), BOX) == [(16.0, 10.0, 66.0, 100.0)]
    assert found.where("det_id in ('3-1n', '7-2w') and (x1 is not null or x2 is not null)").count() == 0


def test_idle_tracks_leave_the_state(spark):
    waves = [[box(60 * k, track=k)] for k in range(6)] + [[box(1000, None)], [box(1001, None)]]
    make = lambda s: smooth_in_order(s, TRACK, "at", ["fr"], "10 seconds", idle_ms=30_000)
    found, query = smoothed(spark, waves, make)
    assert found.count() == 8
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_live_smoothing_keeps_missing_boxes_missing(spark):
    unplaced = box(4, tag="f")
    wave = [box(1), box(2, x1=None, tag="n"), box(3), (*unplaced[:2], None, *unplaced[3:])]
    found, _ = smoothed(spark, [wave], lambda s: smooth_stream(s, TRACK, ["fr"]))
    assert found.count() == 4 and rows(found.where("det_id = '2-1n'"), BOX) == [(None,) * 4]

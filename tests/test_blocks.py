"""Keys kept in blocks: the operator's results, with one value read and written for a block."""

import datetime as dt
from collections import defaultdict
from types import SimpleNamespace

from pyspark.sql import Row

from footfall.functions.geometry import BOX
from footfall.streaming import stateful as S
from footfall.streaming.blocks import Blocks
from footfall.streaming.smooth import SmoothInOrder

START = dt.datetime(2025, 1, 1, 10)


class Store:
    """The engine's handle for one block; counts what goes to the state store."""

    def __init__(self):
        self.value, self.timers, self.messages = None, set(), 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.messages += 1
        return self.value

    def update(self, value):
        self.messages += 1
        self.value = value

    def clear(self):
        self.messages += 1
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def block_of(inner, key):
    block, store = Blocks(inner, key), Store()
    block.init(store)
    return block, store


def fire(block, store, watermark):
    out = []
    for at in sorted(t for t in store.timers if t < watermark):
        out += block.handleExpiredTimer(None, SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark),
                                        SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
        store.timers.discard(at)
    return out


def test_many_keys_cost_one_read_and_one_write():
    block, store = block_of(S.CountDistinct(None), S.GROUP)
    rows = [Row(store_id="s", camera_id=None, ts_minute=START + dt.timedelta(minutes=i % 10), track_id=i % 7, change=1, seen=START)
            for i in range(1000)]
    want = defaultdict(lambda: [0, set()])
    for r in rows:
        want[r.ts_minute][0] += 1
        want[r.ts_minute][1].add(r.track_id)
    for turn in (1, 2):
        store.messages = 0
        found = {r.ts_minute: (r.detections, r.unique_people, r.version) for r in block.handleInputRows(None, iter(rows), None)}
        assert found == {m: (turn * n, len(tracks), turn) for m, (n, tracks) in want.items()}
        assert store.messages == 2


def test_a_block_without_keys_leaves_the_store():
    block, store = block_of(S.CountDistinct(1000), S.GROUP)
    at = lambda second: START + dt.timedelta(seconds=second)
    ms = lambda second: int(at(second).timestamp() * 1000)
    rows = [Row(store_id="s", camera_id="c", ts_minute=at(60 * i), track_id=1, change=1, seen=at(60 * i)) for i in range(3)]
    list(block.handleInputRows(None, iter(rows), None))
    assert store.timers == {ms(61)}  # one timer for three minutes, the earliest one
    assert fire(block, store, ms(100)) == [] and store.timers == {ms(121)}
    fire(block, store, ms(1000))
    assert store.value is None and not store.timers


def test_held_rows_of_many_tracks_come_out_in_order():
    names = ["track_id", "at", "fr", *BOX]
    schema = type("Schema", (), {"fieldNames": lambda self: names})()
    block, store = block_of(SmoothInOrder(names, schema, "at", ["fr"], 0.5, 0.1, None), ["track_id"])
    rows = [Row(track_id=t, at=START + dt.timedelta(seconds=i), fr=i, x1=float(i), y1=0.0, x2=i + 50.0, y2=50.0)
            for i in (3, 1, 0, 2) for t in (1, 2)]
    assert list(block.handleInputRows(None, iter(rows), None)) == []
    out = fire(block, store, int((START.timestamp() + 2.5) * 1000))
    for t in (1, 2):
        assert [(r.fr, r.x1) for r in out if r.track_id == t] == [(0, 0.0), (1, 0.5), (2, 1.25)]
    out = fire(block, store, int((START.timestamp() + 9) * 1000))
    assert sorted((r.track_id, r.fr, r.x1) for r in out) == [(1, 3, 2.125), (2, 3, 2.125)]

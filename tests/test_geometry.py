"""Fold operators against plain Python, with groups large enough to be split."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.functions import ema
from footfall.functions import geometry as geo
from footfall.operators import geometry as g
from footfall.operators.smoothing import smooth_bbox

BOXES = "store_id string, camera_id string, frame_index bigint, class_id int, det_id string, conf double, " \
        "x1 double, y1 double, x2 double, y2 double"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    inter = w * h
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / union if union > 0 else 0.0


def greedy(rows, limit=0.6):
    """det_id -> None when kept, else the id of the box that drops it."""
    fate, kept = {}, {}
    for r in sorted(rows, key=lambda r: (-(r["conf"] or 0.0), r["det_id"])):
        group = kept.setdefault((r["store_id"], r["camera_id"], r["frame_index"], r["class_id"]), [])
        box = (r["x1"], r["y1"], r["x2"], r["y2"])
        hit = next((k for k, b in group if iou(b, box) >= limit), None)
        fate[r["det_id"]] = hit
        if hit is None:
            group.append((r["det_id"], box))
    return fate


def random_boxes(n_small, n_hot, seed=7):
    """Small frames, one frame with a third of everything, copies, flat boxes."""
    rnd, rows = random.Random(seed), []
    for i in range(n_small + n_hot):
        hot = i >= n_small
        x, y = rnd.randrange(0, 300, 3), rnd.randrange(0, 90, 3)
        w, h = rnd.choice([0, 40, 44, 50]), rnd.choice([60, 66])
        if hot and rnd.random() < 0.3:
            x, y, w, h = 10, 10, 40, 60
        rows.append(dict(
            store_id="s", camera_id=None if hot else "c", frame_index=0 if hot else 1 + i % 40, class_id=i % 2,
            det_id=f"d{i:05d}", conf=None if i % 50 == 0 else rnd.randrange(20) / 20,
            x1=float(x), y1=float(y), x2=float(x + w), y2=float(y + h)))
    return rows


@pytest.mark.parametrize("fold", [512, 16])
def test_suppression_equals_a_greedy_loop(spark, fold, monkeypatch):
    """With ``fold`` 16 the hot frame goes through rounds and its keys are salted."""
    monkeypatch.setattr(g, "MIN_HEAVY", 10)
    monkeypatch.setattr(g, "HEAVY_SHARE", 20)
    rows = random_boxes(400, 200)
    boxes = spark.createDataFrame([tuple(r.values()) for r in rows], BOXES).coalesce(2)
    want = greedy(rows)
    assert 100 < sum(v is None for v in want.values()) < len(rows)
    kept = [r.det_id for r in g.nms_per_frame(boxes, fold=fold).collect()]
    assert sorted(kept) == sorted(k for k, v in want.items() if v is None)
    pairs = g.suppressed_pairs(boxes, fold=fold).collect()
    assert {r.det_id: r.suppressed_by for r in pairs} == {k: v for k, v in want.items() if v is not None}
    assert len(pairs) == len({r.det_id for r in pairs}) and min(r.iou for r in pairs) >= 0.6


def test_overlap_and_clip(spark):
    def box(*v):
        return F.struct(*[F.lit(float(x)).alias(c) for x, c in zip(v, geo.BOX)])

    row = spark.range(1).select(
        geo.iou(box(0, 0, 10, 10), box(5, 0, 15, 10)).alias("half"),
        geo.iou(box(0, 0, 10, 10), box(10, 0, 15, 10)).alias("touch"),
        geo.iou(box(3, 3, 3, 9), box(3, 3, 3, 9)).alias("flat"),
        geo.clip(box(-5, 700, 1400, 800), F.lit(1280), F.lit(720)).alias("c"),
        geo.clip(box(2000, 10, 10, 5), F.lit(1280), F.lit(720)).alias("d"),
    ).first()
    assert (row.half, row.touch, row.flat) == (1 / 3, 0.0, 0.0)
    assert tuple(row.c) == (0.0, 700.0, 1280.0, 720.0)
    assert tuple(row.d) == (1279.0, 10.0, 1280.0, 11.0)


def walk(rows):
    """Clip and smooth in one pass per track, the plain way."""
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r["track_id"] if r["track_id"] is not None else -9, r["n"])):
        x1, y1 = max(0.0, min(1279.0, r["x1"])), max(0.0, min(719.0, r["y1"]))
        x2, y2 = max(x1 + 1, min(1280.0, r["x2"])), max(y1 + 1, min(720.0, r["y2"]))
        box, t = (x1, y1, x2, y2), r["track_id"]
        if t is not None and t >= 0:
            prev = state.get(t)
            if prev and iou(box, prev) >= ema.MIN_IOU:
                box = tuple(ema.ALPHA * a + (1 - ema.ALPHA) * b for a, b in zip(box, prev))
            state[t] = box
        out[r["n"]] = box
    return out


@pytest.mark.parametrize("block_rows, tail_rows", [(100_000, 256), (40, 64), (25, 1)])
def test_smoothing_equals_one_pass_however_it_is_cut(spark, block_rows, tail_rows):
    """One track holds a third of the rows; a one-row tail makes guesses wrong,
    so the repair rounds run too."""
    rnd, rows = random.Random(3), []
    for n in range(600):
        track = 5 if n % 3 == 0 else rnd.choice([None, -1, 1, 2, 7, 8])
        x = 100.0 + rnd.random() * 30 + (400 if rnd.random() < 0.02 else 0)
        rows.append(dict(track_id=track, n=n, img_w=1280, img_h=720,
                         x1=x - 110, y1=50.0, x2=x + 60 + rnd.random() * 9, y2=150.0 + rnd.random()))
    schema = "track_id bigint, n bigint, img_w int, img_h int, x1 double, y1 double, x2 double, y2 double"
    boxes = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = smooth_bbox(boxes, ["track_id"], ["n"], block_rows=block_rows, tail_rows=tail_rows).collect()
    assert {r.n: (r.x1, r.y1, r.x2, r.y2) for r in got} == walk(rows)


def test_a_fold_beyond_the_group_limit_is_refused(spark):
    boxes = spark.createDataFrame([("s", "c", 1, 0, "d", 0.5, 0.0, 0.0, 1.0, 1.0)],
                                  "store_id string, camera_id string, frame_index int, class_id int, det_id string,"
                                  " conf double, x1 double, y1 double, x2 double, y2 double")
    with pytest.raises(ValueError, match="fold"):
        g.nms_per_frame(boxes, fold=5000)


def test_live_smoothing_keeps_boxes_without_a_track(spark):
    from footfall.session import shared_dir
    from footfall.streaming.smooth import smooth_stream, start_smooth

    kinds = "cam string, track_id long, fr int, img_w int, img_h int, x1 double, y1 double, x2 double, y2 double"
    rows = [("c", t, i, 100, 100, 10.0 + i, 10.0, 150.0, 40.0) for t in (7, None, -1) for i in range(2)]
    boxes, landing, out = spark.createDataFrame(rows, kinds), shared_dir(spark, "t-boxes"), shared_dir(spark, "t-smooth")
    boxes.write.parquet(landing)
    stream = smooth_stream(spark.readStream.schema(boxes.schema).parquet(landing), ["cam", "track_id"], ["fr"])
    start_smooth(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    got = sorted(((r.track_id or 0, r.fr, r.x1, r.x2) for r in spark.read.parquet(f"{out}/rows").collect()))
    assert [g[:2] for g in got] == [(-1, 0), (-1, 1), (0, 0), (0, 1), (7, 0), (7, 1)]
    assert got[1][2] == 11.0 and 10.0 < got[5][2] < 11.0


def test_smoothing_all_runs_at_once_is_smoothing_each():
    """Bit for bit, with many short runs, few long ones and a state brought along."""
    rng = np.random.default_rng(2)
    for runs, longest in ((1, 50), (3, 400), (60, 30), (200, 3), (40, 90)):
        lengths = rng.integers(1, longest + 1, runs)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        corner = np.cumsum(rng.normal(0, 8, (lengths.sum(), 2)), 0)
        boxes = np.column_stack((corner, corner + rng.choice([0.0, 30.0, 60.0], (len(corner), 2))))
        for first in (None, tuple(boxes[0] + 1.5)):
            expected = []
            for i, (a, n) in enumerate(zip(starts, lengths)):
                rows = [tuple(map(float, b)) for b in boxes[a:a + n]]
                expected += list(ema.smooth(rows, first if i == 0 else None, 0.6, 0.1))
            assert (ema.smooth_runs(boxes, starts, first, 0.6, 0.1) == np.array(expected)).all()


def test_a_box_without_a_corner_stays_missing(spark):
    values = [(1, 5.0, 5.0, 20.0, 20.0, 100, 100), (2, None, 5.0, 20.0, 20.0, 100, 100), (3, 5.0, 5.0, 20.0, None, 100, 100),
              (4, 5.0, 5.0, 20.0, 20.0, None, 100), (5, -5.0, 5.0, 200.0, 20.0, 100, 100)]
    boxes = spark.createDataFrame(values, "det int, x1 double, y1 double, x2 double, y2 double, img_w int, img_h int")
    found = {r.det: (r.x1, r.y1, r.x2, r.y2) for r in g.clip_bbox(boxes).collect()}
    assert found == {1: (5.0, 5.0, 20.0, 20.0), 2: (None,) * 4, 3: (None,) * 4, 4: (None,) * 4, 5: (0.0, 5.0, 100.0, 20.0)}

"""The registered queries again, as plain SQL for an independent engine.

Everything starts from the projections in ``fixtures`` and skips JSON: rows of
a broken payload and rows without a frame number are left out by condition.
"""

from __future__ import annotations

from footfall.functions.labels import coco_names
from footfall.plans.fixtures import F1, F2, IMG_H, IMG_W, render


def _pixel(c: str) -> str:
    return f"CAST(greatest(CAST(0 AS DOUBLE), floor({c} + CAST(0.5 AS DOUBLE))) AS INTEGER)"


CTES: dict[str, str] = {
    "f1": render(F1, "duckdb", "events"),
    "det": f"""
      SELECT fr, e, CASE WHEN fr % 2 >= 0 THEN 'v1' END AS schema_version,
       'run_01' AS pipeline_run_id, store_id, camera_id,
       CASE WHEN fr % 83 <> 0 THEN fr END AS frame_index, capture_ts,
       CAST({IMG_W} AS INTEGER) AS img_w, CAST({IMG_H} AS INTEGER) AS img_h, det_id,
       CASE WHEN cls IS NULL OR lower(trim(cls)) IN ('', 'none', 'null') THEN 'person'
            ELSE trim(cls) END AS class_name,
       CAST(coalesce(cls_id, -1) AS INTEGER) AS class_id,
       least(greatest(coalesce(conf, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) AS conf,
       {_pixel('x1')} AS bbox_x1, {_pixel('y1')} AS bbox_y1,
       greatest({_pixel('x1')}, {_pixel('x2')}) AS bbox_x2,
       greatest({_pixel('y1')}, {_pixel('y2')}) AS bbox_y2,
       CAST(coalesce(track_id, -1) AS BIGINT) AS track_id
      FROM f1 WHERE fr % 79 <> 0""",
    "silver": """
      SELECT * FROM (
       SELECT *, row_number() OVER (PARTITION BY store_id, camera_id, frame_index, det_id
         ORDER BY conf DESC NULLS LAST, capture_ts DESC NULLS LAST, img_w DESC, img_h DESC,
           class_name DESC NULLS LAST, class_id DESC NULLS LAST, bbox_x1 DESC, bbox_y1 DESC,
           bbox_x2 DESC, bbox_y2 DESC, track_id DESC) AS rn
       FROM det WHERE frame_index IS NOT NULL AND store_id IS NOT NULL AND camera_id IS NOT NULL
         AND det_id IS NOT NULL AND conf >= 0.4) ranked
      WHERE rn = 1""",
    "det2": """
      SELECT CASE WHEN fr % 83 <> 0 THEN fr END AS frame_index, capture_ts, camera_id, store_id,
       det_id, cls AS class, CAST(cls_id AS INTEGER) AS class_id, conf,
       x1 AS bbox_x1, CAST(y1 AS DOUBLE) AS bbox_y1, CAST(x2 AS DOUBLE) AS bbox_x2,
       CAST(y2 AS DOUBLE) AS bbox_y2,
       CAST(trunc(x1 + (x2 - x1) / CAST(2 AS DOUBLE)) AS DOUBLE) AS centroid_x,
       CAST(trunc(y1 + (y2 - y1) / CAST(2 AS DOUBLE)) AS DOUBLE) AS centroid_y,
       CAST(track_id AS BIGINT) AS track_id, TIMESTAMP '2025-06-01 00:00:00' AS ingest_ts
      FROM f1 WHERE fr % 79 <> 0""",
    "silver2": """
      SELECT * FROM (
       SELECT *, row_number() OVER (PARTITION BY store_id, camera_id, frame_index, det_id
         ORDER BY conf DESC NULLS LAST, ingest_ts DESC, capture_ts DESC, class DESC NULLS LAST,
           class_id DESC NULLS LAST, bbox_x1 DESC, bbox_y1 DESC, bbox_x2 DESC, bbox_y2 DESC,
           centroid_x DESC, centroid_y DESC, track_id DESC) AS rn
       FROM det2 WHERE frame_index IS NOT NULL AND store_id IS NOT NULL AND camera_id IS NOT NULL
         AND det_id IS NOT NULL AND track_id IS NOT NULL AND conf >= 0.4) ranked
      WHERE rn = 1""",
    "pos": """
      SELECT *, (CAST(bbox_x1 AS DOUBLE) + bbox_x2) / CAST(2 AS DOUBLE) AS cx,
       (CAST(bbox_y1 AS DOUBLE) + bbox_y2) / CAST(2 AS DOUBLE) AS cy FROM silver""",
    "pos2": "SELECT *, centroid_x AS cx, centroid_y AS cy FROM silver2",
    "minute": """
      SELECT store_id, camera_id, date_trunc('minute', capture_ts) AS ts_minute,
       count(*) AS detection_count, count(DISTINCT track_id) AS unique_tracks, avg(conf) AS avg_conf,
       avg(CAST(bbox_x2 - bbox_x1 AS DOUBLE) * (bbox_y2 - bbox_y1)
           / nullif(CAST(img_w AS DOUBLE) * img_h, 0)) AS bbox_area_ratio_avg
      FROM silver GROUP BY ALL""",
    "hour": """
      SELECT store_id, camera_id, date_trunc('hour', capture_ts) AS ts_hour,
       count(*) AS detection_count, count(DISTINCT track_id) AS unique_tracks, avg(conf) AS avg_conf
      FROM silver GROUP BY ALL""",
}

for _tag, _silver, _pos in (("", "silver", "pos"), ("2", "silver2", "pos2")):
    _secs = "CAST(date_sub('second', min(capture_ts), max(capture_ts)) AS DOUBLE)" if not _tag else \
        "date_diff('millisecond', min(capture_ts), max(capture_ts)) / CAST(1000 AS DOUBLE)"
    _zone = """CAST(floor(cx / CAST(128 AS DOUBLE)) AS INTEGER) AS zone_x,
       CAST(floor(cy / CAST(72 AS DOUBLE)) AS INTEGER) AS zone_y"""
    CTES["people" + _tag] = f"""
      SELECT store_id, camera_id, date_trunc('minute', capture_ts) AS ts_minute,
       count(*) AS detections, count(DISTINCT track_id) AS unique_people
      FROM {_silver} GROUP BY ALL"""
    CTES["heatmap" + _tag] = f"""
      SELECT store_id, camera_id, {_zone}, count(*) AS hits, count(DISTINCT track_id) AS unique_tracks
      FROM {_pos} GROUP BY ALL"""
    CTES["visit" + _tag] = f"""
      SELECT store_id, camera_id, track_id, {_zone}, {_secs} AS secs FROM {_pos} GROUP BY ALL"""
    CTES["dwell" + _tag] = f"""
      SELECT store_id, camera_id, zone_x, zone_y, count(*) AS visits,
       sum(secs) AS total_dwell_seconds, avg(secs) AS avg_dwell_seconds
      FROM visit{_tag} GROUP BY ALL"""
    CTES["track" + _tag] = f"""
      SELECT store_id, camera_id, track_id, count(*) AS frames, min(capture_ts) AS start_time,
       max(capture_ts) AS end_time, {_secs} AS duration_seconds,
       min(cx) AS min_x, max(cx) AS max_x, max(cx) - min(cx) AS delta_x,
       min(cy) AS min_y, max(cy) AS max_y, max(cy) - min(cy) AS delta_y,
       avg(cx) AS avg_x, avg(cy) AS avg_y, avg(conf) AS avg_conf
      FROM {_pos} GROUP BY ALL"""

# Which CTEs each one reads, in order of definition.
NEEDS = {
    "f1": [], "det": ["f1"], "silver": ["det"], "det2": ["f1"], "silver2": ["det2"],
    "pos": ["silver"], "pos2": ["silver2"], "minute": ["silver"], "hour": ["silver"],
    "people": ["silver"], "people2": ["silver2"], "heatmap": ["pos"], "heatmap2": ["pos2"],
    "visit": ["pos"], "visit2": ["pos2"], "dwell": ["visit"], "dwell2": ["visit2"],
    "track": ["pos"], "track2": ["pos2"],
}


def over(cte: str, select: str) -> str:
    """``select`` with every CTE that ``cte`` depends on in front."""
    chain: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS[name]:
            visit(need)
        if name not in chain:
            chain.append(name)

    visit(cte)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in chain) + "\n" + select


SILVER_COLUMNS = """schema_version, pipeline_run_id, store_id, camera_id, frame_index, capture_ts,
 img_w, img_h, det_id, class_name, class_id, conf, bbox_x1, bbox_y1, bbox_x2, bbox_y2, track_id"""
# Columns of the stored Silver table, folder columns last.
STORED_SILVER = [
    ("schema_version", "string"), ("pipeline_run_id", "string"), ("camera_id", "string"),
    ("frame_index", "bigint"), ("capture_ts", "timestamp_ntz"), ("img_w", "int"), ("img_h", "int"),
    ("det_id", "string"), ("class_name", "string"), ("class_id", "int"), ("conf", "double"),
    ("bbox_x1", "int"), ("bbox_y1", "int"), ("bbox_x2", "int"), ("bbox_y2", "int"),
    ("track_id", "bigint"), ("processing_ts", "timestamp"),
    ("store_id", "string"), ("capture_date", "date"),
]
SILVER2_COLUMNS = """frame_index, capture_ts, camera_id, store_id, det_id, class, class_id, conf,
 bbox_x1, bbox_y1, bbox_x2, bbox_y2, centroid_x, centroid_y, track_id, ingest_ts"""


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 9) AS {c}" for c in columns)


MINUTE = f"SELECT store_id, camera_id, ts_minute, detection_count, unique_tracks, {_r('avg_conf', 'bbox_area_ratio_avg')} FROM minute"
HOUR = f"SELECT store_id, camera_id, ts_hour, detection_count, unique_tracks, {_r('avg_conf')} FROM hour"


def _dwell(tag: str = "") -> str:
    return f"SELECT store_id, camera_id, zone_x, zone_y, visits, {_r('total_dwell_seconds', 'avg_dwell_seconds')} FROM dwell{tag}"


def _track(tag: str = "") -> str:
    measures = _r("duration_seconds", "min_x", "max_x", "delta_x", "min_y", "max_y", "delta_y",
                  "avg_x", "avg_y", "avg_conf")
    return f"SELECT store_id, camera_id, track_id, frames, start_time, end_time, {measures} FROM track{tag}"


_MS = "date_diff('millisecond', {a}, {b}) / CAST(1000 AS DOUBLE)"
_SPAN = _MS.format(a="min(capture_ts)", b="max(capture_ts)")
_GAP = "round(" + _MS.format(a="prev_ts", b="capture_ts") + ", 9) AS gap_seconds"
_CAM = "store_id, camera_id"
_FRAMES = "SELECT DISTINCT fr, store_id, camera_id, capture_ts FROM f1"
_ISO = "strftime(capture_ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00'"


# The required fields of the record's contract, apart from the operator's own list.
CONTRACT_FRAME = (
    "schema_version pipeline_run_id frame_index capture_ts source.store_id source.camera_id source.stream_id"
    " image_size.width image_size.height detections").split()
CONTRACT_DETECTION = (
    "det_id class class_id conf bbox.x1 bbox.y1 bbox.x2 bbox.y2 bbox_norm.x bbox_norm.y bbox_norm.w bbox_norm.h"
    " centroid.x centroid.y centroid_norm.x centroid_norm.y").split()


def _contract() -> str:
    """Gaps that F1 plants: the frame number, the ids and three leaf values."""
    ok = "fr % 79 <> 0"
    frame_gap = {
        "frame_index": "fr % 83 = 0", "source.store_id": "store_id IS NULL",
        "source.camera_id": "camera_id IS NULL",
    }
    leaf_gap = {"det_id": "det_id IS NULL", "class": "cls IS NULL",
                "class_id": "cls_id IS NULL", "conf": "conf IS NULL"}
    parts = [
        f"SELECT '{f}' AS field, CAST(count(*) FILTER (WHERE NOT ({ok}) OR {frame_gap.get(f, 'false')}) AS BIGINT)"
        f" AS missing, count(*) AS total FROM frames" for f in CONTRACT_FRAME
    ] + [
        f"SELECT 'detections[].{f}' AS field, CAST(count(*) FILTER (WHERE {leaf_gap.get(f, 'false')}) AS BIGINT)"
        f" AS missing, count(*) AS total FROM f1 WHERE {ok}" for f in CONTRACT_DETECTION
    ]
    return (f"WITH f1 AS ({CTES['f1']}), frames AS ({_FRAMES})\n" + "\nUNION ALL\n".join(parts))


def _label_lookup() -> str:
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(coco_names()))
    return over("silver", f"""SELECT s.class_id, coalesce(d.label, 'unknown') AS label, count(*) AS detections
      FROM silver s LEFT JOIN (VALUES {rows}) AS d(class_id, label) ON s.class_id = d.class_id
      GROUP BY 1, 2""")


F2_CTE = "f2 AS (" + render(F2, "duckdb", "events") + ")"


def _iou(a: str, b: str) -> str:
    """Overlap over union of two boxes given by alias."""
    zero = "CAST(0 AS DOUBLE)"
    inter = (f"greatest({zero}, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
             f" * greatest({zero}, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))")
    size = "greatest({z}, {p}.x2 - {p}.x1) * greatest({z}, {p}.y2 - {p}.y1)"
    union = f"({size.format(z=zero, p=a)} + {size.format(z=zero, p=b)} - {inter})"
    return f"(CASE WHEN {inter} > 0 AND {union} > 0 THEN {inter} / {union} ELSE {zero} END)"


# Rank r of every (frame, class) is judged against the boxes kept at ranks below r.
_NMS = f"""WITH RECURSIVE {F2_CTE},
 ranked AS (SELECT *, row_number() OVER (PARTITION BY store_id, camera_id, fr, class_id
    ORDER BY conf DESC, e) AS r FROM f2),
 step AS (
  SELECT 0 AS r, store_id, camera_id, fr, class_id,
   CAST([] AS STRUCT(r BIGINT, id VARCHAR, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE)[]) AS kept,
   CAST(NULL AS VARCHAR) AS det_id, CAST(NULL AS VARCHAR) AS suppressed_by, CAST(NULL AS DOUBLE) AS iou
  FROM ranked WHERE r = 1
  UNION ALL
  SELECT n.r, n.store_id, n.camera_id, n.fr, n.class_id,
   CASE WHEN n.hit IS NULL
        THEN list_append(n.kept, {{'r': n.r, 'id': n.det_id, 'x1': n.x1, 'y1': n.y1, 'x2': n.x2, 'y2': n.y2}})
        ELSE n.kept END,
   n.det_id, n.hit.id, n.hit.iou
  FROM (
   SELECT b.*, s.kept,
    list_filter(list_transform(s.kept, lambda k: {{'id': k.id, 'iou': {_iou('k', 'b')}}}), lambda m: m.iou >= 0.6)[1] AS hit
   FROM step s JOIN ranked b ON b.store_id = s.store_id AND b.camera_id = s.camera_id
     AND b.fr = s.fr AND b.class_id = s.class_id AND b.r = s.r + 1) n)
"""

# Equal boxes stand as one, the best of them.
_PAIRS = f"""WITH {F2_CTE},
 folded AS (
  SELECT store_id, camera_id, fr, class_id, x1, y1, x2, y2, count(*) AS n,
   min({{'c': -conf, 'e': e}}) AS rank, arg_min(det_id, {{'c': -conf, 'e': e}}) AS det_id
  FROM f2 WHERE x2 > x1 AND y2 > y1 GROUP BY ALL),
 met AS (
  SELECT a.store_id, a.camera_id, a.fr, a.class_id, a.det_id, b.det_id AS other_id, {_iou('a', 'b')} AS iou, a.n * b.n AS pairs
  FROM folded a JOIN folded b ON a.store_id = b.store_id AND a.camera_id = b.camera_id AND a.fr = b.fr
   AND a.class_id = b.class_id AND a.rank < b.rank)
SELECT store_id, camera_id, fr, class_id, det_id, other_id, round(iou, 9) AS iou, pairs FROM met WHERE iou > 0
UNION ALL
SELECT store_id, camera_id, fr, class_id, det_id, det_id, CAST(1 AS DOUBLE), CAST(n * (n - 1) / 2 AS BIGINT) FROM folded WHERE n > 1"""

_SMOOTH = f"""WITH RECURSIVE {F2_CTE},
 clipped AS (
  SELECT store_id, camera_id, track_id, fr, e, det_id, x1, y1,
   greatest(x1 + 1, least(CAST({IMG_W} AS DOUBLE), x2)) AS x2,
   greatest(y1 + 1, least(CAST({IMG_H} AS DOUBLE), y2)) AS y2
  FROM (SELECT * REPLACE (greatest(CAST(0 AS DOUBLE), least(CAST({IMG_W - 1} AS DOUBLE), x1)) AS x1,
          greatest(CAST(0 AS DOUBLE), least(CAST({IMG_H - 1} AS DOUBLE), y1)) AS y1) FROM f2) q),
 seq AS (SELECT *, row_number() OVER (PARTITION BY store_id, camera_id, track_id ORDER BY fr, e) AS r FROM clipped),
 walk AS (
  SELECT r, store_id, camera_id, track_id, det_id, x1, y1, x2, y2 FROM seq WHERE r = 1
  UNION ALL
  SELECT r, store_id, camera_id, track_id, det_id,
   CASE WHEN near THEN a * x1 + z * px1 ELSE x1 END, CASE WHEN near THEN a * y1 + z * py1 ELSE y1 END,
   CASE WHEN near THEN a * x2 + z * px2 ELSE x2 END, CASE WHEN near THEN a * y2 + z * py2 ELSE y2 END
  FROM (SELECT c.*, CAST(0.6 AS DOUBLE) AS a, CAST(1 AS DOUBLE) - CAST(0.6 AS DOUBLE) AS z,
          p.x1 AS px1, p.y1 AS py1, p.x2 AS px2, p.y2 AS py2, {_iou('c', 'p')} >= 0.1 AS near
        FROM walk p JOIN seq c ON c.store_id = p.store_id AND c.camera_id = p.camera_id
          AND c.track_id = p.track_id AND c.r = p.r + 1) m)
SELECT store_id, camera_id, track_id, det_id, {_r('x1', 'y1', 'x2', 'y2')} FROM walk"""

_GEO = """SELECT det_id, track_id, cx, cy, w AS box_w, h AS box_h, x1 / 1280 AS norm_x, y1 / 720 AS norm_y,
 w / 1280 AS norm_w, h / 720 AS norm_h,
 CAST(trunc(cx) AS INTEGER) AS centroid_x, CAST(trunc(cy) AS INTEGER) AS centroid_y,
 cx / 1280 AS centroid_norm_x, cy / 720 AS centroid_norm_y
FROM (SELECT *, x2 - x1 AS w, y2 - y1 AS h, x1 + (x2 - x1) / CAST(2 AS DOUBLE) AS cx,
      y1 + (y2 - y1) / CAST(2 AS DOUBLE) AS cy FROM f2) q"""


def _faults(select: str) -> str:
    """Faults of the frames of F1 by the rules that plant them, one row a fault, then ``select``."""
    frame = {
        ("record", "unreadable"): "fr % 79 = 0",
        ("capture_ts", "missing"): "fr % 5 = 1",
        ("frame_index", "missing"): "fr % 83 = 0",
        ("frame_index", "wrong_type"): "fr % 7 = 2 AND fr % 83 <> 0",
        ("weather", "unknown"): "fr % 11 = 3",
        ("source.store_id", "missing"): "store_id IS NULL",
        ("source.camera_id", "missing"): "camera_id IS NULL",
    }
    detection = {
        ("det_id", "missing"): "e % 61 = 0",
        ("class", "missing"): "e % 31 = 0",
        ("class_id", "missing"): "e % 31 = 0",
        ("conf", "missing"): "e % 53 = 0",
        ("conf", "wrong_type"): "fr % 13 = 4 AND e % 53 <> 0",
    }
    parts = [f"SELECT fr, '{f}' AS field, '{p}' AS problem FROM (SELECT DISTINCT fr, store_id, camera_id FROM f1) "
             f"WHERE {test}" + ("" if f == "record" else " AND fr % 79 <> 0") for (f, p), test in frame.items()]
    parts += [f"SELECT fr, 'detections[].{f}', '{p}' FROM f1 WHERE {test} AND fr % 79 <> 0" for (f, p), test in detection.items()]
    return over("f1", f"SELECT {select} FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL")


def _all_gold() -> str:
    """All rows of the six tables in one form: keys, then up to four measures."""
    tables = {
        "minute": ("gold_minute_by_cam", "ts_minute", None, None, None,
                   "detection_count", "unique_tracks", "avg_conf", "bbox_area_ratio_avg"),
        "hour": ("gold_hour_by_cam", "ts_hour", None, None, None, "detection_count", "unique_tracks", "avg_conf", None),
        "people": ("gold_people_per_minute", "ts_minute", None, None, None, "detections", "unique_people", None, None),
        "heatmap": ("gold_zone_heatmap", None, "zone_x", "zone_y", None, "hits", "unique_tracks", None, None),
        "dwell": ("gold_zone_dwell", None, "zone_x", "zone_y", None,
                  "visits", "total_dwell_seconds", "avg_dwell_seconds", None),
        "track": ("gold_track_summary", "start_time", None, None, "track_id",
                  "frames", "duration_seconds", "avg_x", "avg_conf"),
    }
    kinds = {"ts": "TIMESTAMP", "zone_x": "INTEGER", "zone_y": "INTEGER", "track_id": "BIGINT"}

    def part(cte: str, name: str, *columns: str | None) -> str:
        keys = ", ".join(f"CAST({c or 'NULL'} AS {kind}) AS {form}" for (form, kind), c in zip(kinds.items(), columns))
        measures = ", ".join(
            f"round(CAST({c or 'NULL'} AS DOUBLE), 9) AS {form}" for form, c in zip("abcd", columns[4:]))
        return f"SELECT '{name}' AS table_name, store_id, camera_id, {keys}, {measures} FROM {cte}"

    ctes = ["f1", "det", "silver", "pos", "visit", *tables]
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ctes) + "\n" + " UNION ALL ".join(
        part(cte, *columns) for cte, columns in tables.items())


def oracle_sql() -> dict[str, str]:
    silver = over("silver", f"SELECT {SILVER_COLUMNS} FROM silver")
    gold = {
        "minute": over("minute", MINUTE),
        "hour": over("hour", HOUR),
        "people": over("people", "SELECT * FROM people"),
        "heatmap": over("heatmap", "SELECT * FROM heatmap"),
        "dwell": over("dwell", _dwell()),
        "track": over("track", _track()),
    }
    out = {
        # Bronze
        "bronze_ingest": over("f1", f"""SELECT 'v1' AS schema_version, CAST(NULL AS VARCHAR) AS pipeline_run_id,
          CAST(NULL AS BIGINT) AS frame_index, CASE WHEN fr % 79 <> 0 THEN camera_id END AS camera_id,
          CASE WHEN fr % 79 <> 0 THEN store_id END AS store_id,
          TIMESTAMP '2025-06-01 00:00:00' AS ingest_ts, CASE WHEN fr % 79 <> 0 THEN {_ISO} END AS ts,
          CAST(CASE WHEN fr % 79 <> 0 THEN n END AS INTEGER) AS num_dets
          FROM (SELECT fr, store_id, camera_id, capture_ts, count(*) AS n FROM f1 GROUP BY ALL) f"""),
        "bronze_sample": over("f1", f"""SELECT store_id, camera_id, {_ISO} AS ts FROM ({_FRAMES}) f
          WHERE fr % 79 <> 0
          ORDER BY concat('{{', CASE WHEN store_id IS NOT NULL THEN '"store_id":"' || store_id || '",' END,
            CASE WHEN camera_id IS NOT NULL THEN '"camera_id":"' || camera_id || '",' END,
            '"stream_id":"stream_01"}},', CASE WHEN fr % 83 <> 0 THEN '"frame_index":' || fr || ',' END,
            '"capture_ts":"', {_ISO}) LIMIT 10"""),
        "bronze_json_extract": over("f1", f"""SELECT CASE WHEN fr % 79 <> 0 THEN {_ISO} END AS ts,
          CAST(CASE WHEN fr % 79 <> 0 THEN n END AS INTEGER) AS num_dets
          FROM (SELECT fr, capture_ts, count(*) AS n FROM f1 GROUP BY ALL) f"""),
        "bronze_frame_counts": over("f1", f"""SELECT
          CASE WHEN fr % 79 <> 0 AND fr % 83 <> 0 THEN CAST(fr AS VARCHAR) END AS frame_index,
          CASE WHEN fr % 79 <> 0 THEN {_ISO} END AS capture_ts_str,
          CAST(CASE WHEN fr % 79 <> 0 THEN n END AS INTEGER) AS num_person,
          CASE WHEN fr % 79 <> 0 THEN camera_id END AS camera_id,
          CASE WHEN fr % 79 <> 0 THEN store_id END AS store_id,
          TIMESTAMP '2025-06-01 00:00:00' AS ingest_ts
          FROM (SELECT fr, store_id, camera_id, capture_ts, count(*) AS n FROM f1 GROUP BY ALL) f"""),
        "frames_to_jsonl": over("f1", f"""SELECT 'run_01' AS pipeline_run_id, store_id, camera_id,
          CASE WHEN fr % 83 <> 0 THEN fr END AS frame_index, {_ISO} AS capture_ts, det_id, cls AS class,
          CAST(cls_id AS INTEGER) AS class_id, conf, x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2,
          CAST(y2 AS DOUBLE) AS y2, CAST(track_id AS BIGINT) AS track_id FROM f1 WHERE fr % 79 <> 0"""),
        # Silver
        "parse_detections": over("det", f"SELECT {SILVER_COLUMNS} FROM det"),
        "parse_capture_ts": over("det", "SELECT frame_index, capture_ts, count(*) AS detections FROM det GROUP BY ALL"),
        "normalize_class": over("det", "SELECT class_name, count(*) AS detections FROM det GROUP BY ALL"),
        "normalize_bbox": over("det", "SELECT det_id, bbox_x1, bbox_y1, bbox_x2, bbox_y2 FROM det"),
        "parse_detections_sql": over("det", f"SELECT {SILVER_COLUMNS} FROM det"),
        "silver_sql": silver,
        "silver_stream": silver,
        "silver_dedup": over("silver", "SELECT store_id, camera_id, frame_index, det_id, conf, track_id FROM silver"),
        "silver_batch": over("silver2", f"SELECT {SILVER2_COLUMNS} FROM silver2"),
        "describe_silver": over("silver", " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS column_name, '{k}' AS data_type, "
            f"count({'*' if n in ('processing_ts', 'capture_date') else n}) AS filled FROM silver"
            for i, (n, k) in enumerate(STORED_SILVER))),
        "label_lookup": _label_lookup(),
        # Gold
        "gold_minute_by_cam": gold["minute"],
        "gold_hour_by_cam": gold["hour"],
        "gold_people_per_minute": gold["people"],
        "gold_zone_heatmap": gold["heatmap"],
        "gold_zone_dwell": gold["dwell"],
        "gold_track_summary": gold["track"],
        "gold_batch_people_per_minute": over("people2", "SELECT * FROM people2"),
        "gold_batch_zone_heatmap": over("heatmap2", "SELECT * FROM heatmap2"),
        "gold_batch_zone_dwell": over("dwell2", _dwell("2")),
        "gold_batch_track_summary": over("track2", _track("2")),
        # Exploration
        "silver_totals": over("silver2", """SELECT count(*) AS total_detections,
          count(DISTINCT frame_index) AS total_frames, count(DISTINCT track_id) AS total_tracks FROM silver2"""),
        "missing_frames": over("silver2", """SELECT min(frame_index) AS min_frame, max(frame_index) AS max_frame,
          count(*) AS frame_count, max(frame_index) - min(frame_index) + 1 AS expected_frames,
          max(frame_index) - min(frame_index) + 1 - count(*) AS missing_frames
          FROM (SELECT DISTINCT frame_index FROM silver2) f"""),
        "people_per_frame": over("silver2", "SELECT frame_index, count(*) AS num_person FROM silver2 GROUP BY ALL"),
        "conf_percentiles": over("silver2", """SELECT quantile_disc(conf, 0.1) AS p10,
          quantile_disc(conf, 0.5) AS p50, quantile_disc(conf, 0.9) AS p90 FROM silver2"""),
        "ts_gaps": over("silver2", f"""SELECT capture_ts, prev_ts, {_GAP} FROM (SELECT capture_ts,
          lag(capture_ts) OVER (ORDER BY capture_ts) AS prev_ts,
          row_number() OVER (ORDER BY capture_ts) AS rn FROM silver2) t WHERE rn <= 20"""),
        "ts_gaps_by_camera": over("silver2", f"""SELECT {_CAM}, CAST(rn AS INTEGER) AS rn, capture_ts, prev_ts, {_GAP}
          FROM (SELECT *, lag(capture_ts) OVER w AS prev_ts, row_number() OVER w AS rn
                FROM (SELECT {_CAM}, capture_ts, frame_index, det_id FROM silver2) s
                WINDOW w AS (PARTITION BY {_CAM} ORDER BY capture_ts, frame_index, det_id)) t"""),
        "track_stats": over("silver2", f"""SELECT track_id, count(*) AS frames_visible, min(capture_ts) AS start_time,
          max(capture_ts) AS end_time, round({_SPAN}, 9) AS duration_seconds FROM silver2 GROUP BY track_id"""),
        "track_timeline": over("silver2", f"""SELECT track_id, min(capture_ts) AS start_time,
          max(capture_ts) AS end_time, round({_SPAN}, 9) AS duration_seconds FROM silver2 GROUP BY track_id"""),
        "track_mean_position": over("silver2", """SELECT track_id, round(avg(centroid_x), 9) AS avg_x,
          round(avg(centroid_y), 9) AS avg_y FROM silver2 GROUP BY track_id"""),
        "track_extent": over("silver2", """SELECT track_id, min(centroid_x) AS min_x, max(centroid_x) AS max_x,
          min(centroid_y) AS min_y, max(centroid_y) AS max_y, max(centroid_x) - min(centroid_x) AS delta_x,
          max(centroid_y) - min(centroid_y) AS delta_y FROM silver2 GROUP BY track_id"""),
        "track_movement": over("silver2", """SELECT track_id, min(centroid_x) AS start_x, max(centroid_x) AS end_x,
          max(centroid_x) - min(centroid_x) AS movement_x FROM silver2 GROUP BY track_id"""),
        "heatmap_grid": over("silver2", """SELECT floor(centroid_x / 128) AS gx, floor(centroid_y / 72) AS gy,
          count(*) AS hits FROM silver2 GROUP BY ALL"""),
        "dwell_top_stays": over("silver2", f"""SELECT track_id, floor(centroid_x / 128) AS gx,
          floor(centroid_y / 72) AS gy, min(capture_ts) AS start_time, max(capture_ts) AS end_time,
          round({_SPAN}, 9) AS duration_seconds FROM silver2 GROUP BY 1, 2, 3
          ORDER BY {_SPAN} DESC, 1, 2, 3 LIMIT 20"""),
        "people_per_second": over("silver2", """SELECT date_trunc('second', capture_ts) AS sec,
          count(*) AS detections, count(DISTINCT track_id) AS unique_people FROM silver2 GROUP BY 1"""),
        "silver_class_track_counts": over("silver", """SELECT class_name, track_id, count(*) AS total
          FROM silver GROUP BY ALL"""),
        "top_tracks_duration": over("track2", f"""SELECT {_CAM}, track_id, {_r('duration_seconds')} FROM (SELECT * FROM track2
          ORDER BY duration_seconds DESC, store_id, camera_id, track_id LIMIT 10) t"""),
        "top_tracks_dx": over("track2", f"""SELECT {_CAM}, track_id, {_r('delta_x', 'delta_y')} FROM (SELECT * FROM track2
          ORDER BY delta_x DESC, store_id, camera_id, track_id LIMIT 10) t"""),
        "gold_latest_minutes": over("minute", MINUTE + " ORDER BY ts_minute DESC, store_id, camera_id LIMIT 20"),
        "gold_latest_hours": over("hour", HOUR + " ORDER BY ts_hour DESC, store_id, camera_id LIMIT 20"),
        # Quality
        "gold_silver_diff": over("minute", """SELECT store_id, camera_id, ts_minute, g_cnt, s_cnt, g_cnt - s_cnt AS diff
          FROM (SELECT store_id, camera_id, ts_minute,
                 CASE WHEN minute(ts_minute) % 5 = 1 THEN 0
                      WHEN minute(ts_minute) % 5 = 2 THEN detection_count + 1 ELSE detection_count END AS g_cnt,
                 detection_count AS s_cnt FROM minute) t WHERE g_cnt <> s_cnt"""),
        "silver_status_matrix": over("silver", """SELECT CASE WHEN class_name IS NULL THEN 'NULL_VALUE'
           WHEN class_name = '' THEN 'EMPTY_STRING' ELSE class_name END AS class_name_status,
          CASE WHEN track_id = -1 THEN 'CLEANED_TRACK_ID' WHEN track_id IS NULL THEN 'NULL_TRACK_ID'
           ELSE 'VALID_TRACK_ID' END AS track_id_status, count(*) AS total FROM silver GROUP BY ALL"""),
        "partition_stats": over("silver", """SELECT store_id, CAST(CAST(capture_ts AS DATE) AS VARCHAR) AS capture_date,
          count(*) AS record_count FROM silver GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 10"""),
        "contract_report": _contract(),
        # Panels
        "panel_people_totals": over("people", """SELECT CAST(coalesce(sum(detections), 0) AS BIGINT) AS total_detections,
          CAST(coalesce(sum(unique_people), 0) AS BIGINT) AS unique_tracks, count(DISTINCT camera_id) AS active_cameras,
          round(coalesce(avg(detections), 0), 9) AS avg_detections_per_min FROM people"""),
        "panel_people_series": over("people", "SELECT ts_minute AS time, camera_id AS metric, detections AS value FROM people"),
        "panel_people_by_camera": over("people", """SELECT camera_id AS metric, CAST(sum(detections) AS BIGINT) AS value
          FROM people GROUP BY 1"""),
        "panel_people_table": over("people", f"""SELECT ts_minute, {_CAM}, detections, unique_people FROM people
          ORDER BY ts_minute, {_CAM} LIMIT 100"""),
        "panel_track_totals": over("track", """SELECT count(*) AS total_tracks,
          round(coalesce(avg(duration_seconds), 0), 9) AS avg_duration,
          round(coalesce(avg(avg_conf), 0), 9) AS avg_confidence,
          CAST(coalesce(sum(frames), 0) AS BIGINT) AS total_frames FROM track"""),
        "panel_track_series": over("track", """SELECT end_time AS time, CAST(track_id AS VARCHAR) AS metric,
          duration_seconds AS value FROM track"""),
        "panel_track_top_duration": over("track", f"""SELECT 'Track #' || CAST(track_id AS VARCHAR) AS track, duration_seconds
          FROM track ORDER BY duration_seconds DESC, {_CAM}, track_id LIMIT 15"""),
        "panel_track_top_conf": over("track", f"""SELECT 'Track #' || CAST(track_id AS VARCHAR) AS track, {_r('avg_conf')}
          FROM (SELECT * FROM track ORDER BY round(avg_conf, 9) DESC, {_CAM}, track_id LIMIT 15) t"""),
        "panel_tracks_by_camera": over("track", "SELECT camera_id, count(*) AS tracks FROM track GROUP BY 1"),
        "panel_track_table": over("track", f"""SELECT {_CAM}, track_id, frames,
          {_r('duration_seconds', 'delta_x', 'delta_y', 'avg_conf')} FROM (SELECT * FROM track
          ORDER BY frames, {_CAM}, track_id LIMIT 100) t"""),
        "panel_zone_totals": over("dwell", """SELECT CAST(coalesce(sum(visits), 0) AS BIGINT) AS total_visits,
          round(coalesce(avg(avg_dwell_seconds), 0), 9) AS avg_dwell, count(*) AS active_zones,
          round(coalesce(max(avg_dwell_seconds), 0), 9) AS hotspot_dwell FROM dwell"""),
        "panel_zone_top_dwell": over("dwell", f"""SELECT 'Zone (' || zone_x || ',' || zone_y || ')' AS zone,
          round(avg_dwell_seconds, 9) AS dwell_seconds FROM dwell
          ORDER BY avg_dwell_seconds DESC, {_CAM}, zone_x, zone_y LIMIT 15"""),
        "panel_zone_top_visits": over("dwell", f"""SELECT 'Zone (' || zone_x || ',' || zone_y || ')' AS zone, visits FROM dwell
          ORDER BY visits DESC, {_CAM}, zone_x, zone_y LIMIT 15"""),
        "panel_heatmap_table": over("heatmap", f"""SELECT zone_x, zone_y, hits, unique_tracks FROM heatmap
          ORDER BY hits DESC, {_CAM}, zone_x, zone_y LIMIT 50"""),
        "panel_zone_table": over("dwell", _dwell() + f" ORDER BY visits DESC, {_CAM}, zone_x, zone_y LIMIT 50"),
        # Geometry
        "detection_geometry": f"WITH {F2_CTE} {_GEO}",
        "active_zone_filter": f"""WITH {F2_CTE} SELECT det_id, x1, x2 FROM f2
          WHERE x1 + (x2 - x1) / CAST(2 AS DOUBLE) >= 384""",
        "class_filter": f"WITH {F2_CTE} SELECT det_id, class_id, conf FROM f2 WHERE class_id IN (0) AND conf >= 0.2",
        "clip_bbox": f"""WITH {F2_CTE} SELECT det_id, cx1 AS x1, cy1 AS y1,
          greatest(cx1 + 1, least(CAST(1280 AS DOUBLE), x2)) AS x2, greatest(cy1 + 1, least(CAST(720 AS DOUBLE), y2)) AS y2
          FROM (SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1279 AS DOUBLE), x1)) AS cx1,
                 greatest(CAST(0 AS DOUBLE), least(CAST(719 AS DOUBLE), y1)) AS cy1 FROM f2) q""",
        "nms_per_frame": _NMS + "SELECT store_id, camera_id, fr, class_id, det_id FROM step WHERE r > 0 AND suppressed_by IS NULL",
        "iou_pairs": _NMS + """SELECT store_id, camera_id, fr, class_id, det_id, suppressed_by, round(iou, 9) AS iou
          FROM step WHERE r > 0 AND suppressed_by IS NOT NULL""",
        "overlap_pairs": _PAIRS,
        "contract_faults": _faults("field, problem, count(*) AS faults, count(DISTINCT fr) AS records"),
        "contract_rejects": _faults("fr, CAST(count(*) AS INTEGER) AS faults"),
        "smooth_bbox": _SMOOTH,
        # Streaming: the stored result must equal the batch result
        "stream_bronze": over("f1", f"""SELECT 'v1' AS schema_version,
          CASE WHEN fr % 79 <> 0 THEN camera_id END AS camera_id,
          CASE WHEN fr % 79 <> 0 THEN store_id END AS store_id, TIMESTAMP '2025-06-01 00:00:00' AS ingest_ts,
          CASE WHEN fr % 79 <> 0 THEN {_ISO} END AS ts, CAST(CASE WHEN fr % 79 <> 0 THEN n END AS INTEGER) AS num_dets
          FROM (SELECT fr, store_id, camera_id, capture_ts, CAST(floor((e % 4) / 2) AS INTEGER) AS part,
                 count(*) AS n FROM f1 GROUP BY ALL) f"""),
        "stream_topic_replay": over("f1", f"""SELECT 'v1' AS schema_version,
          CASE WHEN fr % 79 <> 0 THEN camera_id END AS camera_id,
          CASE WHEN fr % 79 <> 0 THEN store_id END AS store_id, TIMESTAMP '2025-06-01 00:00:00' AS ingest_ts,
          CASE WHEN fr % 79 <> 0 THEN {_ISO} END AS ts, CAST(CASE WHEN fr % 79 <> 0 THEN n END AS INTEGER) AS num_dets
          FROM (SELECT fr, store_id, camera_id, capture_ts, count(*) AS n FROM f1 GROUP BY ALL) f"""),
        "stream_silver": silver,
        "stream_gold_minute": gold["minute"],
        "stream_gold_hour": gold["hour"],
        "stream_gold_people": gold["people"],
        "stream_gold_heatmap": gold["heatmap"],
        "stream_gold_dwell": gold["dwell"],
        "stream_gold_track": gold["track"],
        "stream_gold_all": _all_gold(),
        "stream_gold_switch": _all_gold(),
        "catalog_gold": over("minute", """SELECT 'gold_minute_by_cam' AS table_name, store_id, camera_id, ts_minute,
          detection_count AS detections, CAST(7 AS INTEGER) AS columns FROM minute UNION ALL
          SELECT 'gold_people_per_minute', store_id, camera_id, ts_minute, count(*), CAST(5 AS INTEGER)
          FROM (SELECT store_id, camera_id, date_trunc('minute', capture_ts) AS ts_minute FROM silver) s GROUP BY ALL"""),
        "upsert_latest": gold["people"],
        "stream_smooth": _SMOOTH,
        "stream_state_silver": silver,
        "stream_state_people": gold["people"],
        "stream_state_dwell": gold["dwell"],
        "stream_smooth_ordered": _SMOOTH,
        "gold_bucketed": gold["minute"],
    }
    out["stored_partitions"] = out["partition_stats"]
    out["diff_bucketed"] = out["gold_silver_diff"]
    return out

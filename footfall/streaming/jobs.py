"""Bronze, Silver and Gold as streaming queries; the tables are the state.

A better-ranked copy of a detection may arrive after Gold has counted the
earlier one, and late rows are never dropped.  So every table stores changes
with their before-images, and the work of a micro-batch follows the changes:

* minute, hour and people tables, and the roll-up ``track_zone_minute``, hold
  groups that are bounded in time.  The touched groups are recomputed from
  Silver with the batch functions; only the touched dates and minutes are read
  (hours, where one job makes all tables).
* ``visits`` and ``gold_track_summary`` have groups that grow for ever.  They add
  the differences of the roll-up's changes to their stored sums and widen their
  stored extremes.  Only a group whose extreme may have shrunk is recomputed.
* heatmap and dwell add the differences of the changes of ``visits``.

Replays are harmless.  A replayed batch overwrites its own folder and starts
from the state before it.  Batches are numbered by the tables, so queries may take
turns on one root, also after a lost checkpoint.  Differences are taken from committed batches of the
source table, each batch once (``KeyedTable.applied``), never from the files a
micro-batch happens to see.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.cleaning import seconds_between
from footfall.operators import gold as g
from footfall.operators import silver as s
from footfall.operators.bronze import bronze_ingest
from footfall.schemas import KEYS, columns_of, struct_of, table_schema
from footfall.sources.tables import PARTITIONS, from_folders, to_folders
from footfall.streaming.keyed import BATCH, DELETED, KeyedTable, query_identity

# How often each layer commits.
BRONZE_TRIGGER = "60 seconds"
SILVER_TRIGGER = "1 second"
GOLD_TRIGGER = "30 seconds"

FRAMES_PER_BLOCK = 1 << 17  # about an hour at 30 frames per second
PRUNE_LIST = 512            # longest list of folder values put into a filter
FEW_TASKS = 4               # tasks per core that hand small groups on; each writes a file per task it hands to
COMMIT_WAIT = 120.0         # seconds to wait for the source query's commit mark before failing

ALL = "gold_all"            # name of the query that feeds every table

STAGE = "track_zone_minute"
VISITS = "visits"
TRACKS = "gold_track_summary"
SUMS = {"hits": "bigint", "sum_x": "double", "sum_y": "double", "sum_conf": "double"}
LOWS = {"start_time": "timestamp_ntz", "min_x": "double", "min_y": "double"}
HIGHS = {"end_time": "timestamp_ntz", "max_x": "double", "max_y": "double"}
MEASURES = {**SUMS, **LOWS, **HIGHS}
_MEASURE_DDL = ", ".join(f"{c} {t}" for c, t in MEASURES.items())
_BEFORE_DDL = "before struct<" + ", ".join(f"{c}:{t}" for c, t in MEASURES.items()) + ">"
_CAMERA_DDL = "store_id string, camera_id string"
_ZONE_DDL = "zone_x int, zone_y int"
VISIT_KEY = [*g.ZONE, "track_id"]
TRACK_KEY = [*g.CAMERA, "track_id"]
STAGE_KEY = [*VISIT_KEY, "ts_minute"]
# What the views on Silver are made of, beside camera and minute.
USED = ["capture_ts", "track_id", "conf", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2", "img_w", "img_h"]
SCHEMAS = {
    STAGE: f"{_CAMERA_DDL}, {_ZONE_DDL}, track_id bigint, ts_minute timestamp_ntz, {_MEASURE_DDL}, {_BEFORE_DDL}",
    VISITS: f"{_CAMERA_DDL}, {_ZONE_DDL}, track_id bigint, {_MEASURE_DDL}, {_BEFORE_DDL}",
    TRACKS: f"{_CAMERA_DDL}, track_id bigint, {_MEASURE_DDL}, {_BEFORE_DDL}",
}
PLACE = [*g.CAMERA, "ts_minute"]  # by which resolved Silver rows are spread over tasks
SILVER_IDENTITY = [*s.DEDUP_KEY, "capture_ts", "track_id", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2"]


# ---- group definitions -----------------------------------------------------

def _minute(rows: DataFrame) -> DataFrame:
    return g.with_time(rows, "minute")


def _hour(rows: DataFrame) -> DataFrame:
    return g.with_time(rows, "hour")


def _stage_groups(rows: DataFrame) -> DataFrame:
    return _minute(g.with_zone(rows))


def stage_rows(silver: DataFrame) -> DataFrame:
    """Silver rolled up per (track, zone, minute): all that zone and track tables need."""
    return _stage_groups(silver).groupBy(*STAGE_KEY).agg(
        F.count(F.lit(1)).alias("hits"),
        F.min("capture_ts").alias("start_time"), F.max("capture_ts").alias("end_time"),
        F.min("cx").alias("min_x"), F.max("cx").alias("max_x"),
        F.min("cy").alias("min_y"), F.max("cy").alias("max_y"),
        F.sum("cx").alias("sum_x"), F.sum("cy").alias("sum_y"), F.sum("conf").alias("sum_conf"),
    )


def roll_up(stage: DataFrame, key: list[str]) -> DataFrame:
    """The roll-up's measures over a coarser key."""
    return stage.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        *[F.min(c).alias(c) for c in LOWS],
        *[F.max(c).alias(c) for c in HIGHS],
    )


def track_summary_of(totals: DataFrame) -> DataFrame:
    """Public form of the per-track totals."""
    return g.finish_track_summary(totals.withColumns({
        "frames": F.col("hits"),
        "avg_x": F.col("sum_x") / F.col("hits"),
        "avg_y": F.col("sum_y") / F.col("hits"),
        "avg_conf": F.col("sum_conf") / F.col("hits"),
    }), whole_seconds=True)


@dataclass(frozen=True)
class View:
    """A keyed table derived from another one."""
    source: str
    key: tuple[str, ...]
    how: str  # recompute, accumulate or add
    groups: Callable[[DataFrame], DataFrame] | None = None
    make: Callable[[DataFrame], DataFrame] | None = None


def _recomputed(name: str, groups, make) -> View:
    return View("silver", tuple(KEYS[name]), "recompute", groups, make)


VIEWS = {
    "gold_minute_by_cam": _recomputed("gold_minute_by_cam", _minute, g.gold_minute_by_cam),
    "gold_hour_by_cam": _recomputed("gold_hour_by_cam", _hour, g.gold_hour_by_cam),
    "gold_people_per_minute": _recomputed("gold_people_per_minute", _minute, g.gold_people_per_minute),
    STAGE: View("silver", tuple(STAGE_KEY), "recompute", _stage_groups, stage_rows),
    VISITS: View(STAGE, tuple(VISIT_KEY), "accumulate"),
    TRACKS: View(STAGE, tuple(TRACK_KEY), "accumulate"),
    "gold_zone_heatmap": View(VISITS, tuple(g.ZONE), "add"),
    "gold_zone_dwell": View(VISITS, tuple(g.ZONE), "add"),
}


class Pipeline:
    """All layers below one folder of a shared store."""

    def __init__(self, spark: SparkSession, root: str, run_scoped: bool = False, now: Column | None = None,
                 checkpoints: str | None = None):
        self.spark, self.root, self.run_scoped, self.now = spark, root, run_scoped, now
        self.checkpoints = checkpoints or f"{root}/_checkpoints"
        self.bronze_path = f"{root}/bronze_raw"
        silver = table_schema("silver_detections").add("capture_date", "date").add("frame_block", "long")
        identity = SILVER_IDENTITY + (["pipeline_run_id"] if run_scoped else [])
        self.tables = {
            "silver": KeyedTable(
                f"{root}/silver_detections", silver, identity,
                ["store_id", "capture_date", "frame_block"], ["camera_id", "frame_index"]),
        }
        # Sorted so that file statistics follow the look-ups: by minute, by track.
        layout = {
            STAGE: (["store_id"], ["ts_minute", "camera_id"]),
            VISITS: (["store_id"], ["track_id", "camera_id"]),
            TRACKS: (["store_id"], ["track_id", "camera_id"]),
        }
        for name, view in VIEWS.items():
            schema = struct_of(SCHEMAS[name]) if name in SCHEMAS else table_schema(name)
            self.tables[name] = KeyedTable(f"{root}/{name}", schema, list(view.key), *layout.get(name, ([], [])))

    # ---- streams ----

    def _checkpoint(self, name: str) -> str:
        return f"{self.checkpoints}/{name}"

    def _writer(self, name: str) -> str:
        return f"{name}.{query_identity(self.spark, self._checkpoint(name))}"

    def _start(self, stream: DataFrame, name: str, each, every: str | None) -> StreamingQuery:
        """Starts a query unless a running one of this session writes to the same tables."""
        rivals = {f"{x}@{self.root}" for x in ([name, *VIEWS] if name == ALL else [name] if name == "silver" else [name, ALL])}
        running = [q.name for q in self.spark.streams.active if q.name in rivals]
        if running:
            raise RuntimeError(f"{name} and {running} would write to the same tables")
        writer = (
            stream.writeStream.foreachBatch(each).queryName(f"{name}@{self.root}")
            .option("checkpointLocation", self._checkpoint(name))
        )
        return _trigger(writer, every).start()

    def start_bronze(self, lines: DataFrame, every: str | None = None) -> StreamingQuery:
        """Raw lines appended to Bronze, each committed once."""
        writer = (
            to_folders(bronze_ingest(lines, self.now), PARTITIONS["bronze_raw"]).writeStream.format("parquet").outputMode("append")
            .partitionBy(*PARTITIONS["bronze_raw"])
            .option("path", self.bronze_path)
            .option("checkpointLocation", self._checkpoint("bronze"))
        )
        return _trigger(writer, every).start()

    def bronze(self) -> DataFrame:
        return from_folders(
            self.spark.read.schema(table_schema("bronze_raw")).parquet(self.bronze_path), PARTITIONS["bronze_raw"])

    def start_silver(self, every: str | None = None, files_per_trigger: int | None = None) -> StreamingQuery:
        self.tables["silver"].create(self.spark)
        reader = self.spark.readStream.schema(table_schema("bronze_raw"))
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)

        def each(bronze: DataFrame, n: int) -> None:
            self.merge_silver(bronze, self.tables["silver"].version(self.spark, self._writer("silver"), n))

        lines = from_folders(reader.parquet(self.bronze_path), PARTITIONS["bronze_raw"])
        return self._start(lines, "silver", each, every)

    def start_view(
        self, name: str, every: str | None = None, files_per_trigger: int | None = None
    ) -> StreamingQuery:
        """One derived table as its own query with its own checkpoint."""
        view = VIEWS[name]
        source = self.tables[view.source].create(self.spark)
        self.tables[name].create(self.spark)

        def each(changes: DataFrame, n: int) -> None:
            _keep_places(changes.sparkSession)
            at = self.tables[name].version(self.spark, self._writer(name), n)
            if view.how == "recompute":
                self.refresh(name, changes, at)
            else:
                self._catch_up(name, changes, at)

        return self._start(source.changes(self.spark, files_per_trigger), name, each, every)

    def start_all(self, every: str | None = None, files_per_trigger: int | None = None) -> StreamingQuery:
        """All derived tables in one query: one read of the changes feeds every table.

        The Silver rows of the touched hours are looked up once, for all tables made of them.
        A table applies what the table before it has stored, this batch included.
        """
        for table in self.tables.values():
            table.create(self.spark)

        def each(changes: DataFrame, n: int) -> None:
            writer = self._writer(ALL)
            at = {name: self.tables[name].version(self.spark, writer, n) for name in VIEWS}
            _keep_places(changes.sparkSession)
            stage = _touched(STAGE, changes).persist()
            spans = stage.withColumn("capture_ts", F.col("ts_minute"))  # these groups determine all others
            hours = _hour(spans.coalesce(self._few_tasks())).select(*g.CAMERA, "ts_hour").distinct().persist()
            held = [stage, hours]
            try:
                silver = self._touched_silver(hours, "ts_hour")
                if silver is not None:
                    silver = silver.select(*PLACE, *USED).persist()
                    held.append(silver)
                for name, view in VIEWS.items():
                    if view.how != "recompute":
                        self._advance(name, at[name], at[view.source])
                    elif silver is not None:
                        made = {STAGE: stage, "gold_hour_by_cam": hours}
                        touched = made[name] if name in made else view.groups(spans).select(*view.key).distinct()
                        self._recompute(name, touched, silver, at[name])
            finally:
                for rows in held:
                    rows.unpersist()

        return self._start(self.tables["silver"].changes(self.spark, files_per_trigger), ALL, each, every)

    def _catch_up(self, name: str, changes: DataFrame, n: int) -> None:
        """Applies the source's committed batches that are not yet in ``name``.

        The micro-batch itself only says that there is something new.  It fails, to
        be tried again, rather than commit what it could not apply.
        """
        seen = changes.agg(F.max(BATCH)).first()[0]
        source = self.tables[VIEWS[name].source]
        until = time.monotonic() + COMMIT_WAIT
        while (done := source.finished(self.spark, self.checkpoints)) < (-1 if seen is None else seen):
            if time.monotonic() > until:
                raise TimeoutError(f"{name}: batch {seen} of {VIEWS[name].source} is not committed after {COMMIT_WAIT} s")
            time.sleep(0.2)
        self._advance(name, n, done)

    def _advance(self, name: str, n: int, upto: int) -> None:
        """Applies the source's batches up to ``upto`` that ``name`` has not applied yet."""
        table = self.tables[name]
        applied = table.applied(self.spark, before=n)
        if upto > applied:
            self.apply(name, n, applied, upto)
            table.mark(self.spark, n, upto)

    # ---- micro-batches ----

    def merge_silver(self, bronze: DataFrame, n: int) -> None:
        """Best new rows against the stored row of the same detection.

        The frame number is part of that identity, so the look-up reads only the
        stored folders of the same store and frame block.
        """
        table = self.tables["silver"]
        key = s.DEDUP_KEY + (["pipeline_run_id"] if self.run_scoped else [])
        columns = columns_of("silver_detections")
        new = _silver_parts(s.silver_stream(bronze, self.now, run_scoped=self.run_scoped)).persist()
        try:
            where = _near(new, ["store_id", "frame_block"], ["frame_index"])
            if where is None:
                return
            old = table.current(
                self.spark, before=n,
                only=lambda log: log.where(where).join(new.select(*key), key, "left_semi"))
            rank = _rank_columns(columns, key)
            pair = new.select(*key, F.struct(*table.schema.fieldNames()).alias("new")).join(
                old.select(*key, F.struct(*table.schema.fieldNames()).alias("old")), key, "left")
            better = F.col("old").isNull() | (
                F.struct(*[F.col(f"new.{c}") for c in rank]) > F.struct(*[F.col(f"old.{c}") for c in rank]))
            both = F.array(
                F.struct(F.col("new").alias("row"), F.lit(False).alias(DELETED)),
                F.struct(F.col("old").alias("row"), F.lit(True).alias(DELETED)),
            )
            changed = pair.where(better).select(F.explode(both).alias("c")).where(F.col("c.row").isNotNull())
            table.write(n, changed.select("c.row.*", f"c.{DELETED}"))
        finally:
            new.unpersist()

    def refresh(self, name: str, changes: DataFrame, n: int) -> None:
        """Recomputes the groups of a view on Silver that ``changes`` touch."""
        bucket = _bucket(name)
        touched = _touched(name, changes).persist()
        try:
            cameras = [*g.CAMERA, bucket]
            near = touched.select(*cameras).distinct() if name == STAGE else touched
            silver = self._touched_silver(near, bucket)
            if silver is not None:
                self._recompute(name, touched, silver, n)
        finally:
            touched.unpersist()

    def _touched_silver(self, touched: DataFrame, bucket: str) -> DataFrame | None:
        """The live Silver rows of the touched hours or minutes of a camera, a camera's minute in one task;
        None if nothing is touched.

        The key of the Silver log holds the columns these are made of, so the log is cut down to them
        before versions are resolved.
        """
        unit = bucket[len("ts_"):]
        spans = touched.select(
            "store_id", F.col(bucket).cast("date").alias("capture_date"), F.col(bucket).alias("capture_ts"))
        where = _near(spans, ["store_id", "capture_date"], ["capture_ts"],
                      {"capture_ts": F.expr(f"INTERVAL 1 {unit.upper()}")})
        if where is None:
            return None

        def only(log: DataFrame) -> DataFrame:
            return _minute(g.with_time(log.where(where), unit).join(touched, [*g.CAMERA, bucket], "left_semi"))

        return self.tables["silver"].current(self.spark, only=only, within=PLACE)

    def _recompute(self, name: str, touched: DataFrame, silver: DataFrame, n: int) -> None:
        """Stores the touched groups as ``silver``, which has all rows of them, gives them."""
        view, table, key = VIEWS[name], self.tables[name], list(VIEWS[name].key)
        if "ts_hour" in key:  # hours do not follow the places of the rows
            silver = silver.coalesce(self._few_tasks())
        fresh = touched.join(view.make(silver), key, "left")
        if name != STAGE:  # the roll-up meets its stored rows in place first
            fresh = fresh.coalesce(self._few_tasks())
        measure = next(c for c in fresh.columns if c not in key)
        out = fresh.withColumn(DELETED, F.col(measure).isNull())
        if name == STAGE:
            out = self._with_before(out, name, n, touched, _near(touched, ["store_id"], [_bucket(name)]))
        table.write(n, out)

    def _few_tasks(self) -> int:
        return FEW_TASKS * self.spark.sparkContext.defaultParallelism

    def _with_before(self, out: DataFrame, name: str, n: int, touched: DataFrame, where: Column) -> DataFrame:
        """Adds the stored row of each group as ``before``."""
        key = list(VIEWS[name].key)
        old = self.tables[name].current(
            self.spark, before=n, only=lambda log: log.where(where).join(touched, key, "left_semi"), within=PLACE)
        return out.join(old.select(*key, F.struct(*MEASURES).alias("before")), key, "left")

    def apply(self, name: str, n: int, after: int, upto: int) -> None:
        """Brings ``name`` from batch ``after`` of its source to batch ``upto``."""
        changes = self.tables[VIEWS[name].source].batches(self.spark, after, upto)
        if VIEWS[name].how == "accumulate":
            self._accumulate(name, changes, n, upto)
        else:
            self._add(name, changes, n)

    def _accumulate(self, name: str, changes: DataFrame, n: int, upto: int) -> None:
        table, key = self.tables[name], list(VIEWS[name].key)
        was = F.col("before")
        shrunk = F.col(DELETED) & was.isNotNull()
        for c in LOWS:
            shrunk = shrunk | (F.col(c) > was[c])
        for c in HIGHS:
            shrunk = shrunk | (F.col(c) < was[c])
        delta = changes.groupBy(*key).agg(
            *[F.sum(F.coalesce(F.col(c), F.lit(0)) - F.coalesce(was[c], F.lit(0))).alias(c) for c in SUMS],
            *[F.min(c).alias(c) for c in LOWS],
            *[F.max(c).alias(c) for c in HIGHS],
            F.max(F.coalesce(shrunk, F.lit(False))).alias("shrunk"),
        ).persist()
        try:
            where = _near_tracks(delta)
            if where is None:
                return
            old = table.current(
                self.spark, before=n,
                only=lambda log: log.where(where).join(delta, key, "left_semi"))
            both = delta.join(old.select(*key, F.struct(*MEASURES).alias("before")), key, "left")
            grown = {
                **{c: F.col(c) + F.coalesce(was[c], F.lit(0)) for c in SUMS},
                **{c: F.least(F.col(c), was[c]) for c in LOWS},
                **{c: F.greatest(F.col(c), was[c]) for c in HIGHS},
            }
            redo = delta.where("shrunk").select(*key)
            near_redo = _near_tracks(redo)
            if near_redo is not None:
                source = self.tables[VIEWS[name].source].current(
                    self.spark, before=upto + 1,
                    only=lambda log: log.where(near_redo).join(redo, key, "left_semi"))
                again = roll_up(source, key).select(*key, F.struct(*MEASURES).alias("again"))
                both = both.join(again, key, "left")
                grown = {c: F.when(F.col("shrunk"), F.col("again")[c]).otherwise(v) for c, v in grown.items()}
            out = both.select(*key, *[grown[c].alias(c) for c in MEASURES], "before")
            table.write(n, out.withColumn(DELETED, F.coalesce(F.col("hits") <= 0, F.lit(True))))
        finally:
            delta.unpersist()

    def _add(self, name: str, changes: DataFrame, n: int) -> None:
        """Heatmap or dwell: differences of visits, summed per zone."""
        table, key = self.tables[name], list(VIEWS[name].key)
        was = F.col("before")
        alive, existed = (~F.col(DELETED)).cast("bigint"), was.isNotNull().cast("bigint")
        if name == "gold_zone_heatmap":
            amounts = {
                "hits": F.coalesce("hits", F.lit(0)) * alive - F.coalesce(was["hits"], F.lit(0)),
                "unique_tracks": alive - existed,
            }
            count = "unique_tracks"
        else:
            now = seconds_between(F.col("start_time"), F.col("end_time"), True)
            then = seconds_between(was["start_time"], was["end_time"], True)
            amounts = {
                "visits": alive - existed,
                "total_dwell_seconds":
                    F.when(~F.col(DELETED), now).otherwise(F.lit(0.0)) - F.coalesce(then, F.lit(0.0)),
            }
            count = "visits"
        delta = changes.groupBy(*key).agg(*[F.sum(v).alias(f"d_{c}") for c, v in amounts.items()]).persist()
        try:
            where = _near(delta, ["store_id"], [])
            if where is None:
                return
            old = table.current(self.spark, before=n, only=lambda log: log.where(where))
            out = delta.join(old, key, "left").select(*key, *[
                (F.col(f"d_{c}") + F.coalesce(F.col(c), F.lit(0))).alias(c) for c in amounts])
            if name == "gold_zone_dwell":
                out = out.withColumn(
                    "avg_dwell_seconds", F.col("total_dwell_seconds") / F.nullif(F.col("visits"), F.lit(0)))
            table.write(n, out.withColumn(DELETED, F.col(count) <= 0))
        finally:
            delta.unpersist()

    # ---- results ----

    def silver(self) -> DataFrame:
        return self.tables["silver"].current(self.spark).select(*columns_of("silver_detections"))

    def view(self, name: str) -> DataFrame:
        rows = self.tables[name].current(self.spark)
        return track_summary_of(rows) if name == TRACKS else rows


def _trigger(writer, every: str | None):
    """Run at an interval, or once over everything available when none is given."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _bucket(name: str) -> str:
    """The column of a view's key that holds the hour or minute."""
    return next(c for c in VIEWS[name].key if c.startswith("ts_"))


def _touched(name: str, changes: DataFrame) -> DataFrame:
    """The groups of a view on Silver that ``changes`` touch; the finest ones lie where Silver's rows are put."""
    groups = VIEWS[name].groups(changes).select(*VIEWS[name].key)
    return (groups.repartition(*PLACE) if name == STAGE else groups).distinct()


def _keep_places(stream: SparkSession) -> None:
    """Lets the plans of a stream join rows that lie together by fewer columns than the join compares."""
    stream.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def _silver_parts(silver: DataFrame) -> DataFrame:
    return silver.withColumns({
        "capture_date": F.col("capture_ts").cast("date"),
        "frame_block": F.floor(F.col("frame_index") / F.lit(FRAMES_PER_BLOCK)).cast("bigint"),
    })


def _rank_columns(columns: list[str], key: list[str]) -> list[str]:
    """The order of ``silver.ranking`` as names."""
    lead = ["conf", "capture_ts"]
    return lead + [c for c in columns if c not in lead and c not in key and c != "processing_ts"]


def _near(
    rows: DataFrame, folders: list[str], ranges: list[str], wider: dict[str, Column] | None = None
) -> Column | None:
    """A filter on where ``rows`` lie: folder names and value ranges, None for no rows.

    It prunes folders and row groups; the exact match is made by a join.  Only
    bounds reach the driver, and up to ``PRUNE_LIST`` folder names; where a
    micro-batch has more, a range takes the place of the list.
    ``wider`` is added to an upper bound, which is then left open.
    """
    wider = wider or {}
    kinds = dict(rows.select(*folders, *ranges).dtypes)
    both = [*folders, *ranges]
    found = rows.agg(
        F.count(F.lit(1)),
        *[F.min(c).cast("string") for c in both], *[F.max(c).cast("string") for c in both],
    ).first()
    if not found[0]:
        return None

    def value(text: str, c: str) -> Column:
        return F.lit(text).cast(kinds[c])

    test = F.lit(True)
    for i, c in enumerate(both):
        lo, hi = value(found[1 + i], c), value(found[1 + len(both) + i], c)
        names = _few(rows, c) if c in folders else []
        if names:
            test = test & F.col(c).isin([value(x, c) for x in names])
        elif c in wider:
            test = test & (F.col(c) >= lo) & (F.col(c) < hi + wider[c])
        else:
            test = test & F.col(c).between(lo, hi)
    return test


def _few(rows: DataFrame, column: str) -> list[str]:
    """The values of a column as text, if there are at most ``PRUNE_LIST``."""
    names = [r[0] for r in rows.select(F.col(column).cast("string")).where(
        F.col(column).isNotNull()).distinct().limit(PRUNE_LIST + 1).collect()]
    return names if len(names) <= PRUNE_LIST else []


def _near_tracks(rows: DataFrame) -> Column | None:
    """Store folders and the range of track ids. Trackless rows would widen the range to
    everything, so they are a term of their own, where ``rows`` have any."""
    tracked = F.when(F.col("track_id") >= 0, F.col("track_id"))
    lo, hi, first, last, trackless = rows.agg(
        F.min(tracked), F.max(tracked), F.min("store_id"), F.max("store_id"),
        F.max((F.col("track_id") < 0).cast("int"))).first()
    if first is None:
        return None
    stores = _few(rows, "store_id")
    test = F.col("store_id").isin(stores) if stores else F.col("store_id").between(first, last)
    near = F.lit(False) if lo is None else F.col("track_id").between(lo, hi)
    return test & (near | (F.col("track_id") < 0) if trackless else near)

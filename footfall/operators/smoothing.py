"""Per-track exponential smoothing of boxes over whole tables.

Each result depends on the one before it, and one track may hold a large share
of all rows, so tracks are not grouped.  Rows are range-partitioned by (track,
order) into blocks of equal size; a block may start in the middle of a track.

1. The state at the end of every block is guessed from its last few rows alone.
   The influence of an older state shrinks by 0.4 per row, so the guess nearly
   always equals the true state bit for bit.
2. Every block is computed in parallel, starting from the guess before it.
3. Each true end state is compared with the guess that its successor used.
   Blocks that used a wrong one, and only these, are computed again until none is left; the
   first wrong block gets its true start in every round, so this ends, and the
   result is exactly that of a single pass over each track.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from footfall.functions.ema import ALPHA, MIN_IOU, smooth_runs
from footfall.operators.geometry import BOX, clip_bbox
from footfall.session import carry_to_workers, shared_dir

carry_to_workers(__name__, "footfall.functions.ema")

BLOCK_ROWS = 200_000
MIN_BLOCK_ROWS = 5_000
TAIL_ROWS = 256
_POS_BITS = 33  # monotonically_increasing_id: partition above, row number below


def _walk(table: pa.Table, track: str | None, prev, alpha: float, min_iou: float) -> np.ndarray:
    """Smoothed boxes of rows in order; ``prev`` is the state ``track`` brings along."""
    tracks = table["_track"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    boxes = np.column_stack([table[c].to_numpy() for c in BOX])
    starts = np.flatnonzero(np.append(True, tracks[1:] != tracks[:-1]))
    follows = prev is not None and table["_track"][0].as_py() == track
    return smooth_runs(boxes, starts, np.array(prev) if follows else None, alpha, min_iou)


def smooth_bbox(
    boxes: DataFrame,
    track_key: list[str],
    order: list[str],
    alpha: float = ALPHA,
    min_iou: float = MIN_IOU,
    block_rows: int = BLOCK_ROWS,
    tail_rows: int = TAIL_ROWS,
) -> DataFrame:
    """Boxes clipped and smoothed along each track.

    ``order`` must be a total order within a track.  Rows without a track stay
    clipped only; rows without a box (a corner or a picture size is NULL) have none
    and leave the track as it is.
    """
    spark = boxes.sparkSession
    columns = boxes.columns
    tracked = F.lit(True)
    for c in [*track_key, *BOX]:
        tracked = tracked & F.col(c).isNotNull()
    clipped = clip_bbox(boxes).withColumn("_tracked", tracked & (F.col(track_key[-1]).cast("bigint") >= 0))
    loose = clipped.where(~F.col("_tracked")).select(*columns)

    work = shared_dir(spark, "smooth")
    source = clipped.where("_tracked").drop("_tracked")
    rows_in = source.count()
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-rows_in // block_rows), min(cores, rows_in // MIN_BLOCK_ROWS))
    placed = (
        source.repartitionByRange(blocks, *track_key, *order)
        .sortWithinPartitions(*track_key, *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_track", F.to_json(F.struct(*track_key)))
    )
    placed.write.parquet(f"{work}/rows")
    rows = spark.read.parquet(f"{work}/rows").withColumn(
        "_block", F.shiftright("_id", _POS_BITS).cast("bigint"))

    guesses = _guess_ends(rows, alpha, min_iou, tail_rows)
    guesses.write.parquet(f"{work}/ends-0")
    ends = spark.read.parquet(f"{work}/ends-0")
    starts = _starts(ends)
    starts.write.parquet(f"{work}/starts-0")
    used = spark.read.parquet(f"{work}/starts-0")
    _run(rows, used, alpha, min_iou).write.parquet(f"{work}/out-0")
    outs = [spark.read.parquet(f"{work}/out-0")]  # a block counts as the last of them has it
    _true_ends(outs[0]).write.parquet(f"{work}/true-0")
    true = spark.read.parquet(f"{work}/true-0")
    turn = 0
    while True:
        # One small row per block: its true end, and the start its successor used.
        due = _starts(true)
        wrong = due.alias("d").join(used.alias("u"), "_block").where(
            ~F.col("d.state").eqNullSafe(F.col("u.state"))
            & F.coalesce(F.col("d.state._track") == F.col("u.first_track"), F.lit(True))
        ).select("_block", F.col("d.state").alias("state"), F.col("u.first_track").alias("first_track"))
        turn += 1
        wrong.write.parquet(f"{work}/wrong-{turn}")
        wrong = spark.read.parquet(f"{work}/wrong-{turn}")
        if wrong.isEmpty():
            break
        again = wrong.select("_block")
        used.join(again, "_block", "left_anti").unionByName(wrong).write.parquet(f"{work}/starts-{turn}")
        _run(rows.join(again, "_block", "left_semi"), wrong, alpha, min_iou).write.parquet(f"{work}/out-{turn}")
        fresh = spark.read.parquet(f"{work}/out-{turn}")
        true.join(again, "_block", "left_anti").unionByName(_true_ends(fresh)).write.parquet(f"{work}/true-{turn}")
        used, true = spark.read.parquet(f"{work}/starts-{turn}"), spark.read.parquet(f"{work}/true-{turn}")
        outs = [out.join(again, "_block", "left_anti") for out in outs] + [fresh]
    return reduce(DataFrame.unionByName, [out.select(*columns) for out in outs], loose)


def _state_type() -> StructType:
    return StructType([StructField("_track", StringType()), *[StructField(c, DoubleType()) for c in BOX]])


def _guess_ends(rows: DataFrame, alpha: float, min_iou: float, tail_rows: int) -> DataFrame:
    """End state per block from its last rows, and the track it begins with."""
    latest = Window.partitionBy("_block").orderBy(F.desc("_id"))
    tail = (
        rows.select("_block", "_id", "_track", *BOX)
        .withColumn("_rn", F.row_number().over(latest))
        .where(F.col("_rn") <= tail_rows)
        .drop("_rn")
    )

    def last_state(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        box = _walk(table, None, None, alpha, min_iou)[-1].tolist()
        row = {"_block": table["_block"][0].as_py(), "_track": table["_track"][-1].as_py(), **dict(zip(BOX, box))}
        return pa.Table.from_pylist([row])

    schema = StructType([StructField("_block", LongType()), *_state_type().fields])
    ends = tail.groupBy("_block").applyInArrow(last_state, schema)
    first = rows.groupBy("_block").agg(F.min_by("_track", "_id").alias("first_track"))
    return ends.join(first, "_block").select(
        "_block", "first_track", F.struct("_track", *BOX).alias("state"))


def _true_ends(out: DataFrame) -> DataFrame:
    return out.groupBy("_block").agg(
        F.min_by("_track", "_id").alias("first_track"),
        F.max_by(F.struct("_track", *BOX), "_id").alias("state"),
    )


def _starts(ends: DataFrame) -> DataFrame:
    """The end state of each block's predecessor; one row per block."""
    before = F.lag("state").over(Window.orderBy("_block"))
    return ends.withColumn("state", before)


def _run(rows: DataFrame, starts: DataFrame, alpha: float, min_iou: float) -> DataFrame:
    """Smoothed rows of every block that has a row in ``starts``."""
    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("_id")
        track, prev = None, None
        if right.num_rows and right["_s_track"][0].as_py() is not None:
            track = right["_s_track"][0].as_py()
            prev = tuple(right[f"_s_{c}"][0].as_py() for c in BOX)
        boxes = _walk(left, track, prev, alpha, min_iou)
        for i, c in enumerate(BOX):
            at = left.schema.get_field_index(c)
            left = left.set_column(at, c, pa.array(boxes[:, i]))
        return left

    flat = starts.select(
        "_block", F.col("state._track").alias("_s_track"),
        *[F.col(f"state.{c}").alias(f"_s_{c}") for c in BOX],
    )
    return rows.groupBy("_block").cogroup(flat.groupBy("_block")).applyInArrow(block, rows.schema)

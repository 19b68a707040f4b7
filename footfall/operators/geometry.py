"""Box operators on detection tables: filters, clipping, overlap suppression.

Boxes have columns ``x1, y1, x2, y2``; a frame is named by ``frame_key``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import geometry as geo
from footfall.session import shared_dir

ACTIVE_FROM = 0.3
TRACK_CONF = 0.20
NMS_IOU = 0.6
FRAME_KEY = ["store_id", "camera_id", "frame_index"]
BOX = geo.BOX
HEAVY_SHARE = 10_000
MIN_HEAVY = 10_000
MAX_FOLD = 1000


def active_zone_filter(boxes: DataFrame, start: float = ACTIVE_FROM) -> DataFrame:
    """Boxes whose centre is not left of the line at ``start`` of the width."""
    cx = F.col("x1") + (F.col("x2") - F.col("x1")) / F.lit(2.0)
    return boxes.where(cx >= F.floor(F.col("img_w") * F.lit(start)))


def class_filter(boxes: DataFrame, classes: list[int] | None = None, conf: float = TRACK_CONF) -> DataFrame:
    """Boxes of the wanted classes (person alone by default) above a confidence."""
    return boxes.where(F.col("class_id").isin(*(classes or [0])) & (F.col("conf") >= conf))


def clip_bbox(boxes: DataFrame) -> DataFrame:
    """Boxes clipped to their picture."""
    inside = geo.clip(geo.box(), F.col("img_w"), F.col("img_h"))
    return boxes.withColumn("_c", inside).withColumns({c: F.col(f"_c.{c}") for c in BOX}).drop("_c")


# ---- overlap suppression ---------------------------------------------------
#
# Within one frame and class, boxes are visited by falling confidence and a box
# is dropped when it overlaps an earlier kept one by ``iou`` or more.
#
# 1. Boxes without area never overlap anything: they are kept as they are.
# 2. A frame of up to ``fold`` boxes is gathered in one shuffle and judged by an
#    array fold in the JVM. Frames are counted first, which shuffles counts only.
# 3. In larger frames, boxes with equal corners share one fate, so only the best of
#    them (the leader) is judged; copies are folded away before the shuffle. A group
#    of up to ``fold`` leaders is judged like a small frame.
# 4. A larger group is judged in rounds: its best ``fold`` leaders are folded,
#    the kept ones are handed to all tasks that hold the rest, and what they do
#    not drop goes to the next round.  No task ever holds the whole group.


def _rank(order: list[str]) -> Column:
    """Sort struct, best first: confidence, then the place in the frame."""
    return F.struct((-F.coalesce(F.col("conf"), F.lit(0.0))).alias("r0"), *order)


def _first_hit(kept: Column, b: Column, iou: float) -> Column:
    """The best-ranked kept box that overlaps ``b`` enough, else NULL."""
    hits = F.filter(kept, lambda k: geo.iou(k, b) >= iou)
    return F.try_element_at(hits, F.lit(1))


def _fold(groups: DataFrame, group: list[str], iou: float) -> DataFrame:
    """(group, boxes sorted by rank) with the kept ones among them."""
    row = groups.schema["boxes"].dataType.simpleString()
    kept = F.aggregate(
        "boxes",
        F.array().cast(row),
        lambda acc, b: F.when(
            F.exists(acc, lambda k: geo.iou(k, b) >= iou), acc
        ).otherwise(F.concat(acc, F.array(b))),
    )
    return groups.select(*group, "boxes", kept.alias("kept"))


def _verdicts(folded: DataFrame, group: list[str], iou: float) -> DataFrame:
    """One row per judged leader with the kept box that drops it, if any."""
    judged = folded.select(*group, F.explode("boxes").alias("b"), "kept")
    earlier = F.filter("kept", lambda k: k["rank"] < F.col("b.rank"))
    return judged.select(*group, "b", _first_hit(earlier, F.col("b"), iou).alias("by"))


def _gather(leaders: DataFrame, group: list[str]) -> DataFrame:
    row = F.struct("rank", *BOX, "row")
    return leaders.groupBy(*group).agg(F.sort_array(F.collect_list(row)).alias("boxes"))


def _heavy(counted: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Keys with more than a ten-thousandth of all rows.

    There are fewer than ``HEAVY_SHARE`` of them whatever the data, so the list
    may be broadcast.
    """
    least = max(MIN_HEAVY, rows // HEAVY_SHARE)
    return counted.where(F.col("n") > least).select(*keys)


def _spread_join(big: DataFrame, small: DataFrame, keys: list[str], heavy: DataFrame, how: str) -> DataFrame:
    """Equi-join that spreads the heavy keys of ``big`` over many tasks.

    Only the ``small`` rows of heavy keys are copied.  NULL keys meet each other.
    """
    salts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_hash = F.pmod(F.xxhash64(*[c for c in big.columns if c not in keys]), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))

    def marked(df: DataFrame) -> DataFrame:
        return _null_safe_join(df, F.broadcast(heavy.withColumn("_hot", F.lit(True))), keys, "left")

    left = marked(big).withColumn("_salt", F.when(F.col("_hot"), row_hash).otherwise(F.lit(0))).drop("_hot")
    right = marked(small).withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    return _null_safe_join(left, right, [*keys, "_salt"], how).drop("_salt")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys])
    return left.join(other, same, how).drop(*[f"_r_{c}" for c in keys])


def _leaders(boxes: DataFrame, group: list[str], order: list[str], rest: list[str]) -> DataFrame:
    """The best box of each set of equal boxes, with the size ``n`` of the set."""
    best = F.min(F.struct(_rank(order).alias("rank"), F.struct(*rest).alias("row"))).alias("m")
    return boxes.groupBy(*group, *BOX).agg(best, F.count(F.lit(1)).alias("n")).select(
        *group, *BOX, "m.rank", "m.row", "n")


def _stored(leaders: DataFrame) -> DataFrame:
    path = shared_dir(leaders.sparkSession, "leaders")
    leaders.write.parquet(path)
    return leaders.sparkSession.read.parquet(path)


def _judge(leaders: DataFrame, group: list[str], iou: float, fold: int) -> DataFrame:
    """Verdict per leader: ``by`` is NULL for kept ones."""
    spark = leaders.sparkSession
    leaders = leaders.drop("n")
    large = leaders.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > fold)
    if large.isEmpty():
        return _verdicts(_fold(_gather(leaders, group), group, iou), group, iou)

    work = shared_dir(spark, "overlap")
    large.write.parquet(f"{work}/large")
    large = spark.read.parquet(f"{work}/large")
    heavy = _heavy(large, group, leaders.count())
    mark = large.select(*group, F.lit(True).alias("large"))
    tagged = _spread_join(leaders, mark, group, heavy, "left")
    small = tagged.where(F.col("large").isNull()).drop("large")
    parts = [_verdicts(_fold(_gather(small, group), group, iou), group, iou)]
    tagged.where("large").drop("large").write.parquet(f"{work}/open-0")
    turn = 0
    by_rank = Window.partitionBy(*group).orderBy("rank")
    while True:
        still = spark.read.parquet(f"{work}/open-{turn}")
        if still.isEmpty():
            break
        top = still.withColumn("rn", F.row_number().over(by_rank)).where(F.col("rn") <= fold).drop("rn")
        _fold(_gather(top, group), group, iou).write.parquet(f"{work}/fold-{turn}")
        folded = spark.read.parquet(f"{work}/fold-{turn}")
        parts.append(_verdicts(folded, group, iou))
        kept = folded.select(*group, "kept", F.array_max("boxes")["rank"].alias("last"))
        rest = _spread_join(still, kept, group, heavy, "inner").where(F.col("rank") > F.col("last"))
        b = F.struct("rank", *BOX, "row")
        rest.select(*group, b.alias("b"), _first_hit(F.col("kept"), b, iou).alias("by")).write.parquet(
            f"{work}/seen-{turn}")
        seen = spark.read.parquet(f"{work}/seen-{turn}")
        parts.append(seen.where(F.col("by").isNotNull()))
        seen.where(F.col("by").isNull()).select(*group, "b.*").write.parquet(f"{work}/open-{turn + 1}")
        turn += 1
    return reduce(DataFrame.unionByName, parts)


def _ordinary(boxes: DataFrame, group: list[str], order: list[str], rest: list[str], iou: float) -> DataFrame:
    """Verdicts for frames that fit an array; rows that are equal in all columns are one."""
    gathered = boxes.withColumns({"rank": _rank(order), "row": F.struct(*rest)})
    gathered = _gather(gathered, group).withColumn("boxes", F.array_distinct("boxes"))
    return _verdicts(_fold(gathered, group, iou), group, iou)


def _by_size(boxes: DataFrame, group: list[str], fold: int) -> tuple[DataFrame, DataFrame | None]:
    """The boxes of frames of up to ``fold`` boxes, and those of larger ones, if there are any.

    ``fold`` has to stay within the size up to which Spark cuts a window before its shuffle.
    """
    if fold > MAX_FOLD:
        raise ValueError(f"fold is {fold}; at most {MAX_FOLD} boxes are cut before the shuffle")
    large = boxes.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > fold)
    large = _stored(large)
    rows = large.agg(F.sum("n")).first()[0]
    if not rows:
        return boxes, None
    mark = large.select(*group, F.lit(True).alias("_large"))
    tagged = _spread_join(boxes, mark, group, _heavy(large, group, rows), "left")
    return tagged.where(F.col("_large").isNull()).drop("_large"), tagged.where("_large").drop("_large")


def _prepare(boxes: DataFrame, frame_key: list[str], order: list[str]):
    group = [*frame_key, "class_id"]
    rest = [c for c in boxes.columns if c not in [*group, *BOX]]
    typed = boxes.withColumns({c: F.col(c).cast("double") for c in BOX})
    solid = F.coalesce((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")), F.lit(False))
    return group, rest, typed, solid


def nms_per_frame(
    boxes: DataFrame,
    frame_key: list[str] | None = None,
    order: list[str] | None = None,
    iou: float = NMS_IOU,
    fold: int = 512,
) -> DataFrame:
    """Boxes that survive suppression, with their columns unchanged.

    ``order`` breaks confidence ties and must tell the boxes of a frame apart.
    """
    order = order or ["det_id"]
    group, rest, typed, solid = _prepare(boxes, frame_key or FRAME_KEY, order)
    small, large = _by_size(typed.where(solid), group, fold)
    verdicts = _ordinary(small, group, order, rest, iou)
    if large is not None:
        verdicts = verdicts.unionByName(_judge(_stored(_leaders(large, group, order, rest)), group, iou, fold))
    kept = verdicts.where(F.col("by").isNull()).select(
        *group, *[F.col(f"b.{c}").alias(c) for c in BOX], "b.row.*")
    return kept.unionByName(typed.where(~solid)).select(*boxes.columns)


def suppressed_pairs(
    boxes: DataFrame,
    frame_key: list[str] | None = None,
    order: list[str] | None = None,
    iou: float = NMS_IOU,
    fold: int = 512,
) -> DataFrame:
    """Each dropped box with the kept box that drops it and their overlap.

    One row per dropped box, never all pairs of a frame.
    """
    order = order or ["det_id"]
    group, rest, typed, solid = _prepare(boxes, frame_key or FRAME_KEY, order)
    small, large = _by_size(typed.where(solid), group, fold)
    found = _ordinary(small, group, order, rest, iou).where(F.col("by").isNotNull()).select(
        *group, F.col("b.row.det_id").alias("det_id"), F.col("by.row.det_id").alias("suppressed_by"),
        geo.iou(F.col("by"), F.col("b")).alias("iou"))
    return found if large is None else found.unionByName(_large_pairs(large, group, order, rest, iou, fold))


def _large_pairs(typed: DataFrame, group: list[str], order: list[str], rest: list[str], iou: float, fold: int) -> DataFrame:
    """``suppressed_pairs`` of frames that fit no array."""
    leaders = _stored(_leaders(typed, group, order, rest))
    verdicts = _judge(leaders, group, iou, fold)
    fate = verdicts.select(
        *group, *[F.col(f"b.{c}").alias(c) for c in BOX], F.col("b.rank").alias("leader"),
        F.col("b.row.det_id").alias("leader_id"), "by",
    )
    heavy = _heavy(leaders, [*group, *BOX], leaders.agg(F.sum("n")).first()[0] or 0)
    all_boxes = typed.select(*group, *BOX, "det_id", _rank(order).alias("rank"))
    joined = _spread_join(all_boxes, fate, [*group, *BOX], heavy, "inner")
    dropped = F.col("by").isNotNull() | (F.col("rank") != F.col("leader"))
    return joined.where(dropped).select(
        *group, "det_id",
        F.coalesce(F.col("by.row.det_id"), F.col("leader_id")).alias("suppressed_by"),
        F.when(F.col("by").isNotNull(), geo.iou(F.col("by"), geo.box())).otherwise(F.lit(1.0)).alias("iou"),
    )

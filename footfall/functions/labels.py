"""Class id to name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 80 COCO class names in id order.
COCO_NAMES = """
person, bicycle, car, motorcycle, airplane, bus, train, truck, boat, traffic light,
fire hydrant, stop sign, parking meter, bench, bird, cat, dog, horse, sheep, cow,
elephant, bear, zebra, giraffe, backpack, umbrella, handbag, tie, suitcase, frisbee,
skis, snowboard, sports ball, kite, baseball bat, baseball glove, skateboard, surfboard,
tennis racket, bottle, wine glass, cup, fork, knife, spoon, bowl, banana, apple, sandwich,
orange, broccoli, carrot, hot dog, pizza, donut, cake, chair, couch, potted plant, bed,
dining table, toilet, tv, laptop, mouse, remote, keyboard, cell phone, microwave, oven,
toaster, sink, refrigerator, book, clock, vase, scissors, teddy bear, hair drier, toothbrush
"""


def coco_names() -> list[str]:
    return [n.strip() for n in COCO_NAMES.replace("\n", " ").split(",")]


def labels(spark: SparkSession) -> DataFrame:
    names = F.array(*[F.lit(n) for n in coco_names()])
    return spark.range(1).select(F.posexplode(names).alias("class_id", "label"))


def label_lookup(detections: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds ``label``; ids outside the list are ``unknown``.

    The dimension is broadcast: it is the fixed 80-row list.
    """
    return detections.join(F.broadcast(dim), "class_id", "left").withColumn(
        "label", F.coalesce("label", F.lit("unknown"))
    )

"""The stored layers behind the registered queries.

Exploration, Gold and dashboard queries read tables, not raw payloads.  The
layers of one input folder are built on first use, each from the layer below,
and kept as Parquet for the life of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.operators import gold as g
from footfall.operators import silver as s
from footfall.plans import fixtures
from footfall.session import shared_dir
from footfall.sources.tables import read_table, write_table

_BUILT: dict[tuple[str, str], "Layers"] = {}


def layers(spark: SparkSession, sf_dir: str) -> "Layers":
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = Layers(spark, sf_dir)
    return _BUILT[key]


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = shared_dir(spark, "layers")
        self._paths: dict[str, str] = {}

    def _stored(self, label: str, name: str, make) -> DataFrame:
        if label not in self._paths:
            path = f"{self.root}/{label}"
            write_table(make(), path, name)
            self._paths[label] = path
        return read_table(self.spark, self._paths[label], name)

    def bronze(self) -> DataFrame:
        return self._stored(
            "bronze_raw", "bronze_raw", lambda: fixtures.f1_bronze(self.spark, self.sf_dir))

    def silver(self) -> DataFrame:
        return self._stored(
            "silver_detections", "silver_detections",
            lambda: s.silver_stream(self.bronze(), fixtures.now()))

    def path(self, label: str) -> str:
        """Folder of a stored layer that has been built."""
        return self._paths[label]

    def silver_v2(self) -> DataFrame:
        return self._stored(
            "silver_detections_v2", "silver_detections_v2", lambda: s.silver_batch(self.bronze()))

    def gold(self, name: str) -> DataFrame:
        return self._stored(name, name, lambda: g.GOLD[name](self.silver()))

    def gold_batch(self, name: str) -> DataFrame:
        make = g.GOLD[name]
        if name == "gold_people_per_minute":
            return self._stored("batch_" + name, name, lambda: make(self.silver_v2()))
        return self._stored("batch_" + name, name, lambda: make(self.silver_v2(), "batch"))

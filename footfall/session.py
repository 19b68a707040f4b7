"""Spark session settings the jobs rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "footfall", master: str | None = None, **extra) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


_roots: dict[str, str] = {}  # application id -> folder, where the session names none


def _root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(
            f"spark.checkpoint.dir is not set and the master is {context.master}: "
            "intermediate tables need a folder that all executors share")
    if context.applicationId not in _roots:
        root = tempfile.mkdtemp(prefix="footfall-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _roots[context.applicationId] = root
    return _roots[context.applicationId]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) may leave that setting out: it gets a
    temporary folder, removed when the process ends. On a cluster the call fails.
    """
    return os.path.join(_root(spark), f"{purpose}-{uuid.uuid4().hex}")


def carry_to_workers(*modules: str) -> None:
    """Sends the functions of these modules along with each task, so that workers
    need no copy of this package."""
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])

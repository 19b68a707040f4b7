"""Keyed tables on plain Parquet: append a batch, read the latest row per key.

Each micro-batch writes its changed rows to its own folder ``batch_id=<n>``,
overwriting it when the batch is replayed.  The number belongs to the table, not
to a checkpoint: a query that takes over, or starts again without its checkpoint,
goes on above everything stored (``version``).  The newest row per key wins; a row
with ``is_deleted`` hides its key.  The key decides the partition, so a partition
can be folded on its own: ``compact`` rewrites only partitions that changed.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from footfall.sources.tables import from_folders, to_folders

DELETED = "is_deleted"
BATCH = "batch_id"
KEEP_MARKS = 100


@dataclass
class KeyedTable:
    path: str
    schema: StructType
    key: list[str]
    partitions: list[str] = field(default_factory=list)
    sort: list[str] = field(default_factory=list)

    @property
    def log(self) -> str:
        return f"{self.path}/log"

    @property
    def folded(self) -> str:
        return f"{self.path}/folded"

    def _full(self) -> StructType:
        full = StructType(list(self.schema.fields))
        return full.add(DELETED, BooleanType()).add(BATCH, LongType())

    def create(self, spark: SparkSession) -> "KeyedTable":
        """Makes an empty table unless it exists."""
        for folder in (self.log, self.folded):
            root, fs = _path(spark, folder)
            if not fs.exists(root):
                fs.mkdirs(root)
        return self

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Stores one batch of changed rows; ``is_deleted`` defaults to false."""
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        self._put(rows, f"{self.log}/{BATCH}={batch_id}")

    def _put(self, rows: DataFrame, path: str) -> None:
        hint = rows.hint("rebalance", *self.partitions) if self.partitions else rows.hint("rebalance")
        out = hint.select(*self.schema.fieldNames(), DELETED)
        if self.sort:
            out = out.sortWithinPartitions(*self.partitions, *self.sort)
        to_folders(out, self.partitions).write.mode("overwrite").partitionBy(*self.partitions).parquet(path)

    def _read(self, spark: SparkSession, folder: str) -> DataFrame:
        return from_folders(spark.read.schema(self._full()).parquet(folder), self.partitions)

    def versions(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All stored versions, below batch ``before`` if given."""
        rows = self._read(spark, self.log).unionByName(self._read(spark, self.folded))
        return rows if before is None else rows.where(F.col(BATCH) < before)

    def batches(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        """The changes of the batches in ``(after, upto]``."""
        return self._read(spark, self.log).where((F.col(BATCH) > after) & (F.col(BATCH) <= upto))

    def current(
        self,
        spark: SparkSession,
        before: int | None = None,
        only: Callable[[DataFrame], DataFrame] | None = None,
        within: list[str] | None = None,
    ) -> DataFrame:
        """Latest live row per key.

        ``only`` may drop rows by key columns; it is applied to the stored
        versions, so it prunes before anything is compared.  ``within`` names columns
        that the key determines, ``only`` may add them: rows are spread by them alone, so
        that aggregates by these and further columns need no other shuffle.
        """
        rows = self.versions(spark, before)
        if only:
            rows = only(rows)
        key, columns = self.key, self.schema.fieldNames()
        if within:
            rows = rows.repartition(*within)
            key = [*[c for c in key if c not in within], *within]
            columns = [*columns, *[c for c in within if c not in columns]]
        newest = Window.partitionBy(*key).orderBy(F.desc(BATCH), F.asc(DELETED))
        latest = rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1")
        return latest.where(~F.col(DELETED)).select(*columns)

    def changes(self, spark: SparkSession, files_per_trigger: int | None = None) -> DataFrame:
        """The change log as a stream, deletions included."""
        reader = spark.readStream.schema(self._full())
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return from_folders(reader.parquet(self.log), self.partitions)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Folds the partitions changed by batches up to ``upto``.

        Only for batches that are finished and that every reader of the change
        log has applied.  Old files stay until ``vacuum``; until then a row is
        simply found twice.
        """
        changed = self._read(spark, self.log).where(F.col(BATCH) <= upto)

        def only(rows: DataFrame) -> DataFrame:
            if not self.partitions:
                return rows
            parts = changed.select(*self.partitions).distinct()
            return rows.join(parts, self.partitions, "left_semi")

        live = self.current(spark, before=upto + 1, only=only).withColumn(DELETED, F.lit(False))
        self._put(live, f"{self.folded}/{BATCH}={upto}")

    def vacuum(self, spark: SparkSession) -> None:
        """Removes what the newest fold has replaced, oldest first."""
        folds = _numbered(spark, self.folded)
        if not folds:
            return
        newest = folds[-1]
        done = [n for n in _numbered(spark, self.log) if n <= newest]
        replaced = {part for n in done for part in self._parts(spark, f"{self.log}/{BATCH}={n}")}
        for n in folds[:-1]:
            for part in replaced:
                path, fs = _path(spark, f"{self.folded}/{BATCH}={n}{part}")
                fs.delete(path, True)
        for n in done:
            path, fs = _path(spark, f"{self.log}/{BATCH}={n}")
            fs.delete(path, True)

    def _parts(self, spark: SparkSession, folder: str) -> list[str]:
        """Partition folders below one batch, as relative paths."""
        if not self.partitions:
            return [""]
        root, fs = _path(spark, folder)
        cut = len(root.toUri().getPath())
        found = fs.globStatus(_path(spark, folder + "/*" * len(self.partitions))[0])
        return [s.getPath().toUri().getPath()[cut:] for s in found]

    # ---- which query wrote which numbers

    def _turns(self, spark: SparkSession) -> list[tuple[int, int, int, str]]:
        """(turn, its first number, the query's batch at that number, query), in order."""
        root, fs = _path(spark, f"{self.path}/writers")
        if not fs.exists(root):
            return []
        names = [s.getPath().getName().split("-", 3) for s in fs.listStatus(root)]
        return sorted((int(turn), int(base), int(first), writer) for turn, base, first, writer in names)

    def version(self, spark: SparkSession, writer: str, n: int) -> int:
        """The number under which ``writer`` stores its batch ``n``; the same on a replay.

        A query that was not the last to write begins a new turn."""
        turns = self._turns(spark)
        if turns and turns[-1][3] == writer and turns[-1][2] <= n:
            return turns[-1][1] + n - turns[-1][2]
        used = [*_numbered(spark, self.log), *_numbered(spark, self.folded), *(t[1] for t in turns),
                *(at for at, _ in self._marks(spark))]
        base = max(used, default=-1) + 1
        path, fs = _path(spark, f"{self.path}/writers/{len(turns)}-{base}-{n}-{writer}")
        fs.create(path, True).close()
        return base

    def finished(self, spark: SparkSession, checkpoints: str) -> int:
        """The highest number that no query will write again."""
        turns = self._turns(spark)
        if not turns:
            return max(_numbered(spark, self.log), default=-1)
        _, base, first, writer = turns[-1]
        name, identity = writer.rsplit(".", 1)
        if query_identity(spark, f"{checkpoints}/{name}") != identity:  # that checkpoint is gone
            return max(_numbered(spark, self.log), default=-1)
        return base + committed(spark, f"{checkpoints}/{name}") - first

    # ---- how far this table has applied the batches of the one it derives from

    def mark(self, spark: SparkSession, n: int, source_batch: int) -> None:
        path, fs = _path(spark, f"{self.path}/applied/{n}-{source_batch}")
        fs.create(path, True).close()
        for status in fs.listStatus(path.getParent()):
            if int(status.getPath().getName().split("-")[0]) < n - KEEP_MARKS:
                fs.delete(status.getPath(), False)

    def applied(self, spark: SparkSession, before: int) -> int:
        return max((src for n, src in self._marks(spark) if n < before), default=-1)

    def _marks(self, spark: SparkSession) -> list[tuple[int, int]]:
        root, fs = _path(spark, f"{self.path}/applied")
        if not fs.exists(root):
            return []
        return [tuple(map(int, s.getPath().getName().split("-"))) for s in fs.listStatus(root)]


def _numbered(spark: SparkSession, folder: str) -> list[int]:
    root, fs = _path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(x[len(BATCH) + 1:]) for x in names if x.startswith(f"{BATCH}="))


def committed(spark: SparkSession, checkpoint: str) -> int:
    """Last batch a streaming query has committed; later ones may be replayed."""
    root, fs = _path(spark, f"{checkpoint}/commits")
    if not fs.exists(root):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return max((int(x) for x in names if x.isdigit()), default=-1)


def query_identity(spark: SparkSession, checkpoint: str) -> str | None:
    """What a streaming query keeps in its checkpoint for life; None without a checkpoint."""
    path, fs = _path(spark, f"{checkpoint}/metadata")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system, so any cluster store works."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())

"""Short codes for vectors: product quantisation in integers, by value dictionaries.

**Integers.** A component x becomes ``floor(1024 * x)``; a vector is cut into four equal
consecutive parts. All arithmetic is in integers, so results do not depend on how rows are
dealt to tasks.

**Dictionaries.** A block of vectors has few distinct integers in one dimension. For each
dimension the squared differences of every distinct integer to all entries of the codebook
are tabulated once; the distances of a part are then rows gathered from these tables by
the dictionary code of each vector and added up over the part's dimensions. Nothing is multiplied
per vector.

**Codebooks** start as the parts of the first vectors by id. A round assigns every part to its
nearest entry (ties: the lower index) and sums each entry's parts: a task folds its rows to one
sum an entry, Spark adds those up by entry, and the driver receives one row for each entry, as
many as ``parts * entries`` whatever the data. An entry without parts stays as it is.

Defined results: vectors that are null or hold null or non-finite components are dropped; the
length of vectors is the one most rows have (ties: the longer) among those that ``parts``
divides, rows of another length are dropped as well. Components must lie within 2^17, else the
sums could leave 64 bits, and a ValueError says so. A null id ranks behind all others; rows of
equal id rank by their vectors. Repeated rows are rows. Null labels are one label. Fewer
vectors than entries make smaller codebooks. An empty table gives no rows. Columns other than id,
vector and label may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from footfall.llm.common import written
from footfall.session import carry_to_workers

carry_to_workers(__name__)

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
MAX_COMPONENT = 1 << 17
BLOCK_ROWS = 4_096      # vectors whose distances a task holds at a time
SMALL_LABELS = 100_000  # labels whose sums are broadcast; beyond, they are joined by salted label
SALTS = 32


def part_distances(values: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``values`` (n x d) to the entries ``book`` (k x d).

    One table a dimension: its distinct integers by all entries."""
    largest = max(int(np.abs(values).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.int32 if 4 * largest * largest * values.shape[1] < 1 << 31 else np.int64
    found = np.zeros((len(values), len(book)), kind)
    for d in range(values.shape[1]):
        distinct, code = np.unique(values[:, d], return_inverse=True)
        table = (distinct[:, None] - book[None, :, d]) ** 2
        found += table.astype(kind)[code]
    return found


def nearest(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest entry, the lower index on ties, and its squared distance."""
    apart = part_distances(values, book)
    entry = apart.argmin(1)
    return entry, apart[np.arange(len(values)), entry].astype(np.int64)


def _integers(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, length)


def _blocks(batch: pa.RecordBatch, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for i in range(0, batch.num_rows, BLOCK_ROWS):
        piece = batch.slice(i, BLOCK_ROWS)
        yield piece, _integers(piece.column(piece.num_columns - 1), length)


def _sums(books: np.ndarray, length: int):
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, values in _blocks(batch, length):
                for p in range(parts):
                    own = values[:, p * width:(p + 1) * width]
                    entry, _ = nearest(own, books[p])
                    order = np.argsort(entry, kind="stable")
                    used, first = np.unique(entry[order], return_index=True)
                    total[p, used] += np.add.reduceat(own[order], first)
                    count[p, used] += np.diff(np.append(first, len(order)))
        p, e = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]),
                 pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["part", "entry", "count", "sums"])
    return run


def _coded(books: np.ndarray, length: int):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, values in _blocks(batch, length):
                found = [nearest(values[:, p * width:(p + 1) * width], books[p]) for p in range(parts)]
                codes = np.column_stack([entry for entry, _ in found]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array([row.tobytes().hex() for row in codes], pa.string()),
                     pa.array(sum(apart for _, apart in found))], ["vec_id", "label", "code", "error"])
    return run


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                    label: str = "label", parts: int = PARTS) -> tuple[DataFrame, int]:
    """``vec_id, label, vector`` (doubles) of the rows that are kept, and the vectors' length."""
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(vectors[vec_id].alias("vec_id"), vectors[label].alias("label"),
                          vectors[vector].cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & F.forall("vector", usable))
    length = F.size("vector")
    commonest = rows.where((length > 0) & (length % parts == 0)).groupBy(length.alias("length")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.array_max(F.transform("vector", F.abs))).alias("largest"))
    top = commonest.orderBy(F.desc("rows"), F.desc("length")).limit(1).first()
    if top is None:
        return rows.where("false"), parts
    if top["largest"] > MAX_COMPONENT:
        raise ValueError(f"a component of {top['largest']} is beyond {MAX_COMPONENT}: distances could leave 64 bits")
    return rows.where(length == top["length"]), top["length"]


def fit_codebooks(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts x entries x width) after ``rounds`` rounds over all rows."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    start = np.floor(np.array(first.column(0).to_pylist(), np.float64).reshape(-1, length) * SCALE).astype(np.int64)
    width = length // parts
    books = np.ascontiguousarray(start.reshape(-1, parts, width).transpose(1, 0, 2))
    for _ in range(rounds if len(start) else 0):
        sums = rows.select("vector").mapInArrow(
            _sums(books, length), "part int, entry int, count long, sums array<long>")
        sums = sums.groupBy("part", "entry").agg(
            F.sum("count").alias("count"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums"))
        books = books.copy()
        for part, entry, count, total in sums.collect():
            books[part, entry] = np.array(total, np.int64) // count
    return books


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def code_vectors(rows: DataFrame, length: int, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error``: each part's nearest entry as two hex digits, and the sum of
    the squared distances."""
    if books.shape[1] > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = StructType([StructField("vec_id", kinds["vec_id"]), StructField("label", kinds["label"]),
                         StructField("code", StringType()), StructField("error", LongType())])
    return rows.select("vec_id", "label", "vector").mapInArrow(_coded(books, length), schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over equal labels."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.limit(SMALL_LABELS + 1).count() <= SMALL_LABELS:
        right = F.broadcast(sums.withColumnRenamed("label", "of"))
        return coded.join(right, coded["label"].eqNullSafe(right["of"])).drop("of")
    left = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    right = sums.withColumnRenamed("label", "of").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, left["label"].eqNullSafe(right["of"]) & (left["salt"] == right["part"])).drop("of", "part", "salt")


def compress_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: ``vec_id, code, error, label_error, codebooks_sha256``."""
    rows, length = integer_vectors(vectors, vec_id, vector, label, parts)
    books = fit_codebooks(rows, length, parts, entries, rounds)
    coded = written(code_vectors(rows, length, books), "vector-codes")
    return with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))

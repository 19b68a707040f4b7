"""Small helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.session import carry_to_workers, shared_dir

carry_to_workers(__name__)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Bytes between words become spaces; A-Z becomes a-z; bytes of other letters stay.
WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256))


def word_list(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table below the shared folder: read many times, computed once,
    and safe from lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32(doc_id as text) mod divisor``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % divisor, F.lit(0)).cast("int")


def bounded_sample(df: DataFrame, key: Column, rows: int, total: int, seed: int = 7) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of ``key``.

    A hash threshold needs no sort and picks the same rows in every run. The
    expected number is the bound; all rows are taken where ``total`` is below it.
    """
    if total <= rows:
        return df
    cut = int(rows / total * (1 << 32))
    return df.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 32)) < cut)


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that no helper column can clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def thinned(rows: DataFrame, docs: DataFrame, key: list[str], known: tuple[str, ...]) -> DataFrame:
    """One of the rows ``(row, *key)`` with equal keys: the first by the columns that are not
    ``known`` to be equal. Spark applies the filter before the shuffle as well."""
    others = [F.col("row").getField(c).asc_nulls_first() for c in docs.columns if c not in known]
    first = Window.partitionBy(*key).orderBy(*(others or [F.lit(0)]))
    return rows.withColumn("repeat", F.row_number().over(first)).where("repeat = 1").drop("repeat")

"""Small odd tables that every operator has to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = "lorem ipsum dolor sit amet " * 30_000

#: Nulls in every column, empty and very long texts, ties, repeated rows.
ODD = [
    (1, "one two three four five six", "en", "a"),
    (1, "one two three four five six", "en", "a"),
    (1, "one two three four five six", None, "b"),
    (2, "one two three four five six", "en", "a"),
    (3, None, None, None),
    (None, None, None, None),
    (None, "text without id", "en", "a"),
    (4, "", "de", ""),
    (5, "  \n\t ", "de", "a"),
    (6, "ÉÉ ß ñ 漢字 \U0001F600 ... !!!", "fr", "é"),
    (7, LONG, "en", "a"),
    (8, "x", "en", "c"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    """ODD with extra columns named like those that operators use inside."""
    rows = [(*r, "keep me", i, None) for i, r in enumerate(ODD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, row string, sha int, fingerprint string")


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def rows_of(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]

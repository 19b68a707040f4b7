"""Runs a registered query and its SQL twin and compares rows, names and types."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pandas as pd

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(pdf: pd.DataFrame) -> Counter:
    columns = sorted(pdf.columns)

    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, (pd.Timestamp,)):
            return v.isoformat()
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and v == 0:
            return 0.0
        return v

    return Counter(tuple(plain(v) for v in row) for row in pdf[columns].itertuples(index=False, name=None))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str:
    """Empty string when both results are equal, otherwise what differs."""
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(duck_pdf.columns)}"
    kinds = {c: (spark_pdf[c].dtype.kind, duck_pdf[c].dtype.kind) for c in spark_pdf.columns}
    ours, theirs = _rows(spark_pdf), _rows(duck_pdf)
    if ours == theirs:
        loose = {c: k for c, k in kinds.items() if k[0] != k[1] and set(k) & set("mM")}
        return f"types {loose}" if loose else ""
    only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
    return (f"{sum(ours.values())} vs {sum(theirs.values())} rows; only spark "
            f"{len(only_ours)} {only_ours[:2]}; only sql {len(only_theirs)} {only_theirs[:2]}")

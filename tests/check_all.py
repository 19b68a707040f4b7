"""python tests/check_all.py [sf] [name ...]: every query against its SQL twin."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from footfall.session import build_session  # noqa: E402
from tests.oracle import TESTDATA, compare, connect  # noqa: E402

if __name__ == "__main__":
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    parts = os.environ.get("SHUFFLE_PARTITIONS", "8")
    spark = build_session("check", "local[8]", spark_sql_shuffle_partitions=parts,
                          spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{TESTDATA}/sf{sf}"
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = query(spark, sf_dir).toPandas()
            took = time.time() - start
            if name in sql:
                diff = compare(ours, con.execute(sql[name]).fetchdf())
            else:
                diff = f"rows only: {len(ours)}"
        except Exception as e:  # noqa: BLE001
            took, diff = time.time() - start, f"ERROR {str(e)[:1500]}"
        bad += bool(diff) and not diff.startswith("rows only")
        print(f"{name:32s} {took:6.2f}s {len(ours) if 'ours' in dir() else 0:7d} {diff or 'ok'}", flush=True)
    print("bad:", bad)

"""Command line check of every query against its oracle: ``python tests/check_all.py [sf] [name-part]``."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from stallmetrics.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    part = sys.argv[2] if len(sys.argv) > 2 else ""
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    oracles, bad = oracle_sql(), []
    for name, build in queries().items():
        if part not in name:
            continue
        start = time.time()
        try:
            if name not in oracles:
                print(f"{name}: no oracle, rows={build(spark, folder).count()}")
                continue
            n, diff = differences(build(spark, folder), folder, oracles[name])
            print(f"{'ok ' if not diff else 'BAD'} {name}: {n} rows, {time.time() - start:.1f}s", flush=True)
            for line in diff:
                print("     ", line)
            bad += [name] if diff else []
        except Exception as error:  # report and go on with the next query
            bad.append(name)
            print(f"ERR {name}: {str(error)[:1500]}", flush=True)
    print("failed:", bad)
    spark.stop()

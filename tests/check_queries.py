"""Run queries against their SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tabwright.session import build_session
from tests.oracle import compare


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            verdict = compare(spark, sf_dir, queries[name], sql.get(name))
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += verdict is not None
        mark = "ok" if verdict is None else "FAIL"
        print(f"{mark:4} {name:28} {'sql ' if name in sql else 'rows'} {time.time() - start:6.2f}s {verdict or ''}", flush=True)
    print("failed", failed)


main()

"""`python tests/check_queries.py [name part ...]`: every registered query against its SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import connect, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from metaloom.session import local_session  # noqa: E402


def main(parts):
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls, failed = connect(folder), oracle_sql(), []
    for name, plan in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            df = plan(spark, folder)
            problem = differences(df, db, sqls[name]) if name in sqls else f"(rows only: {df.count()})"
        except Exception as error:  # a broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if not problem else 'FAIL' if not problem.startswith('(') else 'rows'}"
              f" {name} {time.time() - started:.1f}s {problem}", flush=True)
        if problem and not problem.startswith("("):
            failed.append(name)
    print(len(failed), "failed:", *failed)


main(sys.argv[1:])

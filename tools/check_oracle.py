"""Run registered queries next to their SQL and compare the rows: check_oracle.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.compare import compare  # noqa: E402
from millrace.plans import ORACLES, QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem, rows = compare(df, ORACLES.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            problem, rows = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += problem is not None
        verdict = "ok " if problem is None else "BAD"
        print(f"{verdict} {name:32s} {rows:8d} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    sys.exit(1 if bad else 0)

"""``python tests/check_all.py [sf] [name ...]``: every query against its SQL, with times."""

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

import __spark_entry__ as entry
from oracle import difference
from pulsegrid.session import local_session

if __name__ == "__main__":
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session("check", 8)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracle:
                problem = difference(spark, queries[name], oracle[name], folder)
            else:
                problem = None if queries[name](spark, folder).toArrow().num_rows else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} problems")

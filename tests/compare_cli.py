"""Run named queries (or all) against DuckDB: python tests/compare_cli.py [sf_dir] [key ...]"""

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle import compare, duck  # noqa: E402

from forecourt.plans.registry import ORACLE_SQL, QUERIES, load_all  # noqa: E402
from forecourt.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    load_all()
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for key in keys or sorted(QUERIES):
        t0 = time.time()
        df = QUERIES[key](spark, sf_dir)
        if key not in ORACLE_SQL:
            n = df.count()
            print(f"{key:32s} NO-ORACLE rows={n} {time.time()-t0:.1f}s", flush=True)
            continue
        try:
            ok, msg = compare(df, con, ORACLE_SQL[key])
        except Exception as exc:  # report and continue
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{key:32s} {'OK ' if ok else 'BAD'} {msg} {time.time()-t0:.1f}s", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])

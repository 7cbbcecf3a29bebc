"""Run every registered query against its DuckDB oracle and print a report.

usage: python tests/check_oracles.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dayledger.session import local_session  # noqa: E402
from tests.oracle import compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                digits = None if os.environ.get("ORACLE_EXACT") == "1" else 6
                res = compare(df, sqls[name], sf, digits)
            else:
                res = {"rows_spark": df.count(), "oracle": None, "match": None}
        except Exception as exc:  # report and continue
            res = {"error": f"{type(exc).__name__}: {str(exc)[:400]}", "match": False}
        res["sec"] = round(time.time() - t0, 2)
        if res.get("match") is False:
            bad += 1
        print(name, json.dumps(res, default=str), flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())

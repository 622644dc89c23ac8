"""CLI: compare every registered query (or the named ones) against DuckDB.

    python tests/run_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from perilscope.session import local_session  # noqa: E402
from tests.oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    q, o = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(q):
        t = time.time()
        try:
            r = compare(spark, name, q[name], o.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t, 2)
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(json.dumps(r, default=str), flush=True)
    print(f"# {bad} problem(s)")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

"""Run every registered query against its DuckDB oracle, like the driver's check.

Usage: python tests/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as E  # noqa: E402
from ordercraft.checks.compare import compare, duck_connect  # noqa: E402
from ordercraft.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session(8)
    con = duck_connect(sf_dir)
    oracle = E.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        df = E.queries()[name](spark, sf_dir)
        if name not in oracle:
            n = df.count()
            print(json.dumps({"query": name, "rows_spark": n, "oracle": None, "sec": round(time.time() - t0, 1)}))
            continue
        try:
            res = compare(df, con, oracle[name])
        except Exception as exc:  # report and go on
            print(json.dumps({"query": name, "error": str(exc)[:500]}))
            bad += 1
            continue
        ok = res["hash_match"] and res["rows_spark"] == res["rows_oracle"]
        bad += not ok
        out = {"query": name, "ok": ok, "rows_spark": res["rows_spark"], "rows_oracle": res["rows_oracle"],
               "sec": round(time.time() - t0, 1)}
        if not res["columns_match"]:
            out["columns"] = [res["spark_columns"], res["oracle_columns"]]
        print(json.dumps(out), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))

"""Headline timings: order details, staged run and backfill run.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.
The fixture binding (FIXTURES.md section 2) is materialized first as Parquet and
timed on its own (``setup_binding``), since production inputs are plain tables.
Each job then runs end to end:

* ``order_details``: the 31-column details table, written to a no-op sink;
* ``run_staged``: J13 with versioned writes of all four targets;
* ``run_backfill``: J14 likewise, on a fresh store seeded with the same targets.

Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ordercraft.operators.details import order_details  # noqa: E402
from ordercraft.plans.jobs import run_backfill, run_staged  # noqa: E402
from ordercraft.session import ensure_checkpoint_dir, local_session  # noqa: E402
from ordercraft.sources.binding import bind_test_tables  # noqa: E402
from ordercraft.sources.tables import TableStore  # noqa: E402

AS_OF = dt.datetime(2001, 8, 1, 12, 0, 0)
START = dt.datetime(2001, 1, 1)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="ordercraft-bench")
    root = ensure_checkpoint_dir(spark)
    work = tempfile.mkdtemp(prefix="ordercraft-bench-", dir=root if root.startswith("/") else None)
    if root.startswith("file:"):
        work = tempfile.mkdtemp(prefix="ordercraft-bench-", dir=root[len("file:"):])

    timings: dict[str, float] = {}
    t0 = time.time()
    t = bind_test_tables(spark, sf_dir)
    timings["setup_binding"] = time.time() - t0

    t0 = time.time()
    order_details(t).write.format("noop").mode("overwrite").save()
    timings["order_details"] = time.time() - t0

    seeds = {"cit_refil": t.cit_refil, "cit_opportunities": t.cit_opportunities, "cit_opp_errors": t.cit_opp_errors}
    staged_store = TableStore(spark, f"{work}/staged")
    staged_store.seed(seeds)
    t0 = time.time()
    run_staged(t, AS_OF, staged_store)
    timings["run_staged"] = time.time() - t0

    backfill_store = TableStore(spark, f"{work}/backfill")
    backfill_store.seed(seeds)
    t0 = time.time()
    run_backfill(t, START, AS_OF, backfill_store)
    timings["run_backfill"] = time.time() - t0

    headline = timings["order_details"] + timings["run_staged"] + timings["run_backfill"]
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({
        "metric": "order_details+run_staged+run_backfill",
        "value": round(headline, 2),
        "unit": "sec",
        "queries": {k: round(v, 2) for k, v in timings.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

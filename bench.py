"""Benchmark: the milestone job over bronze tables at $BENCH_SF_DIR.

Like the original two-step job, the bronze sources are first written as
tables (the ingest step, timed as ``ingest_bronze``) and the silver job then
reads them.  Each headline query is run to completion into a no-op sink.
Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3; runs of m8_silver, the median is reported;
     the other queries run once after it, on a warm JVM).
"""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators import facts as fx  # noqa: E402
from tidemark.operators import milestones as ml  # noqa: E402
from tidemark.plans.silver_job import milestone_table, milestone_table_by_union, silver_milestones  # noqa: E402
from tidemark.session import get_session, staged  # noqa: E402
from tidemark.sources import bronze as br  # noqa: E402
from tidemark.sources.sinks import replace_table  # noqa: E402

AS_OF = "2000-01-01 00:00:00"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))

    t0 = time.time()
    views = br.from_fixtures(spark, sf_dir)
    names = {}
    for n, df in views.items():
        names[n] = f"bench_bronze_{n}"
        replace_table(spark, df, names[n])
    ingest = time.time() - t0
    b = br.from_tables(spark, names)

    headline = {
        "m8_silver": lambda: silver_milestones(b, AS_OF, first_red_status="AMBER"),
        "m8_silver_literal_union": lambda: ml.silver(staged(milestone_table_by_union(b, AS_OF), "milestones"), AS_OF, "AMBER"),
        "m0j_milestone_input": lambda: fx.milestone_input(b),
        "k1_milestones": lambda: milestone_table(b, AS_OF),
        "m0_po_type": lambda: fx.po_types(b.purchase_orders, b.export_order),
        "m0b_po_lines": lambda: fx.po_line_rollup(b.purchase_order_line),
        "m0c_ct_shipments": lambda: fx.ct_shipment_rollup(b.ct_shipment, b.export_order),
        "a7_stop_times": lambda: fx.with_shipment_facts(fx.po_orders(b), b),
        "a9_multi_key": lambda: fx.tracking_rollup(b.tracking_message),
    }
    times = {}
    for name, build in headline.items():
        runs = []
        for _ in range(repeat if name == "m8_silver" else 1):
            t = time.time()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t)
        times[name] = round(statistics.median(runs), 3)
    times["ingest_bronze"] = round(ingest, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "m8_silver_sec",
        "value": times["m8_silver"],
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "single_pass_speedup_vs_literal_union": round(times["m8_silver_literal_union"] / times["m8_silver"], 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

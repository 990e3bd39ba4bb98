"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query is run
twice into a sink that discards its rows, after one untimed pass that warms the JVM; the
faster run counts. ``process_cut_*`` are whole pipeline runs, from a cut's file to a
published commit, and are run once.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.model import MOVEMENTS
from tidemark.plans import demo, pipeline, reports
from tidemark.plans.queries import QUERIES
from tidemark.session import local_session
from tidemark.sources.scratch import scratch_path
from tidemark.sources.store import Store

HEADLINES = [
    "norm_date", "quarantine", "occurrence_seq", "occurrence_seq_heavy", "movement_key",
    "scd2_history", "cdc_classify", "scd2_new_versions", "merge_counts", "change_log",
    "mart_flow_by_product", "mart_flow_by_fund", "state_summary", "top_clients", "as_of_state",
    "mart_incremental", "natural_key_cdc", "insights",
]


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "16g"), "bench")
    times: dict[str, float] = {}

    demo.published(spark, sf_dir)  # warms up, and is what the queries below read
    demo.landed(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "bench"), MOVEMENTS)
    cuts = demo.write_cuts(spark, sf_dir)
    for cut in cuts:
        times[f"process_cut_{cut.label}"] = seconds(
            lambda cut=cut: pipeline.process_cut(spark, store, cut))
    times["marts_and_quality_gate"] = seconds(lambda: reports.build_and_check(store))
    again = Store(spark, scratch_path(spark, "bench"), MOVEMENTS)
    times["rebuild_in_one_pass"] = seconds(lambda: pipeline.rebuild(spark, again, cuts))

    for name in HEADLINES:
        def run(name=name):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = min(seconds(run), seconds(run))

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_seconds", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One warm-up pass runs first, on the
sf0.01 tables beside the given ones if there are any (it compiles the same plans);
the reported time per query is the best of ``$BENCH_REPEAT`` timed runs.
Prints one JSON line.  Every registered query is timed; ``BENCH_ALL=0`` times the headline ones only.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regiflow.plans import catalog  # noqa: E402
from regiflow.session import get_session  # noqa: E402

# One or more queries per operator family of the reference.
HEADLINE = [
    "normalize_companies", "normalize_establishments", "normalize_partners", "typed_cast_rejects",
    "file_type_routing", "list_page", "search_name", "lookup_key", "lookup_enrich", "content_hash",
    "latest_state", "first_of_type", "register_new_months", "plan_files", "dashboard_summary",
    "dashboard_month", "progress_summary",
    "verify_integrity", "remote_local_diff", "layer_check_raw", "upload_plan", "gap_full",
    "transform_status", "load_summary", "coverage",
    "quality_checkpoint", "profile_columns", "profile_issues", "capacity_estimate",
    "human_bytes", "transfer_rates",
    "train_set_simples", "train_set_size", "classifier_metrics", "rf_simples",
]


def run(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = get_session(f"local[{cpus}]", app="regiflow-bench", shuffle_partitions=2 * cpus)
    qs = catalog.queries()
    names = list(qs) if os.environ.get("BENCH_ALL", "1") == "1" else [n for n in HEADLINE if n in qs]
    small = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    warm = small if os.path.isdir(small) else sf_dir
    for n in names:  # warm-up: JIT, code generation caches
        run(spark, qs[n], warm)
    times = {n: round(min(run(spark, qs[n], sf_dir) for _ in range(repeat)), 3) for n in names}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()

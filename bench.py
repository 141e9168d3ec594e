"""Times headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Every query runs once to warm up and once on the clock, whole result included
(``noop`` sink). Prints one JSON line; ``value`` is the total of the headline queries, and ``queries`` holds
those added later too, so that totals of all rounds compare.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidedesk.plans.catalog import QUERIES  # noqa: E402
from tidedesk.session import build_session  # noqa: E402

HEADLINE = [
    "c9_flags_lineitem", "b_normalize", "c9_quality_flags", "c14_quality_report", "c12_duplicate_customers",
    "c17_profile", "d4_parse_classification", "d7_merge_tiers", "d10_orders_budget", "e2_e3_merge_fallback",
    "e6_repeat_orders", "f1_documents_spike", "f5_documents_duplicates", "f12_anomalies", "f13_documents_sensitivity",
    "g1_check_calls", "g5_cap_steps", "g7_trim_context", "g9_journal",
]

MORE = ["i2_asof_orders", "i3_incident_tickets", "i4_contact_gaps", "i5_ticket_cube", "i6_run_difference", "g4_status_at"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
           # one machine: any folder is shared
           "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE + MORE:
        run(name)
        seconds[name] = round(run(name), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds[n] for n in HEADLINE), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

"""Wall-clock of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every result is computed in full and discarded by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from refiscope import catalog  # noqa: E402
from refiscope.session import local_session  # noqa: E402

HEADLINE = [
    "silver_loans", "market_rates_standardized", "loan_features", "loan_current_state", "loan_distress_history",
    "market_distress_index", "maturity_wall", "portfolio_kpis", "dscr_ltv_summary_statistics", "quality_gate_raw_loans",
    "training_frame", "classifier_evaluation", "feature_stability_psi", "stress_results", "stress_summary",
    "survival_predictions", "concordance_index",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "refiscope-bench")
    queries, _ = catalog.load()
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start-up is not part of a query
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

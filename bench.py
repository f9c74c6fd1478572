"""Time the headline queries: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from checks.session import local_session  # noqa: E402

HEADLINE = [
    "b12_residual_fill",      # whole feature pipeline
    "d10_describe",           # exact quartiles per arm
    "d12_segment_effects",    # treatment effect in every segment of every feature
    "d14_correlation_matrix",
    "d16_numeric_drift",
    "e3_gain_curve",          # one curve point per member
    "e5_auuc",
    "e7_qini_auc",            # four models, tie-collapsed
    "e8_optimal_target",
    "f2_contact_list",        # features to ranked list
    "g2_health_check",
    "h3_greedy_drop",
    "j12_model_comparison",
    "j2_weighted_forests",
    "j3_s_learner",
    "j4_t_learner",
    "j5_tuned_t_learner",
    "j6_x_learner",
    "j8_random_search",       # 20 trials, 40 models
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    QUERIES["d6_value_counts"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM's engine
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total wall time of headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

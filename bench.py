"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma separated
names, or "all"), BENCH_REPEATS (default 3; the median counts, after one warm-up; none for slow queries).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from civicframe.plans import catalog  # noqa: E402
from civicframe.session import local_session, stages  # noqa: E402

HEADLINE = (
    "s1_top_occupations", "s2_party_share_large_gifts", "s3_recipients_most_states", "s4_cross_party_donors",
    "s5_moving_average_top_recipients", "s6_party_totals", "b_survey_screening", "b22_codebook", "c11_key_audit",
    "d8_group_median", "d9_null_aware_rollup", "d21_threshold_curve", "d25_h_index", "e1_running_sum",
    "e2_moving_average_rows", "f6_random_split", "i1_simple_ols", "i5_cluster_robust_ols", "i6_difference_in_means",
    "i9_aa_test", "i23_autocorrelation", "i28_rolling_backtest", "j2_document_term_counts", "j4_tfidf",
    "k2_flag_counts", "k5_gold_evaluation", "l6_pagerank", "m5_points_in_polygons", "m8_rasterize",
    "n2_block_report", "n7_two_cutoffs", "t1_daily_monitor",
    "j12_near_vectors", "j17_item_overlap", "n3_comparison_vectors",
)
SLOW = 20.0  # a query whose first run takes this many seconds is not repeated


def run(spark, fn, directory: str) -> float:
    start = time.perf_counter()
    with stages(spark):
        fn(spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    queries = catalog.queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else (chosen.split(",") if chosen else list(HEADLINE))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "civicframe-bench")
    times: dict[str, float] = {}
    for name in names:
        first = run(spark, queries[name], directory)
        again = [run(spark, queries[name], directory) for _ in range(repeats if first < SLOW else 0)]
        times[name] = round(statistics.median(again) if again else first, 4)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }), flush=True)


if __name__ == "__main__":
    main()
    os._exit(0)

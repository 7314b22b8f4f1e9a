"""Time the headline queries and print one JSON line.

Each query runs once to warm up, then three times into the no-op sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "k01_monthly_revenue", "k03_wait_by_specialty", "k04_no_show_by_specialty", "k05b_satisfaction_by_visit_month",
    "k11_staff_utilisation", "k13_executive_summary", "c02b_full_duplicates", "c08_first_per_key",
    "c20_clean_appointments", "a01_monthly_growth", "a02_month_pair_effects", "a03_churn_features",
    "a09_specialty_scorecard", "a10_clinic_ranking", "w02_patient_rank_pareto", "w05_patient_journey",
    "l06_leakage_summary", "l08_monthly_leakage", "t01_specialty_pl", "r04_segments", "f01_churn_features",
    "e06_recommendations", "b01_kpi_cards",
]


def main() -> None:
    from spark_revenue.plans.catalog import run
    from spark_revenue.session import build_session

    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in wanted:
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            run(spark, path, name).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(path.rstrip("/")), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

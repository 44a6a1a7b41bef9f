"""Benchmark: builds the model tables, then runs the dashboard queries.

Prints one JSON line.  ``build_tables`` is the full refresh from the raw tables
(nine sources to twelve written tables, four models at a time); the queries
run on those tables, as dashboards do.  Every query is run to completion and
all of its rows are consumed (noop sink)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketloom.registry import registered, warehouse  # noqa: E402
from marketloom.session import local_session  # noqa: E402

HEADLINE = [
    "q_cust_1_1", "q_cust_1_2", "q_cust_2_1", "q_cust_2_2", "q_cust_2_3", "q_cust_3_3",
    "q_cust_5_1", "q_cust_5_2", "q_prod_1_1", "q_prod_1_3", "q_prod_2_1", "q_prod_2_2",
    "q_prod_2_4", "q_prod_3_1", "q_prod_5_1", "q_prod_5_3", "q_nov_products",
    "q_sell_1_1", "q_sell_1_2", "q_sell_1_3", "q_sell_2_2", "q_sell_3_1", "q_sell_4_2",
    "q_sell_5_2", "q_seg_customer_matrix", "q_seg_nps", "q_seg_seller_growth",
    "q_seg_category", "decl_cohort_retention", "decl_payment_mix",
    "dq_not_null", "dq_expression_row", "dq_relationships", "dq_revenue_integrity",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus)
    # start the JVM's code paths on the smallest data, outside the timing
    run(spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count())

    times = {}
    t = time.perf_counter()
    warehouse(spark, sf_dir).build_all()
    times["build_tables"] = time.perf_counter() - t

    queries = registered()
    names = HEADLINE if len(sys.argv) == 1 else sys.argv[1:]
    for name in names:
        taken = []
        for _ in range(repeats):
            t = time.perf_counter()
            run(queries[name](spark, sf_dir))
            taken.append(time.perf_counter() - t)
        times[name] = sorted(taken)[len(taken) // 2]
    print(
        json.dumps(
            {
                "metric": "refresh_plus_dashboard_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

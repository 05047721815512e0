"""Benchmark: run the registered queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and print one JSON line with per-query seconds.

Each query is executed in full with the ``noop`` sink (every row computed, nothing collected).
Set BENCH_QUERIES=q1,q2 to run a subset."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart.plans.registry import QUERIES  # noqa: E402
from starmart.session import local_session, release_scratch  # noqa: E402

# The headline set: the flagship fact build, the history/temporal operators, the miner and the checks.
HEADLINE = [
    "fact_sales_full",
    "dim_product",
    "temporal_join_chain",
    "int_sales_join",
    "stg_order_detail",
    "dim_date",
    "ingest_latest_per_key",
    "dedupe_changes",
    "scd2_from_history",
    "scd2_merge",
    "temporal_join_gap_preserving",
    "pit_join_fact_dim",
    "fact_upsert",
    "check_suite_summary",
    "item_support",
    "pair_rules",
    "adaptive_rules",
    "rules_by_territory",
    "frequent_itemsets",
    "ingest_stream_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="starmart-bench")
    # Untimed warm-up: JVM start, first Parquet scan and code generation are engine start-up costs.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("count(*)", "sum(l_quantity)").collect()
    times: dict[str, float] = {}
    builds: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        built = time.time() - t0  # intermediate tables are written while a query is built
        df.write.format("noop").mode("overwrite").save()
        times[name], builds[name] = round(time.time() - t0, 3), round(built, 3)
        print(f"# {name}: {times[name]}s, of which building {builds[name]}s", file=sys.stderr, flush=True)
        release_scratch(spark)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "build": builds,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

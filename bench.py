"""Benchmark the headline queries.

Runs each query over the driver tables in ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.

Each query is executed in full into Spark's ``noop`` sink (every row is
computed, nothing is collected).  ``BENCH_QUERIES=all`` runs every
registered query; a comma list runs those keys.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "rp_valid_sales_view", "rp_monthly_kpis", "dq_reconcile", "rp_store_month", "rp_region_store_channel",
    "rp_department_category", "rp_top_products", "rp_product_vs_own_avg", "rp_department_top3", "rp_store_mom",
    "rp_store_vs_region", "rp_net_revenue", "rp_return_rate", "rp_inventory_priority", "rp_inactive_customers",
    "rp_unsold_products", "rp_daily_performance", "rp_volume_vs_revenue", "rp_net_by_dimensions",
    "join_star", "join_cardinality_check", "agg_group_multi", "agg_global_kpis", "win_running_rows",
    "win_running_range", "win_rank_in_group", "win_top_n", "dq_profile_table", "dq_name_variants",
    "dq_dedup_candidates", "dq_quality_report", "test_relationships", "pf_join_layout", "declared_schema",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from shelfwise import catalog
    from shelfwise.session import local_session

    extra = {"spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus)))}
    for kv in filter(None, os.environ.get("BENCH_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        extra[k.strip()] = v.strip()
    spark = local_session(cpus, app="shelfwise-bench", extra=extra)
    qs = catalog.queries()
    sel = os.environ.get("BENCH_QUERIES", "")
    keys = list(qs) if sel == "all" else ([k for k in sel.split(",") if k] or list(HEADLINE))

    # warm-up: JVM, codegen caches and file listing (not timed)
    qs["rp_monthly_kpis"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

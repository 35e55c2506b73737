"""Benchmark: build the two-batch vault and run the headline queries.

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Every query is executed to completion through Spark's ``noop`` sink (no
collection to the driver). ``vault_build`` covers adaptor, staging and all 25
vault tables over both batches (strict rules); the mart queries then read the
stored vault tables, as mart views read core tables in production.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "state_intervals",
    "transaction_enriched",
    "activation_30d",
    "activation_7d",
    "retention_monthly",
    "user_activity_monthly",
    "metrics_unified",
    "customer_revenue",
    "churn_monthly",
    "arpu_monthly",
    "ltv_monthly",
    "limit_violations",
    "dq_results",
    "merge_intervals_max",
    "asof_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from hvault.plans.pipeline import vault_store
    from hvault.plans.queries import QUERIES
    from hvault.session import local_session

    spark = local_session(cpus)
    times: dict[str, float] = {}

    t = time.time()
    store = vault_store(spark, sf_dir)
    store.vault(2, set(store._done[0]))
    times["vault_build"] = round(time.time() - t, 3)

    t = time.time()
    ref = vault_store(spark, sf_dir, "reference")
    ref.vault(2, set(ref._done[0]))
    times["vault_build_reference"] = round(time.time() - t, 3)

    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()

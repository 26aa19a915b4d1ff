"""Headline queries on a stored warehouse. Prints one JSON line.

The star tables are written once (ledger by quarter, sorted by material) and the
marts refreshed, as a deployment would; both are reported apart from the queries.
Each query is run once to warm up and then timed; the best of the timed runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plantline.plans import analytics, comparisons, loading, marts, quality, trends  # noqa: E402
from plantline.risk import features  # noqa: E402
from plantline.session import build_session, scratch_path  # noqa: E402
from plantline.sources.star import AS_OF, StarSchema  # noqa: E402
from plantline.sources.warehouse import Warehouse, current  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
DECLARED = (date(2000, 1, 1), date(2001, 7, 1))
BALANCE = {"material_id": 42, "since": date(2000, 10, 1)}
SCORECARD = {"since": date(1999, 1, 1)}


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
        },
    )
    star = StarSchema(spark, FOLDER)
    root, mart_root = scratch_path(spark, "warehouse"), scratch_path(spark, "marts")
    load_sec = timed(lambda: Warehouse.load(star, spark, root, DECLARED))
    stored = Warehouse(spark, root, list(star), DECLARED)
    load_sec += timed(stored.refresh_totals)
    refresh_sec = timed(lambda: loading.refresh_marts(stored, spark, mart_root, "1", AS_OF))
    mart = current(spark, mart_root, "production_at_risk")

    plans = {
        "b1_running_balance_formatted": lambda: comparisons.material_balance_formatted(stored, AS_OF, **BALANCE),
        "b1_running_balance": lambda: comparisons.material_balance(stored, AS_OF, declared=DECLARED, **BALANCE),
        "b2_scorecard_correlated": lambda: comparisons.scorecard_correlated(stored, AS_OF, **SCORECARD),
        "b2_scorecard": lambda: comparisons.scorecard(stored, AS_OF, **SCORECARD),
        "b3_bom_shortage_correlated": lambda: comparisons.bom_shortage_correlated(stored),
        "b3_bom_shortage_mart": lambda: comparisons.bom_shortage_mart(stored, mart=mart),
        "mart_supplier_performance": lambda: marts.supplier_performance(stored),
        "mart_inventory_health": lambda: marts.inventory_health(stored, AS_OF),
        "mart_production_at_risk": lambda: marts.production_at_risk(stored),
        "q1_supplier_trajectory": lambda: trends.supplier_trajectory(stored),
        "q2_inventory_turnover": lambda: analytics.inventory_turnover(stored, AS_OF),
        "q3_delayed_po_impact": lambda: analytics.delayed_po_impact(stored, AS_OF),
        "q4_bom_production_risk": lambda: analytics.bom_production_risk(stored),
        "window_rolling_burn": lambda: comparisons.all_burn_rates(stored),
        "dq_suite": lambda: quality.suite(stored, AS_OF),
        "risk_supplier_features": lambda: features.supplier_features(stored),
        "risk_material_features": lambda: features.material_features(stored),
    }
    seconds = {}
    for key, plan in plans.items():
        consume(plan())
        seconds[key] = round(min(timed(lambda p=plan: consume(p())) for _ in range(RUNS)), 4)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries on stored tables, warm, total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(FOLDER).name.removeprefix("sf"), "cpus": int(CPUS),
        "load_sec": round(load_sec, 2), "mart_refresh_sec": round(refresh_sec, 2),
    }))


if __name__ == "__main__":
    main()

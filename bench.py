"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import all_checks  # noqa: E402
from checks.core import runner  # noqa: E402
from coinloft.session import build  # noqa: E402

HEADLINE = [
    "silver_clients", "silver_transactions", "silver_account_balances", "dedup_latest", "ledger_balance", "balance_change",
    "dim_client", "dim_product", "dim_branch", "fact_transactions_daily", "fact_account_balance_daily",
    "fact_loan_performance", "client_360_view", "product_performance_summary", "branch_performance_dashboard",
    "financial_kpi_summary", "data_quality_dashboard", "aq_monthly_activity", "aq_product_effectiveness",
    "aq_branch_comparison", "aq_monthly_clients", "aq_segmentation", "aq_cards", "gq_volume_by_segment", "agg_percentile",
    "outliers_iqr", "profile_columns", "profile_text", "dq_rules_eval", "incremental_load", "churn_features",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(
        "coinloft-bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="coinloft-bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    all_checks()
    run = lambda name: runner(name)(spark, folder).write.format("noop").mode("overwrite").save()
    run("silver_transactions")  # start the JVM and its compilers
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

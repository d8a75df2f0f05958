"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerflow.entries.registry import QUERIES
from ledgerflow.session import local_session

HEADLINE = (
    "dim_item dim_partner dim_employees dim_warehouse dim_date "
    "fact_sales fact_goals fact_purchases fact_accounts_receivable fact_inventory "
    "fact_daily_inventory_movement int_finance_journal_entries int_finance_payments "
    "int_sales_fiscal_documents int_sales_fiscal_lines int_purchases_fiscal_lines "
    "revenue_by_month_channel goals_vs_sales weighted_unit_rates document_trace receivables_ageing "
    "days_without_movement balance_as_of load_upsert_watermark load_upsert_composite load_via_header "
    "load_append_cutoff_day merge_upsert latest_per_key join_temporal_range join_interval_overlap "
    "dq_double_entry dq_run_results audit_issues stream_closed_day_flow stream_upsert_latest"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in ("dim_warehouse", "dim_date", "dim_item", "fact_purchases", "fact_sales"):  # start the JVM's hot paths
        run(name)
    chosen = sys.argv[1:] or HEADLINE
    seconds = {name: run(name) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR selects the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from silverlode.plans import catalog_files
from silverlode.plans.catalog import QUERIES
from silverlode.plans.frames import Frames
from silverlode.session import local_session

HEADLINE = [
    "b2s_1_hr_bronze_to_silver",
    "b2s_2_payroll_bronze_to_silver",
    "b2s_7_joined_domains",
    "b2s_8_employees_sheet",
    "dq_1_employee_issues",
    "dq_2_payment_issues",
    "dq_9_rule_engine",
    "dq_10_route_by_action",
    "tm_1_upsert_columns",
    "tm_8_change_feed",
    "gd_1_employee_payroll_summary",
    "gd_2_department_payroll_analytics",
    "gd_3_monthly_payroll_trends",
    "gd_4_payment_method_analysis",
    "gov_11_completeness_gate",
    "gov_17_lineage",
    "gov_25_sla_evaluation",
    "gov_28_cost_by_cost_center",
    "gov_32_alert_evaluation",
    "gov_33_alert_cooldown",
    "gov_34_retry_decisions",
    "fi_1_generate_manifest",
    "fi_1_manifest_from_archives",
    "fi_3_archive_summary",
    "fi_8_unzip_and_place",
    "st_2_incremental_upsert",
    "st_4_hourly_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench")
    QUERIES["dq_3_cleansing_impact"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    # Deliveries are staged before the clock starts; the queries below read them.
    tables = Frames(spark, sf_dir)
    catalog_files.delivered(tables)
    catalog_files.delivered_workbooks(tables)
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

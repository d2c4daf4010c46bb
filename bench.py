"""Time the headline queries and print one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowtide.session import local_session
from flowtide.workload.queries import QUERIES

HEADLINE = [
    "ticket_silver", "ticket_triage_counts", "ticket_kpis_week", "ticket_kpis_month", "ticket_page",
    "ticket_escalation_monthly", "ticket_transitions", "snapshot_replay", "import_log", "snapshot_status_counts",
    "backfill_merge_latest", "ingest_files", "ingest_stream", "json_extract",
    "issue_silver", "issue_transitions", "issue_fact", "issue_kpis_week", "issue_kpis_by_project",
    "created_closed_monthly", "backlog_monthly", "backlog_by_assignee", "avg_median_close_monthly",
    "volume_3m_ma", "lifecycle_3m", "oldest_open", "pct_closed_over_threshold", "summary", "overview_series",
    "trends", "lead_time_histogram", "assignee_table", "assignee_month_matrix", "assignee_week_flow",
    "open_issue_list", "drill_rollup", "date_dim", "by_calendar", "volume_per_working_day",
    "column_profile", "describe_profile", "pk_violations", "fk_coverage", "freshness",
]


def run(spark, name, sf_dir):
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    for name in ("ticket_triage_counts", "issue_kpis_by_project"):
        run(spark, name, sf_dir)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(spark, name, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

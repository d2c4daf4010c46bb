"""Fact views: current tables with labels, durations and buckets, never stored."""

from pyspark.sql import DataFrame, functions as F

from flowtide import codes
from flowtide.functions import dates, labels
from flowtide.functions.periods import as_date
from flowtide.functions.text import or_unassigned


def fact_tickets(tickets: DataFrame, waiting=codes.WAITING_CODES, passed=codes.PASSED_CODES) -> DataFrame:
    return tickets.withColumns({
        "status_label": labels.status_label("status"),
        "triage_status": labels.triage_status("status", "denied_triage", waiting, passed),
    })


def fact_issues(issues: DataFrame, as_of, *, projects=(), strict=False) -> DataFrame:
    """Issue fact seen from ``as_of``; ``projects`` are the project names shown on their own."""
    closed, created = F.col("closed_at"), F.col("created_at")
    days_to_close = dates.days_inclusive(created, closed)
    return issues.withColumns({
        "state_label": labels.state_label("state_type", strict),
        "priority_label": labels.priority_label("priority"),
        "days_to_start": dates.days_inclusive(created, F.col("started_at")),
        "days_to_close": days_to_close,
        "age_days": F.when(closed.isNull(), dates.days_inclusive(created, F.lit(as_date(as_of)))),
        "project_group": labels.project_group("project_name", projects),
        "lead_time": labels.lead_time(days_to_close),
        "lead_time_sort": labels.lead_time_sort(days_to_close),
        "assignee": or_unassigned("assignee_name", codes.UNASSIGNED),
    })

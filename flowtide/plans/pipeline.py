"""The whole run in order: ingest, rebuild, facts, reports."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtide import codes, schemas
from flowtide.functions.periods import add_months, as_date
from flowtide.operators import calendar, current, facts, quality, series
from flowtide.plans import reports
from flowtide.sources import ingest, readers, sinks

CALENDAR = ("2025-01-01", "2035-12-31")
REBUILDS = {
    "tickets": (ingest.TICKETS, current.current_tickets, current.ticket_load_report),
    "issues": (ingest.ISSUES, current.current_issues, current.issue_load_report),
}


def build_id(loaded_at) -> str:
    return f"{loaded_at:%Y%m%dT%H%M%SZ}"


def report_tables(tickets: DataFrame, issues: DataFrame, dim: DataFrame, as_of, excluded=()) -> dict[str, DataFrame]:
    """Every report table by name, none of them computed yet."""
    as_of = as_date(as_of)
    year = add_months(as_of, -12)
    return {
        "summary_week": reports.summary(tickets, issues, as_of, "week"),
        "summary_month": reports.summary(tickets, issues, as_of, "month"),
        "ticket_page": reports.ticket_page(tickets, as_of),
        "escalation": series.escalation_rate_series(tickets),
        "overview": reports.overview_series(issues, as_of),
        "trends": reports.trends(issues, as_of),
        "project_volume": reports.project_volume(issues),
        "project_close_times": reports.project_close_times(issues),
        "lead_time_histogram": reports.lead_time_histogram(issues),
        "assignees": reports.assignee_table(issues, year, as_of, excluded),
        "assignee_monthly": reports.assignee_monthly(issues, excluded),
        "assignee_matrix": reports.assignee_matrix(issues, as_of, excluded=excluded),
        "assignee_backlog": reports.assignee_backlog(issues, as_of, excluded=excluded),
        "assignee_weeks": reports.assignee_week_flow(issues, excluded=excluded),
        "open_issues": reports.open_issue_list(issues),
        "oldest_open": reports.tooltip_oldest(issues),
        "priority_mix": reports.priority_mix(issues),
        "backlog_age": reports.backlog_age(issues),
        "drill": series.drill(issues, dim),
    }


def open_facts(spark: SparkSession, out, as_of, *, projects=()) -> dict[str, DataFrame]:
    """The facts over the newest current tables and the calendar."""
    return {
        "fact_tickets": facts.fact_tickets(sinks.read_table(spark, f"{out}/current/tickets")),
        "fact_issues": facts.fact_issues(sinks.read_table(spark, f"{out}/current/issues"), as_of, projects=projects),
        "date_dim": calendar.report_columns(sinks.read_table(spark, f"{out}/calendar"), as_of),
    }


def register_views(spark: SparkSession, out, as_of, *, projects=()) -> None:
    """Facts and calendar as temporary views for ``spark.sql``."""
    for name, df in open_facts(spark, out, as_of, projects=projects).items():
        df.createOrReplaceTempView(name)


def run_pipeline(spark: SparkSession, raw, out, as_of, loaded_at, *, projects=(), excluded=(),
                 date_range=CALENDAR, multi_line=True, names=None, retention_days=codes.RETENTION_DAYS) -> None:
    """Load new snapshots of both feeds, rebuild the current tables, write the report tables.

    ``raw`` holds ``tickets/`` and ``issues/`` folders, ``out`` the results;
    both must be reachable by all executors. ``names`` picks report tables, all by default.
    Each load is checked: what came against the sidecars, the log against the history, keys, and the age of the newest
    load, as tables below ``checks/``. Snapshots that have been loaded go from ``raw`` after ``retention_days``, judged by
    ``as_of``; None keeps them.
    """
    log, build = f"{out}/import_log", build_id(loaded_at)
    for name, (feed, rebuild, load_report) in REBUILDS.items():
        path = f"{out}/history/{name}"
        ingest.load_files(spark, feed, f"{raw}/{name}", path, log, loaded_at, multi_line=multi_line)
        history = sinks.read_or_empty(spark, path, sinks.history_schema(feed.schema))
        quality.require_rows(history, f"{name} history")
        logged = sinks.read_or_empty(spark, log, schemas.IMPORT_LOG).filter(F.col("source") == name)
        arrived = sinks.arrivals(spark, f"{log}_arrivals").filter(F.col("source") == name)
        loads = quality.load_reconciliation(readers.read_manifest(spark, f"{raw}/{name}"), arrived, logged, history)
        sinks.overwrite_table(loads, f"{out}/checks/{name}_loads", build)
        sinks.overwrite_table(rebuild(history), f"{out}/current/{name}", build)
        sinks.overwrite_table(
            load_report(sinks.read_table(spark, f"{out}/current/{name}")), f"{out}/load_report/{name}", build)
        made = sinks.read_table(spark, f"{out}/current/{name}")
        sinks.overwrite_table(quality.key_violations(made, "id"), f"{out}/checks/{name}_keys", build)
        if retention_days is not None:
            listed = readers.list_files(spark, f"{raw}/{name}", name)
            sinks.drop_expired(spark, listed, logged, as_of, retention_days)
    sinks.overwrite_table(calendar.date_dim(spark, *date_range).coalesce(1), f"{out}/calendar", build)
    current_tables = {name: sinks.read_table(spark, f"{out}/current/{name}") for name in REBUILDS}
    dim = sinks.read_table(spark, f"{out}/calendar")
    sinks.overwrite_table(quality.freshness(current_tables, as_of, dim), f"{out}/checks/freshness", build)

    tables = open_facts(spark, out, as_of, projects=projects)
    made = report_tables(tables["fact_tickets"], tables["fact_issues"], tables["date_dim"], as_of, excluded)
    for name in names or made:
        sinks.overwrite_table(made[name], f"{out}/reports/{name}", build)

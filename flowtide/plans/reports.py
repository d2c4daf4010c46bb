"""Report tables, one per visual of the report pages."""

from pyspark.sql import DataFrame, functions as F

from flowtide import codes
from flowtide.functions import dates, labels
from flowtide.functions.periods import as_date, period_bounds
from flowtide.functions.text import is_open, is_set
from flowtide.operators import cube, measures as m, series
from flowtide.operators.joins import exclude_values, last_months, ranked_table


def summary(tickets: DataFrame, issues: DataFrame, as_of, period="week") -> DataFrame:
    """One row with the headline figures of both facts."""
    p = period_bounds(as_of, period)
    of_issues = m.measure_table(issues, [f(p) for f in m.ISSUE_MEASURES])
    of_tickets = m.measure_table(tickets, [m.entered_triage(p), m.passed_triage(p), m.escalation_rate(p)])
    of_issues = of_issues.select(*[F.col(c).alias(f"issue_{c}") for c in of_issues.columns])
    of_tickets = of_tickets.select(*[F.col(c).alias(f"ticket_{c}") for c in of_tickets.columns])
    both = of_issues.unionByName(of_tickets, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def ticket_page(tickets: DataFrame, as_of, period="week", days=codes.WAIT_THRESHOLD_DAYS) -> DataFrame:
    """Figures of the ticket page in one row."""
    p = period_bounds(as_of, period)
    return m.measure_table(
        tickets, [*[f(p) for f in m.TICKET_MEASURES], m.waited_longest(p), m.waiting_over(p, days)])


def overview_series(issues: DataFrame, as_of, months=4, days: DataFrame | None = None) -> DataFrame:
    """Created and closed per month with the backlog at its end, for the latest months.

    ``days`` is the fact's :func:`flowtide.operators.cube.daily_cube`, if there is one already.
    """
    days = cube.daily_cube(issues) if days is None else days
    flow = last_months(cube.volume(days), "month", months, as_of)
    backlog = last_months(cube.backlog(days, as_of), "month", months, as_of)
    return backlog.join(flow, "month", "full").select(
        "month", F.coalesce("created", F.lit(0)).alias("created"),
        F.coalesce("closed", F.lit(0)).alias("closed"), F.coalesce("open", F.lit(0)).alias("open"))


def trends(issues: DataFrame, as_of, days: DataFrame | None = None) -> DataFrame:
    """Trailing volumes, lifecycle averages and close statistics per month; ``days`` as in :func:`overview_series`."""
    days = cube.daily_cube(issues) if days is None else days
    roles = [cube.CREATED, cube.CLOSED]
    volume = series.trailing_volume(cube.volume(days), roles, end=as_of).withColumnsRenamed(
        {r: f"{r}_3m" for r in roles})
    stages = cube.lifecycle(days, end=as_of)
    closing = cube.close_stats(days, [["month"]], ["month"]).drop("grouping", "closed")
    return volume.join(stages, "month", "left").join(closing, "month", "left")


def project_volume(issues: DataFrame) -> DataFrame:
    return m.volume(issues, ["project_group"])


def lead_time_histogram(issues: DataFrame) -> DataFrame:
    """Closed issues per lead-time bucket, in bucket order."""
    return m.volume(issues.filter(is_set("lead_time")), ["lead_time", "lead_time_sort"]).orderBy("lead_time_sort")


def project_close_times(issues: DataFrame) -> DataFrame:
    """Average and median days to close per project group, slowest first."""
    return ranked_table(m.close_stats(issues, ["project_group"]), "avg_days_to_close", ["project_group"])


def assignee_table(issues: DataFrame, start, end, excluded=()) -> DataFrame:
    """Flow per assignee inside a date range beside the backlog they hold now."""
    inside = lambda role: F.col(role).between(F.lit(as_date(start)), F.lit(as_date(end)))
    closed = inside("closed_at")
    table = exclude_values(issues, "assignee", excluded).groupBy("assignee").agg(
        F.count_if(inside("created_at")).alias("created"),
        F.count_if(closed).alias("closed"),
        F.count_if(is_open()).alias("open"),
        F.avg(F.when(closed, F.col("days_to_close"))).alias("avg_days_to_close"),
        F.count_if(inside("created_at") & F.col("is_incident")).alias("incidents"),
    )
    return ranked_table(table, "created", ["assignee"])


def assignee_monthly(issues: DataFrame, excluded=()) -> DataFrame:
    """Created issues per assignee and month."""
    return series.role_volume(
        exclude_values(issues, "assignee", excluded), {"created": "created_at"}, "month", ["assignee"])


def assignee_matrix(issues: DataFrame, as_of, months=3, excluded=()) -> DataFrame:
    """Assignee rows, month columns, created and closed in the cells."""
    flow = series.created_closed_series(exclude_values(issues, "assignee", excluded), "month", ["assignee"])
    shown = series.month_range(as_of, months)
    cells = [
        F.sum(F.when(F.col("month") == F.lit(d), F.col(c))).alias(f"{c}_{d:%Y_%m}")
        for d in shown for c in ("created", "closed")
    ]
    return last_months(flow, "month", months, as_of).groupBy("assignee").agg(*cells)


def assignee_backlog(issues: DataFrame, as_of, months=3, excluded=()) -> DataFrame:
    backlog = series.backlog_series(exclude_values(issues, "assignee", excluded), as_of, by=["assignee"])
    return last_months(backlog, "month", months, as_of)


def tooltip_oldest(issues: DataFrame) -> DataFrame:
    return m.oldest_open(issues, "identifier", "title")


def tooltip_weekly(issues: DataFrame, assignee) -> DataFrame:
    """Created and closed per week of one assignee."""
    flow = series.created_closed_series(issues.filter(F.col("assignee") == assignee), "week")
    return flow.select(dates.year_week("week").alias("year_week"), "created", "closed")


def open_issue_list(issues: DataFrame) -> DataFrame:
    """Open issues, oldest first."""
    return issues.filter(is_open()).select(
        "identifier", "title", "assignee", "project_group", "created_at", "age_days", "priority_label"
    ).orderBy(F.desc("age_days"), "identifier")


def priority_mix(issues: DataFrame) -> DataFrame:
    by = [dates.month_start("created_at").alias("month"), "priority_label"]
    return m.volume(issues.filter(is_set("created_at")), by)


def backlog_age(issues: DataFrame, by="project_group") -> DataFrame:
    """Open issues per group and age bucket."""
    aged = issues.filter(is_open()).select(
        by, labels.lead_time("age_days").alias("age"), labels.lead_time_sort("age_days").alias("age_sort"))
    return m.volume(aged, [by, "age", "age_sort"])


def assignee_week_flow(issues: DataFrame, weeks=None, excluded=()) -> DataFrame:
    """Created and closed per assignee and week; ``weeks`` spreads chosen weeks over columns."""
    flow = series.created_closed_series(exclude_values(issues, "assignee", excluded), "week", ["assignee"])
    flow = flow.select("assignee", dates.year_week("week").alias("year_week"), "created", "closed")
    if weeks is None:
        return flow
    return flow.groupBy("assignee").pivot("year_week", list(weeks)).agg(
        F.sum("created").alias("created"), F.sum("closed").alias("closed"))

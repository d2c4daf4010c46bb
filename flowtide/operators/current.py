"""Current tables: one row per ticket or issue, rebuilt from the whole history."""

from pyspark.sql import Column, DataFrame, functions as F

from flowtide import codes
from flowtide.functions.labels import closed_at
from flowtide.functions.text import contains_flag, iso_date, matched, right, same_text, starts_with
from flowtide.operators.history import ORDER, latest_version, with_state_dates


def not_suffix(col, suffixes=codes.EXCLUDED_GROUP_SUFFIXES) -> Column:
    """True unless the number ends in one of the suffixes; a missing number is kept."""
    c = F.col(col)
    text = c.cast("string")
    ends = F.lit(False)
    for n in sorted({len(s) for s in suffixes}):
        ends = ends | right(text, n).isin([s for s in suffixes if len(s) == n])
    return c.isNull() | ~ends


def drop_suffix(df: DataFrame, col, suffixes=codes.EXCLUDED_GROUP_SUFFIXES) -> DataFrame:
    return df.filter(not_suffix(col, suffixes))


def drop_where_all(df: DataFrame, conditions) -> DataFrame:
    """Drop rows where all conditions hold, by SQL's three-valued logic."""
    both = conditions[0]
    for c in conditions[1:]:
        both = both & c
    return df.filter(~both)


def prune(df: DataFrame, columns) -> DataFrame:
    return df.select(*columns)


def current_tickets(history: DataFrame, *, suffixes=codes.EXCLUDED_GROUP_SUFFIXES,
                    waiting=codes.WAITING_CODES, passed=codes.PASSED_CODES,
                    order=ORDER, filter_after=False) -> DataFrame:
    """One row per ticket: newest kept version, first waiting and passed day, regression."""
    columns = ["status", "created_at", "updated_at", "product_id"]
    columns += [c for c in ("_loaded_at",) if c in history.columns]
    rows = with_state_dates(
        history, not_suffix("group_id", suffixes), columns,
        order=order, waiting=waiting, passed=passed, filter_after=filter_after)
    return rows.select(
        "id",
        "status",
        iso_date("created_at").alias("created_at"),
        iso_date("updated_at").alias("updated_at"),
        "product_id",
        iso_date("first_waiting").alias("first_waiting_at"),
        iso_date("first_passed").alias("first_passed_at"),
        matched("regressed_on").alias("denied_triage"),
        iso_date("regressed_on").alias("denied_triage_at"),
        *columns[4:],
    )


def excluded_issue(prefix=codes.EXCLUDED_IDENTIFIER_PREFIX, team=codes.EXCLUDED_TEAM):
    return [starts_with("identifier", prefix), same_text("team_name", team)]


def current_issues(history: DataFrame, *, excluded=None, order=ORDER, filter_after=False,
                   incident_word=codes.INCIDENT_WORD) -> DataFrame:
    """One row per issue: newest kept version with dates, closing day and incident flag."""
    excluded = excluded_issue() if excluded is None else excluded
    columns = ["identifier", "title", "state_name", "state_type", "priority", "created_at", "started_at",
               "completed_at", "canceled_at", "project_name", "assignee_name", "labels", "trashed"]
    columns += [c for c in ("_loaded_at",) if c in history.columns]
    if filter_after:
        rows = drop_where_all(latest_version(history, order=order, columns=columns + ["team_name"]), excluded)
    else:
        rows = latest_version(drop_where_all(history, excluded), order=order, columns=columns)
    completed = iso_date("completed_at")
    return rows.select(
        "id", "identifier", "title", "state_name", "state_type", "priority",
        iso_date("created_at").alias("created_at"),
        iso_date("started_at").alias("started_at"),
        completed.alias("completed_at"),
        closed_at(completed, iso_date("canceled_at")).alias("closed_at"),
        "project_name", "assignee_name", "labels", "trashed",
        contains_flag("labels", incident_word).alias("is_incident"),
        *columns[13:],
    )


def ticket_load_report(tickets: DataFrame, waiting=codes.WAITING_CODES, passed=codes.PASSED_CODES) -> DataFrame:
    status = F.col("status")
    return tickets.agg(
        F.count("*").alias("total"),
        F.count_if(status.isin(list(waiting))).alias("waiting"),
        F.count_if(status.isin(list(passed))).alias("passed"),
        F.count_if("denied_triage").alias("denied"),
    )


def issue_load_report(issues: DataFrame) -> DataFrame:
    state = F.col("state_type")
    return issues.agg(
        F.count("*").alias("total"),
        F.count_if(state == "started").alias("started"),
        F.count_if(state == "completed").alias("completed"),
        F.count_if(state.isin("cancelled", "canceled")).alias("cancelled"),
        F.count_if("is_incident").alias("incidents"),
    )

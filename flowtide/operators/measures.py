"""Flow measures: current and previous period side by side, in one scan.

A measure is a pair of aggregate columns plus the kind of change shown between
them. ``measure_table`` puts any number of measures in a single aggregation, so
a page of figures costs one pass and one small shuffle.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from flowtide import codes
from flowtide.functions import dates
from flowtide.functions.periods import Period, period_bounds
from flowtide.functions.text import between_dates, is_open, is_set, open_as_of

RATIO, DIFFERENCE = "ratio", "difference"


@dataclass(frozen=True)
class Measure:
    name: str
    current: Column
    previous: Column | None = None
    change: str | None = None


def _change(m: Measure) -> Column:
    now, before = F.col(m.name), F.col(f"{m.name}_prev")
    return F.try_divide(now - before, before) if m.change == RATIO else now - before


def measure_table(fact: DataFrame, measures, by=(), blank_zero=()) -> DataFrame:
    """All measures in one aggregation; ``blank_zero`` names counts shown as NULL when zero."""
    sums, names = [], []
    for m in measures:
        for name, value in ((m.name, m.current), (f"{m.name}_prev", m.previous)):
            if value is not None:
                names.append(name)
                sums.append((F.when(value != 0, value) if m.name in blank_zero else value).alias(name))
    changes = [_change(m).alias(f"{m.name}_change") for m in measures if m.change]
    return fact.groupBy(*by).agg(*sums).select(*by, *names, *changes)


def _both(name, value, p: Period, change=None) -> Measure:
    """The same value over the period and the one before."""
    return Measure(name, value(p.start, p.end), value(p.prev_start, p.prev_end), change)


def _count_in(role, extra=None):
    def value(start, end):
        inside = between_dates(role, start, end)
        return F.count_if(inside if extra is None else inside & extra)
    return value


# Tickets.

def tickets_created(p):
    return _both("created", _count_in("created_at"), p, RATIO)


def entered_triage(p):
    return _both("waiting", _count_in("first_waiting_at"), p, RATIO)


def passed_triage(p):
    return _both("passed", _count_in("first_passed_at"), p, RATIO)


def escalated(p):
    return _both("escalated", _count_in("created_at", is_set("first_waiting_at")), p)


def escalation_rate(p):
    """Share of created tickets that ever waited; the change is in points."""
    over, under = _count_in("created_at", is_set("first_waiting_at")), _count_in("created_at")
    return _both("escalation_rate", lambda a, b: F.try_divide(over(a, b), under(a, b)), p, DIFFERENCE)


def triage_denied(p):
    return _both("denied", _count_in("denied_triage_at", F.col("denied_triage")), p, DIFFERENCE)


def waited_longest(p):
    """Days since the earliest first wait among waiting tickets; 0 on the first day."""
    since = F.min(F.when(F.col("triage_status") == "Waiting", F.col("first_waiting_at")))
    return Measure("waited_longest", F.datediff(F.lit(p.as_of), since))


def waiting_over(p, days=codes.WAIT_THRESHOLD_DAYS):
    waited = dates.days_between("first_waiting_at", F.lit(p.as_of))
    return Measure("waiting_over", F.count_if((F.col("triage_status") == "Waiting") & (waited > days)))


# Issues.

def issues_created(p):
    return _both("created", _count_in("created_at"), p, RATIO)


def issues_closed(p):
    return _both("closed", _count_in("closed_at"), p, RATIO)


def open_at(p):
    return _both("open", lambda start, end: F.count_if(open_as_of("created_at", "closed_at", end)), p, DIFFERENCE)


def incidents(p):
    return _both("incidents", _count_in("created_at", F.col("is_incident")), p, DIFFERENCE)


def avg_days_to_close(p):
    return _both(
        "avg_days_to_close",
        lambda a, b: F.avg(F.when(between_dates("closed_at", a, b), F.col("days_to_close"))), p, DIFFERENCE)


def _oldest(is_counted, d):
    return F.max(F.when(is_counted, dates.days_between("created_at", F.lit(d))))


def oldest_issue(p):
    """Age of the oldest open issue today, and as of the end of the previous period."""
    before = _oldest(open_as_of("created_at", "closed_at", p.prev_end), p.prev_end)
    return Measure("oldest_issue", _oldest(is_open(), p.as_of), before, DIFFERENCE)


def throughput_split(p):
    """Closed in the period, split into issues also created in it and older backlog."""
    fresh = between_dates("created_at", p.start, p.end)
    return [
        Measure("closed", _count_in("closed_at")(p.start, p.end)),
        Measure("same_period", _count_in("closed_at", fresh)(p.start, p.end)),
        Measure("from_backlog", _count_in("closed_at", ~F.coalesce(fresh, F.lit(False)))(p.start, p.end)),
    ]


TICKET_MEASURES = (tickets_created, entered_triage, passed_triage, escalated, escalation_rate, triage_denied)
ISSUE_MEASURES = (issues_created, issues_closed, open_at, incidents, avg_days_to_close, oldest_issue)


def ticket_kpis(fact: DataFrame, as_of, period="week", by=(), blank_zero=()) -> DataFrame:
    p = period_bounds(as_of, period)
    return measure_table(fact, [m(p) for m in TICKET_MEASURES], by, blank_zero)


def issue_kpis(fact: DataFrame, as_of, period="week", by=(), blank_zero=()) -> DataFrame:
    p = period_bounds(as_of, period)
    return measure_table(fact, [m(p) for m in ISSUE_MEASURES], by, blank_zero)


# Other aggregates over a fact.

def role_counts(fact: DataFrame, roles, start, end) -> DataFrame:
    """Rows per date role inside a range, all roles in one scan."""
    return fact.agg(*[F.count_if(between_dates(r, start, end)).alias(r) for r in roles])


def volume(fact: DataFrame, by) -> DataFrame:
    return fact.groupBy(*by).agg(F.count("*").alias("count"))


def share(fact: DataFrame, numerator: Column, denominator: Column, by=(), name="share") -> DataFrame:
    """Count where one condition holds over the count where the other holds."""
    return fact.groupBy(*by).agg(F.try_divide(F.count_if(numerator), F.count_if(denominator)).alias(name))


def pct_closed_over(fact: DataFrame, days=codes.CLOSE_THRESHOLD_DAYS, by=()) -> DataFrame:
    if not 1 <= days <= 180:
        raise ValueError("the close threshold lies between 1 and 180 days")
    closed = is_set("closed_at")
    return share(fact, closed & (F.col("days_to_close") > days), closed, by, "pct_closed_over")


def close_stats(fact: DataFrame, by=()) -> DataFrame:
    """Average and exact median of days to close.

    The median keeps a count per distinct day number, so its state is bounded by
    the length of the calendar and not by the rows of a group.
    """
    return fact.filter(is_set("closed_at")).groupBy(*by).agg(
        F.avg("days_to_close").alias("avg_days_to_close"),
        F.median("days_to_close").alias("median_days_to_close"),
    )


def open_now(fact: DataFrame, by=()) -> DataFrame:
    return fact.groupBy(*by).agg(F.count_if(is_open()).alias("open"))


def oldest_open_age(fact: DataFrame, as_of) -> DataFrame:
    p = period_bounds(as_of)
    return fact.agg(_oldest(is_open(), p.as_of).alias("oldest_open_days"))


def oldest_open(fact: DataFrame, *text_cols) -> DataFrame:
    """Date of the oldest open issue and, per text column, the greatest text on that date."""
    opened = fact.filter(is_open() & is_set("created_at"))
    age = F.negate(F.unix_date("created_at"))
    return opened.agg(
        F.min("created_at").alias("created_at"),
        *[F.max(F.struct(age, F.col(c).alias("text")))["text"].alias(c) for c in text_cols],
    )


def top_assignee(fact: DataFrame, by="assignee", n=1) -> DataFrame:
    """Who has most open issues; equal counts go by name."""
    return open_now(fact, [by]).orderBy(F.desc("open"), by).limit(n)


def person_dim(issues: DataFrame) -> DataFrame:
    """One row per person id, with the name that the newest issue gives; equal or unknown times go by name."""
    newest = F.struct(*(c for c in ("updated_at", "assignee_name") if c in issues.columns))
    return issues.filter(is_set("assignee_id")).groupBy(F.col("assignee_id").alias("person_id")).agg(
        F.max(newest)["assignee_name"].alias("person_name"))


def lead_time_exclusive(fact: DataFrame, state=codes.DONE_STATE) -> DataFrame:
    """Days from creation to the last update of done issues, 0 on the same day."""
    return fact.filter(F.col("state_name") == state).select(
        "id", "state_name", "created_at", "updated_at",
        dates.days_between("created_at", "updated_at").alias("lead_time_days"))


def done_per_person(fact: DataFrame, persons: DataFrame, state=codes.DONE_STATE) -> DataFrame:
    """Done issues per person; counted by id before the names are joined."""
    done = fact.filter((F.col("state_name") == state) & is_set("assignee_id"))
    counted = done.groupBy(F.col("assignee_id").alias("person_id")).agg(F.count("*").alias("n"))
    return counted.join(persons, "person_id").groupBy("person_name").agg(F.sum("n").alias("issues_done"))


# Snapshot-grain counts.

def snapshot_status_counts(history: DataFrame, snapshot="snapshot_ts", waiting=codes.STAGE_WAITING_CODES,
                           post=codes.STAGE_POST_CODES, escalated_codes=codes.ESCALATED_CODES) -> DataFrame:
    status = F.col("status")
    return history.groupBy(snapshot).agg(
        F.count_if(status.isin(list(waiting))).alias("waiting_for_triage"),
        F.count_if(status.isin(list(post))).alias("post_triage"),
        F.count_if(status.isin(list(escalated_codes))).alias("escalated"),
    )


def inflow_daily(fact: DataFrame, role="created_at", name="created") -> DataFrame:
    return fact.filter(is_set(role)).groupBy(F.col(role).alias("date")).agg(F.count("*").alias(name))


def issues_per_state(history: DataFrame, snapshot="snapshot_ts") -> DataFrame:
    return history.groupBy(snapshot, "state_type", "state_name").agg(F.count("*").alias("issues"))


def backlog_per_snapshot(history: DataFrame, snapshot="snapshot_ts", states=codes.BACKLOG_STATES) -> DataFrame:
    in_backlog = history.filter(F.col("state_type").isin(list(states)))
    return in_backlog.groupBy(snapshot).agg(F.count("*").alias("issues_in_backlog"))

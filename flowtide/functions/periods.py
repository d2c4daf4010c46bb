"""Reporting periods: the last complete week or month and the one before it."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from flowtide import codes
from flowtide.functions import dates
from flowtide.functions.text import _col


def as_date(d) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def add_months(d: dt.date, n: int) -> dt.date:
    """First day of the month ``n`` months away."""
    years, month = divmod(d.year * 12 + d.month - 1 + n, 12)
    return dt.date(years, month + 1, 1)


@dataclass(frozen=True)
class Period:
    as_of: dt.date
    kind: str
    start: dt.date
    end: dt.date
    prev_start: dt.date
    prev_end: dt.date


def period_bounds(as_of, period="week") -> Period:
    """Bounds for ``"week"``, ``"month"`` or a chosen month ``("month", date)``."""
    as_of = as_date(as_of)
    day = dt.timedelta(days=1)
    if period == "week":
        monday = as_of - day * as_of.weekday()
        marks = [monday - day * 14, monday - day * 7, monday]
    elif period == "month":
        marks = [add_months(as_of, n) for n in (-2, -1, 0)]
    else:
        chosen = as_date(period[1])
        marks = [add_months(chosen, n) for n in (-1, 0, 1)]
    before, start, after = marks
    kind = period if isinstance(period, str) else period[0]
    return Period(as_of, kind, start, after - day, before, start - day)


def prev_period_bounds(as_of, period="week"):
    p = period_bounds(as_of, period)
    return p.prev_start, p.prev_end


def last_week(as_of):
    p = period_bounds(as_of, "week")
    return p.start, p.end


def last_completed_week(as_of) -> int:
    return period_bounds(as_of, "week").start.isocalendar().week


def _short_label(start, kind):
    return f"W{start.isocalendar().week}" if kind == "week" else codes.MONTH_NAMES["en"][start.month - 1]


def period_label(as_of, period="week"):
    p = period_bounds(as_of, period)
    return "Period: " + _short_label(p.start, p.kind)


def prev_period_label(as_of, period="week"):
    p = period_bounds(as_of, period)
    return "Previous: " + _short_label(p.prev_start, p.kind)


def period_summary(as_of, period="week"):
    return f"{period_label(as_of, period)}     |     {prev_period_label(as_of, period)}"


def check_week(as_of):
    start, end = last_week(as_of)
    return f"{start.isoformat()} -> {end.isoformat()}"


# The same bounds for a date column.

def period_columns(as_of, period="week"):
    """Start and end columns of the period and the one before, seen from a date column."""
    c = _col(as_of)
    if period == "week":
        after = dates.week_monday(c)
        start, before = F.date_sub(after, 7), F.date_sub(after, 14)
    else:
        after = dates.month_start(c)
        start, before = F.add_months(after, -1), F.add_months(after, -2)
    return {
        "period_start": start, "period_end": F.date_sub(after, 1),
        "prev_start": before, "prev_end": F.date_sub(start, 1),
    }


def period_label_column(start, period="week"):
    return F.concat(F.lit("W"), dates.iso_week(start).cast("string")) if period == "week" else dates.month_name(start)


def week_class(c, as_of):
    """'Last Week', 'Week Before' or 'Other' for a date seen from ``as_of``."""
    p = period_bounds(as_of, "week")
    c = _col(c)
    return (
        F.when(c.between(F.lit(p.start), F.lit(p.end)), "Last Week")
        .when(c.between(F.lit(p.prev_start), F.lit(p.prev_end)), "Week Before")
        .otherwise("Other")
    )

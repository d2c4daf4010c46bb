"""Calendar series: role-playing volumes, backlog, trailing windows, drill totals.

Facts shrink to one row per day (and group) before anything is ordered or
joined, so the ordered steps see calendar-sized input whatever the fact holds.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowtide.functions import dates
from flowtide.functions.periods import as_date, add_months
from flowtide.functions.text import is_set


def role_volume(fact: DataFrame, roles, grain="month", by=(), where: Column | None = None) -> DataFrame:
    """Rows per calendar group for several date roles in one scan.

    ``roles`` maps a result name to a date column. Each row counts once per
    role on that role's date; missing dates do not count.
    """
    rows = fact if where is None else fact.filter(where)
    marks = F.array(*[
        F.struct(F.lit(name).alias("role"), F.col(col).alias("day")) for name, col in roles.items()])
    events = rows.select(*by, F.inline(marks)).filter(is_set("day"))
    return events.groupBy(dates.to_grain("day", grain).alias(grain), *by).agg(
        *[F.count_if(F.col("role") == name).alias(name) for name in roles])


def created_closed_series(fact: DataFrame, grain="month", by=()) -> DataFrame:
    return role_volume(fact, {"created": "created_at", "closed": "closed_at"}, grain, by)


def escalation_rate_series(fact: DataFrame, grain="month") -> DataFrame:
    """Created tickets and the percentage that ever waited, per calendar group."""
    return (
        fact.filter(is_set("created_at"))
        .groupBy(dates.to_grain("created_at", grain).alias(grain))
        .agg(
            F.count("*").alias("created"),
            (F.coalesce(F.try_divide(F.count_if(is_set("first_waiting_at")), F.count("*")), F.lit(0.0)) * 100)
            .alias("escalation_rate"),
        )
    )


def backlog_changes(fact: DataFrame, grain="day", by=(), until=None) -> DataFrame:
    """Net change of the open count per calendar group: +1 when created, -1 when closed.

    An issue closed before it was created never counts as open, so the closing
    event is not placed before the creating one.
    """
    opened = F.struct(F.col("created_at").alias("day"), F.lit(1).alias("delta"))
    left_at = F.when(is_set("closed_at"), F.greatest("created_at", "closed_at"))
    closed = F.struct(left_at.alias("day"), F.lit(-1).alias("delta"))
    events = (
        fact.filter(is_set("created_at"))
        .select(*by, F.inline(F.array(opened, closed)))
        .filter(is_set("day") if until is None else F.col("day") <= F.lit(as_date(until)))
    )
    return events.groupBy(*by, dates.to_grain("day", grain).alias(grain)).agg(F.sum("delta").alias("delta"))


def backlog_series(fact: DataFrame, as_of, grain="month", by=()) -> DataFrame:
    """Open issues at the end of each calendar group, the running one cut at ``as_of``.

    Every group with any change before ``as_of`` has a row for each calendar
    group from its first change to ``as_of``. The ordered step sees one row per
    calendar group and ``by`` value.
    """
    return running_backlog(backlog_changes(fact, grain, by, until=as_of), as_of, grain, by)


def running_backlog(changes: DataFrame, as_of, grain, by=()) -> DataFrame:
    """Changes per calendar group (``delta``) as the open count at the end of every group up to ``as_of``."""
    as_of = as_date(as_of)
    in_order = Window.partitionBy(*by).orderBy(grain)
    step = F.expr({"day": "interval 1 day", "week": "interval 7 day",
                   "month": "interval 1 month", "quarter": "interval 3 month"}[grain])
    last = dates.to_grain(F.lit(as_of), grain)
    until = F.coalesce(F.lead(grain).over(in_order) - step, last).cast("date")
    return (
        changes.withColumn("open", F.sum("delta").over(in_order))
        .withColumn("_until", until)
        .select(*by, F.explode(F.sequence(grain, "_until", step)).alias(grain), "open")
    )


def _trailing(monthly: DataFrame, sums, months, by, end) -> DataFrame:
    """Add each month's figures to the months whose window holds it."""
    spread = monthly.select(
        *by, F.explode(F.sequence(
            F.col("month"), F.add_months("month", months - 1), F.expr("interval 1 month"))).alias("month"),
        *sums)
    if end is not None:
        spread = spread.filter(F.col("month") <= F.lit(as_date(end)))
    return spread.groupBy(*by, "month").agg(*[F.sum(s).alias(s) for s in sums])


def moving_volume(fact: DataFrame, roles, months=3, by=(), end=None) -> DataFrame:
    """Average monthly count over the trailing calendar months; the divisor never changes.

    Months whose whole window is empty have no row.
    """
    return trailing_volume(role_volume(fact, roles, "month", by), roles, months, by, end)


def trailing_volume(monthly: DataFrame, roles, months=3, by=(), end=None) -> DataFrame:
    """Monthly counts as their averages over the trailing months."""
    total = _trailing(monthly, list(roles), months, by, end)
    # A role with nothing in the window is missing, not zero.
    return total.select(
        *by, "month", *[F.when(F.col(r) != 0, F.col(r) / months).alias(r) for r in roles])


def moving_average(fact: DataFrame, durations, role="closed_at", months=3, by=(), end=None) -> DataFrame:
    """Trailing average per row over calendar months.

    ``durations`` maps a result name to (value column, condition). Sums and
    counts are carried apart, so busy months weigh more than quiet ones.
    """
    picked = {name: F.when(where, value) if where is not None else value
              for name, (value, where) in durations.items()}
    monthly = (
        fact.filter(is_set(role))
        .groupBy(dates.month_start(role).alias("month"), *by)
        .agg(*[agg for name, v in picked.items()
               for agg in (F.sum(v).alias(f"{name}_sum"), F.count(v).alias(f"{name}_n"))])
    )
    return trailing_average(monthly, list(durations), months, by, end)


def trailing_average(monthly: DataFrame, names, months=3, by=(), end=None) -> DataFrame:
    """Monthly sums and counts (``name_sum``, ``name_n``) as averages over the trailing months."""
    total = _trailing(monthly, [f"{n}_{part}" for n in names for part in ("sum", "n")], months, by, end)
    return total.select(
        *by, "month", *[F.try_divide(F.col(f"{n}_sum"), F.col(f"{n}_n")).alias(n) for n in names])


def lifecycle_averages(fact: DataFrame, months=3, by=(), end=None) -> DataFrame:
    """Trailing averages from creation to close, creation to start, and start to close."""
    started = is_set("started_at")
    return moving_average(fact, {
        "created_to_closed": (F.col("days_to_close"), None),
        "created_to_started": (F.col("days_to_start"), started & (F.col("days_to_start") >= 0)),
        "started_to_closed": (F.col("days_to_close") - F.col("days_to_start"), started),
    }, months=months, by=by, end=end)


def with_previous(df: DataFrame, value, order, by=(), kind="ratio") -> DataFrame:
    """A series with the value of the row before it and the change."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(order))
    change = F.try_divide(F.col(value) - F.col("previous"), F.col("previous"))
    return df.withColumn("previous", before).withColumn(
        "change", change if kind == "ratio" else F.col(value) - F.col("previous"))


def drill(fact: DataFrame, dim: DataFrame, role="created_at") -> DataFrame:
    """Totals along quarter, month, week and day; counted per day before the rollup. Rows whose date is missing or
    outside the calendar are counted under NULL, so the grand total is the number of rows."""
    daily = fact.groupBy(F.col(role).alias("_day")).agg(F.count("*").alias("n"))
    labelled = daily.join(F.broadcast(dim), F.col("_day") == F.col("date_key"), "left").select(
        dates.quarter_sort("date_key").alias("quarter_sort"), "month_sort", "year_week", "date_key", "n")
    levels = ["quarter_sort", "month_sort", "year_week", "date_key"]
    return labelled.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("count"))


def month_range(as_of, months):
    """First days of the ``months`` months before the current one and of the current one."""
    return [add_months(as_date(as_of), -n) for n in range(months, -1, -1)]

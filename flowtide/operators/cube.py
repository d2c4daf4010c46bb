"""Daily cube: a fact as counts per day, role and duration, from which report series are read.

The fact is read once. What is left of it has at most a row per pair of days, role and group, whatever the fact holds,
and is written once; the series of a report page all come from there.
"""

from pyspark.sql import DataFrame, functions as F

from flowtide.functions import dates
from flowtide.functions.text import is_set
from flowtide.operators import series
from flowtide.sources import files

#: What a day stands for. A row leaves the backlog on its closing day, but not before its creating one.
CREATED, CLOSED, LEFT = "created", "closed", "left"


def daily_cube(fact: DataFrame, by=()) -> DataFrame:
    """Per role, day, ``duration`` (days to close, on closing days only) and ``by``: ``n`` rows, and the sums and counts
    of the days to start (``start``) and from start to close (``active``) of those that were started."""
    created, closed = F.col("created_at"), F.col("closed_at")
    left = F.when(is_set("created_at") & is_set("closed_at"), F.greatest(created, closed))
    start = F.when(is_set("started_at") & (F.col("days_to_start") >= 0), F.col("days_to_start"))
    active = F.when(is_set("started_at"), F.col("days_to_close") - F.col("days_to_start"))
    none = F.lit(None).cast("int")
    marks = [(CREATED, created, none, none, none), (LEFT, left, none, none, none),
             (CLOSED, closed, F.col("days_to_close"), start, active)]
    entries = F.array(*[F.struct(F.lit(role).alias("role"), day.alias("day"), duration.cast("int").alias("duration"),
                                 s.cast("int").alias("start"), t.cast("int").alias("active"))
                        for role, day, duration, s, t in marks])
    days = fact.select(*by, F.inline(entries)).filter(is_set("day"))
    return files.landed(days.groupBy(*by, "role", "day", "duration").agg(
        F.count("*").alias("n"), F.sum("start").alias("start_sum"), F.count("start").alias("start_n"),
        F.sum("active").alias("active_sum"), F.count("active").alias("active_n")))


def volume(cube: DataFrame, grain="month", by=()) -> DataFrame:
    """Created and closed rows per calendar group."""
    counts = [F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)).alias(r) for r in (CREATED, CLOSED)]
    return cube.filter(F.col("role") != LEFT).groupBy(dates.to_grain("day", grain).alias(grain), *by).agg(*counts)


def backlog(cube: DataFrame, as_of, grain="month", by=()) -> DataFrame:
    """Open rows at the end of each calendar group, as :func:`flowtide.operators.series.backlog_series` gives them."""
    delta = F.when(F.col("role") == CREATED, F.col("n")).otherwise(-F.col("n"))
    changes = (
        cube.filter((F.col("role") != CLOSED) & (F.col("day") <= F.lit(series.as_date(as_of))))
        .groupBy(*by, dates.to_grain("day", grain).alias(grain)).agg(F.sum(delta).alias("delta"))
    )
    return series.running_backlog(changes, as_of, grain, by)


def lifecycle(cube: DataFrame, months=3, by=(), end=None) -> DataFrame:
    """Trailing averages per month, as :func:`flowtide.operators.series.lifecycle_averages` gives them."""
    known = F.when(is_set("duration"), F.col("n"))
    sums = {"created_to_closed": (F.col("duration") * F.col("n"), known),
            "created_to_started": (F.col("start_sum"), F.col("start_n")),
            "started_to_closed": (F.col("active_sum"), F.col("active_n"))}
    monthly = (
        cube.filter(F.col("role") == CLOSED).groupBy(dates.month_start("day").alias("month"), *by)
        .agg(*[agg for name, (total, n) in sums.items()
               for agg in (F.sum(total).alias(f"{name}_sum"), F.sum(n).alias(f"{name}_n"))])
    )
    return series.trailing_average(monthly, list(sums), months, by, end)


def close_stats(cube: DataFrame, sets, by) -> DataFrame:
    """Average and exact median of days to close for several grouping sets of ``by`` (a column, or a calendar grain of
    the closing day) at once: a row counts ``n`` times. Columns that a set leaves out are null; ``grouping`` tells such
    a null (bit 1, the last column of ``by`` being the lowest) from one in the data."""
    grains = [c for c in by if c in ("day", "week", "month", "quarter")]
    closed = cube.filter(F.col("role") == CLOSED).select(
        *[c for c in by if c not in grains], *[dates.to_grain("day", g).alias(g) for g in grains], "duration", "n")
    known = F.when(is_set("duration"), F.col("n"))
    return closed.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by]).agg(
        F.grouping_id().cast("int").alias("grouping"),
        F.sum("n").alias("closed"),
        F.try_divide(F.sum(F.col("duration") * F.col("n")), F.sum(known)).alias("avg_days_to_close"),
        F.percentile("duration", 0.5, F.col("n")).alias("median_days_to_close"))

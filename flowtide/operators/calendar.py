"""Calendar dimension: days, ISO weeks, public holidays, working days."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flowtide import codes
from flowtide.functions import dates
from flowtide.functions.periods import as_date, period_bounds
from flowtide.functions.text import concat, matched, zero_pad
from flowtide.operators.joins import union_distinct


def date_series(spark: SparkSession, start, end) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(as_date(start)), F.lit(as_date(end)))
    return spark.range(1).select(F.explode(days).alias("date_key"))


def month_series(spark: SparkSession, start, end) -> DataFrame:
    months = F.sequence(
        dates.month_start(F.lit(as_date(start))), F.lit(as_date(end)), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month"))


def years(spark: SparkSession, start, end) -> DataFrame:
    return spark.range(as_date(start).year, as_date(end).year + 1).select(F.col("id").cast("int").alias("year"))


def _dates(years_df, *days):
    return years_df.select(F.explode(F.array(*days)).alias("holiday"))


def easter_holidays(years_df: DataFrame) -> DataFrame:
    """Holidays at a fixed distance from Easter Sunday."""
    with_easter = years_df.select(dates.easter("year").alias("easter"))
    return _dates(with_easter, *[F.date_add("easter", h[0]) for h in codes.EASTER_HOLIDAYS])


def fixed_holidays(years_df: DataFrame, month_days=codes.FIXED_HOLIDAYS) -> DataFrame:
    """Every year paired with every month-day of the list."""
    return _dates(years_df, *[F.make_date("year", F.lit(h[0]), F.lit(h[1])) for h in month_days])


def saturday_holidays(years_df: DataFrame) -> DataFrame:
    """First Saturday on or after a given day of the year."""
    starts = [F.make_date("year", F.lit(h[0]), F.lit(h[1])) for h in codes.SATURDAY_HOLIDAYS]
    return _dates(years_df, *[dates.first_saturday_from(d) for d in starts])


def public_holidays(years_df: DataFrame) -> DataFrame:
    """All holidays with their names, one row per date even where two fall together."""
    parts = [easter_holidays(years_df), fixed_holidays(years_df), saturday_holidays(years_df)]
    return union_distinct(parts).select(
        "holiday", dates.holiday_name("holiday").alias("name"), dates.holiday_name("holiday", "sv").alias("name_sv"))


def flag_holidays(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Mark days found in the holiday list."""
    marks = holidays.select(F.col("holiday").alias("date_key"), F.lit(True).alias("_hit")).distinct()
    return (
        days.join(marks, "date_key", "left")
        .withColumn("is_public_holiday", matched("_hit"))
        .drop("_hit")
    )


def working_flags(days: DataFrame) -> DataFrame:
    """Weekend and working-day flags, and working days per ISO week."""
    dow = dates.iso_dow("date_key")
    week = Window.partitionBy(dates.week_thursday("date_key"))
    return (
        days.withColumn("is_weekend", dow >= 6)
        .withColumn("is_working_day", ~(F.col("is_weekend") | F.col("is_public_holiday")))
        .withColumn("working_days_in_week", F.sum(F.col("is_working_day").cast("int")).over(week).cast("int"))
    )


# A calendar this long stays below 30 MB, so joins may broadcast it.
MAX_DAYS = 200_000


def date_dim(spark: SparkSession, start, end, holidays: DataFrame | None = None, pad: bool = True) -> DataFrame:
    """Calendar with 17 columns, one row per day.

    ``pad`` counts working days over whole weeks at the ends of the range;
    without it the end weeks are cut short.
    """
    start, end = as_date(start), as_date(end)
    if (end - start).days >= MAX_DAYS:
        raise ValueError(f"a calendar has at most {MAX_DAYS} days")
    first, last = start, end
    if pad:
        first = start - dt.timedelta(days=start.weekday())
        last = end + dt.timedelta(days=6 - end.weekday())
    if holidays is None:
        holidays = public_holidays(years(spark, first, last))
    d = F.col("date_key")
    flagged = working_flags(flag_holidays(date_series(spark, first, last), holidays))
    return flagged.filter(d.between(F.lit(start), F.lit(end))).select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter_num"),
        concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month_num"),
        dates.month_name(d).alias("month_name"),
        dates.month_short(d).alias("month_short"),
        dates.month_sort(d).alias("month_sort"),
        dates.iso_week(d).alias("iso_week"),
        dates.year_week(d).alias("year_week"),
        dates.iso_dow(d).alias("day_of_week_num"),
        dates.day_name(d).alias("day_name"),
        dates.day_short(d).alias("day_short"),
        "is_weekend",
        "is_public_holiday",
        "is_working_day",
        "working_days_in_week",
    )


def report_columns(dim: DataFrame, as_of) -> DataFrame:
    """Labels and flags the report pages add to the calendar."""
    as_of = as_date(as_of)
    d = F.col("date_key")
    return dim.withColumns({
        "is_past_or_today": (d <= F.lit(as_of)).cast("int"),
        "is_current_month": (dates.month_sort(d) == as_of.year * 100 + as_of.month).cast("int"),
        "month_label": dates.month_label(d),
        "week_starting": dates.week_starting(d),
        "quarter_label": dates.quarter_label(d),
        "quarter_sort": dates.quarter_sort(d),
        "date_key_int": dates.date_key_int(d),
        "month_start": dates.month_start(d),
        "month_end": dates.month_end(d),
        "day_number": zero_pad(F.dayofmonth(d)),
        "holiday_name": dates.holiday_name(d),
        "holiday_name_sv": dates.holiday_name(d, "sv"),
    })


def with_day_volume(dim: DataFrame, rows: DataFrame, day, name="volume") -> DataFrame:
    """The calendar with the number of ``rows`` of each day, 0 on days without any; rows outside it are left out."""
    per_day = rows.groupBy(F.col(day).cast("date").alias("date_key")).agg(F.count("*").alias(name))
    return dim.join(per_day, "date_key", "left").fillna(0, [name])


def calendar_summary(dim: DataFrame, volume=None) -> DataFrame:
    """Days by kind; with the name of a ``volume`` column of the calendar also what fell on each kind."""
    kinds = {"weekend_days": "is_weekend", "public_holidays": "is_public_holiday", "working_days": "is_working_day"}
    days = [F.count("*").alias("total_days"), *[F.count_if(flag).alias(name) for name, flag in kinds.items()]]
    if volume is None:
        return dim.agg(*days)
    amount = lambda flag: F.coalesce(F.sum(F.when(flag, F.col(volume))), F.lit(0))
    return dim.agg(*days, amount(F.lit(True)).alias(f"{volume}_total"),
                   *[amount(F.col(flag)).alias(f"{volume}_on_{name}") for name, flag in kinds.items()])


def last_date(dim: DataFrame, as_of, volume=None) -> DataFrame:
    """Newest calendar day before ``as_of``; with a ``volume`` column also the newest one that has any, and how much."""
    before = dim.filter(F.col("date_key") < F.lit(as_date(as_of)))
    newest = F.max("date_key").alias("last_date")
    if volume is None:
        return before.agg(newest)
    day = F.when(F.col(volume) > 0, F.col("date_key"))
    return before.agg(newest, F.max(day).alias("last_active"), F.max_by(volume, day).alias(volume))


def last_completed_week(dim: DataFrame, as_of, volume=None) -> DataFrame:
    """ISO week of the last complete week, looked up in the calendar; with a ``volume`` column also its sum."""
    week = period_bounds(as_of, "week")
    if volume is None:
        return dim.filter(F.col("date_key") == F.lit(week.start)).select("iso_week", "year_week")
    days = dim.filter(F.col("date_key").between(F.lit(week.start), F.lit(week.end)))
    return days.groupBy("iso_week", "year_week").agg(F.sum(volume).alias(volume))


def per_working_day(volume: DataFrame, dim: DataFrame, count_col="count") -> DataFrame:
    """Weekly volume divided by the working days of that week; ``volume`` has one row per year_week."""
    weeks = dim.groupBy("year_week").agg(F.max("working_days_in_week").alias("working_days"))
    return volume.join(F.broadcast(weeks), "year_week").withColumn(
        "per_working_day", F.try_divide(F.col(count_col), F.col("working_days")))

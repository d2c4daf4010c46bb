import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowtide.functions import dates
from flowtide.operators import calendar

EASTER = ("2025-04-20 2026-04-05 2027-03-28 2028-04-16 2029-04-01 2030-04-21 2031-04-13 2032-03-28 2033-04-17 "
          "2034-04-09 2035-03-25 2036-04-13 2037-04-05 2038-04-25 2039-04-10 2040-04-01").split()
HOLIDAYS = {
    2025: "01-01 01-06 04-18 04-20 04-21 05-01 05-29 06-06 06-08 06-21 11-01 12-25 12-26",
    2026: "01-01 01-06 04-03 04-05 04-06 05-01 05-14 05-24 06-06 06-20 10-31 12-25 12-26",
}


@pytest.fixture(scope="module")
def dim(spark):
    return calendar.date_dim(spark, "2025-01-01", "2035-12-31", pad=False).cache()


def test_easter(spark):
    years = spark.range(2025, 2041).select(F.col("id").cast("int").alias("year"))
    assert [str(r[0]) for r in years.select(dates.easter("year").alias("e")).orderBy("e").collect()] == EASTER


def test_easter_in_every_century(spark):
    # Known dates that simplified formulas get wrong.
    known = {1954: "1954-04-18", 1981: "1981-04-19", 2049: "2049-04-18", 2076: "2076-04-19", 1818: "1818-03-22",
             1943: "1943-04-25", 2100: "2100-03-28"}
    df = spark.createDataFrame([(y,) for y in known], "year int")
    assert {r.year: str(r.e) for r in df.select("year", dates.easter("year").alias("e")).collect()} == known


def test_summary(dim):
    row = calendar.calendar_summary(dim).first()
    assert tuple(row) == (4017, 1148, 143, 2788)


def test_holidays(dim):
    days = [r.date_key for r in dim.filter("is_public_holiday").orderBy("date_key").collect()]
    for year, wanted in HOLIDAYS.items():
        assert [f"{d:%m-%d}" for d in days if d.year == year] == wanted.split()
    assert all(sum(d.year == y for d in days) == 13 for y in range(2025, 2036))


def test_weeks(dim, spark):
    weeks = {r.year_week: r.w for r in dim.groupBy("year_week").agg(
        F.max("working_days_in_week").alias("w")).collect()}
    assert (weeks["2025-W01"], weeks["2026-W53"], weeks["2036-W01"]) == (2, 4, 1)
    counts = {n: sum(w == n for w in weeks.values()) for n in (5, 4, 3, 2, 1)}
    assert counts == {5: 501, 4: 64, 3: 8, 2: 1, 1: 1}
    padded = calendar.date_dim(spark, "2025-01-01", "2035-12-31")
    assert padded.count() == 4017
    edge = {r.date_key.isoformat(): r.working_days_in_week for r in padded.filter(
        F.col("date_key").isin(dt.date(2025, 1, 1), dt.date(2035, 12, 31))).collect()}
    # Monday 30 and Tuesday 31 December 2024 count too; the week of 2035-12-31 has New Year's Day in it.
    assert edge == {"2025-01-01": 4, "2035-12-31": 4}


def test_columns(dim):
    row = dim.filter(F.col("date_key") == "2035-12-31").first()
    assert row.year_week == "2036-W01" and row.day_name == "Monday" and row.day_short == "Mon"
    assert (row.quarter_name, row.month_short, row.month_sort, row.iso_week) == ("Q4", "Dec", 203512, 1)
    assert len(dim.columns) == 17


def test_iso_against_python(dim):
    for r in dim.select("date_key", "iso_week", "year_week", "day_of_week_num").collect():
        y, w, d = r.date_key.isocalendar()
        assert (r.iso_week, r.year_week, r.day_of_week_num) == (w, f"{y}-W{w:02d}", d)


def test_report_columns(dim):
    rows = {r.date_key.isoformat(): r for r in calendar.report_columns(dim, "2026-06-12").filter(
        F.col("date_key").between("2026-06-08", "2026-06-13")).collect()}
    r = rows["2026-06-12"]
    assert (r.month_label, r.quarter_label, r.quarter_sort, r.week_starting) == ("Jun '26", "Q2 '26", 20262, "8 Jun")
    assert (r.is_past_or_today, r.is_current_month) == (1, 1)
    assert rows["2026-06-13"].is_past_or_today == 0


def test_names_and_languages(spark):
    df = spark.sql("select explode(array(date'2026-05-01', date'2026-06-20', date'2026-05-14', date'2026-05-15')) d")
    got = [tuple(r) for r in df.select(
        dates.holiday_name("d"), dates.holiday_name("d", "sv"), dates.month_name("d", "sv"),
        dates.day_short("d", "sv")).collect()]
    assert got == [
        ("Labour Day", "Första maj", "Maj", "Fre"), ("Midsummer Day", "Midsommardagen", "Juni", "Lör"),
        ("Ascension Day", "Kristi himmelsfärd", "Maj", "Tor"), (None, None, "Maj", "Fre")]


def test_last_week_and_date(dim):
    assert calendar.last_completed_week(dim, "2026-06-12").first() == (23, "2026-W23")
    assert str(calendar.last_date(dim, "2026-06-12").first()[0]) == "2026-06-11"


def test_per_working_day(spark, dim):
    volume = spark.createDataFrame([("2026-W23", 10), ("2026-W53", 8)], "year_week string, count long")
    got = {r.year_week: r.per_working_day for r in calendar.per_working_day(volume, dim).collect()}
    assert got == {"2026-W23": 2.0, "2026-W53": 2.0}


def test_two_holidays_on_one_day(spark):
    # In 2008 Ascension Day fell on 1 May.
    years = spark.createDataFrame([(2008,)], "year int")
    days = [str(r.holiday) for r in calendar.public_holidays(years).collect()]
    assert len(days) == len(set(days)) == 12

"""Column expressions on dates: ISO weeks, labels, moveable holidays."""

from pyspark.sql import Column, functions as F

from flowtide import codes
from flowtide.functions.text import _col, literal_array, literal_map, right, zero_pad


def add_days(c, n):
    return F.date_add(_col(c), n)


def days_between(a, b):
    """Calendar days from ``a`` to ``b``, 0 on the same day."""
    return F.datediff(_col(b), _col(a))


def days_inclusive(a, b):
    """Days worked on: 1 on the same day."""
    return days_between(a, b) + 1


def date_parts(c):
    c = _col(c)
    return {"year": F.year(c), "quarter": F.quarter(c), "month": F.month(c), "day": F.day(c)}


def iso_week(c):
    return F.weekofyear(_col(c))


def iso_dow(c):
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_col(c)) + 1


def week_monday(c):
    c = _col(c)
    return F.date_sub(c, F.weekday(c))


def week_thursday(c):
    """The Thursday of the ISO week; its year is the ISO year."""
    return F.date_add(week_monday(c), 3)


def year_week(c):
    c = _col(c)
    return F.concat(F.year(week_thursday(c)).cast("string"), F.lit("-W"), zero_pad(iso_week(c)))


def _name(index, names):
    return F.element_at(literal_array(names), index)


def month_name(c, lang="en"):
    return _name(F.month(_col(c)), codes.MONTH_NAMES[lang])


def month_short(c, lang="en"):
    return F.left(month_name(c, lang), F.lit(3))


def day_name(c, lang="en"):
    return _name(iso_dow(c), codes.DAY_NAMES[lang])


def day_short(c, lang="en"):
    return F.left(day_name(c, lang), F.lit(3))


def shift_months(c, n):
    return F.add_months(_col(c), n)


def month_start(c):
    return F.trunc(_col(c), "MM")


def month_end(c):
    return F.last_day(_col(c))


def format_date(c, pattern):
    return F.date_format(_col(c), pattern)


def date_key_int(c):
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def month_sort(c):
    c = _col(c)
    return F.year(c) * 100 + F.month(c)


def quarter_sort(c):
    c = _col(c)
    return F.year(c) * 10 + F.quarter(c)


def _short_year(c):
    return right(zero_pad(F.year(_col(c)), 4), 2)


def quarter_label(c):
    """``Q2 '26``"""
    c = _col(c)
    return F.concat(F.lit("Q"), F.quarter(c).cast("string"), F.lit(" '"), _short_year(c))


def month_label(c):
    """``Jun '26``"""
    return F.concat(month_short(c), F.lit(" '"), _short_year(c))


def week_starting(c):
    """Monday of the week as ``8 Jun``."""
    monday = week_monday(c)
    return F.concat(F.day(monday).cast("string"), F.lit(" "), month_short(monday))


GRAINS = {
    "day": lambda c: c,
    "week": week_monday,
    "month": month_start,
    "quarter": lambda c: F.trunc(c, "QUARTER"),
}


def to_grain(c, grain):
    """First day of the calendar group a date falls in."""
    return GRAINS[grain](_col(c))


def snapshot_ts(file_name):
    """Time stamp in a snapshot file name such as ``x_snapshot_20260614T001509Z.json``."""
    stamp = F.regexp_extract(_col(file_name), r"(\d{8}T\d{6}Z)", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd'T'HHmmssX"))


def uniform_time(c):
    """ISO time text at one precision, so that text order is time order.

    Feeds that mix whole and fractional seconds need it: as text,
    ``...51.968Z`` sorts before ``...51Z``. Unreadable text becomes NULL.
    """
    # Counted from the epoch, so that no session zone with summer time shifts the clock.
    micros = F.unix_micros(F.try_to_timestamp(_col(c)))
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=micros / F.lit(1000000).cast("decimal(18,6)"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _div(a, n):
    return F.floor(a / n).cast("int")


def easter(year) -> Column:
    """Easter Sunday of a year (anonymous Gregorian computus)."""
    y = _col(year)
    golden = y % 19
    century, in_century = _div(y, 100), y % 100
    leap_fix = century - _div(century, 4)
    moon_fix = _div(century - _div(century + 8, 25) + 1, 3)
    epact = (19 * golden + leap_fix - moon_fix + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * _div(in_century, 4) - epact - in_century % 4) % 7
    late = _div(golden + 11 * epact + 22 * weekday, 451)
    n = epact + weekday - 7 * late + 114
    return F.make_date(y, _div(n, 31), n % 31 + 1)


def first_saturday_from(d):
    """First Saturday on or after a date."""
    return F.next_day(F.date_sub(_col(d), 1), "Sat")


def holiday_name(c, lang="en"):
    """Name of the public holiday on a date, NULL on other days."""
    c = _col(c)
    name = -2 if lang == "en" else -1

    def lookup(names, key):
        return F.try_element_at(literal_map(names), key)

    fixed = lookup([(h[0] * 100 + h[1], h[name]) for h in codes.FIXED_HOLIDAYS], F.month(c) * 100 + F.day(c))
    moving = lookup([(h[0], h[name]) for h in codes.EASTER_HOLIDAYS], F.datediff(c, easter(F.year(c))))
    saturdays = [
        F.when(c == first_saturday_from(F.make_date(F.year(c), F.lit(h[0]), F.lit(h[1]))), h[name])
        for h in codes.SATURDAY_HOLIDAYS]
    return F.coalesce(fixed, moving, *saturdays)

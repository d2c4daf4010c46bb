"""Column expressions on text, JSON, arrays and missing values."""

from pyspark.sql import Column, functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _sql(value):
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def literal_array(values) -> Column:
    return F.expr(f"array({', '.join(map(_sql, values))})")


def literal_map(pairs) -> Column:
    """Map column with fixed entries."""
    entries = pairs.items() if isinstance(pairs, dict) else pairs
    return F.expr(f"map({', '.join(_sql(x) for kv in entries for x in kv)})")


def left(c, n):
    return F.left(_col(c), F.lit(n))


def right(c, n):
    return F.right(_col(c), F.lit(n))


def to_type(c, t):
    return _col(c).cast(t)


def try_type(c, t):
    """Cast that gives NULL, not an error, for a value that does not fit."""
    return _col(c).try_cast(t)


def iso_date(c):
    """Date from the first ten characters of an ISO time text, NULL for junk."""
    return left(c, 10).try_cast("date")


def zero_pad(c, n=2):
    return F.lpad(_col(c).cast("string"), n, "0")


def concat(*cols):
    return F.concat(*[_col(c) for c in cols])


def ilike(c, pattern):
    """SQL LIKE without regard to case."""
    return F.lower(_col(c)).like(pattern.lower())


def starts_with(c, prefix):
    return F.lower(_col(c)).startswith(prefix.lower())


def same_text(c, value):
    return F.lower(_col(c)) == value.lower()


def first_set(*cols):
    return F.coalesce(*[_col(c) for c in cols])


def switch(*cases, otherwise=None):
    """First result whose condition holds: ``switch((cond, value), ..., otherwise=x)``."""
    out = None
    for cond, value in cases:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(otherwise) if otherwise is not None else out


def blank_to_null(c):
    return F.nullif(_col(c), F.lit(""))


def contains_flag(c, word):
    """True where the text holds the word in any case; NULL text counts as false."""
    return F.coalesce(F.lower(_col(c)).contains(word.lower()), F.lit(False))


def matched(c):
    """True where an outer join found a partner."""
    return _col(c).isNotNull()


def or_unassigned(c, label="Unassigned"):
    return F.coalesce(_col(c), F.lit(label))


def raw_json(c):
    """A nested column kept as JSON text."""
    return F.to_json(_col(c))


def json_path(c, path, t="string"):
    """One scalar from JSON text by path; NULL if absent or of another type."""
    return F.get_json_object(_col(c), path).try_cast(t)


def flatten_array(c, sep=";"):
    """Array elements joined to one text; missing elements are left out, empty gives NULL."""
    return F.nullif(F.array_join(_col(c), sep), F.lit(""))


def join_labels(c, sep="|"):
    """Names of label objects joined in array order."""
    return flatten_array(_col(c)["name"], sep)


def ratio(a, b):
    """Quotient, NULL when the divisor is zero or missing."""
    return F.try_divide(_col(a), _col(b))


def least(*cols):
    return F.least(*[_col(c) for c in cols])


def between_dates(c, start, end) -> Column:
    """Both ends inclusive; a missing date is outside."""
    return _col(c).between(F.lit(start), F.lit(end))


def in_codes(c, codes):
    return _col(c).isin(list(codes))


def is_open(c="closed_at"):
    return _col(c).isNull()


def is_set(c):
    return _col(c).isNotNull()


def open_as_of(created, closed, d) -> Column:
    """Created by the end of day ``d`` and not closed by then."""
    d = d if isinstance(d, Column) else F.lit(d)
    closed = _col(closed)
    return (_col(created) <= d) & (closed.isNull() | (closed > d))

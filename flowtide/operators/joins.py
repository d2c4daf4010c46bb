"""Joins of facts with the calendar and other dimensions, and set operations.

Calendars come from ``date_dim``, which limits their length, and are broadcast;
for other dimensions the choice is left to Spark's size check.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtide.functions.periods import add_months, as_date


def by_calendar(fact: DataFrame, dim: DataFrame, role="created_at", how="left") -> DataFrame:
    """Fact rows with the calendar columns of one of their dates, NULL where the date is missing or outside."""
    return fact.join(F.broadcast(dim), fact[role] == dim["date_key"], how)


def by_two_roles(fact: DataFrame, dim: DataFrame, role_a, role_b, columns=("date_key",)) -> DataFrame:
    """Fact rows with calendar columns of two of their dates, prefixed by the role; NULL where a date is missing or outside."""
    out = fact
    for role in (role_a, role_b):
        part = dim.select(F.col("date_key").alias("_day"), *[F.col(c).alias(f"{role}_{c}") for c in columns])
        out = out.join(F.broadcast(part), out[role] == part["_day"], "left").drop("_day")
    return out


def with_dimension(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    return fact.join(dim, on)


def status_dimension(spark: SparkSession, rows) -> DataFrame:
    return values(spark, rows, "status int, status_name string, status_description string")


def values(spark: SparkSession, rows, schema) -> DataFrame:
    """Inline table."""
    return spark.createDataFrame(rows, schema)


def union_all(dfs) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def union_distinct(dfs) -> DataFrame:
    return union_all(dfs).distinct()


def in_window(df: DataFrame, col, start, end=None) -> DataFrame:
    """Rows whose ISO time text lies in ``[start, end)``.

    Plain text comparison equals comparing the first ten characters, and it
    reaches the file scan as a pushed filter.
    """
    out = df.filter(F.col(col) >= as_date(start).isoformat())
    return out if end is None else out.filter(F.col(col) < as_date(end).isoformat())


def last_months(df: DataFrame, col, n, as_of, include_current=True) -> DataFrame:
    """Rows of the last ``n`` months before the current one, with or without the current one."""
    as_of = as_date(as_of)
    out = df.filter(F.col(col) >= F.lit(add_months(as_of, -n)))
    upper = add_months(as_of, 1 if include_current else 0)
    return out.filter(F.col(col) < F.lit(upper))


def exclude_values(df: DataFrame, col, excluded) -> DataFrame:
    """Rows whose value is not in the list; a missing value stays."""
    c = F.col(col)
    return df.filter(c.isNull() | ~c.isin(list(excluded))) if excluded else df


def not_loaded(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files without an entry in the import log."""
    return files.join(log.select("file_name"), "file_name", "left_anti")


def head(df: DataFrame, n, by) -> DataFrame:
    """First ``n`` rows in an order."""
    return df.orderBy(*by).limit(n)


def order_by_sort_key(df: DataFrame, key) -> DataFrame:
    """Order a text column by the sort key carried beside it."""
    return df.orderBy(key)


def ranked_table(df: DataFrame, by, tie=(), desc=True) -> DataFrame:
    c = F.col(by)
    return df.orderBy(c.desc_nulls_last() if desc else c.asc_nulls_last(), *tie)


def last_load(df: DataFrame, col="_loaded_at") -> DataFrame:
    return df.agg(F.max(col).alias("last_load"))


def ensure_columns(df: DataFrame, schema) -> DataFrame:
    """Add columns of the schema that the table lacks, as NULL; others stay as they are."""
    have = set(df.columns)
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have])

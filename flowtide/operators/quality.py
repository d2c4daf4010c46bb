"""Data quality: gates, keys, freshness, drift, reconciliation."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from flowtide.functions.periods import as_date
from flowtide.functions.text import first_set


def require_rows(df: DataFrame, name) -> DataFrame:
    """Stop before a rebuild that would empty a table."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows; nothing is written")
    return df


def duplicate_ids(df: DataFrame, key="id") -> DataFrame:
    """Rows, distinct keys and surplus rows."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("*").alias("key_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
    )


def key_violations(df: DataFrame, key="id", not_null=()) -> DataFrame:
    """How many rows break each rule: a repeated key or a missing required value."""
    required = [key, *[c for c in not_null if c != key]]
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in required])
    totals = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("repeated"),
        *[F.coalesce(F.sum(f"_{c}"), F.lit(0)).alias(f"_{c}") for c in required])
    rules = [F.struct(F.lit(f"unique {key}").alias("rule"), F.col("repeated").alias("violations"))]
    rules += [F.struct(F.lit(f"not null {c}").alias("rule"), F.col(f"_{c}").alias("violations")) for c in required]
    return totals.select(F.inline(F.array(*rules)))


def verify_backfill(df: DataFrame, required, created="created_at") -> DataFrame:
    """Row count, first and last creation day, and the required fields that are absent."""
    missing = [c for c in required if c not in df.columns]
    day = F.left(F.col(created), F.lit(10))
    return df.agg(
        F.count("*").alias("row_count"), F.min(day).alias("first_created"), F.max(day).alias("last_created"),
    ).withColumn("missing_fields", F.lit(",".join(missing)))


def schema_drift(df: DataFrame, expected) -> DataFrame:
    """Fields removed, added or of another type than expected."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(n, "removed", wanted[n], None) for n in wanted.keys() - actual.keys()]
    rows += [(n, "added", None, actual[n]) for n in actual.keys() - wanted.keys()]
    rows += [(n, "changed", wanted[n], actual[n]) for n in wanted.keys() & actual.keys() if wanted[n] != actual[n]]
    return df.sparkSession.createDataFrame(
        sorted(rows, key=lambda r: r[:2]), "field string, drift string, expected string, actual string")


def last_working_day(dim: DataFrame, as_of) -> DataFrame:
    before = F.col("date_key") < F.lit(as_date(as_of))
    return dim.filter(before & F.col("is_working_day")).agg(F.max("date_key").alias("last_working_day"))


def freshness(tables, as_of, dim: DataFrame, col="_loaded_at") -> DataFrame:
    """Last load per table and whether it reached the last working day."""
    loads = [
        df.agg(F.max(col).alias("last_load")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    due = last_working_day(dim, as_of).scalar()
    loaded_on = F.col("last_load").cast("date")
    return reduce(DataFrame.unionByName, loads).select(
        "table_name", "last_load",
        F.datediff(F.lit(as_date(as_of)), loaded_on).alias("age_days"),
        first_set(loaded_on >= due, F.lit(False)).alias("is_fresh"),
    )


def reconcile(kpis: DataFrame, check: DataFrame) -> DataFrame:
    """Figures that differ between a one-row KPI table and a one-row check of the same columns."""
    def long(df, value):
        pairs = [F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias(value)) for c in check.columns]
        return df.select(F.inline(F.array(*pairs)))

    return long(kpis, "reported").join(long(check, "checked"), "figure").filter(
        ~F.col("reported").eqNullSafe(F.col("checked")))


def fk_coverage(fact: DataFrame, col, dim: DataFrame, key="date_key") -> DataFrame:
    """Values without a row in the dimension and how many fact rows carry them."""
    used = fact.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(key)).agg(F.count("*").alias("row_count"))
    return used.join(dim.select(key), key, "left_anti")


def load_reconciliation(manifest: DataFrame, arrived: DataFrame, log: DataFrame, history: DataFrame) -> DataFrame:
    """Per snapshot: rows fetched (sidecar), arrived, surplus by id, logged and stored, and the first fault, if any.

    ``manifest`` has ``snapshot_file`` and the sidecar's totals, ``arrived`` is the output of
    :func:`flowtide.sources.sinks.arrivals`, ``log`` the import log, ``history`` has ``_source_file``. A snapshot that
    only some of them know has a row, too. Rows logged must be rows stored; that they are fewer than arrived is the rule.
    """
    fetched = manifest.groupBy(F.col("snapshot_file").alias("file_name")).agg(
        F.max(F.coalesce("total_tickets", "total_nodes")).alias("fetched"))
    came = arrived.select("file_name", F.col("row_count").alias("arrived"), F.col("duplicate_count").alias("duplicates"))
    logged = log.groupBy("file_name").agg(F.sum("row_count").alias("logged"))
    stored = history.groupBy(F.col("_source_file").alias("file_name")).agg(F.count("*").alias("stored"))
    out = fetched
    for part in (came, logged, stored):
        out = out.join(part, "file_name", "full")
    fault = (
        F.when(F.col("arrived").isNull(), "never arrived")
        .when(F.col("fetched") != F.col("arrived"), "not as fetched")
        .when(F.col("logged").isNull(), "not logged")
        .when(F.col("logged") != F.coalesce("stored", F.lit(0)), "not as logged"))
    return out.select("file_name", "fetched", "arrived", "duplicates", "logged", F.coalesce("stored", F.lit(0)).alias("stored"),
                      fault.alias("fault"))


def field_drift(df: DataFrame, raw, expected) -> DataFrame:
    """Fields of JSON objects held as text against the expected names: how many objects have each, and whether it is
    ``added``, ``removed`` (expected, but in none) or ``partial`` (in some only). Texts that are no objects have none."""
    keys = F.json_object_keys(F.col(raw))
    # A missing name beside an object's own counts the objects. One row per field and task before the shuffle.
    each = F.array_distinct(F.concat(F.array(F.lit(None).cast("string")), keys))
    seen = df.select(F.explode(each).alias("field")).groupBy("field").agg(F.count("*").alias("found"))
    names = df.sparkSession.createDataFrame([(n,) for n in expected], "field string").withColumn("wanted", F.lit(True))
    # One row per field.
    objects = F.max(F.when(F.col("field").isNull(), F.col("found"))).over(Window.partitionBy(F.lit(0)))
    found = seen.join(names, "field", "full").withColumn("objects", F.coalesce(objects, F.lit(0))).filter("field IS NOT NULL")
    drift = (
        F.when(F.col("wanted").isNull(), "added").when(F.col("found").isNull(), "removed")
        .when(F.col("found") < F.col("objects"), "partial"))
    return found.select("field", F.coalesce("found", F.lit(0)).alias("found"), "objects", drift.alias("drift"))

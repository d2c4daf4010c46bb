"""Column profiles over all columns of a table in one long table.

Figures that add up (rows, missing ones, what each text could be read as, first
and last time) come from one aggregate without a shuffle of rows. Distinct
values are told apart by 128-bit hashes, so what is shuffled has the same size
however long the texts are, and a value that fills a third of a column is one
row by then.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowtide import codes
from flowtide.functions.text import literal_map
from flowtide.sources import files

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def inferred_type(data_type, is_time=False) -> str:
    if is_time or isinstance(data_type, TIMES):
        return "timestamp"
    if isinstance(data_type, NUMERIC):
        return "numeric"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.ArrayType):
        return "array"
    return "json" if isinstance(data_type, (T.StructType, T.MapType)) else "string"


def _text(field) -> Column:
    c = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(c) if nested else c.cast("string")


def _value_counts(df: DataFrame) -> DataFrame:
    """(field, value, n) with one row per distinct value of a field."""
    cells = [F.struct(F.lit(f.name).alias("field"), _text(f).alias("value")) for f in df.schema.fields]
    return df.select(F.inline(F.array(*cells))).groupBy("field", "value").agg(F.count("*").alias("n"))


#: What a text may be read as, each a bit, in the order in which a column's type is chosen.
READINGS = ("boolean", "numeric", "timestamp", "array", "json")
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_TIME = r"^\s*\d{4}-\d{2}-\d{2}"


def readings(value: Column) -> Column:
    """What a text could be, as bits in the order of ``READINGS``; none of them for plain text."""
    tests = (
        F.lower(F.trim(value)).isin("true", "false"), value.rlike(_NUMBER),
        value.rlike(_TIME) & F.try_to_timestamp(value).isNotNull(),
        value.rlike(r"^\s*\[") & F.json_array_length(value).isNotNull(),
        value.rlike(r"^\s*\{") & F.json_object_keys(value).isNotNull())
    bits = F.lit(0)
    for i, test in enumerate(tests):
        bits = bits + F.when(test, 1 << i).otherwise(0)
    return bits


def _figures(field, time, infer, tolerance) -> Column:
    """The figures of one column that add up over rows, and its type."""
    c, none = F.col(f"`{field.name}`"), F.lit(None)
    kind = F.lit(inferred_type(field.dataType, time))
    length = F.max(F.size(c)) if isinstance(field.dataType, T.ArrayType) else none.cast("int")
    read = none.cast("timestamp")
    if infer and not time and isinstance(field.dataType, T.StringType):
        bits = readings(c)
        for i, name in reversed(list(enumerate(READINGS))):
            # Enough of the values can be read so; of several readings the first one counts.
            fits = F.count_if(bits.bitwiseAND(1 << i) != 0) >= (1 - tolerance) * F.count(c)
            kind = F.when(fits & (F.count(c) > 0), name).otherwise(kind)
        length = F.max(F.when(c.rlike(r"^\s*\["), F.json_array_length(c)))
        read = F.when(c.rlike(_TIME), F.try_to_timestamp(c))
    elif inferred_type(field.dataType, time) == "timestamp":
        read = F.try_to_timestamp(c.cast("string"))
    return F.struct(
        F.lit(field.name).alias("field"), kind.alias("inferred_type"), F.count("*").alias("_rows"),
        F.count_if(c.isNull()).alias("_missing"), length.cast("int").alias("_length"),
        F.count_if(c.isNotNull() & read.isNull()).alias("_unread"), F.min(read).alias("_first"), F.max(read).alias("_last"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """``field`` and ``unique_count``, the number of its distinct values, for columns that have any.

    Values are compared by two 64-bit hashes of their text, and only these are shuffled.
    """
    cells = [
        F.struct(F.lit(i).alias("f"), F.xxhash64(F.lit(1), _text(f)).alias("h1"), F.xxhash64(F.lit(2), _text(f)).alias("h2"),
                 _text(f).isNotNull().alias("known")) for i, f in enumerate(df.schema.fields)]
    values = df.select(F.inline(F.array(*cells))).filter("known").groupBy("f", "h1", "h2").agg(F.lit(1).alias("one"))
    names = F.element_at(literal_map({i: f.name for i, f in enumerate(df.schema.fields)}), F.col("f"))
    return values.groupBy("f").agg(F.count("*").alias("unique_count")).select(names.alias("field"), "unique_count")


def profile(df: DataFrame, times=(), handling=codes.SUGGESTED_HANDLING, *, infer=True, tolerance=0.0, source=None,
            notes=None) -> DataFrame:
    """Per column: type, missing rate, distinct count, longest array, unreadable times, first and last time.

    ``times`` names text columns that should hold ISO times. Other text columns are named by what all their values can
    be read as (``READINGS``), or all but a share of ``tolerance``; ``infer=False`` leaves them strings. ``handling`` is
    by type or by field, ``notes`` by field; with ``source`` the result has the table's name first and notes last. A
    table without rows has a row per column, of the column's own type and without a missing rate.
    """
    figures = [_figures(f, f.name in times, infer, tolerance) for f in df.schema.fields]
    found = df.agg(F.array(*figures).alias("r")).select(F.inline("r"))
    is_time = F.col("inferred_type") == "timestamp"
    by_type = F.element_at(literal_map(handling), F.col("inferred_type"))
    advice = F.coalesce(F.element_at(literal_map(handling), F.col("field")), by_type)
    out = found.join(distinct_counts(df), "field", "left").select(
        "field",
        "inferred_type",
        F.round(F.try_divide("_missing", "_rows"), 6).alias("missing_rate"),
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        F.when(F.col("inferred_type") == "array", F.col("_length")).alias("max_array_len"),
        F.when(is_time, F.col("_unread")).otherwise(F.lit(0)).alias("parse_errors"),
        F.when(is_time, F.col("_first")).alias("min_date"),
        F.when(is_time, F.col("_last")).alias("max_date"),
        advice.alias("suggested_handling"),
    )
    if source is None:
        return out
    note = F.element_at(literal_map(notes), F.col("field")) if notes else F.lit(None).cast("string")
    return out.select(F.lit(source).alias("source"), "*", note.alias("notes"))


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
STRIDE = 32
SLICES = STRIDE * STRIDE
SHARES = ", ".join(f"{2 * i / SLICES}D" for i in range(1, SLICES // 2))
#: Values that are put in order at once. What is found does not depend on it.
MOST = 1_000_000


def _numbers(df: DataFrame, columns) -> DataFrame:
    """(field, x) rows of the numeric columns."""
    cells = [F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("x")) for c in columns]
    return df.select(F.inline(F.array(*cells))).filter(F.col("x").isNotNull())


def _sketch(column):
    """Cuts between values: half of them by a sketch of how values lie, half evenly spaced, so that a range gets narrower
    even where one value fills nearly all of it."""
    x = F.col(f"`{column}`").cast("double")
    shares = F.expr(f"percentile_approx(CAST(`{column}` AS DOUBLE), array({SHARES}), {10 * SLICES})")
    half = SLICES // 2
    spaced = F.transform(F.sequence(F.lit(1), F.lit(half)), lambda i: F.min(x) + (F.max(x) - F.min(x)) * (i / (half + 1)))
    return F.array_sort(F.concat(F.coalesce(shares, F.array().cast("array<double>")), spaced)).alias("cuts")


def _slice_no(cuts, x):
    """How many cuts lie below x: first among every 32nd cut, then among the 32 that follow."""
    coarse = F.size(F.filter(F.transform(F.sequence(F.lit(1), F.lit(STRIDE - 1)),
                                         lambda i: F.get(cuts, i * STRIDE - 1)), lambda c: c < x))
    return coarse * STRIDE + F.size(F.filter(F.slice(cuts, coarse * STRIDE + 1, F.lit(STRIDE)), lambda c: c < x))


def _slices(rows: DataFrame, keys) -> DataFrame:
    """Rows per slice with the exact range of the slice and the exact count below it.

    Range and counts travel in one row, so they belong together even if the
    sketch behind the cuts is computed anew elsewhere in the plan.
    """
    no = F.col("slice")
    edge = lambda i: F.when(i >= 0, F.get("cuts", i))
    upto = F.sum("w").over(Window.partitionBy(*keys).orderBy("slice"))
    return (
        rows.withColumn("slice", _slice_no(F.col("cuts"), F.col("x")))
        .withColumns({"lo": F.greatest("lo", edge(no - 1)), "hi": F.least("hi", edge(no))})
        .groupBy(*keys, "below", "slice")
        .agg(F.count("*").alias("w"), F.first("lo").alias("lo"), F.first("hi").alias("hi"),
             F.min("x").alias("least"), F.max("x").alias("most"))
        .withColumn("upto", F.col("below") + upto)
        .withColumn("below", F.col("upto") - F.col("w"))
    )


def _inside(numbers: DataFrame, targets: DataFrame) -> DataFrame:
    """Values in the range of each target; a column has two targets per quantile, so they are broadcast."""
    x = F.col("x")
    in_range = (F.col("lo").isNull() | (x > F.col("lo"))) & (F.col("hi").isNull() | (x <= F.col("hi")))
    return numbers.join(F.broadcast(targets), "field").filter(in_range)


def exact_quantiles(df: DataFrame, columns, quantiles=QUARTILES, most=MOST) -> DataFrame:
    """Exact interpolated quantiles of numeric columns, one row per column with values.

    The range that holds a wanted rank is narrowed, several hundredfold per
    pass, until it has at most ``most`` values or a single one, by its exact
    count. Only that range is put in order, so neither a whole column nor its
    distinct values ever meet in one task. The sketch used for that decides
    where to split, never the result.
    """
    numbers = _numbers(df, columns)
    none = F.lit(None).cast("double")
    hit = (F.col("below") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
    place = {name: (F.col("n") - 1) * q for name, q in quantiles.items()}
    ranks = F.array_distinct(F.array(*[r for at in place.values() for r in (F.floor(at) + 1, F.ceil(at) + 1)]))

    # One row per column of the table.
    start = df.agg(F.array(*[
        F.struct(F.lit(c).alias("field"), F.count(c).alias("n"), _sketch(c)) for c in columns
    ]).alias("s")).select(F.inline("s"), none.alias("lo"), none.alias("hi"), F.lit(0).cast("long").alias("below"))
    first = _slices(numbers.join(F.broadcast(start), "field"), ["field", "n"])
    kept = ["field", "n", "rank", "lo", "hi", "below", "w", "least", "most"]
    # Two rows per quantile and column.
    targets = files.landed(first.withColumn("rank", F.explode(ranks)).filter(hit).select(*kept))
    large = (F.col("w") > most) & (F.col("least") < F.col("most"))
    while not (wide := targets.filter(large)).isEmpty():
        wide = wide.select("field", "n", "rank", "lo", "hi", "below")
        cuts = _inside(numbers, wide).groupBy("field", "rank").agg(_sketch("x"))
        finer = _inside(numbers, wide.join(cuts, ["field", "rank"]))
        narrow = _slices(finer, ["field", "n", "rank"]).filter(hit).select(*kept)
        targets = files.landed(narrow.unionByName(targets.filter(~large)))
    targets = targets.select("field", "n", "rank", "lo", "hi", "below")

    upto = F.col("below") + F.sum("w").over(Window.partitionBy("field", "rank").orderBy("x"))
    found = (
        _inside(numbers, targets).groupBy("field", "n", "rank", "below", "x").agg(F.count("*").alias("w"))
        .withColumn("upto", upto)
        .filter(F.col("upto") >= F.col("rank"))
        .groupBy("field", "n", "rank").agg(F.min("x").alias("x"))
    )
    value = lambda rank: F.max(F.when(F.col("rank") == rank, F.col("x")))
    lower = [value(F.floor(at) + 1).alias(f"{name}_lo") for name, at in place.items()]
    upper = [value(F.ceil(at) + 1).alias(f"{name}_hi") for name, at in place.items()]
    return found.groupBy("field", "n").agg(*lower, *upper).select("field", *[
        (F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (at - F.floor(at))).alias(name)
        for name, at in place.items()])


def _moments(df: DataFrame, columns) -> DataFrame:
    """Count, mean, deviation and range of numeric columns from one scan."""
    rows = [F.struct(
        F.lit(c).alias("field"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")) for c in columns]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def _text_figures(df: DataFrame) -> DataFrame:
    """Count, distinct values, the most frequent one (the smallest among equals) and its frequency."""
    counts = _value_counts(df).filter(F.col("value").isNotNull())
    return counts.groupBy("field").agg(
        F.sum("n").alias("count"),
        F.count("value").alias("unique"),
        F.min_by("value", F.struct(F.negate("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def describe_all(df: DataFrame, most=MOST) -> DataFrame:
    """Per column: count; distinct, top and its frequency for text; moments and quartiles for numbers."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    texts = [f.name for f in df.schema.fields if f.name not in numeric]
    parts = []
    if numeric:
        parts.append(_moments(df, numeric).join(exact_quantiles(df, numeric, most=most), "field", "left"))
    if texts:
        parts.append(_text_figures(df.select(*texts)))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    order = ["field", "count", "unique", "top", "freq", "mean", "std", "min", *QUARTILES, "max"]
    return out.select(*[c for c in order if c in out.columns])


def describe_times(df: DataFrame, most=MOST) -> DataFrame:
    """Per time column: count, mean, first, quartiles and last, without regard to the session time zone."""
    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, TIMES)]
    micros = df.selectExpr(*[
        f"timestampdiff(MICROSECOND, {epoch}, CAST(`{c}` AS TIMESTAMP_NTZ)) AS `{c}`" for c in names])
    figures = _moments(micros, names).join(exact_quantiles(micros, names, most=most), "field", "left")
    time = lambda c: F.expr(f"{epoch} + make_dt_interval(0, 0, 0, CAST({c} / 1000000 AS DECIMAL(18, 6)))").alias(c)
    return figures.select("field", "count", *[time(c) for c in ("mean", "min", *QUARTILES, "max")])

"""Version history: newest version, first entry, regression, replay, transitions.

One id may hold a large share of all rows. Nothing here gathers the rows of an
id in one task: sums per id use partial aggregation, and whatever needs order
within an id first reduces it to one row per id and day (or id and file).
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowtide import codes
from flowtide.functions.text import in_codes
from flowtide.sources import files

ORDER = ("updated_at", "_row_id")


def latest_version(history: DataFrame, key="id", order=ORDER, columns=None) -> DataFrame:
    """Newest version per key; a missing time loses against any other.

    Text in the aggregate makes it sort its input, and a scan task may hold far more rows than it can sort in memory. So
    versions are dealt out first: by a hash of the key, which makes them few per key, and in parts of bounded size, which
    splits a hot key; as this is not a partitioning by the key itself, the rows left of a key meet in another shuffle.
    """
    columns = columns or [c for c in history.columns if c != key]
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("_row")
    rows = history.select(*dict.fromkeys([key, *order, *columns]), F.xxhash64(key).alias("_dealt"))
    dealt = rows.hint("rebalance", F.col("_dealt"))
    return dealt.groupBy(key).agg(newest).select(key, "_row.*")


def high_water_mark(history: DataFrame, key="id", ts="updated_at") -> DataFrame:
    """Greatest stored time per key, empty text where none is known."""
    return history.groupBy(key).agg(F.coalesce(F.max(ts), F.lit("")).alias("high_water"))


def first_in_state(history: DataFrame, state_codes, key="id", ts="updated_at", state="status") -> DataFrame:
    """First time each key was seen in one of the states."""
    return history.filter(in_codes(state, state_codes)).groupBy(key).agg(F.min(ts).alias("first_at"))


def first_regression(history: DataFrame, from_codes, to_codes, key="id", ts="updated_at", state="status") -> DataFrame:
    """Day a key first came back to ``to_codes`` after having been in ``from_codes``.

    The first later time falls on the first day whose newest ``to`` time is past
    the first ``from`` time, so one row per key and day is enough.
    """
    day = F.left(F.col(ts), F.lit(10)).alias("_day")
    per_day = (
        history.filter(in_codes(state, [*from_codes, *to_codes]))
        .groupBy(key, day)
        .agg(
            F.min(F.when(in_codes(state, from_codes), F.col(ts))).alias("_from"),
            F.max(F.when(in_codes(state, to_codes), F.col(ts))).alias("_to"),
        )
    )
    first_from = F.min("_from").over(Window.partitionBy(key))
    return (
        per_day.withColumn("_from", first_from)
        .filter(F.col("_to") > F.col("_from"))
        .groupBy(key)
        .agg(F.min("_day").alias("regressed_on"))
    )


def with_state_dates(history: DataFrame, keep: Column, columns, *, order=ORDER, key="id", ts="updated_at",
                     state="status", waiting=codes.WAITING_CODES, passed=codes.PASSED_CODES,
                     filter_after=False) -> DataFrame:
    """Newest kept version per key with the dates of its states.

    ``keep`` limits which versions may become the current row; the state dates
    read all versions. By default a key whose newest version is not kept falls
    back to an older one; ``filter_after`` drops it instead.

    The history is read once. It becomes one row per key and day, spread by both,
    so a hot key meets in one task only as a row for each of its days; from these
    the newest version, the first dates and the regression (see
    :func:`first_regression`) follow in one more shuffle, by key.
    """
    rank = F.struct(*order)
    kept = F.coalesce(keep, F.lit(False))
    rank = rank if filter_after else F.when(kept, rank)
    moment = F.col(ts)
    per_day = history.groupBy(key, F.left(moment, F.lit(10)).alias("_day")).agg(
        F.max_by(F.struct(*columns, kept.alias("_kept")), rank).alias("_row"),
        F.max(rank).alias("_rank"),
        F.min(F.when(in_codes(state, waiting), moment)).alias("_first_to"),
        F.max(F.when(in_codes(state, waiting), moment)).alias("_to"),
        F.min(F.when(in_codes(state, passed), moment)).alias("_from"),
    )
    first_from = F.min("_from").over(Window.partitionBy(key))
    return (
        per_day.withColumn("_first_from", first_from)
        .groupBy(key)
        .agg(
            F.max_by("_row", "_rank").alias("_row"),
            F.min("_first_to").alias("first_waiting"),
            F.min("_from").alias("first_passed"),
            F.min(F.when(F.col("_to") > F.col("_first_from"), F.col("_day"))).alias("regressed_on"),
        )
        .filter(F.col("_row._kept"))
        .select(key, *[F.col(f"_row.{c}") for c in columns], "first_waiting", "first_passed", "regressed_on")
    )


def is_incremental(file="_snapshot_file") -> Column:
    """Nightly snapshots are incremental; any other file is a full backfill."""
    return F.col(file).contains("_snapshot_")


def replay_snapshots(rows: DataFrame, stored: DataFrame | None = None, *, key="id", ts="updated_at",
                     file="_snapshot_file", incremental: Column | None = None) -> DataFrame:
    """Rows of pending files that a file-by-file load would keep.

    Files count in name order. A row of an incremental file is dropped if its
    key is known from stored rows or an earlier file with the same or a newer
    time; files that are not incremental are kept whole. ``stored`` is the
    output of :func:`high_water_mark`. Dropped rows never exceed the mark, so
    the mark over all earlier rows equals the mark over loaded rows.
    """
    incremental = is_incremental(file) if incremental is None else incremental
    time = F.coalesce(F.col(ts), F.lit(""))
    marks = rows.groupBy(key, file).agg(F.max(time).alias("_mark"))
    if stored is not None:
        marks = marks.unionByName(stored.select(key, F.lit("").alias(file), F.col("high_water").alias("_mark")))
    earlier = Window.partitionBy(key).orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    known = marks.withColumn("_known", F.max("_mark").over(earlier)).filter(F.col(file) != "").drop("_mark")
    newer = F.col("_known").isNull() | (time > F.col("_known"))
    # The large side stays on the left of a left join, which AQE may split at a hot key.
    return rows.join(known, [key, file], "left").filter(~incremental | newer).drop("_known")


def newer_only(rows: DataFrame, stored: DataFrame, key="id", ts="updated_at") -> DataFrame:
    """Rows of one file that are new or newer than the stored mark."""
    time = F.coalesce(F.col(ts), F.lit(""))
    fresh = F.col("high_water").isNull() | (time > F.col("high_water"))
    # Marks come grouped by key. Joining on the key and its hash gives them a shuffle of
    # their own, without which AQE would not split a hot key on the other side.
    split = F.xxhash64(key).alias("_split")
    joined = rows.select("*", split).join(stored.select("*", split), [key, "_split"], "left")
    return joined.filter(fresh).drop("high_water", "_split")


def merge_latest(chunks: DataFrame, key="id", ts="updated_at", order=("_snapshot_file", "_pos")) -> DataFrame:
    """One row per key over several backfill windows: newest time, the earliest place among equals."""
    payload = F.struct(*[c for c in chunks.columns if c != key])
    time = F.coalesce(F.col(ts), F.lit("")).alias("_time")
    first_at_time = chunks.groupBy(key, time).agg(F.min_by(payload, F.struct(*order)).alias("_row"))
    return first_at_time.groupBy(key).agg(F.max_by("_row", "_time").alias("_row")).select(key, "_row.*")


def state_transitions(history: DataFrame, key="id", state="status", ts="updated_at", order=ORDER) -> DataFrame:
    """Changes of state per key with the time each state held.

    Versions are dealt out in ranges of (key, order), so a key, or a day of a
    key, may hold any share of them. One pass over each range finds the changes
    within it. What crosses ranges can only be the first key of a range and the
    last one, so one row per range carries the state in and the next change back.
    """
    found = files.landed(_range_changes(history, key, state, ts, order))
    ends = found.filter("_last").select("_range", F.col("_key").alias("_last_key"), F.col("_state").alias("_last_state"))
    # One row per range from here on, as many as a shuffle has partitions.
    edges = found.filter("_first").select("_range", "_key", "_state", "_ts", "_more", "_next").join(ends, "_range")
    before = F.lag(F.struct("_last_key", "_last_state")).over(Window.orderBy("_range"))
    carried = F.col("_before").isNotNull() & F.col("_before._last_key").eqNullSafe(F.col("_key"))
    changes = ~(F.col("_carried") & F.col("_before._last_state").eqNullSafe(F.col("_state")))
    edges = (
        edges.withColumn("_before", before).withColumn("_carried", carried).withColumn("_changes", changes)
        .withColumn("_change", F.when(F.col("_changes"), F.struct(F.col("_ts").alias("t")))
                    .when(F.col("_more"), F.struct(F.col("_next").alias("t"))))
    )
    none = F.lit(None).cast(edges.schema["_change"].dataType)
    asked = edges.select(F.col("_last_key").alias("_key"), "_range", none.alias("_change"), F.lit(True).alias("_ask"))
    later = Window.partitionBy("_key").orderBy("_range", "_ask").rowsBetween(1, Window.unboundedFollowing)
    after = edges.select("_key", "_range", "_change", F.lit(False).alias("_ask")).unionByName(asked).withColumn(
        "_after", F.first("_change", ignorenulls=True).over(later)).filter("_ask").select("_range", "_after")
    edges = edges.select("_range", "_carried", "_changes", F.col("_before._last_state").alias("_carry")).join(after, "_range")
    return found.join(F.broadcast(edges), "_range").filter(~F.col("_first") | F.col("_changes")).select(
        F.col("_key").alias(key),
        F.when(F.col("_first") & F.col("_carried"), F.col("_carry")).otherwise(F.col("_previous")).alias(f"previous_{state}"),
        F.col("_state").alias(state),
        F.col("_ts").alias("valid_from"),
        F.when(F.col("_more"), F.col("_next")).when(F.col("_last"), F.col("_after.t")).alias("valid_to"),
    )


def _range_changes(history: DataFrame, key, state, ts, order) -> DataFrame:
    """Per range of (key, order): its first row and every row whose key or state is not that of the row before, with the
    state before and the time of the next change of the same key, as far as the range shows them."""
    rows = history.select(F.col(key).alias("_key"), F.col(state).alias("_state"), F.col(ts).alias("_ts"),
                          *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)])
    place = ["_key", *[f"_order{i}" for i in range(len(order))]]
    ranged = rows.repartitionByRange(*place).sortWithinPartitions(*place).select("_key", "_state", "_ts")
    kind = {f.name: f.dataType.simpleString() for f in ranged.schema.fields}
    def changes(batches):
        """One pass over the sorted rows of a range, a batch at a time."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        names = ["_range", "_key", "_previous", "_state", "_ts", "_more", "_next", "_first", "_last"]

        def same(a, b):
            return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))

        def shifted(column, last):
            return pa.concat_arrays([last if last is not None else pa.nulls(1, column.type), column.slice(0, len(column) - 1)])

        def where(condition, column):
            """The column's values where the condition holds, else missing."""
            no = ~condition.to_numpy(zero_copy_only=False)
            return column.take(pa.array(np.arange(len(no)), mask=no))

        def out(rows, more, following, last):
            """Rows with what follows each of them."""
            of_range = pa.array([number] * len(rows[0]), pa.int32())
            key, previous, _, now, time, first = rows
            return pa.RecordBatch.from_arrays([of_range, key, previous, now, time, more, following, first, pa.array(last)], names)

        last_key = last_state = held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, now, time = batch.columns
            first = pa.array([i == 0 and last_key is None for i in range(batch.num_rows)])
            same_key = pc.and_(pc.invert(first), same(key, shifted(key, last_key)))
            before = shifted(now, last_state)
            change = pc.invert(pc.and_(same_key, same(now, before)))
            last_key, last_state = key.slice(len(key) - 1), now.slice(len(now) - 1)
            rows = [c.filter(change) for c in (key, where(same_key, before), same_key, now, time, first)]
            if held is not None:
                rows = [pa.concat_arrays([a, b]) for a, b in zip(held, rows)]
            # The last one waits: what follows it comes with a later batch.
            done, n = [c.slice(0, len(c) - 1) for c in rows], len(rows[0]) - 1
            held = [c.slice(n) for c in rows]
            if n:
                more = rows[2].slice(1)
                yield out(done, more, where(more, rows[4].slice(1)), [False] * n)
        if held is not None:
            yield out(held, pa.array([False]), pa.nulls(1, held[4].type), [True])

    return ranged.mapInArrow(changes, (
        f"_range int, _key {kind['_key']}, _previous {kind['_state']}, _state {kind['_state']}, _ts {kind['_ts']}, "
        f"_more boolean, _next {kind['_ts']}, _first boolean, _last boolean"))

"""The same ingest as a Structured Streaming job over a landing folder."""

import json
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from flowtide.operators.history import is_incremental, newer_only
from flowtide.sources import files
from flowtide.sources.ingest import SNAPSHOTS, Feed, load_landed
from flowtide.sources.readers import lineage, with_position


def ingest_stream(spark: SparkSession, feed: Feed, raw, prefix=None, multi_line=True, max_files=None) -> DataFrame:
    """Rows of new files, each file once; progress lives in the query's checkpoint.

    ``max_files`` bounds what a micro-batch reads. Micro-batches follow the order
    in which files landed; :func:`write_history` loads them in name order.
    """
    reader = (
        spark.readStream.schema(feed.raw_schema)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = F.col("_snapshot_file")
    rows = reader.json(raw).select("*", *lineage())
    return rows.filter(name.startswith(f"{prefix or feed.name}_") & ~name.endswith(".meta.json"))


class HistoryRun:
    """A stream that lands files, and the loading of what has landed once it has ended."""

    def __init__(self, query, load):
        self.query, self._load = query, load

    def awaitTermination(self) -> None:  # noqa: N802 - as the stream's own
        self.query.awaitTermination()
        self._load()


def write_history(stream: DataFrame, feed: Feed, history_path, log_path, checkpoint, loaded_at, *, marks_path=None,
                  most=SNAPSHOTS) -> HistoryRun:
    """Land all waiting files and, when the run is awaited, load them into the history.

    A micro-batch is parsed once and lands beside the checkpoint under its own number, so one that runs twice after a
    failure replaces itself. What has landed is then admitted snapshot by snapshot in name order, at most ``most`` in a
    pass, so neither the size of the micro-batches nor the order in which files landed within a run changes what is
    kept. Landed batches go when they are loaded; a run that stops before that leaves them to the next one. There is no
    watermark: an old version that arrives late is dropped however late it is, by its id's mark in the marks table.
    """
    landing = f"{checkpoint.rstrip('/')}_landing"
    spark = stream.sparkSession

    def land(batch: DataFrame, batch_id: int) -> None:
        feed.flatten(with_position(batch)).write.mode("overwrite").parquet(f"{landing}/batch={batch_id}")

    def load() -> None:
        waiting = files.children(spark, landing)
        if not waiting:
            return
        rows = spark.read.parquet(*[f"{landing}/{name}" for name in waiting])
        # One short string per snapshot.
        names = [r[0] for r in rows.select("_snapshot_file").distinct().collect()]
        load_landed(rows, names, feed, history_path, log_path, loaded_at, marks_path, most)
        for name in waiting:
            files.remove(spark, f"{landing}/{name}")

    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return HistoryRun(query, load)


def newer_only_batch(batch: DataFrame, stored: DataFrame, key="id", ts="updated_at") -> DataFrame:
    """Rows of one micro-batch that beat the stored mark of their key."""
    return newer_only(batch, stored, key, ts)


def high_water_stream(stream: DataFrame, key="id", ts="updated_at") -> DataFrame:
    """Greatest time per key as running state; one row of state per key, kept for good."""
    return stream.groupBy(key).agg(F.max(ts).alias("high_water"))


def newer_rows(rows, state):
    """The rows of one key that the rule keeps, and its new state, from (file, time, incremental, row) in any order.

    Plain values: a key has few rows of each file, and a frame for every file costs more than its rows.
    """
    def later(a, b):
        """The greater of two times, of which either may be unknown."""
        return b if a is None else a if b is None else max(a, b)

    known, newest, top = state
    keep = []
    for name, part in groupby(sorted(rows, key=itemgetter(0)), itemgetter(0)):
        part = list(part)
        if newest is None or name > newest:
            known, newest, top = later(known, top), name, None
        # A file out of order is judged against all that came before it.
        mark = known if name == newest else later(known, top)
        keep += [row for _, time, rule, row in part if mark is None or not rule or time > mark]
        top = later(top, max(time for _, time, _, _ in part))
    return keep, (known, newest, top)


def newer_only_stream(stream: DataFrame, key="id", ts="updated_at", file="_snapshot_file") -> DataFrame:
    """Rows of a stream that the keep-only-newer rule keeps, with a state per key and no history at all.

    The state holds the newest file of the key, the greatest time of the files before it and that of the file itself, so
    parts of one snapshot may come in several micro-batches and do not outdate each other. Files of a micro-batch count in
    name order, and a file that comes after one of a later name is judged against all before it. Files that are not
    incremental are kept whole; so is a row without a key. States stay for good, in the state store of the checkpoint.

    A key's rows of one micro-batch are handled in one task. Where an id may hold a large share of all rows,
    :func:`write_history` splits it and keeps the same.
    """
    fields = T.StructType([T.StructField(c, stream.schema[c].dataType) for c in stream.columns])
    # A row travels as text, as whole numbers beside nulls would turn into floating point, and what it is judged by before
    # it in the same column: every column of every key is converted on its own, which costs more than its rows.
    written = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "true"}
    judged_by = F.struct(
        F.coalesce(F.col(file), F.lit("")).alias("file"), F.coalesce(F.col(ts).cast("string"), F.lit("")).alias("time"),
        F.coalesce(is_incremental(file), F.lit(False)).alias("rule"))
    rows = stream.select(
        F.col(key).cast("string").alias("_key"),
        F.concat_ws("\n", F.to_json(judged_by), F.to_json(F.struct(*stream.columns), written)).alias("_row"))

    def judge(group, frames, state):
        # JSON has no line ends of its own.
        texts = [text.split("\n", 1) for frame in frames for text in frame["_row"].tolist()]
        if group[0] is None:
            yield pd.DataFrame({"_row": [row for _, row in texts]})
            return
        rows = [(*json.loads(head).values(), row) for head, row in texts]
        keep, known = newer_rows(rows, state.get if state.exists else (None, None, None))
        if keep:
            yield pd.DataFrame({"_row": keep})
        state.update(known)

    kept = rows.groupBy("_key").applyInPandasWithState(
        judge, "_row string", "known string, newest string, top string", "append", GroupStateTimeout.NoTimeout)
    return kept.select(F.from_json("_row", fields, written).alias("row")).select("row.*")

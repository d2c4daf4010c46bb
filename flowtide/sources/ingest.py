"""Batch ingest of snapshot files into the history."""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtide import schemas
from flowtide.operators.history import replay_snapshots
from flowtide.operators.quality import require_rows
from flowtide.sources import files, marks, readers, sinks


@dataclass(frozen=True)
class Feed:
    """One source: file prefix, reader and history schema."""
    name: str
    read: Callable[..., DataFrame]
    raw_schema: object
    flatten: Callable[[DataFrame], DataFrame]
    schema: object


TICKETS = Feed("tickets", readers.read_tickets, schemas.RAW_TICKET, readers.project_tickets, schemas.TICKET_HISTORY)
ISSUES = Feed("issues", readers.read_issues, schemas.RAW_ISSUE, readers.flatten_issue, schemas.ISSUE_HISTORY)


#: Snapshots that one pass takes at most. What is kept does not depend on it, as passes follow name order.
SNAPSHOTS = 500


def load_rows(rows: DataFrame, names, feed: Feed, history_path, log_path, loaded_at, marks_path=None) -> None:
    """Apply the keep-only-newer rule to rows of the named files, append them, log the files.

    ``rows`` are read several times and so are best landed. Stored marks leave out the named files: their rows are left
    over from a run that stopped half-way and are written again, or are other parts of the same snapshot, which stay and
    do not outdate each other. Marks come from the marks table (``marks_path``, by default beside the history), of which
    only the buckets of the batch's ids are read.
    """
    spark = rows.sparkSession
    schema = sinks.history_schema(feed.schema)
    stored = sinks.read_or_empty(spark, history_path, schema)
    log = sinks.read_or_empty(spark, log_path, schemas.IMPORT_LOG).filter(F.col("source") == feed.name)
    logged = {r.file_name for r in log.select("file_name").distinct().collect()}
    table = marks.Marks(spark, marks_path or f"{history_path.rstrip('/')}_marks", schema["id"].dataType)
    kept = replay_snapshots(rows, marks.known(rows, names, stored, logged, table))
    sinks.append_history(kept, history_path, loaded_at)
    written = sinks.read_or_empty(spark, history_path, schema).filter(F.col("_source_file").isin(names))
    entries = spark.createDataFrame([(n,) for n in names], "file_name string")
    sinks.log_import(sinks.file_counts(entries, written, feed.name, loaded_at), log_path)


def load_landed(rows: DataFrame, names, feed: Feed, history_path, log_path, loaded_at, marks_path=None,
                most=SNAPSHOTS) -> None:
    """Load whole snapshots in name order, at most ``most`` in a pass, whatever order they landed in.

    What came is counted beside the log, for :func:`flowtide.operators.quality.load_reconciliation`.
    """
    sinks.log_arrivals(rows, feed.name, f"{log_path.rstrip('/')}_arrivals", loaded_at)
    names = sorted(names)
    for i in range(0, len(names), most):
        some = names[i:i + most]
        part = rows if len(some) == len(names) else rows.filter(F.col("_snapshot_file").isin(some))
        load_rows(part, some, feed, history_path, log_path, loaded_at, marks_path)


def load_files(spark: SparkSession, feed: Feed, raw, history_path, log_path, loaded_at,
               prefix=None, multi_line=True, marks_path=None, most=SNAPSHOTS) -> int:
    """Load all snapshots not yet logged; returns how many. Each run must bring rows. The files are parsed once."""
    log = sinks.read_or_empty(spark, log_path, schemas.IMPORT_LOG)
    plan = readers.plan_files(readers.list_files(spark, raw, prefix or feed.name), log)
    # The reader takes paths as a list: one short string per pending snapshot.
    pending = plan.select("path", "file_name").collect()
    if not pending:
        return 0
    rows = files.landed(feed.read(spark, [f.path for f in pending], multi_line))
    require_rows(rows, feed.name)
    load_landed(rows, [f.file_name for f in pending], feed, history_path, log_path, loaded_at, marks_path, most)
    return len(pending)

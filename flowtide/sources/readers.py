"""Readers for snapshot files: JSON arrays or JSON Lines with a fixed schema."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowtide import schemas
from flowtide.functions.dates import snapshot_ts
from flowtide.functions.periods import as_date
from flowtide.functions.text import blank_to_null, join_labels
from flowtide.operators.calendar import month_series
from flowtide.operators.history import is_incremental
from flowtide.operators.joins import not_loaded
from flowtide.sources import arrays


LINEAGE_COLUMNS = ("_snapshot_file", "_part", "_block", "_pos")


def lineage() -> list[Column]:
    """File and place of a row; rows of a file split over tasks are ordered by block."""
    return [
        snapshot_name("_metadata.file_path").alias("_snapshot_file"),
        F.col("_metadata.file_name").alias("_part"),
        F.col("_metadata.file_block_start").alias("_block"),
    ]


def with_position(df: DataFrame) -> DataFrame:
    """Number rows in reading order; applied straight to a file scan."""
    return df.withColumn("_pos", F.monotonically_increasing_id())


def snapshot_name(path) -> Column:
    """Snapshot a path belongs to: the file itself, or the ``.json`` folder of part files it lies in."""
    return F.regexp_extract(F.col(path), r"([^/=]+\.json)(/|$)", 1)


def read_json(spark: SparkSession, paths, schema, multi_line=True) -> DataFrame:
    """Rows of JSON files or folders with their origin.

    ``multi_line=True`` reads a JSON array in one task per file, ``"split"`` in
    one task per byte range, with a second pass over the files; ``False`` is for
    JSON Lines, which Spark splits itself.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if multi_line == "split":
        item = F.from_json("_text", schema).alias("item")
        return arrays.read_objects(spark, paths).select(
            item, snapshot_name("_path").alias("_snapshot_file"), F.element_at(F.split("_path", "/"), -1).alias("_part"),
            "_block", "_pos").select("item.*", *LINEAGE_COLUMNS)
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("recursiveFileLookup", True)
    return with_position(reader.json(paths).select("*", *lineage()))


def project_tickets(df: DataFrame) -> DataFrame:
    """The agreed ticket fields, plus lineage columns where present."""
    fields = [f.name for f in schemas.RAW_TICKET.fields]
    extra = [c for c in LINEAGE_COLUMNS if c in df.columns]
    return df.select(*fields, *extra).withColumn("updated_at", blank_to_null("updated_at"))


def flatten_issue(df: DataFrame) -> DataFrame:
    """Nested issue objects as flat columns; a missing object gives NULLs."""
    extra = [c for c in LINEAGE_COLUMNS if c in df.columns]
    return df.select(
        "id", "number", "identifier", "title", "description",
        F.col("createdAt").alias("created_at"), F.col("updatedAt").alias("updated_at"),
        F.col("archivedAt").alias("archived_at"), F.col("completedAt").alias("completed_at"),
        F.col("canceledAt").alias("canceled_at"), F.col("startedAt").alias("started_at"),
        F.col("dueDate").alias("due_date"),
        "priority", "estimate", "trashed",
        F.col("state.id").alias("state_id"), F.col("state.name").alias("state_name"),
        F.col("state.type").alias("state_type"),
        F.col("assignee.id").alias("assignee_id"), F.col("assignee.name").alias("assignee_name"),
        F.col("assignee.email").alias("assignee_email"),
        F.col("project.id").alias("project_id"), F.col("project.name").alias("project_name"),
        F.col("team.id").alias("team_id"), F.col("team.name").alias("team_name"),
        F.col("parent.id").alias("parent_id"), F.col("parent.identifier").alias("parent_identifier"),
        F.col("cycle.id").alias("cycle_id"), F.col("cycle.name").alias("cycle_name"),
        F.col("cycle.startsAt").alias("cycle_starts_at"), F.col("cycle.endsAt").alias("cycle_ends_at"),
        join_labels("labels.nodes").alias("labels"),
        *extra,
    )


def read_tickets(spark: SparkSession, paths, multi_line=True) -> DataFrame:
    return project_tickets(read_json(spark, paths, schemas.RAW_TICKET, multi_line))


def read_issues(spark: SparkSession, paths, multi_line=True) -> DataFrame:
    return flatten_issue(read_json(spark, paths, schemas.RAW_ISSUE, multi_line))


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """Sidecar files written beside each snapshot, with the snapshot each belongs to; no rows where there are none."""
    name = F.regexp_extract("_metadata.file_path", r"([^/=]+\.meta\.json)(/|$)", 1)
    rows = (
        spark.read.schema(schemas.MANIFEST).option("multiLine", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json").json(path).select("*", name.alias("file_name"))
    )
    snapshot = F.regexp_replace("file_name", r"\.meta\.json$", ".json").alias("snapshot_file")
    return rows.filter("file_name <> ''").select("*", snapshot)


def explode_json(df: DataFrame, col, schema) -> DataFrame:
    """One row per element of a JSON array held as text, with its position."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    keep = [c for c in df.columns if c != col]
    elements = F.from_json(F.col(col), f"array<{ddl}>")
    return df.select(*keep, F.posexplode(elements).alias("pos", "item")).select(*keep, "pos", "item.*")


def list_files(spark: SparkSession, folder, prefix) -> DataFrame:
    """Snapshots of one feed, a file or a folder of part files each.

    Sidecars are left out and contents are not read.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json").load(folder)
    )
    name = F.col("file_name")
    root = F.regexp_extract("path", r"^(.*?/[^/]+\.json)(/|$)", 1)
    return (
        files.select(root.alias("path"), snapshot_name("path").alias("file_name"), "length")
        .filter(name.startswith(f"{prefix}_") & ~name.endswith(".meta.json"))
        .groupBy("path", "file_name").agg(F.sum("length").alias("length"))
    )


def plan_files(files: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Files still to load, in name order, with the rule each one follows."""
    pending = files if log is None else not_loaded(files, log)
    return (
        pending.withColumn("incremental", is_incremental("file_name"))
        .withColumn("snapshot_ts", snapshot_ts("file_name"))
        .orderBy("file_name")
    )


def expired_snapshots(files: DataFrame, as_of, days=90, name="file_name") -> DataFrame:
    """Snapshot files older than the retention time, judged by the stamp in the name."""
    cutoff = F.date_sub(F.lit(as_date(as_of)), days).cast("timestamp")
    return files.filter(is_incremental(name) & (snapshot_ts(name) < cutoff))


def month_windows(spark: SparkSession, start, end) -> DataFrame:
    """Windows ``[window_start, window_end)``, one per month, for a backfill."""
    after = F.date_add(F.lit(as_date(end)), 1)
    return month_series(spark, start, end).select(
        F.col("month").alias("window_start"), F.least(F.add_months("month", 1), after).alias("window_end"))


def snapshot_date(file="_snapshot_file") -> Column:
    """Day in a file name, for partitioning; NULL for files without a stamp."""
    return snapshot_ts(file).cast("date")

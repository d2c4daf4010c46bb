"""Marks table: the greatest stored time per id, kept beside the history in buckets by id.

A load needs the marks of its own ids only, so it reads their buckets and not the history. The table is a list of builds
and a manifest. Folding files in writes the buckets they touch to a new build and then appends one manifest row, which
makes the build count for these buckets and names the files; the rest of the table stays where it is. A run that stops
before the manifest row leaves the table as it was, and the files are folded in by the next one.

Only files that are logged are ever folded in, at the start of a later load. So the marks never hold rows of a load that
is still to be repeated, and every history row is read once for them. There is one writer at a time, as for the log.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowtide.operators.history import high_water_mark
from flowtide.sources import files

#: Buckets of a new table; a table keeps the number it began with.
BUCKETS = 64
MANIFEST = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("build", T.StringType()), T.StructField("of", T.IntegerType()),
    T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("files", T.ArrayType(T.StringType()))])


def bucket(key, of) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(of)).cast("int").alias("bucket")


class Marks:
    """The marks table at ``path``, as its manifest has it now."""

    def __init__(self, spark: SparkSession, path, key_type, key="id", ts="updated_at", buckets=BUCKETS):
        self.spark, self.path, self.key, self.ts = spark, path.rstrip("/"), key, ts
        self.schema = T.StructType([T.StructField(key, key_type), T.StructField("high_water", T.StringType())])
        # One row per fold: its build, its buckets (a fixed number) and one short name per file.
        rows = files.read_or_empty(spark, f"{self.path}/manifest", MANIFEST).orderBy("seq").collect()
        self.seq = rows[-1].seq if rows else 0
        self.of = rows[0].of if rows else buckets
        self.folded = {name for r in rows for name in r.files}
        self.builds = {b: r.build for r in rows for b in r.buckets}

    def read(self, buckets=None) -> DataFrame:
        """Marks of the given buckets, or all: ``key`` and ``high_water``, one row per id."""
        wanted = self.builds if buckets is None else [b for b in buckets if b in self.builds]
        paths = [f"{self.path}/build={self.builds[b]}/bucket={b}" for b in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def fold(self, rows: DataFrame, names) -> "Marks":
        """The table with the marks of ``rows``, the history rows of the files ``names``. A row without an id has none."""
        fresh = high_water_mark(rows.filter(F.col(self.key).isNotNull()), self.key, self.ts)
        fresh = files.landed(fresh.select("*", bucket(self.key, self.of)))
        touched = _distinct(fresh)
        build = uuid.uuid4().hex
        if touched:
            old = self.read(touched).select("*", bucket(self.key, self.of))
            merged = old.unionByName(fresh).groupBy("bucket", self.key).agg(F.max("high_water").alias("high_water"))
            merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/build={build}")
        row = [(self.seq + 1, build, self.of, touched, sorted(names))]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return Marks(self.spark, self.path, self.schema[0].dataType, self.key, self.ts)

    def of_rows(self, rows: DataFrame) -> DataFrame:
        """Marks that ids of ``rows`` may have: whole buckets, no others."""
        return self.read(_distinct(rows.filter(F.col(self.key).isNotNull()).select(bucket(self.key, self.of))))

    def drop_old_builds(self) -> int:
        """Remove builds that no bucket is read from any more; returns how many."""
        live = set(self.builds.values())
        dead = [n for n in files.children(self.spark, self.path) if n.startswith("build=") and n[6:] not in live]
        for name in dead:
            files.remove(self.spark, f"{self.path}/{name}")
        return len(dead)


def _distinct(rows: DataFrame) -> list[int]:
    """The buckets that occur: at most as many numbers as the table has buckets."""
    return sorted(r.bucket for r in rows.select("bucket").distinct().collect())


def known(rows: DataFrame, names, history: DataFrame, logged, marks: Marks) -> DataFrame:
    """Stored marks against which the files ``names``, with these ``rows``, are to be judged: those of all other files.

    ``logged`` are the names of the files loaded so far. Those the table lacks are folded in first, from their own
    partitions of the history. If the table already holds one of ``names``, as when a late part of a snapshot comes
    after other loads, its own rows cannot be told apart there, and the marks come from the history instead.
    """
    if marks.folded & set(names):
        own = F.col("_source_file").isin(list(names))
        return high_water_mark(history.filter(~own), marks.key, marks.ts)
    todo = set(logged) - marks.folded - set(names)
    if todo:
        marks = marks.fold(history.filter(F.col("_source_file").isin(sorted(todo))), todo)
    return marks.of_rows(rows)

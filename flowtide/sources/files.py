"""Tables as files in shared storage: read or empty, landed once, listed, removed."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from flowtide.session import scratch_dir


def read_or_empty(spark: SparkSession, path, schema) -> DataFrame:
    """A Parquet table, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def landed(df: DataFrame, *partition) -> DataFrame:
    """``df`` written once to the shared scratch folder: what reads it several times neither computes it again nor
    depends on an executor that may be lost."""
    path = f"{scratch_dir(df.sparkSession)}/landed"
    df.write.partitionBy(*partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def children(spark: SparkSession, path) -> list[str]:
    """Names in a folder of any file system Spark reads, none if there is no such folder."""
    system, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def remove(spark: SparkSession, path) -> None:
    """Remove a file or a folder with all it holds."""
    system, folder = _folder(spark, path)
    system.delete(folder, True)

"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores=8, shuffle_partitions=8, memory="16g") -> SparkSession:
    """A local session for tests and timing; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flowtide")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may leave that unset and gets a temporary folder; elsewhere executors would each write to
    their own disk, which is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="flowtide-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"

"""Session settings and lineage cuts that survive the loss of an executor."""

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# What the plans rely on. Everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores="*", shuffle_partitions=8, memory="8g", **extra) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("metaloom")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    # Python workers find the package wherever the session was started from.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession):
    """The folder that the driver and all executors share, which the cluster names in `spark.checkpoint.dir`.

    Only a local session, as in tests, may leave it unnamed; a folder of our own stands in for it.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.path.join(tempfile.mkdtemp(prefix="spark-"), "cut")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)

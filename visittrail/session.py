"""Session settings the jobs rely on, and the folder they share."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins on a key that holds a large share of the rows are split at run time,
    # also where the split costs one more shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables that lie together by some of a join's keys are joined where they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Groups of rows that are sorted already are read through in one pass.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Rows of steps are many times larger in memory than in a shuffle. Shuffles start with many
    # parts, so that these stay small on large tables, and are put together to this size.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir; a local session without one gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="visittrail-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared}/{name}-{uuid.uuid4().hex}"

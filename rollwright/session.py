"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings every plan of this package relies on.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when a later aggregate then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession, partitions: int | None = None, split_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    ``partitions`` is the number that shuffles start with (adaptive execution merges small ones), about one
    for each 128 MB of input; ``split_bytes`` the most that one scan task reads. Left out, the cluster's own
    settings hold.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if partitions is not None:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    if split_bytes is not None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under a path, from their listing: no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def build_session(app: str = "rollwright", master: str | None = None, **settings: str) -> SparkSession:
    """Build a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a temporary folder: a
    machine-local path would be lost with its executor on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollwright-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, named after this application too; never one that exists."""
    return f"{scratch_root(spark)}/rollwright/{label}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> int:
    """Delete every copy that this application has written to the shared folder; how many there were.

    Results that were not written elsewhere cannot be read afterwards.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/rollwright/*-{context.applicationId}-*")
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    found = system.globStatus(path) or []
    return sum(system.delete(status.getPath(), True) for status in found)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of executors.

    Used where several outputs share a parent, or where a value (a partition number, a position)
    must not change if a task runs again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins from runtime sizes (that is the size check
# behind every broadcast of a table whose size grows with the data), splits skewed join
# partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where the split adds an exchange: chained joins on one key, a group-by on the join key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # recording the Python call site of every column costs several calls into the JVM each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "forecourt",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the defaults above.

    On a cluster call it without ``master``; the submitter decides. ``shuffle_partitions``
    should be sized so one partition holds roughly 128-256 MB of shuffle data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of the largest input table, or of a shuffle, that one task should take.
BYTES_A_TASK = 8 << 20


def sized_session(spark: SparkSession, input_bytes: int, bytes_a_task: int = BYTES_A_TASK) -> SparkSession:
    """A session whose shuffles have a partition for every ``bytes_a_task`` of the input.

    With a fixed number of shuffle partitions the rows, and so the memory, of a task grow with the input. Where
    ``spark`` has partitions enough it is returned itself; else a new session of the same application with
    all its settings, more partitions, an advisory size that keeps AQE from joining them again beyond
    ``bytes_a_task``, and scans of at most four times that. ``spark`` stays as it is.
    """
    parts = -(-input_bytes // bytes_a_task)
    if parts <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return spark
    sized, initial = spark.newSession(), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sized.conf.set(key, value)
    sized.conf.set("spark.sql.shuffle.partitions", str(parts))
    if int(spark.conf.get(initial, None) or parts) < parts:
        sized.conf.set(initial, str(parts))
    sized.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{bytes_a_task}b")
    sized.conf.set("spark.sql.files.maxPartitionBytes", f"{4 * bytes_a_task}b")
    return sized


def shared_dir(spark: SparkSession, sub: str = "") -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at storage every executor sees; it is read, never
    overridden. Only when it is unset and the master is local (local runs, tests) is a fresh
    local folder registered as the checkpoint directory; on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
    else:
        base = sc.getCheckpointDir()
        if base is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is not set: point it at storage every executor "
                                   "can read and write (a machine-local folder does not work on a cluster)")
            base = tempfile.mkdtemp(prefix="forecourt-ckpt-")
            sc.setCheckpointDir(base)
    return os.path.join(base, sub) if sub else base


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the shared folder; Hadoop deletes it when the driver exits."""
    path = shared_dir(spark, f"scratch/{tag}-{uuid.uuid4().hex}")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: its plan runs once however often the result
    is used, and its lineage ends at files every executor sees."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

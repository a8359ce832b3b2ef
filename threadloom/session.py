"""Session set-up shared by jobs, queries, the benchmark and the tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# All of these may be changed on a running session.
RUNTIME_CONF = {
    # Text dates without an offset are read, and all dates are written, in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Work lists may be GBK files; the CSV reader knows that charset only with this switch.
    "spark.sql.legacy.javaCharsets": "true",
    # Bytes that are no character of a file's charset become U+FFFD instead of ending the run.
    "spark.sql.legacy.codingErrorAction": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings the operators rely on into a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_spark(app: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``__`` in keyword names stands for a dot."""
    builder = SparkSession.builder.appName(app)
    # Call sites of every column expression cost several round trips to the JVM each.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and hand-off tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if path is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            path = tempfile.mkdtemp(prefix="threadloom-")
        context.setCheckpointDir(path)
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other run uses; nothing is created yet."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


_handed_out: list[str] = []


def clear(spark: SparkSession) -> int:
    """Delete the hand-off tables and folders that this process has made; their number.

    Results that are not yet written still read them, so this is the last call of a run.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _handed_out:
        path = jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back.

    Computed once, safe when executors are lost, read by column, and of a size Spark knows.
    """
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

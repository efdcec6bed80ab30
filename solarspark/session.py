"""Session settings the library relies on, and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00", "UTC+0"}


def get_spark(app_name: str = "solarspark", master: str | None = None, **conf) -> SparkSession:
    """Session with UTC time, ANSI arithmetic and adaptive skew handling."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording the Python line of every column expression doubles planning time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Zone shifts of instants are right only in a UTC session; refuse any other."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")


def _shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="solarspark-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from there, lineage cut."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    return f"{_shared_folder(spark)}/stage-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """The same as a table, for frames that are joined next.

    Unlike a checkpoint it tells the planner its size and claims no partitioning, so
    a join shuffles both sides itself and can split a dominant key. The table belongs to
    the application and is deleted when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)

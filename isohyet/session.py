"""A session with the settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution, skew-join splitting, checkpoints that go once nothing reads them; on a cluster leave master and partitions to its own settings."""
    builder = SparkSession.builder.appName("isohyet")
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.ui.enabled": "false", "spark.cleaner.referenceTracking.cleanCheckpoints": "true", **conf}
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return builder.config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Where the setting is absent a new local folder is taken, but only where the master is local: other machines would not
    see it.
    """
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='isohyet-')}")
    return context._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession) -> str:
    """A new name for a folder below the shared one; who asks for it drops it."""
    return f"{shared_folder(spark)}/isohyet/{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Computed once and written to the shared folder, for results that several branches of a plan read."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As durable(), but as Parquet: several readers take the columns and rows that each needs."""
    folder = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

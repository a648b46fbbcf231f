"""Session helpers: table access, lineage cuts and the local test session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session() -> SparkSession:
    """The launcher's session, if there is one (spark-submit, a notebook, a remote), with its own master and settings; else a local one."""
    launched = SparkSession.getActiveSession() is not None or any(x in os.environ for x in ("PYSPARK_GATEWAY_PORT", "SPARK_REMOTE"))
    return SparkSession.builder.getOrCreate() if launched else local_session()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder of ``spark.checkpoint.dir``; only a local master gets one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="annulet-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, without its lineage.

    Set ``spark.cleaner.referenceTracking.cleanCheckpoints`` when the session is made, so that what is no longer
    referred to is removed.
    """
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for text that is written to be read again."""
    _checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}/{name}"


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for costly work per row over input that came in few pieces."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

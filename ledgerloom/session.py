"""Session settings for local runs, and where long lineages are cut on a cluster."""

from __future__ import annotations

import os
import tempfile
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """A session for tests and the bench. A cluster brings its own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running this job")
    return _own_folder(sc.applicationId)


@lru_cache(None)
def _own_folder(application: str) -> str:
    """One temporary folder per local session."""
    return tempfile.mkdtemp(prefix=f"ledgerloom-{application}-", dir=os.environ.get("TMPDIR", "/tmp"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the frame as a Parquet table in the shared folder and go on from there.

    A stored table survives the loss of executors, is columnar, and has a known size, so later joins
    can pick their strategy by it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session helpers: a tuned builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "headway", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    The time zone is explicit because hour and weekday of a reading depend on it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        # Recording the Python call site of every column expression slows plan building noticeably.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables that every executor can reach.

    The root is ``spark.checkpoint.dir``. Only a local-mode session without that setting
    falls back to the machine's temporary folder; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="headway-")
    return f"{root.rstrip('/')}/headway/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the stored table.

    For a small result that several branches of a plan use: it is computed once, its size is known
    when the rest is planned, and losing an executor does not mean computing it again.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Fixed value: Spark's switch that removes the shuffle files of a query when the query ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside, streams started inside included, leave no shuffle files behind.

    Else the files stay until the driver happens to collect its garbage, and those of many large steps pile up on the disks.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

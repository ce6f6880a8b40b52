"""Session settings, and the shared folder for stage tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Stored pages, records and tables take half to two thirds of the disk they take with Spark's default codec.
CODEC = "zstd"
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "leafmill", cores: int | str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one stands in on a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a stage table, in the folder all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Stage table: written once to the shared folder, read by all later uses, column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the query that wrote them has ended, not when the driver happens to collect garbage.

    For steps that go on from stage tables; a data frame that is run again inside shuffles again.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)

"""Tables that are written once and read several times, in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Has Spark remove a write's shuffle files when it ends: what is read again is the written table.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The paths that this process has given out.
MADE: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's spark.checkpoint.dir. A session on one machine may do without that setting and uses its
    warehouse; on a cluster, whose machines need not share the warehouse, its absence is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    MADE.append(f"{folder}/{name}-{uuid.uuid4().hex}")
    return MADE[-1]


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession) -> None:
    """Deletes all tables that `stored` and `scratch` have written in this process: once no result that reads them is needed."""
    while MADE:
        remove(spark, MADE.pop())


def written(df: DataFrame, path: str) -> DataFrame:
    """df, written as Parquet to path and read back; the shuffles of the write go when it ends."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.select("*").write.option("compression", "zstd").parquet(path)  # a plan made under this setting
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to a fresh shared path and read back: computed once, and without lineage to repeat."""
    return written(df, shared_path(df.sparkSession, name))


class Scratch:
    """Writes tables like `stored`, below one folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, shared_path(spark, name)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing lazy reads any more; the whole folder, if none are named."""
        for path in [f"{self.folder}/{name}" for name in names] or [self.folder]:
            remove(self.spark, path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Scratch]:
    """Tables that are deleted when the block ends: nothing lazy may still read them then."""
    keep = Scratch(spark, name)
    try:
        yield keep
    finally:
        keep.drop()

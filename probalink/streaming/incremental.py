"""Scoring of a stream: each batch asks only about rows whose key has no score yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], key: str, path: str, checkpoint: str) -> StreamingQuery:
    """Appends score(batch) to the Parquet table at path, batch by batch, and ends when the available input is done.

    Each batch has a folder of its own, overwritten when the batch is run again, so a restart neither repeats nor loses rows. Rows
    whose key is in an earlier batch's folder are skipped.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key])
        try:
            earlier = spark.read.parquet(path).where(f"batch < {number}")
            new = new.join(earlier.select(key), key, "left_anti")
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
        score(new).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

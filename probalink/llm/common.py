"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probalink.sources.storage import scratch, stored

__all__ = ["SLICE_BYTES", "SPACE", "fresh", "in_arrow", "scratch", "slices", "stored", "table", "text_of"]

#: Bytes of strings and lists that a Python operator handles at once: bounds its memory when texts are long.
SLICE_BYTES = 2_000_000
#: The ASCII white space that separates words.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """name, or a longer one where df has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about most bytes of its strings and lists, a row at least."""
    size = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
        elif pa.types.is_list(column.type):
            size += 8 * np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    part = np.cumsum(size) // most
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def in_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """df.mapInArrow, a slice of bounded size at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield function(part)

    return df.mapInArrow(run, schema)

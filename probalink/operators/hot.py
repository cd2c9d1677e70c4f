"""Joins of a table that may hold one key very often with one that has each key once."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot with more than one of SHARE rows, so that there are at most SHARE hot keys; TRACKED bounds what the sketch of a task holds.
SHARE, TRACKED = 1000, 1 << 13
#: Rows up to which a table isn't looked through: one task takes so many narrow rows of a key in a second, and a pass and the joins of
#: parts would cost as much, and memory of the driver's for their plans.
FEW = 250_000


def hashed(*keys: str) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, *keys: str) -> list[int]:
    """Hashes of the keys that hold more than one row in SHARE, by one pass with a sketch of frequent items, and at most SHARE of them.

    The sketch may miss a key just above the bound; which keys are found changes only how `joined` goes about its work.
    """
    rows = df.select(hashed(*keys).alias("h"))
    found = rows.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {SHARE}, {TRACKED})").alias("top")).first()
    return [item["item"] for item in found["top"] if item["count"] > found["n"] / SHARE] if found["n"] > FEW else []


def parted(df: DataFrame, keys: Sequence[str], hot: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """The rows of df whose keys aren't hot, and those whose keys are, told apart by joins with the broadcast hashes: as parts of the
    plan itself a thousand of them would be written into each of its descriptions, which the driver keeps."""
    name = "__hot"
    while name in df.columns:
        name = f"_{name}"
    table = F.broadcast(df.sparkSession.createDataFrame(pa.table({name: pa.array(hot, pa.int64())})))
    return tuple(df.join(table, hashed(*keys) == F.col(name), how) for how in ("left_anti", "left_semi"))


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: Sequence[int], how: str = "inner", null_safe: bool = False, grown: bool = False) -> DataFrame:
    """left.join(right, keys, how) for a right that has each key once, its columns after those of left.

    Rows of hot keys aren't shuffled: their partners, as many as there are hot keys, are broadcast. The rest is joined as usual, with
    no key that one task couldn't take. null_safe: null keys are equal. grown: right has more rows than Spark thinks, as what is made of
    exploded rows has, whose number it takes for that before the explode: it is sorted, not broadcast through the driver.
    """

    def plain(a: DataFrame, b: DataFrame, grown: bool = False) -> DataFrame:
        b = b.hint("merge") if grown else b
        if not null_safe:
            return a.join(b, list(keys), how)
        b = b.withColumnsRenamed({k: f"__right_{k}" for k in keys})
        condition = [a[k].eqNullSafe(b[f"__right_{k}"]) for k in keys]
        return a.join(b, condition, how).drop(*[f"__right_{k}" for k in keys])

    if not hot:
        return plain(left, right, grown)
    cold, warm = parted(left, keys, hot)
    return plain(cold, right, grown).unionByName(plain(warm, F.broadcast(parted(right, keys, hot)[1])))

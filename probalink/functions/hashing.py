"""Repeatable choices by hash: splits, samples and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def md5_mod(modulus: int, *parts: Column) -> Column:
    """The MD5 of the parts, joined by |, as an unsigned 128-bit number modulo `modulus` (below 2 ** 30)."""
    digest = F.md5(F.concat_ws("|", *parts))
    half = lambda start: F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)")
    rest = (half(1) % modulus * ((1 << 64) % modulus) + half(17) % modulus) % modulus
    return rest.cast("long")


def split(df: DataFrame, key: str, one_in: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(kept, held out): the rows whose key's hash is divisible by `one_in` are held out."""
    out = F.coalesce(md5_mod(one_in, F.col(key)) == 0, F.lit(False))
    return df.where(~out), df.where(out)


def hash_sample(df: DataFrame, key: str, seed: str, rows: int) -> DataFrame:
    """The `rows` rows of smallest seeded hashes: the same ones at every run, kept by a top-k without a full sort."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(rows)


def hash_numbered(df: DataFrame, key: str, seed: str, column: str, prefix: str = "IN-%05d") -> DataFrame:
    """df with numbers from 1 in the order of seeded hashes, formatted by prefix."""
    from probalink.operators.ids import dense_ids

    shuffled = dense_ids(df.withColumn("__order", F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))), ["__order", key], "__number")
    return shuffled.withColumn(column, F.format_string(prefix, F.col("__number"))).drop("__order", "__number")

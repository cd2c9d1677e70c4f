"""Groups of bounded size for verification; the components of the links are those of the linkage operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probalink.operators.graph import connected_components, with_minimum
from probalink.operators.hot import hot_keys, joined, parted

__all__ = ["buckets", "connected_components", "hot_keys", "joined", "parted", "with_minimum"]


def buckets(keyed: DataFrame, key: str, member: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The members of keys that two or more share: lists (members) of up to `most` for the small keys, each list once however many
    keys have it, and rows (key, member) for the larger ones. Keys are counted first, so no list grows beyond `most`; rows of hot keys
    meet their counts without a shuffle. keyed may be exploded rows, whose counts aren't broadcast."""
    shared = keyed.groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1")
    members = joined(keyed, shared, [key], hot_keys(keyed, key), grown=True)
    small = members.where(F.col("__n") <= most).groupBy(key).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return small.select("members").distinct(), members.where(F.col("__n") > most).select(key, member)

"""Dense numbers, unique assignment and even splits, without a single-task window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probalink.operators.hot import hot_keys, joined
from probalink.sources.storage import Scratch, stored


def dense_ids(df: DataFrame, order: Sequence[str | Column], column: str) -> DataFrame:
    """df with numbers 1 … n in the given order (which should be total).

    Rows are range-partitioned and sorted; each counts within its partition, and the partitions' sizes, one number a partition, give
    the offsets. df is written first: choosing the ranges reads it once more.
    """
    placed = stored(df, "numbered").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "ordered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__part").count().withColumn("__offset", F.coalesce(F.sum("count").over(before), F.lit(0))).select("__part", "__offset")
    return placed.join(F.broadcast(offsets), "__part").withColumn(column, F.col("__offset") + F.col("__row") + 1).drop("__part", "__row", "__offset")


def evenly(df: DataFrame, instances: int, key: str | None = None) -> DataFrame:
    """df in `instances` partitions: by the remainder of key, so that each takes its share of a dense key, or round robin."""
    if key is None:
        return df.repartition(instances)
    return df.repartitionById(instances, F.coalesce(F.pmod(F.col(key), F.lit(instances)), F.lit(0)).cast("int"))


def spread(state: DataFrame, at: str, alike: str, order: str, shared_from: int) -> DataFrame:
    """state with later choices for owners whose present ones are sure to be refused.

    Owners of one `alike` have the same choices from number shared_from on. Of two of them who have come that far, the later one (by
    order) can't have a choice up to the earlier one's: it is the earlier one's, or someone's who comes before both. So their numbers
    go up with their order, each at least one more than the one before it.
    """
    there = F.col(at) >= shared_from
    rank = F.row_number().over(Window.partitionBy(alike).orderBy(order))
    ahead = F.max(F.col(at) - F.col("__rank")).over(Window.partitionBy(alike).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    moved = state.where(there).withColumn("__rank", rank).withColumn(at, (F.col("__rank") + ahead).cast(state.schema[at].dataType)).drop("__rank")
    return state.where(~there).unionByName(moved)


def unique_assignment(
    owners: DataFrame, owner: str, order: str, offer: Callable[[Column], Column], value: str, most_rounds: int = 1000, alike: str | None = None, shared_from: int = 0, rounds: list[int] | None = None
) -> DataFrame:
    """(owner, value): each owner's first choice that no owner before it (by order) takes; owners left without one are absent.

    Deferred acceptance: every owner without a value proposes its next choice, and each value keeps the earliest of its proposers. The
    outcome is that of serving the owners one after another. offer(n) is an owner's choice number n, from 0 on, and null when it
    has no more. alike: a column whose equal values mean equal choices from number shared_from on: rivals for these are dealt out at
    once, by their order, instead of a round each. Raises if `most_rounds` don't do. rounds gets the number of each round made.
    """
    keep = Scratch(owners.sparkSession, "assignment")
    state = owners.withColumn("__at", F.lit(0))
    for number in range(most_rounds):
        if alike is not None:
            state = spread(state, "__at", alike, order, shared_from)
        if rounds is not None:
            rounds.append(number)
        proposals = keep(state.withColumn(value, offer(F.col("__at"))).where(F.col(value).isNotNull()), f"proposals-{number}")
        winners = proposals.groupBy(value).agg(F.min(F.struct(order, owner)).alias("__best"))
        judged = keep(joined(proposals, winners, [value], hot_keys(proposals, value)).withColumn("__won", F.struct(order, owner) == F.col("__best")), f"judged-{number}")
        keep.drop(f"proposals-{number}", *[f"judged-{number - 1}"] * (number > 0))
        if judged.where("NOT __won").isEmpty():
            return judged.select(owner, value)
        state = judged.withColumn("__at", F.col("__at") + F.when(F.col("__won"), 0).otherwise(1)).drop(value, "__best", "__won")
    raise RuntimeError(f"no stable assignment in {most_rounds} rounds")

"""Connected components by alternating large-star and small-star contractions (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from probalink.operators.hot import FEW, hot_keys, joined
from probalink.sources.storage import Scratch

MOST_ROUNDS = 60


def with_minimum(edges: DataFrame, hot: Sequence[int] | None = None, grown: bool = False) -> DataFrame:
    """Each edge (u, v) with m, the smallest v of its u. hot: the hot u, if they are known; edges of these aren't shuffled. grown: see `joined`."""
    return joined(edges, edges.groupBy("u").agg(F.min("v").alias("m")), ["u"], hot_keys(edges, "u") if hot is None else hot, grown=grown)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that an edge joins to another: the smallest node that it reaches.

    Edges may be empty, repeated, in either direction or from a node to itself; edges with a null end link nothing. Each round is
    written to the shared folder in place of the one before; the number of rounds grows with the logarithm of the longest path. Nothing is collected but the
    count and a checksum of a round's edges, observed while they are written, and the hashes of hubs, of which there are at most SHARE. Raises
    if it doesn't converge.
    """

    keep = Scratch(edges.sparkSession, "components")

    def round_of(df: DataFrame, number: int) -> tuple[DataFrame, tuple]:
        seen = Observation()
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        table = keep(df.observe(seen, F.count("*").alias("n"), checksum.alias("checksum")), f"round-{number}")
        if number:
            keep.drop(f"round-{number - 1}")
        return table, (seen.get["n"], seen.get["checksum"])

    given = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    current, now = round_of(given.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), 0)
    for number in range(MOST_ROUNDS):
        state = now
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # an edge of large has one of its ends as u, so its hubs are among those of both
        many = 2 * state[0] > FEW  # and then not to be broadcast, however small the files are that hold them
        hubs = hot_keys(both, "u") if many else []
        large = with_minimum(both, hubs, many).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        down = with_minimum(keep(large, f"large-{number}"), hubs, many)  # written, as the plan of the next step holds it several times
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        current, now = round_of(down.select(ends.alias("e")).select("e.u", "e.v").where("u != v").distinct(), number + 1)
        keep.drop(f"large-{number}")
        if now == state:
            nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError(f"components did not converge in {MOST_ROUNDS} rounds")


def labelled(nodes: DataFrame, edges: DataFrame, node: str = "node", a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all given nodes and edge ends; a node without edges is its own component."""
    every = nodes.select(F.col(node).alias("node")).union(edges.select(F.col(a))).union(edges.select(F.col(b))).where("node IS NOT NULL").distinct()
    return every.join(connected_components(edges, a, b), "node", "left").withColumn("component", F.coalesce("component", "node"))

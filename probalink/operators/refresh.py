"""Candidate pairs, decisions and clusters that follow changes of their records: what no change touches isn't made anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probalink.operators.graph import connected_components
from probalink.operators.linkage import KEYS, best_of, best_partners
from probalink.sources.storage import stored
from probalink.sources.versions import VersionedTable

#: What is kept of a pair, besides its ids.
PAIR = "name_sim double, vat_equal boolean, domain_equal boolean, postcode_equal boolean, score double, candidate_rank int, linked boolean"


def partners_after(now: DataFrame, fresh: DataFrame, gone: DataFrame, pairs: DataFrame, k: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The k best partners of every record of `now` among those with larger ids, as `best_partners(now, now, …, within=True)` gives them,
    with their score.

    pairs: those of the records before. fresh: records that are new or differ; gone: ids of records that are away or differ. A record
    whose list was full and loses a partner may have others that were cut off: it is compared with all again, as a fresh one is. Of
    the others, lists stay, and meet the fresh records alone.
    """
    ids = now.select("id")
    lists = pairs.groupBy("a_id").agg(F.max("candidate_rank").alias("n")).where(F.col("n") == k)
    lost = pairs.join(gone.select(F.col("id").alias("b_id")), "b_id", "left_semi").select("a_id").distinct()
    opened = lists.join(lost, "a_id", "left_semi").select(F.col("a_id").alias("id"))
    whole = stored(fresh.select("id").union(opened.join(ids, "id", "left_semi")).distinct(), "compared-anew")
    of = lambda left, right: best_partners(left, right, k, keys=keys, within=True, score="score")
    kept = untouched(pairs, gone).join(whole.select(F.col("id").alias("a_id")), "a_id", "left_anti")
    met = of(now.join(whole, "id", "left_anti"), fresh)
    columns = [c for c in met.columns if c != "candidate_rank"]
    rest = best_of(kept.select(columns).unionByName(met.select(columns)), "score", k)
    return of(now.join(whole, "id", "left_semi"), now).unionByName(rest)


def untouched(pairs: DataFrame, gone: DataFrame) -> DataFrame:
    """The pairs of which no record is gone."""
    for end in ("a_id", "b_id"):
        pairs = pairs.join(gone.select(F.col("id").alias(end)), end, "left_anti")
    return pairs


def components_after(ids: DataFrame, labels: DataFrame, before: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component), the smallest id that a record reaches over links (a_id, b_id), from the labels that held for the links before.

    Components that lost no link stand for their records by their label; of one that lost some, what links are left is followed anew.
    """
    on = ["a_id", "b_id"]
    lost, gained = before.join(links, on, "left_anti"), links.join(before, on, "left_anti")
    ends = lost.select(F.col("a_id").alias("id")).union(lost.select(F.col("b_id").alias("id"))).distinct()
    torn = labels.join(ends, "id", "left_semi").select("component").distinct().withColumn("torn", F.lit(True))
    known = labels.join(torn, "component", "left")
    at = F.when(F.col("torn").isNull(), F.col("component"))
    place = stored(ids.join(known, "id", "left").select("id", F.coalesce(at, F.col("id")).alias("at"), F.coalesce("torn", F.lit(False)).alias("torn")), "places")
    end = lambda name: place.select(F.col("id").alias(f"{name}_id"), F.col("at").alias(name))
    left = links.join(place.where("torn").select(F.col("id").alias("a_id")), "a_id", "left_semi").select(*on)
    edges = stored(left.union(gained.select(*on)).distinct().join(end("a"), "a_id").join(end("b"), "b_id").select("a", "b"), "links")
    found = connected_components(edges).withColumnsRenamed({"node": "at", "component": "found"})
    return place.join(found, "at", "left").select("id", F.coalesce("found", "at").alias("component"))


class KeptClusters:
    """Clusters of a record table, kept at `path` with the records, pairs and decisions that they rest on.

    decide: gives (a_id, b_id, linked) for pairs with their similarity, flags, and both records' columns after a_ and b_; it is asked
    about a pair once, until one of its records changes. A pair whose answer is null doesn't link and is asked about again.
    """

    def __init__(self, spark: SparkSession, path: str, decide: Callable[[DataFrame], DataFrame], k: int = 3, keys: tuple[str, ...] = KEYS):
        self.spark, self.decide, self.k, self.keys = spark, decide, k, keys
        self._tables = {name: VersionedTable(spark, f"{path}/{name}") for name in ("records", "pairs", "labels")}
        self._state = VersionedTable(spark, f"{path}/state")

    def read(self, name: str) -> DataFrame:
        """One of records, pairs and labels, as the last refresh that ended has left them."""
        return self._tables[name].read(self._state.read().first()[name])

    def refresh(self, records: DataFrame) -> DataFrame:
        """(id, component) of records, which have keys (`linkage.with_keys`) and unique ids: rows that the table lacks are added, rows
        that differ are changed, and what records lack goes. The result is that of a clustering from nothing; an empty table has no
        clusters. All tables get their place by one last step: a run that dies before has changed nothing, and of two at once one fails.
        """
        kind = records.schema["id"].dataType.simpleString()
        empty = {"records": f"id {kind}, hash string", "pairs": f"a_id {kind}, b_id {kind}, {PAIR}", "labels": f"id {kind}, component {kind}"}
        begun = bool(self._state.versions())
        old = {name: self.read(name) if begun else self.spark.createDataFrame([], schema) for name, schema in empty.items()}
        now = stored(records.withColumn("hash", F.sha2(F.to_json(F.struct(*records.columns)), 256)), "records")
        same = ["id", "hash"]
        fresh = stored(now.join(old["records"], same, "left_anti"), "fresh")
        gone = stored(old["records"].join(now, same, "left_anti").select("id"), "gone")
        pairs = stored(partners_after(now, fresh, gone, old["pairs"], self.k, self.keys), "pairs")
        known = untouched(old["pairs"], gone).where("linked IS NOT NULL").select("a_id", "b_id", "linked")
        open_pairs = pairs.join(known, ["a_id", "b_id"], "left_anti")
        for side in ("a", "b"):
            open_pairs = open_pairs.join(now.select(*[F.col(c).alias(f"{side}_{c}") for c in records.columns]), f"{side}_id")
        decided = known.unionByName(self.decide(open_pairs).select("a_id", "b_id", "linked"))
        pairs = stored(pairs.join(decided, ["a_id", "b_id"], "left").select("a_id", "b_id", *[c.split()[0] for c in PAIR.split(", ")]), "decided")
        links = lambda df: df.where("linked").select("a_id", "b_id")
        labels = components_after(now.select("id"), old["labels"], links(old["pairs"]), links(pairs))
        made = {"records": now.select(*same), "pairs": pairs, "labels": labels}
        numbers = {name: self._tables[name].replace(df) for name, df in made.items()}
        self._state.replace(self.spark.createDataFrame([tuple(numbers.values())], ", ".join(f"{name} int" for name in numbers)))
        return self.read("labels")

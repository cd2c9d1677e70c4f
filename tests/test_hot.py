from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from probalink.operators import graph, hot


@pytest.fixture(autouse=True)
def small_tables_count(monkeypatch):
    for module in (hot, graph):
        monkeypatch.setattr(module, "FEW", 5_000)


def skewed(spark, n=20_000):
    """Rows of which key 7 has a third, null a tenth, and the rest few each."""
    rng = random.Random(4)
    rows = [(7 if k % 3 == 0 else None if k % 10 == 1 else rng.randrange(n), k) for k in range(n)]
    return spark.createDataFrame(rows, "k long, v long"), rows


def test_hot_keys_are_found(spark):
    df, _ = skewed(spark)
    hashes = {r.k: r.h for r in df.select("k", hot.hashed("k").alias("h")).distinct().collect()}
    assert set(hot.hot_keys(df, "k")) == {hashes[7], hashes[None]}
    assert hot.hot_keys(df.where("k IS NOT NULL AND k != 7"), "k") == [] and hot.hot_keys(df.where("false"), "k") == [] and hot.hot_keys(df.limit(50), "k") == []


def test_hot_joins_give_the_same_rows(spark):
    df, rows = skewed(spark)
    right = spark.createDataFrame([(7, "seven"), (None, "none"), *[(k, str(k)) for k in range(0, 20_000, 2) if k != 7]], "k long, name string")
    found = hot.hot_keys(df, "k")
    for how in ("inner", "left", "left_semi", "left_anti"):
        for null_safe in (False, True):
            own = sorted(map(repr, hot.joined(df, right, ["k"], found, how, null_safe).collect()))
            assert own == sorted(map(repr, hot.joined(df, right, ["k"], [], how, null_safe).collect())) and len(own) > 0


def test_hot_keys_are_not_shuffled(spark):
    df, _ = skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = df.where("k IS NOT NULL").toDF("u", "v")
        plan = graph.with_minimum(edges)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent}


def test_components_of_hubs(spark):
    rng = random.Random(6)
    edges = [(10**6, k) for k in range(9000)] + [(k, k + 1) for k in range(20_000, 20_400)] + [(rng.randrange(30_000, 60_000), rng.randrange(30_000, 60_000)) for _ in range(8000)]
    found = graph.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {k: v for k, v in union_find([e for e in edges if e[0] != e[1]]).items()}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert found.groupBy("node").count().where(F.col("count") > 1).isEmpty()

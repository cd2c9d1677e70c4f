"""Every query of the reference's operators gives what its SQL gives in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__
from probalink.plans import more, queries as plans  # noqa: F401

DATA = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, bool) or not hasattr(value, "__float__"):
        return value
    return float(f"{float(value):.9g}")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    other = duck.sql(plans.SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    rows = [{c: plain(v) for c, v in zip(df.columns, r)} for r in df.collect()]
    expected = [dict(zip(other.columns, map(plain, r))) for r in other.fetchall()]
    key = lambda r: repr([r[c] for c in columns])
    assert sorted(rows, key=key) == sorted(expected, key=key)


def test_components_of_the_whole_graph(spark, duck, tmp_path):
    def found(sf):
        rows = plans.QUERIES["components_l17_a6_j10"](spark, sf).collect()
        assert len({r.node for r in rows}) == len(rows)
        return {r.node: r.component for r in rows}

    def expected(edges):
        root = {x: x for e in edges for x in e}

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in edges:
            low, high = sorted((top(a), top(b)))
            root[high] = low
        return {x: top(x) for x in root}

    assert found(DATA) == expected(duck.sql("SELECT 'c' || o_custkey, 's' || l_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey").fetchall())
    # a hub, a long chain and pairs, of small orders and quantities
    edges = [(k, 1) for k in range(1, 60)] + [(100 + k // 2, 100 + (k + 1) // 2) for k in range(120)] + [(300 + k, 300 + k) for k in range(20)]
    spark.createDataFrame([(i, c, 1.0) for i, (c, _) in enumerate(edges)], "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(i, x, 1.0) for i, (_, x) in enumerate(edges)], "l_orderkey long, l_suppkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    whole = found(str(tmp_path))
    assert whole == expected([(f"c{c}", f"s{x}") for c, x in edges]) and len(set(whole.values())) == 22


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from probalink.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]  # the remainder of SQL
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append((c, d == len(turns)))
    children = defaultdict(set)
    for p in nodes:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    least = {p: min(c for c, _ in m) for p, m in nodes.items()}
    ends = {p: hashlib.sha256(",".join(map(str, sorted(c for c, end in m if end))).encode()).hexdigest() for p, m in nodes.items()}
    return [(least[p], len(p), least[p[:-1]] if p else None, len(m), len(children[p]), leaves[p], saved[p], ends[p]) for p, m in nodes.items()]


def found(spark, rows, copies=1):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("x"), "path": F.lit("y"), "words": F.lit(1)})
    return prefix_trie.trie(prefix_trie.branched(prefix_trie.turn_arrays(df)))


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 3 % 101 if n == 101 else c
        for turn in range(rng.randint(1, 6)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "user", None]), rng.choice(["a", "b c", "", None, "ä  ö\tü"])))
    return rows


def same(spark, rows):
    assert sorted(map(tuple, found(spark, rows).collect()), key=repr) == sorted(plain(rows), key=repr)


def test_op12_rows(spark):
    same(spark, conversations(1, 101) + [(None, 0, "user", "lost"), (-7, 0, "user", "a"), (-20, 1, "user", "b c")])


def test_op12_of_few_rows(spark):
    assert found(spark, []).count() == 0
    same(spark, [(5, None, None, None)])
    lonely = next(c for c in range(100) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    same(spark, [(lonely, 0, "user", "its turns go, and no other's come")])


@pytest.mark.parametrize("kept", [prefix_trie.KEPT, 20])
def test_op12_across_partitions(spark, monkeypatch, kept):
    """Copies and common first turns over many partitions, with deep conversations, and runs of ends that are sent early."""
    monkeypatch.setattr(prefix_trie, "KEPT", kept)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 1200) for t in range(8 if c % 3 else 2)]
    rows += [(c, t, "user", "deep") for c in range(3000, 3040) for t in range(60)] + [(c, 0, "user", f"own {c}") for c in range(5000, 5200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        same(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_op12_sql(spark):
    data = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{data}/conversations.parquet'")
    df = queries.QUERIES["op12_prefix_trie"](spark, data)
    rows = connection.sql(queries.SQL["op12_prefix_trie"])
    assert df.columns == rows.columns
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(rows.fetchall(), key=repr)

"""Blocks that are cut, candidates that no key connects, and neighbours of embeddings."""

from __future__ import annotations

import random
from collections import Counter
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from probalink.operators import linkage, neighbours

FIELDS = linkage.Fields("id", "name", ("none",), "none", "none", "none", "vat")


def keyed(spark, rows):
    df = spark.createDataFrame(rows, "id string, name string, vat string").withColumn("none", F.lit(None).cast("string"))
    return linkage.with_keys(df, FIELDS)


def records(n, seed):
    """A third of all share their first word."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    return [(f"{seed}{k:05}", None if k % 50 == 7 else f"{'north' if k % 3 == 0 else word()} {word()}", rng.choice([None, str(rng.randint(1, n // 2))])) for k in range(n)]


@pytest.mark.parametrize("within", [True, False])
def test_cut_blocks_give_the_same_pairs(spark, within):
    left = keyed(spark, records(300, 1))
    right = left if within else keyed(spark, records(200, 2))
    pairs = lambda **cut: sorted((r.a_id, r.b_id) for r in linkage.blocked(left, right, within=within, **cut).select("a_id", "b_id").collect())
    whole = pairs()
    assert whole == pairs(task=200, side=16) and len(set(whole)) == len(whole)
    a, b = ({r.id: r for r in df.collect()} for df in (left, right))
    share = lambda x, y: any(x[k] is not None and x[k] == y[k] for k in linkage.KEYS)
    assert whole == sorted((x.id, y.id) for x in a.values() for y in b.values() if share(x, y) and (not within or x.id < y.id))


def test_no_task_gets_a_large_block(spark, monkeypatch):
    """A third of 6,000 records in one block: no task makes over twice the median's pairs."""
    rows = keyed(spark, records(6000, 3)).repartition(8).cache()
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = linkage.blocked(rows, rows, within=True, task=20_000, side=64).groupBy(F.spark_partition_id().alias("p")).count()
        uncut = linkage.blocked(rows, rows, within=True).groupBy(F.spark_partition_id().alias("p")).count()
        n, whole = [r["count"] for r in cut.collect()], [r["count"] for r in uncut.collect()]
    finally:
        for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(c)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(n) == sum(whole) and len(n) == 16 and max(n) <= 2 * median(n) and max(whole) > 4 * median(whole)


def test_the_plan_of_cuts_stays_small(spark, monkeypatch):
    monkeypatch.setattr(linkage, "MOST_CUT", 1)
    rows = keyed(spark, records(300, 1))
    long = linkage.long_keys(rows, linkage.KEYS, "x").select("key_type", "key_value")
    assert linkage.cut_blocks(long, long, 4, 2).count() <= 1


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[-1] + 1, old[j + 1] + 1, old[j] + (x != y)))
    return row[-1]


def test_best_partners_are_those_of_all_pairs(spark):
    left, right = keyed(spark, records(120, 4)), keyed(spark, records(90, 5) + [("z", "North", None), ("y", "north  ltd", None)])
    extra = spark.createDataFrame([("400000", "500001"), ("400003", "500003"), ("400007", "500002")], "a_id string, b_id string")
    a, b = ([r.asDict() for r in df.collect()] for df in (left, right))
    more = {(r.a_id, r.b_id) for r in extra.collect()}
    expected = []
    for x in a:
        own = []
        for y in b:
            if (x["id"], y["id"]) in more or any(x[k] is not None and x[k] == y[k] for k in linkage.KEYS):
                p, q = x["name_norm"], y["name_norm"]
                sim = None if p is None or q is None else 1 - levenshtein(p, q) / max(len(p), len(q), 1)
                own.append((-((sim or 0.0) + (x["vat_digits"] is not None and x["vat_digits"] == y["vat_digits"])), y["id"], sim))
        expected += [(x["id"], i, s, n + 1) for n, (_, i, s) in enumerate(sorted(own, key=lambda o: (round(o[0], 12), o[1]))[:3])]
    found = linkage.best_partners(left, right, 3, also=extra)
    assert sorted((r.a_id, r.b_id, r.name_sim, r.candidate_rank) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("within", [True, False])
def test_large_blocks_are_searched_for_alike_names(spark, monkeypatch, within):
    """The best partners are those of all pairs, without a row for each pair of a large block."""
    monkeypatch.setattr(linkage, "FEW_PAIRS", 0)
    monkeypatch.setattr(linkage, "CELL_LEFT", 50)
    monkeypatch.setattr(linkage, "CELL_RIGHT", 40)

    def table(n, seed):
        rng = random.Random(seed)
        digits = lambda n: "".join(rng.choice("0123") for _ in range(n))
        name = lambda: rng.choice([None, "The Ltd", f"north {digits(5)}", f"north {digits(rng.randint(1, 60))}", f"south {digits(4)}", digits(80)])
        rows = [(f"{seed}{k:04}", name(), rng.choice([None, "1", "2", digits(5)]), rng.choice([None, "AB1", "AB2", "AB3"]), rng.choice(["North Road", "South Road", None])) for k in range(n)]
        df = spark.createDataFrame(rows, "id string, name string, vat string, code string, address string").withColumn("none", F.lit(None).cast("string"))
        return linkage.with_keys(df, linkage.Fields("id", "name", ("address",), "code", "none", "none", "vat")).cache()

    left = table(240, 1)
    right = left if within else table(180, 2)
    rows = lambda task: sorted(map(tuple, linkage.best_partners(left, right, 3, within=within, task=task, score="score").collect()), key=repr)
    whole = rows(10**9)
    asked = []
    real = linkage.blocked
    monkeypatch.setattr(linkage, "blocked", lambda *a, **b: asked.append(real(*a, **b)) or asked[-1])
    for task in (3000, 300):
        assert rows(task) == whole and len(whole) > 400
    all_pairs = real(left, right, within=within).count()
    assert asked[0].count() < 0.8 * all_pairs and asked[1].count() < 0.2 * all_pairs


def exact(ids, v, k, within=True):
    u = v / np.linalg.norm(v, axis=1)[:, None]
    cosine = u @ u.T
    out = {}
    for i in range(len(ids)):
        own = [(-round(cosine[i, j], 9), ids[j]) for j in range(len(ids)) if not within or ids[j] > ids[i]]
        out[ids[i]] = [b for _, b in sorted(own)[:k]]
    return out


def vectors(spark, v):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, e array<double>")


def test_neighbours_by_windows(spark, monkeypatch):
    """Clusters, and equal vectors that make a third of all: found in windows, with as many comparisons a record at any size."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((150, 16))
    v = np.concatenate([centres.repeat(8, 0) + 0.1 * rng.standard_normal((1200, 16)), np.ones((600, 16))])[rng.permutation(1800)]
    df = vectors(spark, v).union(spark.createDataFrame([(5000, None), (5001, [1.0]), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (None, [1.0] * 16)], "id long, e array<double>"))
    asked = []
    real = neighbours.around
    monkeypatch.setattr(neighbours, "around", lambda *a, **b: asked.append(a[-2]) or real(*a, **b))
    found = neighbours.nearest(df, df, "e", 3, 16, within=True, least=0.8, tables=6, probes=1).collect()
    assert asked and 6 * asked[-1] * neighbours.WINDOW < 1800  # by windows, not by all pairs
    right = {(a, b) for a, own in exact(range(1800), v, 3).items() for b in own if v[a] @ v[b] >= 0.8 * np.linalg.norm(v[a]) * np.linalg.norm(v[b])}
    got = {(r.a_id, r.b_id) for r in found}
    assert len(got & right) >= 0.98 * len(right) and all(n == 1 for n in Counter((r.a_id, r.candidate_rank) for r in found).values())
    ones = [i for i in range(1800) if v[i][0] == v[i][1] == 1.0]
    assert all((a, b) in got for a, b in zip(ones, ones[1:]))  # the next equal one is the nearest


def test_neighbours_reach_the_recall_or_say_so(spark, monkeypatch):
    """Random vectors have no near ones: probes are doubled until enough is found, all are compared where that is less, or it fails."""
    rng = np.random.default_rng(6)
    v = rng.standard_normal((1500, 24))
    df = vectors(spark, v)
    right = {(a, b) for a, own in exact(range(1500), v, 3).items() for b in own}
    found = {(r.a_id, r.b_id) for r in neighbours.nearest(df, df, "e", 3, 24, within=True, tables=2, probes=1).collect()}
    assert len(found & right) >= 0.9 * len(right)
    monkeypatch.setattr(neighbours, "MOST_PROBES", 1)
    with pytest.raises(ValueError, match="of the sample's neighbours"):
        neighbours.nearest(df, df, "e", 3, 24, within=True, tables=2, probes=1)


def test_windows_take_their_turn(spark, monkeypatch):
    """The same neighbours, with few rows dealt out at once."""
    rng = np.random.default_rng(9)
    v = (rng.standard_normal((100, 16)).repeat(6, 0) + 0.1 * rng.standard_normal((600, 16)))[rng.permutation(600)]
    df = neighbours.unit_vectors(vectors(spark, v), "e", 16).cache()
    dealt = []
    real = neighbours.compared
    monkeypatch.setattr(neighbours, "compared", lambda rows, *a: dealt.append(rows.count()) or real(rows, *a))
    found = lambda name: sorted(map(tuple, neighbours.around(neighbours.Scratch(spark, "turns"), name, df, df, 16, 3, 4, 2, True).collect()))
    whole = found("whole")
    monkeypatch.setattr(neighbours, "DEALT", 1)
    assert found("parts") == whole and len(whole) > 900 and len(dealt) > 4 and max(dealt[1:]) < dealt[0] / 3


@pytest.mark.parametrize("within", [True, False])
def test_all_vectors_are_compared_where_windows_find_too_few(spark, monkeypatch, within):
    """Random vectors, more than windows of MOST_PROBES cover: all exact neighbours, a group and slices of it at a time."""
    for name, value in (("MOST_PROBES", 1), ("GROUP", 300), ("SLICE", 100)):
        monkeypatch.setattr(neighbours, name, value)
    v = np.random.default_rng(8).standard_normal((900, 24))
    df = vectors(spark, v)
    found = neighbours.nearest(df, df, "e", 3, 24, within=within, tables=2, probes=1, every=True).collect()
    own = {}
    for r in sorted(found, key=lambda r: r.candidate_rank):
        own.setdefault(r.a_id, []).append(r.b_id)
    assert {a: b for a, b in exact(range(900), v, 3, within).items() if b} == own


def test_neighbours_of_two_tables(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.standard_normal((60, 8)), np.ones((50, 8))])
    right = vectors(spark, v)
    left = spark.createDataFrame([(7, np.ones(8).tolist()), (8, (-np.ones(8)).tolist()), (9, None)], "id long, e array<double>")
    rows = neighbours.nearest(left, right, "e", 3, 8).collect()
    assert sorted((r.b_id, r.candidate_rank) for r in rows if r.a_id == 7) == [(60, 1), (61, 2), (62, 3)]
    assert {r.a_id for r in rows} == {7, 8} and neighbours.nearest(left.limit(0), right, "e", 3, 8).count() == 0 and neighbours.nearest(left, right.limit(0), "e", 3, 8).count() == 0

"""Clusters that follow changes of their records are those of a clustering from nothing."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_candidates import keyed

from probalink.operators.linkage import best_partners
from probalink.operators.refresh import KeptClusters, components_after
from probalink.sources.versions import Conflict


def smallest_reached(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def made(rng, number):
    word = rng.choice(["north", "south", "east", None])
    return (f"r{number:03}", word and f"{word} {''.join(rng.choices('ab', k=3))}", rng.choice([None, *map(str, range(12))]))


def test_refreshes_equal_a_clustering_from_nothing(spark, tmp_path):
    rng = random.Random(4)
    asked = []

    def decide(pairs):
        answers = pairs.withColumn("linked", F.coalesce(F.col("name_sim") >= 0.75, F.lit(False)) | F.col("vat_equal")).select("a_id", "b_id", "linked").collect()
        asked.append({(r.a_id, r.b_id) for r in answers})
        return spark.createDataFrame(answers, "a_id string, b_id string, linked boolean")

    kept = KeptClusters(spark, str(tmp_path / "kept"), decide, k=2)
    records = {number: made(rng, number) for number in range(40)}
    changed = set(records)
    for step in range(4):
        rows = keyed(spark, list(records.values()))
        labels = {r.id: r.component for r in kept.refresh(rows).collect()}
        best = {(r.a_id, r.b_id, r.candidate_rank, r.score) for r in best_partners(rows, rows, 2, within=True, score="score").collect()}
        pairs = kept.read("pairs").collect()
        assert {(r.a_id, r.b_id, r.candidate_rank, r.score) for r in pairs} == best and len(pairs) == len(best)
        assert labels == smallest_reached([r[0] for r in records.values()], [(r.a_id, r.b_id) for r in pairs if r.linked])
        touched = {f"r{n:03}" for n in changed}
        before = set() if step == 0 else last
        assert all({a, b} & touched or (a, b) not in before for a, b in asked[-1])
        last = {(r.a_id, r.b_id) for r in pairs}
        changed = set() if step == 2 else set(rng.sample(sorted(records), 5))
        for n in sorted(changed):
            records[n] = made(rng, n)
        for n in list(changed)[:2]:
            del records[n]
        if changed:
            records |= {n: made(rng, n) for n in (50 + step, 15 - step)}
            changed |= {50 + step, 15 - step}
    assert asked[3] == set()
    assert kept.refresh(keyed(spark, [])).count() == 0


def test_components_are_cut_and_joined(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    rng = random.Random(8)
    ids = [f"n{k:02}" for k in range(30)]
    link = lambda: tuple(sorted(rng.sample(ids, 2)))
    before = {link() for _ in range(22)}
    for _ in range(3):
        after = set(rng.sample(sorted(before), 15)) | {link() for _ in range(6)}
        own = ids[: rng.randint(25, 30)]
        after = {(a, b) for a, b in after if a in own and b in own}
        old = smallest_reached(ids, before)
        found = components_after(frame([(i,) for i in own], "id string"), frame(list(old.items()), "id string, component string"), *[frame(sorted(x), "a_id string, b_id string") for x in (before, after)])
        assert {r.id: r.component for r in found.collect()} == smallest_reached(own, after)


def test_a_failed_refresh_changes_nothing(spark, tmp_path):
    fine = lambda pairs: pairs.withColumn("linked", F.col("vat_equal"))
    kept = KeptClusters(spark, str(tmp_path / "kept"), fine)
    rows = [("a", "north one", "1"), ("b", "north two", "1"), ("c", None, None)]
    assert {r.id: r.component for r in kept.refresh(keyed(spark, rows)).collect()} == {"a": "a", "b": "a", "c": "c"}

    def fails(pairs):
        raise ConnectionError("no answer")

    with pytest.raises(ConnectionError):
        KeptClusters(spark, str(tmp_path / "kept"), fails).refresh(keyed(spark, rows[:1]))
    kept._state.replace, real = lambda df: (_ for _ in ()).throw(Conflict("another was first")), kept._state.replace
    with pytest.raises(Conflict):
        kept.refresh(keyed(spark, rows[:1]))
    kept._state.replace = real
    assert kept.read("labels").count() == 3
    assert {r.id: r.component for r in kept.refresh(keyed(spark, rows[1:])).collect()} == {"b": "b", "c": "c"}

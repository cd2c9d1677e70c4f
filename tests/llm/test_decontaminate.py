from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from data import ODD, clashing, documents
from pyspark.sql import functions as F

from probalink.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(texts, items, window=10):
    windows = {}
    for name, text in items:
        own = words(text)
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[k : k + n]), set()).add("" if name is None else str(name))
    out = []
    for i, text in texts:
        own, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(own[k : k + n])]
        out.append((i, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def made(seed, n_docs, n_items, vocabulary):
    rng = random.Random(seed)
    some = lambda n: rng.choice([" ", ", ", "\n", "--"]).join(rng.choice([str.upper, str.lower])(rng.choice(vocabulary)) for _ in range(n))
    items = [(k, some(rng.choice([1, 4, 9, 10, 11, 30] if k % 3 else [12, 20]))) for k in range(n_items)]
    docs = []
    for k in range(n_docs):
        parts = [some(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            own = words(rng.choice(items)[1])
            a = rng.randint(0, len(own))
            parts += [" ".join(own[a : a + rng.randint(0, 30)]), some(rng.randint(0, 20))]
        docs.append((1000 + k, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize(("shard", "group"), [(decontaminate.SHARD, decontaminate.GROUP), (300, decontaminate.GROUP), (2000, 400)])
def test_op13_rows(spark, shard, group):
    docs, items = made(1, 200, 30, [f"w{k}" for k in range(60)] + ["ä", "É", "漢字", "1"])
    items = [i for i in items if len(words(i[1])) > 3] + [(None, "An item without a name but with words enough for it"), (99, None), (98, "..."), (7, items[3][1])]
    docs += ODD + [(5000, "x " * 3000 + items[0][1] + " y" * 3000 + " " + items[0][1] + "!"), (5001, items[0][1].upper()), (5001, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = clashing(documents(spark, docs))
    found = decontaminate.contamination(df, bench, shard=shard, group=group)
    assert sorted([tuple(r[c] for c in COLUMNS) for r in found.collect()], key=repr) == sorted(plain(docs, items), key=repr)
    clean = decontaminate.decontaminated(df, bench, shard=shard, group=group)
    assert clean.columns == df.columns
    bad = {(r[0], w) for r, (_, w) in zip(plain(docs, items), docs) if r[-1]}
    assert sorted([(r.doc_id, r.text) for r in clean.collect()], key=repr) == sorted([d for d in docs if d not in bad], key=repr)


def test_op13_short_items_and_nothing(spark):
    docs, items = made(2, 80, 12, [f"w{k}" for k in range(9)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents(spark, docs), bench)
    assert sorted([tuple(r[c] for c in COLUMNS) for r in found.collect()], key=repr) == sorted(plain(docs, items), key=repr)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents(spark, []), bench).count() == 0
    assert {r.contaminated for r in decontaminate.contamination(documents(spark, docs), none).collect()} == {False}
    assert decontaminate.decontaminated(documents(spark, docs), none).count() == len(docs)


def test_longest_match_and_spans(spark):
    item = " ".join(f"i{k}" for k in range(40))
    text = "a b " + " ".join(f"i{k}" for k in range(5, 30)) + " c " + " ".join(f"i{k}" for k in range(20, 32))
    row = decontaminate.contamination(documents(spark, [(1, text)]), spark.createDataFrame([(3, item)], "item_id long, text string")).first()
    assert (row.longest, row["items"], [tuple(s) for s in row.spans]) == (25, ["3"], [(2, 27), (28, 40)])


def test_words_of_equal_hashes_are_told_apart(monkeypatch):
    """With hashes that collide, matches still need equal bytes."""
    right = decontaminate.words_of

    def poor(data, begins):
        found = right(data, begins)
        found.hash = found.hash % np.uint64(3)
        return found

    monkeypatch.setattr(decontaminate, "words_of", poor)
    docs, items = made(3, 40, 6, [f"w{k}" for k in range(30)])
    items = [i for i in items if len(words(i[1])) >= 9]
    bench = decontaminate.prepared(items)
    for _, text in docs:
        data = np.frombuffer(text.encode(), np.uint8)
        found = decontaminate.matches(poor(data, np.zeros(1, np.int64)), bench)
        hit = {k for _, s, _, _, w in found for k in range(s, s + w)}
        assert len(hit) == plain([(1, text)], items)[0][2]


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 500)
    order = decontaminate.suffix_array(codes, 16).tolist()
    keys = [codes[k : k + 16].tolist() for k in order]
    assert keys == sorted(keys) and sorted(order) == list(range(500))


def test_op13_sql(spark):
    data = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for t in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = queries.QUERIES["op13_decontaminate"](spark, data)
    rows = connection.sql(queries.SQL["op13_decontaminate"])
    assert df.columns == rows.columns
    found = sorted(map(tuple, df.collect()), key=repr)
    assert found == sorted(rows.fetchall(), key=repr) and any(r[-1] for r in found)
    assert F is not None

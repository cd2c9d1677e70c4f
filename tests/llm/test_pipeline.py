from __future__ import annotations

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
from data import clashing, documents
from pyspark.sql import functions as F
from test_quality_and_pii import good, junk
from test_tokens import naive_packing
from tokenizers import Tokenizer

import corpus_pipeline
from probalink.llm import queries


def test_stages(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    filler = lambda n: " ".join(f"{chr(97 + n)}{k}x" for k in range(80))
    rows = [(k, good(k)) for k in range(40)] + [(100, junk(0)), (101, junk(1)), (200, good(3)), (300, f"{filler(0)}\n{passage}"), (301, f"{passage}\n{filler(1)}"), (302, f"Mail a.b@c.de {filler(2)}")]
    rows += [(400, None), (401, ""), (None, good(500))]
    docs = clashing(documents(spark, rows))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept["quality_rules"]) == {*range(40), 200, 300, 301, 302, None}
    assert set(kept["simhash_near_dedup"]) == set(kept["quality_rules"]) - {200}
    assert kept["substring_dedup"][301] == filler(1) and passage in kept["substring_dedup"][300]
    assert kept["pii"][302].startswith("Mail [EMAIL] ")
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in pieces} == set(kept["pii"])


def test_sql_of_this_subpackage(spark):
    sf = "/root/testdata/sf0.001"
    for name, sql in queries.SQL.items():
        connection = duckdb.connect()
        for table in ("documents", "pages", "labels", "embeddings", "benchmark", "conversations"):
            connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
        df, other = queries.QUERIES[name](spark, sf), connection.sql(sql)
        columns = sorted(df.columns)
        assert columns == sorted(other.columns)
        plain = lambda v: round(v, 9) if isinstance(v, float) else v
        found = [repr([plain(r[c]) for c in columns]) for r in df.collect()]
        expected = [repr([plain(r[other.columns.index(c)]) for c in columns]) for r in other.fetchall()]
        assert sorted(found) == sorted(expected), name


def plain_words(text):
    return (text or "").encode().lower().split()


def plain_pipeline(rows):
    """Which (id, text) rows stay after each of the first two stages, and the texts after the next two, by plain Python over small,
    well-separated documents: passages repeat whole, near copies differ in one word of many, junk is unmistakable."""
    kept = [(i, t) for i, t in rows if len(plain_words(t)) >= 10 and not any(c in (t or "") for c in "$|") and not (t or "").isupper()]
    kept = sorted(set(kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    first = []
    for i, t in kept:
        if not any(len(set(plain_words(t)) ^ set(plain_words(o))) <= 4 for _, o in first):
            first.append((i, t))
    seen, cleaned = set(), []
    for i, t in first:
        lines = []
        for line in t.split("\n"):
            if len(plain_words(line)) < 50 or tuple(plain_words(line)) not in seen:
                lines.append(line)
            seen.add(tuple(plain_words(line)))
        cleaned.append((i, "\n".join(lines)))
    return first, [(i, re.sub(r"\S+@\S+\.[a-z]+", "[EMAIL]", t)) for i, t in cleaned]


def test_run_is_that_of_a_plain_pipeline(spark, tmp_path):
    rng = random.Random(3)
    words = sorted({f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"})
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passage, repeated = prose(60), prose(200)
    rows = [(k, prose(rng.randrange(60, 250))) for k in range(60)]
    rows += [(100, f"{prose(80)}\n{passage}\n{prose(70)}"), (101, f"{passage}\n{prose(90)}"), (102, f"{prose(100)} mail me@there.org {prose(100)}")]
    rows += [(103, repeated), (104, repeated + " end"), (7, prose(150)), (7, repeated), (None, prose(120)), (None, repeated), (None, None), (105, ""), (106, "short")]
    rows += [(110 + k, junk(k)) for k in range(9)] + [rows[3], rows[3], (120, prose(3000))]
    documents(spark, rows).withColumns({"__text": F.lit("x"), "__id": F.lit(1), "sequence": F.lit(2)}).write.parquet(str(tmp_path / "documents.parquet"))
    first, expected = plain_pipeline(rows)
    assert {i for i, _ in first} == {*range(60), 100, 101, 102, 120, None} and len(first) == 67  # three texts have the id 7
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    wanted = []
    for i, text in expected:
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        wanted += [(i, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes()), ids[start:end]) for k, (start, end) in enumerate(zip(edges, edges[1:]))]
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, list(r.token_ids)) for r in rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and own[-1][1] <= 1024 and all(a[1] == b[0] for a, b in zip(own, own[1:]))
    assert len(sequences) == len(naive_packing([w[3] for w in wanted], 1024))
    documents(spark, []).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0

"""Small documents with every case that an operator must stand."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "Of orea nt lyeaing thre of tionre ereringre ingtioner esinti of reeation onatth for whreea thshin theth thth he anlynt"


def documents(spark, texts):
    """A table of documents; extra columns clash with names that operators make."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    names = ["n_tokens", "score", "kept", "fingerprint", "component_id", "piece", "length", "spans", "n_words", "content", "class", "line", "words", "__x"]
    return df.withColumns({n: F.lit("x") for n in names})


ODD = [(1, ""), (2, None), (3, " "), (4, "\n\n"), (5, "a"), (6, "a"), (None, "without an id"), (None, None), (7, "x" * 70_000), (8, "漢字 и ελληνικά 😀 " * 20), (9, PROSE), (9, PROSE), (10, "word " * 9000)]

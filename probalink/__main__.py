"""`python -m probalink`: lists the queries, or runs one of them or a script over a folder of Parquet tables."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from probalink.plans import more, queries  # noqa: F401  more adds its queries
from probalink.sources import tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="probalink", description=__doc__)
    parser.add_argument("what", help="a query's name, a script (.sql), or `list`")
    parser.add_argument("--tables", help="the folder of the tables; in a script, what {tables} stands for")
    parser.add_argument("--out", help="where the rows are written (default: 20 of them are shown)")
    parser.add_argument("--format", default="parquet", choices=("parquet", "csv", "json"))
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a value bound to :NAME in a script")
    given = parser.parse_args(argv)
    if given.what == "list":
        print("\n".join(sorted(queries.QUERIES)))
        return
    spark = SparkSession.builder.appName("probalink").getOrCreate()
    if given.what.endswith(".sql"):
        text = Path(given.what).read_text(encoding="utf-8").replace("{tables}", given.tables or "")
        df = tables.run_script(spark, text, dict(pair.split("=", 1) for pair in given.set))
    elif given.what in queries.QUERIES:
        df = queries.QUERIES[given.what](spark, given.tables)
    else:
        parser.error(f"no query {given.what!r}; see `list`")
    if df is not None and given.out:
        df.write.mode("error").format(given.format).save(given.out)
    elif df is not None:
        df.show(truncate=False)


if __name__ == "__main__":
    main()

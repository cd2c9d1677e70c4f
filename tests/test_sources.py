from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from probalink.__main__ import main
from probalink.operators import decide
from probalink.sources import tables
from probalink.streaming.incremental import score_stream


def test_register_csv(spark, tmp_path):
    header = ",".join(f" {h}" for h in tables.REGISTER_COLUMNS) + ",Other"
    rows = ['00000001,"ACME ""B"" LTD", 1 ROAD ,,LEEDS,,,LS1 1AA,X,Active,02/01/2020,s, ,zz']
    (tmp_path / "r.csv").write_text("\n".join([header, *rows]))
    row = tables.read_register(spark, str(tmp_path / "r.csv")).first()
    assert (row.company_number, row.company_name, row.address_line1, row.address_line2, row.previous_name, row.incorporation_date) == ("00000001", 'ACME "B" LTD', "1 ROAD", None, None, datetime.date(2020, 1, 2))
    (tmp_path / "bad.csv").write_text("\n".join([header, rows[0].replace("00000001", "")]))
    with pytest.raises(Exception, match="company_number is null"):
        tables.read_register(spark, str(tmp_path / "bad.csv")).collect()


def test_invoices_csv_and_sink(spark, tmp_path):
    df = tables.from_rows(spark, [(1, datetime.date(2020, 1, 1), "UK", "s", 1.0, 0.0, 0.2, "open", 1.0, datetime.date(2020, 2, 1), "c")], tables.INVOICE_SCHEMA)
    tables.write_csv(df, str(tmp_path / "out"), df.columns)
    tables.write_csv(df, str(tmp_path / "out"), df.columns)
    assert tables.read_invoices(spark, str(tmp_path / "out")).collect() == df.collect()
    assert tables.read_invoices(spark, str(tmp_path / "out"), infer=True).first().total == 1.0


def test_translations_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("company_number,registered_name,language,translated_name\n001,A,de,Ä GmbH\n")
    assert tuple(tables.read_translations(spark, str(tmp_path / "t.csv")).first()) == ("001", "A", "de", "Ä GmbH")


def test_row_ids_are_the_same_at_every_read(spark, tmp_path):
    spark.range(50).repartition(3).write.parquet(str(tmp_path / "p"))
    read = lambda: tables.with_row_id(spark.read.parquet(str(tmp_path / "p")))
    first = {r.id: r.row_id for r in read().collect()}
    assert first == {r.id: r.row_id for r in read().orderBy(F.desc("id")).collect()} and len(set(first.values())) == 50


def test_tables_are_replaced_and_dropped(spark):
    tables.create_schema(spark, "lab")
    tables.replace_table(spark.range(3), "scores")
    again = tables.replace_table(spark.table("scores").where("id > 0"), "scores")
    assert again.count() == 2
    assert tables.append(again, spark.range(1)).count() == 3 and tables.scalar(again.agg(F.count("*"))) == 2
    tables.drop_table(spark, "scores")
    assert not spark.catalog.tableExists("scores")


def test_scripts(spark, tmp_path, capsys):
    script = "CREATE OR REPLACE TEMP VIEW one AS\nSELECT 1 AS a, 'x/y' AS b\n/\n  /  \nSELECT a, b, :v AS c FROM one\n/\n"
    assert tuple(tables.run_script(spark, script, {"v": "it's; -- :a", "unused": 1}).first()) == (1, "x/y", "it's; -- :a")
    assert tables.run_script(spark, "/\n/") is None
    (tmp_path / "s.sql").write_text("SELECT :v AS v, '{tables}' AS t\n/")
    main([str(tmp_path / "s.sql"), "--tables", "here", "--set", "v=a=b", "--out", str(tmp_path / "out"), "--format", "json"])
    assert tuple(spark.read.json(str(tmp_path / "out")).select("v", "t").first()) == ("a=b", "here")
    main(["top_k_w1_x3", "--tables", "/root/testdata/sf0.001", "--out", str(tmp_path / "rows")])
    assert spark.read.parquet(str(tmp_path / "rows")).count() > 0
    main(["list"])
    assert "top_k_w1_x3" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["no_such_query"])


def test_secret(monkeypatch):
    monkeypatch.setenv("A_KEY", "v")
    assert tables.secret("A_KEY") == "v"
    with pytest.raises(RuntimeError):
        tables.secret("NO_KEY")


def test_stream_asks_each_key_once(spark, tmp_path):
    source = str(tmp_path / "in")
    score = lambda df: decide.classify_batch(df, decide.HashModel(("document",)))
    rows = lambda *ids: spark.createDataFrame([(i, f"d{i}") for i in ids], "id long, document string")
    for batch in ((1, 2), (2, 3)):
        rows(*batch).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id long, document string").parquet(source)
        score_stream(stream, score, "id", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).select("id").collect()
    assert sorted(r.id for r in found) == [1, 2, 3]


def test_stored_tables_are_written_small(spark):
    import pyarrow.parquet as pq

    from probalink.sources import storage

    df = storage.stored(spark.range(1000).selectExpr("id", "repeat('some words ', 50) AS text"), "small")
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in df.inputFiles()]
    assert {m.row_group(g).column(c).compression for m in files for g in range(m.num_row_groups) for c in range(2)} == {"ZSTD"}
    assert df.count() == 1000 and df.where("text = repeat('some words ', 50)").count() == 1000

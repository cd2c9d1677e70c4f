"""Tables of versions, constraints at load, ids of content, tables that are replaced while they are read, and kept answers."""

from __future__ import annotations

import os
import threading
from dataclasses import dataclass, field

import pytest
from pyspark.sql import functions as F

from probalink.operators import decide
from probalink.sources import tables
from probalink.sources.storage import stored
from probalink.sources.versions import Conflict, VersionedTable


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_merge_writes_only_files_with_a_matched_key(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.range(1000).select("id", (F.col("id") * 2.0).alias("p"), F.lit("x").alias("error"))
    assert table.replace(rows.repartitionByRange(5, "id")) == 1
    before = files_of(tmp_path / "t")
    updates = spark.createDataFrame([(i, None if i % 2 else -1.0, None) for i in range(10)] + [(None, 5.0, "lost"), (99_999, 1.0, "not there")], "id long, p double, error string")
    assert table.merge(updates, "id", ["p", "error"]) == 2
    after = files_of(tmp_path / "t")
    assert all(after[f] == m for f, m in before.items()) and len(after) == len(before) + 1  # one of five files is written anew
    found = {r.id: (r.p, r.error) for r in table.read().collect()}
    assert found == {i: ((None if i % 2 else -1.0, None) if i < 10 else (2.0 * i, "x")) for i in range(1000)}
    assert table.read(1).where("error IS NULL").count() == 0  # the version before is as it was
    assert table.merge(updates.where("id = 99999"), "id", ["p"]) == 2  # nothing to do
    table.vacuum(keep=1)
    assert table.versions() == [2] and len(files_of(tmp_path / "t")) == 5 and table.read().count() == 1000


def test_replace_append_and_what_is_required(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(spark.range(3), required=("id",))
    table.replace(table.read().where("id > 0"))
    assert sorted(r.id for r in table.read().collect()) == [1, 2]
    with pytest.raises(ValueError, match="id is null"):
        table.append(spark.createDataFrame([(7,), (None,)], "id long"), required=("id",))
    assert table.versions() == [1, 2] and len(files_of(tmp_path / "t")) == len(table.listed(1)["files"]) + len(table.listed(2)["files"])
    table.replace(table.read().limit(0))
    assert table.read().count() == 0 and table.read().columns == ["id"]
    assert table.merge(spark.range(2).withColumn("x", F.lit(1)), "id", ["id"]) == 3
    table.drop()
    assert table.versions() == []


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    table, other = VersionedTable(spark, str(tmp_path / "t")), VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    write = table._written

    def late(*given):
        out = write(*given)
        other.append(spark.range(10, 12))
        return out

    monkeypatch.setattr(table, "_written", late)
    with pytest.raises(Conflict):
        table.append(spark.range(1))
    assert table.versions() == [1, 2] and table.read().count() == 5


def test_required_holds_whatever_is_read(spark):
    rows = spark.createDataFrame([("1", "a"), (None, "b")], "n string, x string")
    assert tables.required(rows.where("n IS NOT NULL"), "n", "x").count() == 1
    for read in (lambda df: df.count(), lambda df: df.select("x").collect(), lambda df: df.select(F.lit(1)).collect()):
        with pytest.raises(Exception, match="n is null"):
            read(tables.required(rows, "n"))


def test_register_without_a_number_is_refused(spark, tmp_path):
    header = ",".join(tables.REGISTER_COLUMNS)
    (tmp_path / "bad.csv").write_text(f"{header}\n,ACME,1 ROAD,,LEEDS,,,LS1 1AA,X,Active,02/01/2020,s,\n")
    for read in (lambda df: df.count(), lambda df: df.select("company_name").collect()):
        with pytest.raises(Exception, match="company_number is null"):
            read(tables.read_register(spark, str(tmp_path / "bad.csv")))


def test_translations_with_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('company_number,registered_name,language,translated_name\n1,A,de,"Ä, ""B"" GmbH"\n')
    assert tables.read_translations(spark, str(tmp_path / "t.csv")).first().translated_name == 'Ä, "B" GmbH'


def test_a_reader_meets_no_gap_while_a_table_is_replaced(spark):
    tables.drop_table(spark, "steady")
    tables.replace_table(spark.range(100).withColumn("v", F.lit(0)), "steady")
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                rows = spark.sql("SELECT count(*) AS n, min(v) AS low, max(v) AS high FROM steady").first()
                seen.append(tuple(rows))
            except Exception as e:  # noqa: BLE001
                failed.append(str(e)[:300])
                return

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 51):
        tables.replace_table(spark.range(100).withColumn("v", F.lit(v)), "steady")
    stop.set()
    reader.join()
    assert not failed and len(seen) > 5 and all(n == 100 and low == high for n, low, high in seen)
    changed = tables.replace_table(spark.range(5), "steady")  # other columns
    assert changed.columns == ["id"] and spark.table("steady").count() == 5
    tables.drop_table(spark, "steady")
    assert not spark.catalog.tableExists("steady")


def test_content_ids_survive_a_rewrite(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, ""), (None, None), (None, None), (2, "a")] + [(9, "same")] * 300, "n long, x string")
    rows.repartition(3).write.parquet(str(tmp_path / "a"))
    rows.orderBy(F.desc("x")).coalesce(1).write.json(str(tmp_path / "b"))  # files without positions
    first = tables.with_content_id(spark.read.parquet(str(tmp_path / "a")))
    second = tables.with_content_id(spark.read.schema("n long, x string").json(str(tmp_path / "b")))
    ids = sorted(repr((r.row_id, r.n, r.x)) for r in first.collect())
    assert ids == sorted(repr((r.row_id, r.n, r.x)) for r in second.collect())
    assert len({i for i in ids}) == rows.count() and tables.with_content_id(rows.limit(0)).count() == 0


@dataclass
class Counting:
    """Writes a file for each call."""

    folder: str
    fails: tuple[str, ...] = ()
    inner: object = field(default_factory=lambda: decide.HashModel(("document",)))

    async def answer(self, state, questions):
        with open(f"{self.folder}/{abs(hash(state['document']))}-{os.urandom(4).hex()}", "w"):
            pass
        if state["document"] in self.fails:
            raise ConnectionError("no answer")
        return await self.inner.answer(state, questions)


def test_answers_are_kept(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    cache = VersionedTable(spark, str(tmp_path / "cache"))
    q = {"billing": decide.YesNo("Is it?")}
    ask = lambda rows, fails=(), questions=q: decide.cached_answers(spark.createDataFrame(rows, "id long, text string"), Counting(str(calls), fails), questions, decide.Flat("text"), ["text"], cache, "v1")
    rows = [(i, f"t{i % 7}") for i in range(50)] + [(90, None), (91, "")]
    first = {r.id: (r.answer and r.answer.yes["billing"], r.error) for r in ask(rows, ("t3",)).collect()}
    assert len(os.listdir(calls)) == 8 and first[3] == (None, "ConnectionError: no answer") and first[90] == (None, "null document")
    again = {r.id: (r.answer and r.answer.yes["billing"], r.error) for r in ask(rows).collect()}
    assert len(os.listdir(calls)) == 9 and all(again[i] == v for i, v in first.items() if i % 7 != 3 or i >= 90) and again[3][0] == decide.share("Is it?", "t3")
    ask([(1, "t1"), (2, "new")]).collect()
    assert len(os.listdir(calls)) == 10 and cache.read().count() == 9
    ask([(1, "t1")], questions={"billing": decide.YesNo("Another?")}).collect()
    assert len(os.listdir(calls)) == 11  # another question is another answer


def test_content_ids_write_no_hashes(spark, tmp_path, monkeypatch):
    """What is written beside the rows doesn't grow with them where contents are unique."""
    written = []
    monkeypatch.setattr(tables, "stored", lambda df, name: written.append(stored(df, name)) or written[-1])
    ids = tables.with_content_id(spark.range(500).select("id", F.lit("x").alias("x")).repartition(3))
    assert ids.select("row_id").distinct().count() == 500 and ids.where("row_id RLIKE '^[0-9a-f]{64}#1$'").count() == 500
    assert written[0].columns == ["id", "x", "__part"] and all(df.count() == 0 for df in written[1:])

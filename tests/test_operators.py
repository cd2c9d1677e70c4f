from __future__ import annotations

import asyncio
import fcntl
import os
import random
import uuid
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from probalink.functions import vary
from probalink.operators import decide, graph, ids, linkage, resolve
from probalink.sources import generate, storage, tables
from probalink.sources.storage import stored

PAIR = "pair_id long, a_name string, a_address string, a_country string, a_website string, a_vat string, b_name string, b_address string, b_country string, b_website string, b_vat string"


class FailsFor:
    def __init__(self, names):
        self.names = names

    def __call__(self, state):
        return state["record_a"]["name"] in self.names


def pairs(spark):
    rows = [(1, "A", "x", None, None, "1", "A", "x", None, "w", None), (2, "B", None, "UK", "w", "1", "C", "y", "UK", "w", "1"), (3, "D", "x", None, None, None, "D", None, None, None, None)]
    return spark.createDataFrame(rows, PAIR)


def test_questions_follow_presence_and_nulls_are_left_out():
    state = decide.PairState()({f"{s}_{c}": v for s, values in (("a", ("A", "x", None, None, "1")), ("b", ("B", "y", None, "w", None))) for c, v in zip(("name", "address", "country", "website", "vat"), values)})
    assert state == {"record_a": {"name": "A", "address": "x", "vat_id": "1"}, "record_b": {"name": "B", "address": "y", "website": "w"}}
    assert set(decide.PairQuestions()(state)) == {"same", "name", "address"}


def test_errors_stay_with_their_row_and_a_retry_clears_them(spark):
    failing = decide.FailingModel(decide.SimilarityModel(), FailsFor({"B"}), "x" * 3000)
    scores = {r.pair_id: r for r in decide.ask_pairs(pairs(spark), failing).collect()}
    assert scores[2].error == "ConnectionError: " + "x" * 1900 and scores[2].p_same is None
    assert scores[1].error is None and scores[1].p_same == 1.0 and scores[1].p_website is None
    again = {r.pair_id: r for r in decide.score_pairs(pairs(spark), failing, retry=decide.SimilarityModel()).collect()}
    assert [r.error for r in again.values()] == [None] * 3 and again[2].p_website == 1.0


class Slow:
    def __init__(self):
        self.now = self.peak = 0

    async def answer(self, state, questions):
        import asyncio

        self.now += 1
        self.peak = max(self.peak, self.now)
        await asyncio.sleep(0.001)
        self.now -= 1
        return decide.Answers(str(self.peak), request_id=state["document"])


def test_calls_in_flight_are_bounded_and_order_is_kept(spark):
    rows = spark.createDataFrame([(i, f"d{i}") for i in range(300)], "id long, document string").coalesce(1)
    found = decide.decided(rows, Slow(), {}, decide.Flat("document"), ["document"], ["id"], in_flight=7).collect()
    assert [(r.id, r.answer.request_id) for r in found] == [(i, f"d{i}") for i in range(300)]
    assert max(int(r.answer.model) for r in found) == 7


def test_batch_and_sql_classification(spark):
    rows = spark.createDataFrame([("a", "one"), ("b", None), ("c", "it's")], "id string, document string")
    model = decide.HashModel(("document",))
    found = {r.id: r for r in decide.classify_batch(rows, model).collect()}
    assert found["b"].error == "null document" and found["b"].billing is None and found["a"].tone in ("calm", "frustrated", "angry")
    decide.register(spark, model)
    rows.createOrReplaceTempView("tickets")
    by_sql = {r.id: r for r in spark.sql("SELECT * FROM classify_batch(TABLE(SELECT id, document FROM tickets) PARTITION BY id)").collect()}
    assert {k: (r.billing, r.tone, r.error) for k, r in by_sql.items()} == {k: (r.billing, r.tone, r.error) for k, r in found.items()}
    texts = [r[0] for r in spark.sql("SELECT classify(document) FROM tickets ORDER BY id").collect()]
    assert texts[1] is None and f'"tone": "{found["a"].tone}"' in texts[0]
    assert decide.versions(spark).count() == 4


def test_row_scores_with_equal_states_asked_once(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "id long, service string")
    scored = decide.distinct_scored(rows, "late?", decide.HashModel(("id",)), ("id", "service"), state=decide.Record("invoice"))
    assert scored.count() == 3 and scored.where("p_true IS NULL").count() == 0
    assert decide.matching_rows(scored, ["id"], 0.0).columns == ["id", "service", "p_true"]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (6, 5), (7, 7), (None, 4)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in range(1, 8)], "node long")
    assert {r.node: r.component for r in graph.labelled(nodes, edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7}
    assert graph.connected_components(edges.where("a > 99")).count() == 0
    rng = random.Random(1)
    some = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 360)]
    found = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(some, "a long, b long")).collect()}
    root = {x: x for e in some for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in some:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    assert found == {x: top(x) for x in root if any(x in e and e[0] != e[1] for e in some)}


def test_shared_company_makes_one_cluster(spark):
    best = spark.createDataFrame([("IN-2", "9", None), ("IN-1", "9", None), ("IN-3", None, None)], "incoming_id string, model_company_number string, baseline_company_number string")
    decisions = spark.createDataFrame([], "pair_kind string, a_id string, b_id string, model_match boolean, baseline_match boolean")
    found = {(r.matcher, r.incoming_id): r.cluster_id for r in resolve.clusters(best, decisions).collect()}
    assert found[("MODEL", "IN-2")] == "IN-1" and found[("BASELINE", "IN-2")] == "IN-2" and found[("MODEL", "IN-3")] == "IN-3"


def test_dedup_counts_and_ratios(spark):
    grouped = spark.createDataFrame([("MODEL", f"r{i}", "x" if i < 3 else "y") for i in range(5)], "matcher string, incoming_id string, cluster_id string")
    truth = spark.createDataFrame([(f"r{i}", "K", None, f"e{i}") for i in range(5)], "incoming_id string, variation_type string, true_company_number string, entity_id string")
    row = resolve.dedup_evaluation(grouped, truth).first()
    assert (row.predicted_pairs, row.correct_pairs, row.true_duplicate_pairs, row.pair_precision, row.pair_recall) == (4, 0, 0, 0.0, None)


def test_blocking_pairs_once_and_never_on_missing_keys(spark):
    rows = spark.createDataFrame([(1, "Acme Ltd", None), (2, "ACME LIMITED", "GB 1"), (3, "The Co", "1"), (4, "Ltd", None)], "id long, name string, vat string")
    fields = linkage.Fields("id", "name", ("none",), "none", "none", "none", "vat")
    keyed = linkage.with_keys(rows.withColumn("none", F.lit(None).cast("string")), fields)
    pairs = linkage.blocked(keyed, keyed, within=True, carried=("name_norm",))
    assert sorted(map(tuple, pairs.select("a_id", "b_id").collect())) == [(1, 2), (2, 3)]
    best = linkage.best_partners(keyed, keyed, 1, within=True).collect()
    assert {(r.a_id, r.b_id, r.name_sim) for r in best} == {(1, 2, 1.0), (2, 3, None)}


def test_ids(spark):
    rows = spark.range(500).select(((F.col("id") * 7919) % 503).alias("k"))
    assert [r.n for r in ids.dense_ids(rows, ["k"], "n").orderBy("k").collect()] == list(range(1, 501))
    sizes = ids.evenly(spark.range(1000), 4, "id").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert [r["count"] for r in sizes] == [250] * 4


def test_unique_assignment_serves_in_order(spark):
    rng = random.Random(7)
    wishes = [[rng.randrange(40) for _ in range(rng.randint(0, 6))] for _ in range(60)]
    owners = spark.createDataFrame([(f"o{i}", i, [f"v{v}" for v in own]) for i, own in enumerate(wishes)], "owner string, position int, wishes array<string>")
    found = {r.owner: r.value for r in ids.unique_assignment(owners, "owner", "position", lambda n: F.get("wishes", n), "value").collect()}
    taken, expected = set(), {}
    for i, own in enumerate(wishes):
        for v in own:
            if v not in taken:
                taken.add(v)
                expected[f"o{i}"] = f"v{v}"
                break
    assert found == expected


def test_merge_takes_nulls_too(spark):
    old = spark.createDataFrame([(1, None, "e"), (2, 0.5, None)], "k int, p double, error string")
    new = spark.createDataFrame([(1, 0.7, None)], "k int, p double, error string")
    assert {tuple(r) for r in tables.merged(old, new, "k", ["p", "error"]).collect()} == {(1, 0.7, None), (2, 0.5, None)}


def test_title_and_variants():
    assert (vary.title("ROAD,"), vary.title("O'NEILL")) == ("Road,", "O'Neill")
    rng = random.Random(3)
    for _ in range(200):
        word = vary.typo("PLASTICS", rng)
        assert word[0] == "P" and word != "" and abs(len(word) - 8) <= 1
        assert "".join(c for c in vary.vat_variant("GB554435225", rng) if c.isdigit()) == "554435225"
        assert "acme.co.uk" in vary.website_variant("www.acme.co.uk", rng).lower()


def register(spark, n=400):
    names = ["BLUE FOX SERVICES", "RED LION GROUP", "GREEN OAK SYSTEMS", "GREY OWL TRANSPORT"]
    rows = [(f"{i:08d}", f"{names[i % 4]} {chr(65 + i % 26)}{chr(65 + i // 26 % 26)} LTD", f"{i} HIGH ROAD", None, "LEEDS", None, "ENGLAND", f"LS{i % 9 + 1} {i % 9}AB", "Active", i) for i in range(n)]
    return spark.createDataFrame(rows, "company_number string, company_name string, address_line1 string, address_line2 string, post_town string, county string, country string, postcode string, company_status string, position int")


def test_generated_records_and_their_resolution(spark):
    master, out = generate.prepared(register(spark, 1500))
    assert master.count() + out.count() == 1500
    keys = master.unionByName(out)
    assert keys.where("vat_id IS NOT NULL").count() == keys.select("vat_id").distinct().where("vat_id IS NOT NULL").count()
    assert 0.55 < keys.where("website IS NOT NULL").count() / 1500 < 0.85
    first = master.select("company_number").first()[0]
    words = spark.createDataFrame([(first, "x", "de", "Blauer Fuchs GmbH")], "company_number string, registered_name string, language string, translated_name string")
    more = keys.orderBy("company_number").limit(30)
    records, truth = generate.incoming(master, more, words, total=150, no_match=10, sampled=200, sampled_out=30)
    assert records.count() == 150 and records.select("incoming_id").distinct().count() == 150
    assert {r.variation_type: r["count"] for r in generate.counts_by_type(truth).collect()}["NO_MATCH"] == 10
    assert truth.where("variation_type = 'NO_MATCH' AND true_company_number IS NOT NULL").count() == 0
    assert generate.repeated_entities(truth).count() > 0
    pairs, report = linkage.find_candidates(master, records, truth)
    ceiling = {r.variation_type: r.candidate_recall for r in report.collect()}
    assert ceiling["ALL"] > 0.9 and ceiling["NO_MATCH"] is None and pairs.where("pair_kind = 'DEDUP' AND a_id >= b_id").count() == 0
    done = resolve.resolve(records, master, truth, pairs, decide.SimilarityModel(), 0.6)
    accuracy = {r.variation_type: r.model_accuracy for r in done.matches.collect()}
    assert accuracy["VAT"] > 0.8 and done.report.count() == done.matches.count() + 2
    assert done.results.count() == 150
    with pytest.raises(ValueError, match="too few"):
        generate.incoming(master, more, words, total=5000, sampled=10)


def test_storage(spark):
    df = stored(spark.range(3), "x")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2]
    path = next(p for p in storage.MADE if "/x-" in p)
    assert os.path.exists(path)
    storage.clear(spark)
    assert not os.path.exists(path) and not storage.MADE


class Opened:
    """A model that answers only while it is open, and writes down when it was opened and closed."""

    def __init__(self, log):
        self.log, self.open = log, False

    async def opened(self):
        self.open = True
        open(f"{self.log}/opened-{os.getpid()}-{uuid.uuid4().hex}", "w").close()

    async def closed(self):
        self.open = False
        open(f"{self.log}/closed-{os.getpid()}-{uuid.uuid4().hex}", "w").close()

    async def answer(self, state, questions):
        assert self.open
        return decide.Answers("m", yes={name: 0.5 for name in questions})


def test_a_model_is_opened_and_closed_once_a_task(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "concat('d', id) AS document").repartition(3)
    found = decide.decided(rows, Opened(str(tmp_path)), {"q": decide.YesNo("?")}, decide.Flat("document"), ["document"], ["id"]).collect()
    assert len(found) == 100 and not any(r.error for r in found)
    names = [n.split("-")[0] for n in os.listdir(tmp_path)]
    assert names.count("opened") == names.count("closed") == 3


@dataclass
class Limited:
    """Takes `most` calls at once from all processes together, which a locked file counts."""

    path: str
    most: int = 64

    def count(self, change):
        with open(self.path, "r+") as file:
            fcntl.flock(file, fcntl.LOCK_EX)
            now, peak, refused = map(int, file.read().split())
            if change > 0 and now >= self.most:
                change, refused = 0, refused + 1
            else:
                peak = max(peak, now + change)
            file.seek(0)
            file.write(f"{now + change} {peak} {refused}".ljust(60))
            return change != 0

    async def answer(self, state, questions):
        if not self.count(1):
            raise decide.Overloaded("too many calls")
        await asyncio.sleep(0.02)
        self.count(-1)
        return await decide.HashModel(("document",)).answer(state, questions)


def test_tasks_settle_at_what_the_model_takes(spark, tmp_path):
    """Eight tasks of sixteen calls against a model that takes 64 at once, or 5: every row gets its answer."""
    for most in (64, 5):
        path = tmp_path / f"calls-{most}"
        path.write_text("0 0 0".ljust(60))
        rows = spark.range(1500 if most > 5 else 200).select("id", F.col("id").cast("string").alias("document"))
        found = decide.classify_batch(rows, Limited(str(path), most), in_flight=16, instances=8).collect()
        assert len(found) == (1500 if most > 5 else 200) and all(r.error is None and r.billing is not None for r in found)
        now, peak, refused = map(int, path.read_text().split())
        assert now == 0 and peak <= most and refused > 0


def test_a_model_that_stays_overloaded_is_an_error_of_the_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decide, "PATIENCE", 1)
    path = tmp_path / "calls"
    path.write_text("0 0 0".ljust(60))
    with asyncio.Runner() as runner:
        found = runner.run(decide.asked(Limited(str(path), 0), [{"document": "x"}, None], {}, 4, "null document"))
    assert found == [(None, "Overloaded: too many calls"), (None, "null document")]


def test_one_name_for_a_thousand_takes_few_rounds(spark):
    """Companies of one name, and a few whose name is that with a counter: the same websites as serving them one after another."""
    rng = random.Random(3)
    towns = ["Leeds", "York", "Bath", None]
    rows = [(f"{i:05}", "THE ACME COMPANY LTD" if i % 400 else f"ACME {rng.choice([7, 40])}", rng.choice(towns), i) for i in range(1600)]
    df = spark.createDataFrame(rows, "company_number string, company_name string, post_town string, position int")
    rounds = []
    found = {r.company_number: r.website for r in generate.with_website(df, rounds=rounds).collect()}
    plainly = {r.company_number: r.website for r in served(df).collect()}
    assert found == plainly and len(rounds) <= 8 and len({w for w in found.values() if w}) == sum(w is not None for w in found.values()) > 900
    rounds.clear()
    generate.with_website(df.where("company_name LIKE 'THE%'"), rounds=rounds).count()
    assert len(rounds) <= 5


def served(df):
    """with_website by offers alone, one after another on the driver."""
    taken = set()
    out = []
    alone = dict(lonely(df))
    for r in sorted(df.collect(), key=lambda r: r.position):
        given = alone.get(r.company_number)
        if given:
            root, ending = given.removeprefix("www.").split(".", 1)
            town = "".join(c for c in (r.post_town or "").lower() if "a" <= c <= "z")
            for name in (root, f"{root}-{town}", *(f"{root}{k}" for k in range(2, generate.COUNTERS))):
                if f"{name}.{ending}" not in taken:
                    taken.add(f"{name}.{ending}")
                    out.append((r.company_number, f"www.{name}.{ending}"))
                    break
    return df.select("company_number").join(df.sparkSession.createDataFrame(out, "company_number string, website string"), "company_number", "left")


def lonely(df):
    """(company_number, website) that each company would have if no other wanted one."""
    import hashlib

    mod = lambda m, *parts: int(hashlib.md5("|".join(parts).encode()).hexdigest(), 16) % m
    for r in df.collect():
        if mod(100, "web", r.company_number) < generate.SITE_SHARE:
            words = [w for w in r.company_name.split() if w not in generate.SITE_LEGAL_WORDS]
            yield r.company_number, f"www.{''.join(words).lower()[:40]}{generate.ENDINGS[mod(len(generate.ENDINGS), 'tld', r.company_number)]}"


def test_forms_fail_for_variations_that_change_nothing(spark, monkeypatch):
    from probalink.plans import more

    def unchanged(companies, seed):
        kind = F.coalesce("kind", F.lit("SPELLING"))
        return companies.select(
            F.lit("orders").alias("source_system"), F.col("company_name").alias("record_name"), F.col("address_line1").alias("address"), "postcode", "country", "website", "vat_id",
            kind.alias("variation_type"), F.col("company_number").alias("true_company_number"), F.col("company_number").alias("entity_id"), F.lit(0).alias("copy"),
        )

    monkeypatch.setattr(more.vary, "varied", unchanged)
    rows = more.varied_forms_g5_g12_f19_f20(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(more.FORMS) and not any(r.holds for r in rows)

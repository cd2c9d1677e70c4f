from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from data import ODD, PROSE, clashing, documents
from pyspark.sql import functions as F

from probalink.llm import pii, quality_model, quality_rules, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def noise(seed, letters, n, most):
    rng = random.Random(seed)
    return [(1000 * seed + k, "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))) for k in range(n)]


def test_op5_statistics(spark):
    rows = ODD + noise(2, ["a", "b", " ", "  ", "\n", "\t", "\r", "\x0b", "c#", "|", "é", " ", " a"], 500, 80) + [(50, "the " * 3000), (51, ("w" * 3000 + " ") * 3)]
    found = quality_rules.rated(clashing(documents(spark, rows)), ["doc_id"]).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in found), key=repr) == sorted(((i, *statistics(t)) for i, t in rows), key=repr)
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed)
    assert quality_rules.rated(documents(spark, []), ["doc_id"]).count() == 0


def good(k):
    rng = random.Random(k)
    words = rng.choices(PROSE.split(), k=60)
    return ". ".join(" ".join(words[j : j + 10]).capitalize() for j in range(0, 60, 10)) + f" {k}."


def junk(k):
    words = random.Random(k).choices(PROSE.split(), k=60)
    return [" ".join(w + "$$$" for w in words), " ".join(w.upper() + "!!" for w in words), " | ".join(words)][k % 3]


def test_op5_verdicts_and_stage(spark):
    rows = [(k, good(k)) for k in range(120)] + [(500 + k, junk(k)) for k in range(30)]
    df = clashing(documents(spark, rows))
    kept = {r.doc_id for r in quality_rules.rated(df, ["doc_id"]).where("kept").collect()}
    assert kept == set(range(120))
    passing = quality_rules.passing(df)
    assert passing.columns == df.columns and {r.doc_id for r in passing.collect()} == kept


def test_op5_columns_of_any_name_stay(spark):
    df = documents(spark, [(1, good(1)), (2, junk(2))])
    df = df.withColumns({n: F.lit("kept") for n in ("__text", "__flat", "__lines", "__windows", "__chars", "__rated_kept", "votes")})
    found = quality_rules.passing(df)
    assert found.columns == df.columns and [(r.doc_id, *r[-7:]) for r in found.collect()] == [(1, *["kept"] * 7)]
    assert quality_rules.with_statistics(df).columns[: len(df.columns)] == df.columns


def test_op5_one_kind_of_junk_is_rejected(spark):
    loud = [good(700 + k).upper() for k in range(5)]
    barred = [good(800 + k).replace(" ", " | ", 20) for k in range(2)]
    long = [" ".join("x" * 20 + w for w in good(900 + k).split()) for k in range(3)]
    rows = [*enumerate([good(k) for k in range(200)]), *enumerate([*loud, *barred, *long], 500)]
    assert {r.doc_id for r in quality_rules.rated(documents(spark, rows), ["doc_id"]).where("kept").collect()} == set(range(200))


@pytest.mark.parametrize("share", [0.01, 0.05, 0.1, 0.3])
@pytest.mark.parametrize("kind", ["loud", "barred", "long", "shouted"])
def test_op5_one_kind_of_junk_is_rejected_however_much_there_is(kind, share):
    """Of 10,000 documents, the share that one rule alone calls bad."""
    rule = {"loud": "capitals", "barred": "columns", "long": "word_length", "shouted": "exclamations"}[kind]
    names = [r.name for r in quality_rules.RULES]
    letters = names.index("letters")
    clean = tuple(int(k == letters) for k in range(len(names)))
    bad = tuple(-1 if n == rule else v for n, v in zip(names, clean))
    lines = tuple(-1 if n == "lines" else v for n, v in zip(names, clean))
    n = int(10_000 * share)
    found = quality_rules.estimated({clean: 9_000 - n, bad: n, lines: 1_000}, quality_rules.prior(quality_rules.RULES))
    assert found.quality(bad) < 0.3 and found.quality(clean) > 0.9 and found.quality(lines) > 0.5


def plain_estimate(patterns, believed, belief, rounds):
    """Expectation maximisation, document by document."""
    share, good_votes, bad_votes = believed.share, [list(v) for v in believed.good], [list(v) for v in believed.bad]
    for _ in range(rounds):
        good_weight = []
        for pattern in patterns:
            a, b = share, 1 - share
            for k, v in enumerate(pattern):
                a, b = a * good_votes[k][v + 1], b * bad_votes[k][v + 1]
            good_weight.append(a / (a + b))
        total, mass = len(patterns), sum(good_weight)
        share = (mass + belief * total * believed.share) / (total + belief * total)
        for own, weights, given in ((good_votes, good_weight, believed.good), (bad_votes, [1 - w for w in good_weight], believed.bad)):
            for k in range(len(own)):
                own[k] = [(sum(w for w, p in zip(weights, patterns) if p[k] == v) + belief * sum(weights) * given[k][v + 1]) / (sum(weights) * (1 + belief)) for v in (-1, 0, 1)]
    return share, good_votes, bad_votes


def test_op5_estimates_are_those_of_plain_expectation_maximisation():
    rng = random.Random(5)
    truth = [rng.random() < 0.7 for _ in range(400)]
    patterns = [tuple(rng.choices((-1, 0, 1), ((1, 20, 10) if t else (9, 10, 2)))[0] for _ in range(4)) for t in truth]
    believed = quality_rules.Estimate(0.8, ((0.05, 0.8, 0.15),) * 4, ((0.3, 0.6, 0.1),) * 4)
    for belief, rounds in ((0.1, 1), (0.1, 7), (1.0, 30)):
        found = quality_rules.estimated(dict(Counter(patterns)), believed, belief, rounds)
        share, good_votes, bad_votes = plain_estimate(patterns, believed, belief, rounds)
        assert np.isclose(found.share, share) and np.allclose(found.good, good_votes) and np.allclose(found.bad, bad_votes)
    assert np.mean([(found.quality(p) >= 0.5) == t for p, t in zip(patterns, truth)]) > 0.9
    more = quality_rules.estimated({k: 1000 * n for k, n in Counter(patterns).items()}, believed)
    assert np.allclose(more.good, quality_rules.estimated(dict(Counter(patterns)), believed).good)
    assert quality_rules.estimated({}, believed) == believed


def test_op5_kept_is_the_posterior_of_the_votes(spark):
    rows = [(k, good(k)) for k in range(60)] + [(500 + k, junk(k)) for k in range(20)] + [(None, None), (900, ""), (901, "a b " * 40)]
    found = quality_rules.rated(documents(spark, rows), ["doc_id"]).collect()
    patterns = [tuple(r.votes) for r in found if not r.base_failed]
    share, good_votes, bad_votes = plain_estimate(patterns, quality_rules.prior(quality_rules.RULES), 1.0, 200)
    for r in found:
        a, b = share, 1 - share
        for k, v in enumerate(r.votes):
            a, b = a * good_votes[k][v + 1], b * bad_votes[k][v + 1]
        assert abs(r.quality - a / (a + b)) < 1e-6 and r.kept == (not r.base_failed and r.quality >= 0.5)


def luhn(number):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(number)))) % 10 == 0


def base_spans(text):
    number = lambda h: re.sub("[^0-9]", "", h)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda h: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda h: all(int(x) <= 255 for x in h.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda h: 13 <= len(number(h)) <= 19 and luhn(number(h))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda h: 9 <= len(number(h)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, p, valid in kinds for m in re.finditer(p, text or "") if valid(m.group())]


def test_op3_base(spark):
    letters = ["1", "2", "9", "0", ".", "-", " ", "+", "(", ")", "@", "a", "Z", "_", "%", "4539578763621486", "10.0.0.1", "x@y.zz", "é", "\n", "+1 (555) 123-4567", "256", "😀"]
    rows = ODD + noise(3, letters, 800, 30) + [(60, "9" * 20_000), (61, "a" * 20_000 + "@b"), (62, "1." * 5000)]
    found = pii.digests(clashing(documents(spark, rows))).collect()
    expected = []
    for i, t in rows:
        spans = base_spans(t)
        count = Counter(k for k, _, _ in spans)
        expected.append((i, *(count[k] for k in ("email", "ip", "card", "phone")), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in found), key=repr) == sorted(expected, key=repr)


def test_op3_added_spans_context_and_redaction(spark):
    rows = [
        (1, "Pay to bank account GB82 WEST 1234 5698 7654 32 now."),
        (2, "GB82 WEST 1234 5698 7654 33 fails."),
        (3, 'x token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" y'),
        (4, "ssn 123-45-6789 but part 123-45-6780" + " z" * 40),
        (5, "part number 123-45-6789"),
        (6, "mail é@x a.b@c.de, +1 (555) 123-4567!"),
        (7, None),
    ]
    df = documents(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.digests(df).collect()}
    assert spans[1] == "iban:20:47" and spans[2] == "" and spans[3].startswith("secret:2:") and spans[5] == "" and spans[4].count("ssn") == 2
    clean = {r.doc_id: r for r in pii.redacted(df).collect()}
    assert clean[1].text == "Pay to bank account [IBAN] now." and clean[6].text == "mail é@x [EMAIL], [PHONE]!" and clean[6].n_chars == len(clean[6].text)
    assert clean[2].text == rows[1][1] and clean[7].text is None and pii.redacted(df).columns == df.columns
    odd = df.withColumns({n: F.lit("kept") for n in ("__spans", "__base", "__text", "__email", "__iban")})
    assert {tuple(r[-5:]) for r in pii.redacted(odd).collect()} == {("kept",) * 5} and pii.redacted(odd).columns == odd.columns
    assert pii.redacted(documents(spark, [])).count() == pii.digests(documents(spark, [])).count() == 0


def test_op3_words_beside_a_span_decide(spark):
    iban, key, card = "GB82 WEST 1234 5698 7654 32", "token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "4539/5787/6362/1486"
    cases = [
        (f"{iban} it is", "iban", "0.7"), (f"my bank: {iban}", "iban", "1.0"), (f"an EXAMPLE {iban}", "", ""), (f"sample account {iban}", "iban", "0.7"), (f"{'z' * 60} {iban} {'z' * 60} example", "iban", "0.7"),
        (key, "secret", "0.7"), (f"login {key}", "secret", "1.0"), (f"placeholder {key}", "", ""),
        (card, "", ""), (f"visa {card}", "pan", "0.7"), (f"sample visa {card}", "", ""), (f"visa {card[:-1]}5", "", ""), (f"visard {card}", "", ""),
        ("ssn 123-45-6789", "ssn", "0.7"), ("dummy ssn 123-45-6789", "", ""),
        ("a@b.cd", "email", "0.7"), ("e-mail a@b.cd", "email", "1.0"), ("example a@b.cd", "email", "0.4"), ("version 1.2.3.4", "ip", "0.4"),
    ]
    found = {r.doc_id: r for r in pii.digests(documents(spark, [(k, text) for k, (text, _, _) in enumerate(cases)])).collect()}
    for k, (text, kind, score) in enumerate(cases):
        assert (found[k].spans.split(":")[0], found[k].scores) == (kind, score), text


def test_op2_learns_rules_and_scores_like_its_column(spark):
    rows = [(k, good(k)) for k in range(150)] + [(500 + k, junk(k)) for k in range(60)]
    docs = clashing(documents(spark, rows + [(9000, ""), (9001, None), (None, "x y z")]))
    labels = spark.createDataFrame([(i, int(i < 500), 0) for i, _ in rows] + [(None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_model.learned(docs, labels)
    assert 0 < len(model.rules) < 60
    features = quality_rules.with_statistics(docs.select("doc_id", "text")).select("doc_id", *[F.expr(e).cast("double").alias(n) for n, e in quality_model.FEATURES.items()]).toPandas()
    again = dict(zip(features["doc_id"].fillna(-1), model.score(features[list(quality_model.FEATURES)].to_numpy(float))))
    for r in quality_model.scored(docs, model).collect():
        assert abs(r.score - again[-1 if r.doc_id is None else r.doc_id]) < 1e-12
    twice = docs.union(docs.where("doc_id < 40").withColumn("text", F.concat("text", F.lit(" x"))))
    assert len(quality_model.learned(twice, labels, sample=30).rules) >= 0
    assert {r.score for r in quality_model.scored(docs, quality_model.learned(documents(spark, []), labels)).collect()} == {0.5}
    assert quality_model.scored(documents(spark, []), model).count() == 0
    assert [r.predicted for r in quality_model.scored(documents(spark, [(1, "word " * 100_000), (2, "x" * 500_000)]), model).collect()] is not None
    found = {r.doc_id: r for r in quality_model.scored(docs, model).collect()}
    import zlib

    for i, _ in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and found[i].predicted == int(i < 500)
    assert 0 <= found[9000].score == found[9001].score <= 1
    none = quality_model.learned(docs, labels.where("false"))
    assert {r.score for r in quality_model.scored(docs, none).collect()} == {0.5}


def test_op2_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op2_quality_model(spark, sf).where("held_out").join(labels, "doc_id").select(F.col("score"), F.col("quality")).collect()
    good_scores, bad_scores = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    better = np.mean([[(g > b) + 0.5 * (g == b) for b in bad_scores] for g in good_scores])
    assert better > 0.9


def test_op2_lasso_meets_its_conditions():
    """At the optimum a rule without weight has a gradient within the penalty, and one with a weight exactly that of its sign."""
    rng = np.random.default_rng(2)
    matrix = (rng.random((400, 12)) < 0.4).astype(float)
    labels = (rng.random(400) < 1 / (1 + np.exp(-(2 * matrix[:, 0] - 3 * matrix[:, 1])))).astype(float)
    for penalty in (0.003, 0.02, 0.2):
        b, w = quality_model.lasso(matrix, labels, penalty, 5000)
        p = 1 / (1 + np.exp(-(matrix @ w + b)))
        gradient = matrix.T @ (p - labels) / len(labels)
        assert abs((p - labels).mean()) < 1e-4 and np.all(np.abs(gradient) <= penalty + 1e-4)
        assert np.allclose(gradient[w != 0], -penalty * np.sign(w[w != 0]), atol=1e-4)
    assert not w.any()


def test_op2_trees_take_the_best_split():
    """Every node's split against all splits by plain loops."""
    rng = np.random.default_rng(3)
    values, residual, curvature = rng.integers(0, 6, (120, 3)).astype(float), rng.normal(size=120), rng.random(120) + 0.1
    cuts = [np.unique(v)[:-1] for v in values.T]

    def naive(rows, path):
        g, h = residual[rows].sum(), curvature[rows].sum()
        best = (1e-6, None)
        for k in range(3):
            for cut in cuts[k]:
                low, high = [r for r in rows if values[r, k] <= cut], [r for r in rows if values[r, k] > cut]
                if len(low) >= 10 and len(high) >= 10:
                    score = lambda own: residual[own].sum() ** 2 / (curvature[own].sum() + 1)
                    gain = score(low) + score(high) - g**2 / (h + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, (k, cut, low, high))
        out = [(path, g / (h + 1), best[1] is None or len(path) == 2)]
        if best[1] and len(path) < 2:
            k, cut, low, high = best[1]
            out += naive(low, (*path, (k, cut, False))) + naive(high, (*path, (k, cut, True)))
        return out

    found, expected = quality_model.grown(values, residual, curvature, cuts, 2, 10), naive(list(range(120)), ())
    assert [(p, leaf) for p, _, leaf in found] == [(p, leaf) for p, _, leaf in expected] and np.allclose([s for _, s, _ in found], [s for _, s, _ in expected])
    assert len(found) == 7


def test_op2_the_penalty_is_chosen_on_rows_that_no_tree_saw(monkeypatch):
    seen = []
    monkeypatch.setattr(quality_model, "paths", lambda values, labels, *rest: seen.append(len(values)) or [((0, 0.5, True),)])
    values = np.arange(40).reshape(-1, 1) / 40
    quality_model.fitted(values, (values[:, 0] > 0.6).astype(float))
    assert seen == [30, 40]

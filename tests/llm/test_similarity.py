from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import xxhash
from data import ODD, PROSE, clashing, documents
from pyspark.sql import functions as F

from probalink.llm import ann, passages, queries, simhash, substrings, warc
from probalink.operators import hot


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> k & 1 for s in shingles) for k in range(64)]
    return sum(1 << k for k in range(64) if 2 * bits[k] > len(shingles))


def groups(nodes, linked):
    """The smallest node that each reaches."""
    out = {}
    for start in sorted(nodes, key=lambda n: (n is None, n)):
        if start in out:
            continue
        stack = [start]
        while stack:
            at = stack.pop()
            if at not in out:
                out[at] = start
                stack += [n for n in nodes if n not in out and linked(at, n)]
    return out


def near_copies(seed, n, words=120):
    rng = random.Random(seed)
    base = rng.choices([f"w{k}" for k in range(500)], k=words)
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(words)] = f"x{rng.randrange(99)}"
        out.append(" ".join(own))
    return out


def test_covering_masks_cover():
    masks = simhash.covering_masks(4)
    rng = random.Random(1)
    for _ in range(3000):
        difference = sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4)))
        assert any(difference & m == 0 for m in masks)
    assert len(masks) == 31


def check_components(spark, most):
    rows = [r for r in ODD if r[0] is not None] + [(None, "without an id")] + [(100 + 50 * g + k, t) for g in range(4) for k, t in enumerate(near_copies(g, 12))]
    df = clashing(documents(spark, rows))
    found = {(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash.components(df, most=most).collect()}
    prints = {(i, fingerprint(t)) for i, t in rows}
    reached = groups({f for _, f in prints}, lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for i, f in prints:
        if i is not None:
            least[reached[f]] = min(i, least.get(reached[f], i))
    assert found == {(i, f, least.get(reached[f])) for i, f in prints}
    kept = simhash.one_of_each(df)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == df.columns and sorted(i for i in ids if i is not None) == sorted(set(least.values())) and ids.count(None) == (None in least.values() or len(set(reached.values())) - len(least))


def test_op8_one_of_each_keeps_distinct_texts(spark, monkeypatch):
    monkeypatch.setattr(hot, "FEW", 5_000)
    other, third = near_copies(90, 1)[0], near_copies(91, 1)[0]
    rows = [(1, PROSE), (1, other), (2, PROSE), (None, PROSE), (None, third), (None, third), (None, None), (3, ""), (4, other + " x"), (5, None)]
    df = clashing(documents(spark, rows)).withColumns({"__name": F.lit(1), "__key": F.lit(2), "__id": F.lit(3)})
    found = simhash.one_of_each(df)
    assert found.columns == df.columns and sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted([(1, PROSE), (1, other), (None, third), (3, "")], key=repr)
    many = documents(spark, [(7, PROSE)] * 6000 + [(k, f"{third} {k}") for k in range(100, 6000)])  # one row is half of the table
    assert [r.doc_id for r in simhash.one_of_each(many).where("doc_id < 101").orderBy("doc_id").collect()] == [7, 100]
    assert simhash.one_of_each(documents(spark, [])).count() == 0


def test_op8_components(spark):
    check_components(spark, 256)


def test_op8_large_buckets_lose_no_link(spark):
    check_components(spark, 1)


def test_op8_exploded_rows_are_not_broadcast(spark):
    """A few large buckets fill a small file, but their balls are 2,081 times as many rows, and buckets 31 times."""
    prints = simhash.stored(spark.range(500).select(F.col("id").alias("fingerprint")), "prints")
    for most in (4, 256):
        plan = simhash.links(prints, most=most)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_op8_fingerprint_is_the_shingles_xxhash64(spark):
    assert spark.sql("SELECT xxhash64('a b c d')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)
    assert queries.op8_simhash(spark, "/root/testdata/sf0.001").where("length(fingerprint) = 16").count() == 200
    assert simhash.components(documents(spark, [])).count() == 0


def test_op6_repeats(spark, monkeypatch):
    rng = random.Random(2)
    line = lambda n, seed: " ".join(random.Random(seed).choices([f"w{k}" for k in range(4000)], k=n))
    passage, short = line(60, "p"), line(20, "s")
    near = passage.split()
    near[30] = "changed"
    near = " ".join(near)
    rows = ODD[:-1] + [
        (20, f"{line(55, 1)}\n{passage}\n{short}"),
        (21, f"{passage}\n{line(80, 2)}"),
        (22, f"{line(70, 3)}\n{near}\n{short}"),
        (23, line(90, 4)),
        (24, passage.upper()),
    ] + [(30 + k, "\n".join([line(60, f"u{k}"), *near_copies("n", 20, 100)[k : k + 1]])) for k in range(20)]
    rng.shuffle(rows)
    df = clashing(documents(spark, rows))
    for most, size in ((64, 10**6), (3, 10**6), (64, 2000)):
        monkeypatch.setattr(substrings, "MOST", most)
        monkeypatch.setattr(substrings, "MOST_BYTES", size)
        found = substrings.repeats(df).where("line IS NOT NULL").collect()
        gone = {(r.doc_id, r.line) for r in found}
        assert {g for g in gone if g[0] < 30} == {(21, 0), (22, 1), (24, 0)} and {r.kept_id for r in found if r.doc_id < 30} == {20}
        copies = {30 + k: set(substrings.shingles(t.encode().split())) for k, t in enumerate(near_copies("n", 20, 100))}
        reached = groups(set(copies), lambda a, b: len(copies[a] & copies[b]) >= 0.8 * len(copies[a] | copies[b]))
        assert {g for g in gone if g[0] >= 30} == {(i, 1) for i, first in reached.items() if i != first}
    clean = {r.doc_id: r for r in substrings.cleaned(df).where("doc_id IS NOT NULL").collect()}
    assert clean[20].text == dict(rows)[20] and clean[21].text == line(80, 2) and clean[22].text == f"{line(70, 3)}\n{short}" and clean[23].text == line(90, 4)
    odd = df.withColumns({n: F.lit("kept") for n in ("__id", "__key", "__gone", "__text")})
    assert {(*r[-4:],) for r in substrings.cleaned(odd).collect()} == {("kept",) * 4}
    assert clean[21].n_chars == len(clean[21].text) and substrings.cleaned(df).columns == df.columns and substrings.cleaned(df).count() == len(rows)
    assert substrings.repeats(documents(spark, [])).count() == 0


def shared_later(texts, least):
    """The ids whose text has a run of `least` words that a text of a smaller id has too."""
    seen, out = {}, set()
    for i, text in sorted(texts.items()):
        words = text.lower().split()
        runs = {tuple(words[k : k + least]) for k in range(len(words) - least + 1)}
        if any(r in seen for r in runs):
            out.add(i)
        seen |= dict.fromkeys(runs, i)
    return out


def test_op6_passages_inside_lines(spark):
    rng = random.Random(7)
    prose = lambda n: [f"{rng.choice('abcdé')}{rng.randrange(10**6)}" for _ in range(n)]
    texts, planted = {}, {}
    for g in range(60):
        passage = prose(rng.choice((50, 51, 60, 90)))
        for k in range(rng.randint(2, 4)):
            words = prose(rng.randrange(80)) + passage + prose(rng.randrange(80))
            texts[len(texts)] = "".join(w + rng.choice((" ", " ", " ", "\n", "  ")) for w in words)
            planted.setdefault(g, []).append(len(texts) - 1)
    short = prose(49)  # just too short
    for _ in range(6):
        texts[len(texts)] = " ".join(prose(60) + short + prose(60))
    rows = [*((1000 + (i or 0), t) for i, t in ODD), *texts.items(), *texts.items()]
    df = clashing(documents(spark, rows))
    found = [r for r in substrings.repeats(df).collect() if r.doc_id < 1000]
    assert {r.doc_id for r in found} == shared_later(texts, 50) == {i for own in planted.values() for i in own[1:]}
    assert all(r.kept_id < r.doc_id for r in found)
    for r in found:
        part = texts[r.doc_id][r.start : r.end]
        assert len(part.split()) == r.n_words >= 34 and " ".join(part.split()) in " ".join(texts[r.kept_id].split())
    clean = {r.doc_id: r.text for r in substrings.cleaned(df).collect()}
    assert not shared_later({i: clean[i] for i in texts}, 50)
    assert all(clean[i] == texts[i] for i in set(texts) - {r.doc_id for r in found})


def test_op6_earlier_fragments_hide_no_passage(spark):
    rng = random.Random(8)
    prose = lambda n: [f"{rng.choice('abcd')}{rng.randrange(10**6)}" for _ in range(n)]
    texts = {}
    for _ in range(30):  # a fragment, then two of a longer passage that begins or ends with it
        passage, short = prose(rng.randrange(50, 66)), rng.randrange(34, 50)
        fragment = passage[:short] if rng.random() < 0.5 else passage[-short:]
        for part in (fragment, passage, passage):
            texts[len(texts)] = " ".join(prose(40) + part + prose(40))
    hidden = {i for i in texts if i % 3 == 2}
    passage = prose(55)
    for words in (prose(40) + passage[:40] + prose(60) + passage + prose(40), prose(40) + passage + prose(40)):  # the window twice in one document
        texts[len(texts)] = " ".join(words)
    hidden.add(len(texts) - 1)
    for _ in range(150):  # the second is matched by the first, the third only by the second
        left, window, right = prose(16), prose(34), prose(16)
        for before, after in ((left, prose(16)), (left, right), (prose(16), right)):
            texts[len(texts)] = " ".join(prose(30) + before + window + after + prose(30))
        hidden |= {len(texts) - 2, len(texts) - 1}
    found = substrings.repeats(documents(spark, list(texts.items()))).collect()
    assert {r.doc_id for r in found} == shared_later(texts, 50) == hidden


def test_op6_contexts_of_a_window_are_no_rows_for_each_part(spark, monkeypatch):
    rng = random.Random(11)
    prose = lambda n: [f"{rng.choice('abcd')}{rng.randrange(10**6)}" for _ in range(n)]
    texts = {}
    for many in (3, 5, 40):  # fragments of a passage, each with a neighbourhood that others share in part or not at all
        left, window, right = prose(16), prose(34), prose(16)
        for _ in range(many):
            a, b = rng.randrange(17), rng.randrange(17)
            texts[len(texts)] = " ".join(prose(46 - a) + left[16 - a :] + window + right[:b] + prose(46 - b))
    df = documents(spark, list(texts.items()))
    with monkeypatch.context() as m:
        m.setattr(passages.F, "sequence", None)  # which rows for each part would take
        few = passages.shared_passages(df, 50, "doc_id", "text").collect()
    assert {r.doc_id for r in few} == shared_later(texts, 50) != set()
    for together in (0, 4):  # as rows: all windows, or the larger ones
        monkeypatch.setattr(passages, "TOGETHER", together)
        assert Counter(passages.shared_passages(df, 50, "doc_id", "text").collect()) == Counter(few)


def test_op6_nearest_contexts_across_batches(spark):
    rng = random.Random(12)
    rows = [(w, bytes(rng.choice((0, 1, 1, 1, 2)) for _ in range(8)), k, rng.random() < 0.3) for w in range(60) for k in range(rng.choice((1, 2, 9, 40)))]
    rng.shuffle(rows)
    parts = lambda c: {(k, c[k : k + 4]) for k in (0, 2, 4) if c[k : k + 2] != b"\0\0" != c[k + 2 : k + 4]}
    expected = {(w, k, min(j for v, d, j, _ in rows if v == w and (j == k or parts(c) & parts(d)))) for w, c, k, same in rows if not same}
    others = spark.createDataFrame([(w, c, (k, c), same) for w, c, k, same in rows], "window long, context binary, first struct<k: int, context: binary>, same boolean")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = passages.nearest(others.withColumn("context", F.concat("context", F.lit(b"."), F.col("first.k").cast("string").cast("binary"))), 4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.window, int(bytes(r.context)[9:]), r["__nearer"].k) for r in found} == expected and len(found) == len(expected)


def test_op6_hashes_and_minima_are_those_of_plain_loops():
    rng = np.random.default_rng(13)
    hashes = rng.integers(0, 50, 300).astype(np.uint64)
    factor = int(passages.FACTOR)
    for size in (1, 2, 3, 5, 34, 99, 300):
        minima = passages.leftmost_minima(hashes, size).tolist()
        assert minima == [i + int(np.argmin(hashes[i : i + size])) for i in range(301 - size)]
        sums = [sum(int(h) * factor ** (size - 1 - k) for k, h in enumerate(hashes[i : i + size])) % 2**64 for i in range(301 - size)]
        assert passages.run_hashes(hashes, size).tolist() == [(x ^ x >> 31) * factor % 2**64 for x in sums]
    assert len(passages.leftmost_minima(hashes[:3], 4)) == 0


def test_op6_passages_go_whole(spark):
    rng = random.Random(10)
    prose = lambda n: [f"{rng.choice('abcdé')}{rng.randrange(10**6)}" for _ in range(n)]
    texts, left, at = {}, {}, {}
    for _ in range(60):
        passage = prose(rng.choice((50, 51, 66, 67, 90)))
        for k in range(3):  # also at the beginning and the end of a text
            before, after = prose(rng.choice((0, 40))), prose(rng.choice((0, 40)))
            i = len(texts)
            texts[i], at[i] = " ".join(before + passage + after), len(" ".join([*before, ""]))
            left[i] = before + passage + after if k == 0 else before + after
    df = documents(spark, list(texts.items()))
    found = [r for r in substrings.repeats(df).collect() if r.line is None]
    assert {r.doc_id for r in found} == {i for i in texts if i % 3}
    for r in found:
        assert (r.start, r.kept_id, r.kept_start) == (at[r.doc_id], r.doc_id - r.doc_id % 3, at[r.doc_id - r.doc_id % 3])
        assert r.n_words == len(texts[r.doc_id][r.start : r.end].split()) >= 50
    assert {r.doc_id: r.text.split() for r in substrings.cleaned(df).collect()} == left


def test_op6_bands_find_similar_paragraphs():
    rng = random.Random(15)
    words = [f"w{k}".encode() for k in range(3000)]
    found, compared = 0, 0
    for _ in range(400):
        base = rng.choices(words, k=100)
        near = list(base)
        near[rng.randrange(100)] = b"other"  # five shingles of 96 differ, or fewer
        more = [*near[:40], b"added", *near[40:]]
        a, b = ({bytes(x) for x in substrings.shingles(own)} for own in (base, more))
        if len(a & b) >= 0.8 * len(a | b):
            keys = substrings.bands([base, more])
            compared += 1
            found += bool((keys[0] == keys[1]).any())
    assert compared > 350 and found >= 0.99 * compared
    values, starts = substrings.shingle_hashes([[b"a"], [b"a", b"b", b"c", b"d", b"e", b"f"], [b"a", b"b", b"c", b"d", b"e"]])
    assert len(values) == 4 and starts.tolist() == [0, 1, 3] and values[1] == values[3] and len(set(values.tolist())) == 3


def test_op6_windows_are_those_of_each_text_alone():
    rng = random.Random(14)
    size, apart = passages.window_size(50)
    texts = [" ".join(rng.choices(["a", "b", "cé", "Dd"], k=rng.choice((0, 3, 49, 50, 51, 66, 200)))) for _ in range(60)]
    own, ends, hashes, words, around = passages.windows_of(texts, size, apart)
    assert own == [k for k, t in enumerate(texts) if len(t.split()) >= 50]
    by_content = {}
    for n, k in enumerate(own):
        found = words[ends[n] : ends[n + 1]].tolist()
        lower = texts[k].lower().split()
        alone = passages.windows_of([texts[k]], size, apart)
        assert found == alone[3].tolist() and hashes[ends[n] : ends[n + 1]].tolist() == alone[2].tolist() and around[n] == alone[4][0]
        for at, h in zip(found, alone[2].tolist()):
            assert by_content.setdefault(tuple(lower[at : at + size]), h) == h
        every = [passages.windows_of([" ".join(lower[i : i + size + apart - 1])], size, apart)[3][0] + i for i in range(len(lower) - size - apart + 2)]
        assert sorted(set(every)) == found  # of any neighbours the one of the smallest hash
    assert passages.windows_of([], size, apart)[0] == [] == passages.windows_of(["", "a b"], size, apart)[0]


def wrapped(words, width):
    return "\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width))


def edited(rng, words, rate):
    """A copy of which words are replaced, left out or added, each as often."""
    out = []
    for w in words:
        kind = rng.randrange(3) if rng.random() < rate else None
        out += [w] if kind is None else [] if kind == 1 else [f"x{rng.randrange(10**6)}"] if kind == 0 else [w, f"y{rng.randrange(10**6)}"]
    return out


def test_op6_pieces_are_cut_by_their_content():
    rng = random.Random(21)
    vocabulary = [f"w{k}".encode() for k in range(300)]
    runs = [rng.choices(vocabulary, k=rng.choice((50, 60, 99, 100, 101, 150, 400, 1500))) for _ in range(80)] + [[b"same"] * 500]
    mask = (1 << 64) - 1
    factor = int(passages.FACTOR)

    def hash_of(run, i):
        x = (xxhash.xxh64_intdigest(run[i - 1]) * factor + xxhash.xxh64_intdigest(run[i])) & mask
        return ((x ^ x >> 31) * factor) & mask

    for run, edges in zip(runs, substrings.pieces_of(runs, 50)):
        own = [mask, *(hash_of(run, i) for i in range(1, len(run)))]
        cuts = [i for i in range(50, len(run) - 49) if all(own[i] < x for x in own[i - 49 : i]) and all(own[i] <= x for x in own[i + 1 : i + 50])]
        assert edges == [0, *cuts, len(run)] and all(b - a >= 50 for a, b in zip(edges, edges[1:]))
        assert substrings.pieces_of([run], 50) == [edges]
    assert substrings.pieces_of([], 50) == [] and sum(len(e) > 3 for e in substrings.pieces_of(runs, 50)) > 10


def test_op6_lines_and_runs():
    long, short = " ".join(["é"] * 50), " ".join(["b"] * 30)
    text = f"{short}\n\n{short}\n{long}\n{short}\n{long}\n\n{short}\n{short}\n"
    lines, runs = substrings.lines_and_runs(text, 50)
    assert [(n, text[a:b]) for n, a, b, _ in lines] == [(3, long), (5, long)]
    assert [(n, text[a:b]) for n, a, b, _ in runs] == [(0, f"{short}\n\n{short}"), (6, f"\n{short}\n{short}\n")]
    assert substrings.lines_and_runs("", 50) == ([], []) and substrings.lines_and_runs("\n" * 300, 50) == ([], [])


def test_op6_near_copies_across_short_lines(spark):
    rng = random.Random(22)
    prose = lambda n: [f"{rng.choice('abcdé')}{rng.randrange(3000)}" for _ in range(n)]
    base = prose(400)
    every = [f"x{k}" if k % 48 == 24 else w for k, w in enumerate(base)]
    texts = {0: wrapped(base, 10), 1: wrapped(every, 10)}
    similar, passage = set(), {}
    for _ in range(150):  # copies with edits, wrapped at another width
        own = prose(rng.choice((80, 150, 300, 600)))
        other = edited(rng, own, rng.choice((0.01, 0.015, 0.02)))
        i = len(texts)
        texts |= {i: wrapped(own, rng.randrange(5, 20)), i + 1: wrapped(other, rng.randrange(5, 20))}
        a, b = (set(substrings.shingles([w.encode() for w in x])) for x in (own, other))
        if len(a & b) >= 0.8 * len(a | b):
            similar.add(i + 1)
    for _ in range(40):  # clean texts, and lines of fewer than 50 words together
        texts[len(texts)] = wrapped(prose(rng.choice((20, 45, 300))), 9)
    for _ in range(20):  # a near copy of some 300 words within texts that differ otherwise
        own = prose(300)
        i = len(texts)
        texts |= {i + k: wrapped(prose(200) + (edited(rng, own, 0.012) if k else own) + prose(200), 11) for k in range(2)}
        passage[i + 1] = i
    found = substrings.repeats(documents(spark, list(texts.items()))).collect()
    gone = {r.doc_id for r in found}
    assert len(similar) > 90 and 1 in gone and len(gone & similar) >= 0.9 * len(similar)
    assert len(gone & set(passage)) >= 0.9 * len(passage)
    assert all(r.kept_id < r.doc_id for r in found)  # the texts that come first lose nothing, nor do clean ones
    partner = dict(passage) | {i: i - 1 for i in range(1, 302, 2)}
    for r in found:
        assert partner[r.doc_id] == r.kept_id
        if r.line is not None:
            part = texts[r.doc_id][r.start : r.end]
            assert len(part.split()) == r.n_words >= 50 and texts[r.doc_id].count("\n", 0, r.start) == r.line
    whole = [r for r in found if r.doc_id == 1 and r.line == 0 and r.end == len(texts[1])]
    assert len(whole) == 1 and whole[0].kept_start == 0
    clean = {r.doc_id: r.text for r in substrings.cleaned(documents(spark, list(texts.items()))).collect()}
    assert clean[1] == "" and all(clean[i] == t for i, t in texts.items() if i not in gone)


def test_op6_cut():
    from probalink.llm.passages import cut

    assert cut("a\nb\nc", [(2, 3)]) == "a\nc" and cut("a\nb\nc", [(4, 5), (2, 3)]) == "a" and cut("a\nb", [(0, 1)]) == "b"
    assert cut("a b\nc", [(2, 3)]) == "a\nc" and cut("a", [(0, 1)]) == "" and cut("a b c d", [(2, 5), (4, 5)]) == "a d"


def digest(children):
    """A node's hash from its children's (length, hash), in order."""
    at, parts = 0, []
    for length, own in children:
        parts.append(f"{at}:{at + length}:{own}")
        at += length
    return at, hashlib.sha256(",".join(parts).encode()).hexdigest()


def root_of(rows):
    """The root of a file's (page_id, record) rows, branching from records up to the file."""
    hashes = sorted(((i is None, i or 0, hashlib.sha256(r.encode()).hexdigest(), len(r.encode()) + 4) for i, r in rows))
    level = [((none, i >> 5, i, h[:3], h), (size * n, h)) for (none, i, h, size), n in sorted(Counter(hashes).items())]
    for depth in (4, 3, 2, 0):
        grouped = {}
        for key, node in level:
            grouped.setdefault(key[:depth], []).append(node)
        level = [(key, digest(children)) for key, children in grouped.items()]
    return level[0][1][1]


def check_audit(spark, first, second):
    """The audit of (file, page_id, record) rows against plain Python."""
    schema = "file long, page_id long, record string, number string, hash string, corrupt string, none int, id int, __x int"
    made = [spark.createDataFrame([(*r, "x", "x", "x", 1, 1, 1) for r in rows], schema) for rows in (first, second)]
    found = warc.audited(*made)
    own, left = [], Counter(second)
    for file in {f for f, _, _ in first}:
        rows = sorted(((i is None, i or 0, hashlib.sha256(r.encode()).hexdigest(), i, r) for f, i, r in first if f == file))
        root, offset, copies = root_of([(i, r) for _, _, _, i, r in rows]), 0, Counter()
        for number, (_, _, h, i, r) in enumerate(rows):
            size = len(r.encode()) + 4
            own.append((file, i, number, offset, size, h, root, copies[i, r] >= left[file, i, r]))
            copies[i, r] += 1
            offset += size
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(own, key=repr)
    return own


def test_op7_audit_is_that_of_a_plain_tree(spark):
    rng = random.Random(12)
    rows = [(k // 100, k, f"é {k}") for k in range(300)] + [(-5, None, "x"), (-5, None, "y"), (-5, None, "x")] + [(1, 150, "again"), (1, 150, "again"), (2, 250, ""), (0, -3, "negative")]
    rows += [(3, 333, f"many {rng.randrange(3000)}") for _ in range(5000)]
    other = [r for r in rows if r[1] != 140 and r[2] != "y"]  # one missing in the middle, one without an id
    other[7], other[-1] = (0, 7, "damaged"), (3, 333, "damaged")
    other.remove((1, 150, "again"))
    other += [(0, 55, "added"), (9, 900, "a file of its own")]
    own = check_audit(spark, rows, other)
    bad = [(i, h) for _, i, _, _, _, h, _, corrupt in own if corrupt]
    assert len(bad) == 5 and {i for i, _ in bad} == {7, 140, 150, 333, None}  # damage stays where it is
    check_audit(spark, other, rows)
    assert not [r for r in check_audit(spark, rows[:200], rows[:200]) if r[-1]]
    check_audit(spark, rows[:50], [])
    check_audit(spark, [], rows[:50])


def test_op7_copies_are_counted_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 7)
    check_audit(spark, [(0, 1, "same")] * 50 + [(0, 2, "other")] * 7, [(0, 1, "same")] * 20 + [(0, 2, "other")] * 8)


def test_op7_differing_branches_alone_are_compared(spark):
    rows = [(k // 1024, k, f"r{k}") for k in range(4096)]
    trees = []
    for damage in (None, 2000):
        records = spark.createDataFrame([(f, i, r + "!" * (i == damage)) for f, i, r in rows], "file long, page_id long, record string")
        trees.append(warc.tree(warc.leaves(records)))
    assert [r.id for r in warc.mismatches(*trees).collect()] == [2000, 2000] and [t.count() for t in trees[0]] == [4096, 4096, 4096, 128, 4]


def test_op7_files(spark, tmp_path):
    rows = [(k, f"http://h/{k}", f"<p>é {k}</p>\r\n\r\n" * (k % 5)) for k in range(300)] + [(None, None, None), (None, "u", "x"), (5, "http://h/5", "again"), (6, None, None), (-1, "n", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.records(pages, per_file=100)
    warc.write(records, str(tmp_path / "warc"))
    again = warc.read(spark, str(tmp_path / "warc"))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, records.collect()), key=repr)
    assert {r.file for r in records.where("page_id >= 0").collect()} == {0, 1, 2}


def exact(vectors, every, k):
    out = {}
    usable = {i: np.array(v, float) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    for q in usable:
        if q % every == 0:
            near = [(-float(usable[q] @ v) / float(np.linalg.norm(usable[q]) * np.linalg.norm(v)), i) for i, v in usable.items() if i != q]
            out[q] = sorted((round(s, 9), i) for s, i in near)[:k]
    return out


def test_op9_small_tables_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 8) for i in range(60)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2050, [float("nan")] * 8), (2100, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (2051, [None] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block, size in ((4096, ann.QUERY_BYTES), (50, 200)):
        found = {}
        for r in ann.nearest(clashing(df), block=block, query_bytes=size).orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append((round(-r.score, 9), r.vec_id))
        expected = exact(rows, 50, 5)
        assert found.keys() == expected.keys()
        right = sum(len(set(found[q]) & set(expected[q])) for q in expected)
        assert right >= 0.9 * sum(map(len, expected.values()))
        assert [i for _, i in found[1000]] == [1001, 1002, 1003, 1004, 1005]
    assert ann.nearest(df.where("vec_id IN (50, 7)")).count() == 1 and ann.nearest(df.where("false")).count() == 0


def test_op9_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    expected = exact(rows, 50, 5)
    found = {(r.query_id, r.vec_id) for r in queries.op9_ann(spark, sf).collect()}
    hits = sum((q, i) in found for q, near in expected.items() for _, i in near)
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_op9_ids_with_several_vectors(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [1.0, 0.1]), (7, [-1.0, 0.2]), (7, [-1.0, 0.2]), (8, [0.1, 1.0])]
    found = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    vectors = [(i, np.array(v)) for i, v in {(i, tuple(v)) for i, v in rows}]
    scores = [(-round(float(q @ v / np.linalg.norm(q) / np.linalg.norm(v)), 9), i) for o, q in vectors if o == 50 for i, v in vectors if i != 50]
    assert sorted(found) == [(50, k + 1, i, -score) for k, (score, i) in enumerate(sorted(scores)[:5])]


def test_op9_recall_of_real_neighbours(spark):
    """Clusters whose members are near each other, over several blocks and groups of queries."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(600, 32))
    vectors = centres[np.arange(6000) % 600] + rng.normal(size=(6000, 32)) * rng.choice([0.05, 0.2, 0.4], size=(6000, 1))
    found = {(r.query_id, r.vec_id) for r in ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"), block=1000, query_bytes=10_000).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 6000, 50):
        score = unit @ unit[q]
        score[q] = -2
        hits += sum((q, i) in found for i in np.argsort(-score)[:5].tolist())
    assert len(found) == 600 and hits >= 0.9 * 600


def test_op9_windows_leave_most_of_a_block_of_clusters_unseen():
    rng = np.random.default_rng(8)
    vectors = np.repeat(rng.normal(size=(100, 32)), 20, axis=0) + rng.normal(size=(2000, 32)) * 0.1
    search = ann.Search()
    order, arrays = search.arrays(vectors)
    best = ann.Best(np.array([0]), vectors[:1], search)
    seen = []
    real = ann.np.lexsort
    ann.np.lexsort = lambda keys: seen.append(len(keys[0])) or real(keys)
    try:
        best.look(np.arange(2000), vectors, order, arrays)
    finally:
        ann.np.lexsort = real
    assert set(best.found[0].tolist()) <= set(range(20)) and max(seen) < 500

from __future__ import annotations

import base64
import cProfile
import hashlib
import pstats
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from data import ODD, PROSE, clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from probalink.llm import bpe, packing, token_counts

MULTI, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
LETTERS = ["a", "b", "é", " ", "  ", "\n", "\t", "'s", "'", "1", "23", "!", "###", " ", "the", "<|endoftext|>", "\x1c", "漢字", "😀", "ing", "x" * 40, "ab" * 30, "'ll", "'re", "'ve", "l", "r", "v"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("multi", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), Tokenizer.from_file(JSON)


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_the_libraries(library):
    multi, own = bpe.encoder(MULTI, P.PATTERN), bpe.encoder(JSON, P.PATTERN)
    some = texts(1, 1500)
    ids, ends = own.encode_batch(some)
    for k, (t, e) in enumerate(zip(some, library[1].encode_batch(some, add_special_tokens=False))):
        assert ids[ends[k] : ends[k + 1]].tolist() == e.ids
        assert multi.encode(t) == library[0].encode_ordinary(t)
        assert multi.decode(multi.encode(t)) == t.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(text):
    multi = bpe.encoder(MULTI, P.PATTERN)
    assert multi.decode(multi.encode(text)) == text.encode()


def test_both_trees_merge_alike():
    multi = bpe.encoder(MULTI, P.PATTERN)
    for t in texts(2, 200):
        for piece in multi.pattern.findall(t):
            assert multi.merge(piece.encode()) == np.frombuffer(multi.learn([piece])[piece], "<u4").tolist()


def test_remembered_encodings_start_anew(library):
    small = bpe.Encoder(bpe.read_ranks(MULTI), P.PATTERN, remembered=5)
    for t in texts(3, 100):
        assert small.encode(t) == library[0].encode_ordinary(t)


def test_op1_rows(spark, library):
    df = clashing(documents(spark, ODD))
    found = bpe.digests(bpe.with_bytes(bpe.with_ids(df, MULTI, P.PATTERN), MULTI, P.PATTERN)).collect()
    expected = []
    for i, t in ODD:
        ids = library[0].encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert bpe.with_ids(documents(spark, []), MULTI, P.PATTERN).count() == 0


def test_splices_give_the_whole_count(library):
    own = bpe.encoder(JSON, P.PATTERN)
    rng = random.Random(9)
    dense = ["".join(rng.choices(["a", " ", "'ll", "'re", "'ve", "x" * 33, "the", "!", "1"], k=rng.randint(0, 40))) for _ in range(4000)]
    some = texts(4, 800) + dense
    right = [len(e.ids) for e in library[1].encode_batch(some, add_special_tokens=False)]
    for step, overlap in ((7, 1), (11, 3), (16, 5), (5, 9)):
        assert token_counts.counts(own, some, whole=0, step=step, overlap=overlap) == right
    long = "".join(rng.choices(["ab'll ", "we've ", "'re", " ", "the ", "\n\n ", "1!", "don't "], k=500_000))
    assert token_counts.counts(own, [long]) == [len(library[1].encode(long, add_special_tokens=False).ids)]
    for t in ("ab" * 3000, " " * 3000, PROSE * 30, "1" * 999 + " " + "x" * 999):
        assert token_counts.counts(own, [t], whole=10, step=100, overlap=5) == [len(library[1].encode(t, add_special_tokens=False).ids)]


def test_op10_rows(spark, library):
    found = token_counts.token_counts(clashing(documents(spark, ODD)), JSON, P.PATTERN).collect()
    expected = [(i, len((t or "").encode()), n := len(library[1].encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in ODD]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert token_counts.token_counts(documents(spark, []), JSON, P.PATTERN).count() == 0


def naive_packing(lengths, capacity):
    """The room left in each sequence, placing one piece after another by search."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [(room, k) for k, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(50, 70))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    histogram = defaultdict(int)
    for n in lengths:
        histogram[n] += 1
    rooms, counts = defaultdict(lambda: capacity), defaultdict(int)
    for run in packing.best_fit_decreasing(dict(histogram), capacity):
        for k in range(run.count):
            sequence = run.sequence + k // run.each
            assert capacity - rooms[sequence] == run.offset + k % run.each * run.length
            rooms[sequence] -= run.length
        counts[run.length] += run.count
    assert counts == histogram and sorted(rooms.values()) == naive_packing(lengths, capacity)


@pytest.mark.parametrize("sent", [packing.SENT, 7])
def test_op4_rows(spark, library, monkeypatch, sent):
    monkeypatch.setattr(packing, "SENT", sent)
    rng = random.Random(5)
    more = [(100 + k, " ".join(rng.choices(PROSE.split(), k=rng.randint(0, 900)))) for k in range(120)]
    rows = packing.packed(clashing(documents(spark, ODD + more)), JSON, P.PATTERN, keep_ids=True).collect()
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_document[r.doc_id].append((r.piece, r.start, r.length, list(r.token_ids)))
        assert zlib.crc32(np.array(r.token_ids, "<u4").tobytes()) == r.ids_crc32 and len(r.token_ids) == r.length
    for own in by_sequence.values():
        own.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[0][0] == 0 and own[-1][0] + own[-1][1] <= 1024
    assert len(by_sequence) == len(naive_packing([r.length for r in rows], 1024))
    for i, t in more:
        own = sorted(by_document[i])
        assert [x for p in own for x in p[3]] == library[1].encode(t, add_special_tokens=False).ids + [2]
        assert [p[0] for p in own] == list(range(len(own))) and [p[1] for p in own] == [sum(q[2] for q in own[:k]) for k in range(len(own))] and all(p[2] == 1024 for p in own[1:])
    assert by_document[2] == [(0, 0, 1, [2])] and len(by_document[9]) == 2
    assert packing.packed(documents(spark, []), JSON, P.PATTERN).count() == 0


def test_pieces_of_every_length_are_those_of_trees_of_their_own():
    own = bpe.Encoder(bpe.read_json(JSON)[0], P.PATTERN)
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abeinorst") for _ in range(n)) for n in range(1, 41) for _ in range(20)]
    found = own.learn(pieces)
    assert {p: np.frombuffer(found[p], "<u4").tolist() for p in pieces} == {p: own.merge(p.encode()) for p in pieces}
    assert own.learn(pieces) == found


def test_cuts_are_the_matches_of_the_pattern():
    own = bpe.encoder(JSON, P.PATTERN)
    assert P.PATTERN == bpe.RUNS
    rng = random.Random(11)
    near = ["'", "s", "t", "re", "r", "ve", "l", "ll", "S", " ", "\n", "\t", "\x85", "\xa0", "\u2003", "\u3000", "\u0300", "é", "漢", "😀", "𝟙", "٣", "²", "!", "1", "\0", "\x1c"]
    some = ["".join(rng.choices(near, k=rng.randint(0, 12))) for _ in range(30_000)]
    some += ["".join(chr(c) for c in range(k, k + 64) for _ in (0, rng.randint(0, 1))) for k in range(0, 0x30000, 64) if not 0xD800 <= k < 0xE000]
    for first, last in ((0, len(some)), (17, 9_000), (5, 5)):  # also slices of an array
        pieces, starts = own.cut(pa.array(some).slice(first, last - first))
        pieces = pieces.to_pylist()
        assert [pieces[a:b] for a, b in zip(starts, starts[1:])] == [own.pattern.findall(t) for t in some[first:last]]
    for none in ([""], ["", ""], ["", "a", ""]):
        ids, ends = own.encode_batch(none)
        assert ends.tolist() == [0, *np.cumsum([len(t) for t in none])] and len(ids) == ends[-1]


def test_other_patterns_are_searched():
    pattern = r"\p{L}{1,3}|[^\p{L}]"
    ranks = bpe.read_ranks(MULTI)
    own, right = bpe.Encoder(ranks, pattern), tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert [own.encode(t) for t in texts(6, 200)] == [right.encode_ordinary(t) for t in texts(6, 200)]


def test_no_step_for_each_word_that_repeats_its_pieces():
    """Chunks between spaces all differ, but consist of few pieces: the encoder may take steps for each piece, not for each chunk."""
    words = [a + b for a in "bcdfghklmn" for b in ("ana", "olo", "ete", "iri", "uku")]
    text = " ".join(f"{a}.\n{b}{end}" for a in words for b in words for end in ",;!")
    own = bpe.Encoder(bpe.read_json(JSON)[0], P.PATTERN)
    profile = cProfile.Profile()
    ids, _ = profile.runcall(own.encode_texts, [text])
    assert own.decode(ids.tolist()) == text.encode()
    assert pstats.Stats(profile).total_calls < text.count(" ")

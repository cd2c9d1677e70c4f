from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from data import ODD, PROSE, clashing, documents
from tokenizers import Tokenizer

from probalink.llm import alignment, bpe

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha256, groups) of each text, link by link."""
    a, b = libraries
    letters = bpe.byte_letters()
    inverse = {i: t for t, i in a.get_vocab().items()}
    each = []
    for text in texts:
        whole = b" " + (text or "").encode()
        one = [(i, bytes(letters[c] for c in inverse[i])) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        two = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]] if text else []
        if any(b"".join(x for _, x in side) != whole for side in (one, two)):
            one = two = []
        spans = []
        for side in (one, two):
            at, own = 0, []
            for i, x in side:
                own.append((at, at + len(x), i))
                at += len(x)
            spans.append(own)
        owner = [[n for n, (s, e, _) in enumerate(own) for _ in range(s, e)] for own in spans]
        links = [(spans[0][x][2], spans[1][y][2]) for x, y in sorted(set(zip(*owner)))]  # the two tokens of every byte
        common = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
        groups, at = [], [0, 0]
        for e in sorted(common):
            own = []
            for k in (0, 1):
                ids = []
                while at[k] < len(spans[k]) and spans[k][at[k]][1] <= e:
                    ids.append(str(spans[k][at[k]][2]))
                    at[k] += 1
                own.append(",".join(ids))
            groups.append("|".join(own))
        each.append((len(one), len(two), ";".join(groups), len(groups), links))
    count = Counter(x for *_, links in each for x in links)
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [(n, m, g, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(t.encode()).hexdigest() if n else "", t) for n, m, t, g, links in each]


LETTERS = ["a", "é", " ", "  ", "\n", "\t", "'s", "1", "23", "!", "the", "<|endoftext|>", "<s>", "<0x41>", "漢字", "😀", "ing", " of", "tion", "x" * 40, "Ünï", "\x00", " ", "ﬁ"]
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def some_texts():
    rng = random.Random(4)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["▁", "a ▁b", "under▁score", PROSE * 40, " ".join(PROSE.split()) + " "]


def test_pieces_are_the_models(libraries):
    import numpy as np
    import pyarrow as pa

    own = alignment.PieceEncoder(B, remembered=50)
    for _ in range(2):
        texts = [t for t in some_texts() if t]
        ids, ends, right = own.encode_texts(pa.array(texts))
        for k, t in enumerate(texts):
            assert right[k] == ("▁" not in t)
            if right[k]:
                assert ids[ends[k] : ends[k + 1]].tolist() == libraries[1].encode(t)
    assert len(own.encode_texts(pa.array([], pa.string()))[1]) == 1 and np.all(right[:3])


@pytest.mark.parametrize(("held", "hot", "events"), [(alignment.HELD, alignment.HOT, alignment.EVENTS), (50, 40, 16)])
def test_op11_rows(spark, libraries, monkeypatch, held, hot, events):
    monkeypatch.setattr(alignment, "EVENTS", events)
    texts = [(i, t) for i, t in ODD] + [(1000 + k, t) for k, t in enumerate(some_texts())]
    df = clashing(documents(spark, texts))
    found = alignment.aligned(df, A, B, P.PATTERN, with_groups=True, held=held, hot=hot).collect()
    expected = [(i, *x) for (i, _), x in zip(texts, plain(libraries, [t for _, t in texts]))]
    assert sorted([(r.doc_id, *(r[c] for c in COLUMNS), r.groups) for r in found], key=repr) == sorted(expected, key=repr)


def test_op11_of_nothing(spark):
    assert alignment.aligned(documents(spark, []), A, B, P.PATTERN).count() == 0
    row = alignment.aligned(documents(spark, [(1, None)]), A, B, P.PATTERN).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "")


def test_a_task_flushes_its_counts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FLUSHED", 3)
    df = spark.createDataFrame([([1, 2, 3], [1, 1, 2]), ([2, 5], [4, 1]), ([], [])], "pairs array<long>, counts array<int>").coalesce(1)
    assert {tuple(r) for r in alignment.pair_counts(df).collect()} == {(1, 1), (2, 5), (3, 2), (5, 1)}

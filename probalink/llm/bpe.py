"""Byte-level BPE encoding and decoding (operator 1), and the encoder that operators 4 and 10 share.

The merge loop of one piece works on a segment tree over its byte positions. A leaf holds the rank of the pair that begins at its
position, an inner node the smallest below it, so that the root gives the leftmost pair of smallest rank. A merge changes at most
three positions (the merged pair, the swallowed neighbour and the pair to the left), each a point update that walks one path to the
root. Short pieces go through such trees many at once, a row of a matrix each (`merged_rows`); a long piece has a tree of its own,
whose leaves are blocks of LEAF positions (`PairRanks`).

Texts are cut into the matches of the pattern all at once, by comparing the kinds of neighbouring characters (`matches`), and each
distinct piece of a slice is encoded once. Encodings of short pieces are remembered in a bounded table: texts repeat words.
"""

from __future__ import annotations

import base64
import functools
import json
import sys
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probalink.llm.common import in_arrow, text_of

LEAF = 32
#: Pieces of more bytes get a tree of their own.
SHORT = 32
#: Entries after which the table of remembered encodings starts anew.
REMEMBERED = 500_000
NO_RANK = 1 << 25
#: The pattern that `matches` knows.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def kinds() -> np.ndarray:
    """Of every code point: white space 0, letter 1, number 2, anything else 3."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    out = np.full(sys.maxunicode + 1, 3, np.uint8)
    for kind, of in enumerate((r"\s", r"\p{L}", r"\p{N}")):
        out[np.frombuffer("".join(regex.findall(of, points)).encode("utf-32-le"), "<u4")] = kind
    return out


def matches(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the matches of RUNS begin in the UTF-8 bytes of texts that begin and end at bounds.

    A match is a run of characters of one kind, except that the last character of white space before another kind goes to the run
    behind it if it is a space, and else stands alone, and that an apostrophe at the begin of a match goes to the letters of a contraction.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    kind, high = kinds()[data], data >= 0x80
    if high.any():
        points = np.frombuffer(data[high].tobytes().decode().encode("utf-32-le"), "<u4")
        kind[high] = np.repeat(kinds()[points], 2 + (points >= 0x800) + (points >= 0x10000))
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    first = first[:-1]
    cut = first.copy()
    cut[1:] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == 0) & (kind[1:] != 0) & ~first[1:])  # the last byte of white space
    cut[last[data[last] == 32] + 1] = False
    for _ in range(2):  # to the first byte of its character
        last = last - ((data[last] & 0xC0) == 0x80)
    cut[last] = True
    mark = np.flatnonzero((data[:-1] == 39) & cut[:-1] & ~first[1:])
    more = mark[mark + 2 < len(data)]
    more = more[~first[more + 2]]
    one = mark[np.isin(data[mark + 1], list(b"stmd"))]
    two = more[np.isin(data[more + 1].astype(np.int64) * 256 + data[more + 2], [int.from_bytes(x) for x in (b"re", b"ve", b"ll")])]
    cut[np.concatenate([one, two]) + 1] = False
    ends = np.concatenate([one + 2, two + 3])
    cut[ends[ends < len(data)]] = True
    return np.flatnonzero(cut)


class PairRanks:
    """Segment tree over positions: the smallest pair rank and the leftmost position that has it."""

    def __init__(self, ranks: list[int]):
        self.ranks = ranks
        blocks = -(-len(ranks) // LEAF)
        self.size = 1 << (blocks - 1).bit_length()
        self.tree = [NO_RANK] * (2 * self.size)
        for block in range(blocks):
            self.tree[self.size + block] = min(ranks[block * LEAF : (block + 1) * LEAF])
        for node in range(self.size - 1, 0, -1):
            self.tree[node] = min(self.tree[2 * node], self.tree[2 * node + 1])

    def leftmost_minimum(self) -> tuple[int, int]:
        rank, node = self.tree[1], 1
        if rank == NO_RANK:
            return rank, -1
        while node < self.size:
            node = 2 * node if self.tree[2 * node] == rank else 2 * node + 1
        start = (node - self.size) * LEAF
        return rank, self.ranks.index(rank, start, start + LEAF)

    def put(self, position: int, rank: int) -> None:
        self.ranks[position] = rank
        block = position // LEAF
        node = self.size + block
        self.tree[node] = min(self.ranks[block * LEAF : (block + 1) * LEAF])
        while node > 1:
            node //= 2
            smallest = min(self.tree[2 * node], self.tree[2 * node + 1])
            if self.tree[node] == smallest:
                break
            self.tree[node] = smallest


class Encoder:
    """Encodes texts by the ranks of byte strings. special: texts that stand for one id wherever they occur."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int] | None = None, remembered: int = REMEMBERED):
        self.ranks, self.remembered = ranks, remembered
        self.pattern = regex.compile(pattern)
        self.special = special or {}
        self.at_special = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.bytes_of = {rank: piece for piece, rank in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.pieces: dict[bytes, bytes] = {}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {(ranks[t[:k]] << 20) + ranks[t[k:]]: rank for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair of ids makes, NO_RANK where it makes none."""
        key = (left.astype(np.int64) << 20) + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def merged_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """The ids of pieces of at most width bytes (a power of two), all merged side by side.

        Row r of tree is the segment tree of piece r: node 1 is its root, nodes width to 2 * width - 1 are its byte positions. A
        node holds rank * width + position, whose minimum is the leftmost pair of smallest rank. Matrices are indexed flat.
        """
        n = len(pieces)
        lengths = np.array([len(p) for p in pieces])
        place = np.arange(width)
        live = place < lengths[:, None]
        ids = np.zeros((n, width), np.int32)
        ids[live] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        none = NO_RANK * width
        leaf = np.full((n, width), none, np.int32)
        paired = np.flatnonzero(place < lengths[:, None] - 1)
        rank = self.pair_rank(ids.ravel()[paired], ids.ravel()[paired + 1])
        leaf.ravel()[paired] = np.where(rank == NO_RANK, none, rank * width + paired % width)
        tree = np.empty((n, 2 * width), np.int32)
        tree[:, width:] = leaf
        at = width
        while at > 1:
            at //= 2
            np.minimum(tree[:, 2 * at : 4 * at : 2], tree[:, 2 * at + 1 : 4 * at : 2], out=tree[:, at : 2 * at])
        after = np.broadcast_to((place + 1).astype(np.int8), (n, width)).copy().ravel()
        before = np.broadcast_to(np.arange(-1, width, dtype=np.int8), (n, width + 1)).copy().ravel()
        ids, alive, tree = ids.ravel(), live.ravel(), tree.ravel()
        levels = width.bit_length() - 1

        def put(row: np.ndarray, spot: np.ndarray, new: np.ndarray | int) -> None:
            node = row * (2 * width) + width + spot
            tree[node] = new
            at = width + spot
            for _ in range(levels):
                at = at >> 1
                node = row * (2 * width) + at
                twice = node + at
                tree[node] = np.minimum(tree[twice], tree[twice + 1])

        rows = np.flatnonzero(tree[1 :: 2 * width] != none)
        while len(rows):
            root = tree[rows * (2 * width) + 1]
            i = (root % width).astype(np.int64)
            here = rows * width + i
            gone = after[here].astype(np.int64)
            follows = after[rows * width + gone].astype(np.int64)
            ids[here] = root // width
            alive[rows * width + gone] = False
            after[here] = follows
            before[rows * (width + 1) + follows] = i
            left = before[rows * (width + 1) + i].astype(np.int64)
            new = np.full(len(rows), none, np.int64)
            own = np.flatnonzero(follows < lengths[rows])
            rank = self.pair_rank(ids[here[own]], ids[rows[own] * width + follows[own]])
            new[own] = np.where(rank == NO_RANK, none, rank * width + i[own])
            put(rows, gone, none)
            put(rows, i, new)
            own = np.flatnonzero(left >= 0)
            row, left = rows[own], left[own]
            rank = self.pair_rank(ids[row * width + left], ids[here[own]])
            put(row, left, np.where(rank == NO_RANK, none, rank * width + left))
            rows = rows[tree[rows * (2 * width) + 1] != none]
        flat = ids[alive].astype("<u4").tobytes()
        ends = (4 * np.cumsum(alive.reshape(n, width).sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece by a tree of its own."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        rank_of, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        tree = PairRanks([rank_of(piece[i : i + 2], NO_RANK) for i in range(n - 1)] + [NO_RANK])
        while True:
            rank, i = tree.leftmost_minimum()
            if rank == NO_RANK:
                break
            gone = after[i]
            end = after[gone]
            after[i] = end
            tree.put(gone, NO_RANK)
            if end < n:
                before[end] = i
                tree.put(i, rank_of(piece[i : after[end]], NO_RANK))
            else:
                tree.put(i, NO_RANK)
            if (left := before[i]) >= 0:
                tree.put(left, rank_of(piece[left:end], NO_RANK))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def codes(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces (matches of the pattern) as little-endian unsigned 32-bit numbers; remembers those of short ones."""
        known, rank_of = self.pieces, self.ranks.get
        if len(known) > self.remembered:
            known.clear()
        found = list(map(known.get, pieces))
        by_width: list[list[int]] = [[] for _ in range(SHORT.bit_length())]  # pieces of one width, a power of two, are merged together
        for k in [k for k, ids in enumerate(found) if ids is None]:
            piece = pieces[k]
            whole = rank_of(piece)
            if whole is not None:
                known[piece] = found[k] = whole.to_bytes(4, "little")
            elif len(piece) > SHORT:
                found[k] = np.array(self.merge(piece), "<u4").tobytes()
            else:
                by_width[(len(piece) - 1).bit_length()].append(k)
        for power, own in enumerate(by_width):
            if own:
                group = [pieces[k] for k in own]
                new = self.merged_rows(group, 1 << power)
                known.update(zip(group, new))
                for k, ids in zip(own, new):
                    found[k] = ids
        return found

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The ids of each of pieces, as codes gives them."""
        distinct = list(set(pieces))
        return dict(zip(distinct, self.codes([p.encode() for p in distinct])))

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The matches of the pattern in all texts, and where each text's begin and end among them."""
        if self.pattern.pattern != RUNS:
            found = [self.pattern.findall(t) for t in texts.to_pylist()]
            return pa.array([p for own in found for p in own], pa.large_string()), np.cumsum([0, *map(len, found)])
        texts = texts.cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = (texts.buffers()[2] or pa.py_buffer(b"")).slice(bounds[0], bounds[-1] - bounds[0])
        bounds = bounds - bounds[0]
        begins = matches(np.frombuffer(data, np.uint8), bounds)
        pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, bounds[-1])), data)
        return pieces, np.searchsorted(begins, bounds)

    def encode_texts(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts without special strings: all ids in one array, and where each text's begin and end in it."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        pieces, starts = self.cut(texts)
        coded = pieces.dictionary_encode()
        codes = pa.array(self.codes(coded.dictionary.cast(pa.large_binary()).to_pylist()), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(codes.buffers()[1], np.int64)[: len(codes) + 1] >> 2
        return np.frombuffer(codes.buffers()[2] or b"", "<u4", ends[-1]), ends[starts]

    def encode_batch(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As encode_texts, with special strings as their ids."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        found = np.zeros(len(texts), bool)
        for s in self.special:
            found |= np.asarray(pc.match_substring(texts, s))
        if not found.any():
            return self.encode_texts(texts)
        parts = [self.at_special.split(t) if special else [t] for t, special in zip(texts.to_pylist(), found.tolist())]
        ids, ends = self.encode_texts([t for own in parts for t in own[::2]])
        out, k = [], 0
        for own in parts:
            each = []
            for s in own:
                if len(each) % 2:
                    each.append(np.array([self.special[s]], np.uint32))
                else:
                    each.append(ids[ends[k] : ends[k + 1]])
                    k += 1
            out.append(np.concatenate(each))
        return np.concatenate(out), np.cumsum([0, *map(len, out)])

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line of base64 bytes and a number for each token."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def byte_letters() -> dict[str, int]:
    """The printable letters by which byte-level vocabularies in JSON write bytes: printable Latin-1 as itself, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def read_json(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The ranks and the added special texts of a byte-level BPE vocabulary in JSON, whose ids follow the order of its merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return ranks, special


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder a process, by the place of its vocabulary (.tiktoken or .json), which every executor has."""
    if path.endswith(".json"):
        ranks, special = read_json(path)
        return Encoder(ranks, pattern, special)
    return Encoder(read_ranks(path), pattern)


def ragged(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))


def with_ids(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids): the token ids of every whole text.

    Null and empty texts have no ids; null ids and repeated rows stay, each row by itself. An empty table gives an empty result. Other
    columns are not read. Texts of any length are encoded whole. No shuffle: each row is encoded where it is read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path, pattern)
        return pa.RecordBatch.from_arrays([batch.column(0), ragged(*own.encode_batch(batch.column(1)))], [id_col, "token_ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return in_arrow(df.select(F.col(id_col), text_of(text_col).alias("__text")), run, f"`{id_col}` {kind}, token_ids array<int>")


def with_bytes(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, ids, decoded): the bytes that token ids stand for. Null lists count as empty; an id without a token is an error."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path, pattern)
        ids = batch.column(1)
        decoded = pa.array([own.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else ()) for x in ids], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), ids, decoded], [id_col, ids_col, "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return in_arrow(df.select(id_col, ids_col), run, f"`{id_col}` {kind}, `{ids_col}` array<int>, decoded binary")


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of encoded and decoded texts."""
    return df.select(
        id_col,
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )



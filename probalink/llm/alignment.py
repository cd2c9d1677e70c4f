"""Alignment of two tokenizers' tokens by a sweep over their ends (operator 11).

Each text is encoded twice: by a byte-level BPE (A) and by a sentencepiece model (B). The tokens of either side become end events, up
to EVENTS of one side in a row, with the byte offset where the first of them begins; a token's length follows from its id. The events
of both sides are united, dealt out by document, sorted by offset within a partition and streamed through a machine that keeps the
open group of one document: where both sides end, a group ends; between two neighbouring ends lies exactly one link, that of the A
token and the B token which cover the bytes between them. A document's links leave as counts of id pairs.

How often the corpus links a pair is summed over the documents' counts. Pairs with more than one in HOT of all links, of which there
are at most HOT, are broadcast to the documents' pairs; the others, of which no document set is large, meet their counts by a join.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probalink.llm.bpe import encoder
from probalink.llm.common import slices, stored, text_of

#: Ends in one row of events; ends of one document and side that the sweep holds before it lets the closed groups go.
EVENTS, HELD = 8192, 1 << 19
#: Chunks whose pieces are remembered of each tokenizer, as a process holds both, and the characters of the longest.
REMEMBERED, CHUNK = 120_000, 64
#: Pairs that are broadcast at most, and the entries after which a task sends its counts of pairs on.
HOT, FLUSHED = 1 << 18, 1 << 21
SPACE_MARK = "▁"
#: How events write ids.
NARROW, WIDE = np.dtype("<u2"), np.dtype("<u4")


class PieceEncoder:
    """Pieces of a sentencepiece model for whole texts, and whether their joined bytes are a space and the text.

    No piece of such a model has its space mark after another character (checked when it is loaded), so a text may be cut before every space
    that follows something else, and its chunks encoded, and remembered, by themselves. A text where spaces follow each other, or
    that begins or ends with one, goes as a whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(names)]
        self.cuts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in names)
        self.remembered = remembered
        self.known: dict[str, bytes | None] = {}

    def found(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text as little-endian 32-bit numbers; None where their bytes aren't a space and the text."""
        out = []
        for text, ids in zip(texts, self.model.encode(texts, num_threads=1)):
            same = b"".join([self.bytes_of[i] for i in ids]) == b" " + text.encode()
            out.append(np.array(ids, "<u4").tobytes() if same else None)
        return out

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in one array, where each text's begin and end in it, and whether its bytes are right. Empty texts aren't allowed."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, bool)
        split = pc.split_pattern(texts.cast(pa.large_string()), " ")
        starts = np.asarray(split.offsets, np.int64)
        starts, flat = starts - starts[0], split.flatten()
        coded = flat.dictionary_encode()
        index, distinct = np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()
        whole = np.zeros(len(texts), bool)
        empty = np.array([not c for c in distinct], bool)
        if not self.cuts:
            whole[:] = True
        elif empty.any():
            whole[np.searchsorted(starts, np.flatnonzero(empty[index]), side="right") - 1] = True
        part = ~np.repeat(whole, np.diff(starts))
        used = np.zeros(len(distinct), bool)
        used[index[part]] = True
        if len(self.known) > self.remembered:
            self.known.clear()
        absent = [k for k in np.flatnonzero(used).tolist() if distinct[k] not in self.known]
        new = dict(zip([distinct[k] for k in absent], self.found([distinct[k] for k in absent])))
        pool = [(new[c] if c in new else self.known[c]) if u else b"" for c, u in zip(distinct, used.tolist())]
        self.known |= {c: ids for c, ids in new.items() if len(c) <= CHUNK}
        alone = np.flatnonzero(whole)
        pool += [*self.found([texts[k].as_py() for k in alone.tolist()]), b""]
        index[~part] = len(pool) - 1
        index[starts[:-1][alone]] = len(distinct) + np.arange(len(alone))
        bad = np.array([ids is None for ids in pool], bool)
        right = np.ones(len(texts), bool)
        if bad.any():
            right[np.searchsorted(starts, np.flatnonzero(bad[index]), side="right") - 1] = False
            pool = [ids or b"" for ids in pool]
        lengths = np.array([len(ids) >> 2 for ids in pool], np.int64)
        begins, each = np.cumsum(lengths) - lengths, lengths[index]
        ends = np.cumsum(each)
        at = np.repeat(begins[index] - ends + each, each) + np.arange(int(ends[-1]))
        return np.frombuffer(b"".join(pool), "<u4")[at], np.concatenate([[0], ends])[starts], right


@functools.lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One a process, by the place of its model, which every executor has."""
    return PieceEncoder(path)


@functools.lru_cache(maxsize=2)
def lengths_of(path_a: str, path_b: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each token of both sides."""
    a, b = encoder(path_a, pattern).bytes_of, piece_encoder(path_b).bytes_of
    out = np.zeros(max(a) + 1, np.int64)
    out[list(a)] = [len(x) for x in a.values()]
    return out, np.array([len(x) for x in b], np.int64)


def written_as(*lengths: np.ndarray) -> np.dtype:
    """The type in which events write the ids of vocabularies of these sizes."""
    return NARROW if max(map(len, lengths)) <= 1 << 16 else WIDE


def end_events(df: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__row, id, side, start, ids): rows of up to EVENTS token ends of side 0 (A) or 1 (B), with the offset where the first token
    begins in a space and the text. A text without tokens is one row without ends."""
    names = ["__row", id_col, "side", "start", "ids"]

    def side_of(side: int, batch: pa.RecordBatch, ids: np.ndarray, ends: np.ndarray, length: np.ndarray, kind: np.dtype) -> pa.RecordBatch:
        n = np.diff(ends)
        blocks = np.maximum(-(-n // EVENTS), 1 - side)  # side 0 has a row for every text
        of = np.repeat(np.arange(len(n)), blocks)
        number = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        first = ends[:-1][of] + number * EVENTS
        size = np.minimum(EVENTS, ends[1:][of] - first)
        bytes_before = np.concatenate([[0], np.cumsum(length[ids])])
        offsets = np.concatenate([[0], np.cumsum(kind.itemsize * size)])  # blocks follow each other as the ids do
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(of), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.astype(kind))])
        take = pa.array(of, pa.int64())
        start = bytes_before[first] - bytes_before[ends[:-1][of]]
        return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(len(of), side, np.int8)), pa.array(start), packed.cast(pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = encoder(path_a, pattern), piece_encoder(path_b)
        a.remembered = REMEMBERED
        of_a, of_b = lengths_of(path_a, path_b, pattern)
        kind = written_as(of_a, of_b)
        for whole in batches:
            for batch in slices(whole):
                text = batch.column(2)
                full = np.asarray(pc.greater(pc.binary_length(text), 0))
                some = text.filter(pa.array(full))
                ids_b, ends_b, right = b.encode_texts(some)
                ids_a, ends_a = a.encode_texts(pc.binary_join_element_wise(pa.scalar(" "), some, pa.scalar("")))
                for side, ids, ends, length in ((0, ids_a, ends_a, of_a), (1, ids_b, ends_b, of_b)):
                    n = np.zeros(len(full), np.int64)
                    n[full] = np.diff(ends) * right
                    if not right.all():
                        ids = ids[np.repeat(right, np.diff(ends))]
                    yield side_of(side, batch, ids, np.concatenate([[0], np.cumsum(n)]), length, kind)

    kind = df.schema[id_col].dataType.simpleString()
    numbered = df.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col), text_of(text_col).alias("__text"))
    return numbered.mapInArrow(run, f"__row long, `{id_col}` {kind}, side byte, start long, ids binary")


@dataclass
class Open:
    """What the machine keeps of the document it is in: counts and digest of the groups that are gone, and the ends that follow."""

    row: int
    id: object
    a: list[np.ndarray] = field(default_factory=list)
    b: list[np.ndarray] = field(default_factory=list)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))
    digest: object = None

    def held(self) -> int:
        return min(sum(map(len, self.a)), sum(map(len, self.b)))


def digits(n: int, separators: str) -> list[np.ndarray]:
    """For each separator a matrix of the decimal digits of 0 … n - 1, NUL up to the widest, and the separator."""
    table = np.frombuffer(np.arange(n).astype(f"S{len(str(n - 1))}").tobytes(), np.uint8).reshape(n, -1)
    return [np.concatenate([table, np.full((n, 1), ord(s), np.uint8)], axis=1) for s in separators]


@functools.lru_cache(maxsize=1)
def written_ids(n: int) -> list[np.ndarray]:
    return digits(n, ",|;")


class Sweep:
    """Groups and links of many documents at once, laid end to end: at the end of a document both sides end."""

    def __init__(self, of_a: np.ndarray, of_b: np.ndarray):
        self.of_a, self.of_b = of_a, of_b
        self.written = written_ids(max(len(of_a), len(of_b)))

    def __call__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Groups and links of each document, its groups as text (each with ; after it), and (document, pair, count) by document and
        pair. A document's ids follow each other in a and b, n_a and n_b of them."""
        docs = len(n_a)
        end_a, end_b = np.cumsum(self.of_a[a]), np.cumsum(self.of_b[b])
        in_b, in_a = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)  # the token of the other side that covers the last byte
        both_a, both_b = end_b[in_b] == end_a, end_a[in_a] == end_b
        doc_a, doc_b = np.repeat(np.arange(docs), n_a), np.repeat(np.arange(docs), n_b)
        groups = np.bincount(doc_a[both_a], minlength=docs)
        links = n_a + n_b - groups
        # where groups are written: A's ids of a group come before B's
        group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        upto_a, before_b = np.flatnonzero(both_a) + 1, np.concatenate([[0], np.flatnonzero(both_b) + 1])
        shape = (len(a) + len(b), self.written[0].shape[1])
        text = np.empty(shape, np.uint8)
        for ids, last, place, end in ((a, both_a, np.arange(len(a)) + before_b[group_a], 1), (b, both_b, np.arange(len(b)) + upto_a[group_b], 2)):
            text[place] = self.written[0][ids]
            text[place[last]] = self.written[end][ids[last]]
        bytes_of = np.concatenate([[0], np.cumsum(np.count_nonzero(text, axis=1))])[np.concatenate([[0], np.cumsum(n_a + n_b)])]
        flat = text.ravel()
        flat = flat[flat != 0].tobytes()
        texts = [flat[x:y] for x, y in zip(bytes_of.tolist(), bytes_of[1:].tolist())]
        # one link for every end of either side
        only_b = ~both_b
        pair = np.concatenate([a.astype(np.int64) * len(self.of_b) + b[in_b], a[in_a[only_b]].astype(np.int64) * len(self.of_b) + b[only_b]])
        doc = np.concatenate([doc_a, doc_b[only_b]])
        wide = len(self.of_a) * len(self.of_b)
        keys, counts = np.unique(doc * wide + pair, return_counts=True)
        return groups, links, keys // wide, texts, keys % wide, counts

    def closed(self, doc: Open) -> tuple[np.ndarray, np.ndarray]:
        """Takes from a document the ends up to the last that both sides have reached."""
        a, b = np.concatenate(doc.a), np.concatenate(doc.b)
        end_a, end_b = np.cumsum(self.of_a[a]), np.cumsum(self.of_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        last = common[-1] if len(common) else 0
        cut_a, cut_b = np.searchsorted(end_a, last, "right"), np.searchsorted(end_b, last, "right")
        doc.a, doc.b = [a[cut_a:]], [b[cut_b:]]
        return a[:cut_a], b[:cut_b]


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def swept(events: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", with_groups: bool = False, held: int = HELD) -> DataFrame:
    """(__row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, counts[, groups]): the documents of `events`.

    A long document comes as several rows: their numbers add up, their pairs (A id times the size of B's vocabulary plus B id) and
    groups follow each other, and only the last has a digest. with_groups adds the groups themselves as text, each with a
    semicolon after it. The machine keeps `held` ends of each side of one document and its open group, which has no bound of its own.
    """
    names = ["__row", id_col, *NUMBERS, "groups_sha256", "pairs", "counts", *["groups"] * with_groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_a, of_b = lengths_of(path_a, path_b, pattern)
        sweep, kind = Sweep(of_a, of_b), written_as(of_a, of_b)
        current: Open | None = None

        def rows(docs: list[Open], taken: list[tuple[np.ndarray, np.ndarray]], last: bool) -> pa.RecordBatch:
            """A row for each document with the ends that are taken from it; the last is its final one, or not."""
            n_a, n_b = (np.array([len(t[side]) for t in taken], np.int64) for side in (0, 1))
            a, b = (np.concatenate([t[side] for t in taken]) for side in (0, 1))
            groups, links, of, texts, pairs, counts = sweep(a, b, n_a, n_b) if len(a) else (0 * n_a, 0 * n_a, a, [b""] * len(docs), a, a)
            digests = []
            for k, (doc, text) in enumerate(zip(docs, texts)):
                final = last or k + 1 < len(docs)
                if final and doc.digest is None:
                    digests.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
                    continue
                doc.digest = doc.digest or hashlib.sha256()
                doc.digest.update(text[:-1] if final else text)
                digests.append(doc.digest.hexdigest() if final else None)
            offsets = pa.array(np.searchsorted(of, np.arange(len(docs) + 1)).astype(np.int32))
            columns = [pa.array([d.row for d in docs], pa.int64()), pa.array([d.id for d in docs], kinds[1]), *(pa.array(x, pa.int64()) for x in (n_a, n_b, groups, links)), pa.array(digests, pa.string())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((pairs, pa.int64()), (counts, pa.int32()))]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array([t.decode() for t in texts], pa.string())] * with_groups], names)

        kinds = None
        for whole in batches:
            kinds = [f.type for f in whole.schema]
            for batch in slices(whole):
                ids = np.frombuffer(b"".join(batch.column(4).to_pylist()), kind).astype(np.uint32)
                ends = np.cumsum(np.asarray(pc.binary_length(batch.column(4)), np.int64)) // kind.itemsize
                row, side = np.asarray(batch.column(0)), np.asarray(batch.column(2))
                docs: list[Open] = []
                names_of = batch.column(1).to_pylist()
                for k, (r, s, x, y) in enumerate(zip(row.tolist(), side.tolist(), [0, *ends.tolist()], ends.tolist())):
                    if current is None or current.row != r:
                        docs += [current] * (current is not None)
                        current = Open(r, names_of[k])
                    (current.b if s else current.a).append(ids[x:y])
                if docs:
                    yield rows(docs, [(np.concatenate([ids[:0], *d.a]), np.concatenate([ids[:0], *d.b])) for d in docs], True)
                if current is not None and current.held() > held:
                    yield rows([current], [sweep.closed(current)], False)
        if current is not None:
            yield rows([current], [(np.concatenate(current.a), np.concatenate([np.zeros(0, np.uint32), *current.b]))], True)

    kind = events.schema[id_col].dataType.simpleString()
    schema = f"__row long, `{id_col}` {kind}, " + ", ".join(f"{n} long" for n in NUMBERS) + ", groups_sha256 string, pairs array<long>, counts array<int>" + ", groups string" * with_groups
    return events.repartition("__row").sortWithinPartitions("__row", "start", "side").mapInArrow(run, schema)


def summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(pairs, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64)  # doubles are exact up to 2 ** 53


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, n): how many links of all documents hold each pair. Tasks add up what they have of it before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = [], [], 0
        for batch in batches:
            keys.append(np.asarray(batch.column(0).flatten()))
            counts.append(np.asarray(batch.column(1).flatten(), np.int64))
            waiting += len(keys[-1])
            if waiting > FLUSHED:
                k, c = summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts, waiting = [k], [c], len(k)
                if waiting > FLUSHED // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(c, pa.int64())], ["pair", "n"])
                    keys, counts, waiting = [], [], 0
        if waiting:
            k, c = summed(np.concatenate(keys), np.concatenate(counts))
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(c, pa.int64())], ["pair", "n"])

    return documents.select("pairs", "counts").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def aligned(
    df: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False, held: int = HELD, hot: int = HOT
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) of every whole text.

    n_best counts a document's links whose pair is as frequent in the corpus as any pair of its B id, count_sum adds up the
    frequencies of its links. groups (with_groups) holds the groups' ids as `a1,a2|b1;a3|b2,b3`. Null and empty texts, and those
    whose tokens' bytes aren't a space and the text (such as texts with the space mark itself), have no tokens: zeros and ''. Null ids
    and repeated rows stay, each row by itself; an empty table gives an empty result; other columns are not read.

    The documents' counts are written once to the shared folder. Only the at most `hot` most frequent pairs come to the driver, and
    the largest count of each B id is broadcast, as many numbers as B has tokens.
    """
    spark = df.sparkSession
    width = len(piece_encoder(path_b).bytes_of)
    documents = stored(swept(end_events(df, path_a, path_b, pattern, id_col, text_col), path_a, path_b, pattern, id_col, with_groups, held), "aligned")
    pairs = stored(pair_counts(documents), "pairs").withColumn("b", F.col("pair") % width)
    best = pairs.groupBy("b").agg(F.max("n").alias("most"))
    pairs = pairs.join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    total, kinds = pairs.agg(F.sum("n"), F.count("*")).first()
    often = pairs.where(F.col("n") > (total or 0) / hot).toArrow().sort_by("pair")
    broadcast = spark.sparkContext.broadcast(tuple(np.asarray(often.column(c)) for c in ("pair", "n", "best")))

    def found(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair of the batch: its row in it, itself, its count, its place among the frequent ones and whether it is one."""
        known, n, top = broadcast.value
        lists = batch.column("pairs")
        of = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(lists), np.int64))
        pair, count = np.asarray(lists.flatten()), np.asarray(batch.column("counts").flatten(), np.int64)
        at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
        is_hot = known[at] == pair if len(known) else np.zeros(len(pair), bool)
        return of, pair, count, at, is_hot, (n, top)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                of, _, count, at, is_hot, (n, top) = found(batch)
                of, count, at = of[is_hot], count[is_hot], at[is_hot]
                sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
                np.add.at(sums[0], of, count * top[at])
                np.add.at(sums[1], of, count * n[at])
                kept = [c for c in batch.schema.names if c not in ("pairs", "counts")]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, sums)], [*kept, "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                of, pair, count, _, is_hot, _ = found(batch)
                row = np.asarray(batch.column("__row"))[of[~is_hot]]
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(pair[~is_hot]), pa.array(count[~is_hot])], ["__row", "pair", "times"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name not in ("pairs", "counts"))
    parts = documents.mapInArrow(frequent, f"{schema}, n_best long, count_sum long")
    if kinds > often.num_rows:
        cold = documents.select("__row", "pairs", "counts").mapInArrow(rare, "__row long, pair long, times long").join(pairs.where(F.col("n") <= total / hot), "pair")
        cold = cold.select("__row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
        parts = parts.unionByName(cold.groupBy("__row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), allowMissingColumns=True)
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (*NUMBERS, "n_best", "count_sum")]
    groups = [F.rtrim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__at", "groups"))), lambda g: g["groups"]), ""), F.lit(";")).alias("groups")] * with_groups
    if with_groups:
        parts = parts.withColumn("__at", F.monotonically_increasing_id())
    whole = parts.groupBy("__row").agg(F.max(id_col).alias(id_col), *sums, F.max("groups_sha256").alias("groups_sha256"), *groups)
    return whole.drop("__row")

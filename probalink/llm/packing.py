"""Best-fit packing of documents into sequences of bounded length (operator 4).

Best-fit decreasing places the pieces longest first, each into the open sequence with the least room that still takes it. What that
does depends on the lengths alone, so the driver plans it over the histogram of lengths (as many counts as a sequence has tokens,
however many documents there are): a segment tree over remaining capacities says which capacity has open sequences and finds the
tightest one that fits in logarithmic time, and equal pieces that go to equal sequences are placed as one run. The plan has a run for
each such step; a piece finds its run, and so its sequence and place, by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probalink.llm.bpe import encoder
from probalink.llm.common import slices, stored, text_of

#: Counts of the pieces of one length in one written partition that are broadcast at most; more are joined by a shuffle.
SENT = 1 << 20


class Capacities:
    """Segment tree over remaining capacities: which of them have open sequences."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.open = [False] * (2 * self.size)

    def put(self, capacity: int, is_open: bool) -> None:
        node = self.size + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, length: int) -> int:
        """The smallest capacity of at least length that has open sequences, or -1."""
        node = self.size + length
        if self.open[node]:
            return length
        while node > 1:
            if not node % 2 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return -1


@dataclass(frozen=True)
class Run:
    """Pieces rank to rank + count - 1 of a length: `each` of them in every sequence from `sequence` on, from `offset` on."""

    length: int
    rank: int
    count: int
    each: int
    sequence: int
    offset: int


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Where best-fit decreasing puts histogram[length] pieces of every length."""
    runs: list[Run] = []
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining capacity: (first sequence, how many)
    tree = Capacities(capacity)
    sequences = 0

    def leave(first: int, many: int, room: int) -> None:
        if many and room:
            if not groups[room]:
                tree.put(room, True)
            groups[room].append((first, many))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room < 0:
                room, first, many = capacity, sequences, -(-left // (capacity // length))
                sequences += many
            else:
                first, many = groups[room].pop()
                if not groups[room]:
                    tree.put(room, False)
            each = room // length
            full = min(many, left // each)
            if full:
                runs.append(Run(length, rank, full * each, each, first, capacity - room))
                leave(first, full, room - each * length)
                rank, left = rank + full * each, left - full * each
            if full < many and left:  # fewer than a sequence takes: the last of this length
                runs.append(Run(length, rank, left, left, first + full, capacity - room))
                leave(first + full, 1, room - left * length)
                full, left = full + 1, 0
            leave(first + full, many - full, room)
    return runs


def pieces(df: DataFrame, path: str, pattern: str, capacity: int, end_id: int, keep_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """The pieces of every document's ids (then end_id): of `capacity` tokens, the first shorter where they don't come out even. __rank
    counts the pieces of the same length that the task has made before."""
    names = [id_col, "piece", "start", "length", "ids_crc32", "__rank", *["token_ids"] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end, made = encoder(path, pattern), np.array([end_id], "<u4").tobytes(), Counter()
        for whole in batches:
            for batch in slices(whole):
                ids, ends = own.encode_batch(batch.column(1))
                buffer, ends = ids.tobytes(), (4 * ends).tolist()
                of, number, start, length, crc, rank, kept = [], [], [], [], [], [], []
                for k, (a, b) in enumerate(zip(ends, ends[1:])):
                    document = buffer[a:b] + end
                    n = len(document) // 4
                    at, size = 0, n % capacity or capacity
                    for j in range(-(-n // capacity)):
                        data = document[4 * at : 4 * (at + size)]
                        of.append(k)
                        number.append(j)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(data))
                        rank.append(made[size])
                        made[size] += 1
                        if keep_ids:
                            kept.append(np.frombuffer(data, np.int32))
                        at, size = at + size, capacity
                columns = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, rank))]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, __rank long" + ", token_ids array<int>" * keep_ids
    return df.select(F.col(id_col), text_of(text_col).alias("__text")).mapInArrow(run, schema)


def placing(runs: list[Run]) -> Column:
    """(sequence_id, offset) of a piece by its length and its rank among all of that length."""
    of: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    for r in runs:
        of[r.length].append((r.rank, r.each, r.sequence, r.offset))
    by_length = {n: np.array(own, np.int64).T for n, own in of.items()}

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        length, rank = np.asarray(lengths), np.asarray(ranks)
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length).tolist():
            own = np.flatnonzero(length == size)
            start, each, first, begin = by_length[size]
            run = np.searchsorted(start, rank[own], side="right") - 1
            k = rank[own] - start[run]
            sequence[own] = first[run] + k // each[run]
            offset[own] = begin[run] + k % each[run] * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    return place("length", F.col("__before") + F.col("__rank"))


def packed(
    df: DataFrame, path: str, pattern: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, token_ids], sequence_id, offset): all documents in as few sequences as best fit makes.

    A null or empty text is its end id alone. Rows that repeat, or lack an id, are documents of their own. An empty table gives an
    empty result. Other columns are not read. The pieces are written once to the shared folder, each with its rank among those of its
    length in its partition; what partitions before hold of a length, at most `capacity` counts a partition, makes these ranks those
    among all pieces. So no piece is shuffled: the counts are broadcast, up to SENT of them, and only beyond joined by a shuffle.
    Pieces are placed by a plan whose size is bounded by `capacity` and not by the data. What comes to the driver are the counts of lengths.
    """
    cut = stored(pieces(df, path, pattern, capacity, end_id, keep_ids, id_col, text_col).withColumn("__part", F.spark_partition_id()), "pieces")
    counts = stored(cut.groupBy("__part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    key = (F.col("__part").cast("long") * (capacity + 1) + F.col("length")).alias("__key")
    before = counts.select(key, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    few = counts.count() <= SENT
    ranked = cut.withColumn("__key", key).join(F.broadcast(before) if few else before, "__key")
    placed = ranked.withColumn("__place", placing(best_fit_decreasing(histogram, capacity)))
    return placed.select(*[c for c in cut.columns if not c.startswith("__")], "__place.sequence_id", "__place.offset")

"""Passages that repeat across documents inside longer paragraphs (operator 6).

A text's words are covered by windows of `size` words. Which windows count depends on their words alone: of any `apart` neighbouring
windows the one of the smallest hash does. Two documents that share a passage of least = size + apart - 1 words therefore choose an
equal window in it, wherever it stands and whatever surrounds it. A window has a context, WIDTH bytes for each of the apart - 1 words
before and after it. A shared passage of `least` words is an equal window with apart - 1 neighbouring words of equal bytes (two
different words have the same bytes once in 65,535), and it reaches as far as the bytes of the two contexts are equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from probalink.llm.common import scratch, slices, stored, text_of
from probalink.llm.components import hot_keys, joined, parted

#: An odd multiplier of the words' hashes in a window's.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a context's word; those of words beyond the text are 0.
WIDTH = 2
NONE = bytes(WIDTH)
EDGES = " \t\n\x0b\f\r"
#: Contexts of a window up to which one task looks for those that share a part; the parts of more are dealt out as rows.
TOGETHER = 4096


def window_size(least: int) -> tuple[int, int]:
    """(size, apart) by which every shared passage of `least` words has an equal window."""
    size = max(1, 2 * least // 3 + 1)
    return size, max(1, least - size + 1)


def leftmost_minima(hashes: np.ndarray, apart: int) -> np.ndarray:
    """For each place from which there are `apart` neighbours, the place of the smallest (leftmost, if tied) of them."""
    least, place, width = hashes, np.arange(len(hashes)), 1
    if len(hashes) < apart:
        return place[:0]
    while width < apart:  # the smallest of two overlapping stretches of `width` is that of both
        step = min(width, apart - width)
        place = np.where(least[step:] < least[:-step], place[step:], place[:-step])
        least = np.minimum(least[step:], least[:-step])
        width += step
    return place


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of `size` words, of their hashes h: the sum of h * FACTOR ** (words that follow), from sums of half as many."""
    total, width = hashes, 1
    for bit in bin(size)[3:]:
        total = total[:-width] * np.uint64(pow(int(FACTOR), width, 1 << 64)) + total[width:]
        width *= 2
        if bit == "1":
            total = total[:-1] * FACTOR + hashes[width:]
            width += 1
    return (total ^ total >> np.uint64(31)) * FACTOR


def word_hashes(texts: Iterable[list[bytes]], count: int) -> np.ndarray:
    """The hashes of all `count` words of texts."""
    return np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(texts)), np.uint64, count)


def windows_of(texts: list[str], size: int, apart: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The chosen windows of texts, many at once: which texts have any, where each text's begin among all (and the end), their hashes
    and first words, and for each text WIDTH bytes for each of its words between apart - 1 empty ones on both sides."""
    words = [t.encode().lower().split() for t in texts]
    own = [k for k, w in enumerate(words) if len(w) >= size + apart - 1]
    if not own:
        return [], np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []
    first = np.cumsum([0, *(len(words[k]) for k in own)])
    hashes = word_hashes((words[k] for k in own), first[-1])
    total = run_hashes(hashes, size)
    place = leftmost_minima(total, apart)
    groups = np.diff(first) - (size + apart - 2)  # windows whose neighbours all lie in the same text
    inside = np.arange(groups.sum()) + np.repeat(first[:-1] - np.cumsum(groups) + groups, groups)
    at = np.unique(place[inside])
    ends = np.searchsorted(at, first)
    pad = NONE * (apart - 1)
    letters_of = (hashes % np.uint64(65535) + np.uint64(1)).astype("<u2")
    around = [pad + letters_of[i:j].tobytes() + pad for i, j in zip(first, first[1:])]
    return own, ends, total[at].view(np.int64), at - np.repeat(first[:-1], np.diff(ends)), around


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each of a text's words begins and ends, in code points."""
    letters = np.frombuffer(text.encode(), np.uint8)
    inside = ~((letters == 32) | ((letters >= 9) & (letters <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    points = np.concatenate(([0], np.cumsum((letters & 0xC0) != 0x80)))
    return points[edges[::2]], points[edges[1::2]]


def windows(df: DataFrame, least: int, id_col: str, text_col: str) -> DataFrame:
    """(id, __key, windows, words, around): the chosen windows of every document of `least` words or more."""
    names = [id_col, "__key", "windows", "words", "around"]
    types = [pa.int64(), pa.int32()]
    size, apart = window_size(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                own, ends, *found, around = windows_of(batch.column(2).to_pylist(), size, apart)
                if own:
                    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, t)) for values, t in zip(found, types)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)), *lists, pa.array(around)], names)

    kind = df.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    schema = f"`{id_col}` {kind}, __key long, windows array<long>, words array<int>, around binary"
    return df.select(F.col(id_col), F.xxhash64(text).alias("__key"), text.alias("__text")).mapInArrow(run, schema)


def nearest(others: DataFrame, side: int) -> DataFrame:
    """(window, context, __nearer): for each context that isn't same, the smallest `first` of those of its window that share `side`
    bytes of it at the same place, itself included. No window of others (window, context, first, same) has more than TOGETHER."""

    def part(rows: pa.RecordBatch) -> pa.RecordBatch:  # whole windows, the contexts of each in the order of their first
        own, near, last, seen = [], [], None, []
        for row, (window, context, same) in enumerate(zip(*(rows.column(k).to_pylist() for k in (0, 1, 3)))):
            if window != last:
                last, seen = window, [{} for _ in range(0, side + 1, WIDTH)]
            at = row
            for k, parts in enumerate(seen):
                found = context[k * WIDTH : k * WIDTH + side]
                if found[:WIDTH] != NONE and found[-WIDTH:] != NONE:
                    at = min(at, parts.setdefault(found, row))
            if not same:
                own.append(row)
                near.append(at)
        own, near = pa.array(own, pa.int64()), pa.array(near, pa.int64())
        return pa.RecordBatch.from_arrays([rows.column(0).take(own), rows.column(1).take(own), rows.column(2).take(near)], ["window", "context", "__nearer"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # of the window that may go on
        for batch in batches:
            if batch.num_rows:
                windows = batch.column(0).to_numpy()
                start = int(np.searchsorted(windows, windows[-1]))
                if rest and (start or rest[0].column(0)[0].as_py() != windows[0]):
                    yield part(whole([*rest, batch.slice(0, start)]))
                    rest = []
                elif start:
                    yield part(batch.slice(0, start))
                rest.append(batch.slice(start))
        if rest:
            yield part(whole(rest))

    def whole(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]

    rows = others.select("window", "context", "first", "same").repartition("window").sortWithinPartitions("window", "first")
    return rows.mapInArrow(run, others.select("window", "context", F.col("first").alias("__nearer")).schema)


def places(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __of, __word, __start, __end): where the wanted (__id, __of, __word) begin and end in their texts, in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                of, found = [], []
                for k, (text, words) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                    starts, ends = word_places(text)
                    of += [k] * len(words)
                    found.append(np.array([words, starts[words], ends[words]]))
                columns = [batch.column(c).take(pa.array(of, pa.int32())) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.int32()) for c in np.concatenate(found, axis=1))], ["__id", "__of", "__word", "__start", "__end"])

    text = text_of(text_col)
    texts = df.select(F.col(id_col).alias("__doc"), F.xxhash64(text).alias("__hash"), text.alias("__text"))
    lists = wanted.groupBy("__id", "__of").agg(F.collect_set("__word").alias("__words"))
    rows = texts.join(lists, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__of"))).select("__id", "__of", "__text", "__words")
    return rows.mapInArrow(run, f"__id {df.schema[id_col].dataType.simpleString()}, __of long, __word int, __start int, __end int").distinct()


def shared_passages(df: DataFrame, least: int, id_col: str, text_col: str) -> DataFrame:
    """(id, line, start, end, n_words, kept_id, kept_start, class, __key) of the stretches of every document whose windows lie in
    passages of `least` words that an earlier one has too (of a smaller id; null ids come last). line is null; kept_id and kept_start
    are the earliest place of its first passage. A passage reaches as far as its kept occurrence has the same words.

    A window's contexts are compared with that of its earliest place; those that this leaves unmatched are compared with all others of
    the window, by each of their parts of apart - 1 words: by one task, up to TOGETHER contexts of a window, and else as rows.

    Windows are counted by their hashes alone; places and contexts follow only of those that two rows share. Equal windows of equal
    contexts are one row before contexts are compared. Rows of hot windows meet what is known about their window without a shuffle.
    """
    size, apart = window_size(least)
    with scratch(df.sparkSession, "passages") as keep:
        texts = keep(windows(df, least, id_col, text_col), "texts")
        each = texts.select(id_col, "__key", F.posexplode("windows").alias("__at", "window"))
        several = each.groupBy("window").agg(F.count("*").alias("__n")).where("__n > 1").select("window")
        hits = keep(joined(each, several, ["window"], hot_keys(each, "window"), "left_semi", grown=True).select(F.col(id_col).alias("__id"), F.col("__key").alias("__of"), "__at"), "hits")
        lists = hits.groupBy("__id", "__of").agg(F.collect_set("__at").alias("__ats"))
        own = texts.join(lists, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__of"))).withColumn("__at", F.explode("__ats"))
        value = lambda name: F.get(F.col(name), F.col("__at"))
        word = value("words")
        side = F.lit(WIDTH * (apart - 1))
        context = F.concat(F.substring("around", word * WIDTH + 1, side), F.substring("around", (word + size + apart - 1) * WIDTH + 1, side))
        place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("__key").alias("key"))
        rows = own.select(id_col, "__key", word.alias("word"), value("windows").alias("window"), context.alias("context"))
        rows = keep(rows, "rows").withColumn("place", place)
        keep.drop("texts", "hits")
        contexts = rows.groupBy("window", "context").agg(F.min(F.struct("place", "word")).alias("__f"), F.max("place").alias("last"))
        contexts = keep(contexts.select("window", "context", F.struct("__f.place", "__f.word", "context").alias("first"), "last"), "contexts")
        earliest = contexts.groupBy("window").agg(F.min("first").alias("__e"))
        bytes_of = lambda name, k, n: F.substring(F.col(name), k * WIDTH + 1, n * WIDTH)
        is_word = lambda k: bytes_of("context", k, 1) != F.lit(NONE)
        same = F.lit(False)
        for k in range(apart):  # a passage may begin k words into the context
            same = same | ((bytes_of("context", k, apart - 1) == bytes_of("__e.context", k, apart - 1)) & is_word(k) & is_word(k + apart - 2))
        common = hot_keys(contexts, "window")
        compared = keep(joined(contexts, earliest, ["window"], common).withColumn("same", same), "compared")
        keep.drop("contexts")
        # what the earliest place leaves unmatched is compared with all other contexts of its window, whether those matched or not
        others = compared.where(F.col("context") != F.col("__e.context"))
        still = others.groupBy("window").agg(F.count("*").alias("__n"), F.bool_or(~F.col("same")).alias("__any")).where("__n > 1 AND __any")
        others = keep(joined(others, still.select("window", "__n"), ["window"], common).select("window", "context", "first", "same", "__n"), "others")
        nearer = nearest(others.where(F.col("__n") <= TOGETHER), WIDTH * (apart - 1))
        large = others.where(F.col("__n") > TOGETHER).drop("__n")
        if not large.isEmpty():
            grams = large.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(apart - 1))))
            grams = grams.withColumn("__part", F.substring(F.col("context"), F.col("__at") * WIDTH + 1, side))
            grams = grams.where((F.substring("__part", 1, WIDTH) != F.lit(NONE)) & (F.substring("__part", -WIDTH, WIDTH) != F.lit(NONE)))
            parts = grams.groupBy("window", "__at", "__part").agg(F.min("first").alias("keep"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
            part = ["window", "__at", "__part"]
            wide = hot_keys(large, "window")  # a hot part is one of a hot window, as all windows have about as many parts a context
            frequent = hot_keys(parted(grams, ["window"], wide)[1], *part) if wide else []
            shared = joined(grams.where("NOT same").select("context", *part), parts, part, frequent, grown=True)
            nearer = nearer.union(shared.groupBy("window", "context").agg(F.min("keep").alias("__nearer")))
        keeps = compared.join(nearer, ["window", "context"], "left")
        keeps = keeps.withColumn("keep", F.when(F.col("same"), F.col("__e")).otherwise(F.coalesce("__nearer", "first")))
        before = after = F.lit(0)  # the words beside the window that the kept occurrence has too
        for k in range(1, apart):
            before += ((bytes_of("context", apart - 1 - k, k) == bytes_of("keep.context", apart - 1 - k, k)) & is_word(apart - 1 - k)).cast("int")
            after += ((bytes_of("context", apart - 1, k) == bytes_of("keep.context", apart - 1, k)) & is_word(apart - 2 + k)).cast("int")
        keeps = keeps.where("keep.place != last").select("window", "context", "keep.place", "keep.word", before.alias("before"), after.alias("after"))
        keeps = keep(keeps.select("window", "context", F.struct("place", "word").alias("keep"), "before", "after"), "keeps")
        keep.drop("compared", "others")
        later = joined(rows, keeps, ["window", "context"], hot_keys(rows, "window", "context")).where("place != keep.place")
        later = later.withColumn("from", F.col("word") - F.col("before")).withColumn("to", F.col("word") + size + F.col("after"))
        document = Window.partitionBy(id_col, "__key").orderBy("from", "to")
        reached = F.max("to").over(document.rowsBetween(Window.unboundedPreceding, -1))
        later = later.withColumn("__new", (reached.isNull() | (F.col("from") >= reached)).cast("int"))
        later = later.withColumn("__run", F.sum("__new").over(document.rowsBetween(Window.unboundedPreceding, 0)))
        origin = F.struct("from", F.col("keep.place").alias("place"), (F.col("keep.word") - F.col("before")).alias("word"), F.lower(F.lpad(F.hex("window"), 16, "0")).alias("class"))
        runs = later.groupBy(id_col, "__key", "__run").agg(F.min("from").alias("from"), F.max("to").alias("to"), F.min(origin).alias("__o"))
        runs = runs.select(id_col, "__key", "from", (F.col("to") - 1).alias("last"), F.col("__o.place.id").alias("kept_id"), F.col("__o.place.key").alias("__kept"), F.col("__o.word").alias("__first"), F.col("__o.class").alias("class"))
        runs = keep(runs, "spans")
        keep.drop("rows", "keeps")
        ends = ((id_col, "__key", "from", "__start", "start"), (id_col, "__key", "last", "__end", "end"), ("kept_id", "__kept", "__first", "__start", "kept_start"))
        wanted = [runs.select(F.col(i).alias("__id"), F.col(key).alias("__of"), F.col(w).alias("__word")) for i, key, w, _, _ in ends]
        found = keep(places(df, wanted[0].union(wanted[1]).union(wanted[2]).distinct(), id_col, text_col), "places")
        out = runs
        for i, key, w, edge, name in ends:
            own = found.select("__id", "__of", "__word", F.col(edge).alias(name))
            out = out.join(own, F.col(i).eqNullSafe(F.col("__id")) & (F.col(key) == F.col("__of")) & (F.col(w) == F.col("__word"))).drop("__id", "__of", "__word")
        n_words = (F.col("last") - F.col("from") + 1).cast("int").alias("n_words")
        return stored(out.select(id_col, F.lit(None).cast("int").alias("line"), "start", "end", n_words, "kept_id", "kept_start", "class", "__key"), "runs")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without spans that begin and end with words; of the white space at both sides one character goes with each."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    parts, at = [], 0
    for start, end in merged:
        if end == len(text) or (text[end] == "\n" and start and text[start - 1] == " "):
            start -= start > at and text[start - 1] in EDGES
        elif text[end] in EDGES and (not start or text[start - 1] in EDGES):
            end += 1
        parts.append(text[at:start])
        at = end
    return "".join([*parts, text[at:]])


@F.pandas_udf(StringType())
def without(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or a is None else cut(t, list(zip(a, b))) for t, a, b in zip(texts, starts, ends)], dtype=object)

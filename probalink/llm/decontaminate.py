"""Benchmark decontamination by suffix arrays of the training texts (operator 13).

The documents are taken in shards of SHARD bytes. A shard's words become numbers by the benchmark's vocabulary (0: not in it); a place can
begin a shared passage only within a run of such words as long as the shortest window, and the suffix array is built over these runs by
prefix doubling, sorted as far as a window goes. Every suffix of every benchmark item that begins a window is then searched in it, all
side by side, one word deeper at a time: the range that is left after a window's length holds the places of all its occurrences. Windows
that match at neighbouring places make the longest verbatim matches. Words are compared by 64-bit hashes until then; a match counts
when its bytes are equal.

The benchmark goes to the tasks in groups of about GROUP bytes, a pass over the documents each; no document is shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probalink.llm.common import fresh, slices, stored, text_of

#: Words of a window; bytes of documents in a shard, and of benchmark texts in a group.
WINDOW, SHARD, GROUP = 10, 1 << 22, 1 << 24
#: The odd factor of the words' hashes, modulo 2 ** 64.
FACTOR = 0x9E3779B97F4A7C15
#: Bytes by their lower-case form, and whether they belong to words: digits, letters, and all beyond ASCII.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@functools.lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR ** k and FACTOR ** -k modulo 2 ** 64, for k up to n."""
    out = []
    for factor in (FACTOR, pow(FACTOR, -1, 1 << 64)):
        table = np.full(n + 1, factor, np.uint64)
        table[0] = 1
        out.append(np.cumprod(table))
    return out[0], out[1]


@dataclass
class Words:
    """The words of texts laid end to end: their lower-case bytes, where each word begins and ends, its hash and its text's number."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray

    def bytes_of(self, first: int, n: int) -> list[bytes]:
        return [self.low[s:e].tobytes() for s, e in zip(self.start[first : first + n].tolist(), self.end[first : first + n].tolist())]


def words_of(data: np.ndarray, begins: np.ndarray) -> Words:
    """begins: where each text begins in data; a word never goes on into the next."""
    low = LOWER[data]
    inside = np.concatenate([IN_WORD[low], [False]])
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = begins[begins < len(low)]
    first[cuts] = inside[cuts]
    start = np.flatnonzero(first)
    # a word ends where its run does, or where the next text begins
    after = ~inside
    after[cuts] = True
    stops = np.flatnonzero(after)
    end = stops[np.searchsorted(stops, start, side="right")]
    up, down = powers(max(SHARD, 1 << max(len(low), 1).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low * up[: len(low)])])
    return Words(low, start, end, (sums[end] - sums[start]) * down[start], np.searchsorted(begins, start, side="right") - 1)


@dataclass
class Benchmark:
    """Items to search for. at: the words that begin a window, in `codes`, the places of all items' words in the vocabulary from 1 on,
    with a 0 after each item; size and item are those of each window."""

    names: list[str]
    words: list[bytes]
    vocabulary: np.ndarray
    codes: np.ndarray
    at: np.ndarray
    size: np.ndarray
    item: np.ndarray


def prepared(items: list[tuple[str, str]], window: int = WINDOW) -> Benchmark:
    raw = [t.encode() for _, t in items]
    begins = np.cumsum([0, *map(len, raw)])[:-1]
    found = words_of(np.frombuffer(b"".join(raw), np.uint8), np.array(begins, np.int64))
    vocabulary, code = np.unique(found.hash, return_inverse=True)
    count = np.bincount(found.text, minlength=len(items))
    place = np.arange(len(code)) + found.text  # one 0 after each item
    codes = np.zeros(len(code) + len(items) + window, np.int64)
    codes[place] = code + 1
    words: list[bytes] = [b""] * len(codes)
    for p, w in zip(place.tolist(), found.bytes_of(0, len(code))):
        words[p] = w
    number = np.arange(len(code)) - (np.cumsum(count) - count)[found.text]
    begin = number + np.minimum(count, window)[found.text] <= count[found.text]
    return Benchmark([n for n, _ in items], words, vocabulary, codes, place[begin], np.minimum(count, window)[found.text[begin]], found.text[begin])


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """The places of codes in the order of their next `depth` codes, by prefix doubling; 0 stands after the end."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    h = 1
    while h < depth and n:
        second = np.zeros(n, np.int64)
        second[: n - h] = rank[h:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        if rank[order[-1]] == n - 1:
            break
        h *= 2
    return order


def occurrences(codes: np.ndarray, order: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """(place in codes, window) of all occurrences of all windows, by binary search of every window's suffix in the suffix array."""
    text = np.concatenate([codes, np.zeros(int(bench.size.max()), np.int64)])
    heads = codes[order]
    head = bench.codes[bench.at]
    low, high = np.searchsorted(heads, head, "left"), np.searchsorted(heads, head, "right")
    live, done = np.arange(len(bench.at)), []
    depth = 1
    while len(live):
        some = low < high
        live, low, high = live[some], low[some], high[some]
        full = bench.size[live] == depth
        done.append((live[full], low[full], high[full]))
        live, low, high = live[~full], low[~full], high[~full]
        wanted = bench.codes[bench.at[live] + depth]
        bounds = []
        for right in (False, True):
            a, b = low.copy(), high.copy()
            while len(a) and (a < b).any():
                middle = (a + b) // 2
                here = text[order[np.minimum(middle, len(order) - 1)] + depth]
                more = (a < b) & ((here <= wanted) if right else (here < wanted))
                a, b = np.where(more, middle + 1, a), np.where(more | (a >= b), b, middle)
            bounds.append(a)
        low, high = bounds
        depth += 1
    live, low, high = (np.concatenate(x) for x in zip(*done))
    n = high - low
    at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    return order[at], np.repeat(live, n)


def matches(found: Words, bench: Benchmark) -> list[tuple[int, int, int, int, int]]:
    """(text, first word of all, item, first word of the item, words) of the longest verbatim matches, each of a window at least."""
    if not len(found.start) or not len(bench.at):
        return []
    at = np.minimum(np.searchsorted(bench.vocabulary, found.hash), len(bench.vocabulary) - 1)
    codes = np.where(bench.vocabulary[at] == found.hash, at + 1, 0)
    known = codes > 0
    begin = known.copy()
    begin[1:] &= ~known[:-1] | (found.text[1:] != found.text[:-1])
    runs = np.flatnonzero(begin)
    if not len(runs):
        return []
    number = np.cumsum(begin) - 1
    length = np.bincount(number[known], minlength=len(runs))
    kept = known & (length[np.maximum(number, 0)] >= bench.size.min())
    words = np.flatnonzero(kept)
    if not len(words):
        return []
    # runs are laid end to end, with a 0 between them
    place = np.arange(len(words)) + np.cumsum(begin[words]) - 1
    laid = np.zeros(int(place[-1]) + 2, np.int64)
    laid[place] = codes[words]
    word_at = np.zeros(len(laid), np.int64)
    word_at[place] = words
    where, window = occurrences(laid, suffix_array(laid, int(bench.size.max())), bench)
    if not len(where):
        return []
    start, item_start = word_at[where], bench.at[window]
    order = np.lexsort((start, start - item_start))
    start, item_start, size = start[order], item_start[order], bench.size[window][order]
    item, text = bench.item[window][order], found.text[start]
    same = (np.diff(start) == 1) & (np.diff(item_start) == 1) & (np.diff(item) == 0) & (np.diff(text) == 0)
    heads = np.concatenate([[0], np.flatnonzero(~same) + 1])
    windows = np.diff([*heads, len(start)])
    out = []
    for k, n in zip(heads.tolist(), windows.tolist()):
        s, i, w = int(start[k]), int(item_start[k]), int(size[k]) + n - 1
        if found.bytes_of(s, w) == bench.words[i : i + w]:
            out.append((int(text[k]), s, int(item[k]), i, w))
        else:  # words of equal hashes that differ: each window by itself
            w = int(size[k])
            out += [(int(text[k]), s + j, int(item[k]), i + j, w) for j in range(n) if found.bytes_of(s + j, w) == bench.words[i + j : i + j + w]]
    return out


def shards(data: np.ndarray, most: int, window: int) -> Iterator[tuple[int, Words]]:
    """A long text in shards that share window - 1 words: the number of the first word, and the words."""
    at = number = 0
    size = most
    while True:
        part = data[at : at + size]
        last = at + size >= len(data)
        if not last:
            gaps = np.flatnonzero(~IN_WORD[LOWER[part]])
            part = part[: gaps[-1]] if len(gaps) else part[:0]
        found = words_of(part, np.zeros(1, np.int64))
        if not last and len(found.start) < 2 * window:
            size *= 2
            continue
        yield number, found
        if last:
            return
        step = len(found.start) - window + 1
        number += step
        at += int(found.start[step])
        size = most


def searched(df: DataFrame, bench: Benchmark, window: int, kept: list[str], text_col: str, shard: int) -> DataFrame:
    """The columns `kept` of df, with n_words, and the spans of words and the items that each text shares with the benchmark."""
    broadcast = df.sparkSession.sparkContext.broadcast(bench)
    made = ["n_words", "starts", "ends", "items", "longest"]

    def long_text(data: np.ndarray) -> tuple[int, list[tuple[int, int, int, int, int]]]:
        total, found = 0, []
        for number, words in shards(data, shard, window):
            total = number + len(words.start)
            found += [(item, s + number - i, s + number, w) for _, s, item, i, w in matches(words, broadcast.value)]
        out: list[list[int]] = []
        for item, diagonal, s, w in sorted(found):  # shards overlap: matches that go on are one
            if out and out[-1][:2] == [item, diagonal] and s <= out[-1][2] + out[-1][3]:
                out[-1][3] = max(out[-1][3], s + w - out[-1][2])
            else:
                out.append([item, diagonal, s, w])
        return total, [(0, s, item, s - diagonal, w) for item, diagonal, s, w in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = broadcast.value
        for whole in batches:
            for batch in slices(whole, shard):
                column = batch.column(batch.num_columns - 1)
                offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
                data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
                begins = offsets[:-1] - offsets[0]
                if len(column) == 1 and len(data) > shard:
                    total, own = long_text(data)
                    n_words, firsts = np.array([total]), [0]
                else:
                    found = words_of(data, begins)
                    own = matches(found, bench)
                    n_words = np.bincount(found.text, minlength=len(column))
                    firsts = (np.cumsum(n_words) - n_words).tolist()
                spans: dict[int, list[tuple[int, int, str]]] = {}
                for text, s, item, _, w in own:
                    spans.setdefault(text, []).append((s - firsts[text], s - firsts[text] + w, bench.names[item]))
                starts, ends, items, longest = [[[] for _ in n_words] for _ in range(3)] + [[0] * len(n_words)]
                for text, parts in spans.items():
                    for s, e, _ in sorted(parts):
                        if ends[text] and s <= ends[text][-1]:
                            ends[text][-1] = max(e, ends[text][-1])
                        else:
                            starts[text].append(s)
                            ends[text].append(e)
                    items[text] = sorted({name for *_, name in parts})
                    longest[text] = max(e - s for s, e, _ in parts)
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (starts, ends)] + [pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n_words, pa.int64()), *lists, pa.array(longest, pa.int64())], [*kept, *made])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "n_words long, starts array<long>, ends array<long>, items array<string>, longest long"])
    return df.select(*kept, text_of(text_col).alias("__text")).mapInArrow(run, schema)


def groups(benchmark: DataFrame, window: int, most: int, id_col: str, text_col: str) -> tuple[int, Iterator[Benchmark]]:
    """How many groups of about `most` bytes the benchmark makes, and these, of which the driver holds one at a time."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), text_of(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // most) or 1
    own = (items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k) for k in range(n))
    return n, (prepared([(r["name"], r["text"]) for r in part.toLocalIterator()], window) for part in own)


def shared_spans(starts: Column, ends: Column) -> Column:
    """How many words lie in any of the spans."""
    spans = F.array_sort(F.arrays_zip(starts.alias("s"), ends.alias("e")))
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["to"]), F.lit(0))).alias("n"), F.greatest(acc["to"], x["e"]).alias("to"))
    return F.aggregate(spans, begin, step)["n"]


def contamination(
    df: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shard: int = SHARD, group: int = GROUP
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, longest, items, spans) of every whole text.

    A word is hit inside any occurrence of a benchmark window: `window` words in a row, or a whole item of fewer. spans are the runs of
    words in which occurrences lie, items the ids of the items that have one, longest the words of the longest verbatim match. Null and
    empty texts have no words, an item without words is none, an item without an id is one named ''. Null ids and repeated rows
    stay, each row by itself; an empty table gives an empty result, an empty benchmark no hits. Other columns are not read.

    A benchmark of one group takes one pass and no shuffle of texts. With more groups the texts are written once with a number for
    each row, and what the passes found is put together by it.
    """
    n, passes = groups(benchmark, window, group, item_col, item_text)
    row, text = fresh(df, "__row"), "__t"
    rows = df.select(F.monotonically_increasing_id().alias(row), F.col(id_col).alias("__id"), F.col(text_col).alias(text))
    if n > 1:
        rows = stored(rows, "texts")
    found = None
    for bench in passes:
        one = searched(rows, bench, window, [row, "__id"], text, shard)
        found = one if found is None else found.unionByName(one)
    if n > 1:
        joined = lambda c: F.flatten(F.collect_list(c)).alias(c)
        found = found.groupBy(row).agg(F.max("__id").alias("__id"), F.max("n_words").alias("n_words"), joined("starts"), joined("ends"), joined("items"), F.max("longest").alias("longest"))
    items = F.array_sort(F.array_distinct("items"))
    found = found.withColumns({"items": items, "n_hit": shared_spans(F.col("starts"), F.col("ends"))})
    return found.select(
        F.col("__id").alias(id_col),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest",
        "items",
        F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")).alias("spans"),
    )


def decontaminated(
    df: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shard: int = SHARD, group: int = GROUP
) -> DataFrame:
    """The rows of df, all columns, whose texts share no window with the benchmark. Nothing is shuffled; each group of the benchmark
    after the first works on what the one before it left, written."""
    for k, bench in enumerate(groups(benchmark, window, group, item_col, item_text)[1]):
        rest = stored(df, "clean") if k else df
        names = list(rest.columns)
        made = {c: f"__{k}" for k, c in enumerate(names)}  # columns may have the names that the search gives
        found = searched(rest.withColumnsRenamed(made), bench, window, list(made.values()), made[text_col], shard)
        df = found.where(F.size("items") == 0).select(*(F.col(made[c]).alias(c) for c in names))
    return df

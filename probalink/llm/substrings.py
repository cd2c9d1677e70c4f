"""Removal of passages that repeat across documents (operator 6).

A paragraph is a line of a text with `least` words or more, or a run of shorter lines that have as many together. Such a run is also cut
into pieces of `least` words or more at words that their neighbourhood alone chooses, so that runs which are alike in a part have equal
pieces there. Pieces are compared with pieces only, so that nothing is compared with what it is a part of. Equal paragraphs, and equal pieces (of the same lower-cased words), are one content, and
contents are compared by MinHash over their five-word shingles: BANDS bands of ROWS rows each, by which a pair of similarity 0.8 shares a
bucket with probability 0.9998. Contents that collide are verified by their exact Jaccard similarity, and the links' connected components
are the classes of which all but the first occurrence go. Passages inside paragraphs that differ otherwise are
none; `passages` finds them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probalink.llm.common import fresh, scratch, slices, stored, text_of
from probalink.llm.components import connected_components, hot_keys, joined
from probalink.llm.passages import FACTOR, leftmost_minima, run_hashes, shared_passages, without, word_hashes, word_places
from probalink.sources.storage import Scratch

SHINGLE = 5
BANDS, ROWS = 16, 4
#: Hashes of shingles that are mixed at once, so that they stay in a core's cache.
BLOCK = 1 << 15
#: Contents of a bucket, and bytes of their words, that are compared in one list; larger buckets are dealt into blocks of that size, and
#: every two blocks are a list, so that a content of a bucket of n goes to n / MOST lists.
MOST, MOST_BYTES = 512, 4_000_000


def multipliers(count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return random.integers(1, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 1 << 63, count, np.uint64)


def shingles(words: list[bytes], size: int = SHINGLE) -> list[bytes]:
    """The texts of all runs of `size` words (of all words, if there are fewer)."""
    joined = b" ".join(words)
    if len(words) <= size:
        return [joined]
    ends = list(accumulate(len(w) + 1 for w in words))
    return [joined[a : b - 1] for a, b in zip([0, *ends], ends[size - 1 :])]


def shingle_hashes(paragraphs: list[list[bytes]], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A hash, made from those of its words, of every run of `size` words of each paragraph, and where each paragraph's begin. One
    of fewer words is filled up with empty ones."""
    words = [w if len(w) >= size else [*w, *[b""] * (size - len(w))] for w in paragraphs]
    first = np.cumsum([0, *map(len, words)])
    own = run_hashes(word_hashes(words, first[-1]), size)
    many = np.diff(first) - size + 1
    starts = np.cumsum(many) - many
    inside = np.arange(many.sum()) + np.repeat(first[:-1] - starts, many)
    return own[inside], starts


def bands(paragraphs: list[list[bytes]], count: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key for each paragraph and band."""
    values, starts = shingle_hashes(paragraphs)
    a, b = multipliers(count * rows)
    mixed = np.empty((count * rows, len(paragraphs)), np.uint64)
    blocks = [0, *(np.flatnonzero(np.diff(starts // BLOCK)) + 1).tolist(), len(paragraphs)]
    for i, j in zip(blocks, blocks[1:]):
        own = values[starts[i] : starts[j] if j < len(starts) else None]
        product = np.empty_like(own)
        for k in range(count * rows):
            np.multiply(own, a[k], out=product)
            np.add(product, b[k], out=product)
            np.minimum.reduceat(product, starts[i:j] - starts[i], out=mixed[k, i:j])
    mixed >>= np.uint64(16)
    out = np.empty((len(paragraphs), count), np.uint64)
    x, y = multipliers(count, 6)
    for band in range(count):
        key = np.full(len(paragraphs), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            key = (key ^ mixed[k]) * x[band] + y[band]
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out.view(np.int64)


def lines_and_runs(text: str, least: int) -> tuple[list[tuple[int, int, int, list[bytes]]], list[tuple[int, int, int, list[bytes]]]]:
    """(line, start, end, lower-cased words) of each line of `least` words or more, and of each longest run of shorter lines that have as
    many together. A run begins and ends where its lines do."""
    lines: list[tuple[int, int, int, list[bytes]]] = []
    runs: list[tuple[int, int, int, list[bytes]]] = []

    def end_run(number: int, start: int, end: int) -> None:
        if end - start >= 2 * least - 1:
            words = text[start:end].encode().lower().split()
            if len(words) >= least:
                runs.append((number, start, end, words))

    at = run_line = run_at = 0
    for number, line in enumerate(text.split("\n")):
        after = at + len(line) + 1
        if len(line) >= 2 * least - 1:
            words = line.encode().lower().split()
            if len(words) >= least:
                end_run(run_line, run_at, at - 1)
                lines.append((number, at, after - 1, words))
                run_line, run_at = number + 1, after
        at = after
    end_run(run_line, run_at, at - 1)
    return lines, runs


def pieces_of(runs: list[list[bytes]], least: int) -> list[list[int]]:
    """Where each run's pieces begin, and its end: all of `least` words or more.

    A piece begins at a word whose hash, made from it and the word before, is the smallest of those of least - 1 words on both sides
    (the leftmost, if tied). A change of a word moves only the begins that are as near to it.
    """
    first = np.cumsum([0, *(len(w) for w in runs)])
    own = word_hashes(runs, first[-1])
    pairs = np.roll(own, 1) * FACTOR + own
    pairs = (pairs ^ pairs >> np.uint64(31)) * FACTOR
    gap = least - 1  # so many of the largest hash lie between two runs, which therefore don't see each other
    spread = np.full(len(own) + gap * (len(runs) + 1), np.iinfo(np.uint64).max, np.uint64)
    shift = np.repeat(np.arange(1, len(runs) + 1) * gap, np.diff(first))
    spread[np.arange(len(own)) + shift] = pairs
    spread[first[:-1] + np.arange(1, len(runs) + 1) * gap] = np.iinfo(np.uint64).max  # a run's first word has none before it
    smallest = leftmost_minima(spread, 2 * gap + 1)
    chosen = np.flatnonzero(smallest[np.arange(len(own)) + shift - gap] == np.arange(len(own)) + shift)
    out = []
    for a, b in zip(first, first[1:]):
        cuts = chosen[np.searchsorted(chosen, a + least) : np.searchsorted(chosen, b - least, "right")] - a
        out.append([0, *cuts.tolist(), int(b - a)])
    return out


#: What the contents of runs and of pieces end with, after their hash, and what changes the bands of pieces, which meet pieces only.
LINE, RUN, PIECE = b"", b"r", b"p"
#: Bytes of the hash, with which a line's content ends.
CONTENT = 16
PIECE_BANDS = 0x5851F42D4C957F2D


def paragraphs(df: DataFrame, least: int, id_col: str, text_col: str) -> DataFrame:
    """(id, __key, line, start, end, n_words, content, words, bands): the paragraphs and pieces of every document, places in code points;
    line is that of the first word."""
    names = [id_col, "__key", "line", "start", "end", "n_words", "content", "words", "bands"]

    def of_texts(texts: list[str]) -> Iterator[tuple[int, tuple[int, int, int, int], list[bytes], bytes]]:
        """(number of the text, place, words, kind) of all paragraphs, then of all pieces."""
        of_runs = []
        for k, text in enumerate(texts):
            lines, runs = lines_and_runs(text, least)
            of_runs += [(k, text, *run) for run in runs]
            for kind, those in ((LINE, lines), (RUN, runs)):
                for line, start, end, words in those:
                    yield k, (line, start, end, len(words)), words, kind
        for (k, text, line, start, end, words), edges in zip(of_runs, pieces_of([r[-1] for r in of_runs], least)):
            if len(edges) > 2:
                starts, ends = word_places(text[start:end])
                for a, b in zip(edges, edges[1:]):
                    at = start + int(starts[a])
                    yield k, (line + text.count("\n", start, at), at, start + int(ends[b - 1]), b - a), words[a:b], PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = list(of_texts(batch.column(2).to_pylist()))
                if not found:
                    continue
                of, places, own, kinds = zip(*found)
                joined = [b" ".join(w) for w in own]
                keys = bands(own) ^ np.where([k == PIECE for k in kinds], PIECE_BANDS, 0)[:, None]
                columns = [batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), *(pa.array(x, pa.int32()) for x in zip(*places))]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.ravel()))
                columns += [pa.array([xxhash.xxh3_128_digest(j) + k for j, k in zip(joined, kinds)]), pa.array([j.decode() for j in joined]), lists]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, __key long, line int, start int, end int, n_words int, content binary, words string, bands array<long>"
    text = text_of(text_col)
    return df.select(F.col(id_col), F.xxhash64(text).alias("__key"), text.alias("__text")).mapInArrow(run, schema)


def similar_links(members: Sequence[bytes], texts: Sequence[str], similarity: float) -> list[tuple[bytes, bytes]]:
    """Pairs that connect all members whose Jaccard similarity is at least `similarity`. Members that are connected already aren't
    compared again, so a group of copies takes about as many comparisons as it has members.

    The ends of runs and pieces are no paragraph's: of these, one that goes on for more than SHINGLE words where the other has ended
    is no copy of it (what they have verbatim goes as a shared passage, and the rest stays)."""
    sets, ends = [], []
    for t in texts:
        own = shingles(t.encode().split())
        sets.append(set(own))
        ends.append((own[: SHINGLE + 1], own[-SHINGLE - 1 :]))
    group, links = np.arange(len(members)), []

    def ends_meet(i: int, j: int) -> bool:
        lines = len(members[i]) == len(members[j]) == CONTENT
        return lines or not any(sets[b].isdisjoint(end) for a, b in ((i, j), (j, i)) for end in ends[a])

    for i, own in enumerate(sets):
        others = np.flatnonzero(group[:i] != group[i])
        while len(others):
            j, others = int(others[0]), others[1:]
            small, large = sorted((len(own), len(sets[j])))
            if small >= similarity * large and (both := len(own & sets[j])) >= similarity * (small + large - both) and ends_meet(i, j):
                links.append((members[i], members[j]))
                group[group == group[j]] = group[i]
                others = others[group[others] != group[i]]
    return links


def lists_of(contents: DataFrame, keep: Scratch) -> DataFrame:
    """(list, member): contents (content, size, bands) that are to be compared with each other, each set of contents as one list
    however many buckets have it. A member is a content's hash; contents of one hash are members together, which compares them once more.

    Buckets are counted before they are dealt into blocks, and a list is known by its size and two sums of hashes: nothing is collected.
    """
    keyed = contents.select(F.xxhash64("content").alias("member"), "size", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("__n"), F.sum("size").alias("__bytes")).where("__n > 1")
    members = joined(keyed, shared, ["key"], hot_keys(keyed, "key"), grown=True)
    members = members.withColumn("__blocks", F.ceil(F.greatest(F.col("__n") / MOST, F.col("__bytes") / MOST_BYTES)).cast("int"))
    own, other = F.pmod("member", F.col("__blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    members = members.withColumn("__own", own).withColumn("__other", other)
    members = keep(members.select("key", F.least("__own", "__other").alias("i"), F.greatest("__own", "__other").alias("j"), "member"), "members")
    sums = [F.count("*").alias("n"), F.sum(F.col("member").cast("decimal(38,0)")).alias("x"), F.bit_xor(F.xxhash64("member", F.lit(1))).alias("y")]
    lists = members.groupBy("key", "i", "j").agg(*sums).where("n > 1").groupBy("n", "x", "y").agg(F.min(F.struct("key", "i", "j")).alias("__k")).select("__k.*")
    return members.join(lists, ["key", "i", "j"]).select(F.xxhash64("key", "i", "j").alias("list"), "member")


def content_links(contents: DataFrame, found: DataFrame, similarity: float, keep: Scratch) -> DataFrame:
    """(a, b): links between contents (content, size, bands) that verified similar; found has their words."""
    wanted = keep(lists_of(contents, keep), "lists")
    keep.drop("members")
    texts = found.select(F.xxhash64("content").alias("member"), "content", "words").join(wanted.select("member").distinct(), "member", "left_semi")
    texts = texts.groupBy("member", "content").agg(F.min("words").alias("words"))
    rows = wanted.join(texts, "member").select("list", "content", "words").repartition("list").sortWithinPartitions("list", "content")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[list[tuple[bytes, bytes]]]:  # a list's rows follow each other, in one batch or more
            each = (row for batch in batches for part in slices(batch) for row in zip(*(c.to_pylist() for c in part.columns)))
            for _, own in groupby(each, key=itemgetter(0)):
                _, members, words = zip(*own)
                yield similar_links(members, words, similarity)

        for found in links():
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    return rows.mapInArrow(verify, "a binary, b binary").distinct()


def repeats(df: DataFrame, least: int = 50, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, start, end, n_words, kept_id, kept_start, class, __key) of every paragraph and shared passage to remove.

    Of each class of paragraphs or of pieces the occurrence of the smallest id, and there the first, stays (ids that are null come last). A passage
    of `least` words or more that an earlier document has too is found however it lies in its lines (see `shared_passages`); its line
    is null, and it may overlap paragraphs, as the pieces of a run of lines overlap it. Null and empty texts have no paragraphs. Rows that repeat an id and a text are one document. An empty table
    gives an empty result.
    """
    passages = shared_passages(df, least, id_col, text_col)
    with scratch(df.sparkSession, "paragraphs") as keep:
        found = keep(paragraphs(df, least, id_col, text_col), "paragraphs")
        first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("__key").alias("key"), "start")
        rows = found.withColumn("place", first).withColumn("size", F.octet_length("words"))
        places = rows.select(id_col, "__key", "line", "start", "end", "n_words", "content", "place")
        sums = [F.min("place").alias("first"), F.max("place").alias("last"), F.min("bands").alias("bands"), F.max("size").alias("size")]
        contents = keep(rows.groupBy("content").agg(*sums), "contents")
        linked = connected_components(content_links(contents, found, similarity, keep)).select(F.col("node").alias("content"), F.col("component").alias("class"))
        classes = keep(contents.select("content", "first", "last").join(linked, "content", "left").withColumn("class", F.coalesce("class", "content")), "classes")
        several = classes.groupBy("class").agg(F.min("first").alias("keep"), F.max("last").alias("last")).where("keep != last")
        several = keep(joined(classes.select("content", "class"), several.select("class", "keep"), ["class"], hot_keys(classes, "class")), "several")
        gone = joined(places, several, ["content"], hot_keys(places, "content")).where("place != keep")
        gone = gone.select(id_col, "line", "start", "end", "n_words", F.col("keep.id").alias("kept_id"), F.col("keep.start").alias("kept_start"), F.lower(F.hex("class")).alias("class"), "__key").distinct()
        return stored(gone.union(passages), "repeats")


def cleaned(df: DataFrame, least: int = 50, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """df without what `repeats` finds; texts that lose nothing stay as they are. length_col is set where a text changes."""
    spans = F.collect_set(F.struct("start", "end"))
    own_id, own_key, own_gone, own_text = (fresh(df, f"__{n}") for n in ("id", "key", "gone", "text"))
    gone = repeats(df, least, similarity, id_col, text_col).groupBy(F.col(id_col).alias(own_id), F.col("__key").alias(own_key)).agg(spans.alias(own_gone))
    gone = stored(gone, "gone")  # so that both sides of the join are plain exchanges, which adaptive execution can split
    rows = df.join(gone, df[id_col].eqNullSafe(gone[own_id]) & (F.xxhash64(text_of(text_col)) == gone[own_key]), "left")
    rows = rows.withColumn(own_text, without(F.col(text_col), F.col(f"{own_gone}.start"), F.col(f"{own_gone}.end")))
    columns = {n: F.col(n) for n in df.columns} | {text_col: F.col(own_text).alias(text_col)}
    if length_col in columns:
        columns[length_col] = F.when(F.col(own_gone).isNull(), F.col(length_col)).otherwise(F.length(own_text)).cast(df.schema[length_col].dataType).alias(length_col)
    return rows.select(*columns.values())

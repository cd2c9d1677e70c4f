"""SimHash fingerprints, linked by covering locality-sensitive hashing (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probalink.llm.common import fresh, in_arrow, stored, text_of
from probalink.llm.components import buckets, connected_components, hot_keys, joined, parted, with_minimum

#: A fingerprint has so many bits.
BITS = 64


def fingerprints(texts: list[str], size: int = 4) -> np.ndarray:
    """The 64-bit SimHash of each text over its shingles of `size` words, A-Z lower-cased; zero for a text without words."""
    hashes: list[int] = []
    starts: list[int] = []
    own: list[int] = []
    digest = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        words = text.encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
        if not words:
            continue
        own.append(k)
        starts.append(len(hashes))
        joined = b" ".join(words)
        if len(words) <= size:
            hashes.append(digest(joined, 42))
            continue
        ends = list(accumulate(len(w) + 1 for w in words))
        hashes += [digest(joined[a : b - 1], 42) for a, b in zip([0, *ends], ends[size - 1 :])]
    out = np.zeros(len(texts), np.uint64)
    if hashes:
        raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts = np.empty((len(starts), BITS), np.int64)
        for column in range(8):  # a byte at a time bounds the memory of the unpacked bits
            bits = np.unpackbits(raw[:, column : column + 1], axis=1, bitorder="little")
            counts[:, 8 * column : 8 * column + 8] = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        many = np.diff([*starts, len(hashes)])
        set_bits = (2 * counts > many[:, None]).astype(np.uint8)
        out[own] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """2 ** (radius + 1) - 1 masks of which every pair of fingerprints at most `radius` bits apart agrees on one.

    Each bit has a nonzero vector of radius + 1 bits, and mask v holds the bits whose vector has an odd inner product with v. The
    vectors of up to radius differing bits span less than the whole space, so some v is orthogonal to all of them, and the
    pair agrees under its mask. The vectors are dealt evenly, so that every mask holds about half the bits.
    """
    every = np.arange(1, 2 ** (radius + 1))
    vectors = np.random.default_rng(seed).permutation(np.resize(every, BITS))
    return [sum(1 << i for i in range(BITS) if bin(int(vectors[i]) & int(v)).count("1") % 2) for v in every]


def with_fingerprints(df: DataFrame, size: int = 4, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns named by keep, with `fingerprint` (long; its bits are the unsigned fingerprint's). Null text: no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = fingerprints(batch.column(batch.num_columns - 1).to_pylist(), size)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], [*keep, "fingerprint"])

    schema = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep) + ", fingerprint long"
    return in_arrow(df.select(*keep, text_of(text_col).alias("__text")), run, schema)


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs of a bounded list of fingerprints that join all whose distances of up to radius connect them."""
    n = len(values)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    seen, links = np.zeros(n, bool), []
    for start in range(n):
        if seen[start]:
            continue
        seen[start] = True
        stack = [start]
        while stack:
            at = stack.pop()
            new = np.flatnonzero(close[at] & ~seen)
            seen[new] = True
            links += [(at, k) for k in new.tolist()]
            stack += new.tolist()
    return links


def ball(radius: int) -> list[int]:
    """Masks of up to radius bits out of all."""
    masks = {0}
    for _ in range(radius):
        masks |= {m | (1 << i) for m in masks for i in range(BITS)}
    return sorted(masks)


def links(fingerprints: DataFrame, radius: int = 4, most: int = 256) -> DataFrame:
    """(a, b): pairs of distinct fingerprints at most `radius` bits apart that connect all such pairs.

    Every fingerprint goes to the table of each covering mask. Buckets of two to `most` are verified pair by pair, a list at a
    time, and only a spanning forest of their links is returned. The members of larger buckets are linked without comparing pairs:
    two fingerprints at most radius apart are both within half of it (rounded up and down) of some third value, and all within
    radius / 2 of a value are within radius of each other, so each lists the values of its ball and is linked to the least that
    shares one. That is exact for an even radius; the number of rows is linear in that of the members.
    """
    if radius % 2:
        raise ValueError("an even radius is needed")
    masks = covering_masks(radius)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    tables = F.array(*[F.xxhash64(F.lit(k), F.col("fingerprint").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)])
    keyed = fingerprints.select("fingerprint", F.explode(tables).alias("key"))
    small, large = buckets(keyed, "key", "fingerprint", most)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends: tuple[list[int], list[int]] = ([], [])
            for members in batch.column(0):
                values = np.asarray(members.values)
                for i, j in spanning_links(values.view(np.uint64), radius):
                    ends[0].append(int(values[i]))
                    ends[1].append(int(values[j]))
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    near = small.mapInArrow(verify, "a long, b long")
    masks_near = [m - (1 << BITS) if m >> (BITS - 1) else m for m in ball(radius // 2)]
    centres = stored(large.select("fingerprint").distinct(), "large")
    centres = centres.select("fingerprint", F.explode(F.lit(masks_near)).alias("__flip")).select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("__flip")).alias("u"))
    starred = with_minimum(centres.select("u", F.col("fingerprint").alias("v")), grown=True)
    return near.union(starred.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))).distinct()


def grouped(prints: DataFrame, least: Column, radius: int, most: int) -> DataFrame:
    """(fingerprint, least): the minimum of `least` over all rows whose fingerprints links of up to `radius` bits reach."""
    distinct = stored(prints.groupBy("fingerprint").agg(F.min(least).alias("__least")), "fingerprints")
    linked = connected_components(links(distinct, radius, most)).withColumnRenamed("node", "fingerprint")
    known = stored(distinct.join(linked, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint")), "grouped")
    names = known.groupBy("component").agg(F.min("__least").alias("least"))
    return joined(known, names, ["component"], hot_keys(known, "component")).select("fingerprint", "least")


def with_components(prints: DataFrame, radius: int = 4, most: int = 256, id_col: str = "doc_id") -> DataFrame:
    """(id, fingerprint) rows with component_id, the smallest id that links of up to `radius` bits reach.

    Rows of one fingerprint, texts without words among them, are linked to each other. Null ids get a component but never name
    one (null, if no linked row has an id). An empty table gives an empty result.
    """
    found = grouped(prints, F.col(id_col), radius, most).withColumnRenamed("least", "component_id")
    return joined(prints, found, ["fingerprint"], hot_keys(prints, "fingerprint"))


def components(df: DataFrame, radius: int = 4, size: int = 4, most: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every document. See with_fingerprints and with_components."""
    prints = stored(with_fingerprints(df, size, (id_col,), text_col), "fingerprints")
    return with_components(prints, radius, most, id_col).select(id_col, "fingerprint", "component_id")


def one_of_each(df: DataFrame, radius: int = 4, size: int = 4, most: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df of which each component keeps one: the one of the smallest id (null ids come last), and of its texts that of the
    smallest hash.

    Rows that share an id but belong to different components are told apart by their texts and stay, as rows without an id do. Rows
    of one id and text are one document, of which one row stays, whichever it is. An empty table gives an empty result.
    """
    key = F.xxhash64(text_of(text_col))
    name = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))  # so that null ids are equal to each other
    rows = df.select(F.col(id_col).alias("__id"), name.alias("__name"), key.alias("__key"), text_of(text_col).alias("__text"))
    prints = stored(with_fingerprints(rows, size, ("__id", "__name", "__key"), "__text"), "fingerprints")
    place = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__key").alias("key"), F.col("__name").alias("name"))
    own, own_key = fresh(df, "__name"), fresh(df, "__key")
    kept = grouped(prints, place, radius, most).select(F.col("least.name").alias(own), F.col("least.key").alias(own_key)).distinct()
    named = df.withColumns({own: name, own_key: key})
    hot = hot_keys(prints, "__name", "__key")
    keys = [own, own_key]
    cold, warm = parted(named, keys, hot) if hot else (named, None)
    out = cold.join(kept, keys, "left_semi").dropDuplicates(keys)
    if hot:
        out = out.union(warm.join(F.broadcast(parted(kept, keys, hot)[1]), keys, "left_semi").dropDuplicates(keys))
    return out.drop(own, own_key)

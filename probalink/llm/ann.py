"""Approximate nearest neighbours by collision counting (operator 9).

Vectors are scaled to length one and projected on `lines` random lines, and each line keeps them sorted by projection, one array a
line and block of rows; the index holds these arrays, built once. A query opens a window around its own projection on every line;
all windows start narrow and are widened together by a constant factor (virtual rehashing: no table is built anew). A vector that
lies in the windows of at least `needed` lines is verified by its exact cosine. A query is done with a block when it has `k` verified
vectors, of this block or of those before it, so near that the next ones would have collided already, or when every vector of the block has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probalink.llm.common import scratch, stored

#: Rows of a block of the index, and bytes of the queries that are asked at once.
BLOCK = 4096
QUERY_BYTES = 16_000_000
#: Tasks that write the index, at most.
WRITERS = 10_000


@dataclass(frozen=True)
class Search:
    """needed: the share of lines on which a vector must collide. Windows start at half width `width` and grow by `ratio`."""

    k: int = 5
    lines: int = 48
    share: float = 0.6
    ratio: float = 1.5
    width: float = 0.2
    seed: int = 11

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        axes = np.random.default_rng(self.seed).standard_normal((vectors.shape[1], self.lines))
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ axes

    def arrays(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every line, the places of the vectors in the order of their projections, and these."""
        projections = self.projected(vectors)
        order = np.argsort(projections, axis=0, kind="stable")
        return np.ascontiguousarray(order.T), np.ascontiguousarray(np.take_along_axis(projections, order, axis=0).T)


class Best:
    """The k nearest that each query has found so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, search: Search):
        self.ids, self.vectors, self.search = ids, vectors, search
        self.lengths, self.projected = np.linalg.norm(vectors, axis=1), search.projected(vectors)
        self.found = [np.zeros(0, np.int64) for _ in ids]
        self.scores = [np.zeros(0) for _ in ids]

    def look(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, arrays: np.ndarray) -> None:
        """Looks through one block of the index. Vectors of a query's own id don't count."""
        search, n = self.search, len(ids)
        lines, needed = search.lines, max(1, int(np.ceil(search.share * search.lines)))
        lengths = np.linalg.norm(vectors, axis=1)
        radii = [search.width * search.ratio**j for j in range(64)]
        places: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def window(j: int) -> tuple[np.ndarray, np.ndarray]:
            """Where every query's window of round j begins and ends on every line."""
            if j not in places:
                sides = ((-1, "left"), (1, "right"))
                places[j] = tuple(np.stack([np.searchsorted(arrays[i], self.projected[:, i] + side * radii[j], s) for i in range(lines)], axis=1) for side, s in sides)
            return places[j]

        for q, own in enumerate(self.ids):
            counts, verified, last = np.zeros(n, np.int32), ids == own, None
            for j, radius in enumerate(radii):
                begins, ends = (x[q] for x in window(j))
                if last is None:
                    new = [order[i, begins[i] : ends[i]] for i in range(lines)]
                else:
                    new = [part for i in range(lines) for part in (order[i, begins[i] : last[0][i]], order[i, last[1][i] : ends[i]])]
                last = begins, ends
                counts += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
                fresh = np.flatnonzero((counts >= needed) & ~verified)
                if len(fresh):
                    verified[fresh] = True
                    score = (vectors[fresh] * self.vectors[q]).sum(axis=1) / (lengths[fresh] * self.lengths[q])  # row by row: equal vectors tie exactly
                    found, score = np.concatenate([self.found[q], ids[fresh]]), np.concatenate([self.scores[q], score])
                    best = np.lexsort((found, -score))[: search.k]
                    self.found[q], self.scores[q] = found[best], score[best]
                # a vector at distance d lies in a window of half width r with probability P(|N(0,1)| <= r / d): at d = r / 1.6 nearly all collide
                if len(self.found[q]) == search.k and np.sqrt(max(0.0, 2 - 2 * self.scores[q][-1])) <= radius / 1.6:
                    break
                if verified.all():
                    break

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.repeat(self.ids, [len(f) for f in self.found]), np.concatenate(self.found), np.concatenate(self.scores)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part: an id, and a vector of finite components that isn't null, empty or zero."""
    values = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), values.alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(finite & F.exists("vector", lambda x: x != 0))


INDEX_SCHEMA = "dim int, ids array<long>, vectors array<double>, places array<int>, projections array<double>"


def indexed(rows: DataFrame, blocks: int, search: Search) -> DataFrame:
    """A row for each block of rows (vec_id, vector, dim): its ids, vectors and sorted arrays, each flattened. Rows are dealt by a hash."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        vectors = np.stack(rows["vector"].to_numpy())
        order, arrays = search.arrays(vectors)
        row = (int(key[0]), rows["vec_id"].to_numpy(), vectors.ravel(), order.ravel().astype(np.int32), arrays.ravel())
        return pd.DataFrame([row], columns=["dim", "ids", "vectors", "places", "projections"])

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)))
    return dealt.repartition(min(blocks, WRITERS), "dim", "block").groupBy("dim", "block").applyInPandas(build, INDEX_SCHEMA)


def asked(index: DataFrame, queries: list, search: Search) -> DataFrame:
    """(query_id, vec_id, score): for a bounded list of queries (vec_id, vector, dim), the k nearest among the blocks of each task."""
    by_dim: dict[int, list] = {}
    for row in queries:
        by_dim.setdefault(row["dim"], []).append(row)
    packed = {dim: (np.array([r["vec_id"] for r in own], np.int64), np.array([r["vector"] for r in own])) for dim, own in by_dim.items()}
    sent = index.sparkSession.sparkContext.broadcast(packed)
    names = ["query_id", "vec_id", "score"]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for batch in batches:
            for dim, *parts in zip(*batch.columns):
                dim = dim.as_py()
                if dim in sent.value:
                    ids, vectors, places, projections = (p.values.to_numpy(zero_copy_only=False) for p in parts)
                    if dim not in best:
                        best[dim] = Best(*sent.value[dim], search)
                    best[dim].look(ids, vectors.reshape(len(ids), dim), places.reshape(search.lines, -1), projections.reshape(search.lines, -1))
        for own in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in own.rows()], names)

    return index.mapInArrow(answer, "query_id long, vec_id long, score double")


def nearest(df: DataFrame, every: int = 50, block: int = BLOCK, query_bytes: int = QUERY_BYTES, id_col: str = "vec_id", vector_col: str = "embedding", **given: float) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by cosine for every row whose id is divisible by `every`. given: see Search.

    The index is built once: rows are shuffled by a hash of their id and vector into blocks of about `block` rows, so no key is hot.
    Queries are asked in groups of about `query_bytes`, each broadcast to the tasks that read the blocks; a task keeps the k best of a
    query over all its blocks, and only these are shuffled. So the shuffle grows with the rows, and with the queries times
    the tasks of one pass over the index, but not with their product.

    Rows that repeat an id and its vector are one; those of an id with several vectors are candidates, and queries, of their own, and
    none of them is a neighbour of the others. Vectors of another length than a query's aren't comparable: each length is a space
    of its own. An empty table, or one without queries, gives an empty result. Other columns are not read.
    """
    search = Search(**given)
    with scratch(df.sparkSession, "neighbours") as keep:
        rows = keep(usable(df, id_col, vector_col).distinct().withColumn("dim", F.size("vector")), "rows")
        queries = rows.where(F.col("vec_id") % every == 0)
        total = rows.count()
        size = queries.agg(F.coalesce(F.sum(F.lit(8).cast("long") * F.col("dim")), F.lit(0))).first()[0]
        index = keep(indexed(rows, max(1, -(-total // block)), search), "index")
        groups = max(1, -(-size // query_bytes))
        group = F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(groups))
        found = [keep(asked(index, queries.where(group == g).collect(), search), f"found-{g}") for g in range(groups)]  # about query_bytes each
        every_found = found[0]
        for more in found[1:]:
            every_found = every_found.union(more)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = every_found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= search.k)
        return stored(best.select("query_id", "rank", "vec_id", "score"), "neighbours")

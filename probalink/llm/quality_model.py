"""A quality classifier of sparse rules (operator 2).

Gradient-boosted trees of little depth over statistics of the texts are fitted to labelled documents; every path from a root to a node
is a conjunctive rule; lasso logistic regression gives most rules weight zero. The rest is a Spark column expression, so scoring a
table needs no Python and no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probalink.llm.quality_rules import with_statistics

#: Shares of words, characters or lines, as SQL over the statistics; all are 0 in a text without words.
FEATURES = {
    "symbols": "n_symbols / greatest(n_words, 1)",
    "bars": "n_bars / greatest(n_words, 1)",
    "exclamations": "n_exclamations / greatest(n_words, 1)",
    "doubles": "n_doubles / greatest(n_words, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "others": "n_others / greatest(word_chars, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "words": "CAST(n_words AS DOUBLE)",
}
#: A condition: the position of a feature, a threshold, and whether the feature is above it (or at most at it).
Condition = tuple[int, float, bool]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self, values: np.ndarray) -> np.ndarray:
        odds = np.full(len(values), self.intercept)
        for weight, conditions in self.rules:
            odds += weight * covers(values, conditions)
        return 1 / (1 + np.exp(-odds))

    def column(self, features: list[Column]) -> Column:
        odds = F.lit(self.intercept)
        for weight, conditions in self.rules:
            holds = F.lit(True)
            for k, threshold, above in conditions:
                holds = holds & ((features[k] > threshold) if above else (features[k] <= threshold))
            odds = odds + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def covers(values: np.ndarray, conditions: tuple[Condition, ...]) -> np.ndarray:
    held = np.ones(len(values), bool)
    for k, threshold, above in conditions:
        held &= (values[:, k] > threshold) if above else (values[:, k] <= threshold)
    return held


def grown(values: np.ndarray, residual: np.ndarray, curvature: np.ndarray, cuts: list[np.ndarray], depth: int, least: int) -> list[tuple[tuple[Condition, ...], float, bool]]:
    """A regression tree as its nodes: the path's conditions, the node's Newton step, and whether it is a leaf."""
    nodes: list[tuple[tuple[Condition, ...], float, bool]] = []

    def grow(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        g, h = residual[rows].sum(), curvature[rows].sum()
        best = (1e-6, -1, 0.0)
        if len(path) < depth:
            for k, own in enumerate(cuts):
                if len(own):
                    place = np.searchsorted(own, values[rows, k], side="left")  # cut j holds back the rows at or below it
                    gs, hs, ns = (np.cumsum(np.bincount(place, w, len(own) + 1))[:-1] for w in (residual[rows], curvature[rows], np.ones(len(rows))))
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    gain[(ns < least) | (len(rows) - ns < least)] = 0
                    j = int(np.argmax(gain))
                    if gain[j] > best[0]:
                        best = (float(gain[j]), k, float(own[j]))
        nodes.append((path, g / (h + 1), best[1] < 0))
        if best[1] >= 0:
            _, k, cut = best
            low = values[rows, k] <= cut
            grow(rows[low], (*path, (k, cut, False)))
            grow(rows[~low], (*path, (k, cut, True)))

    grow(np.arange(len(values)), ())
    return nodes


def paths(values: np.ndarray, labels: np.ndarray, trees: int, depth: int, rate: float, least: int) -> list[tuple[Condition, ...]]:
    """The distinct rules of boosted trees."""
    cuts = [np.unique(np.quantile(v, np.linspace(0.02, 0.98, 49)))[:-1] if len(np.unique(v)) > 1 else np.zeros(0) for v in values.T]
    cuts = [np.unique(np.concatenate([c, (u := np.unique(v))[:1]])) if len(np.unique(v)) > 1 else c for c, v in zip(cuts, values.T)]
    odds = np.full(len(labels), np.log(labels.mean() / (1 - labels.mean())))
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        for path, step, leaf in grown(values, labels - p, p * (1 - p), cuts, depth, least):
            if path:
                found[tuple(sorted(path))] = None
            if leaf:
                odds += rate * step * covers(values, path)
    return list(found)


def lasso(matrix: np.ndarray, labels: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Logistic regression with an absolute penalty, by accelerated proximal gradient steps."""
    n, m = matrix.shape
    mean = matrix.mean(axis=0)
    centred = matrix - mean
    bound = 0.25 * max(1e-9, float(np.linalg.norm(centred, 2)) ** 2) / n
    w, v, t = np.zeros(m), np.zeros(m), 1.0
    b = float(np.log(labels.mean() / (1 - labels.mean())))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(centred @ v + b)))
        moved = v - centred.T @ (p - labels) / n / bound
        new = np.sign(moved) * np.maximum(np.abs(moved) - penalty / bound, 0)
        b -= 2 * float((p - labels).mean())
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / after * (new - w), new, after
    return b - float(mean @ w), w


def matrix_of(values: np.ndarray, rules: list[tuple[Condition, ...]]) -> np.ndarray:
    return np.stack([covers(values, r) for r in rules], axis=1).astype(float)


def fitted(values: np.ndarray, labels: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, penalties: tuple[float, ...] = (0.0003, 0.001, 0.003, 0.01)) -> RuleModel:
    """The rule ensemble of labelled rows.

    The penalty is the one with the smallest loss on every fourth row, for rules and weights that come from the other rows alone; the
    ensemble is then grown anew from all rows. Without rows of both labels every score is the share of label 1 (one half, without any).
    """
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return RuleModel(float(np.log(share / (1 - share))), ())
    grow = lambda own: paths(values[own], labels[own], trees, depth, rate, max(5, int(own.sum()) // 500))
    back, losses = np.arange(len(labels)) % 4 == 3, [0.0]
    if back.any() and labels[~back].min() != labels[~back].max() and (rules := grow(~back)):
        known, unseen = matrix_of(values[~back], rules), matrix_of(values[back], rules)
        losses = []
        for penalty in penalties:
            b, w = lasso(known, labels[~back], penalty)
            p = np.clip(1 / (1 + np.exp(-(unseen @ w + b))), 1e-6, 1 - 1e-6)
            losses.append(-float((labels[back] * np.log(p) + (1 - labels[back]) * np.log(1 - p)).mean()))
    rules = grow(np.ones(len(labels), bool))
    if not rules:
        return RuleModel(float(np.log(labels.mean() / (1 - labels.mean()))), ())
    b, w = lasso(matrix_of(values, rules), labels, penalties[int(np.argmin(losses))])
    return RuleModel(b, tuple((float(x), r) for x, r in zip(w, rules) if x))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def learned(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> RuleModel:
    """Fits the rules to labelled documents that aren't held out.

    At most `sample` labels are used, those of the smallest hashes of their ids; their statistics, a few numbers each and one row an id,
    are all that comes to the driver. Labels other than 0 and 1, and ids that are null or have contradicting labels, aren't used; of
    documents that share an id the one with the smallest statistics is. Texts are read whole, however long; of empty tables every
    score is one half.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(F.col(id_col).alias("__id"))
    usable = usable.agg(F.min(label_col).alias("__label"), F.max(label_col).alias("__other")).where("__label = __other")
    chosen = usable.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__document")).join(F.broadcast(chosen), "__id")
    features = with_statistics(rows, "__document").select("__id", F.col("__label").cast("double").alias("label"), *[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()])
    one = features.groupBy("__id").agg(F.min(F.struct("label", *FEATURES)).alias("__row")).select(F.xxhash64("__id").alias("__hash"), "__id", "__row.*")
    data = one.toPandas().sort_values(["__hash", "__id"])
    return fitted(data[list(FEATURES)].to_numpy(float), data["label"].to_numpy(float))


def scored(docs: DataFrame, model: RuleModel, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every whole text, however long. Null texts score as empty ones; a null id isn't held out; rows
    that repeat score alike. Other columns are not read. An empty table gives an empty result."""
    rows = with_statistics(docs.select(id_col, F.col(text_col).alias("__document")), "__document")
    rows = rows.withColumns({f"__{n}": F.expr(e).cast("double") for n, e in FEATURES.items()})
    score = model.column([F.col(f"__{n}") for n in FEATURES])
    rows = rows.withColumn("score", score)
    return rows.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))

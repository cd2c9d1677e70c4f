"""Entity resolution after scoring: decisions, best matches, clusters, evaluation and reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probalink.operators import decide, graph, linkage
from probalink.sources.storage import stored

MATCHERS = ("MODEL", "BASELINE")


def at_least(p: Column, threshold: float | Column) -> Column:
    """Whether p reaches the threshold; a missing p doesn't."""
    return F.coalesce(p >= threshold, F.lit(False))


def pair_decisions(pairs: DataFrame, scores: DataFrame, model_threshold: float = 0.5, baseline_threshold: float = 0.85) -> DataFrame:
    """Pairs with their scores, the model's decision, and that of a rule: equal tax number or domain, or similar names."""
    kept = ["pair_id", "pair_kind", "a_id", "b_id", "candidate_rank", "name_sim", "vat_equal", "domain_equal", "postcode_equal"]
    rows = pairs.select(*kept).join(scores, "pair_id", "left")
    return rows.withColumns({
        "model_match": at_least(F.col("p_same"), model_threshold),
        "baseline_match": F.col("vat_equal") | F.col("domain_equal") | at_least(F.col("name_sim"), baseline_threshold),
    })


def best_match(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """(incoming_id, model_company_number, model_p_same, baseline_company_number): each record's best company, if any, by either."""
    master = decisions.where("pair_kind = 'MASTER'")
    first = lambda rows, *order: rows.withColumn("__row", F.row_number().over(Window.partitionBy("a_id").orderBy(*order))).where("__row = 1")
    model = first(master.where("model_match"), F.desc("p_same"), "b_id").select(F.col("a_id").alias("incoming_id"), F.col("b_id").alias("model_company_number"), F.col("p_same").alias("model_p_same"))
    rule = first(master.where("baseline_match"), F.desc("vat_equal"), F.desc("domain_equal"), F.desc_nulls_last("name_sim"), "b_id")
    rule = rule.select(F.col("a_id").alias("incoming_id"), F.col("b_id").alias("baseline_company_number"))
    return records.select("incoming_id").join(model, "incoming_id", "left").join(rule, "incoming_id", "left")


def clusters(best: DataFrame, decisions: DataFrame) -> DataFrame:
    """(matcher, incoming_id, cluster_id): records linked by a matching pair, or by the same company, for each matcher.

    Companies are nodes beside the records, told apart by node_kind, and a cluster is named by its smallest record. Both matchers are
    one graph, whose nodes are told apart by the matcher.
    """
    node = lambda matcher, kind, c: F.struct(F.lit(matcher).alias("matcher"), F.lit(kind).alias("node_kind"), F.col(c).cast("string").alias("id"))
    nodes, edges = [], []
    for matcher in MATCHERS:
        name = matcher.lower()
        nodes.append(best.select(node(matcher, 0, "incoming_id").alias("node")))
        edges.append(decisions.where("pair_kind = 'DEDUP'").where(f"{name}_match").select(node(matcher, 0, "a_id").alias("a"), node(matcher, 0, "b_id").alias("b")))
        edges.append(best.where(f"{name}_company_number IS NOT NULL").select(node(matcher, 0, "incoming_id").alias("a"), node(matcher, 1, f"{name}_company_number").alias("b")))
    rows = graph.labelled(reduce(DataFrame.union, nodes), reduce(DataFrame.union, edges))
    return rows.where("node.node_kind = 0").select("node.matcher", F.col("node.id").alias("incoming_id"), F.col("component.id").alias("cluster_id"))


def match_results(records: DataFrame, master: DataFrame, best: DataFrame, decisions: DataFrame, grouped: DataFrame) -> DataFrame:
    """Every record with the company found for it, the model's answers about that pair, and its cluster."""
    names = master.select(F.col("company_number").alias("matched_company_number"), F.col("company_name").alias("matched_company_name"))
    why = decisions.where("pair_kind = 'MASTER'").select(F.col("a_id").alias("incoming_id"), F.col("b_id").alias("matched_company_number"), *decide.PAIR_SCORES)
    own = grouped.where("matcher = 'MODEL'").select("incoming_id", "cluster_id")
    rows = records.join(best.select("incoming_id", F.col("model_company_number").alias("matched_company_number")), "incoming_id")
    rows = rows.join(names, "matched_company_number", "left").join(why, ["incoming_id", "matched_company_number"], "left").join(own, "incoming_id", "left")
    return rows.select("incoming_id", "source_system", "record_name", "address", "postcode", "website", "vat_id", "matched_company_number", "matched_company_name", *decide.PAIR_SCORES, "cluster_id")


def match_evaluation(truth: DataFrame, best: DataFrame, pairs: DataFrame) -> DataFrame:
    """(variation_type, records, candidate_ceiling, model_accuracy, baseline_accuracy), per type and in all.

    Right is the true company, or none for a record that has none. A record without a company counts as reachable.
    """
    reachable = pairs.where("pair_kind = 'MASTER'").select(F.col("a_id").alias("__a"), F.col("b_id").alias("__b")).distinct()
    rows = truth.join(best, "incoming_id").join(reachable, (F.col("incoming_id") == F.col("__a")) & (F.col("true_company_number") == F.col("__b")), "left")
    right = lambda c: F.when(F.col(c).eqNullSafe(F.col("true_company_number")), 1.0).otherwise(0.0)
    ceiling = F.when(F.col("true_company_number").isNull() | F.col("__a").isNotNull(), 1.0).otherwise(0.0)
    total = rows.rollup("variation_type").agg(
        F.grouping("variation_type").alias("g"), F.count("*").alias("records"), F.avg(ceiling).alias("candidate_ceiling"),
        F.avg(right("model_company_number")).alias("model_accuracy"), F.avg(right("baseline_company_number")).alias("baseline_accuracy"),
    )
    return total.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("variation_type")).alias("variation_type"), "records", "candidate_ceiling", "model_accuracy", "baseline_accuracy")


def pairs_within(n: Column) -> Column:
    """Pairs of a group of n; whole, as one of n and n - 1 is even."""
    return F.sum((n * (n - 1) / 2).cast("long"))


def dedup_evaluation(grouped: DataFrame, truth: DataFrame) -> DataFrame:
    """(matcher, true_duplicate_pairs, predicted_pairs, correct_pairs, pair_precision, pair_recall), from group sizes alone."""
    rows = grouped.join(truth.select("incoming_id", "entity_id"), "incoming_id")
    sizes = lambda *by: rows.groupBy("matcher", *by).count().groupBy("matcher").agg(pairs_within(F.col("count")).alias("n"))
    predicted, correct = sizes("cluster_id").withColumnRenamed("n", "predicted_pairs"), sizes("cluster_id", "entity_id").withColumnRenamed("n", "correct_pairs")
    true = truth.groupBy("entity_id").count().agg(pairs_within(F.col("count")).alias("true_duplicate_pairs"))
    out = predicted.join(correct, "matcher").crossJoin(F.broadcast(true))  # one row
    ratio = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return out.select("matcher", "true_duplicate_pairs", "predicted_pairs", "correct_pairs", ratio("correct_pairs", "predicted_pairs").alias("pair_precision"), ratio("correct_pairs", "true_duplicate_pairs").alias("pair_recall"))


def metric_report(matches: DataFrame, dedup: DataFrame) -> DataFrame:
    """(metric, records, candidate_ceiling, model, baseline): accuracies by type, all, then the pairs' precision and recall."""
    accuracy = matches.select(F.when(F.col("variation_type") == "ALL", 1).otherwise(0).alias("__order"), F.concat(F.lit("ACCURACY "), "variation_type").alias("metric"), "records", "candidate_ceiling", F.col("model_accuracy").alias("model"), F.col("baseline_accuracy").alias("baseline"))
    of = lambda matcher, c: F.max(F.when(F.col("matcher") == matcher, F.col(c)))
    rows = accuracy
    for order, (name, c) in enumerate((("DEDUP PRECISION", "pair_precision"), ("DEDUP RECALL", "pair_recall")), 2):
        one = dedup.agg(F.max("true_duplicate_pairs").alias("records"), of("MODEL", c).alias("model"), of("BASELINE", c).alias("baseline"))
        rows = rows.unionByName(one.select(F.lit(order).alias("__order"), F.lit(name).alias("metric"), "records", F.lit(None).cast("double").alias("candidate_ceiling"), "model", "baseline"))
    return rows.orderBy("__order", "metric").drop("__order")


def threshold_sweep(records: DataFrame, truth: DataFrame, decisions: DataFrame, thresholds: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8, 0.9)) -> DataFrame:
    """(threshold, variation_type, records, accuracy) from stored scores, without asking again.

    A record's best candidate doesn't depend on the threshold: only whether it counts does.
    """
    top = decisions.where("pair_kind = 'MASTER' AND p_same IS NOT NULL").withColumn("__row", F.row_number().over(Window.partitionBy("a_id").orderBy(F.desc("p_same"), "b_id"))).where("__row = 1")
    rows = records.select("incoming_id").join(truth, "incoming_id").join(top.select(F.col("a_id").alias("incoming_id"), "b_id", "p_same"), "incoming_id", "left")
    rows = rows.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    found = F.when(at_least(F.col("p_same"), F.col("threshold")), F.col("b_id"))
    rows = rows.withColumn("right", F.when(found.eqNullSafe(F.col("true_company_number")), 1.0).otherwise(0.0))
    total = rows.groupBy("threshold", F.expr("coalesce(variation_type, '')").alias("variation_type")).agg(F.count("*").alias("records"), F.avg("right").alias("accuracy"))
    every = rows.groupBy("threshold").agg(F.count("*").alias("records"), F.avg("right").alias("accuracy")).withColumn("variation_type", F.lit("ALL"))
    return total.unionByName(every)


def review_band(decisions: DataFrame, low: float = 0.5, high: float = 0.8, least_name: float | None = None) -> DataFrame:
    """decisions with band: match from `high` on (and of a name at least so alike), review from `low` on, else no match."""
    sure = F.col("p_same") >= high
    if least_name is not None:
        sure = sure & (F.col("p_name") >= least_name)
    return decisions.withColumn("band", F.when(sure, "match").when(F.col("p_same") >= low, "review").otherwise("no match"))


@dataclass(frozen=True)
class Resolution:
    decisions: DataFrame
    best: DataFrame
    clusters: DataFrame
    results: DataFrame
    matches: DataFrame
    dedup: DataFrame
    report: DataFrame


def resolve(records: DataFrame, master: DataFrame, truth: DataFrame, pairs: DataFrame, model: decide.Model, model_threshold: float = 0.5, baseline_threshold: float = 0.85, **given) -> Resolution:
    """Everything from candidate pairs on: score with one retry, decide, match, cluster, evaluate."""
    decisions = stored(pair_decisions(pairs, decide.score_pairs(pairs, model, **given), model_threshold, baseline_threshold), "decisions")
    best = stored(best_match(records, decisions), "best")
    grouped = stored(clusters(best, decisions), "clusters")
    results = match_results(records, master, best, decisions, grouped)
    matches, dedup = match_evaluation(truth, best, pairs), dedup_evaluation(grouped, truth)
    return Resolution(decisions, best, grouped, results, matches, dedup, metric_report(matches, dedup))


find_candidates = linkage.find_candidates

"""Record linkage: keys, multi-key blocking, weighted ranking, candidate pairs and their report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probalink.functions import normalize as n
from probalink.operators import alike
from probalink.operators.ids import dense_ids, evenly
from probalink.sources.storage import stored

#: Blocking keys: the columns that make two records a candidate where one of them is equal.
KEYS = ("vat_digits", "domain_root", "postcode_norm", "address_key", "name_token1")
#: What equal keys add to the similarity of the names when candidates are ranked.
WEIGHTS = {"vat_digits": 1.0, "domain_root": 1.0, "postcode_norm": 0.5, "address_key": 0.5}
#: Pairs of a block beyond which it is cut, the records on a cell's side, and the cut blocks at most that are broadcast.
TASK_PAIRS, CELL_SIDE, MOST_CUT = 1_000_000, 512, 50_000
#: Pairs of a block beyond which it is searched for the most alike names, left and right records of a cell of such a block, and the
#: partitions a core that cells are dealt to; and the pairs of all such blocks up to which they aren't worth the search's jobs.
FEW_PAIRS = 20_000_000
ALIKE_PAIRS, CELL_LEFT, CELL_RIGHT, DEALS = 20_000, 4096, 32_768, 16


@dataclass(frozen=True)
class Fields:
    """The columns of a record table. address_in_text: a missing postcode is looked for in the address."""

    id: str
    name: str
    address: tuple[str, ...]
    postcode: str
    country: str
    website: str
    vat: str
    address_in_text: bool = False


MASTER = Fields("company_number", "company_name", ("address_line1", "address_line2", "post_town", "county"), "postcode", "country", "website", "vat_id")
INCOMING = Fields("incoming_id", "record_name", ("address",), "postcode", "country", "website", "vat_id", True)


def with_keys(df: DataFrame, fields: Fields) -> DataFrame:
    """(id, name, name_norm, name_token1, postcode_norm, address_key, vat_digits, domain_root, full_address, country, website, vat_id)."""
    first = F.col(fields.address[0])
    parts = [*fields.address, *[fields.postcode] * (fields.postcode not in fields.address)]
    rows = df.select(
        F.col(fields.id).alias("id"),
        F.col(fields.name).alias("name"),
        n.name_norm(F.col(fields.name)).alias("name_norm"),
        n.postcode_norm(F.col(fields.postcode), first if fields.address_in_text else None).alias("postcode_norm"),
        n.address_key(first).alias("address_key"),
        n.vat_digits(F.col(fields.vat)).alias("vat_digits"),
        n.domain_root(F.col(fields.website)).alias("domain_root"),
        n.full_address(*map(F.col, parts)).alias("full_address"),
        F.col(fields.country).alias("country"),
        F.col(fields.website).alias("website"),
        F.col(fields.vat).alias("vat_id"),
    )
    return rows.withColumn("name_token1", n.first_word(F.col("name_norm")))


def long_keys(keyed: DataFrame, keys: tuple[str, ...], side: str, carried: Sequence[str] = ()) -> DataFrame:
    """A row for each key that a record has: key_type (its place in keys), key_value, and the record's id, keys and carried columns
    after the side's name."""
    entries = F.array(*[F.struct(F.lit(n).alias("key_type"), F.col(k).alias("key_value")) for n, k in enumerate(keys)])
    own = [F.col(c).alias(f"{side}_{c}") for c in dict.fromkeys(("id", *keys, *carried))]
    rows = keyed.select(*own, F.explode(F.filter(entries, lambda e: e["key_value"].isNotNull())).alias("e"))
    return rows.select("*", "e.key_type", "e.key_value").drop("e")


def large_blocks(left: DataFrame, right: DataFrame, task: int) -> DataFrame:
    """(key_type, key_value, l, r, pairs): the blocks of long-form keys that make more than `task` pairs, and their records on both sides.
    `task` is doubled until at most MOST_CUT blocks are left, so that the table may be broadcast."""
    n = lambda df, name: df.groupBy("key_type", "key_value").agg(F.count("*").alias(name))
    sizes = n(left, "l").join(n(right, "r"), ["key_type", "key_value"]).withColumn("pairs", F.col("l") * F.col("r"))
    large = stored(sizes.where(F.col("pairs") > task), "large-blocks")
    while large.where(F.col("pairs") > task).count() > MOST_CUT:
        task *= 2
    return large.where(F.col("pairs") > task)


def in_parts(large: DataFrame, left: int, right: int) -> DataFrame:
    """(key_type, key_value, l_parts, r_parts): large blocks, to be cut into cells of about left * right pairs."""
    parts = lambda c, side: F.ceil(F.col(c) / side).cast("int").alias(f"{c}_parts")
    return large.select("key_type", "key_value", parts("l", left), parts("r", right))


def cut_blocks(left: DataFrame, right: DataFrame, task: int, side: int) -> DataFrame:
    """The blocks of long-form keys that make more than `task` pairs, each to be cut into cells of about side * side pairs."""
    return in_parts(large_blocks(left, right, task), side, side)


def in_cells(rows: DataFrame, cut: DataFrame, own: str, other: str, id_col: str) -> DataFrame:
    """Long-form keys with the cells (l, r) of their block that a row is in: one part of its own side, and every part of the other."""
    parts = lambda c: F.coalesce(f"{c}_parts", F.lit(1))
    dealt = rows.join(F.broadcast(cut), ["key_type", "key_value"], "left").withColumn(own, F.pmod(F.xxhash64(id_col), parts(own)).cast("int"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), parts(other) - 1))).drop("l_parts", "r_parts")


def blocked(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = KEYS, within: bool = False, carried: Sequence[str] = (), task: int = TASK_PAIRS, side: int = CELL_SIDE) -> DataFrame:
    """(a_id, b_id, keys and carried columns of both sides): each pair of records that share a key, once.

    One equi-join over all keys instead of a disjunction. A pair comes from the first key that its records share, so none has to be
    removed afterwards. within: both are the same table, and only pairs with a_id < b_id count. Ids are unique in a table.
    Blocks of more than `task` pairs are cut into cells, pairs of a part of the left records and one of the right ones, which the
    join deals out like keys: no task gets a whole large block.
    """
    narrow = lambda df: long_keys(df, keys, "x").select("key_type", "key_value")
    cut = cut_blocks(narrow(left), narrow(right), task, side)
    a, b = in_cells(long_keys(left, keys, "a", carried), cut, "l", "r", "a_id"), in_cells(long_keys(right, keys, "b", carried), cut, "r", "l", "b_id")
    on = F.lit(True)
    for c in ("key_type", "key_value", "l", "r"):
        on = on & (a[c] == b[c])
    for n, k in enumerate(keys):
        on = on & ((a["key_type"] <= n) | ~F.coalesce(a[f"a_{k}"] == b[f"b_{k}"], F.lit(False)))
    if within:
        on = on & (a["a_id"] < b["b_id"])
    return a.join(b, on).drop("key_type", "key_value", "l", "r")


def pair_similarity() -> Column:
    """name_sim of a pair's name_norm. Names that begin with the same word are compared from there on: what strings share at their begin
    changes no edit distance, and most pairs of a block share their first word."""
    a, b = F.col("a_name_norm"), F.col("b_name_norm")
    rest = lambda s: F.expr(f"substring({s}_name_norm, length({s}_name_token1) + 1)")
    edits = F.when(F.col("a_name_token1") == F.col("b_name_token1"), F.levenshtein(rest("a"), rest("b"))).otherwise(F.levenshtein(a, b))
    return 1 - edits.cast("double") / F.greatest(F.length(a), F.length(b), F.lit(1))


def parted_keys(left: DataFrame, right: DataFrame, keys: tuple[str, ...], task: int, small: str, large: str, few: int = 0) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """left and right with two columns for each key, after the names' begins small and large: its value where its block is small, and
    where it is large; the large blocks, whose key_type is the key's place in keys; and the keys that have some, none where these make up to `few` pairs in all."""
    narrow = lambda df: long_keys(df, keys, "x").select("key_type", "key_value")
    blocks = large_blocks(narrow(left), narrow(right), task)
    kinds = {r["key_type"]: r["pairs"] for r in blocks.groupBy("key_type").agg(F.sum("pairs").alias("pairs")).collect()}  # as many as keys at most
    if sum(kinds.values()) <= few:
        return left, right, blocks, []
    for n, key in enumerate(keys):
        if n not in kinds:
            left, right = (df.withColumns({f"{small}{key}": F.col(key), f"{large}{key}": F.lit(None).cast(df.schema[key].dataType)}) for df in (left, right))
            continue
        own = blocks.where(F.col("key_type") == n).select(F.col("key_value").alias("__value"))
        mark = lambda df: df.join(F.broadcast(own), F.col(key) == F.col("__value"), "left").withColumn(f"{small}{key}", F.when(F.col("__value").isNull(), F.col(key))).withColumnRenamed("__value", f"{large}{key}")  # noqa: B023, E731
        left, right = mark(left), mark(right)
    return left, right, blocks, [keys[n] for n in sorted(kinds)]


def alike_pairs(left: DataFrame, right: DataFrame, blocks: DataFrame, columns: tuple[str, ...], k: int, within: bool) -> DataFrame:
    """(a_id, b_id): for each left record the k right ones of the most alike names in each of its large blocks, ties to the lower id, and
    some more. columns: those of the blocks' keys, by their key_type. A task holds a cell's records."""
    cut = in_parts(blocks, CELL_LEFT, CELL_RIGHT)
    cells = ["key_type", "key_value", "l", "r"]
    n = DEALS * left.sparkSession.sparkContext.defaultParallelism
    side = lambda df, s, own, other: in_cells(long_keys(df, columns, s, ("name_norm",)), cut, own, other, f"{s}_id").select(f"{s}_id", f"{s}_name_norm", *cells).repartition(n, *cells).groupBy(*cells)
    kind = left.schema["id"].dataType.simpleString()

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return alike.in_cell(left, right, k, within)

    return side(left, "a", "l", "r").cogroup(side(right, "b", "r", "l")).applyInArrow(compare, f"a_id {kind}, b_id {right.schema['id'].dataType.simpleString()}")


def without_large_blocks(left: DataFrame, right: DataFrame, k: int, weights: Mapping[str, float], keys: tuple[str, ...], within: bool, task: int) -> tuple[DataFrame, DataFrame, tuple[str, ...], DataFrame | None]:
    """(left, right, keys, pairs): records with keys whose blocks are small, and pairs beside those that share one of these, so that
    both have each left record's k best partners. pairs is null, and the rest as given, where there are no large blocks.

    Let E be the keys of large blocks that a pair shares, if it shares no others, and W those of them that have a weight. Right records
    that share W too and whose name is more alike rank higher, as no weight is negative. So if the pair is among the k best, it is also
    among the k most alike of the block of W, or of any key of E if W is empty. So a key of a large block is as good as one search of its
    block for names, and sets of two or more such keys with a weight are keys of their own, of small blocks or large ones.
    """
    if min(weights.values(), default=0) < 0 or not set(weights) <= set(keys):
        return left, right, keys, None
    a, b, blocks, large = parted_keys(left, right, keys, task, "__s_", "__l_", FEW_PAIRS)
    if not large:
        return left, right, keys, None
    found = [alike_pairs(a, b, blocks, tuple(f"__l_{key}" for key in keys), k, within)]
    spare = tuple(f"__s_{key}" for key in keys)
    heavy = [key for key in large if weights.get(key)]
    sets = {f"__set{n}": own for n, own in enumerate(own for size in range(2, len(heavy) + 1) for own in combinations(heavy, size))}
    if sets:
        for name, own in sets.items():
            value = [F.col(f"__l_{key}").cast("string") for key in own]
            both = F.when(F.least(*[v.isNotNull().cast("int") for v in value]) == 1, F.to_json(F.array(*value)))
            a, b = a.withColumn(name, both), b.withColumn(name, both)
        a, b, blocks, wide = parted_keys(a, b, tuple(sets), task, "__s_", "__l_")
        if wide:
            found.append(alike_pairs(a, b, blocks, tuple(f"__l_{name}" for name in sets), k, within))
        spare += tuple(f"__s_{name}" if wide else name for name in sets)
    pairs = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return a, b, spare, stored(pairs.distinct(), "alike")


FLAGS = {"vat_equal": "vat_digits", "domain_equal": "domain_root", "postcode_equal": "postcode_norm"}


def best_partners(left: DataFrame, right: DataFrame, k: int, weights: Mapping[str, float] = WEIGHTS, keys: tuple[str, ...] = KEYS, within: bool = False, also: DataFrame | None = None, score: str | None = None, task: int = ALIKE_PAIRS) -> DataFrame:
    """(a_id, b_id, name_sim, …_equal[, score], candidate_rank): the k best partners of every left record among those that share a key with it, by
    the similarity of names and what equal keys add; ties go to the lower id. A pair without a usable name ranks by its keys.

    Each task of the join keeps the k best that it has of a record, and only these are shuffled. also: more pairs (a_id, b_id), each
    once, such as those of near embeddings; those that share a key are there anyway. score: the name of a column for what pairs are ranked by.
    Blocks of more than `task` pairs are searched for alike names instead, see `without_large_blocks`.
    """
    columns = tuple(dict.fromkeys(("name_norm", "name_token1", *weights)))
    a, b, small, alike_ones = without_large_blocks(left, right, k, weights, keys, within, task)
    pairs = blocked(a, b, small, within, columns)
    if also is not None:
        own = lambda df, s: df.select(*[F.col(c).alias(f"{s}_{c}") for c in dict.fromkeys(("id", *keys, *columns))])
        apart = (F.col("a_id") < F.col("b_id")) if within else F.lit(True)
        for c in keys:
            apart = apart & ~F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False))
        pairs = pairs.unionByName(also.select("a_id", "b_id").join(own(left, "a"), "a_id").join(own(right, "b"), "b_id").where(apart))
    ranked = ranked_pairs(pairs, weights, k)
    if alike_ones is not None:
        own = lambda df, s: df.select(F.col("id").alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in columns])
        more = ranked_pairs(alike_ones.join(own(left, "a"), "a_id").join(own(right, "b"), "b_id"), weights, k)
        ranked = best_of(ranked.unionByName(more).drop("candidate_rank").dropDuplicates(["a_id", "b_id"]), "__score", k)
    return ranked.withColumnRenamed("__score", score) if score else ranked.drop("__score")


def ranked_pairs(pairs: DataFrame, weights: Mapping[str, float], k: int) -> DataFrame:
    """(a_id, b_id, name_sim, …_equal, __score, candidate_rank): the k best of pairs with both sides' columns."""
    rows = pairs.withColumn("name_sim", pair_similarity())
    equal: dict[str, Column] = {c: F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False)) for c in weights}
    total = F.coalesce("name_sim", F.lit(0.0))
    for c, weight in weights.items():
        total = total + F.when(equal[c], weight).otherwise(0.0)
    kept = [equal[c].alias(f) for f, c in FLAGS.items() if c in equal]
    return best_of(rows.select("a_id", "b_id", "name_sim", *kept, total.alias("__score")), "__score", k)


def best_of(pairs: DataFrame, score: str, k: int) -> DataFrame:
    """The k pairs of the highest score of every left record, with candidate_rank."""
    order = Window.partitionBy("a_id").orderBy(F.desc(score), "b_id")
    return pairs.withColumn("candidate_rank", F.row_number().over(order)).where(F.col("candidate_rank") <= k)


def candidates(
    left: DataFrame, right: DataFrame, k: int, kind: str, within: bool = False, keys: tuple[str, ...] = KEYS, weights: Mapping[str, float] = WEIGHTS, also: DataFrame | None = None
) -> DataFrame:
    """Candidate pairs of one kind with both sides' fields. also: pairs (a_id, b_id) to rank beside those that share a key."""
    best = best_partners(left, right, k, weights, keys, within, also)
    side = lambda df, s: df.select(F.col("id").alias(f"{s}_id"), F.col("name").alias(f"{s}_name"), F.col("full_address").alias(f"{s}_address"), F.col("country").alias(f"{s}_country"), F.col("website").alias(f"{s}_website"), F.col("vat_id").alias(f"{s}_vat"))
    rows = best.join(side(left, "a"), "a_id").join(side(right, "b"), "b_id").withColumn("pair_kind", F.lit(kind))
    fields = ("name", "address", "country", "website", "vat")
    return rows.select("pair_kind", "a_id", "b_id", "name_sim", "vat_equal", "domain_equal", "postcode_equal", "candidate_rank", *[f"a_{f}" for f in fields], *[f"b_{f}" for f in fields])


def candidate_pairs(
    master: DataFrame, incoming: DataFrame, master_k: int = 5, dedup_k: int = 3, keys: tuple[str, ...] = KEYS, also_master: DataFrame | None = None, also_dedup: DataFrame | None = None
) -> DataFrame:
    """All pairs to decide, numbered: every incoming record's best companies, then its best fellows. Both tables have keys, which are
    written once, in as many files as there are cores: a block makes far more work than its records have bytes. also_…: pairs that no
    key connects, such as those of `neighbours.nearest`, each once."""
    cores = incoming.sparkSession.sparkContext.defaultParallelism
    master, incoming = stored(evenly(master, cores), "keys"), stored(evenly(incoming, cores), "keys")
    to_master = candidates(incoming, master, master_k, "MASTER", keys=keys, also=also_master)
    to_fellow = candidates(incoming, incoming, dedup_k, "DEDUP", within=True, keys=keys, also=also_dedup)
    return dense_ids(to_master.unionByName(to_fellow), [F.desc("pair_kind"), "a_id", "candidate_rank"], "pair_id")


def candidate_report(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """(variation_type, records, candidate_recall, pairs): per type and in all, how often the true company is a candidate.

    Recall counts records that have a true company. A last row counts the pairs among incoming records.
    """
    of = pairs.where("pair_kind = 'MASTER'")
    rows = truth.join(of, of["a_id"] == truth["incoming_id"], "left")
    per = rows.groupBy("incoming_id", "variation_type", "true_company_number").agg(F.count("b_id").alias("pairs"), F.max(F.when(F.col("b_id") == F.col("true_company_number"), 1).otherwise(0)).alias("hit"))
    total = per.rollup("variation_type").agg(
        F.grouping("variation_type").alias("g"), F.count("*").alias("records"), F.avg(F.when(F.col("true_company_number").isNotNull(), F.col("hit"))).alias("candidate_recall"), F.sum("pairs").alias("pairs")
    )
    report = total.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("variation_type")).alias("variation_type"), "records", "candidate_recall", "pairs", "g")
    dedup = pairs.where("pair_kind = 'DEDUP'").agg(F.countDistinct("a_id").alias("records"), F.count("*").alias("pairs"))
    dedup = dedup.select(F.lit("DEDUP").alias("variation_type"), "records", F.lit(None).cast("double").alias("candidate_recall"), "pairs", F.lit(2).alias("g"))
    return report.unionByName(dedup).orderBy("g", "variation_type").drop("g")


def find_candidates(master: DataFrame, incoming: DataFrame, truth: DataFrame, master_fields: Fields = MASTER, incoming_fields: Fields = INCOMING, **given) -> tuple[DataFrame, DataFrame]:
    """(pairs, report) of two record tables: the candidate step as a whole."""
    pairs = stored(candidate_pairs(with_keys(master, master_fields), with_keys(incoming, incoming_fields), **given), "pairs")
    return pairs, candidate_report(pairs, truth)

"""Queries over the driver's tables, each named after the operators that it runs, and the SQL that gives the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probalink.functions import hashing, normalize
from probalink.operators import decide, graph, ids, linkage, resolve
from probalink.plans import standins as s
from probalink.sources import tables as t
from probalink.sources.storage import stored

QUESTION = "Is this invoice likely to be paid late?"
INVOICE_MODEL = decide.Inside(decide.HashModel(("id", "service_line", "country", "client")), "invoice")
TICKET_MODEL = decide.HashModel(("document",))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable[[SparkSession, str], DataFrame]], Callable[[SparkSession, str], DataFrame]]:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def share_sql(*parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"CAST(CAST(('0x' || substr(md5({joined}), 1, 8)) AS BIGINT) AS DOUBLE) / CAST(4294967295 AS DOUBLE)"


# ---- rows and documents

SCORED_SQL = f"SELECT *, {share_sql(f"'{QUESTION}'", 'id_invoice', 'service', 'country', 'client')} AS p_true FROM ({s.INVOICES_SQL})"


@query(f"SELECT * FROM ({SCORED_SQL}) WHERE p_true >= 0.5")
def classify_rows_u3_u11_p2_o1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.classify_rows(s.invoices(spark, sf_dir), QUESTION, INVOICE_MODEL, instances=spark.sparkContext.defaultParallelism)


@query(f"SELECT country, count(*) AS n, avg(p_true) AS mean_p, count(CASE WHEN p_true >= 0.5 THEN 1 END) AS likely FROM ({SCORED_SQL}) GROUP BY country")
def score_rows_u3_a1_a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = decide.distinct_scored(s.invoices(spark, sf_dir), QUESTION, INVOICE_MODEL, ("id_invoice", "service", "country", "client"), state=InvoiceKey(), instances=spark.sparkContext.defaultParallelism)
    return scored.groupBy("country").agg(F.count("*").alias("n"), F.avg("p_true").alias("mean_p"), F.count(F.when(F.col("p_true") >= 0.5, 1)).alias("likely"))


class InvoiceKey:
    """What distinguishes the invoices' states for INVOICE_MODEL."""

    def __call__(self, row: dict) -> dict:
        return {"invoice": {"id": row["id_invoice"], "service_line": row["service"], "country": row["country"], "client": row["client"]}}


def options_sql(instructions: str, options: tuple[str, ...]) -> str:
    return ", ".join(f"{share_sql(f"'{instructions}'", f"'{o}'", 'text')} + CAST(1e-9 AS DOUBLE) AS w{k}" for k, o in enumerate(options))


TICKETS_SQL = f"""SELECT conv_id, turn, billing, CASE WHEN c0 >= c1 AND c0 >= c2 THEN 'calm' WHEN c1 >= c2 THEN 'frustrated' ELSE 'angry' END AS tone, greatest(c0, c1, c2) AS tone_confidence,
  CAST(0 AS DOUBLE) * u0 + CAST(1 AS DOUBLE) * u1 + CAST(2 AS DOUBLE) * u2 AS urgency, greatest(u0, u1, u2) AS urgency_confidence, CAST(NULL AS VARCHAR) AS error FROM
  (SELECT *, t.w0 / (t.w0 + t.w1 + t.w2) AS c0, t.w1 / (t.w0 + t.w1 + t.w2) AS c1, t.w2 / (t.w0 + t.w1 + t.w2) AS c2, u.w0 / (u.w0 + u.w1 + u.w2) AS u0, u.w1 / (u.w0 + u.w1 + u.w2) AS u1, u.w2 / (u.w0 + u.w1 + u.w2) AS u2
   FROM (SELECT conv_id, turn, {share_sql("'Is this ticket about billing?'", 'text')} AS billing, struct_pack(w0 := tw0, w1 := tw1, w2 := tw2) AS t, struct_pack(w0 := uw0, w1 := uw1, w2 := uw2) AS u FROM
    (SELECT conv_id, turn, text, {options_sql("What is the customer''s tone?", ("calm", "frustrated", "angry")).replace(' AS w', ' AS tw')}, {options_sql("How urgent is this ticket?", ("can wait", "this week", "today")).replace(' AS w', ' AS uw')} FROM conversations)))"""


@query(TICKETS_SQL)
def classify_batch_u2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = s.table(spark, sf_dir, "conversations").select(F.struct("conv_id", "turn").alias("id"), F.col("text").alias("document"))
    found = decide.classify_batch(rows, TICKET_MODEL)
    return found.select("id.conv_id", "id.turn", "billing", "tone", "tone_confidence", "urgency", "urgency_confidence", "error")


# ---- keys and candidates


@query(s.with_ctes("keyed", "SELECT id, name_norm, name_token1, postcode_norm, address_key, vat_digits, domain_root, full_address FROM keyed"))
def record_keys_l1_l8(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["id", "name_norm", "name_token1", "postcode_norm", "address_key", "vat_digits", "domain_root", "full_address"]
    master, incoming = s.keys(spark, sf_dir)
    return master.select(names).unionByName(incoming.select(names))


@query(f"SELECT page_id, {s.domain_sql('url')} AS domain_root FROM pages")
def domain_root_l6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.table(spark, sf_dir, "pages").select("page_id", normalize.domain_root(F.col("url")).alias("domain_root"))


@query(s.with_ctes("blocks", "SELECT a_id, b_id FROM blocks WHERE pair_kind = 'MASTER'"))
def blocking_l10_j1_u1_x1(spark: SparkSession, sf_dir: str) -> DataFrame:
    master, incoming = s.keys(spark, sf_dir)
    return linkage.blocked(incoming, master).select("a_id", "b_id")


def pairs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.candidate_pairs(*s.keys(spark, sf_dir))


PAIR_COLUMNS = "pair_id, pair_kind, a_id, b_id, name_sim, vat_equal, domain_equal, postcode_equal, candidate_rank, a_name, a_address, a_country, a_website, a_vat, b_name, b_address, b_country, b_website, b_vat"


@query(s.with_ctes("pairs", f"SELECT {PAIR_COLUMNS} FROM pairs"))
def candidate_pairs_l9_l12_w1_w4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_of(spark, sf_dir).select(*PAIR_COLUMNS.split(", "))


@query(s.with_ctes("pairs", """, per AS (SELECT incoming_id, variation_type, true_company_number, count(b_id) AS pairs, max(CASE WHEN b_id = true_company_number THEN 1 ELSE 0 END) AS hit FROM truth LEFT JOIN pairs ON pair_kind = 'MASTER' AND a_id = incoming_id GROUP BY ALL)
SELECT CASE WHEN grouping(variation_type) = 1 THEN 'ALL' ELSE variation_type END AS variation_type, count(*) AS records, avg(CASE WHEN true_company_number IS NOT NULL THEN hit END) AS candidate_recall, CAST(sum(pairs) AS BIGINT) AS pairs FROM per GROUP BY GROUPING SETS ((variation_type), ())
UNION ALL SELECT 'DEDUP', count(DISTINCT a_id), NULL, count(*) FROM pairs WHERE pair_kind = 'DEDUP'""").replace("\n, per", ",\nper"))  # fmt: skip
def candidate_report_l13_a4_a5_a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.candidate_report(stored(pairs_of(spark, sf_dir), "pairs"), s.truth(spark, sf_dir))


# ---- resolution


class Unlucky:
    """Picks the pairs whose first record's name has an MD5 that begins with 0: their first call fails."""

    def __call__(self, state: dict) -> bool:
        return hashlib.md5(state["record_a"]["name"].encode()).hexdigest()[0] == "0"


def scored_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs scored by a model that fails for some at first and answers when it is asked again."""
    return decide.score_pairs(pairs, decide.FailingModel(decide.SimilarityModel(), Unlucky()), decide.SimilarityModel())


def resolution(spark: SparkSession, sf_dir: str) -> resolve.Resolution:
    pairs = stored(pairs_of(spark, sf_dir), "pairs")
    return resolve.resolve(s.incoming(spark, sf_dir), s.master(spark, sf_dir), s.truth(spark, sf_dir), pairs, decide.FailingModel(decide.SimilarityModel(), Unlucky()), retry=decide.SimilarityModel())


DECISION_COLUMNS = "pair_id, pair_kind, a_id, b_id, candidate_rank, name_sim, vat_equal, domain_equal, postcode_equal, p_same, p_name, p_address, p_website, p_vat, model_match, baseline_match"


@query(s.with_ctes("decisions", f"SELECT {DECISION_COLUMNS} FROM decisions"))
def pair_decisions_u4_l14_l15_p3_p4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = stored(pairs_of(spark, sf_dir), "pairs")
    return resolve.pair_decisions(pairs, scored_pairs(pairs)).select(*DECISION_COLUMNS.split(", "))


@query(s.with_ctes("likeness", """SELECT pair_id, CASE WHEN NOT failed THEN p_name END AS p_name, CASE WHEN NOT failed THEN p_address END AS p_address, CASE WHEN NOT failed THEN p_website END AS p_website,
CASE WHEN NOT failed THEN p_vat END AS p_vat, CASE WHEN failed THEN 'ConnectionError: no answer' END AS error FROM (SELECT *, md5(a_name) LIKE '0%' AS failed FROM likeness)"""))
def pair_questions_u5_u6_u7_u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that both records have are asked about, and a failed call is its pair's error alone."""
    pairs = stored(pairs_of(spark, sf_dir), "pairs")
    found = decide.ask_pairs(pairs, decide.FailingModel(decide.SimilarityModel(), Unlucky()), spark.sparkContext.defaultParallelism)
    return found.select("pair_id", "p_name", "p_address", "p_website", "p_vat", "error")


@query(s.with_ctes("best", "SELECT * FROM best"))
def best_match_l16_w2_w3_j6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = stored(pairs_of(spark, sf_dir), "pairs")
    decisions = stored(resolve.pair_decisions(pairs, scored_pairs(pairs)), "decisions")
    return resolve.best_match(s.incoming(spark, sf_dir), decisions)


@query(s.with_ctes("clusters", "SELECT * FROM clusters"))
def clusters_l17_x7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution(spark, sf_dir).clusters


RESULT_SQL = """SELECT i.incoming_id, source_system, record_name, address, postcode, website, vat_id, model_company_number AS matched_company_number, company_name AS matched_company_name, p_same, p_name, p_address, p_website, p_vat, cluster_id
FROM (SELECT * FROM incoming) i JOIN best USING (incoming_id) LEFT JOIN (SELECT company_number, company_name FROM master) m ON m.company_number = model_company_number
LEFT JOIN (SELECT a_id, b_id, p_same, p_name, p_address, p_website, p_vat FROM decisions WHERE pair_kind = 'MASTER') d ON d.a_id = i.incoming_id AND d.b_id = model_company_number LEFT JOIN clusters c ON c.incoming_id = i.incoming_id AND matcher = 'MODEL'"""


@query(s.with_ctes("clusters", RESULT_SQL))
def match_results_l18_j9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution(spark, sf_dir).results


@query(s.with_ctes("matches", "SELECT * FROM matches"))
def match_evaluation_l19_j8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution(spark, sf_dir).matches


@query(s.with_ctes("dedup", "SELECT * FROM dedup"))
def dedup_evaluation_l20_a12_j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution(spark, sf_dir).dedup


@query(s.with_ctes("dedup", """SELECT 'ACCURACY ' || variation_type AS metric, records, candidate_ceiling, model_accuracy AS model, baseline_accuracy AS baseline FROM matches
UNION ALL SELECT 'DEDUP PRECISION', max(true_duplicate_pairs), NULL, max(CASE WHEN matcher = 'MODEL' THEN pair_precision END), max(CASE WHEN matcher = 'BASELINE' THEN pair_precision END) FROM dedup
UNION ALL SELECT 'DEDUP RECALL', max(true_duplicate_pairs), NULL, max(CASE WHEN matcher = 'MODEL' THEN pair_recall END), max(CASE WHEN matcher = 'BASELINE' THEN pair_recall END) FROM dedup"""))  # fmt: skip
def metric_report_l21_a7_u3_o2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution(spark, sf_dir).report


def decided_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = stored(pairs_of(spark, sf_dir), "pairs")
    return stored(resolve.pair_decisions(pairs, scored_pairs(pairs)), "decisions")


@query(s.with_ctes("decisions", """, top AS (SELECT a_id, b_id, p_same FROM decisions WHERE pair_kind = 'MASTER' AND p_same IS NOT NULL QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY p_same DESC, b_id) = 1),
hits AS (SELECT threshold, variation_type, CASE WHEN (CASE WHEN p_same >= threshold THEN b_id END) IS NOT DISTINCT FROM true_company_number THEN 1.0 ELSE 0.0 END AS hit FROM truth LEFT JOIN top ON a_id = incoming_id, (SELECT unnest([CAST(0.5 AS DOUBLE), 0.6, 0.7, 0.8, 0.9]) AS threshold))
SELECT threshold, variation_type, count(*) AS records, avg(hit) AS accuracy FROM hits GROUP BY ALL UNION ALL SELECT threshold, 'ALL', count(*), avg(hit) FROM hits GROUP BY threshold""").replace("\n, top", ",\ntop"))  # fmt: skip
def threshold_sweep_l22_x10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.threshold_sweep(s.incoming(spark, sf_dir), s.truth(spark, sf_dir), decided_pairs(spark, sf_dir))


@query(s.with_ctes("decisions", "SELECT CASE WHEN p_same >= 0.8 THEN 'match' WHEN p_same >= 0.5 THEN 'review' ELSE 'no match' END AS band, count(*) AS pairs FROM decisions GROUP BY band"))
def review_band_l24_p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.review_band(decided_pairs(spark, sf_dir)).groupBy("band").agg(F.count("*").alias("pairs"))


# ---- identifiers, splits, samples, updates


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders")
def dense_ids_w4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.dense_ids(s.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], "n").select("o_orderkey", "n")


MD5_MOD_SQL = "((CAST(('0x' || substr(md5(c_name), 1, 16)) AS HUGEINT) % 1000) * (18446744073709551616 % 1000) + CAST(('0x' || substr(md5(c_name), 17, 16)) AS HUGEINT) % 1000) % 1000"


@query(f"SELECT c_custkey, CAST({MD5_MOD_SQL} AS BIGINT) AS bucket, {MD5_MOD_SQL} = 0 AS held_out FROM customer")
def hash_split_p12_f13_f14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = s.table(spark, sf_dir, "customer")
    kept, out = hashing.split(rows, "c_name")
    both = kept.withColumn("held_out", F.lit(False)).unionByName(out.withColumn("held_out", F.lit(True)))
    return both.select("c_custkey", hashing.md5_mod(1000, F.col("c_name")).alias("bucket"), "held_out")


@query("SELECT p_partkey, p_name FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR) || '42'), p_partkey LIMIT 100")
def hash_sample_o3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.hash_sample(s.table(spark, sf_dir, "part"), "p_partkey", "42", 100).select("p_partkey", "p_name")


@query("SELECT s_suppkey, printf('IN-%05d', row_number() OVER (ORDER BY md5(CAST(s_suppkey AS VARCHAR) || '42'), s_suppkey)) AS incoming_id FROM supplier")
def hash_order_o6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.hash_numbered(s.table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", "42", "incoming_id")


@query("SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN nullif(c_acctbal, o_totalprice) ELSE o_totalprice END AS o_totalprice, CASE WHEN c_custkey IS NOT NULL THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN customer ON o_orderkey = c_custkey")
def merge_s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = s.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderstatus"))
    return t.merged(s.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), updates, "o_orderkey", ["o_totalprice", "o_orderstatus"])


# ---- relational and scalar operators


@query("""SELECT o_orderkey, o_orderstatus IN ('F', 'O') AS settled, o_orderpriority LIKE '1-%' AS urgent, coalesce(o_totalprice >= 200000, FALSE) AS large, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'middle' ELSE 'large' END AS size
FROM orders WHERE o_orderdate IS NOT NULL AND o_orderstatus NOT IN ('X') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ORDER BY o_totalprice DESC, o_orderkey""")  # fmt: skip
def filters_p1_p5_p6_p7_p8_p9_j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = s.table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    rows = s.table(spark, sf_dir, "orders").where(F.col("o_orderdate").isNotNull() & ~F.col("o_orderstatus").isin("X")).join(rich, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    price = F.col("o_totalprice")
    size = F.when(price < 50000, "small").when(price < 200000, "middle").otherwise("large").alias("size")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", F.col("o_orderstatus").isin("F", "O").alias("settled"), F.col("o_orderpriority").like("1-%").alias("urgent"), resolve.at_least(price, 200000).alias("large"), size)


@query("""SELECT s_suppkey, s_name, n_name, r_name, c.n AS customers, o.total FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) c ON c_nationkey = s_nationkey CROSS JOIN (SELECT count(*) AS total FROM orders) o WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.095 AND l_tax > 0.075 AND l_suppkey IS NOT NULL)""")  # fmt: skip
def joins_j4_j5_j7_j12_j14_j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = lambda n: s.table(spark, sf_dir, n)
    large = x("lineitem").where("l_quantity > 49 AND l_discount > 0.095 AND l_tax > 0.075").select("l_suppkey").distinct()
    regions = x("region").where("r_name <> 'ASIA'").select("r_regionkey", "r_name")
    counts = x("customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    rows = x("supplier").join(large, F.col("s_suppkey") == F.col("l_suppkey"), "left_anti").join(x("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left").join(counts, F.col("c_nationkey") == F.col("s_nationkey"), "left")
    return rows.crossJoin(F.broadcast(x("orders").agg(F.count("*").alias("total")))).select("s_suppkey", "s_name", "n_name", "r_name", "customers", "total")  # one row


@query("""SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS flag, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, sum(l_quantity) AS quantity, avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) AS finished,
max(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS discounted, min(l_shipdate) AS first, max(CASE WHEN l_linestatus = 'O' THEN l_tax END) AS open_tax FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ()) HAVING count(*) > 1""")  # fmt: skip
def aggregates_a1_a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = s.table(spark, sf_dir, "lineitem").rollup("l_returnflag").agg(
        F.grouping("l_returnflag").alias("g"), F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("suppliers"), F.sum("l_quantity").alias("quantity"), F.avg(F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)).alias("finished"),
        F.max(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("discounted"), F.min("l_shipdate").alias("first"), F.max(F.when(F.col("l_linestatus") == "O", F.col("l_tax"))).alias("open_tax"),
    )
    return total.where("n > 1").select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("l_returnflag")).alias("flag"), "n", "suppliers", "quantity", "finished", "discounted", "first", "open_tax")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 3")
def top_k_w1_x3(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return s.table(spark, sf_dir, "events").withColumn("r", F.row_number().over(order)).where("r <= 3").select("user_id", "event_id", "event_type", "value")


@query("SELECT n_nationkey AS k, 'nation' AS kind FROM nation UNION ALL (SELECT c_nationkey, 'used' FROM customer UNION SELECT s_nationkey, 'used' FROM supplier) UNION ALL (SELECT CAST(c_custkey AS INT), 'only' FROM customer EXCEPT SELECT CAST(s_suppkey AS INT), 'only' FROM supplier)")
def sets_u1_u4_a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = lambda n, c, kind: s.table(spark, sf_dir, n).select(F.col(c).cast("int").alias("k"), F.lit(kind).alias("kind"))
    used = x("customer", "c_nationkey", "used").union(x("supplier", "s_nationkey", "used")).distinct()
    return x("nation", "n_nationkey", "nation").unionByName(used).unionByName(x("customer", "c_custkey", "only").subtract(x("supplier", "s_suppkey", "only")))


@query(r"""SELECT c_custkey, upper(c_name) AS u, lower(c_name) AS l, trim(' ' || c_name || ' ') AS t, replace(c_name, '#', '-') AS r, regexp_replace(c_name, '([A-Za-z]+)#0*([0-9]*)', '\2 \1') AS turned, nullif(regexp_extract(c_name, '[1-9][0-9]*'), '') AS found,
substr(c_name, 1, 12) AS s, length(c_name) AS n, levenshtein(c_name, c_mktsegment) AS distance, c_name || '/' || c_mktsegment AS j, coalesce(nullif(c_mktsegment, 'BUILDING'), '-') AS c, greatest(c_nationkey, 7) AS g, least(c_nationkey, 7) AS m, CAST(c_custkey AS DOUBLE) AS d,
CAST(c_custkey % 4 AS BIGINT) AS modulus, md5(c_name) AS h FROM customer""")  # fmt: skip
def scalars_f1_f14_f18(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, segment, nation = F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")
    return s.table(spark, sf_dir, "customer").select(
        "c_custkey", F.upper(name).alias("u"), F.lower(name).alias("l"), F.trim(F.concat(F.lit(" "), name, F.lit(" "))).alias("t"), F.replace(name, F.lit("#"), F.lit("-")).alias("r"),
        F.regexp_replace(name, "([A-Za-z]+)#0*([0-9]*)", "$2 $1").alias("turned"), F.regexp_substr(name, F.lit("[1-9][0-9]*")).alias("found"), F.substring(name, 1, 12).alias("s"), F.length(name).cast("long").alias("n"),
        F.levenshtein(name, segment).cast("long").alias("distance"), F.concat_ws("/", name, segment).alias("j"), F.coalesce(F.nullif(segment, F.lit("BUILDING")), F.lit("-")).alias("c"),
        F.greatest(nation, F.lit(7)).alias("g"), F.least(nation, F.lit(7)).alias("m"), F.col("c_custkey").cast("double").alias("d"), F.pmod("c_custkey", F.lit(4)).cast("long").alias("modulus"), F.md5(name).alias("h"),
    )


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'c' || o_custkey AS x, 's' || l_suppkey AS y FROM orders JOIN lineitem ON o_orderkey = l_orderkey), b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(node, component) USING KEY (node) AS (SELECT DISTINCT x, x FROM b UNION (SELECT DISTINCT ON (u.node) u.node, v.component FROM recurring.r u JOIN b ON b.x = u.node JOIN r v ON v.node = b.y AND v.component < u.component ORDER BY u.node, v.component))
SELECT node, component FROM r""")  # fmt: skip
def components_l17_a6_j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers that lines of orders connect, over all orders and lines."""
    orders = s.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = s.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    edges = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("a"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("b"))
    return graph.connected_components(edges)

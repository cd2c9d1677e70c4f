"""The driver's tables in the roles of invoices, a company register, incoming records, an answer key and tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probalink.functions.normalize import LEGAL_WORDS
from probalink.operators import linkage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, customer and nation. The id is the order's, so it isn't unique."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("l_orderkey").alias("id_invoice"), F.to_date("o_orderdate").alias("issued_date"), F.col("n_name").alias("country"), F.col("c_mktsegment").alias("service"),
        F.col("l_extendedprice").alias("total"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.col("o_orderstatus").alias("invoice_status"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("balance"), F.to_date("l_shipdate").alias("due_date"), F.col("c_name").alias("client"),
    )


INVOICES_SQL = """SELECT l_orderkey AS id_invoice, CAST(o_orderdate AS DATE) AS issued_date, n_name AS country, c_mktsegment AS service, l_extendedprice AS total,
  l_discount AS discount, l_tax AS tax, o_orderstatus AS invoice_status, l_extendedprice * (1 - l_discount) AS balance, CAST(l_shipdate AS DATE) AS due_date, c_name AS client
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def number(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 9, "0")


def site(balance: str) -> Column:
    return F.concat(F.lit("s"), F.floor(F.abs(balance)).cast("string"), F.lit(".com"))


def code(key: str) -> Column:
    """A postcode of a number."""
    return F.concat(F.lit("AB"), (F.col(key) % 90 + 10).cast("string"), F.lit(" "), (F.col(key) % 9).cast("string"), F.lit("CD"))


def code_sql(key: str) -> str:
    return f"'AB' || ({key} % 90 + 10) || ' ' || ({key} % 9) || 'CD'"


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registered companies; some lack a postcode, website or tax number."""
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    key = number("s_suppkey")
    return rows.select(
        key.alias("company_number"), F.concat(F.replace("n_name", F.lit("_"), F.lit("")), F.lit(" "), key, F.lit(" Ltd.")).alias("company_name"),
        F.concat("n_name", F.lit(" Street "), F.col("s_suppkey").cast("string")).alias("address_line1"), F.lit(None).cast("string").alias("address_line2"), F.col("n_name").alias("post_town"),
        F.lit("").alias("county"), F.when(F.col("s_suppkey") % 4 != 0, code("s_suppkey")).alias("postcode"), F.col("n_name").alias("country"),
        F.when(F.col("s_suppkey") % 6 != 0, F.concat(F.lit("www."), site("s_acctbal"))).alias("website"), F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("GB"), key)).alias("vat_id"),
    )


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as incoming records. Postcodes are in their field, in the address, or nowhere; some records lack an address, website or
    tax number, and some names are legal words alone."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = number("c_custkey")
    number_of = F.col("c_custkey")
    inside = F.when(number_of % 3 == 0, F.concat(F.lit(" "), code("c_custkey"))).otherwise("")
    return rows.select(
        F.concat(F.lit("IN-"), key).alias("incoming_id"), F.col("c_mktsegment").alias("source_system"),
        F.when(number_of % 13 == 5, "The Company Ltd").otherwise(F.concat(F.lower(F.replace("n_name", F.lit("_"), F.lit(""))), F.lit(" "), key)).alias("record_name"),
        F.when(number_of % 11 != 0, F.concat("n_name", F.lit(" Street "), number_of.cast("string"), F.lit(", "), F.col("n_name"), inside)).alias("address"),
        F.when(number_of % 3 == 1, F.lower(F.replace(code("c_custkey"), F.lit(" "), F.lit("")))).alias("postcode"), F.col("n_name").alias("country"),
        F.when(number_of % 5 != 0, F.concat(F.lit("https://www."), site("c_acctbal"), F.lit("/contact"))).alias("website"), F.when(number_of % 7 != 0, F.concat(F.lit("GB"), key)).alias("vat_id"),
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer and the supplier of one number are one company."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    rows = table(spark, sf_dir, "customer").join(suppliers, F.col("c_custkey") == F.col("s_suppkey"), "left")
    return rows.select(F.concat(F.lit("IN-"), number("c_custkey")).alias("incoming_id"), F.col("c_mktsegment").alias("variation_type"), number("s_suppkey").alias("true_company_number"), number("c_custkey").alias("entity_id"))


def keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(master, incoming) with keys."""
    return linkage.with_keys(master(spark, sf_dir), linkage.MASTER), linkage.with_keys(incoming(spark, sf_dir), linkage.INCOMING)


def domain_sql(address: str) -> str:
    """The registered domain, by the host's labels."""
    host = f"regexp_replace(list_last(string_split(split_part(regexp_replace(lower({address}), '^https?://', ''), '/', 1), '@')), '^www[.]', '')"
    labels = f"string_split({host}, '.')"
    return f"CASE WHEN len({labels}) > 1 THEN array_to_string(list_slice({labels}, CASE WHEN {host} LIKE '%.co.uk' THEN -3 ELSE -2 END, -1), '.') END"


#: Parts of one WITH clause, in order.
CTES = {
    "master": """SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS company_number, replace(n_name, '_', '') || ' ' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || ' Ltd.' AS company_name,
  n_name || ' Street ' || s_suppkey AS address_line1, n_name AS post_town, CASE WHEN s_suppkey % 4 <> 0 THEN {supplier_code} END AS postcode, n_name AS country,
  CASE WHEN s_suppkey % 6 <> 0 THEN 'www.s' || CAST(floor(abs(s_acctbal)) AS BIGINT) || '.com' END AS website, CASE WHEN s_suppkey % 9 <> 0 THEN 'GB' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') END AS vat_id FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "incoming": """SELECT 'IN-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS incoming_id, c_mktsegment AS source_system,
  CASE WHEN c_custkey % 13 = 5 THEN 'The Company Ltd' ELSE lower(replace(n_name, '_', '')) || ' ' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS record_name,
  CASE WHEN c_custkey % 11 <> 0 THEN n_name || ' Street ' || c_custkey || ', ' || n_name || CASE WHEN c_custkey % 3 = 0 THEN ' ' || {customer_code} ELSE '' END END AS address,
  CASE WHEN c_custkey % 3 = 1 THEN lower(replace({customer_code}, ' ', '')) END AS postcode, n_name AS country,
  CASE WHEN c_custkey % 5 <> 0 THEN 'https://www.s' || CAST(floor(abs(c_acctbal)) AS BIGINT) || '.com/contact' END AS website,
  CASE WHEN c_custkey % 7 <> 0 THEN 'GB' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS vat_id FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "truth": """SELECT 'IN-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS incoming_id, c_mktsegment AS variation_type, lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS true_company_number,
  lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS entity_id FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
    "named": """SELECT company_number AS id, company_name AS name, address_line1 AS first_line, concat_ws(', ', address_line1, post_town, postcode) AS full_address, postcode, country, website, vat_id, 1 AS side FROM master
  UNION ALL SELECT incoming_id, record_name, address, nullif(concat_ws(', ', address, postcode), ''), postcode, country, website, vat_id, 0 FROM incoming""",
    "keyed": r"""SELECT *, nullif(split_part(name_norm, ' ', 1), '') AS name_token1 FROM (SELECT *,
  nullif(array_to_string(list_filter(string_split(regexp_replace(translate(replace(upper(name), '&', ' AND '), '.''', ''), '[^\p{L}\p{N}]', ' ', 'g'), ' '), lambda w: w NOT IN ('', {legal})), ' '), '') AS name_norm,
  coalesce(replace(upper(postcode), ' ', ''), CASE WHEN side = 0 THEN nullif(replace(regexp_extract(upper(first_line), '\b[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}\b'), ' ', ''), '') END) AS postcode_norm,
  nullif(substr(regexp_replace(upper(first_line), '[^A-Z0-9]', '', 'g'), 1, 12), '') AS address_key,
  nullif(regexp_replace(vat_id, '[^0-9]', '', 'g'), '') AS vat_digits,
  {domain} AS domain_root FROM named)""",
    "k0": "SELECT * FROM keyed WHERE side = 0",
    "k1": "SELECT * FROM keyed WHERE side = 1",
    "blocks": "\n  UNION ".join(
        f"SELECT a.id AS a_id, b.id AS b_id, '{kind}' AS pair_kind FROM k0 a JOIN k{side} b ON a.{key} = b.{key}{more}"
        for kind, side, more in (("MASTER", 1, ""), ("DEDUP", 0, " AND a.id < b.id"))
        for key in linkage.KEYS
    ),
    "pairs": """SELECT *, row_number() OVER (ORDER BY pair_kind DESC, a_id, candidate_rank) AS pair_id FROM (SELECT *, row_number() OVER (PARTITION BY pair_kind, a_id ORDER BY
    coalesce(name_sim, 0) + CASE WHEN vat_equal THEN 1 ELSE 0 END + CASE WHEN domain_equal THEN 1 ELSE 0 END + CASE WHEN postcode_equal THEN 0.5 ELSE 0 END + CASE WHEN address_equal THEN 0.5 ELSE 0 END DESC, b_id) AS candidate_rank
  FROM (SELECT pair_kind, a_id, b_id, 1 - CAST(levenshtein(a.name_norm, b.name_norm) AS DOUBLE) / greatest(length(a.name_norm), length(b.name_norm), 1) AS name_sim,
    coalesce(a.vat_digits = b.vat_digits, FALSE) AS vat_equal, coalesce(a.domain_root = b.domain_root, FALSE) AS domain_equal, coalesce(a.postcode_norm = b.postcode_norm, FALSE) AS postcode_equal,
    coalesce(a.address_key = b.address_key, FALSE) AS address_equal, a.name AS a_name, a.full_address AS a_address, a.country AS a_country, a.website AS a_website, a.vat_id AS a_vat,
    b.name AS b_name, b.full_address AS b_address, b.country AS b_country, b.website AS b_website, b.vat_id AS b_vat
    FROM blocks JOIN keyed a ON a.id = a_id AND a.side = 0 JOIN keyed b ON b.id = b_id AND b.side = CASE WHEN pair_kind = 'MASTER' THEN 1 ELSE 0 END)) WHERE candidate_rank <= CASE WHEN pair_kind = 'MASTER' THEN 5 ELSE 3 END""",
    "likeness": """SELECT *, 1 - CAST(levenshtein(upper(a_name), upper(b_name)) AS DOUBLE) / greatest(length(a_name), length(b_name), 1) AS p_name, {likeness} FROM pairs""",
    "decisions": """SELECT *, coalesce(p_same >= 0.5, FALSE) AS model_match, vat_equal OR domain_equal OR coalesce(name_sim >= 0.85, FALSE) AS baseline_match FROM
  (SELECT *, (CAST(4 AS DOUBLE) * p_name + coalesce(p_address, 0) + CAST(2 AS DOUBLE) * coalesce(p_website, 0) + CAST(3 AS DOUBLE) * coalesce(p_vat, 0)) /
    (CAST(4 AS DOUBLE) + CASE WHEN p_address IS NULL THEN 0 ELSE 1 END + CASE WHEN p_website IS NULL THEN 0 ELSE 2 END + CASE WHEN p_vat IS NULL THEN 0 ELSE 3 END) AS p_same FROM likeness)""",
    "best": """SELECT incoming_id, m.b_id AS model_company_number, m.p_same AS model_p_same, r.b_id AS baseline_company_number FROM incoming
  LEFT JOIN (SELECT * FROM decisions WHERE pair_kind = 'MASTER' AND model_match QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY p_same DESC, b_id) = 1) m ON m.a_id = incoming_id
  LEFT JOIN (SELECT * FROM decisions WHERE pair_kind = 'MASTER' AND baseline_match QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY vat_equal DESC, domain_equal DESC, name_sim DESC NULLS LAST, b_id) = 1) r ON r.a_id = incoming_id""",
    "links": """SELECT matcher, x, y FROM (SELECT 'MODEL' AS matcher, a_id AS x, b_id AS y FROM decisions WHERE pair_kind = 'DEDUP' AND model_match UNION ALL SELECT 'BASELINE', a_id, b_id FROM decisions WHERE pair_kind = 'DEDUP' AND baseline_match
  UNION ALL SELECT 'MODEL', incoming_id, 'M:' || model_company_number FROM best WHERE model_company_number IS NOT NULL UNION ALL SELECT 'BASELINE', incoming_id, 'M:' || baseline_company_number FROM best WHERE baseline_company_number IS NOT NULL)""",
    "two_way": "SELECT matcher, x, y FROM links UNION SELECT matcher, y, x FROM links",
    "reached": """SELECT matcher, incoming_id AS x, incoming_id AS y FROM incoming, (VALUES ('MODEL'), ('BASELINE')) v(matcher)
  UNION SELECT r.matcher, r.x, b.y FROM reached r JOIN two_way b ON b.matcher = r.matcher AND b.x = r.y""",
    "clusters": "SELECT matcher, x AS incoming_id, min(y) AS cluster_id FROM reached WHERE y LIKE 'IN-%' GROUP BY matcher, x",
    "matches": """SELECT CASE WHEN grouping(variation_type) = 1 THEN 'ALL' ELSE variation_type END AS variation_type, count(*) AS records,
  avg(CASE WHEN true_company_number IS NULL OR d.a_id IS NOT NULL THEN 1.0 ELSE 0.0 END) AS candidate_ceiling, avg(CASE WHEN model_company_number IS NOT DISTINCT FROM true_company_number THEN 1.0 ELSE 0.0 END) AS model_accuracy,
  avg(CASE WHEN baseline_company_number IS NOT DISTINCT FROM true_company_number THEN 1.0 ELSE 0.0 END) AS baseline_accuracy
  FROM truth JOIN best USING (incoming_id) LEFT JOIN (SELECT DISTINCT a_id, b_id FROM pairs WHERE pair_kind = 'MASTER') d ON d.a_id = incoming_id AND d.b_id = true_company_number GROUP BY GROUPING SETS ((variation_type), ())""",
    "dedup": """SELECT p.matcher, true_duplicate_pairs, predicted_pairs, correct_pairs, CAST(correct_pairs AS DOUBLE) / nullif(predicted_pairs, 0) AS pair_precision, CAST(correct_pairs AS DOUBLE) / nullif(true_duplicate_pairs, 0) AS pair_recall FROM
  (SELECT matcher, CAST(sum(n * (n - 1) // 2) AS BIGINT) AS predicted_pairs FROM (SELECT matcher, count(*) AS n FROM clusters GROUP BY matcher, cluster_id) GROUP BY matcher) p JOIN
  (SELECT matcher, CAST(sum(n * (n - 1) // 2) AS BIGINT) AS correct_pairs FROM (SELECT matcher, count(*) AS n FROM clusters JOIN truth USING (incoming_id) GROUP BY matcher, cluster_id, entity_id) GROUP BY matcher) c ON c.matcher = p.matcher,
  (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS true_duplicate_pairs FROM (SELECT count(*) AS n FROM truth GROUP BY entity_id))""",
}


CTES["master"] = CTES["master"].replace("{supplier_code}", code_sql("s_suppkey"))
CTES["incoming"] = CTES["incoming"].replace("{customer_code}", code_sql("c_custkey"))
#: A field is compared only where both records have it.
CTES["likeness"] = CTES["likeness"].replace("{likeness}", ", ".join(f"CASE WHEN upper(a_{f}) = upper(b_{f}) THEN CAST(1 AS DOUBLE) WHEN upper(a_{f}) <> upper(b_{f}) THEN CAST(0 AS DOUBLE) END AS p_{f}" for f in ("address", "website", "vat")))
CTES["keyed"] = CTES["keyed"].replace("{legal}", ", ".join(f"'{w}'" for w in LEGAL_WORDS)).replace("{domain}", domain_sql("website"))


def with_ctes(last: str, select: str) -> str:
    """select over the parts up to `last`."""
    names = list(CTES)
    parts = names[: names.index(last) + 1]
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in parts) + f"\n{select}"

"""Queries over sources, sinks, SQL surface and generators, and the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probalink.functions import hashing, normalize, vary
from probalink.operators import decide, linkage, neighbours
from probalink.operators.refresh import KeptClusters
from probalink.plans import standins as s
from probalink.plans.queries import MD5_MOD_SQL, TICKET_MODEL, TICKETS_SQL, query, share_sql
from probalink.sources import generate
from probalink.sources import tables as t
from probalink.sources.storage import shared_path, stored
from probalink.sources.versions import VersionedTable

# ---- files


def awkward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a register: cells with quotes, commas and blanks around them, empty cells, and dates."""
    key = F.col("c_custkey")
    rows = s.table(spark, sf_dir, "customer").join(s.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    date = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (key % 9000).cast("int")), "dd/MM/yyyy")
    own = {
        "CompanyNumber": s.number("c_custkey"), "CompanyName": F.concat(F.lit('THE "'), F.col("c_name"), F.lit('", LTD')), "RegAddress.AddressLine1": F.concat(F.lit("  "), key.cast("string"), F.lit(" Ä Road, North ")),
        "RegAddress.AddressLine2": F.when(key % 2 == 0, "").otherwise("Floor 1"), "RegAddress.PostTown": F.col("n_name"), "RegAddress.County": F.lit("   "), "RegAddress.Country": F.lit(None).cast("string"),
        "RegAddress.PostCode": s.code("c_custkey"), "CompanyCategory": F.lit("x"), "CompanyStatus": F.lit("Active"), "IncorporationDate": F.when(key % 5 == 0, "").otherwise(date),
        "SICCode.SicText_1": F.lit("62020 - it's, \"it\""), "PreviousName_1.CompanyName": F.lit(""),
    }
    return rows.select(*[c.alias(f" {n}") for n, c in own.items()], F.lit("more").alias("Unused"))


@query(f"""SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS company_number, 'THE "' || c_name || '", LTD' AS company_name, c_custkey || ' Ä Road, North' AS address_line1, CASE WHEN c_custkey % 2 <> 0 THEN 'Floor 1' END AS address_line2,
n_name AS post_town, CAST(NULL AS VARCHAR) AS county, CAST(NULL AS VARCHAR) AS country, {s.code_sql("c_custkey")} AS postcode, 'x' AS company_category, 'Active' AS company_status,
CASE WHEN c_custkey % 5 <> 0 THEN CAST('1990-01-01' AS DATE) + CAST(c_custkey % 9000 AS INTEGER) END AS incorporation_date, '62020 - it''s, "it"' AS sic_1, CAST(NULL AS VARCHAR) AS previous_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""")  # fmt: skip
def register_csv_s1_f15_s19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register, written as CSV with quoted cells and read back."""
    path = shared_path(spark, "register")
    awkward(spark, sf_dir).write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return t.read_register(spark, path)


INVOICE_COLUMNS = "id_invoice, issued_date, country, service, total, discount, tax, invoice_status, balance, due_date, client"


@query(f"SELECT {INVOICE_COLUMNS}, strftime(issued_date, '%Y-%m-%d') AS issued, inferred FROM ({s.INVOICES_SQL}), (SELECT unnest([FALSE, TRUE]) AS inferred)")
def invoices_csv_s3_s4_f16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices, written as CSV and read back twice: by schema and with inferred types."""
    path = shared_path(spark, "invoices")
    columns = INVOICE_COLUMNS.split(", ")
    t.write_csv(s.invoices(spark, sf_dir), path, columns)
    both = [t.read_invoices(spark, path, infer).select(*[F.col(f.name).cast(f.dataType) for f in t.read_invoices(spark, path).schema], F.lit(infer).alias("inferred")) for infer in (False, True)]
    return both[0].unionByName(both[1]).withColumn("issued", F.date_format("issued_date", "yyyy-MM-dd"))


@query("""SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS company_number, s_name AS registered_name, 'de' AS language, 'Überseehandel, "' || s_name || '" GmbH' AS translated_name, origin FROM supplier, (SELECT unnest(['file']) AS origin)
UNION ALL VALUES ('1', 'A', 'fr', 'Société', 'rows'), ('2', 'B', 'es', NULL, 'rows')""")
def translations_s2_s5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations from a file, and a table of the caller's own rows."""
    path = shared_path(spark, "translations")
    names = s.table(spark, sf_dir, "supplier").select(s.number("s_suppkey").alias("company_number"), F.col("s_name").alias("registered_name"), F.lit("de").alias("language"), F.concat(F.lit('Überseehandel, "'), "s_name", F.lit('" GmbH')).alias("translated_name"))
    names.write.csv(path, header=True, escape='"')
    kind = "company_number STRING, registered_name STRING, language STRING, translated_name STRING"
    own = t.from_rows(spark, [("1", "A", "fr", "Société"), {"company_number": "2", "registered_name": "B", "language": "es", "translated_name": None}], kind)
    return t.append(t.read_translations(spark, path).withColumn("origin", F.lit("file")), own.withColumn("origin", F.lit("rows")))


SCHEMA = "probalink_tables"


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, total FROM orders, (SELECT count(*) AS total FROM orders WHERE o_totalprice > 1000) WHERE o_totalprice > 1000 AND o_orderstatus = 'F' AND o_totalprice <= 200000")
def tables_s6_s7_s9_s12_s14_p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that replaces itself, read through a view by a statement with bound values, and dropped at last."""
    t.create_schema(spark, SCHEMA)
    t.create_schema(spark, SCHEMA)  # a second time changes nothing
    name = f"{SCHEMA}.orders_{uuid.uuid4().hex}"
    view = name.replace(".", "_")
    t.replace_table(s.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), name)
    t.replace_table(spark.table(name).where("o_totalprice > 1000"), name)
    total = t.scalar(spark.table(name).agg(F.count("*")))
    spark.table(name).createOrReplaceTempView(view)
    sql = f"SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(:total AS BIGINT) AS total FROM {view} WHERE o_orderstatus = :status AND o_totalprice <= :most"
    found = stored(spark.sql(sql, args={"total": total, "status": "F", "most": 200000.0}), "view")
    spark.catalog.dropTempView(view)
    t.drop_table(spark, name)
    return found


@query("SELECT o_orderkey, o_totalprice, CAST(round(CAST(o_totalprice AS DECIMAL(18, 2)) / 7, 3) AS DECIMAL(18, 3)) AS seventh FROM orders JOIN (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE l_quantity > 45) ON CAST(o_orderkey AS VARCHAR) = id")
def cast_join_j4_s8_f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined by a text id, as scores that were stored with one are. Every row has an id of its own by its place in the file."""
    orders = t.with_row_id(s.table(spark, sf_dir, "orders"))
    scores = s.table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").cast("string").alias("id")).distinct()
    one = orders.groupBy("row_id").agg(F.count("*").alias("n")).where("n > 1").select("row_id")
    rows = orders.join(scores, F.col("o_orderkey").cast("string") == F.col("id")).join(one, "row_id", "left_anti")
    return rows.select("o_orderkey", "o_totalprice", F.round(F.col("o_totalprice").cast("decimal(18,2)") / 7, 3).cast("decimal(18,3)").alias("seventh"))


VERSIONS_SQL = """WITH first AS (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 10 <> 0),
second AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 3 THEN CASE WHEN o_orderkey % 200 = 3 THEN price + 1 END ELSE price END AS price, status FROM first),
third AS (SELECT * FROM second UNION ALL SELECT o_orderkey, CAST(o_totalprice AS DOUBLE), o_orderstatus FROM orders WHERE o_orderkey % 10 = 0)
SELECT 1 AS version, * FROM first UNION ALL SELECT 2, * FROM second UNION ALL SELECT 3, * FROM third"""


@query(VERSIONS_SQL)
def versions_s7_s10_s11_s19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a table that is replaced, merged into and added to; each version as it was."""
    orders = s.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"), F.col("o_orderstatus").alias("status"))
    table = VersionedTable(spark, shared_path(spark, "orders"))
    key = F.col("o_orderkey")
    table.replace(orders.where(key % 10 != 0).repartitionByRange(4, "o_orderkey"), required=("o_orderkey",))
    updates = orders.where(key % 100 == 3).select("o_orderkey", F.when(key % 200 == 3, F.col("price") + 1).alias("price"))
    table.merge(updates, "o_orderkey", ["price"])
    table.append(orders.where(key % 10 == 0).select("status", "price", "o_orderkey"))
    found = None
    for n in table.versions():
        one = table.read(n).withColumn("version", F.lit(n))
        found = one if found is None else t.append(found, one)
    return found


@query("SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS BIGINT) AS occurrence, CAST(1 AS BIGINT) AS rows_of_id FROM lineitem")
def content_ids_s8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by what they hold of their order and place, which isn't unique: every one gets an id of its own."""
    rows = t.with_content_id(s.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))
    part = lambda n: F.element_at(F.split("row_id", "#"), n)
    rows = rows.select("l_orderkey", "l_linenumber", F.unhex(part(1)).alias("content"), part(2).cast("long").alias("occurrence"))  # the id, in half its bytes
    return rows.select("l_orderkey", "l_linenumber", "occurrence", F.count("*").over(Window.partitionBy("content", "occurrence")).alias("rows_of_id"))


# ---- SQL surface of documents

LITERAL = "My bill is wrong"
DOCUMENTS = f"(SELECT conv_id, turn, text FROM conversations UNION ALL SELECT CAST(-1 AS BIGINT), 0, '{LITERAL}') AS documents"
SCALAR_SQL = TICKETS_SQL.replace("FROM conversations", f"FROM {DOCUMENTS}")


def of_json(answer: str) -> list[Column]:
    value = lambda n: F.get_json_object(answer, f"$.{n}")
    return [value(n).cast(kind).alias(n) for n, kind in (("billing", "double"), ("tone", "string"), ("tone_confidence", "double"), ("urgency", "double"), ("urgency_confidence", "double"))]


@query(f"SELECT conv_id, turn, billing, tone, tone_confidence, urgency, urgency_confidence FROM ({SCALAR_SQL})")
def classify_scalar_u1_f17_p14_s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar function over a table, and in a statement without one."""
    decide.register(spark, TICKET_MODEL)
    s.table(spark, sf_dir, "conversations").createOrReplaceTempView("tickets_to_classify")
    rows = spark.sql("SELECT conv_id, turn, classify(text) AS answer FROM tickets_to_classify")
    one = spark.sql(f"SELECT CAST(-1 AS BIGINT) AS conv_id, 0 AS turn, classify('{LITERAL}') AS answer")
    both = stored(rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("int"), "answer").unionByName(one), "answers")
    return both.select("conv_id", "turn", *of_json("answer"))


@query(f"SELECT conv_id || '-' || turn AS id, billing, tone, tone_confidence, urgency, urgency_confidence, error FROM ({TICKETS_SQL})")
def classify_table_u2_u9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table function, over partitions of a query's rows."""
    decide.register(spark, TICKET_MODEL)
    rows = s.table(spark, sf_dir, "conversations").select(F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("document"))
    rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(8))).createOrReplaceTempView("tickets_in_parts")
    return stored(spark.sql("SELECT * FROM classify_batch(TABLE(SELECT id, document, part FROM tickets_in_parts) PARTITION BY part)"), "answers")


KEPT_SQL = f"""SELECT conv_id, turn, {share_sql("'Is this ticket about billing?'", 'text')} AS billing, asked_first, asked_then FROM conversations,
  (SELECT count(DISTINCT text) FILTER (conv_id % 2 = 0) AS asked_first, count(DISTINCT text) - count(DISTINCT text) FILTER (conv_id % 2 = 0) AS asked_then FROM conversations)"""


@query(KEPT_SQL)
def kept_answers_u3_u9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the tickets are asked about, then all: the second time only about texts that are new."""
    rows = s.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    cache = VersionedTable(spark, shared_path(spark, "answers"))
    questions = {"billing": decide.TICKET_QUESTIONS["billing"]}
    ask = lambda df: decide.cached_answers(df, TICKET_MODEL, questions, decide.Flat("text"), ["text"], cache)
    ask(rows.where("conv_id % 2 = 0"))
    first = cache.read().count()
    found = ask(rows)
    then = cache.read().count() - first
    return found.select("conv_id", "turn", F.col("answer.yes")["billing"].alias("billing"), F.lit(first).cast("long").alias("asked_first"), F.lit(then).cast("long").alias("asked_then"))


# ---- pairs on a scale

LEVELS = decide.PAIR_SCALE["relation"].levels
PAIR_MODEL = decide.HashModel(("record_a", "record_b"))


def record_sql(side: str) -> str:
    """A record as Python writes a dictionary of its texts, without those that are null."""
    fields = zip(decide.PAIR_FIELDS, ("name", "address", "country", "website", "vat"))
    return "'{' || concat_ws(', ', " + ", ".join(f"'''{f}'': ''' || {side}_{c} || ''''" for f, c in fields) + ") || '}'"


WEIGHTS_SQL = ", ".join(share_sql("'How are the two records related?'", f"'{level}'", "state") + f" + CAST(1e-9 AS DOUBLE) AS w{k}" for k, level in enumerate(LEVELS))


@query(s.with_ctes("pairs", f"""SELECT pair_id, CAST(0 AS DOUBLE) * (w0 / (w0 + w1 + w2)) + CAST(1 AS DOUBLE) * (w1 / (w0 + w1 + w2)) + CAST(2 AS DOUBLE) * (w2 / (w0 + w1 + w2)) AS relation,
greatest(w0 / (w0 + w1 + w2), w1 / (w0 + w1 + w2), w2 / (w0 + w1 + w2)) AS relation_confidence, CAST(NULL AS VARCHAR) AS error
FROM (SELECT pair_id, {WEIGHTS_SQL} FROM (SELECT pair_id, {record_sql("a")} || '|' || {record_sql("b")} AS state FROM pairs))"""))
def pair_scale_l25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs on three levels, by a model that hashes all that it is told about both records."""
    pairs = linkage.candidate_pairs(*s.keys(spark, sf_dir))
    return decide.relate_pairs(stored(pairs, "pairs"), PAIR_MODEL)


# ---- candidates by embeddings

#: Vectors with five slightly turned copies each: neighbours that exist at every size of the table.
TURNED_SQL = """SELECT vec_id * 6 + c AS id, list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) + c * CAST(0.01 AS DOUBLE) * CAST((vec_id * 7 + i * 13 + c * 5) % 11 - 5 AS DOUBLE) / CAST(5 AS DOUBLE)) AS v
  FROM embeddings, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS c) WHERE len(embedding) = 64"""


def nearest_sql(vectors: str) -> str:
    """The three nearest of a greater id, by all pairs."""
    return f"""WITH e AS ({vectors}), u AS (SELECT id, v, sqrt(list_inner_product(v, v)) AS n FROM e),
p AS (SELECT a.id AS a_id, b.id AS b_id, list_inner_product(a.v, b.v) / (a.n * b.n) AS cosine FROM u a JOIN u b ON a.id < b.id)
SELECT a_id, b_id, round(cosine, 9) AS cosine, CAST(candidate_rank AS INTEGER) AS candidate_rank FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY cosine DESC, b_id) AS candidate_rank FROM p) WHERE candidate_rank <= 3"""


@query(nearest_sql("SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE len(embedding) = 64"))
def embedding_candidates_l26(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest fellows of every vector, whatever the vectors: nearly random ones have none that windows find."""
    rows = s.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return neighbours.nearest(rows, rows, "embedding", 3, 64, within=True, every=True).withColumn("cosine", F.round("cosine", 9))


@query(f"SELECT a_id, b_id, cosine, candidate_rank FROM ({nearest_sql(TURNED_SQL)}) WHERE cosine >= 0.9")
def embedding_copies_l26(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fellows that are a turned copy, found in the windows of sorted signatures."""
    turn = lambda x, i: x.cast("double") + F.col("c") * F.lit(0.01) * (F.pmod(F.col("vec_id") * 7 + (i + 1) * 13 + F.col("c") * 5, F.lit(11)) - 5).cast("double") / F.lit(5.0)
    copies = s.table(spark, sf_dir, "embeddings").withColumn("c", F.explode(F.array(*map(F.lit, range(6)))))
    rows = copies.select((F.col("vec_id") * 6 + F.col("c")).alias("id"), F.transform("embedding", turn).alias("v"))
    found = neighbours.nearest(rows, rows, "v", 3, 64, within=True, least=0.9, probes=2)
    return found.withColumn("cosine", F.round("cosine", 9))


# ---- scripts

SCRIPT = """
CREATE OR REPLACE TEMP VIEW script_suppliers AS
  SELECT s_suppkey, s_acctbal / 2 AS half, '/' AS slash FROM parquet.`{tables}/supplier.parquet`
/
CREATE OR REPLACE TEMP VIEW script_rich AS SELECT * FROM script_suppliers WHERE half >= :least
/

/
SELECT s_suppkey, half, slash FROM script_rich
/
"""


@query("SELECT s_suppkey, s_acctbal / 2 AS half, '/' AS slash FROM supplier WHERE s_acctbal / 2 >= 1000")
def script_s13_s17_s18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of a script's last statement; its parameters are bound, its folder is put in."""
    return stored(t.run_script(spark, SCRIPT.replace("{tables}", sf_dir), {"least": 1000.0}), "script")


# ---- generators

UNIQUE_COMPANIES = "SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS number, upper(p_name) AS name, p_brand AS town, row_number() OVER (ORDER BY p_partkey) AS position FROM part"


def md5_mod_sql(modulus: int, text: str) -> str:
    half = lambda start: f"CAST(('0x' || substr(md5({text}), {start}, 16)) AS HUGEINT) % {modulus}"
    return f"((({half(1)}) * ({(1 << 64) % modulus}) + {half(17)}) % {modulus})"


KINDS_OF_SITE = ", ".join(f"'{e}'" for e in generate.ENDINGS)
UNIQUE_SQL = f"""WITH RECURSIVE c AS ({UNIQUE_COMPANIES}),
v AS (SELECT number, row_number() OVER (ORDER BY position) AS k, [lpad(CAST({md5_mod_sql(10**9, "'vat|' || number || '|' || salt")} AS VARCHAR), 9, '0') FOR salt IN range(8)] AS offers FROM c WHERE {md5_mod_sql(100, "'vat|' || number")} < {generate.VAT_SHARE}),
vr AS (SELECT CAST(0 AS BIGINT) AS k, CAST('' AS VARCHAR) AS number, CAST('' AS VARCHAR) AS pick, CAST([] AS VARCHAR[]) AS used
  UNION ALL SELECT v.k, v.number, list_filter(v.offers, lambda x: NOT list_contains(vr.used, x))[1], list_append(vr.used, list_filter(v.offers, lambda x: NOT list_contains(vr.used, x))[1]) FROM vr JOIN v ON v.k = vr.k + 1),
w AS (SELECT number, town, position, substr(lower(array_to_string(list_filter(string_split(regexp_replace(replace(name, '&', ' AND '), '[^A-Z0-9 ]', '', 'g'), ' '), lambda x: x NOT IN ('', {", ".join(f"'{x}'" for x in generate.SITE_LEGAL_WORDS)})), '')), 1, 40) AS root,
  [{KINDS_OF_SITE}][1 + CAST({md5_mod_sql(len(generate.ENDINGS), "'tld|' || number")} AS INTEGER)] AS ending FROM c WHERE {md5_mod_sql(100, "'web|' || number")} < {generate.SITE_SHARE}),
g AS (SELECT number, root, ending, root || '-' || regexp_replace(lower(coalesce(town, '')), '[^a-z]', '', 'g') AS town, row_number() OVER (PARTITION BY root, ending ORDER BY position) AS k FROM w WHERE length(root) >= 3),
gr AS (SELECT root, ending, CAST(0 AS BIGINT) AS k, CAST('' AS VARCHAR) AS number, CAST('' AS VARCHAR) AS pick, CAST([] AS VARCHAR[]) AS used FROM (SELECT DISTINCT root, ending FROM g)
  UNION ALL SELECT g.root, g.ending, g.k, g.number, list_filter(list_concat([g.root, g.town], [g.root || n FOR n IN range(2, {generate.COUNTERS})]), lambda x: NOT list_contains(gr.used, x))[1],
    list_append(gr.used, list_filter(list_concat([g.root, g.town], [g.root || n FOR n IN range(2, {generate.COUNTERS})]), lambda x: NOT list_contains(gr.used, x))[1]) FROM gr JOIN g ON g.root = gr.root AND g.ending = gr.ending AND g.k = gr.k + 1)
SELECT c.number AS company_number, 'GB' || vr.pick AS vat_id, 'www.' || gr.pick || gr.ending AS website FROM c LEFT JOIN vr ON vr.number = c.number LEFT JOIN gr ON gr.number = c.number"""


@query(UNIQUE_SQL)
def unique_keys_g1_g2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique tax numbers and websites. The SQL serves one company after another: numbers over all, websites within a name and ending,
    as names of letters alone can only meet there."""
    companies = s.table(spark, sf_dir, "part").select(s.number("p_partkey").alias("company_number"), F.upper("p_name").alias("company_name"), F.col("p_brand").alias("post_town"), F.col("p_partkey").alias("position"))
    return generate.with_website(generate.with_vat(companies)).select("company_number", "vat_id", "website")


@query(f"SELECT c_name, {MD5_MOD_SQL} = 0 AS held_out FROM customer")
def holdout_g3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, out = hashing.split(s.table(spark, sf_dir, "customer").select("c_name"), "c_name")
    return kept.withColumn("held_out", F.lit(False)).unionByName(out.withColumn("held_out", F.lit(True)))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as companies fit to be varied, every tenth of them inactive."""
    key = F.col("c_custkey")
    rows = s.table(spark, sf_dir, "customer").join(s.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        s.number("c_custkey").alias("company_number"), F.concat(F.lit("NORTHERN "), F.element_at(F.array(*map(F.lit, ("TRANSPORT", "ENGINEERING", "PROPERTIES", "MANAGEMENT"))), (key % 4 + 1).cast("int")), F.lit(" SERVICES LIMITED")).alias("company_name"),
        F.concat(key.cast("string"), F.lit(" HIGH ROAD")).alias("address_line1"), F.lit(None).cast("string").alias("address_line2"), F.col("n_name").alias("post_town"), F.lit("ENGLAND").alias("country"), s.code("c_custkey").alias("postcode"),
        F.concat(F.lit("www.c"), key.cast("string"), F.lit(".co.uk")).alias("website"), F.concat(F.lit("GB"), s.number("c_custkey")).alias("vat_id"), F.when(key % 10 == 0, "Dissolved").otherwise("Active").alias("company_status"),
    )


@query("""WITH c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS company_number, c_custkey FROM customer WHERE c_custkey % 10 <> 0)
SELECT company_number, 'sampled' AS part FROM (SELECT * FROM c WHERE c_custkey % 3 <> 1 AND c_custkey % 50 <> 2 ORDER BY md5(company_number || '42'), company_number LIMIT 60)
UNION ALL SELECT company_number, 'held out' FROM (SELECT * FROM c WHERE c_custkey % 3 = 1 ORDER BY md5(company_number || '42'), company_number LIMIT 20)
UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 'translated' FROM customer WHERE c_custkey % 3 <> 1 AND c_custkey % 50 = 2""")
def base_samples_g4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies to be varied: those with a translation, and samples of the fit ones, of the register and of those held out."""
    rows = companies(spark, sf_dir)
    number = F.col("company_number").cast("long")
    out, kept = rows.where(number % 3 == 1), rows.where(number % 3 != 1)
    words = kept.where(number % 50 == 2).select("company_number")
    sampled = hashing.hash_sample(generate.base(kept).join(words, "company_number", "left_anti"), "company_number", "42", 60)
    parts = (sampled, "sampled"), (hashing.hash_sample(generate.base(out), "company_number", "42", 20), "held out"), (kept.join(words, "company_number", "left_semi"), "translated")
    named = [df.select("company_number", F.lit(name).alias("part")) for df, name in parts]
    return named[0].unionByName(named[1]).unionByName(named[2])


KINDS = (*vary.KIND_WEIGHTS, "TRANSLATION", "NO_MATCH")

@query("""SELECT * FROM (VALUES ('ADDRESS', 0, 0, 0, 0), ('DOMAIN', 0, 0, 0, 0), ('LEGAL_SUFFIX', 0, 0, 0, 0), ('MIXED', 0, 0, 0, 0), ('NO_MATCH', 0, 0, 0, 0), ('SPELLING', 0, 0, 0, 0), ('TRANSLATION', 0, 0, 0, 0), ('VAT', 0, 0, 0, 0)) x(variation_type, wrong_name, wrong_website, wrong_vat, wrong_address)""")
def varied_records_g5_g12_l3_l6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of every kind made of all companies, and how many break what their kind promises: keys, once normalised, are those of
    the company where they are given; a key is given where it is the variation, and else by NO_MATCH alone; names keep or change."""
    base = companies(spark, sf_dir)
    rows = base.withColumn("kind", F.explode(F.array(*map(F.lit, KINDS)))).withColumns({"language": F.when(F.col("kind") == "TRANSLATION", "de"), "translated_name": F.when(F.col("kind") == "TRANSLATION", "Nordverkehr GmbH")})
    made = vary.varied(rows, "42")
    c = base.select(F.col("company_number").alias("entity_id"), *[F.col(n).alias(f"c_{n}") for n in ("company_name", "website", "vat_id", "postcode")])
    both = made.join(c, "entity_id")
    kind = F.col("variation_type")
    norm = lambda name: normalize.name_norm(F.col(name))
    wrong = {
        "name": F.when(kind.isin("LEGAL_SUFFIX", "ADDRESS", "NO_MATCH"), norm("record_name") != norm("c_company_name")).when(kind == "TRANSLATION", F.col("record_name") != "Nordverkehr GmbH").otherwise(F.col("record_name").isNull()),
        "website": F.coalesce(normalize.domain_root(F.col("website")) != normalize.domain_root(F.col("c_website")), kind == "DOMAIN") | (F.col("website").isNotNull() & ~kind.isin("DOMAIN", "NO_MATCH")),
        "vat": F.coalesce(normalize.vat_digits(F.col("vat_id")) != normalize.vat_digits(F.col("c_vat_id")), kind == "VAT") | (F.col("vat_id").isNotNull() & ~kind.isin("VAT", "NO_MATCH")),
        "address": F.coalesce(normalize.postcode_norm(F.col("postcode"), F.col("address")) != normalize.postcode_norm(F.col("c_postcode")), F.lit(False)) | F.col("true_company_number").eqNullSafe(F.col("entity_id")).eqNullSafe(kind == "NO_MATCH"),
    }
    counts = both.groupBy("variation_type").agg(*[F.count(F.when(w, 1)).cast("int").alias(f"wrong_{n}") for n, w in wrong.items()])
    return counts


def near(share: Column, expected: float, by: float) -> Column:
    return F.abs(share - expected) <= by


#: What made records must show, each broken by a variation that returns what it is given.
FORMS = (
    "spelling changes names", "spelling keeps first letters", "spelling stays near", "legal forms change", "legal forms are listed", "trading names lose their form", "trading names lose generic words",
    "own names are titled at times", "titles capitalise each run", "street words are short", "postcodes are squeezed, lowered, moved or kept", "websites have all forms", "websites keep their host",
    "tax numbers have all forms", "tax numbers keep their digits", "kinds have their shares", "copies have their shares",
)


@query(f"SELECT unnest([{', '.join(f"'{f}'" for f in FORMS)}]) AS form, TRUE AS holds, count(*) AS companies FROM customer")
def varied_forms_g5_g12_f19_f20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether records made of all companies show the forms and shares that their kinds promise."""
    base = companies(spark, sf_dir)
    kinds = base.withColumn("kind", F.explode(F.array(*map(F.lit, KINDS)))).withColumns({"language": F.when(F.col("kind") == "TRANSLATION", "de"), "translated_name": F.when(F.col("kind") == "TRANSLATION", "Nordverkehr GmbH")})
    c = base.select(F.col("company_number").alias("entity_id"), *[F.col(n).alias(f"c_{n}") for n in ("company_name", "website", "vat_id", "postcode")])
    made = stored(vary.varied(kinds, "42").join(c, "entity_id"), "varied")
    free = vary.varied(base.withColumns({n: F.lit(None).cast("string") for n in ("kind", "language", "translated_name")}), "43")
    kind, name, upper = F.col("variation_type"), F.col("record_name"), F.upper("record_name")
    of = lambda *k: kind.isin(*k)
    share = lambda rows, holds: F.avg(F.when(rows, holds.cast("double")))
    always = lambda rows, holds: F.coalesce(F.bool_and(F.when(rows, holds)), F.lit(False))
    stem = F.regexp_replace("c_company_name", " LIMITED$", "")
    ending = F.trim(F.substr(upper, F.length(stem) + 1))
    host, digits = F.regexp_replace("c_website", "^www[.]", ""), F.regexp_replace("c_vat_id", "[^0-9]", "")
    site_forms = {f.replace("{host}", "H").replace("{upper}", "H") for f in vary.WEBSITE_FORMS}
    site_form = F.replace(F.replace("website", host, F.lit("H")), F.upper(host), F.lit("H"))
    tax_form = F.regexp_replace("vat_id", "[0-9]", "9")
    tax_forms = {f.format(a="999", b="9999", c="99") for f in vary.VAT_FORMS}
    form_of_code = F.when(F.col("postcode").isNull() & F.col("address").endswith(F.col("c_postcode")), "moved").when(F.col("postcode") == F.col("c_postcode"), "kept").when(F.col("postcode") == F.lower("c_postcode"), "lowered").when(F.col("postcode") == F.replace("c_postcode", F.lit(" "), F.lit("")), "squeezed")
    codes = {"squeezed": 0.35, "lowered": 0.15, "moved": 0.25, "kept": 0.25}
    every = lambda shares, rows, form: [near(share(rows, F.coalesce(form == f, F.lit(False))), s, 0.1) for f, s in shares.items()]
    whole = lambda parts: F.coalesce(F.least(*[p.cast("int") for p in parts]) == 1, F.lit(False))
    even = lambda forms: {f: 1 / len(forms) for f in sorted(forms)}
    holds = {
        "spelling changes names": share(of("SPELLING"), upper != F.col("c_company_name")) > 0.9,
        "spelling keeps first letters": always(of("SPELLING"), (F.substring(upper, 1, 1) == F.substring("c_company_name", 1, 1)) & (upper != "")) & (share(of("SPELLING"), upper == F.col("c_company_name")) < 0.1),
        "spelling stays near": always(of("SPELLING"), F.levenshtein(upper, F.col("c_company_name")) <= 10) & near(share(of("SPELLING"), F.levenshtein(upper, F.col("c_company_name")).between(1, 2)), 0.45, 0.35),
        "legal forms change": near(share(of("LEGAL_SUFFIX"), ending == "LIMITED"), 0.0, 0.1),
        "legal forms are listed": always(of("LEGAL_SUFFIX"), upper.startswith(stem) & ending.isin("LTD", "LTD.", "", "LIMITED COMPANY")),
        "trading names lose their form": always(of("DOMAIN", "VAT"), ~upper.endswith("LIMITED") & (name != upper)),
        "trading names lose generic words": near(share(of("DOMAIN", "VAT"), ~upper.endswith("SERVICES")), 0.6, 0.12),
        "own names are titled at times": near(share(of("NO_MATCH", "ADDRESS"), name != upper), 0.5, 0.12),
        "titles capitalise each run": always(of("DOMAIN", "VAT"), name == F.initcap(name)) & always(of("TRANSLATION"), F.col("address").rlike("High Road, [A-Z]")),
        "street words are short": always(of("ADDRESS", "MIXED"), F.lower("address").rlike("\\bhigh rd\\b") & ~F.lower("address").contains("road")),
        "postcodes are squeezed, lowered, moved or kept": whole(every(codes, of("ADDRESS", "MIXED"), form_of_code)),
        "websites have all forms": whole(every(even(site_forms), of("DOMAIN"), site_form)),
        "websites keep their host": always(of("DOMAIN"), F.lower("website").contains(host)) & (share(of("DOMAIN"), F.col("website") == F.col("c_website")) < 0.1),
        "tax numbers have all forms": whole(every({f: s * len(vary.VAT_FORMS) / len(tax_forms) for f, s in even(vary.VAT_FORMS).items() for f in [f.format(a="999", b="9999", c="99")]}, of("VAT"), tax_form)),
        "tax numbers keep their digits": always(of("VAT"), F.regexp_replace("vat_id", "[^0-9]", "") == digits) & (share(of("VAT"), F.col("vat_id") == F.col("c_vat_id")) < 0.5),
    }
    total = sum(vary.KIND_WEIGHTS.values())
    first = F.col("copy") == 0
    per = free.groupBy("entity_id").agg(F.count("*").alias("n"))
    copies = per.agg(whole([near(F.avg((F.col("n") == k + 1).cast("double")), s, 0.1) for k, s in enumerate(vary.COPIES)]).alias("holds"))
    kinds_free = free.where(first).agg(whole([near(F.avg((kind == k).cast("double")), w / total, 0.08) for k, w in vary.KIND_WEIGHTS.items()]).alias("holds"))
    row = made.agg(*[h.alias(f"h{n}") for n, h in enumerate(holds.values())])
    found = row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("form"), F.coalesce(f"h{n}", F.lit(False)).alias("holds")) for n, f in enumerate(holds)])).alias("x")).select("x.*")
    found = found.unionByName(kinds_free.withColumn("form", F.lit("kinds have their shares"))).unionByName(copies.withColumn("form", F.lit("copies have their shares")))
    return found.join(F.broadcast(base.agg(F.count("*").alias("companies"))))


@query("""SELECT * FROM (VALUES ('records', 100), ('ids', 100), ('NO_MATCH', 10), ('TRANSLATION', 8), ('without a company', 10), ('repeats counted', 0)) x(measure, n)""")
def quotas_g13_g14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data set of 100 records with its answer key, by its quotas."""
    rows = companies(spark, sf_dir)
    number = F.col("company_number").cast("long")
    words = rows.where((number % 3 != 1) & number.between(2, 90) & (number % 5 == 2)).select("company_number", F.lit("de").alias("language"), F.lit("Nordverkehr GmbH").alias("translated_name"))
    words = words.orderBy("company_number").limit(8)
    records, truth = generate.incoming(rows.where(number % 3 != 1), rows.where(number % 3 == 1), words, total=100, no_match=10, sampled=200, sampled_out=40)
    by_type = generate.counts_by_type(truth)
    of = lambda kind: by_type.where(F.col("variation_type") == kind).select("count")
    repeats = generate.repeated_entities(truth).agg(F.count("*").alias("a")).join(truth.groupBy("entity_id").count().agg(F.count(F.when(F.col("count") > 1, 1)).alias("b")))
    measures = {
        "records": records.agg(F.count("*").alias("count")), "ids": records.agg(F.countDistinct("incoming_id").alias("count")), "NO_MATCH": of("NO_MATCH"), "TRANSLATION": of("TRANSLATION"),
        "without a company": truth.where("true_company_number IS NULL").agg(F.count("*").alias("count")), "repeats counted": repeats.select((F.col("a") - F.col("b")).alias("count")),
    }
    out = None
    for name, df in measures.items():
        one = df.select(F.lit(name).alias("measure"), F.col("count").cast("int").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query(s.with_ctes("decisions", """, two AS (SELECT a_id AS x, b_id AS y FROM decisions WHERE pair_kind = 'DEDUP' AND baseline_match UNION SELECT b_id, a_id FROM decisions WHERE pair_kind = 'DEDUP' AND baseline_match),
met AS (SELECT incoming_id AS x, incoming_id AS y FROM incoming UNION SELECT met.x, two.y FROM met JOIN two ON two.x = met.y) SELECT x AS id, min(y) AS component FROM met GROUP BY x""").replace("\n, two", ",\ntwo"))  # fmt: skip
def refreshed_clusters_u11_l12_l17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all incoming records, kept from a table that lacked a tenth of them, had other values in a tenth, and held records that are gone."""
    rows = linkage.with_keys(s.incoming(spark, sf_dir), linkage.INCOMING)
    digit = F.substring("id", -1, 1)
    other = rows.where(digit == "4").withColumns({"domain_root": F.lit("shared.com"), "vat_digits": F.lit(None).cast("string")})
    removed = rows.where(digit == "5").withColumns({"id": F.concat(F.lit("A"), "id"), "name_norm": F.concat("name_norm", F.lit("S"))})
    alike = lambda pairs: pairs.withColumn("linked", F.col("vat_equal") | F.col("domain_equal") | F.coalesce(F.col("name_sim") >= 0.85, F.lit(False)))
    kept = KeptClusters(spark, shared_path(spark, "clusters"), alike)
    kept.refresh(rows.where(~digit.isin("3", "4")).unionByName(other).unionByName(removed))
    return kept.refresh(rows)

"""Test data for record linkage: synthetic unique keys, held-out companies, and varied records with their answer key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probalink.functions import hashing, vary
from probalink.operators.ids import unique_assignment
from probalink.sources.storage import stored

# Words that a website's name loses, and the slots from which a domain's ending is drawn.
SITE_LEGAL_WORDS = ("LTD", "LIMITED", "PLC", "LLP", "LP", "CIC", "CO", "COMPANY", "THE")
ENDINGS = (".co.uk",) * 6 + (".com",) * 3 + (".uk",)
VAT_SHARE, SITE_SHARE = 65, 70
#: Numbers that are put behind a website's name before a company goes without one: 2 to COUNTERS - 1.
COUNTERS = 1000


def with_vat(companies: DataFrame, order: str = "position") -> DataFrame:
    """companies with vat_id: GB and nine digits of a salted hash for 65 % of them, unique, earlier companies first. No company
    goes without: salts are tried until one gives a free number."""
    number = F.col("company_number")
    chosen = companies.where(hashing.md5_mod(100, F.lit("vat"), number) < VAT_SHARE).select("company_number", order)
    offer = lambda salt: F.lpad(hashing.md5_mod(10**9, F.lit("vat"), number, salt.cast("string")).cast("string"), 9, "0")
    given = unique_assignment(chosen, "company_number", order, offer, "digits")
    return companies.join(given, "company_number", "left").withColumn("vat_id", F.concat(F.lit("GB"), "digits")).drop("digits")


def with_website(companies: DataFrame, order: str = "position", rounds: list[int] | None = None) -> DataFrame:
    """companies with website: a unique domain of the name for 70 % of them; a taken one gets the town, then a counter. Counters are
    dealt out at once among those of one name and ending, so the rounds are few however many want a name; they are noted in `rounds`."""
    number = F.col("company_number")
    words = F.split(F.regexp_replace(F.replace(F.upper("company_name"), F.lit("&"), F.lit(" AND ")), "[^A-Z0-9 ]", ""), " ")
    root = F.substring(F.lower(F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*SITE_LEGAL_WORDS)), "")), 1, 40)
    ending = F.array(*map(F.lit, ENDINGS))[hashing.md5_mod(len(ENDINGS), F.lit("tld"), number).cast("int")]
    chosen = companies.where(hashing.md5_mod(100, F.lit("web"), number) < SITE_SHARE).select("company_number", order, root.alias("root"), ending.alias("ending"), "post_town")
    town = F.concat("root", F.lit("-"), F.regexp_replace(F.lower(F.coalesce("post_town", F.lit(""))), "[^a-z]", ""))
    chosen = chosen.where(F.length("root") >= 3).select("company_number", order, "root", town.alias("town"), "ending")
    name = lambda n: F.when(n == 0, F.col("root")).when(n == 1, F.col("town")).when(n < COUNTERS, F.concat("root", n.cast("string")))
    chosen = chosen.withColumn("__alike", F.concat_ws("|", "root", "ending"))
    given = unique_assignment(chosen, "company_number", order, lambda n: F.concat(name(n), "ending"), "domain", COUNTERS + 1, "__alike", 2, rounds)
    return companies.join(given, "company_number", "left").withColumn("website", F.concat(F.lit("www."), "domain")).drop("domain")


def prepared(companies: DataFrame, order: str = "position") -> tuple[DataFrame, DataFrame]:
    """(master, held out) with synthetic keys; order is the position in the register."""
    keyed = stored(with_website(with_vat(companies, order), order).drop(order), "register")
    return hashing.split(keyed, "company_number")


def base(companies: DataFrame) -> DataFrame:
    """Companies fit to be varied: active, with a postcode and an address, of two words or more."""
    return companies.where(F.col("company_status").like("Active%") & F.col("postcode").isNotNull() & F.col("address_line1").isNotNull() & F.col("company_name").like("% %"))


def incoming(master: DataFrame, held_out: DataFrame, translations: DataFrame, seed: str = "42", total: int = 2000, no_match: int = 250, sampled: int = 2000, sampled_out: int = 400) -> tuple[DataFrame, DataFrame]:
    """(records, truth): varied records of sampled companies, of held-out ones (NO_MATCH) and of all translations.

    Records beyond `total` are left out; too few, or a translation whose company is missing, is an error.
    """
    wanted = translations.select("company_number", "language", "translated_name")
    missing = wanted.join(master, "company_number", "left_anti").select("company_number").orderBy("company_number").limit(20).collect()
    if missing:
        raise ValueError(f"translations of companies that aren't in the register, the first of them: {[r[0] for r in missing]}")
    empty = [F.lit(None).cast("string").alias(n) for n in ("language", "translated_name")]
    translated = master.join(wanted, "company_number").withColumn("kind", F.lit("TRANSLATION"))
    others = base(master).join(wanted, "company_number", "left_anti")
    varied = hashing.hash_sample(others, "company_number", seed, sampled).select("*", *empty, F.lit(None).cast("string").alias("kind"))
    outside = hashing.hash_sample(base(held_out), "company_number", seed, sampled_out).select("*", *empty, F.lit("NO_MATCH").alias("kind"))
    rows = vary.varied(translated.unionByName(varied).unionByName(outside), seed)
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.md5(F.concat("entity_id", F.lit(seed))), "copy"))
    part = F.when(F.col("variation_type") == "NO_MATCH", 2).when(F.col("variation_type") == "TRANSLATION", 0).otherwise(1)
    placed = stored(rows.withColumn("part", part).withColumn("rank", rank), "varied")
    counts = {r[0]: r[1] for r in placed.groupBy("part").count().collect()}
    positives = total - no_match - counts.get(0, 0)
    if counts.get(2, 0) < no_match or counts.get(1, 0) < positives:
        raise ValueError(f"too few records to choose from: {counts}")
    kept = placed.where((F.col("part") == 0) | ((F.col("part") == 1) & (F.col("rank") <= positives)) | ((F.col("part") == 2) & (F.col("rank") <= no_match)))
    kept = kept.withColumn("__key", F.concat_ws("|", "entity_id", "copy"))
    numbered = stored(hashing.hash_numbered(kept, "__key", seed, "incoming_id"), "incoming")
    records = numbered.select("incoming_id", "source_system", "record_name", "address", "postcode", "country", "website", "vat_id")
    return records, numbered.select("incoming_id", "variation_type", "true_company_number", "entity_id")


def counts_by_type(truth: DataFrame) -> DataFrame:
    return truth.groupBy("variation_type").count().orderBy("variation_type")


def repeated_entities(truth: DataFrame) -> DataFrame:
    """Entities with more than one record."""
    return truth.groupBy("entity_id").count().where("count > 1")

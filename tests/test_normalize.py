from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from probalink.functions import hashing, normalize

CASES = [
    ("domain_root", "shop.brancheng.co.uk", "brancheng.co.uk"),
    ("domain_root", "https://www.brancheng.co.uk/", "brancheng.co.uk"),
    ("domain_root", "info@brancheng.co.uk", "brancheng.co.uk"),
    ("domain_root", "WWW.BRANCHENG.CO.UK", "brancheng.co.uk"),
    ("domain_root", "http://x.com/contact-us", "x.com"),
    ("domain_root", "localhost", None),
    ("domain_root", None, None),
    ("domain_root", "a.org.uk", "org.uk"),
    ("domain_root", "x.com:8080/p", "x.com:8080"),
    ("domain_root", "x.com?y=1", "x.com?y=1"),
    ("address_key", "24B Kenilworth Road", "24BKENILWORT"),
    ("address_key", "24B Kenilworth Road, Bridge Of Allan", "24BKENILWORT"),
    ("address_key", " ", None),
    ("name_norm", "B.P.S. PLASTICS Limited Company", "BPS PLASTICS"),
    ("name_norm", "Blau Sanitär und Heizung GmbH", "BLAU SANITÄR UND HEIZUNG"),
    ("name_norm", "A & B (UK) L.L.P.", "A AND B"),
    ("name_norm", "Gruppo Caffè Ash S.r.l.", "GRUPPO CAFFÈ ASH"),
    ("name_norm", "Acme Public Limited Company", "ACME PUBLIC"),
    ("name_norm", "CO-OP GROUP", "OP GROUP"),
    ("name_norm", "The UK Co. Ltd", None),
    ("name_norm", None, None),
    ("vat_digits", "GB 554 4352 25", "554435225"),
    ("vat_digits", "gb 554435225", "554435225"),
    ("vat_digits", "GB-554-4352-25", "554435225"),
    ("vat_digits", "none", None),
    ("postcode_norm", "sw1a 1aa", "SW1A1AA"),
]


def test_normalisers(spark):
    rows = spark.createDataFrame([(i, f, x) for i, (f, x, _) in enumerate(CASES)], "i int, f string, x string")
    value = F.col("x")
    found = rows.select("i", F.coalesce(*[F.when(F.col("f") == n, getattr(normalize, n)(value)) for n in {c[0] for c in CASES}]).alias("y"))
    assert {r.i: r.y for r in found.collect()} == {i: y for i, (_, _, y) in enumerate(CASES)}


def test_addresses_and_similarity(spark):
    row = spark.range(1).select(
        normalize.postcode_norm(F.lit(None).cast("string"), F.lit("1 Road sw1a1aa")).alias("found"),
        normalize.full_address(F.lit("A"), F.lit(None).cast("string"), F.lit(" "), F.lit("B")).alias("full"),
        normalize.full_address(F.lit(""), F.lit(None).cast("string")).alias("empty"),
        normalize.name_sim(F.lit("BÄR"), F.lit("BAR")).alias("near"),
        normalize.name_sim(F.lit("X"), F.lit(None).cast("string")).alias("none"),
        normalize.domain_root(F.lit("x.com:8080/p"), strict=True).alias("strict"),
        normalize.first_word(F.lit("BPS PLASTICS")).alias("first"),
    ).first()
    assert (row.found, row.full, row.empty, row.none, row.strict, row["first"]) == ("SW1A1AA", "A, B", None, None, "x.com", "BPS")
    assert row.near == pytest.approx(2 / 3)


def test_md5_mod_is_that_of_the_whole_number(spark):
    keys = ["x", "", "Ä", "12345678"] + [f"k{i}" for i in range(50)]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", *[hashing.md5_mod(m, F.lit("vat"), F.col("k")).alias(f"m{m}") for m in (100, 1000, 10**9)])
    for r in rows.collect():
        n = int(hashlib.md5(f"vat|{r.k}".encode()).hexdigest(), 16)
        assert (r.m100, r.m1000, r.m1000000000) == (n % 100, n % 1000, n % 10**9)
    assert spark.range(1).select(hashing.md5_mod(1000, F.lit("x"))).first()[0] == 638

"""Key normalisers of company records, as column expressions.

Every normaliser gives null, never an empty text, where nothing is left: empty keys would otherwise join every record that lacks one
with every other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal words that a name loses, and the pattern of a postcode within an address.
LEGAL_WORDS = ("LIMITED", "LTD", "PLC", "LLP", "LP", "CIC", "CO", "COMPANY", "THE", "UK", "GMBH", "AG", "SA", "SAS", "SARL", "SL", "SRL", "BV", "NV")
POSTCODE = r"\b[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}\b"
ADDRESS_KEY_LENGTH = 12


def filled(text: Column) -> Column:
    """text, or null where it is empty."""
    return F.nullif(text, F.lit(""))


def name_norm(name: Column) -> Column:
    """Upper case, & as AND, without dots and apostrophes; words of letters and digits only, legal words dropped."""
    plain = F.regexp_replace(F.replace(F.upper(name), F.lit("&"), F.lit(" AND ")), "[.']", "")
    words = F.split(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "), " ")
    return filled(F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*LEGAL_WORDS)), " "))


def first_word(norm: Column) -> Column:
    return filled(F.substring_index(norm, " ", 1))


def postcode_norm(postcode: Column, address: Column | None = None) -> Column:
    """Upper case without blanks; with an address, the first postcode found there where the field is empty."""
    squeezed = lambda c: filled(F.replace(F.upper(c), F.lit(" "), F.lit("")))
    own = squeezed(postcode)
    return own if address is None else F.coalesce(own, squeezed(F.regexp_substr(F.upper(address), F.lit(POSTCODE))))


def address_key(address: Column) -> Column:
    return filled(F.substring(F.regexp_replace(F.upper(address), "[^A-Z0-9]", ""), 1, ADDRESS_KEY_LENGTH))


def vat_digits(vat: Column) -> Column:
    return filled(F.regexp_replace(vat, "[^0-9]", ""))


def domain_root(address: Column, strict: bool = False) -> Column:
    """The registered domain of a web or mail address: its last two labels, or three where it ends in .co.uk.

    strict also cuts a port, query or fragment that follows the host directly.
    """
    bare = F.regexp_replace(F.lower(address), r"^(?:https?://)?(?:[^@/]*@)?(?:www\.)?", "")
    host = F.regexp_substr(bare, F.lit(r"^[^/:?#]+" if strict else r"^[^/]+"))
    return F.regexp_substr(host, F.lit(r"[^.]+\.(co\.uk|[^.]+)$"))


def full_address(*parts: Column) -> Column:
    """The parts that hold something, separated by commas."""
    return filled(F.concat_ws(", ", *[filled(F.trim(p)) for p in parts]))


def name_sim(a: Column, b: Column) -> Column:
    """1 less the edit distance in characters over the longer length; null where a name is."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))

"""Personal data in texts (operator 3), by DataFrame functions only.

A regular expression proposes spans of each kind, a validator confirms them (Luhn for cards, mod-97 for bank accounts, digit counts and
ranges elsewhere), and words near a span raise or lower its score, which decides about spans of all kinds but the base ones. Spans
are counted in code points, the end exclusive.

Every pattern is written so that its search takes linear time, however long the text is: a run of letters or digits is entered only
at its start, and taken whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probalink.llm.common import fresh, text_of

SPAN = "array<struct<kind:string,start:int,end:int,hit:string,score:double>>"
#: Characters on each side of a span that are searched for context words.
NEAR = 48


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits of hit pass Luhn's check."""
    doubled = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
    each = F.transform(F.split(F.reverse(digits(hit)), ""), lambda d, i: F.when(i % 2 == 1, doubled(d.cast("int"))).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod_97(hit: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters read as 10 to 35, is 1 mod 97."""
    flat = F.replace(hit, F.lit(" "))
    turned = F.split(F.concat(flat.substr(F.lit(5), F.length(flat)), flat.substr(1, 4)), "")
    step = lambda rest, c: F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(turned, F.lit(0), step) == 1


def small_parts(hit: Column) -> Column:
    """Whether no dotted part exceeds 255."""
    return F.forall(F.split(hit, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def digit_count(least: int, most: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(digits(hit)).between(least, most)


@dataclass(frozen=True)
class Kind:
    """hint: a cheap pattern that every text with a match also matches. base: its valid spans stay whatever their score.

    score is what a valid match is worth. A word of `near` within NEAR characters beside it raises that by `raised`, one of AGAINST or
    `against` lowers it by LOWERED (words are patterns, in any letter case). Spans of at least LEAST stay.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    hint: str
    base: bool = False
    score: float = 0.7
    near: str = "(?!)"
    against: str = "(?!)"
    raised: float = 0.3


LEAST, LOWERED = 0.5, 0.3
#: Words beside what only looks like personal data.
AGAINST = "example|sample|dummy|placeholder|fictitious|invalid|beispiel|exemple|ejemplo"
BASE = (
    Kind(
        "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda hit: F.lit(True), "@", True,
        near="e-?mail|mail|contact|write|address",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", small_parts, r"[0-9]\.[0-9]", True, near="ip|host|server|address|client|login", against="version|release|section|build"),
    Kind(
        "card", r"[0-9](?:[\x20-]?[0-9]){12,}+", lambda hit: digit_count(13, 19)(hit) & luhn(hit), r"[0-9](?:[\x20-]?[0-9]){12}", True,
        near="card|credit|debit|visa|mastercard|amex|payment|karte|carte|tarjeta", against="order|serial|tracking|isbn|part",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", digit_count(9, 15), r"\+[0-9]", True, near="phone|tel|telephone|call|mobile|cell|fax|telefon"),
)
ADDED = (
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![a-z])", mod_97, r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11}",
        near="iban|account|bank|konto|compte|cuenta", against="serial|part|tracking",
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9_])(?:[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Pp]assword|PASSWORD|[Aa]pi[_-]?[Kk]ey|API[_-]?KEY)\x20{0,2}[=:]\x20{0,2}[\x22']?[A-Za-z0-9+/_-]{16,}+",
        lambda hit: hit.rlike("[0-9]") & (F.size(F.array_distinct(F.split(hit, ""))) >= 12),
        r"(?i)(?:token|secret|password|key)\x20{0,2}[=:]", near="credential|credentials|login|auth|private|production|config",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda hit: ~hit.rlike("^(000|666|9)|-00-|-0000$"), r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        score=0.3, near="ssn|social security", raised=0.4,
    ),
    Kind(
        "pan", r"(?<![0-9./_])[0-9]{4}[./_][0-9]{4}[./_][0-9]{4}[./_][0-9]{4}(?![0-9./_])", luhn, r"[0-9]{4}[./_][0-9]{4}[./_][0-9]{4}",
        score=0.3, near="card|credit|debit|visa|mastercard|payment|karte|carte|tarjeta", raised=0.4,
    ),
)


def proposed(text: Column, kind: Kind) -> Column:
    """The valid spans of one kind, an empty array where there are none.

    The gaps between matches and the matches, by their lengths, give the places.
    """
    parts = F.zip_with(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1), lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap")))
    state = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(s: Column, part: Column) -> Column:
        start = s["at"] + part["gap"]
        end = start + F.length(part["hit"])
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), part["hit"].alias("hit"), F.lit(kind.score).alias("score"))
        return F.when(part["hit"].isNull(), s).otherwise(F.struct(end.alias("at"), F.concat(s["spans"], F.array(span)).alias("spans")))

    spans = F.filter(F.aggregate(parts, state, step, lambda s: s["spans"]), lambda s: kind.valid(s["hit"]))
    has = lambda beside, words: beside.rlike(rf"(?i)(?<![a-z])(?:{words})(?![a-z])")

    def scored(s: Column) -> Column:
        first = F.greatest(s["start"] - NEAR, F.lit(0))
        beside = F.concat_ws(" ", F.substring(text, first + 1, s["start"] - first), F.substring(text, s["end"] + 1, F.lit(NEAR)))
        score = kind.score + F.when(has(beside, kind.near), kind.raised).otherwise(0.0) - F.when(has(beside, f"{AGAINST}|{kind.against}"), LOWERED).otherwise(0.0)
        return s.withField("score", F.round(score, 2))

    spans = F.transform(spans, scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST)
    return F.when(text.rlike(kind.hint), spans).otherwise(F.array().cast(SPAN))


def with_spans(df: DataFrame, text_col: str = "text", column: str = "spans", kinds: tuple[Kind, ...] = (*BASE, *ADDED)) -> DataFrame:
    """df with an array of (kind, start, end, hit, score), by kind as listed and then by start.

    Added spans that overlap one of a kind listed before them are dropped. Null and empty texts have none. Rows and other columns stay
    as they are, whatever their names; a column with the new one's name is replaced. An empty table gives an empty result. No shuffle.
    """
    text = text_of(text_col)
    own = {k.name: fresh(df, f"__{k.name}") for k in kinds}
    base = fresh(df, "__base")
    found = df.withColumns({own[k.name]: proposed(text, k) for k in kinds})
    found = found.withColumn(base, F.concat(*[F.col(own[k.name]) for k in kinds if k.base]))
    for k in kinds:
        if not k.base:
            free = F.filter(own[k.name], lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
            found = found.withColumn(base, F.when(F.size(own[k.name]) == 0, F.col(base)).otherwise(F.concat(base, free)))
    return found.withColumn(column, F.col(base)).drop(base, *own.values())


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of every whole text; scores are those of the spans, in order."""
    found = with_spans(df.select(id_col, text_col), text_col, "__spans")
    names = [k.name for k in BASE]
    of = lambda *kinds: F.filter("__spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(n)).cast("long").alias(f"n_{n}") for n in names]
    return found.select(id_col, *counts, F.sha2(joined(of(*names)), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"), F.array_join(F.transform("__spans", lambda s: s["score"].cast("string")), ",").alias("scores"))


def redacted(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """df with every span of personal data replaced by its kind in brackets; texts without one, null among them, stay as they are.

    Where spans overlap, the one that begins first is named and what the others reach beyond it goes too. length_col, if df has it, is
    set to the new length of the texts that change.
    """
    spans, text = fresh(df, "__spans"), fresh(df, "__text")
    found = with_spans(df, text_col, spans)
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, span: Column) -> Column:
        before = F.array(F.substring(F.col(text_col), s["at"] + 1, span["start"] - s["at"]), F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.when(span["start"] >= s["at"], F.concat(s["parts"], before)).otherwise(s["parts"]).alias("parts"))

    end = lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(F.col(text_col), s["at"] + 1, F.length(text_col)))
    found = found.withColumn(text, F.when(F.size(spans) == 0, F.col(text_col)).otherwise(F.aggregate(ordered, state, step, end)))
    columns = {n: F.col(n) for n in df.columns} | {text_col: F.col(text).alias(text_col)}
    if length_col in columns:
        columns[length_col] = F.when(F.size(spans) == 0, F.col(length_col)).otherwise(F.length(text)).cast(df.schema[length_col].dataType).alias(length_col)
    return found.select(*columns.values())

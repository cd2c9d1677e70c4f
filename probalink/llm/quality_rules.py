"""Quality rules as weak supervision (operator 5), by DataFrame functions only.

Each rule votes a document good (1) or bad (-1), or abstains (0). Documents with the same votes are counted, and from these counts, at
most 3 ** rules of them, expectation maximisation estimates how often each rule gives each vote to good documents, and how often to bad
ones. A document is kept if the posterior probability that it is good is high enough; no single rule has to pass, and one that is
hardly ever wrong about good documents may decide alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probalink.llm.common import fresh, stored, text_of

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: A window of five words from the start of a word on, as group 1; the match itself is that word and the blank after it.
WINDOW = r"(?<![^ ])(?=([^ ]+ [^ ]+ [^ ]+ [^ ]+ [^ ]+))[^ ]+ ?"
WINDOW_WORDS = 5


@dataclass(frozen=True)
class Rule:
    """bad and good are conditions on the statistics; where neither holds (or one is null) the rule abstains.

    What is believed before any votes are seen: the shares of good and of bad documents that it votes bad, and that it votes good.
    """

    name: str
    bad: str
    good: str = "false"
    voted_bad: tuple[float, float] = (0.0005, 0.3)
    voted_good: tuple[float, float] = (1e-6, 1e-6)

    def believed(self, of: int) -> tuple[float, float, float]:
        """The shares of VOTES among good documents (of = 0) or bad ones (1)."""
        return self.voted_bad[of], 1 - self.voted_bad[of] - self.voted_good[of], self.voted_good[of]


#: Thresholds are on shares of words or characters, so that a document's length doesn't matter. Most rules are believed to be wrong about
#: one good document in 2,000, so each decides alone; repeated words and lines occur in good documents too.
RULES = (
    Rule("symbols", "n_symbols > 0.2 * n_words"),
    Rule("letters", "n_others > 0.2 * word_chars", "n_others <= 0.1 * word_chars", (0.005, 0.3), (0.9, 0.5)),
    Rule("columns", "n_bars > 0.2 * n_words"),
    Rule("capitals", "n_capitals > 0.3 * word_chars"),
    Rule("exclamations", "n_exclamations > 0.2 * n_words"),
    Rule("repetition", "n_repeat_words > 0.1 * n_words", voted_bad=(0.02, 0.3)),
    Rule("doubles", "n_doubles > 0.15 * n_words", voted_bad=(0.005, 0.3)),
    Rule("lines", "n_dup_lines > 0.2 * n_lines", voted_bad=(0.1, 0.2)),
    Rule("word_length", "word_chars > 12 * n_words OR word_chars < 2 * n_words"),
)


def repeated_words(windows: Column) -> Column:
    """How many words lie in windows that occur twice or more, from the array of all windows in order.

    The windows are sorted with their positions, so equal ones are neighbours: n log n steps in a text of n words.
    """
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    twins = F.zip_with(placed, F.slice(placed, F.lit(2), F.greatest(F.size(placed), F.lit(1))), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda t: t.isNotNull()))))
    steps = F.zip_with(starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts), F.lit(1))), lambda a, b: F.least(F.lit(WINDOW_WORDS), F.coalesce(b - a, F.lit(WINDOW_WORDS))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def with_statistics(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """df with the statistics of every whole text, each column's name after prefix. Null texts have no words and no lines."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    own = {n: fresh(df, f"__{n}") for n in ("flat", "lines", "windows", "chars")}
    flat, chars, all_lines, every = (F.col(own[n]) for n in ("flat", "chars", "lines", "windows"))
    first = df.withColumns({own["flat"]: F.trim(F.regexp_replace(text, rf"{SPACES}{{2,}}|[\x09-\x0D]", " ")), own["lines"]: lines})
    windows = F.regexp_extract_all(flat, F.lit(WINDOW), F.lit(1))
    second = first.withColumns({own["windows"]: windows, own["chars"]: F.length(F.replace(flat, F.lit(" ")))})
    words = F.when(flat == "", 0).otherwise(F.length(flat) - chars + 1)
    repeated = F.when(F.size(every) == F.size(F.array_distinct(every)), 0).otherwise(repeated_words(every))
    count = lambda pattern: F.regexp_count(flat, F.lit(pattern))
    found = {
        "n_words": words,
        "word_chars": chars,
        "n_symbols": count(SYMBOLS),
        "n_dup_lines": F.size(all_lines) - F.size(F.array_distinct(all_lines)),
        "n_repeat_words": repeated,
        "n_lines": F.size(all_lines),
        "n_bars": count(r"\|"),
        "n_exclamations": count("!"),
        "n_capitals": count(r"\p{Lu}"),
        "n_others": count(r"[^\p{L}\p{N}\x20]"),
        "n_doubles": count(r"(?<![^ ])([^ ]++) (?=\1(?![^ ]))"),
    }
    return second.withColumns({prefix + n: c.cast("long") for n, c in found.items()}).drop(*own.values())


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bars", "n_exclamations", "n_capitals", "n_others", "n_doubles")


def votes(rules: tuple[Rule, ...] = RULES, prefix: str = "") -> Column:
    """The array of the rules' votes: -1, 0 or 1 each."""

    def own(rule: Rule) -> Column:
        bad, good = rule.bad, rule.good
        for name in STATISTICS if prefix else ():
            bad, good = bad.replace(name, prefix + name), good.replace(name, prefix + name)
        return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)

    return F.array(*map(own, rules))


VOTES = (-1, 0, 1)
#: Times its believed share that a rule may be estimated to vote good documents bad.
WRONG = 10.0


@dataclass(frozen=True)
class Estimate:
    """The share of good documents, and how often each rule gives each of VOTES to good and to bad ones."""

    share: float
    good: tuple[tuple[float, ...], ...]
    bad: tuple[tuple[float, ...], ...]

    def weights(self) -> list[list[float]]:
        """What each vote of each rule adds to the log odds that a document is good."""
        return [[math.log(g / b) for g, b in zip(*rule)] for rule in zip(self.good, self.bad)]

    def odds(self) -> float:
        return math.log(self.share / (1 - self.share))

    def quality(self, pattern: tuple[int, ...]) -> float:
        """The probability that a document with these votes is good."""
        return 1 / (1 + math.exp(-self.odds() - sum(w[v + 1] for w, v in zip(self.weights(), pattern))))

    def posterior(self, pattern: Column) -> Column:
        """The same, of an array of votes."""
        odds = F.lit(self.odds())
        for k, own in enumerate(self.weights()):
            odds = odds + F.get(F.array(*map(F.lit, own)), pattern[k] + 1)
        return 1 / (1 + F.exp(-odds))


def prior(rules: tuple[Rule, ...], share: float = 0.8) -> Estimate:
    """What is believed before any votes are seen."""
    return Estimate(share, tuple(r.believed(0) for r in rules), tuple(r.believed(1) for r in rules))


def held_back(rates: tuple[float, ...], most: float) -> tuple[float, ...]:
    """The shares of VOTES with that of bad votes at most `most`, the others in proportion."""
    return rates if rates[0] <= most else (most, *(r * (1 - most) / (1 - rates[0]) for r in rates[1:]))


def estimated(counts: dict[tuple[int, ...], int], believed: Estimate, belief: float = 1.0, rounds: int = 200) -> Estimate:
    """Expectation maximisation over counts of vote patterns.

    Given its class, a document's votes are independent, and every rule has its own shares of bad votes, abstentions and good votes
    among the good and among the bad. Estimates start from what is believed, and lean on it as on a further `belief` times the documents at
    hand, so that they come out alike for any number of documents; they stand where there are none. No rule is taken to vote good
    documents bad more than WRONG times as often as believed: else junk of one kind, which one rule alone sees, would count as a usual
    kind of good document once there is enough of it.
    """
    now, total, rules = believed, sum(counts.values()), range(len(believed.good))
    for _ in range(rounds if total else 0):
        mass = [0.0, 0.0]
        votes = [[[0.0] * len(VOTES) for _ in rules] for _ in mass]
        for pattern, n in counts.items():
            p = now.quality(pattern)
            for c, own in enumerate((n * (1 - p), n * p)):
                mass[c] += own
                for k, v in enumerate(pattern):
                    votes[c][k][v + 1] += own
        lean = lambda c, given: tuple(tuple((votes[c][k][v] + belief * mass[c] * given[k][v]) / (mass[c] * (1 + belief)) if mass[c] else given[k][v] for v in range(len(VOTES))) for k in rules)
        usual = tuple(held_back(own, min(1.0, WRONG * given[0])) for own, given in zip(lean(1, believed.good), believed.good))
        last, now = now, Estimate((mass[1] + belief * total * believed.share) / (total * (1 + belief)), usual, lean(0, believed.bad))
        if abs(last.share - now.share) < 1e-12 and last.weights() == now.weights():
            break
    return now


def rated(df: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES, least: float = 0.5, text_col: str = "text", prefix: str = "") -> DataFrame:
    """The columns named by keep, the statistics, base_failed, quality (the posterior of good) and kept.

    base_failed: fewer than 10 words, or over a fifth of them in repeated windows. kept: not so, and quality of at least `least`;
    quality is estimated from the documents that aren't failed already. Null and empty texts fail. Rows that repeat are rated alike;
    an empty table gives an empty result. Columns that keep names and that clash with a new one need a prefix for the new ones. The
    rated rows are written once to the shared folder, between the count of vote patterns and the verdict.
    """
    rows = with_statistics(df.select(*dict.fromkeys([*keep, text_col])), text_col, prefix).select(*keep, *[prefix + n for n in STATISTICS])
    names = {n: prefix + n for n in ("votes", "base_failed", "quality", "kept")}
    rows = stored(rows.withColumn(names["votes"], votes(rules, prefix)), "rated")
    words, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    failed = (words < 10) | (100 * repeated > 20 * words)
    counts = {tuple(r[0]): r[1] for r in rows.where(~failed).groupBy(names["votes"]).count().collect()}  # at most 3 ** rules of them
    quality = estimated(dict(sorted(counts.items())), prior(rules)).posterior(F.col(names["votes"]))
    rows = rows.withColumns({names["base_failed"]: failed, names["quality"]: quality})
    return rows.withColumn(names["kept"], ~F.col(names["base_failed"]) & (F.col(names["quality"]) >= least))


def passing(df: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of df that are kept, with its columns, whatever their names."""
    prefix = "__rated_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = f"_{prefix}"
    return rated(df, df.columns, rules, least, text_col, prefix).where(f"{prefix}kept").select(*df.columns)

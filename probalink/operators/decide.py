"""Questions to a decision model about rows and pairs of rows, with bounded concurrency and errors kept with their row."""

from __future__ import annotations

import asyncio
import datetime
import hashlib
import json
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probalink.operators.hot import hot_keys, joined
from probalink.operators.ids import evenly
from probalink.sources.storage import stored
from probalink.sources.tables import merged
from probalink.sources.versions import Conflict, VersionedTable

#: Characters of a message that an error keeps.
MESSAGE = 1900
#: Calls in flight in one task; tasks times this is what the model sees.
IN_FLIGHT = 16
#: Times that a call is made again when the model is overloaded, and the longest wait between them in seconds.
PATIENCE, LONGEST_WAIT = 30, 5.0
#: Documents that the table function asks about at once.
SLICE = 1024


@dataclass(frozen=True)
class YesNo:
    """A yes/no question; true and false describe the answers."""

    instructions: str
    true: str | None = None
    false: str | None = None


@dataclass(frozen=True)
class Choice:
    """One of the labels, each with a description or None."""

    instructions: str
    labels: Mapping[str, str | None]


@dataclass(frozen=True)
class Scale:
    """A level, in ascending order."""

    instructions: str
    levels: Sequence[str]


Question = YesNo | Choice | Scale
Questions = Mapping[str, Question]
State = dict[str, Any]


@dataclass
class Answers:
    model: str
    request_id: str = ""
    input_tokens: int = 0
    output_tokens: int = 0
    yes: dict[str, float] = field(default_factory=dict)
    choices: dict[str, dict[str, Any]] = field(default_factory=dict)
    scales: dict[str, dict[str, Any]] = field(default_factory=dict)


class Model(Protocol):
    """Answers all questions about one state. Pickled to the workers, where one client serves a partition: a model that has
    `opened` and `closed` is opened before a task's first question and closed after its last, also where one fails."""

    async def answer(self, state: State, questions: Questions) -> Answers: ...


@contextmanager
def client(model: Model) -> Iterator[asyncio.Runner]:
    """A runner for one task's questions, within which the model is open."""
    with asyncio.Runner() as runner:
        if hasattr(model, "opened"):
            runner.run(model.opened())
        try:
            yield runner
        finally:
            if hasattr(model, "closed"):
                runner.run(model.closed())


def fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


STRING, DOUBLE, LONG = T.StringType(), T.DoubleType(), T.LongType()
CHOICE = fields(choice=STRING, confidence=DOUBLE, probabilities=T.MapType(STRING, DOUBLE))
LEVELS = fields(score=DOUBLE, confidence=DOUBLE, legend=T.MapType(T.IntegerType(), STRING), probabilities=T.MapType(T.IntegerType(), DOUBLE))
ANSWER = fields(
    model=STRING, request_id=STRING, usage=fields(input_tokens=LONG, output_tokens=LONG), yes=T.MapType(STRING, DOUBLE), choices=T.MapType(STRING, CHOICE), scales=T.MapType(STRING, LEVELS)
)


def share(*parts: str) -> float:
    """A number from 0 to 1 that the parts' MD5 fixes: its first eight hexadecimal digits over 16 ** 8 - 1."""
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:8], 16) / 0xFFFFFFFF


@dataclass(frozen=True)
class HashModel:
    """A deterministic offline stand-in: every probability is a hash of the question and of the named fields of the state.

    It says nothing about a row's meaning, but SQL can compute the same numbers.
    """

    fields: tuple[str, ...]
    first_level: int = 0

    async def answer(self, state: State, questions: Questions) -> Answers:
        text = "|".join(str(state.get(f, "")) for f in self.fields)
        out = Answers("hash", hashlib.md5(text.encode()).hexdigest(), len(text), len(questions))
        for name, q in questions.items():
            if isinstance(q, YesNo):
                out.yes[name] = share(q.instructions, text)
                continue
            options = list(q.labels) if isinstance(q, Choice) else list(q.levels)
            weights = [share(q.instructions, option, text) + 1e-9 for option in options]
            chances = [w / sum(weights) for w in weights]
            best = max(range(len(options)), key=lambda k: chances[k])
            if isinstance(q, Choice):
                out.choices[name] = {"choice": options[best], "confidence": chances[best], "probabilities": dict(zip(options, chances))}
            else:
                levels = range(self.first_level, self.first_level + len(options))
                score = sum(n * p for n, p in zip(levels, chances))
                out.scales[name] = {"score": score, "confidence": chances[best], "legend": dict(zip(levels, options)), "probabilities": dict(zip(levels, chances))}
        return out


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@dataclass(frozen=True)
class SimilarityModel:
    """An offline stand-in for pairs: names by their edit distance, tax numbers by their digits, other fields by equality, and `same` weighs name, address, website and tax number."""

    weights: tuple[tuple[str, float], ...] = (("name", 4.0), ("address", 1.0), ("website", 2.0), ("vat_id", 3.0))

    async def answer(self, state: State, questions: Questions) -> Answers:
        out = Answers("similarity")
        a, b = state["record_a"], state["record_b"]
        likeness = {}
        for name, _ in self.weights:
            if name in a and name in b:
                x, y = ("".join(filter(str.isdigit, r[name])) if name == "vat_id" else r[name].upper() for r in (a, b))
                likeness[name] = 1 - edit_distance(x, y) / max(len(x), len(y), 1) if name == "name" else float(x == y)
        total = sum(w for n, w in self.weights if n in likeness)
        for name in questions:
            out.yes[name] = sum(w * likeness[n] for n, w in self.weights if n in likeness) / total if name == "same" and total else likeness.get(name, 0.0)
        return out


@dataclass
class FailingModel:
    """Raises for states that `fails` picks, else asks the other model; counts its calls (within one process)."""

    inner: Model
    fails: Callable[[State], bool]
    message: str = "no answer"
    calls: int = 0

    async def answer(self, state: State, questions: Questions) -> Answers:
        self.calls += 1
        if self.fails(state):
            raise ConnectionError(self.message)
        return await self.inner.answer(state, questions)


def plain(value: Any) -> Any:
    """A column's value as it goes into a state: dates as ISO texts."""
    return value.isoformat() if isinstance(value, datetime.date | datetime.datetime) else value


def packed(answers: Answers) -> dict[str, Any]:
    usage = {"input_tokens": answers.input_tokens, "output_tokens": answers.output_tokens}
    return {"model": answers.model, "request_id": answers.request_id, "usage": usage, "yes": answers.yes, "choices": answers.choices, "scales": answers.scales}


class Overloaded(RuntimeError):
    """A model raises it for a call that it can't take now: the call is made again, and fewer are made at once."""


async def gate_of(most: int) -> Gate:
    """A gate of the running loop, which all calls of a task go through."""
    return Gate(most)


class Gate:
    """How many calls of a task may be in flight: halved when the model is overloaded, one more for every `limit` calls that succeed."""

    def __init__(self, most: int):
        self.most, self.limit, self.inside = most, float(most), 0
        self.free = asyncio.Condition()

    async def __aenter__(self) -> None:
        async with self.free:
            await self.free.wait_for(lambda: self.inside < int(self.limit))
            self.inside += 1

    async def __aexit__(self, *_: object) -> None:
        async with self.free:
            self.inside -= 1
            self.free.notify(2)

    def widen(self) -> None:
        self.limit = min(self.most, self.limit + 1 / self.limit)

    def narrow(self) -> None:
        self.limit = max(1.0, self.limit / 2)


async def asked(
    model: Model, states: list[State | None], questions: Questions | Callable[[State], Questions], in_flight: int | Gate, missing: str
) -> list[tuple[dict | None, str | None]]:
    """An answer or an error for each state, in order. A call that finds the model overloaded waits, longer each time, and is made again up to
    PATIENCE times."""
    gate = in_flight if isinstance(in_flight, Gate) else Gate(in_flight)

    async def one(state: State | None) -> tuple[dict | None, str | None]:
        if state is None:
            return None, missing
        for attempt in range(PATIENCE + 1):
            async with gate:
                try:
                    found = packed(await model.answer(state, questions(state) if callable(questions) else questions))
                    gate.widen()
                    return found, None
                except Overloaded as e:
                    gate.narrow()
                    error = e
                except Exception as e:  # noqa: BLE001  whatever a row meets is its own error
                    return None, f"{type(e).__name__}: {str(e)[:MESSAGE]}"
            await asyncio.sleep(min(LONGEST_WAIT, 0.01 * 2**attempt) * (0.5 + random.random()))
        return None, f"{type(error).__name__}: {str(error)[:MESSAGE]}"

    return await asyncio.gather(*map(one, states))


def decided(
    df: DataFrame,
    model: Model,
    questions: Questions | Callable[[State], Questions],
    state: Callable[[dict[str, Any]], State | None],
    reads: Sequence[str],
    keep: Sequence[str],
    instances: int | None = None,
    in_flight: int = IN_FLIGHT,
    missing: str = "null document",
) -> DataFrame:
    """(keep …, answer, error): the model's answers about every row.

    state makes what the model sees from the columns named by reads, or None for a row that can't be asked (its error is `missing`).
    A row's failure is its own: answer is null, error says what happened, the rest goes on. `instances` caps the tasks that ask at
    once; a task has up to in_flight calls open, and fewer while the model says that it is overloaded, so that all tasks together
    settle at what it can take. Columns pass through, so answers need no join back. Rows are asked where the plan is run: write the result once (see
    `scores`) and read that, as another run would ask again.
    """
    columns = list(dict.fromkeys([*keep, *reads]))
    kept = [df.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("answer", ANSWER), T.StructField("error", T.StringType())])
    arrow_answer = pa_type(ANSWER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with client(model) as runner:
            gate = runner.run(gate_of(in_flight))
            for batch in batches:
                for part in (batch.slice(k, 1024) for k in range(0, batch.num_rows, 1024)):
                    states: list[State | None] = []
                    for row in part.select(list(reads)).to_pylist():
                        states.append(state({k: plain(v) for k, v in row.items()}))
                    answers = runner.run(asked(model, states, questions, gate, missing))
                    own = [pa.array([mapped(a) for a, _ in answers], arrow_answer), pa.array([e for _, e in answers], pa.string())]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *own], [*keep, "answer", "error"])

    rows = df.select(*columns)
    return (rows if instances is None else evenly(rows, instances)).mapInArrow(run, schema)


def mapped(answer: dict | None) -> dict | None:
    """An answer with its maps as lists of pairs, as Arrow wants them."""
    if answer is None:
        return None
    inner = lambda x: {k: list(v.items()) if isinstance(v, dict) else v for k, v in x.items()}
    return answer | {"yes": list(answer["yes"].items()), "choices": [(k, inner(v)) for k, v in answer["choices"].items()], "scales": [(k, inner(v)) for k, v in answer["scales"].items()]}


def pa_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, pa_type(f.dataType)) for f in kind])
    if isinstance(kind, T.MapType):
        return pa.map_(pa_type(kind.keyType), pa_type(kind.valueType))
    return {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "int": pa.int32()}[kind.simpleString()]


# ---- rows: one question, or several, about each


@dataclass(frozen=True)
class Record:
    """A state with the row's fields, some of them renamed, under one name."""

    name: str
    renamed: tuple[tuple[str, str], ...] = ()

    def __call__(self, row: dict[str, Any]) -> State:
        new = dict(self.renamed)
        return {self.name: {new.get(k, k): v for k, v in row.items()}}


@dataclass(frozen=True)
class Flat:
    """A state of one required column; null can't be asked."""

    column: str

    def __call__(self, row: dict[str, Any]) -> State | None:
        return None if row[self.column] is None else {"document": row[self.column]}


INVOICE_FIELDS = ("id_invoice", "issued_date", "country", "service", "total", "discount", "tax", "invoice_status", "balance", "due_date", "client")


@dataclass(frozen=True)
class InvoiceState:
    """What the model sees of an invoice; null fields stay."""

    def __call__(self, row: dict[str, Any]) -> State:
        return {"invoice": {"id": row["id_invoice"], "service_line": row["service"], **{k: v for k, v in row.items() if k not in ("id_invoice", "service")}}}


@dataclass(frozen=True)
class Inside:
    """Asks the model about what is inside a one-entry state."""

    inner: Model
    name: str

    async def answer(self, state: State, questions: Questions) -> Answers:
        return await self.inner.answer(state[self.name], questions)


def score_rows(df: DataFrame, question: str, model: Model, columns: Sequence[str] = INVOICE_FIELDS, instances: int | None = None, state: Callable | None = None) -> DataFrame:
    """df with p_true and error: one yes/no question about every row, written once to the shared folder."""
    found = decided(df, model, {"answer": YesNo(question)}, state or InvoiceState(), columns, df.columns, instances)
    return stored(found.select(*df.columns, F.col("answer.yes")["answer"].alias("p_true"), "error"), "row_scores")


def matching_rows(scored: DataFrame, order: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """The rows that are at least `threshold` likely, most confident first; rows without a score are dropped."""
    return scored.where(F.col("p_true") >= threshold).drop("error").orderBy(F.desc("p_true"), *order)


def classify_rows(df: DataFrame, question: str, model: Model, order: Sequence[str] = ("id_invoice",), threshold: float = 0.5, **given: Any) -> DataFrame:
    """An ad-hoc question over rows: score, filter, order."""
    return matching_rows(score_rows(df, question, model, **given), order, threshold)


def distinct_scored(df: DataFrame, question: str, model: Model, columns: Sequence[str], **given: Any) -> DataFrame:
    """As score_rows, but equal states are asked once, and joined back null-safely."""
    asked_once = score_rows(df.select(*columns).distinct(), question, model, columns, **given)
    right = asked_once.select(*[F.col(c).alias(f"__{c}") for c in columns], "p_true", "error")
    condition = [df[c].eqNullSafe(right[f"__{c}"]) for c in columns]
    return df.join(right, condition, "left").select(*df.columns, "p_true", "error")


def asked_before(model: Model, questions: Questions) -> str:
    """What an answer depends on besides the state: the model, by its name and settings, and the questions."""
    return f"{type(model).__module__}.{type(model).__qualname__}|{model!r}|{ {k: repr(q) for k, q in sorted(questions.items())} }"


def cached_answers(
    df: DataFrame, model: Model, questions: Questions, state: Callable[[dict[str, Any]], State | None], columns: Sequence[str], cache: VersionedTable, version: str | None = None, instances: int | None = None
) -> DataFrame:
    """df with answer and error, asking only what the cache doesn't know.

    An answer is kept under a hash of the state's columns (null and empty differ), the questions, and `version`, which names the
    model and what it depends on (if None, its class and its repr, which must then tell all that). Each state is asked
    once, however many rows have it; answers are added to the cache in one step after all of them are there, so a task that is repeated
    asks again but adds nothing twice. Failures aren't kept: the next run asks them again. Of two runs at once that add to a
    cache, the later one adds to what the earlier one left.
    """
    spark = df.sparkSession
    about = F.lit(hashlib.sha256((version or asked_before(model, questions)).encode() + repr(sorted(questions.items())).encode()).hexdigest())
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    rows = stored(df.withColumn("__key", F.sha2(F.concat(about, text), 256)), "keyed")
    known = cache.read().select("key", "answer") if cache.versions() else spark.createDataFrame([], T.StructType([T.StructField("key", STRING), T.StructField("answer", ANSWER)]))
    new = rows.select(F.col("__key").alias("key"), *columns).dropDuplicates(["key"]).join(known, "key", "left_anti")
    found = stored(decided(new, model, questions, state, columns, ["key"], instances), "answers")
    fresh = found.where("error IS NULL").select("key", "answer")
    if not fresh.isEmpty():
        while True:
            try:
                cache.append(fresh.join(cache.read(), "key", "left_anti") if cache.versions() else fresh)
                break
            except Conflict:
                continue
    every = known.select(F.col("key").alias("__key"), "answer", F.lit(None).cast("string").alias("error")).unionByName(found.withColumnRenamed("key", "__key"))
    answers = every.join(rows.select("__key").distinct(), "__key", "left_semi")
    return joined(rows, answers, ["__key"], hot_keys(rows, "__key")).drop("__key")


# ---- documents: the fixed three questions, in a batch or for SQL

TICKET_QUESTIONS: dict[str, Question] = {
    "billing": YesNo("Is this ticket about billing?"),
    "tone": Choice("What is the customer's tone?", {"calm": None, "frustrated": None, "angry": None}),
    "urgency": Scale("How urgent is this ticket?", ("can wait", "this week", "today")),
}


def classify_batch(df: DataFrame, model: Model, id_col: str = "id", document_col: str = "document", questions: Questions = TICKET_QUESTIONS, in_flight: int = 8, instances: int | None = None) -> DataFrame:
    """(id, billing, tone, tone_confidence, urgency, urgency_confidence, error) of every document; a null one is an error of its row."""
    found = decided(df, model, questions, Flat(document_col), [document_col], [id_col], instances, in_flight)
    a, tone, urgency = F.col("answer"), F.col("answer.choices")["tone"], F.col("answer.scales")["urgency"]
    return found.select(
        id_col, a["yes"]["billing"].alias("billing"), tone["choice"].alias("tone"), tone["confidence"].alias("tone_confidence"),
        urgency["score"].alias("urgency"), urgency["confidence"].alias("urgency_confidence"), "error",
    )


def flat_json(answer: dict[str, Any]) -> str:
    """An answer to the three questions as one JSON text."""
    tone, urgency = answer["choices"]["tone"], answer["scales"]["urgency"]
    return json.dumps(
        {
            "model": answer["model"], "request_id": answer["request_id"], **answer["usage"], "billing": answer["yes"]["billing"],
            "tone": tone["choice"], "tone_confidence": tone["confidence"], "tone_probabilities": tone["probabilities"],
            "urgency": urgency["score"], "urgency_confidence": urgency["confidence"], "urgency_legend": urgency["legend"], "urgency_probabilities": urgency["probabilities"],
        }
    )


def register(spark: SparkSession, model: Model, questions: Questions = TICKET_QUESTIONS, in_flight: int = 8) -> None:
    """The SQL surface: `classify(text)` gives JSON (null for null; a failure fails the query), and
    `classify_batch(TABLE(SELECT id, document …) PARTITION BY …)` rows with an error column."""
    @F.pandas_udf("string")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with client(model) as runner:
            for batch in batches:
                states = [None if x is None else {"document": x} for x in batch]
                out = []
                for answer, error in runner.run(asked(model, states, questions, in_flight, "")):
                    if error:
                        raise RuntimeError(error)
                    out.append(answer and flat_json(answer))
                yield pd.Series(out, dtype=object)

    spark.udf.register("classify", classify.asNondeterministic())

    class ClassifyBatch:
        """Asks in slices, so that a partition of any size passes through in bounded memory."""

        def __init__(self) -> None:
            self.rows: list[tuple[Any, Any]] = []
            self.client = client(model)
            self.runner = self.client.__enter__()

        def eval(self, row: Any) -> Iterator[tuple]:
            self.rows.append((row["id"], row["document"]))
            if len(self.rows) >= SLICE:
                yield from self.answers()

        def answers(self) -> Iterator[tuple]:
            states = [None if d is None else {"document": d} for _, d in self.rows]
            found = self.runner.run(asked(model, states, questions, in_flight, "null document"))
            for (key, _), (answer, error) in zip(self.rows, found):
                tone, urgency = (answer["choices"]["tone"], answer["scales"]["urgency"]) if answer else ({}, {})
                yield str(key), answer and answer["yes"]["billing"], tone.get("choice"), tone.get("confidence"), urgency.get("score"), urgency.get("confidence"), error
            self.rows = []

        def terminate(self) -> Iterator[tuple]:
            yield from self.answers()
            self.client.__exit__(None, None, None)

    kind = "id STRING, billing DOUBLE, tone STRING, tone_confidence DOUBLE, urgency DOUBLE, urgency_confidence DOUBLE, error STRING"
    spark.udtf.register("classify_batch", F.udtf(ClassifyBatch, returnType=kind))


# ---- pairs of records

PAIR_FIELDS = ("name", "address", "country", "website", "vat_id")
PAIR_QUESTIONS: dict[str, Question] = {
    "same": YesNo(
        "Would both records belong in one customer account?",
        "Yes where they stand for a single legal person. Spelling, language, abbreviations, legal form, layout of addresses and notation of numbers do not count.",
        "No where two legal persons are meant, be they relatives, namesakes or neighbours. An office address may serve thousands of firms, so by itself it says nothing.",
    ),
    "name": YesNo("Taken alone, do the two names denote one firm? Ignore how they are spelt, shortened, translated or ended."),
    "address": YesNo("Taken alone, do the two addresses lead to one building? Ignore how they are written."),
    "website": YesNo("Taken alone, are the two web or mail addresses on one registered domain?"),
    "vat_id": YesNo("Taken alone, do the two tax numbers have equal digits? Ignore blanks, marks and the country's letters."),
}
#: The same as a scale, for a review of pairs that are neither.
PAIR_SCALE: dict[str, Question] = {"relation": Scale("How are the two records related?", ("different firms", "related firms", "one firm"))}
#: Columns of a score, by the question that gives them.
PAIR_SCORES = {"p_same": "same", "p_name": "name", "p_address": "address", "p_website": "website", "p_vat": "vat_id"}


@dataclass(frozen=True)
class PairState:
    """Both records without their null fields."""

    def __call__(self, row: dict[str, Any]) -> State:
        side = lambda s: {f: row[f"{s}_{c}"] for f, c in zip(PAIR_FIELDS, ("name", "address", "country", "website", "vat")) if row[f"{s}_{c}"] is not None}
        return {"record_a": side("a"), "record_b": side("b")}


@dataclass(frozen=True)
class PairQuestions:
    """Name and sameness always; the other fields only where both records have them."""

    def __call__(self, state: State) -> Questions:
        both = set(state["record_a"]) & set(state["record_b"])
        return {k: q for k, q in PAIR_QUESTIONS.items() if k in ("same", "name") or k in both}


def ask_pairs(pairs: DataFrame, model: Model, instances: int | None = None) -> DataFrame:
    """(pair_id, p_same, p_name, p_address, p_website, p_vat, error); what wasn't asked is null."""
    reads = [f"{s}_{c}" for s in "ab" for c in ("name", "address", "country", "website", "vat")]
    found = decided(pairs, model, PairQuestions(), PairState(), reads, ["pair_id"], instances)
    return found.select("pair_id", *[F.col("answer.yes")[q].alias(p) for p, q in PAIR_SCORES.items()], "error")


def relate_pairs(pairs: DataFrame, model: Model, instances: int | None = None) -> DataFrame:
    """(pair_id, relation, relation_confidence, error): the pairs on the three levels of PAIR_SCALE, from 0 (different) to 2 (one firm)."""
    reads = [f"{s}_{c}" for s in "ab" for c in ("name", "address", "country", "website", "vat")]
    found = decided(pairs, model, PAIR_SCALE, PairState(), reads, ["pair_id"], instances)
    relation = F.col("answer.scales")["relation"]
    return found.select("pair_id", relation["score"].alias("relation"), relation["confidence"].alias("relation_confidence"), "error")


def score_pairs(pairs: DataFrame, model: Model, retry: Model | None = None, instances: int | None = None) -> DataFrame:
    """Scores of all pairs, written once; those that failed are asked once more and merged in, which clears their errors."""
    scores = stored(ask_pairs(pairs, model, instances), "pair_scores")
    failed = scores.where("error IS NOT NULL").select("pair_id")
    if failed.isEmpty():
        return scores
    again = stored(ask_pairs(pairs.join(failed, "pair_id", "left_semi"), retry or model, instances), "pair_scores")
    return stored(merged(scores, again, "pair_id", [*PAIR_SCORES, "error"]), "pair_scores")


def versions(spark: SparkSession) -> DataFrame:
    """(package, version) as a worker process has them."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import importlib.metadata as m

        for _ in batches:
            names = ["pyspark", "pyarrow", "pandas", "numpy"]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([m.version(n) for n in names])], ["package", "version"])

    return spark.range(1).coalesce(1).mapInArrow(probe, "package STRING, version STRING")

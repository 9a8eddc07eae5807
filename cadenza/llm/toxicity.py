"""Toxicity by a weighted finite-state grammar over clauses (operator 7).

Words become symbols of five classes: insults (a lexicon of word stems with
weights, learned from labels), threats, targets, negations and reported-speech
marks (fixed lists). Three small transducers over the symbols of one clause
(negation, reported speech, match) are composed into the machine that reads it:
a negation just before an insult or threat weakens it, as reported speech does
the clause; an insult, or a threat with a target, makes a match, and a target
raises its weight. A document's score is a logistic function of its matched
clauses, whose coefficients are learned too.

Stems have 4 to 8 bytes, shorter words are learned whole. A stem is learned if
its evidence (twice the log-likelihood ratio of stem and label) is at least
``MIN_EVIDENCE`` and it has at least ``MIN_TOXIC`` toxic rows of the sample.

Learning uses only labelled rows whose crc32(doc_id) modulo 5 is not 0, and of
these the ``TRAIN_ROWS`` with the smallest hash of doc_id (the documented
bound of the sample). Scores are computed for every row from its text alone.

Null or empty texts have no clauses and get the score of a document without a
match. Repeated labels of one document count once (the larger). A null doc_id
is never labelled; its ``held_out`` is false. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import BROADCAST_ROWS, in_batches, slices, stored, table
from cadenza.llm.licenses import WORD_TABLE

TRAIN_ROWS = 40_000
STEM = range(4, 9)  # bytes of a learned stem; shorter words are learned whole
WHOLE = b"\0"  # ends a word that is learned whole
LEXICON = 8_000  # stems that the driver takes at most, by evidence
MIN_TOXIC = 3
MIN_LIFT = 2.0
MIN_EVIDENCE = 20.0  # twice the log-likelihood ratio of a stem and the label
FOLDS = 5
FEATURES = ["total", "largest", "clauses", "density", "threats", "known"]

# Fixed word lists, English, German, French, Spanish.
THREATS = {"kill", "murder", "hurt", "destroy", "strangle", "umbringen", "töten", "tuer", "frapper", "matar", "destruir"}
TARGETS = {"you", "your", "he", "she", "they", "them", "him", "her", "these", "those", "people", "du", "ihr", "sie", "dich", "tu",
           "toi", "vous", "ils", "elles", "tú", "vosotros", "ellos", "ellas", "ustedes"}
NEGATIONS = {"not", "never", "isn't", "nicht", "kein", "keine", "pas", "jamais", "nunca", "tampoco"}
REPORTS = {"said", "says", "wrote", "called", "quoted", "reported", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió"}

_CLAUSE = re.compile(r"[.!?;:\n]+")


def crc_fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_TABLE).split()


# ---- learning ---------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """text and toxic of the bounded training sample."""
    chosen = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(crc_fold(F.col("doc_id")) != 0)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    if rows <= BROADCAST_ROWS:  # its size is bounded by ``rows``
        chosen = F.broadcast(chosen)
    return docs.select("doc_id", "text").join(chosen, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def stem_counts(train: DataFrame) -> DataFrame:
    """stem, toxic, clean: documents of either label that have a word beginning with it."""
    def run(batches):
        for b in slices(batches):  # small, as a slice's stems are held as a dict
            counts: dict[bytes, list[int]] = {}
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                words = set(_words(text))
                stems = {w[:k] for w in words for k in STEM if len(w) >= k} | {w + WHOLE for w in words if len(w) < STEM.start}
                for s in stems:
                    counts.setdefault(s, [0, 0])[0 if y else 1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], ["stem", "toxic", "clean"])
    return train.transform(in_batches, run, "stem binary, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_lexicon(candidates: list[tuple[bytes, int, int]], toxic: int, clean: int) -> dict[bytes, float]:
    """Stems by falling evidence; a stem that a chosen one begins, or that begins a chosen one, adds nothing."""
    weigh = lambda t, c: math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
    scored = sorted(((weigh(t, c) * t, -len(s), s, weigh(t, c)) for s, t, c in candidates), reverse=True)
    chosen: dict[bytes, float] = {}
    beginnings: set[bytes] = set()
    for _, _, stem, weight in scored:
        parts = {stem[:k] for k in range(STEM.start, len(stem) + 1)} | {stem}
        if stem not in beginnings and chosen.keys().isdisjoint(parts):
            chosen[stem] = weight
            beginnings |= parts
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Coefficients (intercept first) by Newton steps with a ridge penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


# ---- the grammar ------------------------------------------------------------

class Transducer:
    """A sequential weighted transducer: (state, symbol) gives (state, symbol out, factor); an accepting state a final factor.

    A symbol without a transition stays itself, at factor 1, in the same state.
    """

    def __init__(self, start, steps: dict, final: dict):
        self.start, self.steps, self.final = start, steps, final

    def step(self, state, symbol: str):
        return self.steps.get((state, symbol), (state, symbol, 1.0))

    def compose(self, other: Transducer, alphabet: str) -> Transducer:
        """``other`` reads what this one writes; only pairs of states that can be reached are built."""
        start = (self.start, other.start)
        steps, final, open_pairs, seen = {}, {}, [start], {start}
        while open_pairs:
            pair = open_pairs.pop()
            a, b = pair
            final[pair] = self.final[a] * other.final[b]
            for symbol in alphabet:
                to_a, middle, x = self.step(a, symbol)
                to_b, out, y = other.step(b, middle)
                steps[pair, symbol] = ((to_a, to_b), out, x * y)
                if (to_a, to_b) not in seen:
                    seen.add((to_a, to_b))
                    open_pairs.append((to_a, to_b))
        return Transducer(start, steps, final)


# Symbols: an insult, a threat, their negated forms, a target, a negation, a reported-speech mark, any other word.
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "ITYNRO"
NEGATED = {INSULT: "i", THREAT: "t"}
AIMED, WEAKENED, QUOTED = 1.25, 0.3, 0.5  # factors of a target, a negation, reported speech
REACH = 2  # words that a negation reaches


def negation_machine() -> Transducer:
    """Counts down from a negation; insults and threats within reach come out negated, at a lower weight."""
    steps = {}
    for left in range(REACH + 1):
        steps[left, NEGATION] = (REACH, OTHER, 1.0)
        if left:
            steps.update({(left, s): (left - 1, s, 1.0) for s in (TARGET, REPORT, OTHER)})
            steps.update({(left, s): (left - 1, NEGATED[s], WEAKENED) for s in NEGATED})
    return Transducer(0, steps, {left: 1.0 for left in range(REACH + 1)})


def report_machine() -> Transducer:
    """Weakens a clause that reports speech."""
    return Transducer("direct", {(s, REPORT): ("reported", OTHER, 1.0) for s in ("direct", "reported")}, {"direct": 1.0, "reported": QUOTED})


def match_machine() -> Transducer:
    """Accepts a clause with an insult, or with a threat and a target it is aimed at; a target raises the weight.

    A state is the set of what the clause has had.
    """
    states = [frozenset(x for j, x in enumerate((INSULT, THREAT, TARGET)) if k >> j & 1) for k in range(8)]
    kinds = {INSULT: INSULT, "i": INSULT, THREAT: THREAT, "t": THREAT, TARGET: TARGET}
    steps = {(state, s): (state | {kind}, s, 1.0) for state in states for s, kind in kinds.items()}
    accepts = lambda state: INSULT in state or {THREAT, TARGET} <= state
    return Transducer(frozenset(), steps, {state: accepts(state) * (AIMED if TARGET in state else 1.0) for state in states})


def clause_machine() -> Transducer:
    """The composition of the three, over the symbols of the lexicon."""
    alphabet = INSULT + THREAT + TARGET + NEGATION + REPORT + OTHER
    return negation_machine().compose(report_machine(), alphabet).compose(match_machine(), alphabet)


class Grammar:
    """The lexicon, itself a transducer from words to symbols with weights, and the composed machine that reads these."""

    THREAT_WEIGHT = 4.0

    def __init__(self, lexicon: dict[bytes, float]):
        self.lexicon = lexicon
        self.sizes = sorted({len(s) for s in lexicon if s[-1:] != WHOLE}, reverse=True)
        self.fixed = {w.encode(): symbol for symbol, words in ((THREAT, THREATS), (TARGET, TARGETS), (REPORT, REPORTS), (NEGATION, NEGATIONS)) for w in words}
        # First bytes of any insult or threat: most documents need nothing more.
        self.heads = {s.rstrip(WHOLE)[:4] for s in [*lexicon, *(w for w, s in self.fixed.items() if s == THREAT)]}
        machine = clause_machine()
        number = {state: i for i, state in enumerate(machine.final)}
        self.start, self.final = number[machine.start], list(machine.final.values())
        self.steps: list[dict[str, tuple[int, float]]] = [{} for _ in number]
        for (state, symbol), (to, _, factor) in machine.steps.items():
            self.steps[number[state]][symbol] = (number[to], factor)

    def insult(self, word: bytes) -> float:
        if len(word) < STEM.start:
            return self.lexicon.get(word + WHOLE, 0.0)
        for n in self.sizes:
            if len(word) >= n and word[:n] in self.lexicon:
                return self.lexicon[word[:n]]
        return 0.0

    def symbol(self, word: bytes) -> tuple[str, float]:
        """A word's symbol and weight. Function words are never insults; a threat is one that the lexicon has not learned."""
        fixed = self.fixed.get(word, OTHER)
        if fixed in (TARGET, REPORT, NEGATION):
            return fixed, 0.0
        weight = self.insult(word)
        if weight:
            return INSULT, weight
        return (THREAT, self.THREAT_WEIGHT) if fixed == THREAT else (OTHER, 0.0)

    def clause(self, words: list[bytes]) -> tuple[float, int, int]:
        """Weight, insults and threats of one clause; weight 0 where the machine does not accept it."""
        state, total, insults, threats = self.start, 0.0, 0, 0
        for w in words:
            symbol, weight = self.symbol(w)
            state, factor = self.steps[state][symbol]
            total += weight * factor
            insults += symbol == INSULT
            threats += symbol == THREAT
        total *= self.final[state]
        return (total, insults, threats) if total else (0.0, 0, 0)

    def features(self, text: str | None) -> list[float]:
        data = (text or "").encode()
        words = data.translate(WORD_TABLE).split()
        heads = self.heads
        if not any(w[:4] in heads for w in words):
            return [0.0] * len(FEATURES)
        total = largest = 0.0
        clauses = found = threats = 0
        for part in _CLAUSE.split(text):
            weight, insults, t = self.clause(part.encode().translate(WORD_TABLE).split())
            if weight:
                total, largest, clauses = total + weight, max(largest, weight), clauses + 1
                found, threats = found + insults, threats + t
        return [math.log1p(total), math.log1p(largest), math.log1p(clauses), min(1.0, 50.0 * (found + threats) / len(words)), math.log1p(threats), float(clauses > 0)]


def train_model(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[Grammar, np.ndarray]:
    """Lexicon and coefficients from the bounded sample; without labels all scores are 0.1."""
    train = stored(training_rows(docs, labels, rows), "toxic-train")
    n = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    if not n["t"] or n["t"] == n["n"]:
        return Grammar({}), np.array([math.log(0.1 / 0.9), *[0.0] * len(FEATURES)])
    t, c = n["t"], n["n"] - n["t"]
    lift = F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("clean") + 0.5) / (c + 1))
    seen = F.col("toxic") + F.col("clean")
    term = lambda x, share: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / (seen * share))).otherwise(0.0)
    evidence = 2 * (term("toxic", t / n["n"]) + term("clean", c / n["n"]))
    stems = (stem_counts(train).where((F.col("toxic") >= MIN_TOXIC) & (lift >= MIN_LIFT) & (evidence >= MIN_EVIDENCE))
             .orderBy(F.desc(lift * F.col("toxic")), "stem").limit(LEXICON).collect())
    grammar = Grammar(choose_lexicon([(bytes(r["stem"]), r["toxic"], r["clean"]) for r in stems], t, c))
    sample = features(train, grammar, ["toxic"]).toPandas()  # at most ``rows`` rows of seven numbers
    return grammar, fit_logistic(sample[FEATURES].to_numpy(), sample["toxic"].to_numpy(dtype=float))


def features(rows: DataFrame, grammar: Grammar, keep: list[str]) -> DataFrame:
    def run(batches):
        for b in slices(batches):
            found = np.array([grammar.features(x) for x in b.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *(pa.array(column) for column in found.T)], [*keep, *FEATURES])
    kinds = dict(rows.dtypes)
    return rows.select(*keep, "text").transform(in_batches, run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), *(f"{f} double" for f in FEATURES)]))


# ---- the operator -----------------------------------------------------------

def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    grammar, w = train_model(docs, labels, rows)
    linear = F.lit(float(w[0]))
    for f, x in zip(FEATURES, w[1:], strict=True):
        linear = linear + F.col(f) * float(x)
    out = features(docs, grammar, ["doc_id"]).withColumn("score", 1 / (1 + F.exp(-linear)))
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.col("clauses").alias("matched_clauses"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose own text is predicted toxic; all columns stay."""
    grammar, w = train_model(docs, labels)
    names = docs.columns

    def run(batches):
        for b in slices(batches):
            x = np.array([grammar.features(t) for t in b.column("text").to_pylist()])
            yield b.filter(pa.array(x @ w[1:] + w[0] < 0))
    return docs.select(*names).transform(in_batches, run, docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

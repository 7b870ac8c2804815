"""Toxicity of whole texts by a weighted finite-state pattern grammar over clauses.

Words become classes: insult, threat, target, negation, reported speech, or other.
Small weighted transducers read the classes of a clause: ``negation`` stays on for a few
words, ``reporting`` to the end of the clause, ``targeting`` tells whether the clause
addresses someone, and ``offence`` emits an insult or a threat.  Their composition is one
machine that gives each matched offence a kind: insult or threat, aimed or not, negated
or not, reported or not.  A text is scored by how much weight each kind of match has
gathered, through a logistic function; a word alone, outside a match, scores nothing.

Insults are words and word beginnings that training rows show to mark toxic texts; the
other classes are short fixed lists.  The lexicon and the logistic weights are fitted on a
sample of at most about ``SAMPLE`` labelled rows, picked by a hash of the id among those
with ``crc32(id) mod 5`` other than 0; it holds distinct texts only, so copies do not
count twice.  Only the sample's ids (a bounded table) are broadcast.

A null or empty text has no match and the score of a clean text; without any label every
score is 0.  Ties, repeated rows and very long texts need no special care, and a table
without rows gives no rows.  Only the text is read; all columns are passed on in a struct.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 8000               # labelled rows the lexicon and the weights are fitted on
SUPPORT = 5                 # toxic texts of the sample that must hold a word or beginning
SURE = 0.6                  # lower bound of the share of toxic texts among those that hold it
BEGINNING = range(4, 9)     # letters of a word's beginning
FLUSH = 400_000

# Word classes of the grammar.
THREATS = ("kill", "hurt", "destroy", "beat", "shoot", "burn", "crush", "smash", "stab", "punish",
           "töten", "schlagen", "vernichten", "verletzen", "tuer", "frapper", "détruire", "brûler",
           "matar", "golpear", "destruir", "quemar")
TARGETS = ("you", "your", "yours", "yourself", "he", "she", "him", "her", "they", "them", "this", "these",
           "du", "dich", "dir", "ihr", "euch", "sie", "dieser", "tu", "toi", "vous", "te", "ton", "ces",
           "tú", "usted", "ustedes", "ti", "este", "estos")
NEGATIONS = ("not", "never", "no", "isn't", "don't", "without", "nicht", "kein", "keine", "nie", "ohne",
             "pas", "jamais", "sans", "aucun", "nunca", "jamás", "sin", "ningún")
REPORTS = ("said", "says", "say", "called", "calls", "claimed", "wrote", "quoted", "sagte", "sagt", "schrieb",
           "nannte", "dit", "disait", "écrit", "appelé", "dijo", "dice", "llamó", "escribió")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
NEGATED_WORDS = 3           # words after a negation that it reaches

_LETTER = r"[^\W\d_]"
_TOKEN = re.compile(rf"{_LETTER}+(?:'{_LETTER}+)?|[.!?;:\n]")


class _Blanks(dict):
    """Translates every character that no word of ``_TOKEN`` holds, and the apostrophe, to a blank."""

    def __missing__(self, code: int) -> int:
        self[code] = code if re.match(_LETTER, chr(code)) else 32
        return self[code]


_PLAIN = _Blanks()


class Transducer(NamedTuple):
    """``step[state][class]`` is the next state, ``out[state][class]`` the weights emitted on the way."""

    step: list[list[int]]
    out: list[list[tuple[int, ...]]]


def _flag(raises: int, reach: int | None) -> Transducer:
    """Emits 1 with each word once ``raises`` was read, for ``reach`` words or to the clause's end."""
    states = 2 if reach is None else reach + 1
    step, out = [], []
    for s in range(states):
        rest = s if reach is None else max(s - 1, 0)
        step.append([states - 1 if c == raises else rest for c in range(6)])
        out.append([(int(s > 0),) for _ in range(6)])
    return Transducer(step, out)


OFFENCE = Transducer([[0] * 6], [[(1 if c == INSULT else 2 if c == THREAT else 0,) for c in range(6)]])


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The machine that runs both over the same classes and emits what both emit."""
    width = len(b.step)
    pairs = list(itertools.product(range(len(a.step)), range(width)))
    return Transducer([[a.step[i][c] * width + b.step[j][c] for c in range(6)] for i, j in pairs],
                      [[a.out[i][c] + b.out[j][c] for c in range(6)] for i, j in pairs])


GRAMMAR = compose(compose(OFFENCE, _flag(NEGATION, NEGATED_WORDS)), _flag(REPORT, None))
TARGETING = _flag(TARGET, None)

# a kind: insult or threat (1 bit), aimed (1), negated (1), reported (1)
KINDS = 16
FEATURES = KINDS + 2


def matches(classes: list[int], weights: list[float]) -> list[tuple[int, float]]:
    """(kind, weight) of every matched offence in one clause."""
    state = 0
    for c in classes:
        state = TARGETING.step[state][c]
    aimed = int(state > 0)
    found, state = [], 0
    for c, weight in zip(classes, weights):
        offence, negated, reported = GRAMMAR.out[state][c]
        if offence:
            found.append(((offence - 1) << 3 | aimed << 2 | negated << 1 | reported, weight))
        state = GRAMMAR.step[state][c]
    return found


class Lexicon:
    """Word classes, with the learned insults and their weights."""

    def __init__(self, insults: dict[str, float]):
        """``insults``: words, or beginnings marked by a trailing ``*``, with weights."""
        import ahocorasick

        self.words = {w: (INSULT, x) for w, x in insults.items() if not w.endswith("*")}
        self.heads = {w[:-1]: x for w, x in insults.items() if w.endswith("*")}
        for kind, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            for w in words:
                self.words.setdefault(w, (kind, 1.0))
        self.finder = ahocorasick.Automaton()
        for w in insults:
            self.finder.add_word(" " + (w[:-1] if w.endswith("*") else w + " ").translate(_PLAIN), 1)
        for w in THREATS:
            self.finder.add_word(f" {w} ".translate(_PLAIN), 1)
        self.finder.make_automaton()

    def classify(self, word: str) -> tuple[int, float]:
        known = self.words.get(word)
        if known is None:
            for n in BEGINNING:
                if (x := self.heads.get(word[:n])) is not None and len(word) >= n:
                    return INSULT, x
            return OTHER, 0.0
        return known

    def features(self, text: str | None) -> list[float]:
        """What the grammar gathers in a text: log weight by kind, over all kinds, and per word."""
        out = [0.0] * FEATURES
        if not text:
            return out
        low = text.lower()
        if next(self.finder.iter(f" {low.translate(_PLAIN)} "), None) is None:
            return out          # no offence anywhere, so no clause can match
        words, classes, weights = 0, [], []
        for token in itertools.chain(_TOKEN.findall(low), ["."]):
            if token[0] in ".!?;:\n":
                if classes:
                    if INSULT in classes or THREAT in classes:
                        for kind, weight in matches(classes, weights):
                            out[kind] += weight
                    classes, weights = [], []
                continue
            kind, weight = self.classify(token)
            classes.append(kind)
            weights.append(weight)
            words += 1
        total = sum(out)
        return [math.log1p(x) for x in out[:KINDS]] + [math.log1p(total), math.log1p(100 * total / max(words, 1))]


class Model(NamedTuple):
    insults: dict[str, float]
    weights: np.ndarray | None      # bias first


def _tokens(text: str) -> set[str]:
    words = set(_TOKEN.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in BEGINNING if len(w) > n}


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and toxic texts of a task that hold each word or beginning."""
    held, toxic = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        names = list(held)
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([held[x] for x in names], pa.int64()),
                                          pa.array([toxic[x] for x in names], pa.int64())], names=["token", "n", "bad"])
        held.clear()
        toxic.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens = _tokens(text)
            held.update(tokens)
            if label:
                toxic.update(tokens)
            if len(held) > FLUSH:
                yield flush()
    yield flush()


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression, bias first, by Newton steps."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE, seed: int = 3) -> Model:
    known = (labels.select(labels[key].alias("key"), labels[label].cast("int").alias("label"))
             .filter(F.col("label").isNotNull() & (F.crc32(F.col("key").cast("string").cast("binary")) % 5 != 0)))
    total = known.count()
    if not total:
        return Model({}, None)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.filter(draw < sample / total).groupBy("key").agg(F.max("label").alias("label"))   # about SAMPLE rows
    rows = (docs.select(docs[key].alias("key"), docs[text].alias("text")).filter(F.col("text").isNotNull())
            .join(F.broadcast(chosen), "key").groupBy("text").agg(F.max("label").alias("label")))

    counted = (rows.select("text", "label").mapInArrow(_counts, "token string, n bigint, bad bigint")
               .groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
               .filter((F.col("bad") >= SUPPORT) & (F.col("bad") > SURE * F.col("n"))))
    insults = {}
    z = 1.64
    for token, n, bad in sorted(counted.collect()):      # few of the sample's words mark toxic texts
        share = bad / n
        low = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if low >= SURE:
            insults[token] = 1.0 + low
    lexicon_of = _cached(insults)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_of()
        for batch in batches:
            found = [lexicon.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))],
                                             names=["label", "x"])

    seen = rows.select("text", "label").mapInArrow(gather, "label int, x array<double>").toPandas()
    if not len(seen):
        return Model(insults, None)
    order = sorted(range(len(seen)), key=lambda i: (seen["label"][i], tuple(seen["x"][i])))
    x, y = np.stack([seen["x"][i] for i in order]), seen["label"].to_numpy()[order].astype(float)
    return Model(insults, _logistic(x, y))


def _cached(insults: dict[str, float]):
    """The lexicon, built once per worker process from what the task brings along."""
    def build() -> Lexicon:
        name = hash(tuple(insults.items()))
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = Lexicon(insults)
        return _BUILT[name]
    return build


_BUILT: dict[int, Lexicon] = {}


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``record`` (struct of all columns) with ``score``."""
    lexicon_of, weights = _cached(model.insults), model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_of()
        for batch in batches:
            if weights is None:
                score = np.zeros(batch.num_rows)
            else:
                x = np.array([lexicon.features(t) for t in batch.column(0).to_pylist()]).reshape(-1, FEATURES)
                score = 1 / (1 + np.exp(-np.clip(x @ weights[1:] + weights[0], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(score, pa.float64())], names=["record", "score"])

    record = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("record")
    rows = docs.select(docs[text].alias("text"), record)
    schema = T.StructType([rows.schema["record"], T.StructField("score", T.DoubleType())])
    names = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    return rows.mapInArrow(run, schema).withColumn("record", F.col("record").cast(names))

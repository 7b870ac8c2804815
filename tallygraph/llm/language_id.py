"""Language of whole texts: sparse multinomial logistic regression on TF-IDF of character n-grams.

A text's features are its hashed 1- to 3-grams of lower-cased characters: the count of
each over the number of grams, times the inverse document frequency.  The frequencies come
from every labelled training row.  The weights are fitted by follow-the-regularised-leader
with elastic-net penalties on a sample of at most about ``PER_LANGUAGE`` rows of each
language, picked by a hash of the id, so the driver holds a bounded number of sparse rows.
Another bounded sample sets one temperature that scales the scores into probabilities.

Training rows are those of ``crc32(id) mod 4`` other than 2 with a language; a row with a
null id or text does not train.  Texts without a letter, null ones included, are ``und``
with score 0, as is everything if there is nothing to learn from.  Ties go to the language
first in the alphabet.  Repeated rows and very long texts need no special care; an empty
table gives no rows.  ``predicted`` reads no column but the text and passes all on under
their own names, inside one struct, so added names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygraph.llm.common import slices

BUCKETS_LOG2 = 15
BUCKETS = 1 << BUCKETS_LOG2
PER_LANGUAGE = 1500         # rows of a language that fit the weights
CALIBRATION = 400           # rows of a language that fit the temperature
SLICE_CHARS = 400_000
SCALE = 20.0                # brings the mean feature to the order of one
UNKNOWN = "und"


class Ftrl(NamedTuple):
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    epochs: int = 4
    seed: int = 5


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray       # weight times document frequency factor, by bucket and language
    temperature: float


_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Letter test by code point, and lower case of those up to U+FFFF that keep one character."""
    if not _TABLES:
        every = [chr(i) for i in range(0x110000)]
        _TABLES.append(np.fromiter((c.isalpha() for c in every), bool, len(every)))
        low = np.arange(0x110000, dtype=np.uint32)
        for i, c in enumerate(every[:0x10000]):
            if c != (d := c.lower()) and len(d) == 1:
                low[i] = ord(d)
        _TABLES.append(low)
    return _TABLES


def _grams(texts: list[str]) -> Iterator[tuple[int, int, list[np.ndarray], list[np.ndarray], np.ndarray]]:
    """Per slice of the texts: its bounds; by gram length the buckets, text by text, and the texts' bounds; if letters occur."""
    letter, low = _tables()
    for a, b in slices(texts, SLICE_CHARS):
        sizes = np.array([len(t) for t in texts[a:b]], np.int64)
        codes = np.frombuffer("".join(texts[a:b]).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum(sizes)
        letters = np.concatenate([[0], np.cumsum(letter[codes])])
        has_letter = letters[ends] > letters[ends - sizes]
        codes = low[codes]
        left = np.repeat(ends, sizes) - np.arange(len(codes))       # characters from here to the end of the text
        order, parts = [], []
        value = np.zeros(len(codes), np.uint32)
        for n in range(3):
            value[:len(codes) - n] = (value[:len(codes) - n] ^ codes[n:]) * _FACTORS[n]
            inside = np.flatnonzero(left > n)
            parts.append((value[inside] * np.uint32(0x27D4EB2F) + _FACTORS[n]) * np.uint32(0x165667B1)
                         >> np.uint32(32 - BUCKETS_LOG2))
            order.append(inside)
        starts = [np.searchsorted(o, np.concatenate([[0], ends])) for o in order]
        yield a, b, parts, starts, has_letter


def _sums(parts: list[np.ndarray], starts: list[np.ndarray], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the table's rows over each text's grams, and how many grams it has."""
    total, count = 0.0, 0
    for part, start in zip(parts, starts):
        run = np.zeros((len(part) + 1, table.shape[1]))
        np.cumsum(table[part], axis=0, out=run[1:])
        total = total + run[start[1:]] - run[start[:-1]]
        count = count + np.diff(start)
    return total, count


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task that have each bucket."""
    seen_in, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        texts = batch.column(0).to_pylist()
        rows += len(texts)
        for _, _, parts, starts, has in _grams(texts):
            for i in range(len(has)):
                seen = np.zeros(BUCKETS, bool)
                for part, start in zip(parts, starts):
                    seen[part[start[i]:start[i + 1]]] = True
                seen_in += seen
    used = np.flatnonzero(seen_in)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int32()),
                                      pa.array(np.append(seen_in[used], rows), pa.int64())], names=["bucket", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, sample and sparse counts of each row."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        keys, counts = [], []
        for _, _, parts, starts, has in _grams(texts):
            for i in range(len(has)):
                own = np.concatenate([p[s[i]:s[i + 1]] for p, s in zip(parts, starts)])
                k, n = np.unique(own, return_counts=True)
                keys.append(k.astype("<u2").tobytes())
                counts.append(n.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array(keys, pa.binary()),
                                          pa.array(counts, pa.binary())], names=["lang", "part", "draw", "keys", "counts"])


def trains(key: Column, label: Column, text: Column) -> Column:
    """Whether a row may be learned from."""
    return ((F.crc32(key.cast("string").cast("binary")) % 4) != 2) & label.isNotNull() & text.isNotNull()


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, set_: Ftrl) -> np.ndarray:
    """Weights by bucket and class; coordinates below the L1 penalty stay zero."""
    z, n, w = (np.zeros((BUCKETS, classes)) for _ in range(3))
    rng = np.random.default_rng(set_.seed)
    for _ in range(set_.epochs):
        for r in rng.permutation(len(rows)):
            keys, x = rows[r]
            zi, ni = z[keys], n[keys]
            wi = np.where(np.abs(zi) <= set_.l1, 0.0,
                          -(zi - np.sign(zi) * set_.l1) / ((set_.beta + np.sqrt(ni)) / set_.alpha + set_.l2))
            score = x @ wi
            p = np.exp(score - score.max())
            p /= p.sum()
            p[labels[r]] -= 1.0
            g = x[:, None] * p
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / set_.alpha
            z[keys], n[keys] = zi + g - step * wi, ni + g * g
    w = np.where(np.abs(z) <= set_.l1, 0.0,
                 -(z - np.sign(z) * set_.l1) / ((set_.beta + np.sqrt(n)) / set_.alpha + set_.l2))
    return w


def _softmax(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores that gives the labels the highest likelihood."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(5.0), 60))
    pick = np.arange(len(labels))
    loss = [-np.log(np.maximum(_softmax(scores / t)[pick, labels], 1e-12)).sum() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
        per_language: int = PER_LANGUAGE, calibration: int = CALIBRATION, settings: Ftrl = Ftrl()) -> Model:
    rows = (docs.select(docs[text].alias("text"), docs[label].cast("string").alias("lang"), docs[key].alias("key"))
            .filter(trains(F.col("key"), F.col("lang"), F.col("text"))))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}     # a row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), 1.0)
    frequency = np.zeros(BUCKETS)
    total = 0
    counted = rows.select("text").mapInArrow(_frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in counted.collect():         # at most BUCKETS + 1 rows
        if bucket < 0:
            total = n
        else:
            frequency[bucket] = n
    idf = np.log((1 + total) / (1 + frequency)) + 1

    draw = F.pmod(F.xxhash64(F.lit(settings.seed), F.col("key")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.create_map(*[F.lit(x) for lang in languages
                           for x in (lang, (per_language + calibration) / sizes[lang])])[F.col("lang")]
    part = F.when(draw < F.least(share, F.lit(1.0)) * (per_language / (per_language + calibration)), 0).otherwise(1)
    sample = (rows.filter(draw < share).select("text", "lang", part.alias("part"), draw.alias("draw"))
              .mapInArrow(_sparse, "lang string, part int, draw double, keys binary, counts binary").toPandas())
    sample = sample.sort_values(["draw", "lang"], kind="stable")
    labels = sample["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(np.int64)
    sparse = []
    for keys, counts in zip(sample["keys"], sample["counts"]):
        k, n = np.frombuffer(keys, "<u2").astype(np.int64), np.frombuffer(counts, "<u4").astype(float)
        sparse.append((k, SCALE * n / max(n.sum(), 1.0) * idf[k]))
    first = sample["part"].to_numpy() == 0
    train, check = np.flatnonzero(first), np.flatnonzero(~first)
    weights = _ftrl([sparse[i] for i in train], labels[train], len(languages), settings)
    scores = np.array([sparse[i][1] @ weights[sparse[i][0]] for i in check]).reshape(len(check), len(languages))
    return Model(languages, SCALE * idf[:, None] * weights, _temperature(scores, labels[check]))


def predicted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``record`` (struct of all columns) with ``lang_pred`` and ``score``."""
    languages, table, temperature = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*languages, UNKNOWN], object)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            best, score = np.full(len(texts), len(languages)), np.zeros(len(texts))
            for a, b, parts, starts, has in _grams(texts) if languages else ():
                sums, count = _sums(parts, starts, table)
                p = _softmax(sums / np.maximum(count, 1)[:, None] / temperature)
                best[a:b] = np.where(has, p.argmax(axis=1), len(languages))
                score[a:b] = np.where(has, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(names[best], pa.string()), pa.array(score)],
                                             names=["record", "lang_pred", "score"])

    record = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("record")
    rows = docs.select(docs[text].alias("text"), record)
    schema = T.StructType([rows.schema["record"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    names = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    return rows.mapInArrow(run, schema).withColumn("record", F.col("record").cast(names))

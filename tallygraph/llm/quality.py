"""Quality rules in native Spark expressions: base counts, then a likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words fall into ``BUCKETS`` hash buckets.  Two smoothed
multinomials over the buckets are counted, one over the trusted documents (label quality
1), one over all documents.  A document's score is the mean log ratio of the two over its
grams; it is kept if no base rule fails and the score is at least ``THRESHOLD``.  Ratios
are whole millionths, so sums do not depend on their order and every document, at every
size of the corpus, gets the same verdict each time.

Counts cover all documents.  The only thing that leaves the executors is the table of
ratios, one number per bucket.  Labels join by id before grams are made, so each text
moves once: by a shuffled hash join at every size, so that what a small run shows holds
for a large one and texts are never sorted; a task's hash table holds ids and flags only.
Grams are added up in each task before they are shuffled.

A null text has no words: it fails the base rule.  A text without pairs is scored by its
words.  Repeated rows count as often as they occur, a repeated label is trusted if any of
its rows is.  Without trusted documents all ratios are 0 and the base rules decide.
A table without rows gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.common import BLANKS

BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.15           # mean log ratio
UNIT = 1_000_000
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


def with_words(df: DataFrame, text: str, out: str) -> DataFrame:
    return df.withColumn(out, F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BLANKS), ""))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def base_counts(df: DataFrame, text: str, words: str, hashes: str) -> DataFrame:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``."""
    body = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # three-word windows, by 64-bit hash; only texts that repeat one are sorted
    df = df.withColumn("_t", F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - F.lit(2), F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(F.col(hashes), i + F.lit(1)), F.get(F.col(hashes), i + F.lit(2)))))
    df = df.withColumn("_s", F.when(
        F.size("_t") > F.size(F.array_distinct("_t")),
        F.sort_array(F.transform("_t", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_at", F.sort_array(F.filter(
        F.transform("_s", lambda x, i: F.when((x["h"] == F.get(F.col("_s"), i - F.lit(1))["h"])
                                              | (x["h"] == F.get(F.col("_s"), i + F.lit(1))["h"]), x["i"])),
        lambda x: x.isNotNull())))
    covered = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("_at"), i + F.lit(1)) - p, F.lit(3)))),
        F.lit(0), lambda acc, x: acc + x)
    df = df.withColumns({
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": (F.size(F.split(body, f"[{SYMBOLS}]")) - F.lit(1)).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_lines", "_t", "_s", "_at")


def grams(hashes: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of every word and of every pair of neighbours, from the hashes of the words."""
    last = F.greatest(F.size(hashes) - F.lit(1), F.lit(0))
    pairs = F.zip_with(F.slice(hashes, F.lit(1), last), F.slice(hashes, F.lit(2), last), lambda a, b: F.xxhash64(a, b))
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def ratios(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
           buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[int]:
    """Log ratio of trusted to raw, in millionths, by bucket."""
    trusted = (labels.select(labels[key].alias("key"), labels[label].alias("label")).filter("key is not null")
               .groupBy("key").agg((F.max("label") == 1).cast("int").alias("trusted")).hint("shuffle_hash"))
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text")).join(trusted, "key", "left")
    rows = with_words(rows, "text", "w").withColumn("h", word_hashes(F.col("w")))
    rows = rows.select(grams(F.col("h"), buckets).alias("g"), F.coalesce("trusted", F.lit(0)).alias("t"))
    # outer, as Spark would else filter on the size of grams below the join and make them twice
    counts = (rows.select(F.explode_outer("g").alias("g"), "t").groupBy("g")
              .agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target")).filter("g is not null"))
    table = {r["g"]: (r["raw"], r["target"]) for r in counts.collect()}     # at most one row per bucket
    return _ratios(table, buckets, smoothing)


def _ratios(table: dict[int, tuple[int, int]], buckets: int, smoothing: float) -> list[int]:
    raw = sum(r for r, _ in table.values())
    target = sum(t for _, t in table.values())
    if not target:
        return [0] * buckets
    out = []
    for g in range(buckets):
        r, t = table.get(g, (0, 0))
        out.append(round(UNIT * (math.log((t + smoothing) / (target + smoothing * buckets))
                                 - math.log((r + smoothing) / (raw + smoothing * buckets)))))
    return out


def judged(docs: DataFrame, table: list[int], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` in ``record``, the base counts, ``llr_sum`` (millionths), ``n_grams`` and ``kept``."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("record"), docs[text].alias("_text"))
    rows = with_words(rows, "_text", "_words").withColumn("_hashes", word_hashes(F.col("_words")))
    rows = base_counts(rows, "_text", "_words", "_hashes")
    values = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")      # folded to one literal
    rows = rows.withColumn("_g", grams(F.col("_hashes"), len(table)))
    rows = rows.withColumns({"n_grams": F.size("_g").cast("bigint"), "llr_sum": F.aggregate(
        "_g", F.lit(0).cast("bigint"), lambda acc, g: acc + F.get(values, g))})
    good = F.col("llr_sum") >= F.lit(round(threshold * UNIT)) * F.col("n_grams")
    return rows.withColumn("kept", ~F.col("base_failed") & good).drop("_text", "_words", "_hashes", "_g")

"""Cleaning pipeline: language, toxicity, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on every row it is given and returns what it
keeps, in the columns of ``documents``; the last returns packed pieces.  ``run`` writes
every stage's rows as Parquet in the shared folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm import jaccard_join, language_id, packing, substring_dedup, toxicity
from tallygraph.llm.common import documents
from tallygraph.session import materialize

LEAST_SCORE = 0.4       # of a language; below it no language speaks for a text
TOXIC_SCORE = 0.5
NEAR = jaccard_join.Rule(words=5, num=80, den=100)

ORACLE_SQL = None       # learned models and token ids have no SQL; see the brute-force tests


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or in no language in particular, go; so null and empty texts go."""
    judged = language_id.predicted(docs, language_id.fit(docs))
    return judged.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("record.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).filter(F.col("score") < TOXIC_SCORE).select("record.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; a row without an id stays."""
    found = jaccard_join.near_duplicates(docs, NEAR)
    gone = found.filter("component_id <> doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 35 words that occur again go; a text without any keeps its exact form."""
    out = substring_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("record.text"))
    size = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("bigint")).otherwise(F.col("record.n_chars"))
    new = {"text": text, "n_chars": size}
    return out.select(*[new.get(c, F.col(f"record.`{c}`")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("language ID", language), ("toxicity", toxic), ("n-gram Jaccard join", near_copies),
          ("substring dedup", passages), ("best-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs

"""Queries over whole tables: each applies one operator with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm import (byte_bpe, jaccard_join, language_id, merkle, packing, phrases, piece_viterbi, quality, sharding, substring_dedup,
                            toxicity, transcripts, winnowing)
from tallygraph.llm.common import documents, utf8_size

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 40


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _held_out(key: Column, mod: int, rest: int) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % mod == rest, F.lit(False))


@query("op1_external_shuffle")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shards(documents(spark, sf_dir), SHARDS)
    text = F.col("record.text")
    return out.select("record.doc_id", (utf8_size(text) + 16).alias("size"),
                      F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs)
    return language_id.predicted(docs.select("doc_id", "text"), model).select(
        "record.doc_id", _held_out(F.col("record.doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


@query("op3_winnowing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.edited(documents(spark, sf_dir))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      winnowing.rendered(F.col("fingerprint")).alias("fingerprint"),
                      winnowing.rendered(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    table = quality.ratios(docs, documents(spark, sf_dir, "labels"))
    return quality.judged(docs.select("doc_id", "text"), table).select(
        "record.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_grams", "llr_sum")


def transcripts_of(conversations: DataFrame) -> DataFrame:
    """Conversations as transcripts: speaker markers in four styles, one in six left out."""
    role, text = F.col("role"), F.coalesce(F.col("text"), F.lit(""))
    style = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    bare = F.pmod(F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")), F.lit(6)) == 0
    name = F.when(role == "user", "Human").otherwise(F.initcap(role))
    raw = (F.when(bare | role.isNull(), text).when(style == 0, F.concat(F.initcap(role), F.lit(": "), text))
           .when(style == 1, F.concat(F.lit("### "), name, F.lit("\n"), text))
           .when(style == 2, F.concat(F.lit("["), role, F.lit("] "), text))
           .otherwise(F.concat(F.lit("**"), role, F.lit("**: "), text)))
    return conversations.select("conv_id", "turn", raw.alias("text"))


@query("op5_chat_turns")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = documents(spark, sf_dir, "conversations")
    return transcripts.rendered(transcripts_of(table), transcripts.fit(table))


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


@query("op7_ngram_jaccard", """
WITH texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
        FROM texts),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM grams a JOIN grams b ON a.g = b.g
        AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90 AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (WITH RECURSIVE r(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM r JOIN links l ON r.v = l.u)
        SELECT u, min(v) AS v FROM r GROUP BY u)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(least(doc_id, v), doc_id) AS component_id
FROM sets LEFT JOIN reach ON doc_id = u""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir), jaccard_join.Rule(3, 90, 100))


@query("op8_substring_dedup", """
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM texts WHERE len(w) >= 35)),
repeated AS (SELECT doc_id, i FROM windows WHERE g IN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM texts WHERE len(w) > 0),
marked AS (SELECT words.doc_id, words.i, word, count(repeated.i) OVER (PARTITION BY words.doc_id ORDER BY words.i
        ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 0 AS gone
        FROM words LEFT JOIN repeated ON words.doc_id = repeated.doc_id AND words.i = repeated.i),
kept AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS gone,
        coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS left_over FROM marked GROUP BY doc_id)
SELECT texts.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
        sha256(coalesce(left_over, '')) AS kept_sha256 FROM texts LEFT JOIN kept ON texts.doc_id = kept.doc_id""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(documents(spark, sf_dir))
    kept = F.coalesce(F.col("kept"), F.lit("")).cast("binary")
    return out.select("record.doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    return toxicity.scored(docs.select("doc_id", "text"), model).select(
        "record.doc_id", _held_out(F.col("record.doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_viterbi.round_trips(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN)


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query("op13_merkle_manifest", """
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
rows AS (SELECT doc_id, lang, [coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
        coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
        coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')] AS head, text,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c))),
            lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)])), 4294967295) % 3 = 0 AS hit FROM documents, bits),
leaves AS (SELECT doc_id, lang, sha256(array_to_string(head, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN hit THEN sha256(array_to_string(head, '') || coalesce(strlen(low) || ':' || low, '-')) END AS other
        FROM rows),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
up(lang, k, h) AS (SELECT lang, 0, list(leaf ORDER BY i) FROM placed GROUP BY lang
        UNION ALL SELECT lang, k + 1, list_transform(range((len(h) + 7) // 8),
            lambda r: sha256(array_to_string(h[r * 8 + 1:r * 8 + 8], ''))) FROM up WHERE len(h) > 1),
sub AS (SELECT lang, h[1] AS subroot, k AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j
        FROM up WHERE len(h) = 1),
over(k, h) AS (SELECT 0, list(subroot ORDER BY j) FROM sub
        UNION ALL SELECT k + 1, list_transform(range((len(h) + 7) // 8),
            lambda r: sha256(array_to_string(h[r * 8 + 1:r * 8 + 8], ''))) FROM over WHERE len(h) > 1),
nodes AS (SELECT doc_id, i, p.lang, k, h, i // (8 ** k)::BIGINT AS a FROM placed p JOIN up ON p.lang IS NOT DISTINCT FROM up.lang
            WHERE len(h) > 1
        UNION ALL SELECT doc_id, i, p.lang, height + k, h, j // (8 ** k)::BIGINT FROM placed p
            JOIN sub ON p.lang IS NOT DISTINCT FROM sub.lang, over WHERE len(h) > 1),
steps AS (SELECT doc_id, i, lang, k, array_to_string(h[a - a % 8 + 1:a], '') AS l,
        array_to_string(h[a + 2:a - a % 8 + 8], '') AS r FROM nodes),
paths AS (SELECT i, lang, string_agg(l || r, '' ORDER BY k) AS proof, list(l || '|' || r ORDER BY k) AS path
        FROM steps GROUP BY i, lang),
found AS (SELECT doc_id, leaf, subroot, (SELECT h[1] FROM over WHERE len(h) = 1) AS root,
        sha256(coalesce(proof, '')) AS proof_sha256,
        list_reduce(list_concat([coalesce(other, leaf)], coalesce(path, [])),
            lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) AS folded_root
        FROM placed JOIN sub ON placed.lang IS NOT DISTINCT FROM sub.lang
        LEFT JOIN paths ON placed.i = paths.i AND placed.lang IS NOT DISTINCT FROM paths.lang)
SELECT *, folded_root = root AS verified FROM found""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", LETTERS, LETTERS.lower())
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                      merkle.leaf(*[lowered if c == "text" else F.col(c) for c in columns]))
    manifest = merkle.build(docs, columns, extra={"tampered": tampered})
    presented = F.coalesce("tampered", "leaf")
    out = manifest.proofs().select(
        F.col("key").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"),
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(presented, F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


PHRASES = 2000          # of each language, in the report


@query("op12_phrase_collocations", """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
texts AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, unnest(range(1, 6)) AS k FROM texts WHERE len(w) > 0),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized WHERE len(w) >= k)),
counted AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g HAVING count(*) >= 100),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM texts GROUP BY lang),
cand AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM counted WHERE k > 1),
part AS (SELECT lang, f, w, k, unnest(range(2, k)) AS m FROM cand WHERE k > 2),
inner_grams AS (SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS g
        FROM (SELECT lang, f, w, m, unnest(range(1, k - m + 2)) AS i FROM part)),
covered AS (SELECT lang, g, max(f) AS most FROM inner_grams GROUP BY lang, g),
alone AS (SELECT c.* FROM cand c LEFT JOIN covered o ON c.lang = o.lang AND c.g = o.g WHERE most IS NULL OR 100 * most < 100 * c.f),
cut AS (SELECT lang, k, g, f, w, unnest(range(1, k)) AS j FROM alone),
scored AS (SELECT cut.lang, cut.g, cut.f, j, x.f AS l, y.f AS r, n, ((1000::HUGEINT * cut.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS s
        FROM cut JOIN sizes ON cut.lang = sizes.lang
        JOIN counted x ON x.lang = cut.lang AND x.g = array_to_string(w[1:j], ' ')
        JOIN counted y ON y.lang = cut.lang AND y.g = array_to_string(w[j + 1:cut.k], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY s, j) AS o FROM scored),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY s DESC, f DESC, g) AS rank, g, f, l, r, n, s FROM best WHERE o = 1)
SELECT lang, rank::BIGINT AS rank, g AS phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, s AS score
FROM ranked WHERE rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.report(phrases.collocations(phrases.mine(documents(spark, sf_dir))), PHRASES)

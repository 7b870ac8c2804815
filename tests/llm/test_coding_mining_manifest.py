"""Byte-level BPE, phrase mining and the Merkle manifest against brute force and the reference library."""

import base64
import collections
import hashlib
import random
import re
import zlib
from array import array

import public_tokenizers
import pytest

from tallygraph.llm import byte_bpe, language_id, merkle, packing, phrases, piece_viterbi, queries, wordbpe
from tallygraph.llm.common import documents

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
BIG = 2 ** 53 + 1


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, texts without a space, ties, repeated rows, large ids, clashing column names."""
    long = " ".join(f"w{i % 97} x{i % 89}" for i in range(4000))
    rows = [(1, "One two. One two, three ONE TWO", "en"), (2, None, "en"), (3, "", None), (None, "no id  here", None),
            (BIG, "a" * 9000 + "日本" * 900, "fr"), (5, long, "en"), (5, long, "en"), (6, long, None), (7, "one two\tthree\x0bfour", "fr"),
            (8, " \n\t ", "fr"), (9, "Ünïcode — “quotes” 𝄞\x00 \x1c", "de"), (10, "a b a b a b a b", "de")]
    cells = [(i, t, lang, None if t is None else len(t), "s", "x", k, "y") for k, (i, t, lang) in enumerate(rows)]
    return spark.createDataFrame(cells, "doc_id long, text string, lang string, n_chars long, source string, "
                                        "block string, gid int, hash string").repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def small(spark):
    return documents(spark, SF)


# Byte-level BPE

@pytest.fixture(scope="module")
def library():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_coder_equals_library(library):
    coder, rng = byte_bpe.ByteCoder(byte_bpe.ranks(RANKS), PATTERN), random.Random(4)
    kinds = [(32, 127), (0xA0, 0x250), (0x370, 0x500), (0x4E00, 0x9FFF), (0x1F300, 0x1F600), (9, 14), (32, 33), (0, 0xD800)]
    for _ in range(3000):
        text = "".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(30)))
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text) and coder.decode(ids) == text.encode()
    every = "".join(chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000)
    assert coder.encode(every) == library.encode_ordinary(every)


def test_byte_coder_long_pretokens(library, monkeypatch):
    coder = byte_bpe.ByteCoder(byte_bpe.ranks(RANKS), PATTERN)
    monkeypatch.setattr(byte_bpe, "BLOCK", 7)
    monkeypatch.setattr(byte_bpe, "CACHED", 50)
    for text in ("ab" * 4000, "日本" * 3000 + "x" * 5000, " " * 5000 + "y", "zq" * 3000 + "🙂" * 2000, "word " * 100 + "other, " * 60):
        assert coder.encode(text) == library.encode_ordinary(text)


def test_byte_coder_reads_whole_tokens_first():
    """A token that no merge reaches is still one id, as in rank files."""
    vocabulary = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"de": 300}
    coder = byte_bpe.ByteCoder(vocabulary, r"\w+|\W+")
    assert coder.encode("abc") == [256] and coder.encode("abcd") == [*b"abcd"] and coder.encode("xde") == [ord("x"), 300]


def test_byte_digests(odd, empty, small, library):
    for docs in (odd, small):
        want = collections.Counter()
        for r in docs.collect():
            ids = library.encode_ordinary(r.text or "")
            want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
        assert collections.Counter(map(tuple, byte_bpe.digests(docs, RANKS, PATTERN).collect())) == want
    coded = byte_bpe.encoded(odd, RANKS, PATTERN)
    back = byte_bpe.decoded(coded, RANKS, PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.raw).decode()) for r in back) == \
        sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert byte_bpe.digests(empty, RANKS, PATTERN).count() == 0


# Phrases

def brute_phrases(rows, least, depth):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, depth + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] += 1
    known = {g: n for g, n in counts.items() if n >= least}
    out = []
    for (lang, w), a in known.items():
        if len(w) < 2:
            continue
        held = [n for (x, v), n in known.items() if x == lang and len(v) > len(w)
                and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * n >= 100 * a for n in held):
            continue
        score, k = min((1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], totals[lang], score))
    return sorted(out), known


@pytest.mark.parametrize("shard, range_ids, least, depth", [
    (phrases.SHARD, phrases.RANGE_IDS, 3, 5), (700, 300, 4, 5), (60, 100, 12, 3), (phrases.SHARD, 500, 30, 2)])
def test_phrases(odd, empty, small, shard, range_ids, least, depth):
    for docs in (odd, small.filter("doc_id < 60")):
        want, known = brute_phrases([(r.lang, r.text) for r in docs.collect()], least, depth)
        mined = phrases.mine(docs, least, depth, shard=shard, range_ids=range_ids)
        rows = {(r.lang, tuple(r.words)): r for r in mined.collect()}
        assert {g: r.n for g, r in rows.items()} == {g: n for g, n in known.items() if len(g[1]) > 1}
        for (lang, w), r in rows.items():
            assert r.starts == [known[lang, w[:k]] for k in range(1, len(w) + 1)]
            assert r.ends == [known[lang, w[-k:]] for k in range(1, len(w) + 1)]
            longer = [(v, n) for (x, v), n in known.items() if x == lang and len(v) == len(w) + 1]
            assert r.left_most == max([n for v, n in longer if v[1:] == w], default=0)
            assert r.right_most == max([n for v, n in longer if v[:-1] == w], default=0)
        found = phrases.collocations(mined)
        assert sorted(map(tuple, found.select("lang", "phrase", "a", "l", "r", "n", "score").collect())) == want
    assert phrases.report(phrases.collocations(phrases.mine(empty, 2, 3)), 5).count() == 0


def test_phrase_report(odd):
    found = phrases.collocations(phrases.mine(odd, 2))
    every = collections.defaultdict(list)
    for r in found.collect():
        every[r.lang].append((-r.score, -r.a, r.phrase.encode(), r.l, r.r, r.n))
    got = collections.defaultdict(list)
    for r in sorted(phrases.report(found, 3).collect(), key=lambda r: r.rank):
        got[r.lang].append((-r.score, -r.a, r.phrase.encode(), r.l, r.r, r.n))
    assert dict(got) == {lang: sorted(rows)[:3] for lang, rows in every.items()}


def test_score_is_exact_beyond_64_bits(spark):
    n, a, left, right = 9 * 10 ** 15, 7 * 10 ** 14 + 1, 8 * 10 ** 14 + 7, 7 * 10 ** 14 + 3
    row = [("en", ["x", "y"], a, [left, a], [right, a], 0, 0, n)]
    made = spark.createDataFrame(row, "lang string, words array<string>, n long, starts array<long>, ends array<long>, "
                                      "left_most long, right_most long, total long")
    assert phrases.collocations(made).first().score == 1000 * a * n // (left * right)


def test_one_piece_longer_than_a_shard(spark):
    """Words without any stop are cut with an overlap that is counted off again."""
    text = " ".join(f"{'abcde'[i * i % 5]}{i % 3}" for i in range(2000))
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    want, known = brute_phrases([("en", text)], 5, 5)
    rows = phrases.mine(docs, 5, 5, shard=90, range_ids=50).collect()
    assert {(r.lang, tuple(r.words)): r.n for r in rows} == {g: n for g, n in known.items() if len(g[1]) > 1}


# Merkle manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def hexed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    cells = [text if c == "text" else row[c] for c in COLUMNS]
    return hexed(*("-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells))


def brute_tree(nodes):
    """Root, and for every node its (left, right) siblings level by level."""
    paths, place, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for path, p in zip(paths, place):
            a = p - p % 8
            path.append(("".join(level[a:p]), "".join(level[p + 1:a + 8])))
        level, place = [hexed(*level[i:i + 8]) for i in range(0, len(level), 8)], [p // 8 for p in place]
    return level[0], paths


def brute_manifest(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        ranked = sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, brute_leaf(r, r.text)))
        trees[g] = ranked, *brute_tree([brute_leaf(r, r.text) for r in ranked])
    root, over = brute_tree([trees[g][1] for g in order])
    out = []
    for g, above in zip(order, over):
        for r, path in zip(trees[g][0], trees[g][2]):
            own, start = brute_leaf(r, r.text), brute_leaf(r, r.text)
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                start = brute_leaf(r, r.text and re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
            folded, proof = start, ""
            for a, b in [*path, *above]:
                folded, proof = hexed(a, folded, b), proof + a + b
            out.append((r.doc_id, own, trees[g][1], root, hexed(proof), folded, folded == root))
    return sorted(out, key=str)


def test_manifest(spark, odd, small, monkeypatch):
    from pyspark.sql import functions as F
    many = small.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 75).cast("string"))      # two levels of groups
    deep = small.withColumn("lang", F.when(F.col("doc_id") > 0, F.lit(None).cast("string")).otherwise("x"))
    deep = deep.unionByName(deep.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(deep).unionByName(small.limit(9))
    for depth, docs in ((3, odd), (3, small), (3, many), (1, small), (2, deep), (3, deep)):
        monkeypatch.setattr(merkle, "DEPTH", depth)
        monkeypatch.setattr(queries, "documents", lambda spark, sf_dir, docs=docs: docs)
        got = sorted(map(tuple, queries.QUERIES["op13_merkle_manifest"](spark, "").collect()), key=str)
        assert got == brute_manifest(docs.collect())


def test_manifest_of_nothing(empty):
    made = merkle.build(empty, COLUMNS)
    assert made.root is None and made.proofs().count() == 0


def test_stored_levels(small):
    made = merkle.build(small.drop("lang").withColumnRenamed("source", "lang"), ["doc_id", "text"])
    sizes = [level.count() for level in made.by_group.stored]
    assert sizes[0] == small.count() and sizes[-1] == made.by_group.roots.count()
    flipped = made.proofs().selectExpr("key", "leaf", "path").limit(5).collect()
    assert all(re.fullmatch("([0-9a-f]{64})*", s.left + s.right) for r in flipped for s in r.path)


# Ids, and texts that broke earlier versions

def test_large_ids_beside_nulls(spark):
    ids = [None, BIG, 2 ** 60 + 1, 5]
    docs = spark.createDataFrame([(i, "some words here") for i in ids], "doc_id long, text string").coalesce(1)
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 8)
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_viterbi.encoded(docs, model)
    for out in (cut, packing.pack(cut, 8), coded, piece_viterbi.decoded(coded, model), piece_viterbi.round_trips(docs, model),
                byte_bpe.digests(docs, RANKS, PATTERN)):
        assert sorted(str(r.doc_id) for r in out.collect()) == sorted(map(str, ids))


def test_texts_without_spaces():
    coder = piece_viterbi.PieceCoder.from_model(public_tokenizers.path("piece_bpe_32k.model"))
    for short in ("日本語" * 40, "𝄞" * 60, "カ" * 50, "٪" * 50):
        coder.encode(short)
    for text in ("日本語" * 40_000, "𝄞" * 100_000, "カナ" * 50_000, "٪" * 100_000, "x" * 100_000):
        assert coder.decode(coder.encode(text)) == text


def test_word_ids_over_unicode():
    words, rng = wordbpe.WordBpe(public_tokenizers.path("word_bpe_49k.json")), random.Random(9)
    special = ["İ", "Ʊ", "Ʀ", "Ⱥ", "Ⱦ", ".", ",", "'s", " ", "a", "B", "1", "é", "ß", "K"]
    for k in range(6000):
        kinds = (32, 0x300) if k % 2 else (0, 0xD800)
        text = "".join(rng.choice([rng.choice(special), chr(rng.randrange(*kinds))]) for _ in range(rng.randrange(1, 9)))
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert words.ids(text) == array("I", want).tobytes(), text


def test_calibrated_at_every_size(small):
    assert language_id.fit(small).temperature != 1.0

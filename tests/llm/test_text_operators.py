"""Text operators against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import math
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tallygraph.llm import (components, jaccard_join, language_id, packing, quality, queries, sharding, substring_dedup,
                            toxicity, transcripts, wordbpe)
from tallygraph.llm.common import documents, window_hashes
from tallygraph.llm.piece_viterbi import MARK, PENALTY, PieceCoder

SF = "/root/testdata/sf0.001"
BLANK = rb"[^\x20\x09-\x0D]+"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use."""
    long = " ".join(f"w{i % 97}x{i % 89}" for i in range(6000))
    near = " ".join(f"{w}{i}" for i in range(12) for w in BASE)
    rows = [(1, near, "en", "s"), (2, near + " more", "en", "s"), (3, near, None, None), (4, None, "en", "s"), (5, "", "en", "s"),
            (6, " \n\t", "fr", "s"), (7, "a", "fr", "t"), (8, long, "en", "t"), (9, long, "en", "t"), (9, long, "en", "t"),
            (None, "no id here", None, None), (10, "ÀB cd\nÀB cd\nÀB cd", "fr", "t"), (11, "ab ab ab ab", "fr", "u")]
    cells = [(i, t, lang, s, None if t is None else len(t), "block", "x", k) for k, (i, t, lang, s) in enumerate(rows)]
    return spark.createDataFrame(cells, "doc_id long, text string, lang string, source string, n_chars long, "
                                        "record string, bucket string, shard int").repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def small(spark):
    return documents(spark, SF)


def words(text):
    return re.findall(BLANK, (text or "").encode())


def test_shards(spark, odd, empty, small):
    for docs, n in ((odd, 4), (small, 7)):
        rows = sharding.shards(docs, n, bucket_bytes=20_000).collect()
        slots = collections.defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        sizes = [len(slots[s]) for s in range(n)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert collections.Counter(map(str, (r.record for r in rows))) == collections.Counter(map(str, docs.collect()))
        again = sharding.shards(docs, n, bucket_bytes=20_000).collect()
        assert sorted(map(str, rows)) == sorted(map(str, again))
    assert sharding.shards(empty, 3).count() == 0


def test_written_shards(small, tmp_path):
    sharding.write_shards(sharding.shards(small, 3), str(tmp_path / "out"))
    back = small.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == small.count() and back.select("shard").distinct().count() == 3


def brute_components(rows, rule):
    sets = collections.defaultdict(list)
    for i, text in rows:
        w = [x.lower() for x in words(text)]
        k = rule.words
        own = {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets[i].append(own)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, many in sets.items() for s in many if s]
    for x, (i, a) in enumerate(flat):
        for j, b in flat[:x]:
            if rule.den * len(a & b) >= rule.num * len(a | b):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return sorted((i, len(s), find(i)) for i, many in sets.items() for s in many)


@pytest.mark.parametrize("rule", [jaccard_join.Rule(3, 90, 100), jaccard_join.Rule(5, 80, 100), jaccard_join.Rule(1, 50, 100)])
def test_jaccard(odd, empty, small, rule, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 300)
    for docs in (odd.filter("doc_id is not null"), small):
        got = sorted(map(tuple, jaccard_join.near_duplicates(docs, rule).collect()))
        assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()], rule)
    assert jaccard_join.near_duplicates(empty, rule).count() == 0
    alone = [r for r in jaccard_join.near_duplicates(odd, rule).collect() if r.doc_id is None]
    assert [r.component_id for r in alone] == [None]


@pytest.mark.parametrize("rule", [jaccard_join.Rule(3, 90, 100), jaccard_join.Rule(5, 80, 100), jaccard_join.Rule(1, 70, 100)])
def test_tiles_hold_content(rule):
    rng = np.random.default_rng(5)

    def tiles(sets):
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        owners, keys = jaccard_join.tile_keys(np.concatenate(sets), bounds, rule)
        by_set = [set() for _ in sets]
        for i, k in zip(owners.tolist(), keys.tolist()):
            by_set[i].add(k)
        return by_set

    sizes = np.concatenate([rng.integers(1, 40, 3000), rng.integers(40, 300, 1000)])
    left, right = [], []
    for n in sizes:
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n + 4, dtype=np.uint64))
        rng.shuffle(pool)
        most = n * (rule.den - rule.num) // rule.num                # what n common n-grams allow besides
        a, b = int(rng.integers(0, most + 1)), 0
        b = most - a
        left.append(np.sort(pool[:n + a]))
        right.append(np.sort(np.concatenate([pool[:n], pool[n + a:n + a + b]])))
        assert rule.den * n >= rule.num * (n + a + b)
    one, two = tiles(left), tiles(right)
    assert all(x & y for x, y in zip(one, two))                     # linked sets meet
    held = collections.Counter(k for x in one for k in x)
    assert max(held.values()) == 1                                  # sets without a common n-gram never do


def test_large_tiles(small, odd, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 3)
    rule = jaccard_join.Rule(1, 70, 100)
    docs = odd.sparkSession.createDataFrame([(i, " ".join(f"w{k}" for k in range(40) if k % 23 != i)) for i in range(23)],
                                            "doc_id long, text string").unionByName(small.select("doc_id", "text").filter("doc_id > 30"))
    got = sorted(map(tuple, jaccard_join.near_duplicates(docs, rule).collect()))
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()], rule)


def test_bands_follow_the_rule(spark):
    rule = jaccard_join.Rule(1, 50, 100)
    sets = [(first, n) for k, n in enumerate([5, 7, 11, 20, 90]) for first, n in ((2 * k, n), (2 * k + 1, 2 * n))]
    docs = spark.createDataFrame([(i, " ".join(f"s{i // 2}w{j}" for j in range(n))) for i, n in sets], "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.near_duplicates(docs, rule).collect()))
    assert got == [(i, n, i - i % 2) for i, n in sets]
    for num in (50, 60, 66, 67, 80, 90):
        rule = jaccard_join.Rule(1, num, 100)
        small = np.arange(1, 5000)
        assert (jaccard_join.band_of(small * 100 // num, rule) - jaccard_join.band_of(small, rule)).max() <= 1


def test_groups_hold_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 60)
    asked, placed, parts, places = [], [], jaccard_join.parts_for, jaccard_join._places
    monkeypatch.setattr(jaccard_join, "parts_for", lambda size, each: asked.append(size) or parts(size, each))
    monkeypatch.setattr(jaccard_join, "_places", lambda fetched: placed.append(places(fetched)) or placed[-1])
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(50) if k != i)) for i in range(20)], "doc_id long, text string")
    rows = jaccard_join.near_duplicates(docs, jaccard_join.Rule(1, 90, 100)).collect()
    assert {r.component_id for r in rows} == {0}
    moved = sum(len(r.hashes) for r in placed[0].select("hashes").collect())
    assert asked[-1] == moved > 5 * 20 * 49 * 8


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()))
    least = {x: x for p in pairs for x in p}
    for _ in range(400):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert {x: got.get(x, x) for x in least} == least


def brute_kept(rows, window=35):
    texts = [(i, words(t)) for i, t in rows]
    count = collections.Counter(tuple(w[k:k + window]) for _, w in texts for k in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((str(i), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("window,block", [(35, 8 << 20), (35, 3000), (2, 3000)])
def test_repeats(odd, empty, small, window, block):
    for docs in (odd, small):
        out = substring_dedup.remove_repeats(docs, window, block_bytes=block, range_bytes=max(block // 4, 2000))
        got = sorted((str(r.record.doc_id), r.n_words, r.n_removed, r.kept or "") for r in out.collect())
        assert got == brute_kept([(r.doc_id, r.text) for r in docs.collect()], window)
    out = substring_dedup.remove_repeats(odd)
    assert out.select("record.*").schema.names == odd.schema.names
    assert sorted(map(str, out.select("record.*").collect())) == sorted(map(str, odd.collect()))
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_token_ids():
    encoder = wordbpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"), cached=50)
    texts = ["", "İstanbul don't we'll 's", "x²½ 10 ÷ ×, ¿qué?", "日本語 text ß ſ.", "a\x1cb", "a<|endoftext|>b", "É́é ǅ ŉ",
             "'''s's 'S it'S  \u0085x\xad--é—", "__a_b__ !!?? ...", "The the THE. the, Éa éa,", "don't, a. 1. ß."]
    for t in texts * 2:
        assert encoder.ids(t) == array("I", encoder.tokenizer.encode(t, add_special_tokens=False).ids).tobytes(), t


def test_packing(odd, empty, small):
    path = public_tokenizers.path("word_bpe_49k.json")
    for docs in (odd, small):
        cut = packing.pieces(docs, path, 64, keep_ids=True)
        rows = packing.pack(cut, 64, group_tokens=20_000).collect()
        total = sum(r.length for r in rows)
        fill = collections.defaultdict(list)
        for r in rows:
            fill[r.sequence_id].append((r.offset, r.length))
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 64
        assert len(fill) <= 1.1 * math.ceil(total / 64) + 2
        by_doc = collections.Counter()
        for r in rows:
            by_doc[r.doc_id] += r.length
        for d in docs.collect():
            assert by_doc[d.doc_id] % (len(wordbpe.load(path).ids(d.text or "")) // 4 + 1) == 0
    assert packing.pack(packing.pieces(empty, path)).count() == 0
    cut = packing.pieces(small, path, 64, keep_ids=True)
    joined = packing.sequences(packing.pack(cut, 64), cut).collect()
    assert sum(len(r.ids) for r in joined) == sum(r.length for r in cut.collect())


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity(rule):
    lengths = np.random.default_rng(2).integers(1, 60, 500)
    place, offset = packing.fit(lengths, 64, 5, 1500, rule)
    for s in set(place):
        own = lengths[place == s]
        assert own.sum() <= 64 and len(own) <= 5 and ((own ** 2).sum() <= 1500 or len(own) == 1)
        assert sorted(offset[place == s])[0] == 0


def test_sentencepiece(spark, odd, empty, small):
    path = public_tokenizers.path("piece_bpe_32k.model")
    coder = PieceCoder.from_model(path)
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    score = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    worst, longest = min(score.values()) - PENALTY, max(map(len, score))

    def best(text):
        s, out = MARK + text.replace(MARK, "\0").replace(" ", MARK), [0.0]
        for e in range(1, len(s) + 1):
            out.append(max([out[e - 1] + worst, *(out[e - n] + score[s[e - n:e]] for n in range(1, min(longest, e) + 1)
                                                  if s[e - n:e] in score)]))
        return out[-1]

    def found(text):
        ids, total, k = array("I", coder.encode(text)), 0.0, 0
        name = {model.piece_to_id(p): x for p, x in score.items()}
        while k < len(ids):
            if ids[k] in name:
                total, k = total + name[ids[k]], k + 1
            else:
                lead = coder.bytes_of[ids[k]][0]
                total, k = total + worst, k + (1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4)
        return total

    for t in [r.text[:1500] for r in small.collect()[:20]] + ["▁x ▁ ▁▁", "日本 𝄞\x00\n\t", "  a  b ", "iNgB tMx!! a.b,c"]:
        assert coder.decode(coder.encode(t)) == t and abs(best(t) - found(t)) < 1e-6
    from tallygraph.llm import piece_viterbi
    for docs in (odd, small):
        rows = piece_viterbi.round_trips(docs, path).collect()
        assert all(r.round_trip for r in rows if r.n_tokens is not None)
        assert sum(r.n_tokens is None for r in rows) == docs.filter("text is null").count()
    texts = piece_viterbi.decoded(piece_viterbi.encoded(odd, path), path).collect()
    assert sorted(map(str, texts)) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert piece_viterbi.round_trips(empty, path).count() == 0


def test_every_piece_takes_part():
    path = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    whole = {model.id_to_piece(i): (model.get_score(i), i) for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    crossing = {"a": (-1.0, 0), "b": (-1.0, 1), MARK: (-1.0, 2), f"a{MARK}b": (-1.5, 3), MARK * 2: (-1.2, 4), f"{MARK}a": (-1.6, 5)}
    model_coder = PieceCoder.from_model(path)
    made = PieceCoder([(p, x, i) for p, (x, i) in crossing.items()], list(range(10, 266)))
    texts = ["a  ", "    return x", "        if a:\n            b  = 1  # c ", " ", "   ", " " * 40 + "x" + " " * 17, "x ▁  ▁▁ y",
             "a b  a b", "▁ a", "a\n\n  b\t  c", "  ▁  "]
    for coder, score in ((model_coder, whole), (made, crossing)):
        worst, longest = min(x for x, _ in score.values()) - PENALTY, max(map(len, score))
        by_id = {i: x for x, i in score.values()}
        for t in texts:
            s, best = MARK + t.replace(MARK, "\0").replace(" ", MARK), [0.0]
            for e in range(1, len(s) + 1):
                best.append(max([best[e - 1] + worst, *(best[e - n] + score[s[e - n:e]][0] for n in range(1, min(longest, e) + 1)
                                                        if s[e - n:e] in score)]))
            ids = array("I", coder.encode(t))
            spelled = b"".join(coder.bytes_of[i] for i in ids if i not in by_id).decode()
            assert coder.decode(coder.encode(t)) == t
            assert abs(sum(by_id[i] for i in ids if i in by_id) + worst * len(spelled) - best[-1]) < 1e-6, t
    assert len(model_coder.encode("    return x")) < len(model_coder.encode("a a a a return x"))


def test_fingerprints(spark, odd, empty, small):
    from tallygraph.llm import winnowing
    for docs in (odd.filter("doc_id <> 9 and doc_id is not null"), small):
        rows = {r.doc_id: r for r in winnowing.edited(docs).collect()}
        order = sorted((r.doc_id, r.text or "") for r in docs.collect())
        for at, (i, text) in enumerate(order):
            after, cut = order[(at + 1) % len(order)][1], len(text) // 4
            new = text[:len(text) - cut] + after[:cut]
            assert (rows[i].n_chars, rows[i].edited) == (len(text), new)
            assert 0 <= rows[i].near_next <= 1 and (rows[i].near_edited == 1 or new != text)
            # kept positions: every window of runs holds one, at the smallest hash
            units = re.findall(r"[^\x20\x09-\x0D]{1,32}", text)
            spots = [winnowing._LAST - (x & winnowing._LAST) for x in rows[i].fingerprint]
            runs = max(len(units) - winnowing.K + 1, 1)
            assert spots == sorted(spots) and all(0 <= p < runs for p in spots)
            for begin in range(max(runs - winnowing.WINDOW + 1, 1)):
                assert any(begin <= p < begin + winnowing.WINDOW for p in spots)
    assert winnowing.edited(odd).count() == odd.count() and winnowing.edited(empty).count() == 0
    chain = dict(map(tuple, winnowing.successors(spark.createDataFrame(
        [(x,) for x in (-5, 0, 65_535, 65_536, 1 << 40)], "id long")).collect()))
    assert chain == {-5: 0, 0: 65_535, 65_535: 65_536, 65_536: 1 << 40, 1 << 40: -5}


def base_counts(text):
    w = [x.decode() for x in words(text)]
    count = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality(spark, odd, empty, small):
    labels = documents(spark, SF, "labels")
    table = quality.ratios(small, labels)
    for docs in (odd, small):
        rows = quality.judged(docs, table).collect()
        for r in rows:
            own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            assert own == base_counts(r.record.text)
            assert r.kept == (not r.base_failed and r.llr_sum >= round(quality.THRESHOLD * quality.UNIT) * r.n_grams)
            assert r.n_grams == max(2 * r.n_words - 1, 0)
    assert quality.judged(empty, table).count() == 0
    # counts of the two multinomials by brute force
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1}
    rows = quality.with_words(small, "text", "w").select("doc_id", quality.grams(quality.word_hashes(quality.F.col("w"))).alias("g")).collect()
    raw = collections.Counter(g for r in rows for g in r.g)
    target = collections.Counter(g for r in rows if r.doc_id in trusted for g in r.g)
    assert table == quality._ratios({g: (n, target[g]) for g, n in raw.items()}, quality.BUCKETS, quality.SMOOTHING)
    assert set(quality.ratios(small, labels.filter("false"))) == {0}


def test_language(spark, odd, empty):
    rows = {r.doc_id: r for r in queries.op2(spark, "/root/testdata/sf0.01").collect()}
    truth = {r.doc_id: r.lang for r in documents(spark, "/root/testdata/sf0.01").collect()}
    held = [i for i in rows if rows[i].held_out]
    assert {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2} == set(held)
    assert np.mean([rows[i].lang_pred == truth[i] for i in held]) > 0.97
    model = language_id.fit(documents(spark, SF))
    seen = [(r.record.text, r.lang_pred, r.score) for r in language_id.predicted(odd, model).collect()]
    assert all((p == "und" and s == 0) == (not any(c.isalpha() for c in t or "")) and 0 <= s <= 1 for t, p, s in seen)
    assert language_id.predicted(empty, model).count() == 0
    assert {r.lang_pred for r in language_id.predicted(odd, language_id.fit(empty)).collect()} == {"und"}


def test_toxicity(spark, odd, empty):
    rows = {r.doc_id: r for r in queries.op9(spark, "/root/testdata/sf0.1").collect()}
    held = [(rows[r.doc_id].predicted, r.toxic) for r in documents(spark, "/root/testdata/sf0.1", "labels").collect()
            if rows[r.doc_id].held_out]
    assert np.mean([p == t for p, t in held]) > 0.97
    assert np.mean([p for p, t in held if t]) > 0.8
    labels = documents(spark, SF, "labels")
    model = toxicity.fit(documents(spark, SF), labels)
    assert toxicity.scored(odd, model).count() == odd.count() and toxicity.scored(empty, model).count() == 0
    assert {r.score for r in toxicity.scored(odd, toxicity.fit(odd, labels.filter("false"))).collect()} == {0.0}


def test_clause_grammar():
    lexicon = toxicity.Lexicon({"moron": 1.0, "idio*": 1.0})
    kinds = {text: [k for k, x in enumerate(lexicon.features(text)[:16]) if x] for text in
             ("a moron here", "you idiots", "you are not a moron", "he said she is a moron", "kill them", "fine. you", None, "")}
    assert kinds == {"a moron here": [0], "you idiots": [4], "you are not a moron": [6], "he said she is a moron": [5],
                     "kill them": [12], "fine. you": [], None: [], "": []}


def test_offences_beside_any_mark():
    insults = {"moron": 1.0, "idio*": 1.0, "imbécil": 1.0, "dolt's": 1.0, "o'fo*": 1.0}
    lexicon, whole = toxicity.Lexicon(insults), toxicity.Lexicon(insults)

    class Always:
        def iter(self, text):
            return iter([(0, 1)])

    whole.finder = Always()     # no shortcut
    marks = [*"'’‘“”«»¡¿…–—\u00a0\u200b\u3000😀£²٣_7-\0\n", "''", "x'", "'x", "a'b'"]
    words = ["moron", "idiots", "imbécil", "kill", "dolt's", "o'fool", "oxymoron", "fine"]
    for mark in marks:
        for word in words:
            for text in (f"you {mark}{word}{mark} there", f"{mark}{word}", f"{word}{mark}", f"{word}{mark}{word}"):
                assert lexicon.features(text) == whole.features(text), text
    assert lexicon.features("'moron'")[0] and lexicon.features("¡imbécil!")[0] and lexicon.features("“kill”")[8]


def test_transcripts(spark, empty, monkeypatch):
    table = documents(spark, "/root/testdata/sf0.01", "conversations")
    segments, model = queries.transcripts_of(table), transcripts.fit(table)
    whole = sorted(map(tuple, transcripts.rendered(segments, model).collect()))
    truth = {(r.conv_id, r.turn): r.role for r in table.collect()}
    assert np.mean([truth[r[0], r[1]] == r[3] for r in whole if r[2] == 0]) > 0.97
    monkeypatch.setattr(transcripts, "CHUNK", 2)
    assert sorted(map(tuple, transcripts.rendered(segments, model).collect())) == whole
    odd = spark.createDataFrame([(1, None, "x"), (1, None, None), (None, 3, "User: hi\nBot: <|im_end|>\nmore"), (2, 0, ""),
                                 (2, 0, "")], "conv_id long, turn long, text string")
    rows = transcripts.rendered(odd).collect()
    assert collections.Counter(r.conv_id for r in rows) == {1: 2, None: 2, 2: 2}
    text = "".join(r.rendered for r in sorted((r for r in rows if r.conv_id is None), key=lambda r: (r.turn, r.part)))
    assert text == "<|im_start|>user\nhi\n<|im_end|>\n<|im_start|>assistant\n< |im_end|>\nmore\n<|im_end|>\n"
    assert transcripts.rendered(odd.filter("false")).count() == 0


def test_viterbi():
    rng = np.random.default_rng(3)
    first, step = transcripts._transitions(transcripts.Model())
    emitted = rng.normal(size=(5, transcripts.STATES))
    scores = {}
    for states in np.ndindex(*[transcripts.STATES] * 5):
        scores[states] = first[states[0]] + sum(step[a, b] for a, b in zip(states, states[1:])) + sum(
            emitted[i, s] for i, s in enumerate(states))
    assert tuple(transcripts.path(emitted, step, first)) == max(scores, key=scores.get)


def test_windows_equal_hashes():
    w = np.array([3, 9, 4, 3, 9, 4], np.uint64)
    h = window_hashes(w, 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 3


def test_pipeline(spark):
    docs = documents(spark, SF)
    rows = docs.collect()
    first = corpus_pipeline.language(spark, docs, SF)
    kept = {r.doc_id for r in first.collect()}
    assert first.columns == docs.columns and kept <= {r.doc_id for r in rows if any(c.isalpha() for c in r.text)}
    near = corpus_pipeline.near_copies(spark, docs, SF)
    want = {i for i, _, c in brute_components([(r.doc_id, r.text) for r in rows], corpus_pipeline.NEAR) if i == c}
    assert {r.doc_id for r in near.collect()} == want and near.columns == docs.columns
    left = corpus_pipeline.passages(spark, docs, SF)
    by_id = {i: (n, t) for i, _, n, t in brute_kept([(r.doc_id, r.text) for r in rows])}
    for r, new in zip(sorted(rows), sorted(left.collect())):
        gone, text = by_id[str(r.doc_id)]
        assert new == (r if not gone else (r.doc_id, text, r.lang, r.source, len(text)))
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} <= kept
    assert corpus_pipeline.packed(spark, docs.filter("false"), SF).count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), SF).count() == 0, name


def test_digest_of_kept(spark):
    rows = queries.op8(spark, SF).collect()
    want = {(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute_kept(
        [(r.doc_id, r.text) for r in documents(spark, SF).collect()])}
    assert {(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want

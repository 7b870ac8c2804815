"""Phrase collocations from an FM-index per shard over word ids.

1. A task reads its texts into shards of about two million word ids, words of a language
   numbered by frequency, and writes each shard's words with their counts and the
   Burrows-Wheeler transform of its ids, the suffixes ordered by their first ``depth`` words.
2. Word counts are summed; words below ``least`` stand in no phrase that is searched for.
   A word is known by the first shard and number that has it.
3. Level by level, a shard finds the intervals of the phrases known to be frequent and
   extends them.  To the left: the ids in front of an interval, counted, are the longer
   phrases, and the rank of an id gives their interval.  To the right: the interval of a
   longer phrase lies inside that of the phrase it prolongs to the right.  So each longer
   phrase comes with its count and with both phrases it extends, and it counts only if both
   are frequent.  Counts are summed over the shards in ranges of a hash; a range tells each
   shard which of its phrases reached ``least``.

A phrase is known by the ids of the two phrases it extends, so all counts are exact.  From
them follow the counts of all its beginnings and ends, and its largest extensions.

Shards are cut between pieces.  A piece longer than a shard is cut with ``depth - 1`` words
in both parts, and those words are counted once more as a shard of their own with sign -1.
A phrase of a third of all texts is one entry per shard.  Shards are numbered by task, and
the plan of the levels deals them once and reads that exchange again for each level.

A null text has no words, a null language is ``und``; empty and very long texts, ties and
repeated rows are counted like any others; a table without rows has no phrases.  Only text
and language are read, so names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygraph.llm.common import mix, parts_for, slices
from tallygraph.session import materialize, union_all

DEPTH = 5               # words of the longest phrase
BITS = 21
SHARD = (1 << BITS) - 64            # ids of a shard; a position, an id and a phrase number fit in 63 bits
TASK_BITS = 12          # shards of one task: 4096, of about 2 million ids each
RANGE_IDS = 4_000_000   # ids of all shards for each range that sums their counts
READ_CHARS = 4 << 20    # characters of text read at once
READ_BYTES = 8 << 20    # bytes of a longer text read at once

# Bytes between the words of a piece, and between pieces.
BLANKS, ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(ENDS)] = 2
_LOW = (1 << BITS) - 1

READ = "block bigint, local int, lang string, word string, n bigint, bwt binary"
MESSAGE = "rng bigint, block bigint, prefixes binary, suffixes binary, counts binary"
# Phrases known to be frequent, packed: of a shard, or of all shards (negative block) with their counts.
ANSWER = "block bigint, step int, prefixes binary, suffixes binary, gids binary, counts binary"
KNOWN = ANSWER + ", gid bigint, lang string, word string, n bigint"
FOUND = "step int, prefix bigint, suffix bigint, gid bigint, n bigint"
TOLD_ROWS = 1_000_000   # words of a task that are packed together

_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _table(schema: str, columns: list) -> pa.Table:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.table([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds)], names=list(names))


# Reading texts into shards

def _parts(kind: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of parts of about ``READ_BYTES``, cut behind a byte that is in no word."""
    begin = 0
    while begin < len(kind):
        end = begin + READ_BYTES
        if end < len(kind):
            inside = np.flatnonzero(kind[begin:end])
            if len(inside):
                end = begin + int(inside[-1]) + 1
            else:
                after = np.flatnonzero(kind[end:])
                end = end + int(after[0]) + 1 if len(after) else len(kind)
        yield begin, min(end, len(kind))
        begin = end


def _words(data: np.ndarray, kind: np.ndarray) -> tuple[pa.Array, np.ndarray, bool]:
    """The words of a part, before which of them a piece ends, and whether one ends behind the last."""
    inside = np.zeros(len(data) + 2, bool)
    np.equal(kind, 0, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    stops = np.flatnonzero(kind == 2)
    passed = np.searchsorted(stops, starts)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]])])
    return words, np.diff(passed, prepend=0) > 0, len(stops) > (int(passed[-1]) if len(passed) else 0)


class _Reader:
    """Texts of one task as rows of shards."""

    def __init__(self, task: int, depth: int, size: int):
        self.next_block, self.depth, self.size = task << TASK_BITS, depth, size
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.names: list[tuple[str, bytes]] = [("", b"")]
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, lang: str, texts: list[str]) -> Iterator[pa.Table]:
        data = np.frombuffer(b"\n".join([t.encode("utf-8", "surrogatepass") for t in texts]).lower(), np.uint8)
        kind, known, ended = _KIND[data], self.numbers.setdefault(lang, {}), True
        for begin, end in _parts(kind):
            words, broken, ends_behind = _words(data[begin:end], kind[begin:end])
            if not len(words):
                ended |= ends_behind
                continue
            broken[0] |= ended
            ended = ends_behind
            coded = words.dictionary_encode()
            number = np.empty(len(coded.dictionary), np.int64)
            for i, word in enumerate(coded.dictionary.to_pylist()):
                at = known.get(word)
                if at is None:
                    at = known[word] = len(self.names)
                    self.names.append((lang, word))
                number[i] = at
            ids = np.zeros(len(words) + int(broken.sum()), np.int64)
            ids[np.arange(len(words)) + np.cumsum(broken)] = number[coded.indices.to_numpy()]
            self.held.append(ids)
            self.n_held += len(ids)
            if self.n_held >= self.size:
                yield from self._cut()

    def _cut(self) -> Iterator[pa.Table]:
        """All full shards of what is held."""
        ids = np.concatenate(self.held)
        while len(ids) >= self.size:
            stops = np.flatnonzero(ids[1:self.size] == 0)
            cut = int(stops[-1]) + 1 if len(stops) else self.size
            yield self._shard(ids[:cut], 1)
            if not len(stops):
                cut -= self.depth - 1
                yield self._shard(ids[cut:self.size], -1)
            ids = ids[cut:]
        self.held, self.n_held = [ids], len(ids)

    def finish(self) -> Iterator[pa.Table]:
        if self.n_held:
            yield self._shard(np.concatenate(self.held), 1)

    def _shard(self, ids: np.ndarray, sign: int) -> pa.Table:
        counts = np.bincount(ids, minlength=len(self.names))
        counts[0] = 0       # of the stops
        found = np.flatnonzero(counts)
        counts = counts[found]
        local = np.zeros(len(self.names), np.int64)
        local[found[np.argsort(-counts, kind="stable")]] = np.arange(1, len(found) + 1)
        block, self.next_block = self.next_block, self.next_block + 1
        words = [self.names[i] for i in found]
        n = len(words)
        rows = [[block] * n, local[found], [lang for lang, _ in words],
                [w.decode("utf-8", "surrogatepass") for _, w in words], counts * sign, [None] * n]
        head = _table(READ, [[block], [sign], [None], [None], [None], [_packed(_bwt(local[ids], self.depth))]])
        return pa.concat_tables([head, _table(READ, rows)])


def _bwt(ids: np.ndarray, depth: int) -> np.ndarray:
    """Ids in front of the suffixes, which are ordered by their first ``depth`` ids."""
    ids = np.append(ids, 0)
    rank, width = ids, 1
    while width < depth:
        step = min(width, depth - width)
        keys = np.zeros(len(ids), np.int64)
        keys[:-step] = rank[step:]
        keys <<= BITS
        keys |= rank << 2 * BITS
        keys |= np.arange(len(ids))
        keys.sort()
        order = keys & _LOW
        keys >>= BITS
        fresh = np.zeros(len(ids), bool)
        np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.cumsum(fresh)
        width += step
    return ids[order - 1]


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, all lowest first: bytes that hardly change shrink to nothing in a shuffle."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel() for x in parts])


def _packed(ids: np.ndarray) -> bytes:
    """Three planes of bytes; ids go by frequency, so the upper ones are mostly zero."""
    return b"".join((ids >> shift & 255).astype(np.uint8).tobytes() for shift in (0, 8, 16))


def _reading(depth: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(TaskContext.get().partitionId(), depth, size)
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts, READ_CHARS):
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(langs[a:b], texts[a:b]):
                    if text is not None:
                        by_lang.setdefault(lang, []).append(text)
                for lang, own in by_lang.items():
                    for table in reader.add(lang, own):
                        yield from table.to_batches()
        for table in reader.finish():
            yield from table.to_batches()
    return run


# Extending intervals

class _Index:
    """FM-index of a shard: ranks by search in the sorted (id, position) pairs of its transform."""

    def __init__(self, packed: bytes):
        low, mid, high = np.frombuffer(packed, np.uint8).reshape(3, -1).astype(np.int64)
        self.bwt = low | mid << 8 | high << 16
        self.pairs = (self.bwt << BITS) | np.arange(len(self.bwt))
        self.pairs.sort()

    def start(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(self.pairs, ids << BITS), np.searchsorted(self.pairs, (ids + 1) << BITS)

    def left(self, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of phrases with one more id in front."""
        return np.searchsorted(self.pairs, (ids << BITS) | low), np.searchsorted(self.pairs, (ids << BITS) | high)


@dataclass
class _Phrases:
    """Frequent phrases of one length in a shard, by ascending interval."""

    gid: np.ndarray
    first: np.ndarray       # id of the first word
    low: np.ndarray
    high: np.ndarray

    def __post_init__(self):
        order = np.argsort(self.low)
        self.gid, self.first, self.low, self.high = (x[order] for x in (self.gid, self.first, self.low, self.high))
        self.by_gid = np.argsort(self.gid)

    def place(self, gid: np.ndarray) -> np.ndarray:
        return self.by_gid[np.searchsorted(self.gid, gid, sorter=self.by_gid)]

    def extensions(self, index: _Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase extended to the right, phrase extended to the left, count) of each one word longer phrase."""
        sizes = self.high - self.low
        owner = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(owner)) + np.repeat(self.low - np.cumsum(sizes) + sizes, sizes)
        front = index.bwt[at]
        keys = (owner << 2 * BITS | front << BITS | at)[front > 0]
        keys.sort()
        begin = np.flatnonzero(np.diff(keys >> BITS, prepend=-1))
        counts = np.diff(begin, append=len(keys))
        heads = keys[begin]
        low = np.searchsorted(index.pairs, heads & ((1 << 2 * BITS) - 1))     # rank of that id there
        prefix = np.searchsorted(self.low, low, side="right") - 1
        good = (prefix >= 0) & (low < self.high[prefix])
        return prefix[good], (heads >> 2 * BITS)[good], counts[good]


def _extend(step: int, ranges: int):
    """Counts of the phrases of ``step`` words in one shard, from the answers on all shorter ones."""
    def run(shard: pa.Table, answers: pa.Table) -> pa.Table:
        if not shard.num_rows:
            return _table(MESSAGE, [[]] * 5)
        of_step = [answers.filter(pc.equal(answers.column("step"), k)) for k in range(1, step)]
        if not of_step[-1].num_rows:
            return _table(MESSAGE, [[]] * 5)
        index, known = _Index(shard.column("bwt")[0].as_py()), None
        for rows in of_step:
            prefix, suffix, gid = (_from_planes(rows.column(c).to_pylist()) for c in ("prefixes", "suffixes", "gids"))
            if known is None:
                known = _Phrases(gid, prefix, *index.start(prefix))
            else:
                first, after = known.first[known.place(prefix)], known.place(suffix)
                known = _Phrases(gid, first, *index.left(first, known.low[after], known.high[after]))
        prefix, suffix, counts = known.extensions(index)
        prefix, suffix, counts = known.gid[prefix], known.gid[suffix], counts * shard.column("sign")[0].as_py()
        rng = (mix(prefix.astype(np.uint64) + mix(suffix)) % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(rng, kind="stable")
        rng = rng[order]
        begin = np.flatnonzero(np.diff(rng, prepend=-1))
        cuts = list(zip(begin, np.append(begin[1:], len(rng))))
        columns = [[_planes(x[order[a:b]]) for a, b in cuts] for x in (prefix, suffix, counts)]
        return _table(MESSAGE, [rng[begin], [shard.column("block")[0].as_py()] * len(cuts), *columns])
    return run


def _sum(step: int, least: int):
    """Phrases of a range that reach ``least``: once for all (negative block), and once for each shard that has them."""
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        blocks = rows.column("block").to_numpy()
        prefix, suffix, counts = (_from_planes(rows.column(c).to_pylist()) for c in ("prefixes", "suffixes", "counts"))
        sender = np.repeat(np.arange(len(blocks)), [len(x) // 8 for x in rows.column("counts").to_pylist()])
        order = np.lexsort((suffix, prefix))
        p, s = prefix[order], suffix[order]
        fresh = np.ones(len(p), bool)
        fresh[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1])
        begin = np.flatnonzero(fresh)
        total = np.add.reduceat(counts[order], begin)
        hit = total >= least
        number = (key[0].as_py() << 32) + np.cumsum(hit) - 1        # of a phrase of this length
        group = np.cumsum(fresh) - 1
        told = np.flatnonzero(hit[group])
        to = sender[order[told]]
        told = told[np.argsort(to, kind="stable")]
        ends = np.cumsum(np.bincount(to, minlength=len(blocks)))
        out = [[-1 - key[0].as_py(), step, *map(_planes, (p[begin[hit]], s[begin[hit]], number[hit], total[hit]))]]
        for i, (a, b) in enumerate(zip(np.append(0, ends[:-1]), ends)):
            if b > a:
                at = told[a:b]
                out.append([int(blocks[i]), step, *map(_planes, (p[at], s[at], number[group[at]])), None])
        return _table(ANSWER, list(zip(*out)))
    return run


def _tell_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent words, each once, and their numbers in every shard, packed."""
    def packed(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        block, local, gid = (rows.column(c).to_numpy() for c in ("block", "local", "gid"))
        order = np.lexsort((local, block))
        cuts = np.flatnonzero(np.diff(block[order], prepend=-1))
        out = []
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            at = order[a:b]
            out.append([int(block[at[0]]), 1, _planes(local[at].astype(np.int64)), _planes(np.zeros(len(at))), _planes(gid[at]), None])
        once = rows.filter(pc.is_valid(rows.column("word")))
        none = pa.nulls(once.num_rows)
        words = [none] * 6 + [once.column(c) for c in ("gid", "lang", "word", "n")]
        columns = [*map(list, zip(*out)), *[[None] * len(out)] * 4]
        names = [c.split()[0] for c in KNOWN.split(", ")]
        table = _table(KNOWN, columns)
        return [*table.to_batches(), *pa.table(words, names=names).cast(table.schema).to_batches()]

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= TOLD_ROWS:
            yield from packed(held)
            held, size = [], 0
    if size:
        yield from packed(held)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            packed = [_from_planes([row[c]]) for c in ("prefixes", "suffixes", "gids", "counts")]
            yield from _table(FOUND, [np.full(len(packed[0]), row["step"]), *packed]).to_batches()


def mine(docs: DataFrame, least: int = 100, depth: int = DEPTH, text: str = "text", lang: str = "lang",
         shard: int = SHARD, range_ids: int = RANGE_IDS) -> DataFrame:
    """Every phrase of 2 to ``depth`` words that occurs ``least`` times in a language.

    ``lang``, ``words`` (array), ``n`` its count, ``starts`` and ``ends`` (arrays: counts of
    its first and its last 1, 2, ... words), ``left_most`` and ``right_most`` (the largest
    count of a phrase with one more word in front or behind, 0 if none reaches ``least``)
    and ``total``, all words of the language.
    """
    named = docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), docs[text].alias("text"))
    read = materialize(named.mapInArrow(_reading(depth, shard), READ))
    words = read.filter("word is not null")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    pair, same = (F.col("block") * (1 << BITS) + F.col("local")).alias("pair"), Window.partitionBy("lang", "word")
    summed = words.select("block", "local", "lang", "word", F.sum("n").over(same).alias("n"), F.min(pair).over(same).alias("gid"), pair)
    first = F.col("gid") == F.col("pair")
    frequent = summed.filter(F.col("n") >= least).select(
        "block", "local", "gid", *[F.when(first, F.col(c)).alias(c) for c in ("lang", "word", "n")])
    known = materialize(frequent.mapInArrow(_tell_words, KNOWN))
    index = read.filter("bwt is not null").select("block", F.col("local").alias("sign"), "bwt")
    shards, size = index.agg(F.count(F.lit(1)), F.sum(F.octet_length("bwt"))).first()
    parts, ranges = max(1, shards), parts_for(size, 3 * range_ids)
    told = known.filter("word is null").select([c.split()[0] for c in ANSWER.split(", ")])
    found = materialize(union_all(_levels(index, told, depth, least, parts, ranges)))
    return _described(found.mapInArrow(_unpack, FOUND), known.filter("word is not null"), totals, depth)


def _levels(index: DataFrame, words: DataFrame, depth: int, least: int, parts: int, ranges: int) -> list[DataFrame]:
    """Frequent phrases of each length from 2, as one plan whose exchanges are shared by all levels."""
    dealt = index.repartition(parts, "block")
    answers, found = [words.repartition(parts, "block").drop("counts")], []
    for step in range(2, depth + 1):
        told = union_all(list(answers))
        messages = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_extend(step, ranges), MESSAGE)
        summed = messages.groupBy("rng").applyInArrow(_sum(step, least), ANSWER).repartition(parts, "block")
        answers.append(summed.filter("block >= 0").drop("counts"))
        found.append(summed.filter("block < 0"))
    return found


def _described(found: DataFrame, frequent: DataFrame, totals: DataFrame, depth: int) -> DataFrame:
    """Words, counts of beginnings and ends, and largest extensions of every phrase."""
    one = F.array("n")
    known = frequent.select("gid", "lang", F.array("word").alias("words"), one.alias("starts"), one.alias("ends"))
    out = []
    for step in range(2, depth + 1):
        rows = found.filter(F.col("step") == step).select("prefix", "suffix", "gid", "n")
        begins = known.select(F.col("gid").alias("prefix"), "lang", "words", "starts")
        ends = known.select(F.col("gid").alias("suffix"), F.element_at("words", -1).alias("last"), "ends")
        known = materialize(rows.join(begins, "prefix").join(ends, "suffix").select(
            "gid", "lang", F.concat("words", F.array("last")).alias("words"), F.concat("starts", one).alias("starts"),
            F.concat("ends", one).alias("ends")))
        longer = found.filter(F.col("step") == step + 1)
        left = longer.groupBy(F.col("suffix").alias("gid")).agg(F.max("n").alias("left_most"))
        right = longer.groupBy(F.col("prefix").alias("gid")).agg(F.max("n").alias("right_most"))
        out.append(known.join(left, "gid", "left").join(right, "gid", "left"))
    none = F.lit(0).cast("bigint")
    return union_all(out).join(totals, "lang").select(
        "lang", "words", F.element_at("starts", -1).alias("n"), "starts", "ends", F.coalesce("left_most", none).alias("left_most"),
        F.coalesce("right_most", none).alias("right_most"), "total")


def collocations(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer phrase accounts for whole, with the score of their weakest cut.

    ``lang``, ``phrase``, ``a`` its count, ``l`` and ``r`` the counts of both sides of the cut,
    ``n`` the words of the language and ``score``, 1000 * a * n / (l * r) rounded down; of
    equal scores the first cut.
    """
    alone = phrases.filter(F.greatest("left_most", "right_most") < F.col("n"))
    wide = "decimal(19,0)"
    top = F.lit(1000).cast("decimal(4,0)") * F.col("n").cast(wide) * F.col("total").cast(wide)

    def cut(k):
        left, right = F.element_at("starts", k), F.element_at("ends", F.size("words") - k)
        return F.struct(F.call_function("div", top, left.cast(wide) * right.cast(wide)).alias("score"), k.alias("k"),
                        left.alias("l"), right.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), F.size("words") - 1), cut))
    return alone.withColumn("best", best).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), "best.l", "best.r",
        F.col("total").alias("n"), "best.score")


def report(found: DataFrame, cap: int) -> DataFrame:
    """``rank`` from 1 and the first ``cap`` collocations of each language by score, count and phrase.

    Each of 64 parts of a language is trimmed before the language is ranked as a whole.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= cap)
    ranked = few.withColumn("rank", F.row_number().over(whole).cast("bigint")).filter(F.col("rank") <= cap)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

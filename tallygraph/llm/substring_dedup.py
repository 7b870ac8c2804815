"""Removal of word runs that occur more than once, behind a count-min prefilter.

Documents lie in blocks of about ``BLOCK_BYTES`` of text, dealt by a hash of their id.

1. Every block counts its windows in a count-min sketch of two rows.  The sketch is cut
   into ranges by window hash, as many as the corpus needs for a load of one sixteenth,
   and only cells that were touched are sent (two bytes each, counts saturate at two).
   Each range merges its blocks' sketches and answers, cell by cell, which are estimated
   repeated.  An estimate is never below the count, so no repeated window is lost.
2. Only windows that both rows estimate repeated are sent again, as 128-bit digests, once
   per block, and grouped exactly.  Digest equality stands for equality of the words.
3. Each block takes the words that repeated windows cover out of its texts.

A window held by a third of all documents is one cell and one digest per block.  Nothing
goes through the driver but the total size.  All hashes depend on the words alone, so a
lost task is simply run again.

A null text has no words and stays null; an empty one stays empty; a text shorter than a
window keeps all of its words.  Repeated rows and repeated ids are separate documents, so
equal rows empty each other.  A table without rows gives no rows.  All columns are carried
along under neutral names, so none can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygraph.llm.common import TextBatch, mix, parts_for, utf8_size

BLOCK_BYTES = 8 << 20
RANGE_BYTES = 1_500_000     # text per sketch range: about a quarter million windows
CELL_BITS = 22              # cells of one sketch row in one range
_LOW, _CELLS = 16, 1 << CELL_BITS

SKETCH = "rng bigint, block bigint, counts0 binary, lows0 binary, counts1 binary, lows1 binary"
ANSWER = "block bigint, step int, rng bigint, mask0 binary, mask1 binary"
PAIR = [("a", "<u8"), ("b", "<u8")]
DIGESTS = "rng bigint, block bigint, digests binary"


class _Windows:
    """The windows of one block, in an order that every pass finds again."""

    def __init__(self, table: pa.Table, text: int, size: int, ranges: int):
        self.texts = pc.struct_field(table.column("record"), [text]).to_pylist()
        self.batch = TextBatch(self.texts)
        self.size, self.ranges = size, ranges
        self.words = self.batch.hashes()
        self.hash, self.at = self.batch.window_hashes(self.words, size)

    def second_hash(self) -> np.ndarray:
        return self.batch.window_hashes(mix(self.words ^ np.uint64(0xA5A5A5A5A5A5A5A5)), self.size)[0]

    def cells(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """One sketch row: sorted (range, cell) keys with counts up to two, and each window's place there."""
        rng = mix(self.hash) % np.uint64(self.ranges) << np.uint64(CELL_BITS)
        return _at_most_two(rng | (self.hash >> np.uint64(row * CELL_BITS) & np.uint64(_CELLS - 1)))


def _at_most_two(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values, each at most twice, and where each input value is among them."""
    order = np.argsort(values)
    ordered = values[order]
    keep = np.ones(len(values), bool)
    keep[2:] = ordered[2:] != ordered[:-2]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(keep) - 1
    return ordered[keep], place


def _by_range(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges among sorted keys, and where each starts (with the end appended)."""
    rng = keys >> np.uint64(CELL_BITS)
    first = np.flatnonzero(np.concatenate([[True], rng[1:] != rng[:-1]])) if len(rng) else np.zeros(0, int)
    return rng[first].astype(np.int64), np.append(first, len(keys))


def _table(schema: str, columns: list) -> pa.Table:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.table([pa.array(c, arrow[k]) for c, k in zip(columns, kinds)], names=list(names))


def _sketch(block: int, windows: _Windows) -> pa.Table:
    sent0, sent1 = windows.cells(0)[0], windows.cells(1)[0]
    columns: list[list] = [[] for _ in range(6)]
    (ranges, bounds0), (_, bounds1) = _by_range(sent0), _by_range(sent1)     # the same ranges in both rows
    for i, rng in enumerate(ranges):
        row = [int(rng), block]
        for sent, bounds in ((sent0, bounds0), (sent1, bounds1)):
            cells = sent[bounds[i]:bounds[i + 1]] & np.uint64(_CELLS - 1)
            high = np.bincount((cells >> np.uint64(_LOW)).astype(np.int64), minlength=_CELLS >> _LOW)
            row += [high.astype("<u4").tobytes(), (cells & np.uint64(0xFFFF)).astype("<u2").tobytes()]
        for column, value in zip(columns, row):
            column.append(value)
    return _table(SKETCH, columns)


def _merge(rows: pa.Table) -> pa.Table:
    """Which cells of a range are repeated, answered to each block in the order it sent them."""
    masks = []
    for d in ("0", "1"):
        parts = []
        for counts, lows in zip(rows.column("counts" + d).to_pylist(), rows.column("lows" + d).to_pylist()):
            high = np.repeat(np.arange(_CELLS >> _LOW, dtype=np.int64), np.frombuffer(counts, "<u4"))
            parts.append((high << _LOW) | np.frombuffer(lows, "<u2"))
        repeated = np.bincount(np.concatenate(parts), minlength=_CELLS) >= 2
        masks.append([np.packbits(repeated[p]).tobytes() for p in parts])
    n = rows.num_rows
    return _table(ANSWER, [rows.column("block").to_pylist(), [1] * n, rows.column("rng").to_pylist(), *masks])


def _flags(keys: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """The answers to sorted keys, one after the other."""
    ranges, bounds = _by_range(keys)
    out = np.zeros(len(keys), bool)
    for i, rng in enumerate(ranges):
        n = bounds[i + 1] - bounds[i]
        out[bounds[i]:bounds[i + 1]] = np.unpackbits(np.frombuffer(answers[int(rng)], np.uint8), count=n)
    return out


def _candidates(windows: _Windows, answers: pa.Table) -> np.ndarray:
    """Windows that both sketch rows estimate to occur at least twice."""
    chosen = answers.filter(pc.equal(answers.column("step"), 1))
    ranges = chosen.column("rng").to_pylist()
    out = np.ones(len(windows.hash), bool)
    for row in range(2):
        sent, place = windows.cells(row)
        out &= _flags(sent, dict(zip(ranges, chosen.column(f"mask{row}").to_pylist())))[place]
    return np.flatnonzero(out)


def _pairs(windows: _Windows, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct digests of the chosen windows, each at most twice, and each window's place among them."""
    a, b = windows.hash[chosen], windows.second_hash()[chosen]
    order = np.lexsort((b, a))
    pair = np.empty(len(chosen), PAIR)
    pair["a"], pair["b"] = a[order], b[order]
    keep = np.ones(len(pair), bool)
    keep[2:] = pair[2:] != pair[:-2]
    place = np.empty(len(pair), np.int64)
    place[order] = np.cumsum(keep) - 1
    return pair[keep], place


def _digest_range(sent: np.ndarray, ranges: int) -> np.ndarray:
    return (mix(sent["a"]) % np.uint64(ranges)).astype(np.int64)


def _group(rows: pa.Table) -> pa.Table:
    """Exact counts of a range's digests, answered to each block in the order it sent them."""
    parts = [np.frombuffer(d, PAIR) for d in rows.column("digests").to_pylist()]
    every = np.concatenate(parts)
    order = np.lexsort((every["b"], every["a"]))
    same = every[order][1:] == every[order][:-1]
    flag = np.zeros(len(every), bool)
    flag[order[1:]] |= same
    flag[order[:-1]] |= same
    masks = [np.packbits(f).tobytes() for f in np.split(flag, np.cumsum([len(p) for p in parts])[:-1])]
    n = rows.num_rows
    return _table(ANSWER, [rows.column("block").to_pylist(), [2] * n, rows.column("rng").to_pylist(), masks, [b""] * n])


def _repeated(windows: _Windows, answers: pa.Table) -> np.ndarray:
    """Windows that occur at least twice."""
    chosen = _candidates(windows, answers)
    sent, place = _pairs(windows, chosen)
    own = answers.filter(pc.equal(answers.column("step"), 2))
    answer = dict(zip(own.column("rng").to_pylist(), own.column("mask0").to_pylist()))
    rng = _digest_range(sent, windows.ranges)
    flags = np.zeros(len(sent), bool)
    order = np.argsort(rng, kind="stable")
    bounds = np.append(np.flatnonzero(np.diff(rng[order], prepend=-1)), len(order))
    for begin, end in zip(bounds[:-1], bounds[1:]):
        bits = np.frombuffer(answer[int(rng[order[begin]])], np.uint8)
        flags[order[begin:end]] = np.unpackbits(bits, count=end - begin)
    return chosen[flags[place]]


def _kept(windows: _Windows, repeated: np.ndarray) -> tuple[list, list, list]:
    """Per text: its words, how many of them repeated windows cover, and what is left."""
    batch, size = windows.batch, windows.size
    edge = np.zeros(len(batch.starts) + 1, np.int64)
    np.add.at(edge, windows.at[repeated], 1)
    np.add.at(edge, windows.at[repeated] + size, -1)
    covered = np.cumsum(edge)[:-1] > 0
    n_words, n_removed, kept = [], [], []
    for i, text in enumerate(windows.texts):
        a, b = batch.first[i], batch.first[i + 1]
        gone = covered[a:b]
        n_words.append(int(b - a))
        n_removed.append(int(gone.sum()))
        words = batch.bytes[batch.begin[i]:batch.begin[i + 1]].split()
        if n_removed[-1]:
            words = [words[j] for j in np.flatnonzero(~gone)]
        kept.append(None if text is None else b" ".join(words).decode("utf-8", "surrogatepass"))
    return n_words, n_removed, kept


def remove_repeats(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text",
                   block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``record`` (struct of all columns) with ``n_words``, ``n_removed`` and ``kept``, the words left."""
    size = docs.agg(F.sum(utf8_size(F.col(text)) + 16)).first()[0]
    blocks, ranges = parts_for(size, block_bytes), parts_for(size, range_bytes)
    text_at = docs.columns.index(text)
    scatter = F.when(docs[key].isNull(), F.xxhash64(docs[text])).otherwise(F.xxhash64(docs[key]))
    record = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("record")
    dealt = (docs.select(F.pmod(scatter, F.lit(blocks)).alias("block"), record)
             .repartition(blocks, "block"))

    def sketch(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _sketch(key[0].as_py(), _Windows(rows, text_at, window, ranges))

    def digests(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        windows = _Windows(rows, text_at, window, ranges)
        sent, _ = _pairs(windows, _candidates(windows, answers))
        rng = _digest_range(sent, ranges)
        order = np.argsort(rng, kind="stable")
        bounds = np.append(np.flatnonzero(np.diff(rng[order], prepend=-1)), len(order))
        cuts = list(zip(bounds[:-1], bounds[1:]))
        return _table(DIGESTS, [[int(rng[order[a]]) for a, _ in cuts], [key[0].as_py()] * len(cuts),
                                [sent[order[a:b]].tobytes() for a, b in cuts]])

    def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
        windows = _Windows(rows, text_at, window, ranges)
        n_words, n_removed, kept = _kept(windows, _repeated(windows, answers))
        return pa.table({"record": rows.column("record"), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    sketches = dealt.groupBy("block").applyInArrow(sketch, SKETCH)
    estimates = sketches.groupBy("rng").applyInArrow(_merge, ANSWER)
    sent = dealt.groupBy("block").cogroup(estimates.groupBy("block")).applyInArrow(digests, DIGESTS)
    exact = sent.groupBy("rng").applyInArrow(_group, ANSWER)
    answers = estimates.unionByName(exact)
    schema = T.StructType([dealt.schema["record"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    out = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(remove, schema)
    names = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    return out.select(F.col("record").cast(names).alias("record"), "n_words", "n_removed", "kept")

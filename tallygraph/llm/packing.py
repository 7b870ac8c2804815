"""Best-fit packing of documents into training sequences under several capacities.

A sequence has room for so many tokens, so many documents and so much attention cost
(a piece of n tokens costs n * n).  Pieces go in by falling length; among the open
sequences with room under every capacity, the one with the smallest weighted norm of
what would be left over (``rule="norm"``) or the largest weighted dot product of need
and room (``rule="dot"``) takes the piece.

Only documents longer than a sequence are cut, into full pieces and a rest.  A full piece
is a sequence by itself.  The rests are spread by hash over groups of about
``GROUP_TOKENS`` tokens and packed group by group, so a task holds some thousand lengths
however many documents there are, and each group leaves about one sequence half empty.
Texts never move: pieces are made where a document is read, and carry lengths and sums.

A null text is an empty one and, like it, one end token.  Rows with a null or repeated id
are packed like any other.  A table without rows gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.llm import wordbpe
from tallygraph.llm.common import parts_for
from tallygraph.session import materialize

END_ID = 0
GROUP_TOKENS = 8_000_000
WEIGHTS = (1.0, 0.001, 0.001)       # tokens, documents, attention cost

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, key: str = "doc_id", text: str = "text",
           keep_ids: bool = False) -> DataFrame:
    """Token pieces of every document, its end token included; with ``ids`` if asked for."""
    schema = PIECES + (", ids array<bigint>" if keep_ids else "")

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordbpe.load(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (encoder.ids(value) if value is not None else b"") + end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    row = (doc, number, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int64)) if keep_ids else row)
            cells = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cells, kinds)], names)

    return docs.select(docs[key].cast("bigint").alias("k"), docs[text].alias("t")).mapInArrow(run, schema)


def fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int, rule: str = "norm",
        weights: tuple[float, float, float] = WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length; no capacity is ever exceeded.

    A piece that alone exceeds the cost capacity gets a sequence of its own.
    """
    limits = np.array([capacity, max_docs, max_cost], float)
    scale = np.array(weights) / limits ** 2
    room = np.empty((3, 64))
    number = np.empty(64, np.int64)     # of the open sequence in each column of room
    open_count = opened = 0
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    smallest = float(lengths.min()) if len(lengths) else 0.0
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        now = room[:, :open_count]
        fits = np.flatnonzero((now >= need[:, None]).all(axis=0))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin(scale @ (now[:, fits] - need[:, None]) ** 2)]
            else:
                at = fits[np.argmax((scale * need) @ now[:, fits])]
        else:
            if open_count == room.shape[1]:
                room = np.concatenate([room, np.empty_like(room)], axis=1)
                number = np.concatenate([number, np.empty_like(number)])
            at = open_count
            room[:, at], number[at] = limits, opened
            open_count += 1
            opened += 1
        place[i], offset[i] = number[at], capacity - room[0, at]
        room[:, at] -= need
        if room[0, at] < smallest or room[1, at] < 1 or room[2, at] <= 0:      # full: the last one takes its column
            open_count -= 1
            room[:, at], number[at] = room[:, open_count], number[open_count]
    return place, offset


def pack(cut: DataFrame, capacity: int = 2048, max_docs: int | None = None, max_cost: int | None = None,
         rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS,
         group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``sequence_id`` and ``offset`` for each piece; ``cut`` has the columns of ``pieces``.

    Unset capacities for documents and cost are those that tokens alone already ensure.
    """
    max_docs, max_cost = max_docs or capacity, max_cost or capacity * capacity
    table = materialize(cut.select("doc_id", "piece", "start", "length", "ids_crc32")
                        .withColumn("row", F.monotonically_increasing_id()))
    groups = parts_for(table.agg(F.sum("length")).first()[0], group_tokens)
    spread = F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups))

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        by = [(c, "ascending") for c in ("doc_id", "piece", "row")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=by, null_placement="at_start"))
        place, offset = fit(rows.column("length").to_numpy(), capacity, max_docs, max_cost, rule, weights)
        own = key[0].as_py() + groups * (place + 1)
        return (rows.select([c.split()[0] for c in PIECES.split(", ")])
                .append_column("sequence_id", pa.array(own)).append_column("offset", pa.array(offset)))

    whole = (table.filter(F.col("length") == capacity)
             .select("doc_id", "piece", "start", "length", "ids_crc32",
                     (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))
    rests = (table.filter(F.col("length") < capacity).withColumn("grp", spread.cast("bigint"))
             .groupBy("grp").applyInArrow(run, PLACED))
    return whole.unionByName(rests)


def sequences(placed: DataFrame, cut: DataFrame) -> DataFrame:
    """Token ids of each sequence in order; ``cut`` holds ``ids`` and unique (doc_id, piece)."""
    parts = placed.join(cut.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))

"""Order-dependent operators that stay parallel inside one huge group.

A window over a group that holds a third of all rows runs in one task.  The
operators here first cut every group into blocks of at most ``width``
consecutive positions, so a task sees one block, and carry block totals
forward.  Positions must be unique in their group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.session import by_shuffle, materialize

BLOCK = 65_536
PRUNED_LIMIT = 1000     # up to here Spark trims row_number groups before the shuffle
SPREAD = 64


def running_total(df: DataFrame, group: list[str], pos: str, value: Column, out: str,
                  width: int = BLOCK) -> DataFrame:
    """Sum of ``value`` over all rows of the group up to and including this one.

    Rows shuffle once, on (group, block), for the window and the join alike; the
    block totals are one row per ``width`` positions and are summed per group.
    The key is a struct, so that a null group is a group like any other.
    """
    block = F.floor(F.col(pos) / F.lit(width)).cast("bigint").alias("block")
    whole = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    rows = (df.withColumn("_key", F.struct(whole.alias("whole"), block)).withColumn("_value", value))
    before = Window.partitionBy("_key.whole").orderBy("_key.block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy("_key").agg(F.sum("_value").alias("_sum"))
              .select("_key", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("_key").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("_inside", F.sum("_value").over(inside)).join(by_shuffle(totals), "_key")
            .withColumn(out, F.col("_before") + F.col("_inside"))
            .drop("_key", "_value", "_inside", "_before"))


def dense_index(df: DataFrame, group: list[str], pos: str, out: str, width: int = BLOCK) -> DataFrame:
    """Zero-based place of each row in its group, in the order of ``pos``."""
    return running_total(df, group, pos, F.lit(1).cast("bigint"), out, width) \
        .withColumn(out, F.col(out) - 1)


def first_per_group(df: DataFrame, group: list[str], order: list[str], cap: int) -> DataFrame:
    """First ``cap`` rows of each group; ``cap`` 0 keeps all rows.

    Small caps are trimmed in each task before the shuffle.  Above
    ``PRUNED_LIMIT`` a first round over a spread key does that trimming.
    """
    if not cap:
        return df
    if cap > PRUNED_LIMIT:
        spread = F.pmod(F.xxhash64(*order), F.lit(SPREAD))
        local = Window.partitionBy(*group, spread).orderBy(*order)
        df = df.withColumn("_rn", F.row_number().over(local)).filter(F.col("_rn") <= cap).drop("_rn")
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(whole)).filter(F.col("_rn") <= cap).drop("_rn")


def ranked(df: DataFrame, group: list[str], order: list[str], out: str, keep_order: bool = True) -> DataFrame:
    """Zero-based place of each row in its group by columns of any sortable kind.

    Rows are dealt by ranges of (group, order) and written once, sorted; a place is the
    row's number in its part behind the rows of the group's earlier parts.  ``order``
    must tell all rows of a group apart, or equal rows get their places in any order.
    Its columns are left out of what is written unless they are to be kept.
    """
    whole = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    ranged = df.withColumn("_key", whole).repartitionByRange("_key", *order).sortWithinPartitions("_key", *order)
    dealt = ranged if keep_order else ranged.drop(*[c for c in order if c not in group])
    rows = materialize(dealt.withColumn("_seen", F.monotonically_increasing_id())) \
        .withColumn("_part", F.expr("shiftright(_seen, 33)"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # written out: they are few, and rows are not moved to meet them
    parts = materialize(rows.groupBy("_key", "_part").agg(F.min("_seen").alias("_first"), F.count(F.lit(1)).alias("_n"))
                        .select("_key", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (rows.join(parts, ["_key", "_part"]).withColumn(out, F.col("_before") + F.col("_seen") - F.col("_first"))
            .drop("_key", "_part", "_seen", "_first", "_before"))


def bounded_batches(ops: DataFrame, group: list[str], pos: str, size: Column,
                    max_bytes: int = fx.BATCH_BYTES) -> DataFrame:
    """``op_bytes`` and the ``batch`` number of each op: a batch closes with the op that fills it.

    Exactly the batches of a sequential pass.  What a pass does in a block of positions depends
    only on how many bytes the batch that comes in open still takes.  A task follows, in its
    block, the batches that begin at each op at which one may begin first, which are those of the
    first ``max_bytes``, and says what each leaves open; these few rows are walked from block to
    block, then each block is numbered from the bytes that really came in.  ``pos`` is the op's
    place in its group.  Only places and sizes are walked; what else an op has is joined to its
    batch at the end.
    """
    whole = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    sized = ops.withColumn("op_bytes", size.cast("bigint"))
    others = [c for c in sized.columns if c not in (*group, pos, "op_bytes")]
    rows = materialize(sized.select(whole.alias("grp"), F.floor(F.col(pos) / F.lit(BLOCK)).cast("bigint").alias("block"),
                                    F.col(pos).cast("bigint").alias("at"), "op_bytes"))
    kind, far = rows.schema["grp"].dataType.simpleString(), 2 ** 62

    def followed(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Places in order; of the ops that may begin a batch number, start and the next one's; bytes of the block."""
        order = np.argsort(block["at"].to_numpy(), kind="stable")
        sizes = block["op_bytes"].fill_null(0).to_numpy()[order]
        may = np.flatnonzero(block["op_bytes"].is_valid().to_numpy()[order])      # an op without a size begins none
        start = (np.cumsum(sizes) - sizes)[may]
        behind = np.maximum(np.searchsorted(start, start + max_bytes), np.arange(1, len(may) + 1))
        return order, may, start, behind, int(sizes.sum())

    def left_open(block: pa.Table) -> pa.Table:
        _, _, start, behind, total = followed(block)
        n = len(start)
        last = np.where(behind < n, behind, np.arange(n))
        begun = (behind < n).astype(np.int64)
        while (last[last] != last).any():
            begun, last = begun + begun[last], last[last]
        upto, first = np.unique(start, return_index=True)
        first = first[:int(np.searchsorted(upto, max_bytes)) + 1]
        leaves = np.maximum(start[last[first]] + max_bytes - total, 0)
        # the last row is for a batch that takes the whole block
        made = {"upto": [*start[first], far], "leaves": [*leaves, -total], "begun": [*(begun[first] + 1), 0]}
        same = block.select(["grp", "block"]).take(np.zeros(len(first) + 1, np.int64))
        return pa.table({**{c: same[c] for c in same.column_names}, **{c: pa.array(v, pa.int64()) for c, v in made.items()}})

    def came_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        takes = before = 0
        done = False
        for batch in batches:
            at, found = [], []
            for i, (first, *piece) in enumerate(zip(*[batch[c].to_pylist() for c in ("first", "upto", "leaves", "begun")])):
                upto, leaves, begun = piece
                if first:
                    takes, before, done = 0, 0, False
                if not done and takes <= upto:
                    at.append(i)
                    found.append((takes, before))
                    takes, before, done = leaves if upto < far else max(0, takes + leaves), before + begun, True
                if upto == far:
                    done = False
            same = batch.select(["grp", "block"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*same.columns, *[pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]],
                                             names=["grp", "block", "takes", "before"])

    def numbered(block: pa.Table) -> pa.Table:
        order, may, start, behind, _ = followed(block)
        begins = np.zeros(len(order), np.int64)
        i = int(np.searchsorted(start, block["takes"][0].as_py()))
        while i < len(may):
            begins[may[i]] = 1
            i = int(behind[i])
        number = pa.array(np.cumsum(begins) + block["before"][0].as_py() - 1)
        return block.select(["grp", "at", "op_bytes"]).take(order).append_column("batch", number)

    pieces = rows.groupBy("grp", "block").applyInArrow(left_open, f"grp {kind}, block bigint, upto bigint, leaves bigint, begun bigint")
    in_order = Window.partitionBy("grp").orderBy("block", "upto")
    walked = materialize(pieces.withColumn("first", F.lag("block").over(in_order).isNull())
                         .mapInArrow(came_in, f"grp {kind}, block bigint, takes bigint, before bigint"))
    batched = rows.join(by_shuffle(walked), ["grp", "block"]).groupBy("grp", "block").applyInArrow(
        numbered, f"grp {kind}, at bigint, op_bytes bigint, batch bigint")
    if not others:
        named = {**{c: F.col(f"grp.{c}") for c in group}, pos: F.col("at").cast(sized.schema[pos].dataType)}
        return batched.select(*[named.get(c, F.col(c)).alias(c) for c in sized.columns], "batch")
    keyed = batched.select("grp", F.col("at").alias("_pos"), "batch")
    return sized.withColumn("grp", whole).withColumnRenamed(pos, "_pos").join(by_shuffle(keyed), ["grp", "_pos"]) \
        .select(*[F.col("_pos" if c == pos else c).alias(c) for c in sized.columns], "batch")


def _later_slots(slots: DataFrame) -> DataFrame:
    """(grp, slot, later): ``own`` of the next slot of the group that has one, block by block of slots."""
    def behind(place: str, *by: str) -> WindowSpec:
        return Window.partitionBy(*by).orderBy(F.desc(place)).rowsBetween(Window.unboundedPreceding, -1)

    dealt = slots.withColumn("block", F.floor(F.col("slot") / F.lit(BLOCK)).cast("bigint"))
    blocks = dealt.groupBy("grp", "block").agg(F.min_by("own", F.when(F.col("own").isNotNull(), F.col("slot"))).alias("own")) \
        .select("grp", "block", F.last("own", ignorenulls=True).over(behind("block", "grp")).alias("beyond"))
    inside = dealt.withColumn("near", F.last("own", ignorenulls=True).over(behind("slot", "grp", "block")))
    return inside.join(blocks, ["grp", "block"]).select("grp", "slot", F.coalesce("near", "beyond").alias("later"))


def grid_place(index: Column) -> tuple[Column, Column]:
    """Coordinates of the n-th placed actor, fourteen to a row."""
    x = F.lit(fx.GRID_X0) + (index % fx.GRID_COLUMNS) * fx.GRID_DX
    y = F.lit(fx.GRID_Y0) + F.floor(index / fx.GRID_COLUMNS) * fx.GRID_DY
    return x.cast("bigint"), y.cast("bigint")

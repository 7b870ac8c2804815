"""Sequential walks in parallel: which rows does a walk from the first row reach.

Each row names the row it leads to, as a sequential program does that closes a batch or
skips a region.  Places are cut into blocks that double with every round.  A round keeps
only the rows at which a walk can enter a block, and joins their jumps with the jumps of
the half they land in; so rounds get smaller as blocks grow.  Back down, the rows at which
the one walk enters blocks give those at which it enters their halves.  No task sees a whole
walk; a walk over n places takes about 2 log2(n) rounds of equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.session import by_shuffle, materialize


def _same_block(size: int) -> Column:
    return F.shiftright("place", size) == F.shiftright("to_place", size)


def reached(steps: DataFrame, group: list[str], at: str, to: str, place: str | None = None,
            to_place: str | None = None) -> DataFrame:
    """(group, at): rows that the walk from the smallest ``at`` of each group visits.

    ``at`` is unique in its group.  ``place`` and ``to_place`` number the rows and those they
    lead to, in the order of ``at`` and closely; a step leads to a greater place.  Unset they
    are ``at`` and ``to``.  A null ``to``, or one that is no row's ``at``, ends the walk; a
    null group is a group.
    """
    key = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    names = {"at": at, "to": to, "place": place or at, "to_place": to_place or to}
    rows = materialize(steps.select(key.alias("grp"), *[F.col(c).cast("bigint").alias(n) for n, c in names.items()]))
    start = rows.groupBy("grp").agg(F.min("at").alias("at"))
    halves, size = [rows.filter("to is not null")], 0
    while True:
        size += 1
        jumps = halves[-1]
        out = jumps.filter(~_same_block(size))
        if out.isEmpty():
            break
        entries = out.select("grp", F.col("to").alias("at")).unionByName(start).distinct()
        second = jumps.select("grp", F.col("at").alias("to"), F.col("to").alias("to2"), F.col("to_place").alias("place2"))
        joined = jumps.join(by_shuffle(entries), ["grp", "at"], "left_semi").join(by_shuffle(second), ["grp", "to"], "left")
        inside = _same_block(size)
        halves.append(materialize(joined.select(
            "grp", "at", "place", F.when(inside, F.col("to2")).otherwise(F.col("to")).alias("to"),
            F.when(inside, F.col("place2")).otherwise(F.col("to_place")).alias("to_place")).filter("to is not null")))
    visited = start
    for jumps in reversed(halves):
        entered = jumps.filter(_same_block(size)).join(by_shuffle(visited), ["grp", "at"], "left_semi")
        visited = materialize(visited.unionByName(entered.select("grp", F.col("to").alias("at"))))
        size -= 1
    real = visited.join(by_shuffle(rows.select("grp", "at")), ["grp", "at"], "left_semi")
    return real.select(*[F.col(f"grp.{c}").alias(c) for c in group], F.col("at").alias(at))

"""Merkle manifest of a table, stored every few levels and recomputed in between.

A row's leaf hashes its columns; the leaves of a group, in order of the key, are joined
eight at a time, level by level, into the group's root, and the roots of all groups, in
order of the group, into one root.  ``build`` persists the leaves and every ``DEPTH``-th
level above them.  ``proofs`` works down from the root: the stored nodes below one node of
the next checkpoint are an aligned subtree of at most 8**DEPTH members, which is one row;
its missing levels are hashed again, every member's siblings are emitted with those
of the node above it, and the levels are forgotten with the row.

Nothing but native expressions is used.  Rows move as digests and keys, never as texts.  The
order comes from range partitions of (group, key, leaf), so a group that holds most rows
is many partitions; the window over them sees one row per partition and group.  The largest
group's size and the root are all that the driver reads.

A null column is hashed as ``-``; null groups and null keys come first.  Rows with equal
keys are ordered by leaf; equal rows are separate, equal leaves.  Empty and very long texts
are ordinary values.  A table without rows has no root and no proofs.  Only the named columns
are read, under neutral names, so others cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygraph.functions.text import let
from tallygraph.session import materialize

FAN = 8
DEPTH = 3               # levels from one stored level to the next


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*columns: Column) -> Column:
    """Hash of columns: ``-`` for null, else the size in bytes, a colon and the value."""
    cells = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in columns]
    return digest(F.concat(*cells))


def _runs(nodes: Column) -> Column:
    """Hash of every eight consecutive nodes; the last run may be shorter."""
    last = F.floor((F.size(nodes) - 1) / FAN).cast("int")
    return F.transform(F.sequence(F.lit(0), last),
                       lambda r: digest(F.array_join(F.slice(nodes, r * FAN + 1, FAN), "")))


def _levels_inside(total: Column) -> Column:
    """Levels above a stored level, up to the next one or the top of its group."""
    out = F.lit(DEPTH)
    for k in reversed(range(DEPTH)):
        out = F.when(total <= FAN ** k, k).otherwise(out)
    return out


def _recomputed(nodes: Column, levels: Column) -> Column:
    """The levels of one subtree, from its stored members to its top."""
    start = F.array(nodes).cast("array<array<string>>")
    return F.aggregate(F.array_repeat(F.lit(0), levels), start,
                       lambda found, _: F.concat(found, F.array(_runs(F.element_at(found, -1)))).cast("array<array<string>>"))


def _siblings(levels: Column, member: Column) -> Column:
    """For each level below the top, what stands left and right of the member's ancestor in its run."""
    width = F.array(*[F.lit(FAN ** k).cast("bigint") for k in range(DEPTH)])

    def around(nodes: Column, k: Column) -> Column:
        at = F.floor(member / F.element_at(width, k + 1)).cast("int")
        inside = at % FAN
        return F.struct(F.array_join(F.slice(nodes, at - inside + 1, inside), "").alias("left"),
                        F.array_join(F.slice(nodes, at + 2, F.lit(FAN - 1) - inside), "").alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), around)


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """The nodes of each group with their place in it and how many there are, written once."""
    ranged = nodes.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    rows = materialize(ranged.withColumn("seen", F.monotonically_increasing_id()))
    part = F.expr("shiftright(seen, 33)")
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy("grp", part.alias("part")).agg(F.min("seen").alias("first"), F.count(F.lit(1)).alias("n"))
              .select("grp", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                      F.sum("n").over(group).alias("total")))
    return (rows.withColumn("part", part).join(counts, ["grp", "part"])
            .withColumn("idx", F.col("before") + F.col("seen") - F.col("first"))
            .drop("seen", "part", "first", "before"))


def _subtrees(nodes: DataFrame) -> DataFrame:
    """One row per aligned subtree of a stored level, its members in order."""
    members = F.array_sort(F.collect_list(F.struct("idx", *[c for c in nodes.columns if c not in ("grp", "idx", "total")])))
    return (nodes.groupBy("grp", "total", F.expr(f"idx div {FAN ** DEPTH}").alias("sub")).agg(members.alias("members"))
            .withColumn("levels", _levels_inside(F.col("total"))))


@dataclass
class Tree:
    """``stored[0]`` holds the leaves, each next entry the level ``DEPTH`` above; the last one node per group."""

    stored: list[DataFrame]

    @property
    def roots(self) -> DataFrame:
        return self.stored[-1].select("grp", "hash")

    def paths(self, above: DataFrame) -> DataFrame:
        """Rows of ``stored[0]`` with ``path``, their siblings up to their root and on through ``above`` (grp, path)."""
        found = above.withColumn("idx", F.lit(0).cast("bigint"))
        for nodes in reversed(self.stored[:-1]):
            up = found.select("grp", F.col("idx").alias("sub"), F.col("path").alias("rest"))
            here = _subtrees(nodes).join(up, ["grp", "sub"])
            hashes = F.transform("members", lambda m: m["hash"])
            kept = [c for c in nodes.columns if c not in ("grp", "total")]
            proven = let(_recomputed(hashes, F.col("levels")), lambda levels: F.transform(
                "members", lambda m, i: F.struct(*[m[c].alias(c) for c in kept],
                                                 F.concat(_siblings(levels, i), "rest").alias("path"))))
            found = here.select("grp", F.inline(proven))
        return found


def tree(nodes: DataFrame, order: list[str]) -> Tree:
    """Tree over each ``grp`` of rows with ``hash``, in the order of the named columns."""
    stored = [materialize(_placed(nodes, order))]
    largest = stored[0].agg(F.max("total")).first()[0] or 1
    while largest > 1 or len(stored) == 1:
        tops = _recomputed(F.transform("members", lambda m: m["hash"]), F.col("levels"))
        up = _subtrees(stored[-1]).select(
            "grp", F.expr(f"(total + {FAN ** DEPTH - 1}) div {FAN ** DEPTH}").alias("total"), F.col("sub").alias("idx"),
            F.element_at(F.element_at(tops, -1), 1).alias("hash"))
        stored.append(materialize(up))
        largest = -(-largest // FAN ** DEPTH)
    return Tree(stored)


@dataclass
class Manifest:
    by_group: Tree
    over_groups: Tree
    root: str | None

    def proofs(self) -> DataFrame:
        """``key``, ``leaf``, the extra columns, ``subroot`` and ``path`` of every row.

        ``path`` is an array of (left, right): the siblings' hex digests on both sides,
        level by level from the leaf to the root.
        """
        top = self.over_groups.stored[-1].select("grp", F.array().cast(_PATH).alias("path"))
        groups = self.over_groups.paths(top).select(F.col("own").alias("grp"), F.col("hash").alias("subroot"), "path")
        rows = self.by_group.paths(groups.select("grp", "path")).join(groups.select("grp", "subroot"), "grp")
        extra = [c for c in rows.columns if c not in ("grp", "idx", "hash", "row", "key", "subroot", "path")]
        return rows.select("key", F.col("hash").alias("leaf"), *extra, "subroot", "path")


_PATH = "array<struct<left:string,right:string>>"


def build(docs: DataFrame, columns: list[str], group: str = "lang", key: str = "doc_id",
          extra: dict[str, Column] | None = None) -> Manifest:
    """Manifest of a table: leaves over ``columns``, a tree per ``group`` in order of ``key``, and one over the groups.

    ``extra`` columns are carried beside the leaves.
    """
    leaves = materialize(docs.select(
        F.struct(docs[group].alias("g")).alias("grp"), docs[key].alias("key"), leaf(*[docs[c] for c in columns]).alias("hash"),
        *[c.alias(name) for name, c in (extra or {}).items()], F.monotonically_increasing_id().alias("row")))
    by_group = tree(leaves, ["key", "hash", "row"])
    whole = by_group.roots.select(F.struct(F.lit(0).alias("g")).alias("grp"), F.col("grp").alias("own"), "hash")
    over = tree(whole, ["own"])
    first = over.roots.first()
    return Manifest(by_group, over, first["hash"] if first else None)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda h, step: digest(F.concat(step["left"], h, step["right"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings on a path, from the leaf's level up, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))

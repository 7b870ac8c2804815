"""Id resolution and links between actors: equi-joins on the 16-byte id.

Hot targets are left to adaptive skew handling, which splits the rows of one
key over several tasks.  That needs each join side to come straight from its
own shuffle, so no side here ends in an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.keys import present_id
from tallygraph.operators.actors import ROW_INDEX, is_valid, ref_of
from tallygraph.session import materialize
from tallygraph.sources.catalog import TableObject


CANDIDATES = "obj int, pos bigint, source_ref string, ord int, name string, target_id binary"


def last_wins(id_rows: DataFrame) -> DataFrame:
    """One row per id, a later row replaces an earlier one.

    Written out: the map feeds several joins, and a join over a plain table
    keeps adaptive skew handling, which an aggregate below it would switch off.
    """
    later = F.struct("obj", "pos")
    newest = id_rows.groupBy("id").agg(
        F.max_by(F.struct("ref", "cls", "form_ref", "obj", "pos"), later).alias("r"))
    return materialize(newest.select("id", "r.*"))


def wanted_ids(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The part of an id map that some row names, repeats included.

    Written out twice, as ids and as map: where few ids are named the planner sees that from
    the files, and neither the whole map nor the rows are moved to meet.
    """
    wanted = materialize(rows.select(F.col(column).alias("id")).distinct())
    return materialize(ids.join(wanted, "id", "left_semi"))


def repeated_ids(ids: DataFrame) -> DataFrame:
    """(id) of the ids that an id map holds more than once; none where ids are keys."""
    return materialize(ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"))


def left_to(rows: DataFrame, columns: list[str], ids: DataFrame) -> list[DataFrame]:
    """For each column the rows that are left to it: no earlier column of theirs names a known id.

    Unknown ids are found among the distinct ones and written out; where they are few, no row is moved.
    """
    left = [rows]
    for column in columns[:-1]:
        named = left[-1].select(F.col(column).alias("_id")).distinct()
        unknown = materialize(named.join(ids.select(F.col("id").alias("_id")), "_id", "left_anti"))
        left.append(left[-1].join(unknown, F.col(column).eqNullSafe(F.col("_id")), "left_semi"))
    return left


def link_candidates(df: DataFrame, obj: TableObject) -> DataFrame:
    """(source_ref, name, target_id): one row per non-zero reference of a row."""
    refs = [(c, n) for c, n in obj.refs if c in df.columns]
    if "_PARENTIDRREF" in df.columns:
        refs = [("_PARENTIDRREF", fx.HIERARCHY_TITLE), *refs]
    cells = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("name"),
                               present_id(F.col(c)).alias("id")) for i, (c, n) in enumerate(refs)])
    return (df.filter(is_valid(df, obj))
            .select(F.lit(obj.order).alias("obj"), F.col(ROW_INDEX).cast("bigint").alias("pos"),
                    ref_of(df, obj).alias("source_ref"), F.explode(cells).alias("l"))
            .select("obj", "pos", "source_ref", F.col("l.ord").alias("ord"),
                    F.col("l.name").alias("name"), F.col("l.id").alias("target_id"))
            .filter(F.col("target_id").isNotNull()))


def has_references(df: DataFrame, obj: TableObject) -> bool:
    return "_PARENTIDRREF" in df.columns or any(c in df.columns for c, _ in obj.refs)


def resolve_links(candidates: DataFrame, ids: DataFrame) -> DataFrame:
    """Links whose target exists and is another actor."""
    return (candidates.join(ids.select(F.col("id").alias("target_id"), F.col("ref").alias("target_ref")),
                            "target_id")
            .filter(F.col("source_ref") != F.col("target_ref"))
            .select("obj", "pos", "ord", "source_ref", "target_ref", "name"))


def parent_links(df: DataFrame, obj: TableObject, ids: DataFrame) -> DataFrame:
    """Hierarchy links only: a row to the row its parent id names."""
    only = link_candidates(df.withColumn("_PARENTIDRREF", F.col("_PARENTIDRREF")), obj)
    return resolve_links(only.filter(F.col("name") == fx.HIERARCHY_TITLE), ids)


def accepted_and_rejected(actors: DataFrame, forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Actors whose form exists, and error rows for the others."""
    known = forms.select(F.col("ref").alias("form_ref"))
    good = actors.join(known, "form_ref", "left_semi")
    bad = actors.join(known, "form_ref", "left_anti") \
        .select(F.lit("actor:no_form").alias("error"), "ref", "form_ref")
    return good, bad


def built_links(links: DataFrame, actors: DataFrame) -> DataFrame:
    """Links with two different endpoints that are both built."""
    known = actors.select("ref")
    return (links.filter(F.col("source_ref") != F.col("target_ref"))
            .join(known.withColumnRenamed("ref", "source_ref"), "source_ref", "left_semi")
            .join(known.withColumnRenamed("ref", "target_ref"), "target_ref", "left_semi"))

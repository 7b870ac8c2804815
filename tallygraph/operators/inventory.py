"""Inventory of a base or file: rows, fields and links per entity, and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.numbers import lookup
from tallygraph.operators.actors import is_valid
from tallygraph.session import small_table, union_all
from tallygraph.sources.catalog import Catalog

ENTITY_SCHEMA = ("ord int, key string, name string, kind string, fields array<string>, "
                 "links array<string>")


def _table_rows(tables: dict[str, DataFrame], keyed: list[tuple[str, str]]) -> DataFrame:
    parts = [tables[phys].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(key).alias("key"), "rows")
             for key, phys in keyed]
    return union_all(parts)


def base_entities(spark: SparkSession, tables: dict[str, DataFrame], catalog: Catalog) -> DataFrame:
    """One row per object and register with its row count, fields and links."""
    described, keyed = [], []
    for o in catalog.objects:
        described.append((o.order, o.scope, o.title, fx.KIND_LABELS.get(o.kind, o.kind),
                          [t for _, _, t in o.fields], [n for _, n in o.refs]))
        keyed.append((o.scope, o.phys))
    for r in catalog.registers:
        described.append((1000 + r.idx, f"reg{r.idx}", r.name, fx.REGISTER_LABEL,
                          [n for _, n, _ in r.resources], [n for _, n in r.dims]))
        keyed.append((f"reg{r.idx}", r.phys))
    return small_table(spark, described, ENTITY_SCHEMA) \
        .join(_table_rows(tables, keyed), "key", "left") \
        .withColumn("rows", F.coalesce("rows", F.lit(0)))


def base_totals(entities: DataFrame, currencies: DataFrame | None = None) -> DataFrame:
    """Entities, records, fields, links, registers; fields and links leave registers out."""
    own = F.col("kind") != fx.REGISTER_LABEL
    totals = entities.agg(
        F.count(F.lit(1)).alias("entities"), F.sum("rows").alias("records"),
        F.sum(F.when(own, F.size("fields")).otherwise(0)).alias("fields"),
        F.sum(F.when(own, F.size("links")).otherwise(0)).alias("links"),
        F.count_if(~own).alias("registers"))
    if currencies is None:
        return totals.withColumn("currencies", F.lit(0).cast("bigint"))
    counted = currencies.select("ref").distinct().agg(F.count(F.lit(1)).alias("currencies"))
    return totals.withColumn("k", F.lit(1)).join(counted.withColumn("k", F.lit(1)), "k").drop("k")


def class_counts(tables: dict[str, DataFrame], catalog: Catalog, counters: DataFrame | None,
                 classes: list[str] | None = None) -> DataFrame:
    """Planned rows per class: valid rows, all document lines, counter actors."""
    objects = [o for o in catalog.objects if not classes or o.cls in classes]
    parts = [tables[o.phys].filter(is_valid(tables[o.phys], o)).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(o.cls).alias("cls"), "n") for o in objects]
    with_lines = not classes or "documents" in classes
    lines = [tables[v.phys].agg(F.count(F.lit(1)).alias("n")) for v in catalog.lines] if with_lines else []
    if lines:
        all_lines = union_all(lines).agg(F.sum("n").alias("n")).filter(F.col("n") > 0)
        parts.append(all_lines.select(F.lit(fx.LINE_CLASS).alias("cls"), "n"))
        parts.append(all_lines.select(F.lit("counters").alias("cls"), F.lit(1).cast("bigint").alias("n")))
    if counters is not None:
        parts.append(counters.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0)
                     .select(F.lit("counters").alias("cls"), "n"))
    return union_all(parts).groupBy("cls").agg(F.sum("n").alias("n"))


def line_coverage(tables: dict[str, DataFrame], catalog: Catalog) -> DataFrame:
    """Line tables and their rows, next to the type buckets of the catalog."""
    counted = _table_rows(tables, [(v.scope, v.phys) for v in catalog.lines])
    return counted.agg(F.count(F.lit(1)).alias("line_tables"), F.sum("rows").alias("line_rows"))


def xml_entities(leaves: DataFrame, records: DataFrame) -> DataFrame:
    """Per record type: records, distinct field set in first-seen order, reference count."""
    named = leaves.withColumn("is_ref", F.col("leaf") == fx.XML_REFERENCE)
    valued = (~F.col("is_ref")) & (F.trim("text") != "") & (F.col("leaf") != F.col("tag"))
    per_leaf = named.groupBy("file_id", "tag", "leaf").agg(
        F.count_if(valued).alias("valued"), F.count_if("is_ref").alias("refs"),
        F.min(F.when(valued, F.struct("record_no", "leaf_no"))).alias("first_seen"))
    fields = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("valued") > 0, F.struct("first_seen", "leaf")))),
        lambda s: s["leaf"])
    per_tag = per_leaf.groupBy("file_id", "tag").agg(fields.alias("fields"), F.sum("refs").alias("links"))
    counted = records.groupBy("file_id", "tag").agg(F.count(F.lit(1)).alias("records"),
                                                    F.min("record_no").alias("first_record"))
    kind = F.when(F.col("tag").contains("."), F.regexp_extract("tag", r"^([^.]*)\.", 1)).otherwise("Объект")
    name = F.when(F.col("tag").contains("."), F.regexp_replace("tag", r"^[^.]*\.", "")).otherwise(F.col("tag"))
    return counted.join(per_tag, ["file_id", "tag"], "left").select(
        "file_id", F.col("tag").alias("key"), name.alias("name"),
        lookup(fx.METADATA_KINDS, kind, "object").alias("kind"), "records", "first_record",
        F.coalesce("fields", F.array().cast("array<string>")).alias("fields"),
        F.coalesce("links", F.lit(0)).alias("links"))


def xml_totals(entities: DataFrame) -> DataFrame:
    return entities.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("records").alias("records"),
        F.sum(F.size("fields")).alias("fields"), F.sum("links").alias("links"))


def analyze(files: DataFrame, totals: list[DataFrame]) -> DataFrame:
    """Uniform record per file: passport columns plus totals, zeros for formats without any.

    ``totals`` hold file_id, entities, records, fields, links per analysed file.
    """
    names = ["entities", "records", "fields", "links"]
    known = union_all([t.select("file_id", *names) for t in totals])
    joined = files.join(known, "file_id", "left")
    supported = F.col("format").isin("xml", "1cd", "dt", "cf")
    return joined.select(
        *files.columns, *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names],
        (F.coalesce("records", F.lit(0)) > 0).alias("has_data"),
        F.when(supported, "").otherwise(F.concat(F.lit("unsupported format: "), "format")).alias("note"))


def container_totals(objects: DataFrame, people: DataFrame) -> DataFrame:
    """Totals of configuration and dump files: objects found, names as records (not for cf)."""
    counted = objects.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("kind").contains("register")).alias("registers"))
    records = F.when(F.col("format") != "cf", F.col("names")).otherwise(0)
    return people.join(counted, "file_id", "left").select(
        "file_id", F.coalesce("entities", F.lit(0)).alias("entities"), records.cast("bigint").alias("records"),
        F.lit(0).cast("bigint").alias("fields"), F.lit(0).cast("bigint").alias("links"),
        F.coalesce("registers", F.lit(0)).alias("registers"))

"""Business entities: a capped sample of rows per catalog, full counts, a file entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.text import strip
from tallygraph.operators.actors import (ROW_INDEX, is_valid, salary_of, title_of, value_text)
from tallygraph.session import no_rows, union_all
from tallygraph.sources.catalog import TableObject


def entity_rows(df: DataFrame, obj: TableObject, cap: int) -> DataFrame:
    """First ``cap`` titled rows of one table as entities; the cap restarts per table.

    The rows come from a top-k by row index, which each task trims before
    anything moves; an untitled row does not use up the cap.
    """
    target = fx.ENTITY_CLASS[obj.cls]
    title = strip(title_of(df, obj))
    number = value_text(df, "_NUMBER") if "_NUMBER" in df.columns else F.lit(None).cast("string")
    date = value_text(df, "_DATE_TIME") if "_DATE_TIME" in df.columns else F.lit(None).cast("string")
    if target == "document":
        value = F.trim(F.concat(F.lit(fx.DOCUMENT_HINT + " "), F.coalesce(number, F.lit("")),
                                F.lit(" "), F.coalesce(date, F.lit(""))))
    else:
        value = F.lit(fx.ENTITY_HINT[target])
    salary = F.nullif(salary_of(df, obj), F.lit(0.0)) if target == "employee" else F.lit(None).cast("double")
    picked = df.filter(is_valid(df, obj)).select(
        F.lit(obj.order).alias("obj"), F.col(ROW_INDEX).cast("bigint").alias("pos"),
        F.lit(target).alias("entity"), F.left(title, F.lit(120)).alias("title"),
        F.left(value, F.lit(200)).alias("value"), salary.alias("_salary")).filter(F.col("title") != "")
    accounts = F.when(F.col("_salary").isNotNull(),
                      F.create_map(F.lit(fx.SALARY_ACCOUNT), F.col("_salary"))) \
        .otherwise(F.create_map().cast("map<string,double>"))
    return picked.orderBy("pos").limit(cap).withColumn("accounts", accounts).drop("_salary")


ROWS = ("obj int, pos bigint, entity string, title string, value string, accounts map<string,double>")


def entities(spark: SparkSession, tables: dict[str, DataFrame], objects: list[TableObject], caps: dict[str, int] | None = None,
             file_name: str | None = None, parent: str | None = None) -> DataFrame:
    limits = {**fx.ENTITY_CAPS, **(caps or {})}
    parts = [entity_rows(tables[o.phys], o, limits.get(o.cls, 0)) for o in objects if o.cls in fx.ENTITY_CLASS]
    return union_all(parts, empty=no_rows(spark, ROWS)).select(
        "*", F.lit(fx.ENTITY_CONFIDENCE).alias("confidence"), F.lit("1c").alias("source"),
        F.lit(file_name).cast("string").alias("source_url"), F.lit("confirmed").alias("status"),
        F.lit(parent).cast("string").alias("parent"))


def entity_counts(spark: SparkSession, tables: dict[str, DataFrame], objects: list[TableObject],
                  caps: dict[str, int] | None = None) -> DataFrame:
    """Valid rows and shown rows per class; shown adds up the per-table caps."""
    limits = {**fx.ENTITY_CAPS, **(caps or {})}
    parts = []
    for o in objects:
        if o.cls not in fx.ENTITY_CLASS:
            continue
        df = tables[o.phys]
        titled = strip(title_of(df, o)) != ""
        parts.append(df.filter(is_valid(df, o)).agg(
            F.count(F.lit(1)).alias("total"),
            F.least(F.count_if(titled), F.lit(limits.get(o.cls, 0))).alias("shown"))
            .select(F.lit(o.cls).alias("cls"), "total", "shown"))
    return union_all(parts, empty=no_rows(spark, "cls string, total bigint, shown bigint")).groupBy("cls").agg(
        F.sum("total").alias("total"), F.sum("shown").alias("shown"))


def file_entity(counts: DataFrame, file_name: str, file_format: str, kb: int,
                note: str | None = None, parent: str | None = None) -> DataFrame:
    """One document entity that describes the file: format, rows, counts per class, note."""
    listed = F.array_sort(F.collect_list(F.concat_ws(":", "cls", F.col("total").cast("string"))))
    whole = counts.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("rows"), listed.alias("per_class"))
    parts = F.concat_ws(
        "; ", F.lit(f"{fx.FILE_HINT} ({file_format})" if file_format else None).cast("string"),
        F.when(F.col("rows") > 0, F.concat(F.col("rows").cast("string"), F.lit(" рядків"))),
        F.when(F.size("per_class") > 0, F.array_join("per_class", ", ")), F.lit(note).cast("string"))
    accounts = F.map_filter(F.create_map(F.lit(fx.SIZE_ACCOUNT), F.lit(kb).cast("bigint"),
                                         F.lit(fx.ROWS_ACCOUNT), F.nullif(F.col("rows"), F.lit(0))),
                            lambda k, v: v.isNotNull())
    return whole.select(
        F.lit("document").alias("entity"), F.left(F.lit(file_name or fx.FILE_HINT), F.lit(120)).alias("title"),
        F.left(F.coalesce(F.nullif(parts, F.lit("")), F.lit(fx.FILE_FALLBACK)), F.lit(200)).alias("value"),
        F.lit(fx.ENTITY_CONFIDENCE).alias("confidence"), F.lit("1c").alias("source"),
        F.lit(file_name).cast("string").alias("source_url"), F.lit("confirmed").alias("status"),
        F.lit(parent).cast("string").alias("parent"), accounts.alias("accounts"))


def organization_name(spark: SparkSession, tables: dict[str, DataFrame], objects: list[TableObject]) -> DataFrame:
    """Title of the first valid row of the first organisations catalog that has one."""
    parts = [tables[o.phys].filter(is_valid(tables[o.phys], o))
             .select(F.lit(o.order).alias("obj"), F.col(ROW_INDEX).alias("pos"),
                     title_of(tables[o.phys], o).alias("title"))
             for o in objects if o.cls == "organizations"]
    titled = union_all(parts, empty=no_rows(spark, "obj int, pos bigint, title string")).filter(F.col("title") != "")
    return titled.agg(F.min_by("title", F.struct("obj", "pos")).alias("org_name"))


def summary(entity_rows_: DataFrame, org: DataFrame) -> DataFrame:
    """Entity count, organisation name and found flag: two one-row tables side by side."""
    counted = entity_rows_.agg(F.count(F.lit(1)).alias("entities")).withColumn("k", F.lit(1))
    named = org.withColumn("k", F.lit(1))
    return counted.join(named, "k", "left").select(
        "entities", F.coalesce("org_name", F.lit("")).alias("org_name"),
        (F.col("entities") > 0).alias("found"))

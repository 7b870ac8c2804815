"""Forms, actors and fills of one landed table: a projection per table, no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygraph import fixed as fx
from tallygraph.functions.keys import present_id, row_ref
from tallygraph.functions.text import blank_to_null
from tallygraph.session import small_table
from tallygraph.sources.catalog import TableObject

ROW_INDEX = "row_index"     # position of the row in its table, given by the landing job
STANDARD_KEYS = [("_CODE", "code"), ("_DESCRIPTION", "name"), ("_NUMBER", "number"),
                 ("_DATE_TIME", "date"), ("_POSTED", "posted")]
FIELDS_TYPE = "array<struct<id:string,title:string>>"
# Columns of a base that lacks the kind of table.
ID_ROWS = "id binary, ref string, cls string, form_ref string, obj int, pos bigint"
ACTORS = "obj int, pos bigint, ref string, form_ref string, title string, cls string, std map<string,string>"
SHELLS = f"{ACTORS}, data map<string,string>, position string, salary double"
PEOPLE = "code string, full_name string, position string, salary bigint"


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.typeName()


def value_text(df: DataFrame, column: str) -> Column:
    """A cell as text: null for blobs and for empty text."""
    if isinstance(df.schema[column].dataType, T.BinaryType):
        return F.lit(None).cast("string")
    return blank_to_null(F.col(column).cast("string"))


def ref_of(df: DataFrame, obj: TableObject) -> Column:
    key = obj.key_col if obj.key_col in df.columns else None
    ident = "_IDRREF" if "_IDRREF" in df.columns else None
    return row_ref(obj.scope, F.col(key) if key else None, _type(df, key) if key else "string",
                   F.col(ident) if ident else None, F.col(ROW_INDEX))


def title_of(df: DataFrame, obj: TableObject) -> Column:
    ref = ref_of(df, obj)
    if obj.kind == "doc":
        parts = [F.coalesce(value_text(df, c), F.lit("")) for c in ("_NUMBER", "_DATE_TIME")
                 if c in df.columns]
        return F.coalesce(blank_to_null(F.trim(F.concat_ws(" ", *parts))), ref)
    if obj.kind == "ref" and "_DESCRIPTION" in df.columns:
        return F.coalesce(value_text(df, "_DESCRIPTION"), ref)
    return ref


def is_valid(df: DataFrame, obj: TableObject) -> Column:
    """Catalogs and documents need an id; a register record needs any value."""
    if obj.id_col:
        return F.col(obj.id_col).isNotNull() if obj.id_col in df.columns else F.lit(False)
    cond = F.lit(False)
    for name in df.columns:
        if name != ROW_INDEX:
            cond = cond | F.col(name).isNotNull()
    return cond


def _sparse_map(pairs: list[tuple[str, Column]]) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,string>")
    cells = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])
    return F.map_from_entries(F.filter(cells, lambda c: c["value"].isNotNull()))


def standard_map(df: DataFrame) -> Column:
    return _sparse_map([(key, value_text(df, col)) for col, key in STANDARD_KEYS if col in df.columns])


def forms(spark: SparkSession, objects: list[TableObject]) -> DataFrame:
    """One form row per object, in object order."""
    rows = [(o.order, o.kind, o.form_ref, o.title, o.color, o.cls,
             [{"id": item, "title": title} for _, item, title in o.fields]) for o in objects]
    return small_table(
        spark, rows, f"obj int, kind string, ref string, title string, color string, cls string, fields {FIELDS_TYPE}")


def actors(df: DataFrame, obj: TableObject) -> DataFrame:
    """One actor per valid row."""
    return df.filter(is_valid(df, obj)).select(
        F.lit(obj.order).alias("obj"), F.col(ROW_INDEX).cast("bigint").alias("pos"),
        ref_of(df, obj).alias("ref"), F.lit(obj.form_ref).alias("form_ref"),
        title_of(df, obj).alias("title"), F.lit(obj.cls).alias("cls"), standard_map(df).alias("std"))


def named_columns(obj: TableObject, pattern: str) -> list[str]:
    """Columns whose human name matches, in column order."""
    return [c for c, name in obj.names if re.search(pattern, name.lower())]


def _first_text(df: DataFrame, columns: list[str]) -> Column:
    values = [value_text(df, c) for c in columns if c in df.columns]
    return F.coalesce(*values) if values else F.lit(None).cast("string")


def salary_of(df: DataFrame, obj: TableObject) -> Column:
    """First salary-like column that holds a number."""
    values = [F.col(c).cast("string").try_cast("double")
              for c in named_columns(obj, fx.SALARY_COLUMN) if c in df.columns]
    return F.coalesce(*values) if values else F.lit(None).cast("double")


def shells_and_fills(df: DataFrame, obj: TableObject) -> DataFrame:
    """Everything one table says about its actors, in one pass: shell, fill map, staff columns."""
    data = _sparse_map([(item, value_text(df, col)) for col, item, _ in obj.fields if col in df.columns])
    staff = obj.cls == "employees"
    position = _first_text(df, named_columns(obj, fx.POSITION_COLUMN))
    return df.filter(is_valid(df, obj)).select(
        F.lit(obj.order).alias("obj"), F.col(ROW_INDEX).cast("bigint").alias("pos"),
        ref_of(df, obj).alias("ref"), F.lit(obj.form_ref).alias("form_ref"),
        title_of(df, obj).alias("title"), F.lit(obj.cls).alias("cls"), standard_map(df).alias("std"),
        data.alias("data"),
        (F.coalesce(position, F.lit(fx.DEFAULT_POSITION)) if staff
         else F.lit(None).cast("string")).alias("position"),
        (F.nullif(salary_of(df, obj), F.lit(0.0)) if staff
         else F.lit(None).cast("double")).alias("salary"))


def is_filled() -> Column:
    """Rows without values are no fills, except for employees."""
    return (F.size("data") > 0) | (F.col("cls") == "employees")


def fills(df: DataFrame, obj: TableObject) -> DataFrame:
    """Sparse ``item_N -> value`` map per row; empty rows stay only for employees."""
    return shells_and_fills(df, obj).filter(is_filled()).drop("title")


def id_rows(df: DataFrame, obj: TableObject) -> DataFrame:
    """(id, ref, cls, form_ref) of the rows that carry an id."""
    return df.select(present_id(F.col("_IDRREF")).alias("id"), ref_of(df, obj).alias("ref"),
                     F.lit(obj.cls).alias("cls"), F.lit(obj.form_ref).alias("form_ref"),
                     F.lit(obj.order).alias("obj"), F.col(ROW_INDEX).cast("bigint").alias("pos")) \
        .filter(F.col("id").isNotNull())


def people(df: DataFrame, obj: TableObject) -> DataFrame:
    """Employee roll: code, full name, position with a default, whole salary or 0."""
    name = F.trim(F.coalesce(value_text(df, "_DESCRIPTION"), F.lit("")))
    position = _first_text(df, [c for c, n in obj.names if any(k in n.lower() for k in fx.PEOPLE_POSITION)])
    salary = _first_text(df, [c for c, n in obj.names if any(k in n.lower() for k in fx.PEOPLE_SALARY)])
    return df.filter(name != "").select(
        F.trim(F.coalesce(value_text(df, "_CODE"), F.lit(""))).alias("code"), name.alias("full_name"),
        F.coalesce(F.trim(position), F.lit(fx.DEFAULT_POSITION)).alias("position"),
        F.coalesce(salary.try_cast("double").cast("bigint"), F.lit(0).cast("bigint")).alias("salary"))

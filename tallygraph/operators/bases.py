"""Many bases in one plan: rows in long form and a catalog that is a table.

``model.LandedBase`` builds a branch of the plan per physical table, which suits one base.
Here all tables of all bases are one table, (base, phys, row_index, data): ``data`` is a
VARIANT object of the row's columns, ids in it as hexadecimal text.  What a table or column
is stands in catalog tables keyed by base, so bases whose field numbers clash never mix, and
a plan has the same few joins however many bases and tables there are.

Joins are with the catalog, whose size follows the number of columns of all bases, not the
rows: Spark broadcasts it below its own threshold and shuffles by (base, table) beyond;
links join by (base, id).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.keys import canon_class, first_human_name
from tallygraph.functions.text import blank_to_null
from tallygraph.sources import catalog

BASE = ("base",)
# By kind of table: pattern of its name, type in the catalog text, letter of refs, form, key column.
KINDS = {"ref": ("^_REFERENCE([0-9]+)$", "Reference", "c", "tmpl_ref", "_CODE"),
         "doc": ("^_DOCUMENT([0-9]+)$", "Document", "d", "tmpl_doc", "_NUMBER")}
STANDARD = {"_CODE": "code", "_DESCRIPTION": "name", "_NUMBER": "number", "_DATE_TIME": "date", "_POSTED": "posted"}
NO_ID = "00" * 16


def _by_kind(of: Column, at: int) -> Column:
    (first, spec), *rest = KINDS.items()
    out = F.when(of == first, spec[at])
    for kind, spec in rest:
        out = out.when(of == kind, spec[at])
    return out


@dataclass
class Bases:
    """``landing`` (base, phys, row_index, data), ``columns`` (base, phys, pos, column) and catalog tables of all bases.

    ``entries`` are ``catalog.metadata_entries`` with the base, ``configs`` has base, file,
    file_no and text.
    """

    landing: DataFrame
    columns: DataFrame
    entries: DataFrame
    configs: DataFrame

    def objects(self) -> DataFrame:
        """(base, phys, kind, scope, form_ref, title, cls, key_column, file): tables that the base's catalog knows."""
        phys, kind = F.upper("phys"), None
        for name, (rx, *_) in KINDS.items():
            kind = F.when(phys.rlike(rx), name) if kind is None else kind.when(phys.rlike(rx), name)
        tables = self.columns.select("base", "phys").distinct().withColumn("kind", kind).filter(F.col("kind").isNotNull())
        tables = tables.withColumns({"number": F.regexp_extract("phys", "([0-9]+)$", 1).cast("bigint"), "type": _by_kind(F.col("kind"), 1)})
        known = self.entries.groupBy("base", "type", "number").agg(F.max_by("uuid", "pos").alias("uuid"))
        texts = (self.configs.withColumn("uuid", F.regexp_extract("file", rf"^({fx.UUID})", 1))
                 .groupBy("base", "uuid").agg(F.min_by("text", "file_no").alias("text"), F.min_by("file", "file_no").alias("file")))
        found = tables.join(known, ["base", "type", "number"]).join(texts, ["base", "uuid"], "left")
        number = F.col("number").cast("string")
        generic = F.concat(F.when(F.col("kind") == "doc", fx.DEFAULT_TITLES["doc"])
                           .otherwise(fx.DEFAULT_TITLES.get("ref", fx.DEFAULT_TITLES["doc"])), number)
        titled = found.withColumn("title", F.coalesce(first_human_name(F.coalesce("text", F.lit(""))), generic))
        return titled.select("base", "phys", "kind", F.concat(_by_kind(F.col("kind"), 2), number).alias("scope"),
                             F.concat(_by_kind(F.col("kind"), 3), number).alias("form_ref"), "title",
                             canon_class(F.col("kind"), F.col("title")).alias("cls"), _by_kind(F.col("kind"), 4).alias("key_column"), "file")

    def fields(self) -> DataFrame:
        """(base, phys, column, role, title, item): what every column of a known table is, named by its own base."""
        seen = catalog.field_sightings(self.configs, self.entries, BASE)
        own = catalog.own_field_names(seen, BASE).withColumnRenamed("name", "own_name")
        shared = catalog.global_field_names(seen, BASE).withColumnRenamed("name", "shared_name")
        fld = F.concat(F.lit("_FLD"), F.regexp_extract("column", "([0-9]+)", 1))
        cols = (self.columns.join(self.objects().select("base", "phys", "kind", "file"), ["base", "phys"])
                .withColumns({"fld": fld, "parent_col": F.lit(None).cast("string")})
                .join(own, ["base", "file", "fld"], "left").join(shared, ["base", "fld"], "left"))
        return catalog.classify_columns(cols, BASE).select("base", "phys", "column", "role", "title", "item")

    def _rows(self) -> DataFrame:
        """Valid rows of known tables with their ref; a key that is empty or zero falls back to the id, then the place."""
        cell = F.try_variant_get("data", "$._IDRREF", "string")
        rows = self.landing.join(self.objects().drop("file"), ["base", "phys"]).withColumn("id", F.nullif(cell, F.lit(NO_ID)))
        cells = F.col("data").try_cast("map<string,variant>")
        key = F.element_at(cells, F.col("key_column"))
        text = F.nullif(key.try_cast("string"), F.lit(""))
        present = F.when(F.schema_of_variant(key) == "STRING", text).otherwise(F.nullif(text, F.lit("0")))
        name = F.coalesce(present, F.lower("id"), F.concat(F.lit("r"), F.col("row_index").cast("string")))
        return rows.filter("id is not null").select("*", cells.alias("cells"), F.concat_ws("-", "scope", name).alias("ref"))

    def actors(self) -> DataFrame:
        """(base, ref, form_ref, title, cls, std): one actor per valid row of every base."""
        text = lambda c: blank_to_null(F.element_at("cells", c).try_cast("string"))
        dated = F.nullif(F.trim(F.concat_ws(" ", text("_NUMBER"), text("_DATE_TIME"))), F.lit(""))
        std = F.map_from_entries(F.filter(
            F.array(*[F.struct(F.lit(name).alias("key"), text(c).alias("value")) for c, name in STANDARD.items()]),
            lambda e: e["value"].isNotNull()))
        title = F.coalesce(F.when(F.col("kind") == "doc", dated).otherwise(text("_DESCRIPTION")), F.col("ref"))
        return self._rows().select("base", "ref", "form_ref", title.alias("title"), "cls", std.alias("std"))

    def _cells(self) -> DataFrame:
        cells = self._rows().select("base", "phys", "ref", F.explode("cells").alias("column", "v"))
        return cells.join(self.fields(), ["base", "phys", "column"])

    def values(self) -> DataFrame:
        """(base, ref, item, title, value): every non-empty field of every row, in long form."""
        value = blank_to_null(F.col("v").try_cast("string"))
        return self._cells().filter("role = 'field'").select("base", "ref", "item", F.col("title"), value.alias("value")) \
            .filter("value is not null")

    def links(self) -> DataFrame:
        """(base, source_ref, target_ref, name): references to another row of the same base."""
        wanted = F.nullif(F.col("v").try_cast("string"), F.lit(NO_ID))
        named = self._cells().filter("role = 'reference'").select("base", F.col("ref").alias("source_ref"), F.col("title").alias("name"),
                                                                  wanted.alias("id")).filter("id is not null")
        targets = self._rows().select("base", "id", F.col("ref").alias("target_ref"))
        return named.join(targets, ["base", "id"]).filter("source_ref <> target_ref").select("base", "source_ref", "target_ref", "name")

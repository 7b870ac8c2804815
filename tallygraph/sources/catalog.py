"""Metadata catalog of a landed accounting base: entries, field names, columns, objects."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.keys import canon_class, first_human_name
from tallygraph.functions.numbers import lookup
from tallygraph.functions.text import blank_to_null
from tallygraph.session import small_table


def metadata_entries(catalogs: DataFrame, key: str = "file_id", text: str = "text") -> DataFrame:
    """(key, pos, uuid, type, number): one row per entry of each catalog text."""
    groups = [F.regexp_extract_all(text, F.lit(fx.CATALOG_ENTRY), F.lit(g)) for g in (1, 2, 3)]
    zipped = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("uuid", "type", "number"))])
    return (catalogs.select(key, F.posexplode(zipped).alias("pos", "e"))
            .select(key, "pos", F.col("e.uuid").alias("uuid"), F.col("e.type").alias("type"),
                    F.col("e.number").cast("bigint").alias("number")))


def type_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def coverage(entries: DataFrame) -> DataFrame:
    """Entries per type in the buckets handled and pending; other types are system types."""
    bucket = (F.when(F.col("type").isin(fx.HANDLED_TYPES), "handled")
              .when(F.col("type").isin(fx.PENDING_TYPES), "pending"))
    return (entries.withColumn("bucket", bucket).filter(F.col("bucket").isNotNull())
            .groupBy("bucket", "type").agg(F.count(F.lit(1)).alias("n")))


def field_sightings(configs: DataFrame, entries: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(file, file_no, pos, fld, name): a quoted name soon after a field's uuid in a config text.

    ``configs`` has file, file_no, text.  Only entries of type Fld count.  ``by`` names
    columns of both, as the base, that keep apart what must not mix.
    """
    rx = rf"(?s)({fx.UUID})(?=(.{{0,{fx.NAME_WINDOW}}}))"
    near = F.arrays_zip(F.regexp_extract_all("text", F.lit(rx), F.lit(1)).alias("uuid"),
                        F.regexp_extract_all("text", F.lit(rx), F.lit(2)).alias("window"))
    seen = (configs.select(*by, "file", "file_no", F.posexplode(near).alias("pos", "s"))
            .select(*by, "file", "file_no", "pos", F.col("s.uuid").alias("uuid"),
                    blank_to_null(F.regexp_extract("s.window", fx.QUOTED_NAME, 1)).alias("name"))
            .filter(F.col("name").isNotNull()))
    fields = entries.filter(F.col("type") == "Fld") \
        .groupBy(*by, "uuid").agg(F.max_by("number", "pos").alias("number"))
    return (seen.join(fields, [*by, "uuid"])
            .select(*by, "file", "file_no", "pos", F.concat(F.lit("_FLD"), F.col("number")).alias("fld"), "name"))


def global_field_names(sightings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Field -> name, the first sighting over all files wins."""
    return sightings.groupBy(*by, "fld").agg(F.min_by("name", F.struct("file_no", "pos")).alias("name"))


def own_field_names(sightings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(file, field) -> name inside one object's own text, the last sighting wins."""
    return sightings.groupBy(*by, "file", "fld").agg(F.max_by("name", "pos").alias("name"))


def metadata_objects(texts: DataFrame, key: str = "file_id", text: str = "text") -> DataFrame:
    """Distinct ``Kind.Name`` objects of each configuration text with kind and first position."""
    parts = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(fx.METADATA_OBJECT), F.lit(1)).alias("kind_ru"),
        F.regexp_extract_all(text, F.lit(fx.METADATA_OBJECT), F.lit(2)).alias("name"))
    return (texts.select(key, F.posexplode(parts).alias("pos", "o"))
            .groupBy(key, F.col("o.kind_ru").alias("kind_ru"), F.col("o.name").alias("name"))
            .agg(F.min("pos").alias("pos"))
            .select(key, F.concat_ws(".", "kind_ru", "name").alias("key"), "name",
                    lookup(fx.METADATA_KINDS, F.col("kind_ru"), "object").alias("kind"), "pos"))


def person_names(*texts: Column) -> Column:
    """Distinct full names over several decodings of the same bytes."""
    merged = None
    for t in texts:
        found = F.array_distinct(F.regexp_extract_all(t, F.lit(fx.PERSON_WITH_PATRONYMIC), F.lit(0)))
        merged = found if merged is None else F.array_union(merged, found)
    return merged


def field_title(column: Column, own: Column, shared: Column) -> Column:
    """Name from the object's own text, else the shared map, else a generic one."""
    number = blank_to_null(F.regexp_extract(column, "([0-9]+)", 1))
    generic = F.concat(F.lit(fx.GENERIC_FIELD), number)
    return F.when(number.isNull(), F.coalesce(own, column)).otherwise(F.coalesce(own, shared, generic))


def classify_columns(columns: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Role of every physical column: field (numbered item_N), reference or skip.

    ``columns`` has kind, phys, pos, column, parent_col, own_name, shared_name.
    """
    col, kind = F.col("column"), F.col("kind")
    standard = None
    for k, titles in fx.STANDARD_TITLES.items():
        for name, label in titles.items():
            cond = (kind == k) & (col == name)
            standard = F.when(cond, label) if standard is None else standard.when(cond, label)
    system = col.isin(fx.SYSTEM_COLUMNS) | col.rlike(fx.COMPOSITE_COLUMN)
    is_parent = F.coalesce(col == F.col("parent_col"), F.lit(False))
    named = field_title(col, F.col("own_name"), F.col("shared_name"))
    role = (F.when(is_parent, "reference").when(standard.isNotNull(), "field")
            .when(system, "skip").when(col.endswith("RREF"), "reference").otherwise("field"))
    title = (F.when(is_parent, fx.PARENT_TITLE).when(standard.isNotNull(), standard)
             .when(F.col("role") == "reference",
                   F.coalesce(lookup(fx.REFERENCE_TITLES, col), named))
             .when(F.col("role") == "field", named))
    order = Window.partitionBy(*by, "phys", "role").orderBy("pos")
    item = F.when(F.col("role") == "field",
                  F.concat(F.lit("item_"), F.row_number().over(order).cast("string")))
    return (columns.withColumn("role", role).withColumn("title", title).withColumn("item", item)
            .select(*by, "kind", "phys", "pos", "column", "role", "title", "item", "own_name", "shared_name"))


def resource_kind(name: Column) -> Column:
    return F.when(name.rlike(f"(?iu){fx.MONEY_RESOURCE}"), "money").otherwise("units")


@dataclass(frozen=True)
class TableObject:
    """A table that gives a form and actors (or, for a line table, postings)."""
    order: int
    kind: str
    phys: str
    scope: str
    form_ref: str
    title: str
    cls: str
    fields: tuple[tuple[str, str, str], ...]      # (column, item, title)
    refs: tuple[tuple[str, str], ...]             # (column, name)
    key_col: str | None
    id_col: str | None
    parent_col: str | None = None
    names: tuple[tuple[str, str], ...] = ()       # (column, human name), all columns

    @property
    def color(self) -> str:
        return fx.KIND_COLORS.get(self.kind, fx.OTHER_COLOR)


@dataclass(frozen=True)
class Register:
    """An accumulation register: dimensions, resources and their currencies."""
    idx: int
    phys: str
    name: str
    dims: tuple[tuple[str, str], ...]             # (column, name)
    resources: tuple[tuple[str, str, str], ...]   # (column, name, money or units)
    currency_dim: str | None
    signed: bool

    @property
    def counter(self) -> str:
        return f"ctr{self.idx}"


@dataclass(frozen=True)
class Catalog:
    objects: tuple[TableObject, ...]
    lines: tuple[TableObject, ...]
    registers: tuple[Register, ...]


_TABLES = {"ref": r"^_REFERENCE([0-9]+)$", "doc": r"^_DOCUMENT([0-9]+)$",
           "info": r"^_INFORG([0-9]+)$", "vt": r"^_DOCUMENT([0-9]+)_VT([0-9]+)$",
           "reg": r"^_ACCUMRG([0-9]+)$"}
_TYPES = {"ref": "Reference", "doc": "Document", "info": "InfoRg", "vt": "Document", "reg": "AccumRg"}
_SPEC = {"ref": ("c", "tmpl_ref", "_CODE", "_IDRREF"), "doc": ("d", "tmpl_doc", "_NUMBER", "_IDRREF"),
         "info": ("i", "tmpl_info", None, None)}


def discover(spark: SparkSession, schemas: dict[str, list[str]], entries: DataFrame,
             configs: DataFrame) -> Catalog:
    """Object descriptors from table schemas, catalog entries and configuration texts.

    Only metadata is collected: its size is the number of columns in the schema,
    whatever the tables hold.  Table names match without regard to case.
    """
    placed = []
    for phys in schemas:
        for kind, rx in _TABLES.items():
            m = re.match(rx, phys, re.I)
            if m:
                placed.append((kind, phys, int(m.group(1)), int(m.group(2)) if kind == "vt" else 0))
    tables = small_table(spark, placed, "kind string, phys string, idx bigint, sub bigint")
    types = F.create_map(*[F.lit(x) for kv in _TYPES.items() for x in kv])
    known = entries.groupBy("type", "number").agg(F.max_by("uuid", "pos").alias("uuid"))
    tables = tables.withColumn("type", F.element_at(types, F.col("kind")))
    tables = tables.join(known.select("type", F.col("number").alias("idx"), "uuid"), ["type", "idx"],
                         "left").filter(F.col("uuid").isNotNull() | (F.col("kind") == "vt"))
    texts = (configs.withColumn("uuid", F.regexp_extract("file", rf"^({fx.UUID})", 1))
             .groupBy("uuid").agg(F.min_by("text", "file_no").alias("text"),
                                  F.min_by("file", "file_no").alias("file")))
    tables = tables.join(texts, "uuid", "left")
    sightings = field_sightings(configs, entries)
    shared, own = global_field_names(sightings), own_field_names(sightings)

    listing = small_table(
        spark, [(p, i, c) for p, cols in schemas.items() for i, c in enumerate(cols)],
        "phys string, pos bigint, column string")
    parent = F.when(F.col("kind") == "vt", F.concat(F.lit("_DOCUMENT"), F.col("idx"), F.lit("_IDRREF")))
    fld = F.concat(F.lit("_FLD"), F.regexp_extract("column", "([0-9]+)", 1))
    cols = (listing.join(tables.select("kind", "phys", "idx", "file"), "phys")
            .withColumn("parent_col", parent).withColumn("fld", fld)
            .join(own.withColumnRenamed("name", "own_name"), ["file", "fld"], "left")
            .join(shared.withColumnRenamed("name", "shared_name"), "fld", "left"))
    heads = (tables.withColumn("human", first_human_name(F.coalesce("text", F.lit(""))))
             .select("kind", "phys", "idx", "sub", "human").collect())
    rows = classify_columns(cols).collect()
    by_table: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r["pos"]):
        by_table.setdefault(r["phys"], []).append(r)
    return _describe(spark, heads, by_table)


def _describe(spark: SparkSession, heads: list, by_table: dict[str, list]) -> Catalog:
    kinds = list(_TABLES)
    heads = sorted(heads, key=lambda h: (kinds.index(h["kind"]), h["idx"], h["sub"]))
    titles = {h["phys"]: h["human"] or _default_title(h["kind"], h["idx"]) for h in heads}
    doc_titles = {h["idx"]: titles[h["phys"]] for h in heads if h["kind"] == "doc"}
    for h in heads:
        if h["kind"] == "vt":
            titles[h["phys"]] = h["human"] or f"{doc_titles.get(h['idx'], _default_title('doc', h['idx']))} — строки"
    named = small_table(spark, [(h["phys"], h["kind"], titles[h["phys"]]) for h in heads],
                                  "phys string, kind string, title string")
    classes = {r["phys"]: r["cls"] for r in
               named.select("phys", canon_class(F.col("kind"), F.col("title")).alias("cls")).collect()}
    objects, lines, registers = [], [], []
    for order, h in enumerate(heads):
        kind, phys, cols = h["kind"], h["phys"], by_table[h["phys"]]
        if kind == "reg":
            registers.append(_register(h, titles[phys], cols))
            continue
        fields = tuple((c["column"], c["item"], c["title"]) for c in cols if c["role"] == "field")
        refs = tuple((c["column"], c["title"]) for c in cols if c["role"] == "reference")
        names = tuple((c["column"], c["shared_name"] or _generic(c["column"])) for c in cols)
        if kind == "vt":
            lines.append(TableObject(
                order, kind, phys, f"v{h['idx']}_{h['sub']}", f"tmpl_vt{h['idx']}_{h['sub']}",
                titles[phys], fx.LINE_CLASS, fields, refs, "_KEYFIELD", "_KEYFIELD",
                f"_DOCUMENT{h['idx']}_IDRREF", names))
        else:
            letter, form, key, ident = _SPEC[kind]
            objects.append(TableObject(
                order, kind, phys, f"{letter}{h['idx']}", f"{form}{h['idx']}", titles[phys],
                classes[phys], fields, refs, key, ident, None, names))
    return Catalog(tuple(objects), tuple(lines), tuple(registers))


def _default_title(kind: str, idx: int) -> str:
    return f"{fx.DEFAULT_TITLES.get(kind, fx.DEFAULT_TITLES['doc'])}{idx}"


def _generic(column: str) -> str:
    number = re.search("[0-9]+", column)
    return fx.GENERIC_FIELD + number.group(0) if number else column


def _register(head, title: str, cols: list) -> Register:
    def own(c):
        return c["own_name"] or c["column"]

    flds = [c for c in cols if c["column"].startswith("_FLD")]
    dims = tuple((c["column"], own(c)) for c in flds if c["column"].endswith("RREF"))
    money = re.compile(fx.MONEY_RESOURCE, re.I)
    resources = tuple((c["column"], own(c), "money" if money.search(own(c)) else "units")
                      for c in flds if not c["column"].endswith("RREF"))
    currency = next((c for c, n in dims if re.search(fx.CURRENCY_FIELD, n, re.I)), None)
    return Register(head["idx"], head["phys"], title, dims, resources, currency,
                    any(c["column"] == "_RECORDKIND" for c in cols))

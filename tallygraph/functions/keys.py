"""Stable keys: row refs, posting ids, namespaced refs, classes, name tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.text import blank_to_null, contains_any, let, strip


def canon_class(kind: Column, title: Column) -> Column:
    """Canonical class of an object from its kind and the keywords in its title."""
    def by_keyword(low: Column) -> Column:
        (first, words), *rest = fx.CLASS_KEYWORDS
        col = F.when(contains_any(low, words), first)
        for cls, words in rest:
            col = col.when(contains_any(low, words), cls)
        return col.otherwise(fx.OTHER_CLASS)

    by_kind = F.when(kind == "doc", fx.KIND_CLASS["doc"]).when(kind == "info", fx.KIND_CLASS["info"])
    return by_kind.otherwise(let(F.lower(F.coalesce(title, F.lit(""))), by_keyword))


def present_id(id_col: Column) -> Column:
    """An id that points somewhere: sixteen zero bytes mean no reference."""
    return F.when(id_col != F.unhex(F.lit("00" * 16)), id_col)


def row_ref(scope: str, key: Column | None, key_type: str, id_col: Column | None,
            row_index: Column) -> Column:
    """``scope-key`` from the business key, else the id in hex, else the row number.

    An empty text and a numeric zero are no keys; the text ``0`` is one.
    """
    options = []
    if key is not None:
        if key_type == "binary":
            options.append(blank_to_null(F.lower(F.hex(key))))
        elif key_type in ("string",):
            options.append(blank_to_null(key))
        elif key_type == "boolean":
            options.append(F.when(key, "True"))
        else:
            options.append(F.when(key != 0, key.cast("string")))
    if id_col is not None:
        options.append(blank_to_null(F.lower(F.hex(id_col))))
    options.append(F.concat(F.lit("r"), row_index.cast("string")))
    return F.concat(F.lit(f"{scope}-"), F.coalesce(*options))


def posting_id(*parts: Column) -> Column:
    """``p-`` and 26 hex digits of the sha256 of the parts joined by a bar."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.concat(F.lit(fx.POSTING_PREFIX),
                    F.left(F.sha2(F.encode(text, "utf-8"), 256), F.lit(fx.POSTING_DIGITS)))


def amount_text(amount: Column) -> Column:
    """A decimal with a fraction part, without trailing zeros but with at least one decimal: 2.0, 10.5, 0.125."""
    short = F.rtrim(amount.cast("string"), F.lit("0"))
    return F.when(short.endswith("."), F.concat(short, F.lit("0"))).otherwise(short)


def name_prefix(name: Column) -> Column:
    slug = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return F.concat(F.lit("twin_"), F.regexp_replace(slug, "^_+|_+$", ""))


def namespaced_ref(name: Column, ref: Column) -> Column:
    return F.concat(name_prefix(name), F.lit("__"), ref)


def first_human_name(text: Column) -> Column:
    """First Cyrillic run of 3 to 41 characters that is not one repeated letter."""
    runs = F.transform(F.regexp_extract_all(text, F.lit(fx.HUMAN_NAME), F.lit(0)), strip)
    real = F.filter(runs, lambda x: ~F.replace(x, F.lit(" "), F.lit("")).rlike(r"^(.?)\1*$"))
    return F.get(real, F.lit(0))


def is_person_name(name: Column) -> Column:
    """Two to four capitalised words, 6 to 70 characters, no digits, markup or stop words."""
    def test(n: Column) -> Column:
        words = F.split(n, rf"{fx.WS}+")
        return (F.char_length(n).between(6, 70) & ~n.rlike(fx.PERSON_FORBIDDEN)
                & F.size(words).between(2, 4) & F.forall(words, lambda w: w.rlike(fx.PERSON_WORD))
                & ~contains_any(F.lower(n), fx.PERSON_STOP_WORDS))

    return let(strip(F.coalesce(name, F.lit(""))), test)


def schema_class(type_name: Column) -> Column:
    """Entity class of a schema.org type name."""
    def named(t: Column) -> Column:
        (first, words), *rest = fx.SCHEMA_CLASSES
        col = F.when(contains_any(t, words), first).when(t == "person", "person")
        for cls, words in rest:
            col = col.when(contains_any(t, words), cls)
        return col.otherwise(F.coalesce(blank_to_null(t), F.lit("thing")))

    return let(F.lower(F.coalesce(type_name, F.lit(""))), named)

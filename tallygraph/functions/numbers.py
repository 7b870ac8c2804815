"""Numbers, sizes and dates read from text: ``Column -> Column``, null when unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.text import blank_to_null, let, strip


def lookup(mapping: dict, key: Column, default=None) -> Column:
    """Small fixed table as a literal map."""
    cells = F.create_map(*[F.lit(x) for item in mapping.items() for x in item])
    value = F.try_element_at(cells, key)
    return value if default is None else F.coalesce(value, F.lit(default))


def human_number(text: Column) -> Column:
    """``1.2M``, ``12.3K``, ``1 234`` or a number with a magnitude word, as bigint.

    Without a magnitude every separator is dropped, so ``12.5`` reads as 125.
    """
    def read(t: Column) -> Column:
        (value, pattern), *rest = fx.MAGNITUDES
        factor = F.when(t.rlike(pattern), F.lit(value))
        for value, pattern in rest:
            factor = factor.when(t.rlike(pattern), F.lit(value))
        found = F.struct(blank_to_null(F.regexp_extract(t, fx.NUMBER_RUN, 1)).alias("raw"), factor.alias("factor"))
        return let(found, scale)

    def scale(f: Column) -> Column:
        number = F.replace(F.replace(f["raw"], F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
        scaled = F.rint(number.try_cast("double") * f["factor"]).try_cast("bigint")
        plain = F.regexp_replace(f["raw"], "[^0-9]", "").try_cast("bigint")
        return F.when(f["factor"].isNotNull(), scaled).otherwise(plain)

    return let(strip(F.lower(F.replace(text, F.lit("\xa0"), F.lit(" ")))), read)


def money_number(text: Column) -> Column:
    """Amount written with a comma or a point as decimal mark, as double.

    Commas alone are decimal marks, so ``1,234,567`` is not a number.
    """
    def read(t: Column) -> Column:
        comma, point = t.contains(","), t.contains(".")
        comma_first = F.instr(F.reverse(t), ",") > F.instr(F.reverse(t), ".")
        no_points = F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
        return (F.when(comma & point & comma_first, F.replace(t, F.lit(","), F.lit("")))
                .when(comma & point, no_points).when(comma, F.replace(t, F.lit(","), F.lit(".")))
                .otherwise(t)).try_cast("double")

    return let(blank_to_null(F.regexp_replace(text, "[^0-9,.]", "")), read)


def installs_number(text: Column) -> Column:
    """``10,000,000+`` or ``1B+`` as bigint; a Cyrillic T counts as 10^9."""
    t = strip(text)
    digits = F.regexp_replace(F.regexp_extract(t, fx.INSTALLS, 1), rf"{fx.WS}|,", "")
    suffix = F.upper(F.regexp_extract(t, fx.INSTALLS, 2))
    return F.rint(digits.try_cast("double") * lookup(fx.INSTALL_SUFFIXES, suffix, 1)).try_cast("bigint")


def size_to_bytes(number: Column, unit: Column) -> Column:
    n = F.regexp_replace(number, "[ \xa0]", "")
    n = F.replace(n, F.lit(","), F.lit(".")).try_cast("double")
    factor = lookup(fx.SIZE_UNITS, F.upper(strip(F.coalesce(unit, F.lit("")))))
    return F.rint(n * factor).try_cast("bigint")


def human_size(n_bytes: Column) -> Column:
    """Bytes as ``153.3 MB``, or ``1.20 GB`` from 1024 MB on."""
    mb = n_bytes.cast("double") / F.lit(1048576.0)
    gigabytes = F.concat(F.bround(mb / 1024.0, 2).cast("decimal(20,2)").cast("string"), F.lit(" GB"))
    megabytes = F.concat(F.bround(mb, 1).cast("decimal(20,1)").cast("string"), F.lit(" MB"))
    return F.when(mb >= 1024.0, gigabytes).otherwise(megabytes)


def iso_date(text: Column) -> Column:
    """First yyyy-mm-dd as ``struct<ymd int, iso string>``; without one, ten characters as text."""
    def read(day: Column) -> Column:
        ymd = F.replace(day, F.lit("-"), F.lit("")).try_cast("int")
        return F.struct(ymd.alias("ymd"), F.coalesce(day, F.left(blank_to_null(text), F.lit(10))).alias("iso"))

    return let(blank_to_null(F.regexp_extract(text, fx.ISO_DATE, 0)), read)


def month_name_date(text: Column) -> Column:
    """Day, month name and year in any order as ``struct<ymd int, iso string>``.

    The calendar is not checked, so 31 February passes.
    """
    t = F.lower(text)
    word = blank_to_null(F.regexp_extract(t, "([a-zа-яіїєґ]{3,})", 1))
    found = F.struct(word.alias("word"), F.regexp_extract(t, r"(?U)\b([0-9]{1,2})\b", 1).try_cast("int").alias("day"),
                     F.regexp_extract(t, r"(?U)\b([0-9]{4})\b", 1).try_cast("int").alias("year"))

    def date(f: Column) -> Column:
        month = F.coalesce(lookup(fx.MONTH_STEMS, F.left(f["word"], F.lit(4))),
                           lookup(fx.MONTH_STEMS, F.left(f["word"], F.lit(3))))
        good = f["day"].between(1, 31) & f["year"].between(1990, 2100)
        return F.when(good, f["year"] * 10000 + month * 100 + f["day"])

    def show(ymd: Column) -> Column:
        iso = F.regexp_replace(ymd.cast("string"), "^(.{4})(..)(..)$", "$1-$2-$3")
        return F.struct(ymd.alias("ymd"), F.coalesce(iso, F.left(blank_to_null(text), F.lit(12))).alias("iso"))

    return let(let(found, date), show)


def flex_date(text: Column) -> Column:
    """Timestamp from four fixed layouts, null for any other text."""
    long_, short = strip(F.left(text, F.lit(19))), strip(F.left(text, F.lit(10)))
    ymd = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    clock = "[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
    return (F.when(long_.rlike(f"{ymd}T{clock}"), F.try_to_timestamp(long_, F.lit("yyyy-M-d'T'H:m:s")))
            .when(long_.rlike(f"{ymd} {clock}"), F.try_to_timestamp(long_, F.lit("yyyy-M-d H:m:s")))
            .when(short.rlike(f"{ymd}$"), F.try_to_timestamp(short, F.lit("yyyy-M-d")))
            .when(short.rlike(r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"),
                  F.try_to_timestamp(short, F.lit("d.M.yyyy"))))


def days_left(until: Column, as_of: Column) -> Column:
    return F.floor((F.unix_timestamp(until) - F.unix_timestamp(as_of)) / F.lit(86400.0))


def is_number(text: Column) -> Column:
    return F.coalesce((text.cast("string") != "") & text.cast("string").try_cast("double").isNotNull(),
                      F.lit(False))


def sample_indices(total: Column, k: int) -> Column:
    """Zero-based rows of a representative sample: head, evenly spaced middle, tail.

    The array holds at most ``k`` numbers, whatever the total is.
    """
    head = tail = max(1, k // 3)
    mid = k - head - tail
    total = total.cast("bigint")
    every = F.when(total > 0, F.sequence(F.lit(0).cast("bigint"), total - 1)) \
        .otherwise(F.array().cast("array<bigint>"))
    parts = [F.sequence(F.lit(0).cast("bigint"), F.lit(head - 1).cast("bigint"))]
    if mid > 0:
        step = (total - head - tail) / F.lit(float(mid + 1))
        parts.append(F.transform(F.sequence(F.lit(1), F.lit(mid)),
                                 lambda i: F.rint(step * i).cast("bigint") + head))
    parts.append(F.sequence(total - tail, total - 1))
    spread = F.array_distinct(F.concat(*parts))
    inside = F.filter(spread, lambda i: (i >= 0) & (i < total))
    return F.when(total <= k, every).otherwise(inside)

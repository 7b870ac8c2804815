"""Files as rows (path, content): formats, passports, and text, csv, json and xml profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions import text, urls
from tallygraph.functions.numbers import lookup, sample_indices
from tallygraph.functions.text import blank_to_null, let
from tallygraph.session import by_shuffle


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Whole files as (path, content, length); Spark splits the work by file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true") \
        .load(path).select("path", "content", "length")


def extension(path: Column) -> Column:
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1))


def _head(content: Column, n: int) -> Column:
    return F.hex(F.substring(content, 1, n))


def detect_format(path: Column, content: Column) -> Column:
    """Format by leading bytes, then by extension; an xml head or extension wins first."""
    head, ext = _head(content, 8), extension(path)
    return (F.when(head.startswith(b"<?xml".hex().upper()) | (ext == "xml"), "xml")
            .when(head == b"1CDBMSV8".hex().upper(), "1cd").when(head == b"1CIBDmpF".hex().upper(), "dt")
            .when(head.startswith("FFFFFF7F"), "cf").when(head.startswith(b"PK\x03\x04".hex().upper()), "zip")
            .when(ext == "cfe", "cf").when(ext.isin("1cd", "dt", "cf", "xlsx", "csv"), ext).otherwise("unknown"))


def detect_document(path: Column, content: Column, name: Column | None = None) -> Column:
    """Office-file format: container plus extension, pdf, json or xml heads, then the extension."""
    ext = extension(path)
    if name is not None:
        ext = F.coalesce(blank_to_null(extension(name)), ext)
    head = _head(content, 16)
    first = F.regexp_replace(F.decode(F.substring(content, 1, 16), "ISO-8859-1"), r"^[ \t\n\r\x0b\x0c]+", "")
    zipped = F.when(ext == "docx", "docx").when(ext.isin("xlsx", "xlsm"), "xlsx") \
        .otherwise(F.coalesce(blank_to_null(ext), F.lit("zip")))
    return (F.when(head.startswith(b"PK\x03\x04".hex().upper()), zipped)
            .when(head.startswith(b"%PDF-".hex().upper()), "pdf")
            .when(first.startswith("{") | first.startswith("["), "json")
            .when(first.startswith("<") & ~ext.isin("html", "htm"), "xml")
            .otherwise(F.coalesce(blank_to_null(ext), F.lit("unknown"))))


def passports(files: DataFrame, source: Column | None = None) -> DataFrame:
    """Size, hashes, mime type, format and source host of every file."""
    origin = source if source is not None else F.col("path")
    sha = F.sha2("content", 256)
    host = F.when(origin.rlike("^https?://"), urls.netloc(origin)).otherwise("")
    plain = F.regexp_replace(origin, r"\?.*$", "")
    return files.select(
        F.regexp_extract(plain, "([^/]*)$", 1).alias("file_name"),
        F.octet_length("content").cast("bigint").alias("bytes"),
        F.rint(F.octet_length("content") / F.lit(1024.0)).cast("bigint").alias("kb"), sha.alias("sha256"),
        F.left(sha, F.lit(16)).alias("sha16"),
        lookup(fx.MIME_TYPES, F.concat(F.lit("."), extension(plain)), fx.OTHER_MIME).alias("mime"),
        detect_format(F.col("path"), F.col("content")).alias("format"),
        detect_document(F.col("path"), F.col("content")).alias("document_format"), host.alias("host"))


def decode_payload(parts: Column) -> Column:
    """Bytes of a base64 payload given in parts: data prefix and blanks off, padding added."""
    joined = F.array_join(parts, "")
    body = F.when(joined.rlike("^data:[^,]*,"), F.regexp_replace(joined, "^data:[^,]*,", "")).otherwise(joined)
    body = F.regexp_replace(body, rf"{fx.WS}", "")
    pad = F.pmod(-F.char_length(body), F.lit(4))
    return F.try_to_binary(F.concat(body, F.repeat(F.lit("="), pad)), F.lit("base64"))


def text_lines(body: Column) -> Column:
    """Lines without their breaks; a final break adds no line."""
    lines = F.split(body, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    return let(lines, lambda x: F.when(F.get(x, F.size(x) - 1) == "", F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))


def _first(values: Column, cap: int | None) -> Column:
    return F.slice(values, 1, cap) if cap else values


def csv_profile(files: DataFrame, sample_rows: int = fx.FILE_SAMPLE_ROWS, max_columns: int | None = None) -> DataFrame:
    """Delimiter, header, columns, body rows and a row sample; no quoting.

    The first line with text is the header and tells the delimiter.  Lines are counted and sampled inside the file's row, so nothing is moved.
    """
    rows = files.select("file_id", F.filter(text_lines(F.col("text")), text.has_text).alias("_rows")) \
        .withColumn("_probe", F.get("_rows", F.lit(0)))
    delimiter = F.when(F.col("_probe").contains(fx.CSV_DELIMITERS[0]), fx.CSV_DELIMITERS[0])
    for d in fx.CSV_DELIMITERS[1:]:
        delimiter = delimiter.when(F.col("_probe").contains(d), d)
    rows = rows.withColumn("delimiter", delimiter.otherwise(",")) \
        .withColumn("header", F.coalesce(F.get("_rows", F.lit(0)), F.lit(""))) \
        .withColumn("rows", F.greatest(F.size("_rows") - 1, F.lit(0)).cast("bigint"))
    quoted = F.concat(F.lit("\\Q"), "delimiter", F.lit("\\E"))
    taken = sample_indices(F.col("rows"), sample_rows)
    shown = F.when(F.col("delimiter") == "\t", "\\t").otherwise(F.col("delimiter"))
    return rows.select("file_id", shown.alias("delimiter"), "header",
                       _first(F.split(F.col("header"), quoted), max_columns).alias("columns"), "rows",
                       F.transform(taken, lambda i: F.get("_rows", (i + 1).cast("int"))).alias("sample"),
                       (F.col("rows") > sample_rows).alias("sampled"))


def json_profile(files: DataFrame, max_chars: int = fx.FILE_MAX_CHARS, sample_rows: int = fx.FILE_SAMPLE_ROWS,
                 max_keys: int | None = None, item_chars: int | None = None) -> DataFrame:
    """Kind, length or keys, and sampled items as compact JSON; bad JSON keeps its head.

    Caps are for display: keys shown and characters of an item.
    """
    body = F.col("text")
    parsed = F.try_parse_json(body)
    items = F.from_json(F.when(body.rlike(rf"^{fx.WS}*\["), body), "array<string>")
    keys = F.json_object_keys(F.when(body.rlike(rf"^{fx.WS}*\{{"), body))
    rows = files.select("file_id", "text", parsed.isNotNull().alias("parsed"), items.alias("items"), keys.alias("keys"))
    n = F.size("items")
    k = max(5, sample_rows // 6)
    kind = F.when(~F.col("parsed"), "invalid").when(F.col("items").isNotNull(), "array") \
        .when(F.col("keys").isNotNull(), "object").otherwise("scalar")
    first_keys = F.json_object_keys(F.get("items", F.lit(0)))
    shown = (lambda item: F.left(item, F.lit(item_chars))) if item_chars else (lambda item: item)
    taken = F.transform(sample_indices(n, k), lambda i: shown(F.get("items", i.cast("int"))))
    return rows.withColumn("kind", kind).select(
        "file_id", "parsed", "kind", F.when(F.col("kind") == "array", n.cast("bigint")).alias("length"),
        F.when(F.col("kind") == "array", _first(first_keys, max_keys)).alias("item_keys"),
        F.when(F.col("kind") == "object", _first(F.col("keys"), max_keys)).alias("keys"),
        F.when(F.col("kind") == "array", taken).alias("sample"),
        F.when(F.col("kind") != "array", F.left("text", F.lit(max_chars))).alias("head"),
        F.when(F.col("kind") == "array", n > k).otherwise(F.col("kind") == "invalid").alias("sampled"))


def xml_profile(files: DataFrame, max_chars: int = fx.FILE_MAX_CHARS, max_tags: int | None = None) -> DataFrame:
    """Root tag, node count and count per tag in the order they are first seen.

    Tags are counted from exploded rows; a file adds one partial count per tag
    and task, and its tags, not its nodes, are put together again.
    """
    body = F.regexp_replace("text", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[?!][^>]*>", "")
    names = text.extract_all(body, r"<(?:[A-Za-z_][^\s<>/:]*:)?([\p{L}_][^\s<>/:]*)")
    tags = files.select("file_id", F.posexplode(names).alias("pos", "tag"))
    per_tag = tags.groupBy("file_id", "tag").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    listed = F.array_sort(F.collect_list(F.struct("first", "tag", "n")))
    whole = per_tag.groupBy("file_id").agg(F.sum("n").alias("nodes"), listed.alias("tags"))
    heads = files.select("file_id", F.left("text", F.lit(max_chars)).alias("head"))
    first30 = F.transform(_first(F.col("tags"), max_tags), lambda t: F.struct(t["tag"].alias("tag"), t["n"].alias("n")))
    return heads.join(by_shuffle(whole), "file_id", "left").select(
        "file_id", F.get("tags", F.lit(0))["tag"].alias("root"), F.coalesce("nodes", F.lit(0)).alias("nodes"),
        first30.alias("tags"), (F.coalesce("nodes", F.lit(0)) > fx.SAMPLED_NODES).alias("sampled"), "head")


def size_guard(kb: Column, pages: Column, fmt: Column, sampled: Column, truncated: Column,
               max_kb: int = fx.FILE_MAX_KB, kb_per_page: int = fx.PDF_KB_PER_PAGE) -> Column:
    """``structural`` for a large, sampled or cut file, else ``full``; a pdf counts by pages."""
    by_pages = F.when(fmt == "pdf", F.coalesce(pages, F.lit(0)) * kb_per_page).otherwise(0)
    return F.when((F.greatest(kb, by_pages) > max_kb) | sampled | truncated, "structural").otherwise("full")


def text_report(files: DataFrame, max_chars: int = fx.FILE_MAX_CHARS) -> DataFrame:
    """Text of plain files by head and tail, with the size guard's verdict."""
    long_ = F.char_length("text") > max_chars
    body = text.strip(text.head_and_tail(F.col("text"), max_chars))
    kb = F.rint(F.octet_length("text") / F.lit(1024.0)).cast("bigint")
    mode = size_guard(kb, F.lit(None).cast("bigint"), F.lit("txt"), long_, F.char_length(body) > max_chars)
    return files.select("file_id", F.char_length("text").cast("bigint").alias("chars"), kb.alias("kb"),
                        F.left(body, F.lit(max_chars)).alias("text"), long_.alias("sampled"), mode.alias("mode"))

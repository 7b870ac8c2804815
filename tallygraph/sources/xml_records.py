"""Record-oriented XML: records are the children of Body (or of the root).

Tags come from texts that are rows (``xml_tags``) or from files of any size that many
tasks read (``read_tags``).  Depth and record numbers are running sums over tag positions,
taken block by block, so one large file is not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions import text
from tallygraph.operators.chains import reached
from tallygraph.operators.positions import dense_index, running_total
from tallygraph.session import by_shuffle, materialize

# CDATA first and kept, so that marks inside it stay; the rest is no content
_NOISE = r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->|<\?.*?\?>|<!DOCTYPE[^>]*>"
_TAG = r"""<(?:[^>"']++|"[^"]*+"|'[^']*+')++>"""      # a quoted value may hold a closing bracket
_TEXT = r"(?:[^<]++|<!\[CDATA\[(?s:.*?)\]\]>)*+"
_CHAR_REF = r"&#(x[0-9A-Fa-f]{1,6}|[0-9]{1,7});"


def _named(raw: Column) -> Column:
    """Named entities, the ampersand last, so that nothing is decoded twice."""
    for name, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]:
        raw = F.replace(raw, F.lit(name), F.lit(char))
    return raw


def _referred(ref: Column) -> Column:
    """The character of a numeric reference; a number that is no character stays as written."""
    code = F.when(ref.startswith("x"), F.conv(F.substr(ref, F.lit(2)), 16, 10)).otherwise(ref).cast("int")
    real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(real, char).otherwise(F.concat(F.lit("&#"), ref, F.lit(";")))


def _decoded(raw: Column) -> Column:
    between = F.transform(F.split(raw, _CHAR_REF), _named)
    chars = F.transform(text.extract_all(raw, _CHAR_REF, 1), _referred)
    joined = F.array_join(F.zip_with(between, chars, lambda t, c: F.concat(t, F.coalesce(c, F.lit("")))), "")
    return F.when(raw.contains("&#"), joined).otherwise(_named(raw))


def _plain_text(raw: Column) -> Column:
    """Text with references decoded; what stands in a CDATA section stays as it is."""
    def piece(part: Column, i: Column) -> Column:
        rest = _decoded(F.regexp_replace(part, r"(?s)^.*?\]\]>", ""))
        return F.when(i == 0, _decoded(part)).otherwise(F.concat(F.substring_index(part, "]]>", 1), rest))

    sections = F.array_join(F.transform(F.split(raw, r"<!\[CDATA\["), piece), "")
    return F.when(raw.contains("<![CDATA["), sections).otherwise(_decoded(raw))


def _without_noise(raw: Column) -> Column:
    return F.regexp_replace(raw, _NOISE, "$1")


def _tag_columns(token: Column) -> list[Column]:
    """(tag, opens, closes, text) of a tag with the text after it."""
    name = F.regexp_replace(F.regexp_extract(token, r"^</?([^\s/>]+)", 1), "^.*[}:]", "")
    is_close = token.startswith("</")
    is_empty = F.regexp_extract(token, f"^({_TAG})", 1).endswith("/>")
    return [name.alias("tag"), (~is_close).alias("opens"), (is_close | is_empty).alias("closes"),
            _plain_text(F.regexp_extract(token, f"(?s)^{_TAG}(.*)", 1)).alias("text")]


def xml_tags(files: DataFrame) -> DataFrame:
    """(file_id, pos, tag, opens, closes, text): every tag of a file with the text after it."""
    body = _without_noise(F.col("text"))
    return (files.select("file_id", F.posexplode(text.extract_all(body, _TAG + _TEXT, 0)).alias("pos", "token"))
            .select("file_id", F.col("pos").cast("bigint").alias("pos"), *_tag_columns(F.col("token"))))


# What begins after "<" without being a tag, and what ends it.
_REGIONS = {"comment": ("!--", "-->"), "cdata": ("![CDATA[", "]]>"), "instruction": ("?", "?>")}


def read_tags(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The columns of ``xml_tags`` for files under a path; ``file_id`` is the file's path.

    Files are read in splits, cut at every ``<``; a row's place in its file follows from the
    split's start and its number in the split.  Until the end a file is known by a number, the
    first ``seen`` in it, as a path in each row would be most of what is moved.  A cut inside a comment, CDATA section or
    instruction is found from the few rows that hold such marks and undone, so a row ends
    up as one tag with its text, whatever that text holds.
    """
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = spark.read.option("lineSep", "<").option("encoding", encoding).text(path)
    read = materialize(lines.select(split.alias("split"), F.monotonically_increasing_id().alias("seen"), "value"))
    whole = Window.partitionBy("split.file")
    before = whole.orderBy("split.start").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(read.groupBy("split").agg(F.min("seen").alias("first"), F.count(F.lit(1)).alias("n"))
                         .select("split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                                 F.min("first").over(whole).alias("file_id")))
    placed = read.join(splits, "split").select("file_id", (F.col("before") + F.col("seen") - F.col("first")).alias("pos"), "value")
    tokens = placed.filter("pos > 0")           # the first is what stands before the first "<"
    inside = _inside_regions(tokens)
    marked = tokens.join(by_shuffle(inside.withColumn("inside", F.lit(True))), ["file_id", "pos"], "left")
    no_tag = F.col("inside").isNotNull() | F.col("value").startswith("!") | F.col("value").startswith("?")
    tails = _tails(marked.filter(no_tag).select("file_id", "pos", "value"))
    token = F.concat(F.lit("<"), F.col("value"), F.coalesce(_without_noise(F.col("tail")), F.lit("")))
    names = splits.select("file_id", F.col("split.file").alias("path")).distinct()
    return (marked.filter(~no_tag).join(by_shuffle(tails), ["file_id", "pos"], "left").join(names, "file_id")
            .select(F.col("path").alias("file_id"), "pos", *_tag_columns(token)))


def _inside_regions(tokens: DataFrame) -> DataFrame:
    """(file_id, pos): rows that lie in a comment, CDATA section or instruction begun in an earlier row.

    A mark inside a region opens nothing: the regions that count are those that a reader
    meets who goes on behind the end of each.
    """
    value, kinds = F.col("value"), []
    for kind, (mark, end) in _REGIONS.items():
        opens = value.startswith(mark) & ~F.substring(value, len(mark) + 1, 2 ** 31 - 1).contains(end)
        kinds.append(F.struct(F.lit(kind).alias("kind"), opens.alias("opens"), value.contains(end).alias("ends")))
    marks = materialize(tokens.select("file_id", "pos", F.inline(F.array(*kinds))).filter("opens or ends"))
    # the n-th end of a kind, and how many ends stand up to each opening
    counted = running_total(marks, ["file_id", "kind"], "pos", F.col("ends").cast("bigint"), "n")
    ends = counted.filter("ends").select("file_id", "kind", "n", F.col("pos").alias("last"))
    opened = counted.filter("opens").select("file_id", "kind", (F.col("n") + 1).alias("n"), "pos")
    regions = opened.join(by_shuffle(ends), ["file_id", "kind", "n"]).select("file_id", "pos", "last")
    # the first opening behind each region's end
    at = running_total(marks.groupBy("file_id", "pos").agg(F.max(F.col("opens").cast("bigint")).alias("opens")),
                       ["file_id"], "pos", F.col("opens"), "number")
    starts = at.filter("opens = 1").select("file_id", "number", F.col("pos").alias("next"))
    own = at.select("file_id", "pos", F.col("number").alias("place"))
    behind = at.select("file_id", F.col("pos").alias("last"), (F.col("number") + 1).alias("number"))
    steps = regions.join(by_shuffle(own), ["file_id", "pos"]).join(by_shuffle(behind), ["file_id", "last"]) \
        .join(by_shuffle(starts), ["file_id", "number"], "left")
    met = reached(steps, ["file_id"], "pos", "next", "place", "number")
    return regions.join(by_shuffle(met), ["file_id", "pos"]).select(
        "file_id", F.explode(F.sequence(F.col("pos") + 1, F.col("last"))).alias("pos"))


def _tails(rows: DataFrame) -> DataFrame:
    """(file_id, pos, tail): rows that are no tags, put together for the tag before each run of them."""
    ranked = dense_index(rows, ["file_id"], "pos", "i").withColumn("run", F.col("pos") - F.col("i"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "value")))
    runs = ranked.groupBy("file_id", "run").agg(parts.alias("parts"))
    return runs.select("file_id", (F.get("parts", F.lit(0))["pos"] - 1).alias("pos"),
                       F.concat(F.lit("<"), F.array_join(F.transform("parts", lambda x: x["value"]), "<")).alias("tail"))


def xml_leaves(files: DataFrame) -> DataFrame:
    return tag_leaves(xml_tags(files))


def tag_leaves(tags: DataFrame) -> DataFrame:
    """(file_id, record_no, leaf_no, is_record, leaf, text): every element of every record, in order.

    The record element itself is its first leaf.  The tag table and the result
    are written out: the texts are cut once, and what follows reads the leaves.
    """
    tags = materialize(tags)
    step = F.col("opens").cast("bigint") - F.col("closes").cast("bigint")
    deep = running_total(tags, ["file_id"], "pos", step, "depth_after")
    depth = F.when(F.col("opens") & ~F.col("closes"), F.col("depth_after")) \
        .when(F.col("opens"), F.col("depth_after") + 1)
    opened = deep.withColumn("depth", depth).filter("opens")
    body = opened.filter(F.col("tag") == "Body").groupBy("file_id").agg(
        F.min_by(F.struct("pos", "depth"), "pos").alias("body"))
    framed = opened.join(body, "file_id", "left") \
        .withColumn("record_depth", F.coalesce(F.col("body.depth"), F.lit(1)) + 1) \
        .filter(F.col("pos") > F.coalesce(F.col("body.pos"), F.lit(0))) \
        .filter(F.col("depth") >= F.col("record_depth"))
    starts = (F.col("depth") == F.col("record_depth")).cast("bigint")
    numbered = running_total(framed, ["file_id"], "pos", starts, "record_no")
    return materialize(numbered.select(
        "file_id", (F.col("record_no") - 1).alias("record_no"), F.col("pos").alias("leaf_no"),
        (starts == 1).alias("is_record"), F.col("tag").alias("leaf"), "text"))


def with_record_tag(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (file_id, record_no, tag, group_no, index, ref) and leaves with the record tag.

    ``ref`` is ``e{group}_{index}``: groups stand in the order of their first record.
    """
    records = leaves.filter("is_record").select("file_id", "record_no", F.col("leaf").alias("tag"))
    groups = records.groupBy("file_id", "tag").agg(F.min("record_no").alias("first_record"))
    groups = dense_index(groups, ["file_id"], "first_record", "group_no")
    indexed = dense_index(records, ["file_id", "tag"], "record_no", "index")
    full = indexed.join(groups, ["file_id", "tag"]).select(
        "file_id", "record_no", "tag", "group_no", "index",
        F.concat(F.lit("e"), F.col("group_no").cast("string"), F.lit("_"), F.col("index").cast("string")).alias("ref"))
    return full, leaves.join(by_shuffle(full), ["file_id", "record_no"])


def type_fields(leaves: DataFrame) -> DataFrame:
    """(file_id, tag, leaf, item): value-bearing leaf tags of a record type, numbered as first seen."""
    valued = leaves.filter((text.strip(F.col("text")) != "") & (F.col("leaf") != F.col("tag"))
                           & (F.col("leaf") != fx.XML_REFERENCE))
    seen = valued.groupBy("file_id", "tag", "leaf").agg(F.min(F.struct("record_no", "leaf_no")).alias("first"))
    listed = seen.groupBy("file_id", "tag").agg(F.array_sort(F.collect_list(F.struct("first", "leaf"))).alias("l"))
    return listed.select("file_id", "tag", F.posexplode("l").alias("p", "f")).select(
        "file_id", "tag", F.col("f.leaf").alias("leaf"),
        F.concat(F.lit("item_"), (F.col("p") + 1).cast("string")).alias("item"))


def record_actors(records: DataFrame, leaves: DataFrame) -> DataFrame:
    """(file_id, ref, form_ref, title): first non-blank name of the record, else its ref."""
    named = leaves.filter((F.col("leaf") == fx.XML_TITLE) & (text.strip(F.col("text")) != "")) \
        .groupBy("file_id", "record_no").agg(F.min_by(text.strip(F.col("text")), "leaf_no").alias("name"))
    return records.join(named, ["file_id", "record_no"], "left").select(
        "file_id", "ref", F.col("tag").alias("form_ref"), F.coalesce("name", "ref").alias("title"))


def record_values(leaves: DataFrame) -> DataFrame:
    """(file_id, ref, tag, item, value): first value of each field of a record, long form."""
    first = leaves.filter(text.strip(F.col("text")) != "") \
        .groupBy("file_id", "ref", "tag", "leaf").agg(F.min_by(text.strip(F.col("text")), "leaf_no").alias("value"))
    return first.join(type_fields(leaves), ["file_id", "tag", "leaf"]).select("file_id", "ref", "tag", "item", "value")


def record_links(leaves: DataFrame) -> DataFrame:
    """(file_id, source_ref, target_ref, name): references to the first record that owns the guid.

    A record's own guid is its first reference; links to itself are left out.
    The owner map is written out, so that its join with all references starts
    from two plain shuffles and a guid that everybody names is split by
    adaptive skew handling.
    """
    refs = leaves.filter((F.col("leaf") == fx.XML_REFERENCE) & (F.col("text") != "")) \
        .withColumn("guid", text.strip(F.col("text")))
    own = refs.groupBy("file_id", "record_no", "ref", "group_no", "index") \
        .agg(F.min_by("guid", "leaf_no").alias("own_guid"))
    owners = own.filter(F.col("own_guid") != "").groupBy("file_id", F.col("own_guid").alias("guid")) \
        .agg(F.min_by("ref", F.struct("group_no", "index")).alias("target_ref"))
    name = F.when(F.col("tag").contains("."), F.regexp_replace("tag", r"^[^.]*\.", "")).otherwise(F.col("tag"))
    return (refs.join(own.select("file_id", "record_no", "own_guid"), ["file_id", "record_no"])
            .filter(F.col("guid") != F.col("own_guid")).join(materialize(owners), ["file_id", "guid"])
            .select("file_id", F.col("ref").alias("source_ref"), "target_ref", name.alias("name"), "leaf_no"))


def record_forms(leaves: DataFrame, records: DataFrame) -> DataFrame:
    """(file_id, ref, title, color, fields): one form per record type."""
    fields = type_fields(leaves).groupBy("file_id", "tag").agg(
        F.array_sort(F.collect_list(F.struct(
            F.regexp_extract("item", "([0-9]+)", 1).cast("int").alias("n"), F.col("item").alias("id"),
            F.col("leaf").alias("title")))).alias("f"))
    title = F.regexp_replace(F.col("tag"), r"^[^.]*\.", "")
    return records.select("file_id", "tag", "group_no").distinct().join(fields, ["file_id", "tag"], "left").select(
        "file_id", F.col("tag").alias("ref"), title.alias("title"), F.lit(fx.XML_COLOR).alias("color"), "group_no",
        F.transform(F.coalesce("f", F.array()), lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title")))
        .alias("fields"))


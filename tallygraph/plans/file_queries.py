"""Queries over files: passports, text, csv, json and xml profiles, xml records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.numbers import sample_indices
from tallygraph.operators import inventory
from tallygraph.plans.registry import derived, query, table, texts_of
from tallygraph.session import work_dir
from tallygraph.sources import catalog, files, xml_records

EXTENSIONS = "array('txt', 'csv', 'xml', 'cfe', 'json', 'docx', 'html', 'md')"
HEADS = "array('<?xml ', '1CDBMSV8', '1CIBDmpF', 'PK\x03\x04', '%PDF-', '  {', '[', '<p>', '', '')"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "documents", "doc_id as file_id",
                   f"concat('https://files.example.com/d/f', cast(doc_id as string), '.', element_at({EXTENSIONS}, cast(doc_id % 8 + 1 as int)), '?v=1') as source",
                   f"concat('/d/f', cast(doc_id as string), '.', element_at({EXTENSIONS}, cast(doc_id % 8 + 1 as int))) as path",
                   f"encode(concat(element_at({HEADS}, cast(doc_id % 10 + 1 as int)), text), 'utf-8') as content")


SQL_FILES = """f AS (SELECT doc_id, doc_id % 8 AS e, doc_id % 10 AS h, text,
  CASE doc_id % 10 WHEN 0 THEN '<?xml ' WHEN 1 THEN '1CDBMSV8' WHEN 2 THEN '1CIBDmpF' WHEN 3 THEN 'PK' || chr(3) || chr(4) WHEN 4 THEN '%PDF-' WHEN 5 THEN '  {' WHEN 6 THEN '[' WHEN 7 THEN '<p>' ELSE '' END || text AS body,
  list_extract(['txt', 'csv', 'xml', 'cfe', 'json', 'docx', 'html', 'md'], (doc_id % 8 + 1)::INT) AS ext FROM documents)"""


@query("file_passport", f"""WITH {SQL_FILES} SELECT 'f' || doc_id || '.' || ext AS file_name, octet_length(encode(body)) AS bytes, round_even(octet_length(encode(body)) / 1024.0, 0)::BIGINT AS kb,
  sha256(body) AS sha256, left(sha256(body), 16) AS sha16, CASE ext WHEN 'csv' THEN 'text/csv' WHEN 'xml' THEN 'text/xml' ELSE 'application/octet-stream' END AS mime,
  CASE WHEN h = 0 OR ext = 'xml' THEN 'xml' WHEN h = 1 THEN '1cd' WHEN h = 2 THEN 'dt' WHEN h = 3 THEN 'zip' WHEN ext = 'cfe' THEN 'cf' WHEN ext = 'csv' THEN 'csv' ELSE 'unknown' END AS format,
  CASE WHEN h = 3 THEN ext WHEN h = 4 THEN 'pdf' WHEN h IN (5, 6) THEN 'json' WHEN h IN (0, 7) AND ext <> 'html' THEN 'xml' ELSE ext END AS document_format,
  'files.example.com' AS host FROM f""")
def file_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.passports(_documents(spark, sf_dir), F.col("source"))


@query("base64_payload", """SELECT doc_id, octet_length(encode(text)) AS bytes, sha256(text) AS sha FROM documents""")
def base64_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived(spark, sf_dir, "documents", "doc_id", "regexp_replace(base64(encode(text, 'utf-8')), '=+$', '') as b")
    parts = F.array(F.concat(F.lit("data:text/plain;base64,"), F.substring("b", 1, 40)), F.lit(" \n"),
                    F.expr("substring(b, 41)"))
    payload = files.decode_payload(parts)
    return raw.select("doc_id", payload.alias("p")).select(
        "doc_id", F.octet_length("p").cast("bigint").alias("bytes"), F.sha2("p", 256).alias("sha"))


@query("text_head_tail", f"""SELECT doc_id AS file_id, length(text) AS chars, md5(CASE WHEN length(text) <= 2000 THEN text
  ELSE left(text, 1200) || '{fx.TEXT_GAP}' || right(text, 700) END) AS md5 FROM documents""")
def text_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallygraph.functions.text import head_and_tail
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), F.char_length("text").cast("bigint").alias("chars"),
        F.md5(head_and_tail(F.col("text"), 2000)).alias("md5"))


@query("size_guard", """SELECT doc_id, CASE WHEN greatest(octet_length(encode(text)) // 1024, CASE WHEN doc_id % 3 = 0 THEN doc_id % 50 * 80 ELSE 0 END) > 2000
  OR length(text) > 16000 THEN 'structural' ELSE 'full' END AS mode FROM documents""")
def size_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kb = F.floor(F.octet_length("text") / 1024)
    fmt = F.when(F.col("doc_id") % 3 == 0, "pdf").otherwise("txt")
    return docs.select("doc_id", files.size_guard(kb, F.col("doc_id") % 50, fmt, F.lit(False), F.char_length("text") > fx.FILE_MAX_CHARS,
                                                  max_kb=2000).alias("mode"))


SQL_CSV = r"""l AS (SELECT doc_id, list_filter(string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]'), lambda x: regexp_matches(x, '[^\s\x0b\x1c-\x1f\x85\p{Z}]')) AS r, r[1] AS probe FROM documents),
  c AS (SELECT *, CASE WHEN contains(probe, chr(9)) THEN chr(9) WHEN contains(probe, ';') THEN ';' WHEN contains(probe, ',') THEN ',' WHEN contains(probe, '|') THEN '|' ELSE ',' END AS d FROM l)"""


@query("csv_profile", f"""WITH {SQL_CSV} SELECT doc_id AS file_id, CASE WHEN d = chr(9) THEN '\\t' ELSE d END AS delimiter, md5(r[1]) AS header, greatest(len(r) - 1, 0) AS rows,
  len(string_split(r[1], d)) AS columns, least(greatest(len(r) - 1, 0), 60) AS sample, len(r) - 1 > 60 AS sampled FROM c""")
def csv_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), "text")
    return files.csv_profile(docs).select(
        "file_id", "delimiter", F.md5("header").alias("header"), "rows", F.size("columns").alias("columns"),
        F.size("sample").alias("sample"), "sampled")


JSON_TEXT = ("case event_id % 4 when 0 then props when 1 then concat('[', array_join(transform(sequence(0, cast(event_id % 15 as int)), i -> "
             "concat('{\"k\":', cast(i as string), ',\"t\":\"', event_type, '\"}')), ','), ']') when 2 then '{broken' else cast(event_id as string) end")


@query("json_profile", """SELECT event_id AS file_id, event_id % 4 <> 2 AS parsed, CASE event_id % 4 WHEN 0 THEN 'object' WHEN 1 THEN 'array' WHEN 2 THEN 'invalid' ELSE 'scalar' END AS kind,
  CASE WHEN event_id % 4 = 1 THEN event_id % 15 + 1 END AS length, CASE event_id % 4 WHEN 0 THEN 'k' WHEN 1 THEN 'k,t' END AS keys,
  CASE WHEN event_id % 4 = 1 THEN '{"k":' || (event_id % 15) || ',"t":"' || event_type || '"}' END AS last_item,
  CASE WHEN event_id % 4 = 1 THEN least(event_id % 15 + 1, 10) END AS items,
  CASE event_id % 4 WHEN 1 THEN event_id % 15 + 1 > 10 WHEN 2 THEN true ELSE false END AS sampled FROM events""")
def json_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.json_profile(derived(spark, sf_dir, "events", "event_id as file_id", f"{JSON_TEXT} as text"))
    return found.select("file_id", "parsed", "kind", "length", F.array_join(F.coalesce("item_keys", "keys"), ",").alias("keys"),
                        F.get("sample", F.size("sample") - 1).alias("last_item"),
                        F.when(F.col("kind") == "array", F.size("sample")).alias("items"), "sampled")


# --------------------------------------------------------------- xml
XML_FILE = """concat('<?xml version="1.0"?><!-- <x/> --><m:Message xmlns:m="urn:x"><Header><Ссылка>h</Ссылка></Header><Body>',
  '<Справочник.Товары><Ссылка>g', cast(p_partkey as string), '</Ссылка><Наименование>', case when p_partkey % 3 = 0 then ' ' else p_name end, '</Наименование><Код a="1"> ', p_brand, ' </Код></Справочник.Товары>',
  '<m:Документ.Заказ><Ссылка>d', cast(p_partkey as string), '</Ссылка><Номер>', cast(p_size as string), '</Номер><Товар><Ссылка>g', cast(p_partkey as string), '</Ссылка></Товар><Пусто/></m:Документ.Заказ>',
  '<Справочник.Товары><Ссылка>h', cast(p_partkey as string), '</Ссылка><Вид>', p_type, ' &amp; co<![CDATA[ <!-- <b> --> <?x?> ]]></Вид><Товар><Ссылка>missing</Ссылка><Ссылка>d', cast(p_partkey as string), '</Ссылка></Товар></Справочник.Товары>',
  '</Body></m:Message>')"""


def _xml(spark: SparkSession, sf_dir: str):
    raw = texts_of(spark, sf_dir, "part", "p_partkey as file_id", f"{XML_FILE} as text")
    return xml_records.with_record_tag(xml_records.xml_leaves(raw))


@query("xml_leaves", """SELECT p_partkey AS file_id, unnest([
    {'ref': 'e0_0', 'leaf': 'Справочник.Товары', 'text': ''}, {'ref': 'e0_0', 'leaf': 'Ссылка', 'text': 'g' || p_partkey}, {'ref': 'e0_0', 'leaf': 'Наименование', 'text': CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END},
    {'ref': 'e0_0', 'leaf': 'Код', 'text': p_brand}, {'ref': 'e1_0', 'leaf': 'Документ.Заказ', 'text': ''}, {'ref': 'e1_0', 'leaf': 'Ссылка', 'text': 'd' || p_partkey}, {'ref': 'e1_0', 'leaf': 'Номер', 'text': p_size::VARCHAR},
    {'ref': 'e1_0', 'leaf': 'Товар', 'text': ''}, {'ref': 'e1_0', 'leaf': 'Ссылка', 'text': 'g' || p_partkey}, {'ref': 'e1_0', 'leaf': 'Пусто', 'text': ''}, {'ref': 'e0_1', 'leaf': 'Справочник.Товары', 'text': ''},
    {'ref': 'e0_1', 'leaf': 'Ссылка', 'text': 'h' || p_partkey}, {'ref': 'e0_1', 'leaf': 'Вид', 'text': p_type || ' & co <!-- <b> --> <?x?>'}, {'ref': 'e0_1', 'leaf': 'Товар', 'text': ''}, {'ref': 'e0_1', 'leaf': 'Ссылка', 'text': 'missing'},
    {'ref': 'e0_1', 'leaf': 'Ссылка', 'text': 'd' || p_partkey}], recursive := true) FROM part""")
def xml_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _xml(spark, sf_dir)[1].select("file_id", "ref", "leaf", F.trim("text").alias("text"))


@query("xml_actors", """SELECT p_partkey AS file_id, unnest([{'ref': 'e0_0', 'form_ref': 'Справочник.Товары', 'title': CASE WHEN p_partkey % 3 = 0 THEN 'e0_0' ELSE p_name END},
    {'ref': 'e1_0', 'form_ref': 'Документ.Заказ', 'title': 'e1_0'}, {'ref': 'e0_1', 'form_ref': 'Справочник.Товары', 'title': 'e0_1'}], recursive := true) FROM part""")
def xml_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml_records.record_actors(*_xml(spark, sf_dir))


@query("xml_values", """SELECT * FROM (SELECT p_partkey AS file_id, unnest([{'ref': 'e0_0', 'item': CASE WHEN p_partkey % 3 = 0 THEN 'item_9' ELSE 'item_1' END, 'value': CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END},
    {'ref': 'e0_0', 'item': CASE WHEN p_partkey % 3 = 0 THEN 'item_1' ELSE 'item_2' END, 'value': p_brand}, {'ref': 'e1_0', 'item': 'item_1', 'value': p_size::VARCHAR},
    {'ref': 'e0_1', 'item': CASE WHEN p_partkey % 3 = 0 THEN 'item_2' ELSE 'item_3' END, 'value': p_type || ' & co <!-- <b> --> <?x?>'}], recursive := true) FROM part) WHERE value <> ''""")
def xml_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml_records.record_values(_xml(spark, sf_dir)[1]).select("file_id", "ref", "item", "value")


@query("xml_links", """SELECT p_partkey AS file_id, 'e1_0' AS source_ref, 'e0_0' AS target_ref, 'Заказ' AS name FROM part UNION ALL
  SELECT p_partkey, 'e0_1', 'e1_0', 'Товары' FROM part""")
def xml_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml_records.record_links(_xml(spark, sf_dir)[1]).drop("leaf_no")


@query("xml_forms", """SELECT p_partkey AS file_id, 'Справочник.Товары' AS ref, 'Товары' AS title, CASE WHEN p_partkey % 3 = 0 THEN 'Код,Вид' ELSE 'Наименование,Код,Вид' END AS fields FROM part UNION ALL
  SELECT p_partkey, 'Документ.Заказ', 'Заказ', 'Номер' FROM part""")
def xml_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, leaves = _xml(spark, sf_dir)
    return xml_records.record_forms(leaves, records).select(
        "file_id", "ref", "title", F.array_join(F.transform("fields", lambda f: f["title"]), ",").alias("fields"))


@query("xml_inventory", """SELECT p_partkey AS file_id, 2 AS entities, 3 AS records, CASE WHEN p_partkey % 3 = 0 THEN 3 ELSE 4 END AS fields, 6 AS links FROM part""")
def xml_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, leaves = _xml(spark, sf_dir)
    return inventory.xml_totals(inventory.xml_entities(leaves, records))


EXPORTS = 16            # files an export is written to; each grows with the tables
EXPORT_LINE = """concat(case when p_partkey % 5 = 0 then '<!-- <Документ.Заказ> <![CDATA[ -->' else '' end,
  '<Справочник.Товары><Ссылка>g', cast(p_partkey as string), '</Ссылка><Наименование><![CDATA[', p_name, ' <!-- <', p_brand, '> -->]]></Наименование><Код a="x>y"> ', p_brand, ' &amp; <?go <x/>?>co</Код></Справочник.Товары>',
  '<Документ.Заказ><Ссылка>d', cast(p_partkey as string), '</Ссылка><Товар><Ссылка>g', cast(p_partkey - p_partkey % 16 + (p_partkey + 5) % 16 as string), '</Ссылка></Товар></Документ.Заказ>')"""


def xml_exports(spark: SparkSession, sf_dir: str) -> str:
    """Parts as a few large XML files, each with a head, a line per part and an end; returns their folder."""
    lines = derived(spark, sf_dir, "part", f"cast(p_partkey % {EXPORTS} as int) as file", "p_partkey as at", f"{EXPORT_LINE} as line")
    ends = spark.range(EXPORTS).select(F.col("id").cast("int").alias("file"), F.explode(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("at"), F.lit('<?xml version="1.0"?><m:Message xmlns:m="urn:x"><Header/><Body>').alias("line")),
        F.struct(F.lit(2 ** 62).alias("at"), F.lit("</Body></m:Message>").alias("line")))).alias("e")).select("file", "e.*")
    path = work_dir(spark, "exports")
    (lines.select("file", F.col("at").cast("bigint").alias("at"), "line").unionByName(ends).repartitionById(EXPORTS, "file")
     .sortWithinPartitions("file", "at").select("line").write.text(path))
    return path


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml_records.tag_leaves(xml_records.read_tags(spark, xml_exports(spark, sf_dir)))


def _export_number(file: str) -> Column:
    return F.regexp_extract(F.col(file), "part-0*([0-9]+)-", 1).cast("int")


SQL_EXPORTS = """x AS (SELECT p_partkey % 16 AS file, 2 * (row_number() OVER (PARTITION BY p_partkey % 16 ORDER BY p_partkey) - 1) AS no, * FROM part)"""


@query("xml_large_files", f"""WITH {SQL_EXPORTS} SELECT file::INT AS file, no AS record_no, unnest([
    {{'leaf': 'Справочник.Товары', 'text': ''}}, {{'leaf': 'Ссылка', 'text': 'g' || p_partkey}}, {{'leaf': 'Наименование', 'text': p_name || ' <!-- <' || p_brand || '> -->'}},
    {{'leaf': 'Код', 'text': p_brand || ' & co'}}], recursive := true) FROM x
  UNION ALL SELECT file::INT, no + 1, unnest([{{'leaf': 'Документ.Заказ', 'text': ''}}, {{'leaf': 'Ссылка', 'text': 'd' || p_partkey}}, {{'leaf': 'Товар', 'text': ''}},
    {{'leaf': 'Ссылка', 'text': 'g' || (p_partkey - p_partkey % 16 + (p_partkey + 5) % 16)}}], recursive := true) FROM x""")
def xml_large_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir).select(_export_number("file_id").alias("file"), "record_no", "leaf", F.trim("text").alias("text"))


@query("xml_large_inventory", f"""WITH {SQL_EXPORTS} SELECT file::INT AS file, 2 AS entities, 2 * count(*) AS records, 2 AS fields, 3 * count(*) AS links FROM x GROUP BY file""")
def xml_large_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, leaves = xml_records.with_record_tag(_exported(spark, sf_dir))
    totals = inventory.xml_totals(inventory.xml_entities(leaves, records))
    return totals.withColumn("file", _export_number("file_id")).drop("file_id")


@query("xml_profile", """SELECT p_partkey AS file_id, 'Message' AS root, 20 AS nodes, 'Message:1,Header:1,Ссылка:7,Body:1,Справочник.Товары:2,Наименование:1,Код:1,Документ.Заказ:1,Номер:1,Товар:2,Пусто:1,Вид:1' AS tags FROM part""")
def xml_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.xml_profile(texts_of(spark, sf_dir, "part", "p_partkey as file_id", f"{XML_FILE} as text"))
    return found.select("file_id", "root", "nodes", F.array_join(
        F.transform("tags", lambda t: F.concat_ws(":", t["tag"], t["n"].cast("string"))), ",").alias("tags"))


# --------------------------------------------------------------- analysis and samples
@query("analyze_files", """SELECT p_partkey AS file_id, CASE p_partkey % 3 WHEN 0 THEN 'xml' WHEN 1 THEN 'dt' ELSE 'zip' END AS format, CASE p_partkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS entities,
  CASE p_partkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS records, CASE WHEN p_partkey % 3 = 0 THEN 3 ELSE 0 END AS fields, CASE WHEN p_partkey % 3 = 0 THEN 6 ELSE 0 END AS links,
  p_partkey % 3 < 2 AS has_data, CASE WHEN p_partkey % 3 = 2 THEN 'unsupported format: zip' ELSE '' END AS note FROM part""")
def analyze_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = (f"case p_partkey % 3 when 0 then {XML_FILE} when 1 then concat('1CIBDmpF Справочник.Люди ', 'Іваненко Петро Петрович ', p_name) "
            "else concat('PK\x03\x04', p_name) end")
    raw = texts_of(spark, sf_dir, "part", "p_partkey as file_id", "concat('/f', cast(p_partkey as string)) as path", f"{body} as text")
    listed = raw.select("file_id", "text", files.detect_format(F.col("path"), F.encode("text", "utf-8")).alias("format"))
    records, leaves = xml_records.with_record_tag(xml_records.xml_leaves(listed.filter("format = 'xml'").select("file_id", "text")))
    dumps = listed.filter(F.col("format").isin("dt", "cf"))
    people = dumps.select("file_id", "format", F.size(catalog.person_names(F.col("text"))).alias("names"))
    totals = [inventory.xml_totals(inventory.xml_entities(leaves, records)),
              inventory.container_totals(catalog.metadata_objects(dumps), people)]
    return inventory.analyze(listed.select("file_id", "format"), totals)


@query("sample_rows", """WITH d AS (SELECT doc_id, n_chars AS total FROM documents), h AS (SELECT doc_id, total, unnest(range(0, least(total, 10))) AS i FROM d)
  SELECT doc_id, string_agg(CASE WHEN total <= 10 THEN i WHEN i < 3 THEN i WHEN i < 7 THEN 3 + round_even((total - 6) / 5.0 * (i - 2), 0)::BIGINT ELSE total - 10 + i END, ',' ORDER BY i) AS picked
  FROM h GROUP BY doc_id""")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(sample_indices(F.col("n_chars"), 10).cast("array<string>"), ",").alias("picked"))

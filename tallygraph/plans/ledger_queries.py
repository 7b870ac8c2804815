"""Queries over the landed base: catalog, actors, links, ledger, plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions import keys
from tallygraph.operators import entities, inventory, ledger, links, plan, positions
from tallygraph.operators.bases import Bases
from tallygraph.operators.positions import dense_index, grid_place
from tallygraph.plans.registry import query, table
from tallygraph.plans.star import metadata_texts, star_base
from tallygraph.session import small_table
from tallygraph.sources import catalog
from tallygraph.sources.sinks import landed_ops

CAP = 40

# --------------------------------------------------------------- SQL of the landed base
SQL_QUANTITY = "CAST(CASE WHEN l_linenumber = 7 THEN 0.004 ELSE l_quantity + 0.125 END AS DECIMAL(18,4))"
SQL_REFS = """
c1 AS (SELECT *, md5('customer-' || c_custkey) AS id, 'c1-' || CASE WHEN c_custkey % 97 = 0
       THEN md5('customer-' || c_custkey) ELSE lpad(c_custkey::VARCHAR, 9, '0') END AS ref FROM customer),
c2 AS (SELECT *, md5('supplier-' || s_suppkey) AS id, 'c2-' || lpad(s_suppkey::VARCHAR, 9, '0') AS ref FROM supplier),
c3 AS (SELECT *, md5('part-' || p_partkey) AS id, 'c3-' || CASE WHEN p_partkey = 0
       THEN md5('part-0') ELSE p_partkey::VARCHAR END AS ref FROM part),
c4 AS (SELECT *, md5('nation-' || n_nationkey) AS id, 'c4-' || lpad(n_nationkey::VARCHAR, 3, '0') AS ref FROM nation),
c5 AS (SELECT *, md5('region-' || r_regionkey) AS id, 'c5-' || lpad(r_regionkey::VARCHAR, 3, '0') AS ref FROM region),
c6 AS (SELECT DISTINCT o_orderstatus, md5('currency-' || o_orderstatus) AS id, 'c6-' || o_orderstatus AS ref,
       CASE WHEN o_orderstatus = 'O' THEN 'Гривня' ELSE 'Dollar' END AS name FROM orders),
c7 AS (SELECT *, md5('staff-' || c_custkey) AS id, 'c7-' || lpad(c_custkey::VARCHAR, 9, '0') AS ref
       FROM customer WHERE c_mktsegment = 'BUILDING'),
d1 AS (SELECT *, md5('order-' || o_orderkey) AS id, 'd1-' || o_orderkey AS ref FROM orders)
"""
SQL_REGISTER = f"""
mv AS (SELECT l.*, l_orderkey * 8 + l_linenumber AS pos, c2.ref AS actor, l_returnflag = 'R' AS expense
       FROM lineitem l JOIN c2 ON s_suppkey = l_suppkey),
cells AS (SELECT pos, actor, expense, 'Стоимость' AS account, CAST(l_extendedprice AS DECIMAL(18,2)) AS value,
            CASE WHEN l_returnflag = 'N' THEN 'Деньги' WHEN l_linestatus = 'O' THEN 'Гривня' ELSE 'Dollar' END AS currency
          FROM mv UNION ALL
          SELECT pos, actor, expense, 'Количество', {SQL_QUANTITY}, 'Единицы' FROM mv),
reg AS (SELECT 'p-' || left(sha256('reg1|' || actor || '|' || account || '|' || pos || '|' || abs(value)::DOUBLE), 26) AS ref,
          currency, account AS account_name, CASE WHEN expense THEN actor ELSE 'ctr1' END AS debit_ref,
          CASE WHEN expense THEN 'ctr1' ELSE actor END AS credit_ref, abs(value) AS amount
        FROM cells WHERE value <> 0)
"""
SQL_LINES = f"""
ln AS (SELECT d1.ref AS doc, l_linenumber::VARCHAR AS lineno, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         {SQL_QUANTITY} AS quantity, coalesce(c3.ref, c2.ref) AS target,
         CASE WHEN c3.ref IS NOT NULL THEN 'Номенклатура' WHEN c2.ref IS NOT NULL THEN 'Поставщик' END AS target_name,
         l_orderkey * 8 + l_linenumber AS pos
       FROM lineitem JOIN d1 ON o_orderkey = l_orderkey LEFT JOIN c3 ON p_partkey = l_partkey
       LEFT JOIN c2 ON s_suppkey = l_suppkey),
doc AS (SELECT 'p-' || left(sha256(doc || '|Сума|' || lineno || '|' || abs(amount)::DOUBLE), 26) AS ref, 'Деньги' AS currency,
          'Сума' AS account_name, 'ctrdoc' AS debit_ref, doc AS credit_ref, abs(amount) AS amount
        FROM ln WHERE amount <> 0 UNION ALL
        SELECT 'p-' || left(sha256(doc || '|Залишок|' || target || '|' || lineno || '|' || abs(quantity)::DOUBLE), 26),
          'Единицы', 'Залишок', 'ctrdoc', target, abs(quantity) FROM ln WHERE quantity <> 0 AND target IS NOT NULL)
"""
SQL_TRANSFERS = f"WITH {SQL_REFS}, {SQL_REGISTER}, {SQL_LINES}, tr AS (SELECT * FROM reg UNION ALL SELECT * FROM doc)"
SQL_LEGS = SQL_TRANSFERS + """, legs AS (
  SELECT ref, debit_ref AS actor_ref, account_name, currency, 'from' AS side, amount FROM tr UNION ALL
  SELECT ref, credit_ref, account_name, currency, 'to', amount FROM tr)"""
SQL_ACTORS = f"""WITH {SQL_REFS}, actors AS (
  SELECT 'counterparties' AS cls, 'tmpl_ref1' AS form_ref, c_custkey AS pos, ref, c_name AS title FROM c1 UNION ALL
  SELECT 'counterparties', 'tmpl_ref2', s_suppkey, ref, s_name FROM c2 UNION ALL
  SELECT 'nomenclature', 'tmpl_ref3', p_partkey, ref, CASE WHEN p_partkey % 89 = 0 THEN ref ELSE p_name END FROM c3 UNION ALL
  SELECT 'catalogs', 'tmpl_ref4', n_nationkey, ref, n_name FROM c4 UNION ALL
  SELECT 'organizations', 'tmpl_ref5', r_regionkey, ref, r_name FROM c5 UNION ALL
  SELECT 'currencies', 'tmpl_ref6', ascii(o_orderstatus), ref, name FROM c6 UNION ALL
  SELECT 'employees', 'tmpl_ref7', c_custkey, ref, c_name FROM c7 UNION ALL
  SELECT 'documents', 'tmpl_doc1', o_orderkey, ref, o_orderkey || ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM d1 UNION ALL
  SELECT 'registers', 'tmpl_info1', event_id, 'i1-r' || event_id, 'i1-r' || event_id FROM events)"""
SQL_LINKS = """
links AS (
  SELECT c1.ref AS source_ref, c4.ref AS target_ref, 'Страна' AS name FROM c1 JOIN c4 ON n_nationkey = c_nationkey UNION ALL
  SELECT c2.ref, c4.ref, 'Страна' FROM c2 JOIN c4 ON n_nationkey = s_nationkey UNION ALL
  SELECT c4.ref, c5.ref, 'Родитель' FROM c4 JOIN c5 ON r_regionkey = n_regionkey UNION ALL
  SELECT d1.ref, c1.ref, 'Контрагент' FROM d1 JOIN c1 ON c_custkey = o_custkey)
"""


# --------------------------------------------------------------- catalog
@query("canon_classes", f"""
WITH t AS (SELECT p_partkey % 4 AS k, CASE p_partkey % 12 {' '.join(
    f"WHEN {i} THEN '{w}'" for i, w in enumerate(
        ['Список сотрудников', 'Должности', 'Клиенты', 'Товары', 'Склады', 'Организации', 'Валюты',
         'Единиц измерения', 'План счетов', 'Chart of Accounts', 'Прочее', 'Поставщики']))} END || ' ' || p_type AS title FROM part),
n AS (SELECT CASE k WHEN 0 THEN 'doc' WHEN 1 THEN 'info' ELSE 'ref' END AS kind, title, lower(title) AS low FROM t)
SELECT kind, title, CASE WHEN kind = 'doc' THEN 'documents' WHEN kind = 'info' THEN 'registers' {' '.join(
    f"WHEN regexp_matches(low, '{'|'.join(words).replace('.', chr(92) + '.')}') THEN '{cls}'"
    for cls, words in fx.CLASS_KEYWORDS)} ELSE 'catalogs' END AS cls, count(*) AS n
FROM n GROUP BY ALL""")
def canon_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = ["Список сотрудников", "Должности", "Клиенты", "Товары", "Склады", "Организации", "Валюты",
              "Единиц измерения", "План счетов", "Chart of Accounts", "Прочее", "Поставщики"]
    named = table(spark, sf_dir, "part").select(
        F.element_at(F.array(F.lit("doc"), F.lit("info"), F.lit("ref"), F.lit("ref")),
                     (F.col("p_partkey") % 4 + 1).cast("int")).alias("kind"),
        F.concat_ws(" ", F.element_at(F.array(*[F.lit(t) for t in titles]),
                                      (F.col("p_partkey") % 12 + 1).cast("int")), "p_type").alias("title"))
    return named.withColumn("cls", keys.canon_class(F.col("kind"), F.col("title"))) \
        .groupBy("kind", "title", "cls").agg(F.count(F.lit(1)).alias("n"))


def _catalog_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog text per customer: three entries whose type and number follow the key."""
    entry = ("concat('{{', lpad(cast(c_custkey as string), 8, '0'), '-0000-4000-8000-00000000000{0}', ',\"', "
             "case (c_custkey + {0}) % 7 when 0 then 'Reference' when 1 then 'Document' when 2 then 'Enum' "
             "when 3 then 'AccumRg' when 4 then 'InfoRg' when 5 then 'Fld' else 'AccumRgOpt' end, '\",', "
             "cast(c_custkey % 50 + {0} as string), '}}')")
    text = ", ',', ".join(entry.format(i) for i in (1, 2, 3))
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as file_id", f"concat('{{3,', {text}, '}}') as text")


SQL_ENTRIES = """WITH e AS (SELECT c_custkey AS file_id, i - 1 AS pos,
  lpad(c_custkey::VARCHAR, 8, '0') || '-0000-4000-8000-00000000000' || i AS uuid,
  CASE (c_custkey + i) % 7 WHEN 0 THEN 'Reference' WHEN 1 THEN 'Document' WHEN 2 THEN 'Enum' WHEN 3 THEN 'AccumRg'
    WHEN 4 THEN 'InfoRg' WHEN 5 THEN 'Fld' ELSE 'AccumRgOpt' END AS type, c_custkey % 50 + i AS number
  FROM customer, (VALUES (1), (2), (3)) v(i))"""


@query("metadata_entries", SQL_ENTRIES + " SELECT * FROM e")
def metadata_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.metadata_entries(_catalog_texts(spark, sf_dir)).withColumn("pos", F.col("pos").cast("bigint"))


@query("catalog_coverage", SQL_ENTRIES + """ SELECT CASE WHEN type IN ('Reference', 'Document', 'AccumRg') THEN 'handled'
  ELSE 'pending' END AS bucket, type, count(*) AS n FROM e
  WHERE type IN ('Reference', 'Document', 'AccumRg', 'Enum', 'InfoRg', 'Chrc', 'Const') GROUP BY ALL""")
def catalog_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.coverage(catalog.metadata_entries(_catalog_texts(spark, sf_dir)))


@query("field_names", """WITH f AS (SELECT c_custkey, c_custkey // 10 AS fld,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'Поле ' || c_mktsegment END AS name FROM customer)
  SELECT '_FLD' || fld AS fld, arg_min(name, c_custkey) AS name FROM f WHERE name <> '' GROUP BY 1""")
def field_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    uuid = "concat(lpad(cast(div(c_custkey, 10) as string), 8, '0'), '-0000-4000-8000-000000000000')"
    people = table(spark, sf_dir, "customer")
    configs = people.selectExpr(
        "cast(c_custkey as string) as file", "c_custkey as file_no",
        f"concat('{{1,', {uuid}, ',\"', case when c_custkey % 5 = 0 then '' else concat('Поле ', c_mktsegment) end, '\"}}') as text")
    params = people.filter("c_custkey % 10 = 0").selectExpr(
        "c_custkey as file_id", f"concat('{{', {uuid}, ',\"Fld\",', cast(div(c_custkey, 10) as string), '}}') as text")
    return catalog.global_field_names(catalog.field_sightings(configs, catalog.metadata_entries(params)))


# Two bases whose tables and field numbers clash: what is a segment in one is a kind in the other.
BASE_NAMES = [("a", "Контрагенты", {11: "Сегмент", 12: "Страна"}), ("b", "Номенклатура", {11: "Вид", 12: "Марка"})]


def _two_bases(spark: SparkSession, sf_dir: str) -> Bases:
    def uuid(number: int) -> str:
        return f"{number:08x}-0000-4000-8000-000000000000"

    def rows(name: str, base: str, phys: str, index: str, *cells: str) -> DataFrame:
        return table(spark, sf_dir, name).selectExpr(
            f"'{base}' as base", f"'{phys}' as phys", f"cast({index} as bigint) as row_index", f"to_variant_object(named_struct({', '.join(cells)})) as data")

    landing = rows("customer", "a", "_REFERENCE1", "c_custkey", "'_IDRREF', md5(concat('c', c_custkey))", "'_CODE', case when c_custkey % 7 = 0 then '' else lpad(cast(c_custkey as string), 6, '0') end",
                   "'_DESCRIPTION', c_name", "'_FLD11', case when c_custkey % 5 = 0 then '' else c_mktsegment end", "'_FLD12RREF', md5(concat('n', c_nationkey))")
    landing = landing.unionByName(rows("nation", "a", "_REFERENCE2", "n_nationkey", "'_IDRREF', md5(concat('n', n_nationkey))", "'_CODE', cast(n_nationkey as bigint)", "'_DESCRIPTION', n_name"))
    landing = landing.unionByName(rows("part", "b", "_Reference1", "p_partkey", "'_IDRREF', case when p_partkey % 9 = 0 then repeat('0', 32) else md5(concat('c', p_partkey)) end", "'_CODE', p_partkey",
                                       "'_DESCRIPTION', p_name", "'_FLD11', p_type", "'_FLD12', p_brand", "'_FLD13', p_size"))
    texts = [(base, "1", 0, f'{{{uuid(1)},"Reference",1}}{{{uuid(2)},"Reference",2}}' + "".join(f'{{{uuid(f)},"Fld",{f}}}' for f in names)) for base, _, names in BASE_NAMES]
    params = small_table(spark, texts, "base string, file string, file_no int, text string")
    named = [(base, uuid(1), 0, f'{{1,"{title}",' + "".join(f'{{{uuid(f)},"{n}"}}' for f, n in names.items())) for base, title, names in BASE_NAMES]
    configs = small_table(spark, named, "base string, file string, file_no int, text string")
    columns = landing.select("base", "phys", F.explode(F.map_keys(F.col("data").try_cast("map<string,variant>"))).alias("column")).distinct()
    columns = columns.withColumn("pos", F.coalesce(F.regexp_extract("column", "([0-9]+)", 1).try_cast("bigint"), F.lit(0)))
    entries = catalog.metadata_entries(params, "base")
    return Bases(landing, columns, entries, configs)


SQL_BASES = """a AS (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN 'c1-' || md5('c' || c_custkey) ELSE 'c1-' || lpad(c_custkey::VARCHAR, 6, '0') END AS ref FROM customer),
  n AS (SELECT *, CASE WHEN n_nationkey = 0 THEN 'c2-' || md5('n0') ELSE 'c2-' || n_nationkey END AS ref FROM nation),
  b AS (SELECT *, 'c1-' || CASE WHEN p_partkey = 0 THEN md5('c0') ELSE p_partkey::VARCHAR END AS ref FROM part WHERE p_partkey % 9 > 0)"""


@query("many_bases_values", f"""WITH {SQL_BASES} SELECT 'a' AS base, ref, 'Сегмент' AS title, c_mktsegment AS value FROM a WHERE c_custkey % 5 > 0 UNION ALL
  SELECT 'b', ref, 'Вид', p_type FROM b UNION ALL SELECT 'b', ref, 'Марка', p_brand FROM b UNION ALL SELECT 'b', ref, 'Поле13', p_size::VARCHAR FROM b""")
def many_bases_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field values of two bases at once; the standard columns are in ``many_bases_actors``."""
    return _two_bases(spark, sf_dir).values().filter("item is not null and title not in ('Код', 'Наименование')").select("base", "ref", "title", "value")


@query("many_bases_actors", f"""WITH {SQL_BASES} SELECT 'a' AS base, ref, 'tmpl_ref1' AS form_ref, c_name AS title, 'counterparties' AS cls,
    CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'code=' || lpad(c_custkey::VARCHAR, 6, '0') || ' ' END || 'name=' || c_name AS std FROM a UNION ALL
  SELECT 'a', ref, 'tmpl_ref2', n_name, 'catalogs', 'code=' || n_nationkey || ' name=' || n_name FROM n UNION ALL
  SELECT 'b', ref, 'tmpl_ref1', p_name, 'nomenclature', 'code=' || p_partkey || ' name=' || p_name FROM b""")
def many_bases_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    std = F.array_join(F.transform(F.map_entries("std"), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")
    return _two_bases(spark, sf_dir).actors().withColumn("std", std)


@query("many_bases_links", f"""WITH {SQL_BASES} SELECT 'a' AS base, a.ref AS source_ref, n.ref AS target_ref, 'Страна' AS name FROM a JOIN n ON n_nationkey = c_nationkey""")
def many_bases_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_bases(spark, sf_dir).links()


@query("standard_fields", f"""WITH {SQL_REFS}, s AS (SELECT ref, 'code' AS key, lpad(c_custkey::VARCHAR, 9, '0') AS value FROM c1 WHERE c_custkey % 97 > 0 UNION ALL SELECT ref, 'name', c_name FROM c1 UNION ALL
  SELECT ref, 'code', lpad(s_suppkey::VARCHAR, 9, '0') FROM c2 UNION ALL SELECT ref, 'name', s_name FROM c2 UNION ALL
  SELECT ref, 'code', p_partkey::VARCHAR FROM c3 UNION ALL SELECT ref, 'name', p_name FROM c3 WHERE p_partkey % 89 > 0 UNION ALL
  SELECT ref, 'code', lpad(n_nationkey::VARCHAR, 3, '0') FROM c4 UNION ALL SELECT ref, 'name', n_name FROM c4 UNION ALL
  SELECT ref, 'code', lpad(r_regionkey::VARCHAR, 3, '0') FROM c5 UNION ALL SELECT ref, 'name', r_name FROM c5 UNION ALL
  SELECT ref, 'code', o_orderstatus FROM c6 UNION ALL SELECT ref, 'name', name FROM c6 UNION ALL
  SELECT ref, 'code', lpad(c_custkey::VARCHAR, 9, '0') FROM c7 UNION ALL SELECT ref, 'name', c_name FROM c7 UNION ALL
  SELECT ref, 'number', o_orderkey::VARCHAR FROM d1 UNION ALL SELECT ref, 'date', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM d1 UNION ALL
  SELECT ref, 'posted', CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END FROM d1) SELECT * FROM s""")
def standard_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_base(spark, sf_dir).actors().select("ref", F.explode("std").alias("key", "value"))


@query("container_objects", """WITH t AS (SELECT s_suppkey AS file_id, i, CASE (s_suppkey + i) % 4 WHEN 0 THEN 'Справочник'
    WHEN 1 THEN 'Документ' WHEN 2 THEN 'РегистрНакопления' ELSE 'Константа' END AS kind_ru,
    'Объект' || (s_suppkey % 3 + i % 2) AS name FROM supplier, (VALUES (1), (2), (3), (4), (5)) v(i))
  SELECT file_id, kind_ru || '.' || name AS key, name, CASE kind_ru WHEN 'Справочник' THEN 'catalog' WHEN 'Документ' THEN 'document'
    WHEN 'РегистрНакопления' THEN 'accum_register' ELSE 'const' END AS kind, min(i) - 1 AS pos FROM t GROUP BY ALL""")
def container_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.metadata_objects(_configurations(spark, sf_dir)).withColumn("pos", F.col("pos").cast("bigint"))


@query("container_forms", """WITH t AS (SELECT s_suppkey AS file_id, CASE (s_suppkey + i) % 4 WHEN 0 THEN 'Справочник'
    WHEN 1 THEN 'Документ' WHEN 2 THEN 'РегистрНакопления' ELSE 'Константа' END AS kind_ru,
    'Объект' || (s_suppkey % 3 + i % 2) AS name FROM supplier, (VALUES (1), (2), (3), (4), (5)) v(i))
  SELECT 'create_form' AS op, kind_ru || '.' || name AS ref, name AS title, '#868e96' AS color, count(DISTINCT file_id) AS files FROM t GROUP BY ALL""")
def container_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = plan.container_forms(catalog.metadata_objects(_configurations(spark, sf_dir)))
    return formed.groupBy("op", "ref", "title", "color").agg(F.count(F.lit(1)).alias("files"))


def _configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration text per supplier with five named objects, some of them repeated."""
    one = ("case (s_suppkey + {0}) % 4 when 0 then 'Справочник' when 1 then 'Документ' when 2 then 'РегистрНакопления' "
           "else 'Константа' end, '.Объект', cast(s_suppkey % 3 + {0} % 2 as string), '; '")
    text = ", ".join(one.format(i) for i in (1, 2, 3, 4, 5))
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey as file_id", f"concat({text}) as text")


# --------------------------------------------------------------- actors and links
@query("actor_shells", SQL_ACTORS + " SELECT cls, form_ref, pos, ref, title FROM actors")
def actor_shells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_base(spark, sf_dir).actors().select("cls", "form_ref", "pos", "ref", "title")


@query("actor_fill", f"""WITH {SQL_REFS}
  SELECT ref, 'tmpl_ref7' AS form_ref, lpad(c_custkey::VARCHAR, 9, '0') || '|' || c_name || '|' ||
    CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Менеджер ' || c_nationkey END || '|' ||
    CAST(greatest(c_acctbal, 0) AS DECIMAL(18,2)) AS items,
    CASE WHEN c_custkey % 3 = 0 THEN 'Співробітник' ELSE 'Менеджер ' || c_nationkey END AS position,
    CASE WHEN c_acctbal > 0 THEN c_acctbal END AS salary FROM c7 UNION ALL
  SELECT ref, 'tmpl_doc1', o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '|' || (o_orderstatus = 'F')
    || '|' || CAST(o_totalprice AS DECIMAL(18,2)), NULL, NULL FROM d1""")
def actor_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    fills = star_base(spark, sf_dir, ["employees", "documents"]).fills()
    items = [F.coalesce(F.try_element_at("data", F.lit(f"item_{i}")), F.lit("")) for i in (1, 2, 3, 4)]
    return fills.select("ref", "form_ref", F.concat_ws("|", *items).alias("items"), "position", "salary")


@query("people_roll", f"""WITH {SQL_REFS} SELECT lpad(c_custkey::VARCHAR, 9, '0') AS code, c_name AS full_name,
  'Співробітник' AS position_default, CAST(trunc(CAST(greatest(c_acctbal, 0) AS DECIMAL(18,2))) AS BIGINT) AS salary
  FROM customer""")
def people_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    roll = star_base(spark, sf_dir).people()
    return roll.select("code", "full_name", F.lit(fx.DEFAULT_POSITION).alias("position_default"), "salary")


@query("id_map", f"""WITH {SQL_REFS} SELECT id, ref, 'counterparties' AS cls, 'tmpl_ref1' AS form_ref FROM c1 UNION ALL
  SELECT id, ref, 'counterparties', 'tmpl_ref2' FROM c2 UNION ALL SELECT id, ref, 'nomenclature', 'tmpl_ref3' FROM c3 UNION ALL
  SELECT id, ref, 'catalogs', 'tmpl_ref4' FROM c4 UNION ALL SELECT id, ref, 'organizations', 'tmpl_ref5' FROM c5 UNION ALL
  SELECT id, ref, 'currencies', 'tmpl_ref6' FROM c6 UNION ALL SELECT id, ref, 'employees', 'tmpl_ref7' FROM c7 UNION ALL
  SELECT id, ref, 'documents', 'tmpl_doc1' FROM d1""")
def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.last_wins(star_base(spark, sf_dir).ids()).select(F.lower(F.hex("id")).alias("id"), "ref", "cls", "form_ref")


@query("resolve_links", f"WITH {SQL_REFS}, {SQL_LINKS} SELECT * FROM links")
def resolve_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_base(spark, sf_dir).links().select("source_ref", "target_ref", "name")


@query("parent_links", f"""WITH {SQL_REFS} SELECT c4.ref AS source_ref, c5.ref AS target_ref, 'Родитель' AS name
  FROM c4 JOIN c5 ON r_regionkey = n_regionkey""")
def parent_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    nation = next(o for o in base.objects if o.phys == "_REFERENCE4")
    region = [o for o in base.objects if o.phys == "_REFERENCE5"]
    return links.parent_links(base.tables[nation.phys], nation, base.ids(region)) \
        .select("source_ref", "target_ref", "name")


@query("link_endpoints", f"""WITH {SQL_REFS}, {SQL_LINKS}, built AS (SELECT ref FROM c1 UNION ALL SELECT ref FROM d1)
  SELECT source_ref, target_ref, name FROM links WHERE source_ref IN (SELECT ref FROM built)
    AND target_ref IN (SELECT ref FROM built)""")
def link_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    built = base.actors().filter(F.col("form_ref").isin("tmpl_ref1", "tmpl_doc1"))
    return links.built_links(base.links(), built).select("source_ref", "target_ref", "name")


@query("form_errors", SQL_ACTORS + """ SELECT 'actor:no_form' AS error, ref, form_ref FROM actors
  WHERE cls = 'counterparties'""")
def form_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    known = base.forms().filter(F.col("cls") != "counterparties")
    return links.accepted_and_rejected(base.actors(), known)[1]


# --------------------------------------------------------------- ledger
TRANSFER = ["ref", "currency", "account_name", "debit_ref", "credit_ref"]


def _transfer(df: DataFrame) -> DataFrame:
    return df.select(*TRANSFER, F.col("amount").cast("double").alias("amount"))


@query("order_line_postings", f"WITH {SQL_REFS}, {SQL_LINES} SELECT * REPLACE (amount::DOUBLE AS amount) FROM doc")
def order_line_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transfer(star_base(spark, sf_dir).line_postings())


@query("register_postings", f"WITH {SQL_REFS}, {SQL_REGISTER} SELECT * REPLACE (amount::DOUBLE AS amount) FROM reg")
def register_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transfer(star_base(spark, sf_dir).register_postings())


@query("counter_actors", """SELECT 'ctr1' AS ref, 'tmpl_counter' AS form_ref, 'Контур: Расчеты' AS title
  WHERE EXISTS (SELECT 1 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)""")
def counter_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_base(spark, sf_dir).counters().select("ref", "form_ref", "title")


@query("line_target", f"""WITH {SQL_REFS}, {SQL_LINES} SELECT DISTINCT doc AS source_ref, target AS target_ref,
  target_name AS name FROM ln WHERE target IS NOT NULL""")
def line_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.line_links(star_base(spark, sf_dir).document_lines()).select("source_ref", "target_ref", "name")


@query("ledger_balance", SQL_LEGS + """ SELECT actor_ref, account_name, currency,
  sum(CASE WHEN side = 'from' THEN amount ELSE 0 END)::DOUBLE AS debit,
  sum(CASE WHEN side = 'to' THEN amount ELSE 0 END)::DOUBLE AS credit,
  sum(CASE WHEN side = 'to' THEN amount ELSE -amount END)::DOUBLE AS net, count(*) AS entries FROM legs GROUP BY ALL""")
def ledger_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = star_base(spark, sf_dir).balances()
    return found.select("actor_ref", "account_name", "currency", "entries",
                        *[F.col(c).cast("double").alias(c) for c in ("debit", "credit", "net")])


@query("ledger_violations", SQL_TRANSFERS + """ SELECT ref, (CASE WHEN ref LIKE '%00' THEN 0.004 ELSE -amount END)::DOUBLE AS difference
  FROM tr WHERE ref LIKE '%00' OR ref LIKE '%ff'""")
def ledger_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ops with legs broken on the way: some credited too much, some not credited at all."""
    ops = plan.transfer_ops(star_base(spark, sf_dir).transfers())
    leg = F.get("to_legs", F.lit(0))
    more = F.array(leg.withField("amount", (leg["amount"] + F.lit("0.004").cast(ledger.AMOUNT)).cast(ledger.AMOUNT)))
    broken = F.when(F.col("ref").endswith("00"), more).when(~F.col("ref").endswith("ff"), F.col("to_legs"))
    return ledger.violations(ops.withColumn("to_legs", broken)) \
        .withColumn("difference", F.col("difference").cast("double"))


SQL_TOTALS = f"""WITH {SQL_REFS}, t AS (
  SELECT c2.ref, 'Стоимость' AS account_name, 'money' AS currency,
    CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS v
  FROM lineitem JOIN c2 ON s_suppkey = l_suppkey UNION ALL
  SELECT c2.ref, 'Количество', 'units', CASE WHEN l_returnflag = 'R' THEN -{SQL_QUANTITY}
    ELSE {SQL_QUANTITY} END FROM lineitem JOIN c2 ON s_suppkey = l_suppkey),
  totals AS (SELECT ref, account_name, currency, sum(v) AS amount FROM t GROUP BY ALL)"""


@query("account_baseline", SQL_TOTALS + """ SELECT ref, account_name, amount::DOUBLE AS amount, currency,
  'counterparties' AS cls, 'tmpl_ref2' AS form_ref FROM totals ORDER BY ref, account_name LIMIT 5000""")
def account_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.baseline(star_base(spark, sf_dir).account_totals()) \
        .withColumn("amount", F.col("amount").cast("double"))


@query("money_total", SQL_TOTALS + """ SELECT sum(abs(amount))::DOUBLE AS money_total FROM totals WHERE currency = 'money'""")
def money_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.money_total(star_base(spark, sf_dir).account_totals()) \
        .select(F.col("money_total").cast("double").alias("money_total"))


SQL_SALARY = "trunc(CAST(greatest(c_acctbal, 0) AS DECIMAL(18,2)))"


@query("file_meta", SQL_TOTALS + f""" SELECT (SELECT sum({SQL_SALARY})::BIGINT FROM customer) AS salary_total,
  (SELECT sum(abs(amount)) FROM totals WHERE currency = 'money')::DOUBLE AS money_total,
  (SELECT count(*) FROM c1) + (SELECT count(*) FROM c2) + (SELECT count(*) FROM c3) + (SELECT count(*) FROM c4) + (SELECT count(*) FROM c5)
    + (SELECT count(*) FROM c6) + (SELECT count(*) FROM c7) + (SELECT count(*) FROM d1) + (SELECT count(*) FROM events)
    + (SELECT count(*) FROM lineitem) AS rows""")
def file_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salaries of the roll, money on the accounts, and all rows but the counter actors."""
    base = star_base(spark, sf_dir)
    parts = [base.people().agg(F.sum("salary").alias("salary_total")),
             ledger.money_total(base.account_totals()).select(F.col("money_total").cast("double").alias("money_total")),
             base.class_counts().filter(F.col("cls") != "counters").agg(F.sum("n").alias("rows"))]
    one, *rest = [p.withColumn("k", F.lit(1)) for p in parts]
    for p in rest:
        one = one.join(p, "k")
    return one.drop("k")


@query("chart_of_accounts", SQL_LEGS + """, a AS (SELECT DISTINCT actor_ref, account_name, currency FROM legs)
  SELECT account_name, currency, count(*) AS accounts FROM a GROUP BY ALL""")
def chart_of_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.accounts_of(star_base(spark, sf_dir).balances())


@query("repeated_refs", SQL_TRANSFERS + """, stored AS (SELECT DISTINCT ref FROM reg)
  SELECT DISTINCT ref, account_name, amount::DOUBLE AS amount FROM tr WHERE ref NOT IN (SELECT ref FROM stored)""")
def repeated_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    ops = base.transfers().select("obj", "pos", "ord", "ref", "account_name", "amount")
    fresh = ledger.new_by_ref(ops, base.register_postings().select("ref").distinct())
    return fresh.select("ref", "account_name", F.col("amount").cast("double").alias("amount"))


@query("document_rollup", f"""WITH {SQL_REFS}, {SQL_LINES} SELECT doc, count(*) AS lines, sum(amount)::DOUBLE AS total
  FROM ln WHERE amount IS NOT NULL GROUP BY doc""")
def document_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.document_totals(star_base(spark, sf_dir).document_lines(targets=False)) \
        .select("doc", "lines", F.col("total").cast("double").alias("total"))


@query("first_documents", f"""WITH {SQL_REFS}, {SQL_LINES} SELECT doc, count(*) AS lines, sum(amount)::DOUBLE AS total
  FROM ln WHERE amount IS NOT NULL GROUP BY doc ORDER BY min(pos) LIMIT 3""")
def first_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.first_documents(star_base(spark, sf_dir).document_lines(targets=False)) \
        .select("doc", "lines", F.col("total").cast("double").alias("total"))


# --------------------------------------------------------------- inventory
@query("class_counts", SQL_ACTORS + """ SELECT cls, count(*) AS n FROM actors GROUP BY cls UNION ALL
  SELECT 'doclines', count(*) FROM lineitem UNION ALL SELECT 'counters', 2""")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_base(spark, sf_dir).class_counts()


@query("inventory_metrics", """SELECT * FROM (
  SELECT 'c1' AS key, 'Контрагенты' AS name, 'catalog' AS kind, 'Код,Наименование,Баланс,Сегмент' AS fields, 'Страна' AS links, count(*) AS rows FROM customer UNION ALL
  SELECT 'c2', 'Поставщики', 'catalog', 'Код,Наименование,Баланс', 'Страна', count(*) FROM supplier UNION ALL
  SELECT 'c3', 'Номенклатура', 'catalog', 'Код,Наименование,Марка,Вид,Цена', '', count(*) FROM part UNION ALL
  SELECT 'c4', 'Страны', 'catalog', 'Код,Наименование', '', count(*) FROM nation UNION ALL
  SELECT 'c5', 'Организации', 'catalog', 'Код,Наименование', '', count(*) FROM region UNION ALL
  SELECT 'c6', 'Валюты', 'catalog', 'Код,Наименование', '', count(DISTINCT o_orderstatus) FROM orders UNION ALL
  SELECT 'c7', 'Сотрудники', 'catalog', 'Код,Наименование,Должность,Оклад', '', count(*) FROM customer UNION ALL
  SELECT 'd1', 'Заказ', 'document', 'Номер,Дата,Проведён,Итог,Срочность', 'Контрагент', count(*) FROM orders UNION ALL
  SELECT 'i1', 'Журнал', 'info_register', 'Период,Событие,Показатель', '', count(*) FROM events UNION ALL
  SELECT 'reg1', 'Расчеты', 'accum_register', 'Стоимость,Количество', 'Поставщик,Валюта', count(*) FROM lineitem)""")
def inventory_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_base(spark, sf_dir).inventory().select(
        "key", "name", "kind", F.array_join("fields", ",").alias("fields"),
        F.array_join("links", ",").alias("links"), "rows")


@query("inventory_totals", """SELECT 10 AS entities, 2 * (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
  + (SELECT count(*) FROM part) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM region)
  + (SELECT count(DISTINCT o_orderstatus) FROM orders) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM events)
  + (SELECT count(*) FROM lineitem) AS records, 30 AS fields, 3 AS links, 1 AS registers,
  (SELECT count(DISTINCT o_orderstatus) FROM orders) AS currencies""")
def inventory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    return inventory.base_totals(base.inventory(), base.currencies())


@query("line_coverage", "SELECT 1 AS line_tables, count(*) AS line_rows FROM lineitem")
def line_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    return inventory.line_coverage(base.tables, base.catalog)


# --------------------------------------------------------------- entities
@query("entity_sample", f"""WITH {SQL_REFS}, e AS (
  SELECT * FROM (SELECT 1 AS obj, c_custkey AS pos, 'counterparty' AS entity, c_name AS title, 'Контрагент (1С)' AS value, NULL AS salary FROM c1 ORDER BY pos LIMIT 25) UNION ALL
  SELECT * FROM (SELECT 2, s_suppkey AS pos, 'counterparty', s_name, 'Контрагент (1С)', NULL FROM c2 ORDER BY pos LIMIT 25) UNION ALL
  SELECT * FROM (SELECT 3, p_partkey AS pos, 'nomenclature', CASE WHEN p_partkey % 89 = 0 THEN ref ELSE p_name END, 'Номенклатура (1С)', NULL FROM c3 ORDER BY pos LIMIT 25) UNION ALL
  SELECT * FROM (SELECT 7, c_custkey AS pos, 'employee', c_name, 'Співробітник (1С)', CASE WHEN c_acctbal > 0 THEN c_acctbal END FROM c7 ORDER BY pos LIMIT 25) UNION ALL
  SELECT * FROM (SELECT 8, o_orderkey AS pos, 'document', o_orderkey || ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
    'Документ 1С ' || o_orderkey || ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), NULL FROM d1 ORDER BY pos LIMIT 20))
  SELECT pos, entity, title, value, salary, 0.95::DOUBLE AS confidence FROM e""")
def entity_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_base(spark, sf_dir).entities(file_name="base").select(
        "pos", "entity", "title", "value",
        F.try_element_at("accounts", F.lit(fx.SALARY_ACCOUNT)).alias("salary"), "confidence")


SQL_ENTITY_COUNTS = """SELECT 'counterparties' AS cls, (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS total,
    least(25, (SELECT count(*) FROM customer)) + least(25, (SELECT count(*) FROM supplier)) AS shown UNION ALL
  SELECT 'nomenclature', count(*), least(25, count(*)) FROM part UNION ALL
  SELECT 'employees', count(*), least(25, count(*)) FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL
  SELECT 'documents', count(*), least(20, count(*)) FROM orders"""


@query("entity_counts", SQL_ENTITY_COUNTS)
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    return entities.entity_counts(spark, base.tables, base.objects)


@query("file_entity", f"""WITH c AS ({SQL_ENTITY_COUNTS}) SELECT 'base.1cd' AS title, 'Файл 1С (1cd); ' || sum(total)::BIGINT ||
  ' рядків; ' || string_agg(cls || ':' || total, ', ' ORDER BY cls) AS value, sum(total)::BIGINT AS rows FROM c""")
def file_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    counts = entities.entity_counts(spark, base.tables, base.objects)
    return entities.file_entity(counts, "base.1cd", "1cd", 64).select(
        "title", "value", F.try_element_at("accounts", F.lit(fx.ROWS_ACCOUNT)).alias("rows"))


@query("entity_summary", """SELECT 25 * 3 + 20 + 25 AS entities, (SELECT arg_min(r_name, r_regionkey) FROM region) AS org_name,
  true AS found FROM (SELECT count(*) AS n FROM supplier) WHERE n >= 25 UNION ALL
  SELECT 25 * 2 + 20 + 25 + n, (SELECT arg_min(r_name, r_regionkey) FROM region), true FROM (SELECT count(*) AS n FROM supplier) WHERE n < 25""")
def entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    return entities.summary(base.entities(), entities.organization_name(spark, base.tables, base.objects))


# --------------------------------------------------------------- plan
@query("cap_per_form", SQL_ACTORS + f""" SELECT form_ref, ref, pos FROM actors
  QUALIFY row_number() OVER (PARTITION BY form_ref ORDER BY pos, ref) <= {CAP}""")
def cap_per_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.capped_actors(star_base(spark, sf_dir).actors(), CAP)[0].select("form_ref", "ref", "pos")


SQL_CAPPED = SQL_ACTORS + f""", {SQL_LINKS}, capped AS (SELECT ref FROM actors
  QUALIFY row_number() OVER (PARTITION BY form_ref ORDER BY pos, ref) > {CAP})"""


@query("capped_links", SQL_CAPPED + """ SELECT source_ref, target_ref, name FROM links
  WHERE source_ref NOT IN (SELECT ref FROM capped) AND target_ref NOT IN (SELECT ref FROM capped)""")
def capped_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    ops = plan.op_stream([plan.actor_ops(base.actors()), plan.link_ops(base.links())])
    return plan.cap_ops(landed_ops(ops), CAP).filter(F.col("op") == "create_link").select("source_ref", "target_ref", "name")


SQL_OPS = f"""WITH {SQL_REFS}, {SQL_REGISTER}, {SQL_LINES}, {SQL_LINKS}, n AS (
  SELECT 'create_form' AS op, 10 AS n UNION ALL
  SELECT 'create_actor', (SELECT count(*) FROM c1) + (SELECT count(*) FROM c2) + (SELECT count(*) FROM c3) + (SELECT count(*) FROM c4)
    + (SELECT count(*) FROM c5) + (SELECT count(*) FROM c6) + (SELECT count(*) FROM c7) + (SELECT count(*) FROM d1)
    + (SELECT count(*) FROM events) + 2 UNION ALL
  SELECT 'fill_actor', (SELECT count(*) FROM c1) + (SELECT count(*) FROM c2) + (SELECT count(*) FROM c3) + (SELECT count(*) FROM c4)
    + (SELECT count(*) FROM c5) + (SELECT count(*) FROM c6) + (SELECT count(*) FROM c7) + (SELECT count(*) FROM d1)
    + (SELECT count(*) FROM events) UNION ALL
  SELECT 'transfer', (SELECT count(*) FROM reg) + (SELECT count(*) FROM doc) UNION ALL
  SELECT 'create_link', (SELECT count(*) FROM links) + (SELECT count(*) FROM ln WHERE target IS NOT NULL))"""


@query("op_totals", SQL_OPS + " SELECT op, n::BIGINT AS n FROM n")
def op_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.op_totals(star_base(spark, sf_dir).op_stream())


@query("structure_scope", SQL_OPS + " SELECT 'create_form' AS op, 9::BIGINT AS n, 30::BIGINT AS fields, (SELECT count(*) FROM c1) AS customers")
def structure_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    formed = base.op_stream(structure=True).groupBy("op").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("fields")).alias("fields")).withColumn("k", F.lit("counterparties"))
    counted = base.actors().filter(F.col("form_ref") == "tmpl_ref1").groupBy(F.col("cls").alias("k")) \
        .agg(F.count(F.lit(1)).alias("customers"))
    return formed.join(counted, "k").drop("k")


@query("scope_filter", SQL_ACTORS + """ SELECT cls, count(*) AS n FROM actors
  WHERE cls IN ('employees', 'documents') GROUP BY cls""")
def scope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.in_scope(star_base(spark, sf_dir).actors(), "employees, documents") \
        .groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


@query("first_ops", """SELECT 'create_form' AS op, 'tmpl_ref' || i AS ref, i - 1 AS rank FROM (VALUES (1), (2), (3), (4), (5), (6), (7)) v(i)
  UNION ALL SELECT 'create_form', 'tmpl_doc1', 7 UNION ALL SELECT 'create_form', 'tmpl_info1', 8
  UNION ALL SELECT 'create_form', 'tmpl_counter', 9 UNION ALL
  SELECT 'create_actor', 'c1-' || CASE WHEN c_custkey % 97 = 0 THEN md5('customer-' || c_custkey)
    ELSE lpad(c_custkey::VARCHAR, 9, '0') END, 10 + c_custkey FROM customer WHERE c_custkey < 2""")
def first_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    counter = base.forms().limit(1).selectExpr(
        f"'create_form' as op", "10000L as obj", "0L as pos", "0 as ord", f"'{fx.COUNTER_FORM}' as ref")
    ops = plan.op_stream([plan.form_ops(base.forms()), counter, plan.actor_ops(base.actors())])
    first = plan.first_ops(ops).select("op", "ref", "prio", "obj", "pos")
    return dense_index(first.withColumn("_p", F.col("prio") * 100000 + F.col("obj") + F.col("pos")), [], "_p", "rank") \
        .select("op", "ref", "rank")


COUNTED = ("op", "obj", "pos", "ref", "form_ref", "from_legs", "to_legs", "source_ref", "target_ref")


def counted_ops(ops: DataFrame) -> DataFrame:
    """Ops with what caps and counts read: of a transfer the last sign of its ref, of legs their actors.

    Refs of transfers are hashes, which no file makes smaller, and amounts are most of a leg.
    """
    def actors_of(legs: str) -> Column:
        return F.transform(legs, lambda x: F.struct(x["actor_ref"].alias("actor_ref"), F.lit(None).cast("string").alias("account_name"),
                                                    F.lit(None).cast(ledger.AMOUNT).alias("amount")))

    ref = F.when(F.col("op") == "transfer", F.right("ref", F.lit(1))).otherwise(F.col("ref"))
    return ops.select(*COUNTED).withColumns({"ref": ref, "from_legs": actors_of("from_legs"), "to_legs": actors_of("to_legs")})


def _plan_and_fact(base, cap: int) -> tuple[DataFrame, DataFrame]:
    """Planned counts of the capped stream, and counts of the ops whose endpoints get built.

    Some transfers never reach the sink, so that plan and fact differ.  Ops are landed
    with the columns that caps and counts read.
    """
    ops = plan.cap_ops(landed_ops(counted_ops(base.op_stream())), cap)
    formed = ops.filter(F.col("op") == "create_form")
    made, _ = links.accepted_and_rejected(ops.filter(F.col("op") == "create_actor"), formed)
    filled = ops.filter(F.col("op") == "fill_actor").join(made.select("ref"), "ref", "left_semi")
    moved = ops.filter((F.col("op") == "transfer") & ~F.col("ref").endswith("7")).select(
        "op", F.get("from_legs", F.lit(0))["actor_ref"].alias("source_ref"),
        F.get("to_legs", F.lit(0))["actor_ref"].alias("target_ref"))
    linked = ops.filter(F.col("op") == "create_link").select("op", "source_ref", "target_ref")
    ends = links.built_links(moved.unionByName(linked), made)
    built = formed.select("op").unionByName(made.select("op")).unionByName(filled.select("op")) \
        .unionByName(ends.select("op"))
    return plan.plan_counts(ops), plan.plan_counts(built).withColumnRenamed("planned", "built")


SQL_PLAN = SQL_ACTORS + f""", {SQL_REGISTER}, {SQL_LINES}, {SQL_LINKS},
  capped AS (SELECT ref FROM actors QUALIFY row_number() OVER (PARTITION BY form_ref ORDER BY pos, ref) > {CAP}),
  tr AS (SELECT * FROM reg UNION ALL SELECT * FROM doc),
  alllinks AS (SELECT source_ref, target_ref FROM links UNION ALL SELECT doc, target FROM ln WHERE target IS NOT NULL),
  p AS (SELECT 'forms' AS category, 10 AS planned UNION ALL
    SELECT 'actors', (SELECT count(*) FROM actors WHERE ref NOT IN (SELECT ref FROM capped)) + 2 UNION ALL
    SELECT 'filled', (SELECT count(*) FROM actors WHERE ref NOT IN (SELECT ref FROM capped)) UNION ALL
    SELECT 'txns', (SELECT count(*) FROM tr WHERE debit_ref NOT IN (SELECT ref FROM capped) AND credit_ref NOT IN (SELECT ref FROM capped)) UNION ALL
    SELECT 'links', (SELECT count(*) FROM alllinks WHERE source_ref NOT IN (SELECT ref FROM capped) AND target_ref NOT IN (SELECT ref FROM capped))),
  lost AS (SELECT count(*) AS n FROM tr WHERE ref LIKE '%7' AND debit_ref NOT IN (SELECT ref FROM capped) AND credit_ref NOT IN (SELECT ref FROM capped)),
  pf AS (SELECT category, planned::BIGINT AS planned, (planned - CASE WHEN category = 'txns' THEN n ELSE 0 END)::BIGINT AS built FROM p, lost)"""


@query("plan_vs_fact", SQL_PLAN + " SELECT *, planned = built AS match FROM pf")
def plan_vs_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.reconcile(*_plan_and_fact(star_base(spark, sf_dir), CAP))


@query("case_balances", SQL_PLAN + """ SELECT '__case__' AS actor_ref, k || category AS account_name, 'count' AS currency,
  CASE WHEN k = 'PLAN ' THEN planned ELSE built END AS amount FROM pf, (VALUES ('PLAN '), ('FACT ')) v(k)""")
def case_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.case_balances(plan.reconcile(*_plan_and_fact(star_base(spark, sf_dir), CAP)), "__case__")


@query("namespaced_refs", f"""WITH {SQL_REFS} SELECT 'twin_' || trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_')
  || '__' || ref AS gref FROM c3""")
def namespaced_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = star_base(spark, sf_dir)
    part = next(o for o in base.objects if o.phys == "_REFERENCE3")
    named = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), "p_name")
    shells = base.actors().filter(F.col("form_ref") == part.form_ref).select("pos", "ref")
    return shells.join(named, "pos").select(keys.namespaced_ref(F.col("p_name"), F.col("ref")).alias("gref"))


@query("op_batches")
def op_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of op of the whole stream in batches as a sequential pass closes them."""
    return plan.batch_totals(plan.batches(star_base(spark, sf_dir).op_stream(), 20000, texts=False))


@query("bounded_batches", f"""WITH RECURSIVE {SQL_REFS.strip()}, {SQL_LINKS.strip()}, o AS (SELECT name AS stage, length('{{"op":"create_link","source_ref":"","target_ref":"","name":"","dedup":false}}')
      + length(source_ref) + length(target_ref) + length(name) AS op_bytes, row_number() OVER (PARTITION BY name ORDER BY left(source_ref, 2), source_pos) - 1 AS pos FROM placed),
  s AS (SELECT *, sum(op_bytes) OVER (PARTITION BY stage ORDER BY pos) - op_bytes AS start FROM o),
  b AS (SELECT DISTINCT stage, 0 AS batch, 0::HUGEINT AS start, 0 AS pos FROM s UNION ALL
    SELECT b.stage, b.batch + 1, min(s.start), min(s.pos) FROM b JOIN s ON s.stage = b.stage AND s.start >= b.start + 20000 GROUP BY b.stage, b.batch)
  SELECT s.stage, batch::BIGINT AS batch, count(*) AS ops, sum(op_bytes)::BIGINT AS bytes, b.pos::BIGINT AS first_pos
  FROM s ASOF JOIN b ON s.stage = b.stage AND s.pos >= b.pos GROUP BY ALL""".replace("FROM placed", """FROM (
    SELECT source_ref, target_ref, name, coalesce(c1.c_custkey, c2.s_suppkey, c4.n_nationkey, d1.o_orderkey) AS source_pos FROM links LEFT JOIN c1 ON c1.ref = source_ref
      LEFT JOIN c2 ON c2.ref = source_ref LEFT JOIN c4 ON c4.ref = source_ref LEFT JOIN d1 ON d1.ref = source_ref)"""))
def bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link ops of the base, in stream order and by the name of the link."""
    links = plan.op_stream([plan.link_ops(star_base(spark, sf_dir).links())])
    listed = links.select(F.col("name").alias("stage"), "obj", "pos", "ord", "source_ref", F.char_length(plan.op_json(links)).alias("op_bytes"))
    placed = positions.ranked(listed, ["stage"], ["obj", "pos", "ord", "source_ref"], "place").select("stage", "place", "op_bytes")
    return positions.bounded_batches(placed, ["stage"], "place", F.col("op_bytes"), 20000).groupBy("stage", "batch").agg(
        F.count(F.lit(1)).alias("ops"), F.sum("op_bytes").alias("bytes"), F.min("place").alias("first_pos"))


@query("grid_layout", """WITH n AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS n FROM customer)
  SELECT c_custkey AS pos, 150 + (n % 14) * 150 AS x, 150 + (n // 14) * 95 AS y FROM n""")
def grid_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = dense_index(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos")), [], "pos", "n")
    x, y = grid_place(F.col("n"))
    return placed.select("pos", x.alias("x"), y.alias("y"))

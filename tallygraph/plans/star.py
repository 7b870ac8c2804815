"""The driver's tables landed as an accounting base: physical tables plus metadata texts.

Ids are the md5 bytes of a table name and key.  Some codes are empty or zero
and some ids are zero, so that every fallback is taken on real rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallygraph.operators.model import LandedBase
from tallygraph.plans.registry import table
from tallygraph.session import small_table
from tallygraph.sources.catalog import Catalog, discover, metadata_entries

# physical table -> (metadata type, number, title, {column number: human name})
METADATA = {
    "_REFERENCE1": ("Reference", 1, "Контрагенты", {11: "Баланс", 12: "Сегмент", 13: "Страна"}),
    "_REFERENCE2": ("Reference", 2, "Поставщики", {21: "Баланс", 22: "Страна"}),
    "_REFERENCE3": ("Reference", 3, "Номенклатура", {31: "Марка", 32: "Вид", 33: "Цена"}),
    "_REFERENCE4": ("Reference", 4, "Страны", {}),
    "_REFERENCE5": ("Reference", 5, "Организации", {}),
    "_REFERENCE6": ("Reference", 6, "Валюты", {}),
    "_REFERENCE7": ("Reference", 7, "Сотрудники", {71: "Должность", 72: "Оклад"}),
    "_DOCUMENT1": ("Document", 1, "Заказ", {81: "Контрагент", 82: "Итог", 83: "Срочность",
                                           91: "Номенклатура", 92: "Поставщик", 93: "Количество",
                                           94: "Сумма"}),
    "_INFORG1": ("InfoRg", 1, "Журнал", {111: "Событие", 112: "Показатель"}),
    "_ACCUMRG1": ("AccumRg", 1, "Расчеты", {101: "Поставщик", 102: "Валюта", 103: "Стоимость",
                                           104: "Количество"}),
}
SYSTEM_ENTRIES = [("Enum", 1), ("Enum", 2), ("Const", 1), ("AccumRgOpt", 1)]


def _uuid(kind: int, number: int) -> str:
    return f"{kind:08x}-0000-4000-8000-{number:012x}"


def _object_uuid(phys: str) -> str:
    return _uuid(list(METADATA).index(phys) + 1, 0)


def metadata_texts(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Catalog text (one row) and configuration texts (one per object)."""
    entries = [f'{{{_object_uuid(p)},"{t}",{n}}}' for p, (t, n, _, _) in METADATA.items()]
    entries += [f'{{{_uuid(900 + i, n)},"{t}",{n}}}' for i, (t, n) in enumerate(SYSTEM_ENTRIES)]
    configs = []
    for i, (phys, (_, _, title, names)) in enumerate(METADATA.items()):
        entries += [f'{{{_uuid(500, fld)},"Fld",{fld}}}' for fld in names]
        body = ",".join(f'{{{_uuid(500, fld)},"{name}"}}' for fld, name in names.items())
        configs.append((_object_uuid(phys), i, f'{{1,"{title}",{{{body}}}}}'))
    params = small_table(spark, [(0, ",".join(entries))], "file_id bigint, text string")
    return params, small_table(spark, configs, "file string, file_no int, text string")


def _id(prefix: str, key: str) -> str:
    return f"unhex(md5(concat('{prefix}-', {key})))"


def _money(col: str) -> str:
    return f"cast({col} as decimal(18,2))"


def _quantity() -> str:
    """Parts of a unit, and one line in seven far below a hundredth."""
    return "cast(case when l_linenumber = 7 then 0.004 else l_quantity + 0.125 end as decimal(18,4))"


def _landings() -> dict[str, tuple[str, list[str]]]:
    zero = "unhex(repeat('00', 16))"
    line_no = "l_orderkey * 8 + l_linenumber as row_index"
    return {name: (source, exprs) for name, source, exprs in [
        ("_REFERENCE1", "customer", [
            f"{_id('customer', 'c_custkey')} as _IDRREF",
            "case when c_custkey % 97 = 0 then '' else lpad(cast(c_custkey as string), 9, '0') end as _CODE",
            "c_name as _DESCRIPTION", "false as _MARKED", f"{_money('c_acctbal')} as _FLD11",
            "c_mktsegment as _FLD12", f"{_id('nation', 'c_nationkey')} as _FLD13RREF",
            "c_custkey as row_index"]),
        ("_REFERENCE2", "supplier", [
            f"{_id('supplier', 's_suppkey')} as _IDRREF",
            "lpad(cast(s_suppkey as string), 9, '0') as _CODE", "s_name as _DESCRIPTION",
            f"{_money('s_acctbal')} as _FLD21", f"{_id('nation', 's_nationkey')} as _FLD22RREF",
            "s_suppkey as row_index"]),
        ("_REFERENCE3", "part", [
            f"{_id('part', 'p_partkey')} as _IDRREF", "p_partkey as _CODE",
            "case when p_partkey % 89 = 0 then '' else p_name end as _DESCRIPTION",
            "p_brand as _FLD31", "p_type as _FLD32", f"{_money('p_retailprice')} as _FLD33",
            "p_partkey as row_index"]),
        ("_REFERENCE4", "nation", [
            f"{_id('nation', 'n_nationkey')} as _IDRREF",
            "lpad(cast(n_nationkey as string), 3, '0') as _CODE", "n_name as _DESCRIPTION",
            f"{_id('region', 'n_regionkey')} as _PARENTIDRREF", "cast(n_nationkey as bigint) as row_index"]),
        ("_REFERENCE5", "region", [
            f"{_id('region', 'r_regionkey')} as _IDRREF",
            "lpad(cast(r_regionkey as string), 3, '0') as _CODE", "r_name as _DESCRIPTION",
            "cast(r_regionkey as bigint) as row_index"]),
        ("_REFERENCE7", "customer", [
            f"case when c_mktsegment = 'BUILDING' then {_id('staff', 'c_custkey')} end as _IDRREF",
            "lpad(cast(c_custkey as string), 9, '0') as _CODE", "c_name as _DESCRIPTION",
            "case when c_custkey % 3 = 0 then '' else concat('Менеджер ', c_nationkey) end as _FLD71",
            f"{_money('greatest(c_acctbal, 0)')} as _FLD72", "c_custkey as row_index"]),
        ("_DOCUMENT1", "orders", [
            f"{_id('order', 'o_orderkey')} as _IDRREF", "cast(o_orderkey as string) as _NUMBER",
            "o_orderdate as _DATE_TIME", "o_orderstatus = 'F' as _POSTED",
            f"{_id('customer', 'o_custkey')} as _FLD81RREF", f"{_money('o_totalprice')} as _FLD82",
            "o_orderpriority as _FLD83", "o_orderkey as row_index"]),
        ("_DOCUMENT1_VT1", "lineitem", [
            f"{_id('order', 'l_orderkey')} as _DOCUMENT1_IDRREF",
            "unhex(md5(concat('line-', l_orderkey, '-', l_linenumber))) as _KEYFIELD",
            "l_linenumber as _LINENO", f"{_id('part', 'l_partkey')} as _FLD91RREF",
            f"{_id('supplier', 'l_suppkey')} as _FLD92RREF", f"{_quantity()} as _FLD93",
            f"{_money('l_extendedprice')} as _FLD94", line_no]),
        ("_INFORG1", "events", [
            "ts as _PERIOD", "event_type as _FLD111", f"{_money('value')} as _FLD112",
            "event_id as row_index"]),
        ("_ACCUMRG1", "lineitem", [
            "case when l_returnflag = 'R' then 1 else 0 end as _RECORDKIND",
            f"{_id('supplier', 'l_suppkey')} as _FLD101RREF",
            f"case when l_returnflag = 'N' then {zero} else {_id('currency', 'l_linestatus')} end as _FLD102RREF",
            f"{_money('l_extendedprice')} as _FLD103", f"{_quantity()} as _FLD104", line_no]),
        ("_REFERENCE6", "orders", [
            f"{_id('currency', 'o_orderstatus')} as _IDRREF", "o_orderstatus as _CODE",
            "case when o_orderstatus = 'O' then 'Гривня' else 'Dollar' end as _DESCRIPTION",
            "cast(ascii(o_orderstatus) as bigint) as row_index"]),
    ]}


class LandedTables(Mapping):
    """Physical tables, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.landings, self.read = spark, sf_dir, _landings(), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.read:
            source, exprs = self.landings[name]
            rows = table(self.spark, self.sf_dir, source)
            if name == "_REFERENCE6":
                rows = rows.select("o_orderstatus").distinct()
            self.read[name] = rows.selectExpr(*exprs)
        return self.read[name]

    def __iter__(self):
        return iter(self.landings)

    def __len__(self):
        return len(self.landings)


_CATALOGS: dict[str, Catalog] = {}


def star_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Catalog:
    """Descriptors read once per session and set of columns; they do not depend on the rows."""
    schemas = {name: [c for c in df.columns if c != "row_index"] for name, df in tables.items()}
    app = f"{spark.sparkContext.applicationId} {sorted(schemas.items())}"
    if app not in _CATALOGS:
        params, configs = metadata_texts(spark)
        _CATALOGS[app] = discover(spark, schemas, metadata_entries(params), configs)
    return _CATALOGS[app]


def star_base(spark: SparkSession, sf_dir: str, scope: list[str] | None = None) -> LandedBase:
    tables = LandedTables(spark, sf_dir)
    return LandedBase(spark, tables, star_catalog(spark, tables), scope, unique_ids=True)

"""A landed base with every edge row: refs, links, postings, totals, plan."""

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallygraph.operators import inventory, ledger, links, plan
from tallygraph.operators.model import LandedBase
from tallygraph.sources import catalog, sinks
from tallygraph.session import work_dir

ZERO = b"\x00" * 16


def uid(n):
    return bytes([n]) * 16


CATALOG_TEXT = ",".join(f'{{{n:08d}-0000-4000-8000-000000000000,"{t}",{i}}}' for n, t, i in [
    (1, "Reference", 1), (2, "Reference", 2), (3, "Document", 5), (4, "AccumRg", 9), (5, "Enum", 1), (6, "Reference", 3),
    (11, "Fld", 11), (12, "Fld", 12), (13, "Fld", 13), (14, "Fld", 14), (15, "Fld", 15), (16, "Fld", 16), (17, "Fld", 17), (18, "Fld", 18)])


def config(n, title, fields):
    body = "".join(f'{{{f:08d}-0000-4000-8000-000000000000,0,"{name}"}}' for f, name in fields)
    return f"{n:08d}-0000-4000-8000-000000000000", n, f'{{1,{{"{title}"}},{body}}}'


@pytest.fixture(scope="module")
def base(spark):
    ref = "_IDRREF binary, _CODE string, _DESCRIPTION string, _PARENTIDRREF binary, _FLD11 string, _FLD11_TYPE binary, _FLD12RREF binary, row_index bigint"
    goods = [(uid(1), "001", "Bolt", ZERO, "x", b"1", uid(9), 0), (uid(2), "", "", uid(1), "", b"1", uid(2), 1),
             (uid(3), "001", "Nut", uid(77), None, b"1", None, 2), (None, "9", "ghost", None, "q", b"1", uid(1), 3)]
    money = [(uid(9), "UAH", "Гривня", 0), (uid(8), "X", None, 1)]
    docs = [(uid(20), "7", "2026-01-02 03:04:05", True, uid(1), 0), (uid(21), None, None, False, uid(20), 1)]
    lines = [(uid(20), uid(31), 1, uid(1), Decimal("10.50"), Decimal("2"), 0), (uid(20), uid(32), 0, uid(21), None, Decimal("-3"), 1),
             (uid(50), uid(33), 1, uid(1), Decimal("1"), Decimal("1"), 2), (ZERO, uid(34), 1, uid(1), Decimal("1"), Decimal("1"), 3)]
    moves = [(0, uid(1), uid(9), Decimal("5"), Decimal("2"), 0), (1, uid(1), ZERO, Decimal("3"), Decimal("0"), 1),
             (None, uid(2), uid(8), Decimal("-4"), None, 2), (2, uid(1), None, Decimal("1"), Decimal("1"), 3),
             (0, ZERO, uid(9), Decimal("9"), Decimal("9"), 4), (0, uid(66), uid(9), Decimal("9"), Decimal("9"), 5)]
    d = "decimal(18,2)"
    tables = {
        "_Reference1": spark.createDataFrame(goods, ref),
        "_REFERENCE2": spark.createDataFrame(money, "_IDRREF binary, _CODE string, _DESCRIPTION string, row_index bigint"),
        "_DOCUMENT5": spark.createDataFrame(docs, "_IDRREF binary, _NUMBER string, _DATE_TIME string, _POSTED boolean, _FLD13RREF binary, row_index bigint"),
        "_DOCUMENT5_VT1": spark.createDataFrame(
            lines, f"_DOCUMENT5_IDRREF binary, _KEYFIELD binary, _LINENO int, _FLD14RREF binary, _FLD15 {d}, _FLD16 {d}, row_index bigint"),
        "_ACCUMRG9": spark.createDataFrame(moves, f"_RECORDKIND int, _FLD12RREF binary, _FLD17RREF binary, _FLD15 {d}, _FLD16 {d}, row_index bigint"),
    }
    params = spark.createDataFrame([(0, CATALOG_TEXT)], "file_id bigint, text string")
    configs = spark.createDataFrame([
        config(1, "Товары", [(11, "Вес"), (12, "Поставщик")]), config(2, "Валюты", []),
        config(3, "Накладная", [(13, "Товар"), (14, "Номенклатура"), (15, "Сумма"), (16, "Количество")]),
        config(4, "Остатки", [(12, "Товар"), (17, "Валюта"), (15, "Сумма"), (16, "Количество")])], "file string, file_no int, text string")
    schemas = {k: [c for c in v.columns if c != "row_index"] for k, v in tables.items()}
    found = catalog.discover(spark, schemas, catalog.metadata_entries(params), configs)
    return LandedBase(spark, tables, found)


def test_catalog(base):
    goods, money, doc = base.catalog.objects
    assert (goods.scope, goods.title, goods.cls) == ("c1", "Товары", "nomenclature")
    assert [t for _, _, t in goods.fields] == ["Код", "Наименование", "Вес"]
    assert goods.refs == (("_FLD12RREF", "Поставщик"),)
    assert money.cls == "currencies" and doc.cls == "documents"
    (reg,) = base.catalog.registers
    assert reg.currency_dim == "_FLD17RREF" and [k for _, _, k in reg.resources] == ["money", "units"]
    (vt,) = base.catalog.lines
    assert vt.refs[0] == ("_DOCUMENT5_IDRREF", "Документ")


def test_actors(base):
    got = {(r.ref, r.title) for r in base.actors().collect()}
    assert ("c1-001", "Bolt") in got and ("c1-001", "Nut") in got
    assert ("c1-" + "02" * 16, "c1-" + "02" * 16) in got
    assert ("d5-7", "7 2026-01-02 03:04:05") in got and ("d5-" + "15" * 16, "d5-" + "15" * 16) in got
    assert not any("ghost" in t for _, t in got)


def test_fills_are_sparse(base):
    data = {r.ref: r.data for r in base.fills().filter("obj = 0").orderBy("pos").collect()}
    assert data["c1-001"] == {"item_1": "001", "item_2": "Nut"} and "c1-" + "02" * 16 not in data


def test_links(base):
    got = sorted((r.source_ref, r.target_ref, r.name) for r in base.links().collect())
    second = "c1-" + "02" * 16
    assert got == sorted([(second, "c1-001", "Родитель"), ("c1-001", "c2-UAH", "Поставщик"),
                          ("d5-7", "c1-001", "Товар"), ("d5-" + "15" * 16, "d5-7", "Товар")])


def test_last_row_of_an_id_wins(spark):
    rows = spark.createDataFrame([(uid(1), "a", "x", "f", 0, 1), (uid(1), "b", "y", "f", 0, 2), (uid(1), "c", "y", "f", 1, 0)],
                                 "id binary, ref string, cls string, form_ref string, obj int, pos bigint")
    assert [r.ref for r in links.last_wins(rows).collect()] == ["c"]


def _id(*parts):
    return "p-" + hashlib.sha256("|".join(parts).encode()).hexdigest()[:26]


def test_register_postings(base):
    got = {(r.ref, r.debit_ref, r.credit_ref, r.amount, r.currency) for r in base.register_postings().collect()}
    second = "c1-" + "02" * 16
    assert got == {
        (_id("reg9", "c1-001", "Сумма", "0", "5.0"), "ctr9", "c1-001", 5, "Гривня"),
        (_id("reg9", "c1-001", "Количество", "0", "2.0"), "ctr9", "c1-001", 2, "Единицы"),
        (_id("reg9", "c1-001", "Сумма", "1", "3.0"), "c1-001", "ctr9", 3, "Деньги"),
        (_id("reg9", second, "Сумма", "2", "4.0"), "ctr9", second, 4, "c2-X"),
        (_id("reg9", "c1-001", "Сумма", "3", "1.0"), "c1-001", "ctr9", 1, "Деньги"),
        (_id("reg9", "c1-001", "Количество", "3", "1.0"), "c1-001", "ctr9", 1, "Единицы")}


def test_account_totals_sign_only_kind_one(base):
    got = {(r.ref, r.account_name): r.amount for r in base.account_totals().collect()}
    assert got == {("c1-001", "Сумма"): 3, ("c1-001", "Количество"): 3, ("c1-" + "02" * 16, "Сумма"): -4}
    assert ledger.money_total(base.account_totals()).first()[0] == 7


def test_line_postings(base):
    lines = {r.lineno: r for r in base.document_lines().collect()}
    assert lines["1"].target == "c1-001" and lines["1"].target_name == "Номенклатура"
    assert lines["2"].target is None and lines["2"].amount == -3
    got = sorted((r.credit_ref, r.account_name, r.amount) for r in base.line_postings().collect())
    assert got == [("c1-001", "Залишок", 2), ("d5-7", "Сума", 3), ("d5-7", "Сума", Decimal("10.5"))]


def test_balances_and_counts(base):
    assert ledger.violations(base.op_stream()).count() == 0
    assert base.transfers().count() == 9
    assert {r.cls: r.n for r in base.class_counts().collect()} == {
        "nomenclature": 3, "currencies": 2, "documents": 2, "doclines": 4, "counters": 2}
    scoped = LandedBase(base.spark, base.tables, base.catalog, ["nomenclature"])
    assert {r.cls: r.n for r in scoped.class_counts().collect()} == {"nomenclature": 3, "counters": 1}
    assert inventory.base_totals(base.inventory(), base.currencies()).first().currencies == 2


def test_primary_form(base):
    (reg,) = base.catalog.registers
    assert ledger.primary_form(base.tables[reg.phys], reg, base.ids()).first().form_ref == "tmpl_ref1"


def test_cap_removes_everything_that_touches_a_capped_actor(base):
    ops = base.op_stream()
    capped = plan.cap_ops(ops, 1)
    kept = {r.ref for r in capped.filter("op = 'create_actor'").collect()}
    assert kept == {"c1-001", "c2-UAH", "d5-7", "ctr9"}
    out = {r.ref for r in ops.filter("op = 'create_actor'").collect()} - kept
    for r in capped.filter("op in ('transfer', 'create_link', 'fill_actor')").collect():
        legs = [x.actor_ref for x in (r.from_legs or []) + (r.to_legs or [])]
        assert not out & {r.source_ref, r.target_ref, *legs}
    counts = {r.category: r.planned for r in plan.plan_counts(capped).collect()}
    assert counts["forms"] == 4 and counts["actors"] == 4


def test_reconcile_counts_missing_sides_as_zero(spark):
    a = spark.createDataFrame([("forms", 2), ("links", 1)], "category string, planned bigint")
    b = spark.createDataFrame([("forms", 2), ("txns", 3)], "category string, built bigint")
    got = {r.category: (r.planned, r.built, r.match) for r in plan.reconcile(a, b).collect()}
    assert got == {"forms": (2, 2, True), "links": (1, 0, False), "txns": (0, 3, False)}
    assert plan.all_match(plan.reconcile(a, b)).first()[0] is False


def test_sink_is_idempotent(base):
    path = work_dir(base.spark, "sink-test")
    ops = plan.op_stream([plan.actor_ops(base.actors())])
    sinks.write_ops(ops.limit(0), path)
    for _ in range(2):
        sinks.append_new_ops(ops, path)
    stored = sinks.read_ops(base.spark, path)
    assert stored.count() == stored.select("ref").distinct().count() == base.actors().select("ref").distinct().count()


def test_hot_reference_key_gives_every_link(spark):
    rows = spark.range(3000).select(
        F.lit(0).alias("obj"), F.col("id").alias("pos"), F.concat(F.lit("s"), "id").alias("source_ref"), F.lit(0).alias("ord"),
        F.lit("n").alias("name"), F.when(F.col("id") % 3 == 0, F.unhex(F.lit("01" * 16))).otherwise(F.unhex(F.md5(F.col("id").cast("string")))).alias("target_id"))
    ids = rows.filter("id % 3 = 0 and id = 0 or id % 3 > 0".replace("id", "pos")).select(
        F.col("target_id").alias("id"), F.concat(F.lit("t"), "pos").alias("ref"))
    assert links.resolve_links(rows, ids).count() == 3000


@pytest.mark.parametrize("scope", [["nomenclature"], ["documents"], ["employees"], ["no such class"]])
def test_a_scope_may_lack_every_kind_of_table(base, scope):
    scoped = LandedBase(base.spark, base.tables, base.catalog, scope)
    counts = {r.op: r.n for r in plan.op_totals(scoped.op_stream()).collect()}
    assert counts.get("create_form", 0) >= 1 and scoped.people().count() == 0
    for rows in (scoped.actors(), scoped.fills(), scoped.links(), scoped.transfers(), scoped.document_lines(), scoped.account_totals(),
                 scoped.entities()):
        assert rows.count() >= 0
    assert (scoped.actors().count() == 0) == (scope[0] in ("employees", "no such class"))


def test_a_base_without_registers_and_lines(base):
    bare = LandedBase(base.spark, base.tables, catalog.Catalog(base.catalog.objects, [], []))
    assert bare.transfers().count() == bare.account_totals().count() == bare.counters().count() == 0
    assert bare.op_stream().filter("op = 'transfer'").count() == 0 and bare.actors().count() == base.actors().count()


def test_small_amounts_post_as_stored(spark, base):
    (reg,) = base.catalog.registers
    moves = spark.createDataFrame([(0, uid(1), None, Decimal("0.125"), Decimal("0.004"), 0)],
                                  "_RECORDKIND int, _FLD12RREF binary, _FLD17RREF binary, _FLD15 decimal(18,4), _FLD16 decimal(18,4), row_index bigint")
    got = {(r.ref, r.amount) for r in ledger.register_postings(moves, reg, base.ids(), None).collect()}
    assert got == {(_id("reg9", "c1-001", "Сумма", "0", "0.125"), Decimal("0.125")),
                   (_id("reg9", "c1-001", "Количество", "0", "0.004"), Decimal("0.004"))}


def test_broken_legs_are_found(base):
    ops = plan.transfer_ops(base.transfers()).withColumn("to_legs", F.when(F.col("account_name") != "Сума", F.col("to_legs")))
    got = sorted(r.difference for r in ledger.violations(ops).collect())
    assert got == [Decimal("-10.5"), -3]


def test_balances_summed_before_lookup_equal_those_of_transfers(base):
    from tallygraph.operators import ledger
    for one in (base, type(base)(base.spark, base.tables, base.catalog, scope=["counterparties"])):
        rows = [sorted(map(str, df.select("actor_ref", "account_name", "currency", "debit", "credit", "net", "entries").collect()))
                for df in (one.balances(), ledger.balances(one.transfers()))]
        assert rows[0] == rows[1]
        charts = [sorted(map(str, df.collect())) for df in (ledger.accounts_of(one.balances()), ledger.chart_of_accounts(one.transfers()))]
        assert charts[0] == charts[1]
    assert base.balances().count() > 3

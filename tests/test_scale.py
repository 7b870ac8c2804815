"""Plans whose work must be dealt out, narrow or done once; rows are built here."""

from pyspark.sql import functions as F

from tallygraph.operators import chains, ledger, plan
from tallygraph.operators.model import LandedBase
from tallygraph.plans import file_queries, ledger_queries, registry, web_queries
from tallygraph.session import work_dir
from tallygraph.sources import sinks, web, xml_records
from tallygraph.sources.catalog import Catalog, Register, TableObject
from tallygraph.streaming import ingest


def _one_file(spark, folder, name, df):
    df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _tasks_with_rows(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_texts_of_one_file_are_made_in_many_tasks(spark, tmp_path):
    folder = _one_file(spark, tmp_path, "part", spark.range(40).selectExpr("id as p_partkey"))
    made = registry.texts_of(spark, folder, "part", "p_partkey", "concat('x', p_partkey) as text")
    assert _tasks_with_rows(registry.derived(spark, folder, "part", "p_partkey")) == 1
    assert _tasks_with_rows(made) == 4
    assert sorted(r.text for r in made.collect()) == sorted(f"x{i}" for i in range(40))


def test_pages_and_files_of_one_table_file_are_read_in_many_tasks(spark, tmp_path):
    suppliers = spark.range(1, 25).selectExpr("cast(id as int) as s_suppkey", "concat('S', id) as s_name")
    parts = spark.range(24).selectExpr("id as p_partkey", "concat('P', id) as p_name", "'B' as p_brand", "'t' as p_type", "1 as p_size")
    folder = _one_file(spark, tmp_path, "supplier", suppliers)
    _one_file(spark, tmp_path, "part", parts)
    for df in (web_queries.fetch_report(spark, folder), registry.texts_of(spark, folder, "supplier", *web_queries.CONTENTS_PAGE)):
        assert _tasks_with_rows(df) == 4
    profiled = file_queries.xml_profile(spark, folder).select("file_id", "nodes").collect()
    assert sorted(map(tuple, profiled)) == [(i, 20) for i in range(24)]


def test_crawl_contents_reads_each_report_once(spark):
    log = spark.createDataFrame([("u1", 200), ("u2", 404)], "url string, status int")
    reports = spark.createDataFrame(
        [("u1", "body", ["a@b.co"], ["s"], ["+1"], ["l1", "l2"], [("organization", "X"), ("organization", "X")]),
         ("u3", None, None, [], ["+1"], None, None)],
        "url string, text string, emails array<string>, socials array<string>, phones array<string>, links array<string>, "
        "entities array<struct<entity:string,title:string>>")
    found = web.crawl_contents(log, reports)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    assert {tuple(r) for r in found.collect()} == {
        ("email", "a@b.co", None, 1), ("social", "s", None, 1), ("phone", "+1", None, 2), ("link", "l1", None, 1),
        ("link", "l2", None, 1), ("entity", "organization", "X", 1), ("error", "u2", "404", 1),
        ("text", "u1", "body", 1), ("text", "u3", None, 1)}


def test_movements_carry_plain_values_through_joins(spark):
    """Names and texts of resources are made after the lookup, not moved by it."""
    reg = Register(phys="_R", idx=1, name="r", dims=[("_D", "d")], resources=[("_X", "Sum", "money"), ("_Y", "Units", "units")],
                   currency_dim=None, signed=False)
    df = spark.createDataFrame([(bytearray(b"a" * 16), 1, 2)], "_D binary, _X int, _Y int").withColumn("row_index", F.lit(7))
    moved = ledger.movements(df, reg)
    assert not [f.name for f in moved.schema if f.dataType.typeName() in ("array", "struct", "map")]
    ids = spark.createDataFrame([(bytearray(b"a" * 16), "c1-1")], "id binary, ref string")
    got = ledger.register_postings(df, reg, ids, None).select("ord", "account_name", F.col("amount").cast("int")).collect()
    assert sorted(map(tuple, got)) == [(0, "Sum", 1), (1, "Units", 2)]


def test_new_by_ref_moves_each_ref_once(spark):
    ops = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 1, "x"), (None, 3, "n"), ("c", 1, "gone")],
                                "ref string, pos bigint, v string")
    found = ledger.new_by_ref(ops, spark.createDataFrame([("c",)], "ref string"))
    assert {(r.ref, r.pos, r.v) for r in found.collect()} == {("a", 1, "first"), ("b", 1, "x"), (None, 3, "n")}
    shuffled = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "min_by" in line]
    assert shuffled and not any("ref, ref" in line.split("min_by")[1] for line in shuffled)
    assert ledger.new_by_ref(ops.select("ref"), spark.createDataFrame([("c",)], "ref string")).count() == 3


def _plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_unrepeated_ops_are_not_grouped(spark):
    """Only ops whose identity may repeat go through the group; new identities are told before ops move."""
    path = work_dir(spark, "scale-sink")
    ops = plan.op_stream([spark.createDataFrame(
        [("create_actor", "a", 2, "late", None), ("create_actor", "a", 1, "first", None), ("create_actor", "b", 1, "x", None),
         ("create_link", None, 1, "l", "s"), ("create_link", None, 2, "l", "s")], "op string, ref string, pos bigint, name string, source_ref string")])
    assert "LeftAnti" in _plan_of(sinks.first_of_each(ops))
    sinks.write_ops(ops.filter("pos = 3"), path)
    for _ in range(2):
        sinks.append_new_ops(ops, path)
        stored = sinks.read_ops(spark, path)
        assert sorted((r.op, r.ref, r.pos) for r in stored.collect()) == [
            ("create_actor", "a", 1), ("create_actor", "b", 1), ("create_link", None, 1)]


def test_many_repeats_are_grouped_at_once(spark, monkeypatch):
    monkeypatch.setattr(sinks, "REPEATED", 1)
    ops = spark.createDataFrame([(r, p) for r in "abc" for p in (2, 1)] + [("d", 3)], "ref string, pos bigint")
    found = sinks.first_of_each(ops)
    assert "LeftAnti" not in _plan_of(found)
    assert {(r.ref, r.pos) for r in found.select("_row.*").collect()} == {("a", 1), ("b", 1), ("c", 1), ("d", 3)}


def test_batches_are_not_grouped_where_nothing_repeats(spark):
    ops = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 4)], "ref string, pos bigint")
    found = ingest.first_per_key(ops, "ref", ("pos",))
    assert "LeftAnti" in _plan_of(found)
    assert {(r.ref, r.pos) for r in found.select("_row.*").collect()} == {("a", 1), ("b", 5), (None, 4)}


def test_capping_moves_ends_not_ops(spark):
    rows = [("create_actor", "f", f"a{i}", i, None, None) for i in range(4)] + [
        ("create_link", None, None, 0, "a0", "a1"), ("create_link", None, None, 1, "a0", "a3"), ("create_link", None, None, 2, "else", "a1"),
        ("fill_actor", "f", "a2", 2, None, None), ("fill_actor", "f", "a1", 1, None, None), ("create_link", None, None, 3, None, None)]
    ops = plan.op_stream([spark.createDataFrame(rows, "op string, form_ref string, ref string, pos bigint, source_ref string, target_ref string")
                          .withColumn("obj", F.lit(1).cast("bigint"))])
    capped = plan.cap_ops(ops, 2)
    assert sorted((r.op, r.pos) for r in capped.collect()) == [
        ("create_actor", 0), ("create_actor", 1), ("create_link", 0), ("create_link", 2), ("create_link", 3), ("fill_actor", 1)]
    assert "LeftAnti" not in _plan_of(capped) and _plan_of(capped).count("LeftSemi") == 2


def _lines(spark):
    """Lines with two references; the map holds part 1 and supplier 2 twice, part 9 not at all."""
    table = TableObject(1, "vt", "_V", "v", "v", "v", "doclines", (), (("_A", "part"), ("_B", "supplier")), None, None, "_D",
                        (("_S", "Сумма"), ("_Q", "Количество")))
    b = lambda n: bytes([n]) * 16      # noqa: E731
    df = spark.createDataFrame([(b(50), 1, b(1), b(3), 5, 2, 0), (b(50), 2, b(4), b(2), 6, 3, 1), (b(50), 3, b(9), b(3), 7, 4, 2),
                                (b(50), 0, None, b(2), 8, 5, 3), (b(51), 1, b(1), b(2), 9, 6, 4)],
                               "_D binary, _LINENO int, _A binary, _B binary, _S int, _Q int, row_index bigint")
    ids = spark.createDataFrame([(b(1), "p1"), (b(1), "p1x"), (b(2), "s2"), (b(2), "s2x"), (b(3), "s3"), (b(4), "p4")], "id binary, ref string")
    return df, table, spark.createDataFrame([(b(50), "d")], "id binary, ref string"), ids


def test_later_references_are_looked_up_where_they_matter(spark):
    df, table, docs, ids = _lines(spark)
    maps = ledger._target_maps(df.select(F.col("_A").alias("_t0"), F.col("_B").alias("_t1")), ["_t0", "_t1"], ids)
    assert sorted(r.ref for r in maps[1].collect()) == ["p1", "p1x", "s2", "s2x", "s3"] and maps[0] is ids
    got = sorted((r.lineno, r.target, r.target_name) for r in ledger.document_lines(df, table, docs, ids).collect())
    assert got == [("1", "p1", "part"), ("1", "p1x", "part"), ("2", "p4", "part"), ("2", "p4", "part"), ("3", "s3", "supplier"),
                   ("4", "s2", "supplier"), ("4", "s2x", "supplier")]


def test_line_flows_are_summed_by_one_reference_at_a_time(spark):
    df, table, docs, ids = _lines(spark)
    flows = ledger.line_flows(df, table, docs, ids)
    assert not [line for line in _plan_of(flows).split("\n") if "Aggregate [_t0" in line and "_t1" in line.split("]")[0]]
    summed = flows.filter("currency = 'Единицы'").groupBy("credit_ref").agg(F.sum("amount").cast("int"), F.sum("n"))
    postings = ledger.line_postings(ledger.document_lines(df, table, docs, ids)).filter("currency = 'Единицы'")
    expected = postings.groupBy("credit_ref").agg(F.sum("amount").cast("int"), F.count(F.lit(1)))
    assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, expected.collect())) == [
        ("p1", 2, 1), ("p1x", 2, 1), ("p4", 6, 2), ("s2", 5, 1), ("s2x", 5, 1), ("s3", 4, 1)]


def test_refs_of_violations_are_made_once(spark):
    df, table, docs, ids = _lines(spark)
    ops = plan.transfer_ops(ledger.line_postings(ledger.document_lines(df, table, docs, ids)))
    broken = ops.withColumn("to_legs", F.when(F.col("ref").endswith("00"), F.col("from_legs")))
    found = ledger.violations(broken)
    assert _plan_of(found).count("sha2(") == _plan_of(ops.select("ref")).count("sha2(")
    assert found.count() == ops.filter("not ref like '%00'").count()


def test_a_register_is_joined_with_the_ids_it_names(spark):
    reg = Register(phys="_R", idx=1, name="r", dims=[("_D", "d")], resources=[("_X", "Sum", "money")], currency_dim=None, signed=False)
    goods = TableObject(0, "ref", "_G", "c1", "tmpl_ref1", "g", "nomenclature", (), (), "_CODE", "_IDRREF")
    tables = {"_G": spark.range(1, 100).selectExpr("unhex(md5(cast(id as string))) as _IDRREF", "cast(id as string) as _CODE", "id as row_index"),
              "_R": spark.range(50).selectExpr("unhex(md5(cast(id % 3 as string))) as _D", "1 as _X", "id as row_index")}
    base = LandedBase(spark, tables, Catalog([goods], [], [reg]), unique_ids=True)
    assert sorted(r.ref for r in base._register_ids(reg).collect()) == ["c1-1", "c1-2"]
    assert base.register_postings().count() == 33 and base.counters().count() == 1


def test_plan_lands_what_it_counts(spark, monkeypatch):
    landed = []
    monkeypatch.setattr(ledger_queries, "landed_ops", lambda ops: landed.append(ops.columns) or plan.no_ops(spark))
    ledger_queries._plan_and_fact(type("Base", (), {"op_stream": lambda self: plan.with_priority(plan.no_ops(spark))})(), 3)
    assert "data" not in landed[0] and {"op", "ref", "from_legs"} <= set(landed[0])


def _joins_of(df, kind):
    return df._jdf.queryExecution().executedPlan().toString().count(kind)


def test_profiles_of_texts_made_of_short_rows_are_not_broadcast(spark, tmp_path):
    """A short table makes long texts: by its file's size their profiles would be sent to the driver and every task."""
    parts = spark.range(24).selectExpr("id as p_partkey", "concat('P', id) as p_name", "'B' as p_brand", "'t' as p_type", "1 as p_size")
    found = file_queries.xml_profile(spark, _one_file(spark, tmp_path, "part", parts.unionByName(parts.filter("p_partkey = 3"))))
    assert _joins_of(found, "BroadcastHashJoin") == 0
    assert sorted((r.file_id, r.nodes) for r in found.collect()) == sorted([(i, 20) for i in range(24) if i != 3] + [(3, 40)] * 2)


def test_rows_of_large_xml_files_are_not_broadcast(spark, tmp_path):
    """Written rows are compressed many times; places and texts of tags meet by shuffles, only the files' names may be sent."""
    for i in range(2):
        (tmp_path / f"{i}.xml").write_text(f"<?xml version='1.0'?><a><Body><r><!-- <x> --><t><![CDATA[{i} <!-- <b> -->]]></t></r></Body></a>")
    tags = xml_records.read_tags(spark, str(tmp_path))
    joins = [x for x in tags._jdf.queryExecution().executedPlan().toString().split("\n") if "HashJoin" in x or "MergeJoin" in x]
    assert any("pos#" in x for x in joins) and not any("BroadcastHashJoin" in x for x in joins if "pos#" in x)
    records, leaves = xml_records.with_record_tag(xml_records.tag_leaves(tags))
    assert _joins_of(leaves.select("leaf_no", "index"), "SortMergeJoin") > 0
    got = [(r.file_id.rsplit("/", 1)[1], r.ref, r.leaf, r.text) for r in leaves.orderBy("file_id", "leaf_no").collect()]
    assert got == [(f"{i}.xml", "e0_0", leaf, text) for i in range(2) for leaf, text in (("r", ""), ("t", f"{i} <!-- <b> -->"))]


def test_a_walk_meets_its_halves_by_shuffles(spark):
    steps = spark.range(300).selectExpr("'g' as g", "id as at", "id + 7 as to")
    met = chains.reached(steps, ["g"], "at", "to")
    assert _joins_of(met, "BroadcastHashJoin") == 0
    assert sorted(r["at"] for r in met.collect()) == list(range(0, 300, 7))


def test_ops_are_landed_with_what_is_counted(spark):
    leg = "array(named_struct('actor_ref', '{}', 'account_name', 'money', 'amount', cast(5 as decimal(28,10))))"
    ops = plan.op_stream([spark.range(1).selectExpr(
        "'transfer' as op", "id as pos", "'p-0a7' as ref", f"{leg.format('a')} as from_legs", f"{leg.format('b')} as to_legs"),
        spark.range(1).selectExpr("'create_actor' as op", "id as pos", "'a-17' as ref", "'f' as form_ref")])
    landed = sinks.landed_ops(ledger_queries.counted_ops(ops))
    got = {r.op: r for r in landed.collect()}
    assert (got["transfer"].ref, got["create_actor"].ref, got["create_actor"].form_ref, got["create_actor"].from_legs) == ("7", "a-17", "f", None)
    assert [(x.actor_ref, x.account_name, x.amount) for x in got["transfer"].from_legs + got["transfer"].to_legs] == [("a", None, None), ("b", None, None)]
    written = spark.read.option("mergeSchema", "true").parquet(landed.inputFiles()[0].rsplit("/", 2)[0])
    assert sorted(written.columns) == sorted(ledger_queries.COUNTED)

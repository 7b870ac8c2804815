"""The op stream and its plan: one long table of ops, scope, caps, counts, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.numbers import lookup
from tallygraph.operators import ledger
from tallygraph.operators.actors import is_filled
from tallygraph.operators.positions import bounded_batches, first_per_group, ranked
from tallygraph.session import materialize, no_rows, small_table, union_all

LEG_TYPE = f"array<struct<actor_ref:string,account_name:string,amount:{ledger.AMOUNT}>>"
OPS_SCHEMA = ("op string, obj bigint, pos bigint, ord int, ref string, form_ref string, title string, "
              "cls string, color string, fields array<struct<id:string,title:string>>, "
              "std map<string,string>, data map<string,string>, position string, salary double, "
              "currency string, account_name string, account_type string, "
              f"from_legs {LEG_TYPE}, to_legs {LEG_TYPE}, doc string, lineno string, "
              "source_ref string, target_ref string, name string, dedup boolean")


def _leg(actor: str) -> Column:
    return F.array(F.struct(F.col(actor).alias("actor_ref"), F.col("account_name"),
                            F.col("amount").cast(ledger.AMOUNT).alias("amount")))


def form_ops(forms: DataFrame) -> DataFrame:
    return forms.select(F.lit("create_form").alias("op"), F.col("obj").cast("bigint").alias("obj"),
                        F.lit(0).cast("bigint").alias("pos"), F.lit(0).alias("ord"),
                        "ref", "title", "color", "cls", "fields")


def actor_ops(actors: DataFrame) -> DataFrame:
    cols = [c for c in ("ref", "form_ref", "title", "cls", "std") if c in actors.columns]
    return actors.select(F.lit("create_actor").alias("op"), F.col("obj").cast("bigint").alias("obj"),
                         F.col("pos").cast("bigint").alias("pos"), F.lit(0).alias("ord"), *cols)


def row_ops(rows: DataFrame) -> DataFrame:
    """Shell and fill of every row in one pass over its table."""
    shell = F.col("op") == "create_actor"
    both = rows.select("*", F.explode(F.array(F.lit("create_actor"), F.lit("fill_actor"))).alias("op"))
    return both.filter(shell | is_filled()).select(
        "op", F.col("obj").cast("bigint").alias("obj"), "pos", F.lit(0).alias("ord"), "ref", "form_ref",
        F.when(shell, F.col("title")).alias("title"), "cls", "std",
        *[F.when(~shell, F.col(c)).alias(c) for c in ("data", "position", "salary")])


def line_ops(lines: DataFrame) -> DataFrame:
    """Money leg, quantity leg and document-to-target link of every line in one pass.

    The link comes once per line and is marked ``dedup``: whoever applies the
    ops keeps one per pair, see ``ledger.line_links``.
    """
    empty = F.lit(None).cast("string")
    legs = ledger.line_legs(lines)
    link = F.struct(F.lit(2).alias("ord"), F.lit(None).cast(ledger.AMOUNT).alias("amount"), empty.alias("currency"),
                    empty.alias("account_name"), F.col("target").alias("credit_ref"))
    made = lines.select("obj", "pos", "doc", "lineno", "target_name", F.explode(F.concat(legs, F.array(link))).alias("l")) \
        .select("obj", "pos", "doc", "lineno", "target_name", "l.*").filter(F.col("credit_ref").isNotNull())
    is_link = F.col("ord") == 2
    made = made.filter(is_link | (F.col("amount") != 0)).withColumn("debit_ref", F.lit(fx.DOCUMENT_COUNTER))
    return made.select(
        F.when(is_link, "create_link").otherwise("transfer").alias("op"), F.col("obj").cast("bigint").alias("obj"), "pos", "ord",
        F.when(~is_link, ledger.line_ref()).alias("ref"), "currency", "account_name", F.when(~is_link, "fact").alias("account_type"),
        F.when(~is_link, _leg("debit_ref")).alias("from_legs"), F.when(~is_link, _leg("credit_ref")).alias("to_legs"),
        F.when(~is_link, F.col("doc")).alias("doc"), F.when(~is_link, F.col("lineno")).alias("lineno"),
        F.when(is_link, F.col("doc")).alias("source_ref"), F.when(is_link, F.col("credit_ref")).alias("target_ref"),
        F.when(is_link, F.col("target_name")).alias("name"), F.when(is_link, F.lit(True)).alias("dedup"))


def transfer_ops(transfers: DataFrame) -> DataFrame:
    return transfers.select(
        F.lit("transfer").alias("op"), F.col("obj").cast("bigint").alias("obj"),
        F.col("pos").cast("bigint").alias("pos"), F.col("ord").cast("int").alias("ord"), "ref",
        F.coalesce("currency", F.lit(fx.DEFAULT_UNITS)).alias("currency"),
        F.coalesce("account_name", F.lit(fx.DOCUMENT_ACCOUNT)).alias("account_name"),
        F.lit("fact").alias("account_type"), _leg("debit_ref").alias("from_legs"),
        _leg("credit_ref").alias("to_legs"), "doc", "lineno")


def link_ops(links: DataFrame, dedup: bool = False) -> DataFrame:
    ordinal = F.col("ord").cast("int") if "ord" in links.columns else F.lit(0)
    return links.select(F.lit("create_link").alias("op"), F.col("obj").cast("bigint").alias("obj"),
                        F.col("pos").cast("bigint").alias("pos"), ordinal.alias("ord"),
                        "source_ref", "target_ref", "name", F.lit(dedup).alias("dedup"))


def op_stream(parts: list[DataFrame]) -> DataFrame:
    """All ops in one table; ``prio`` and (obj, pos, ord) give the dependency order."""
    return with_priority(union_all([*parts, no_ops(parts[0].sparkSession)], allow_missing=True))


def no_ops(spark: SparkSession) -> DataFrame:
    """The columns of the op stream, without rows."""
    return no_rows(spark, OPS_SCHEMA)


def with_priority(ops: DataFrame) -> DataFrame:
    return ops.withColumn("prio", lookup(fx.OP_PRIORITY, F.col("op"), 9))


def in_dependency_order(ops: DataFrame) -> DataFrame:
    """Total order for output; the extra keys make it independent of sort stability."""
    return ops.orderBy("prio", "obj", "pos", "ord", F.coalesce("ref", "source_ref"))


def in_scope(rows: DataFrame, scope: str | list[str] | None) -> DataFrame:
    """Rows of the chosen classes; the scope is a list or a comma-separated text."""
    if isinstance(scope, str):
        scope = [s.strip() for s in scope.split(",") if s.strip()]
    return rows.filter(F.col("cls").isin(list(scope))) if scope else rows


def capped_actors(actors: DataFrame, cap: int) -> tuple[DataFrame, DataFrame]:
    """First ``cap`` actors of each form, and the refs of the actors left out.

    The last kept place per form is one small row; the actors left out are those
    behind it, so the full actor list is filtered and never sorted.
    """
    kept = first_per_group(actors, ["form_ref"], ["obj", "pos", "ref"], cap)
    place = F.struct("obj", "pos", "ref")
    last = kept.groupBy("form_ref").agg(F.max(place).alias("_last"))
    left_out = actors.join(last, "form_ref").filter(place > F.col("_last")).select("ref")
    return kept, left_out


def cap_ops(ops: DataFrame, cap: int) -> DataFrame:
    """Ops without the actors above the cap and without every op that touches one.

    Which ends are free of actors left out is found among the distinct ends and written out;
    ops are moved only where these are many.
    """
    if not cap:
        return ops
    actors = ops.filter(F.col("op") == "create_actor")
    kept, out = capped_actors(actors, cap)
    touched = ops.filter(~F.col("op").isin("create_actor", "create_form"))
    touched = touched.withColumn("_a", F.coalesce("source_ref", F.get("from_legs", F.lit(0))["actor_ref"], "ref")) \
        .withColumn("_b", F.coalesce("target_ref", F.get("to_legs", F.lit(0))["actor_ref"], "ref"))
    ends = touched.select(F.explode(F.array("_a", "_b")).alias("_end")).distinct()
    free = materialize(ends.join(out.withColumnRenamed("ref", "_end"), "_end", "left_anti"))
    for side in ("_a", "_b"):
        touched = touched.join(free, F.col(side).eqNullSafe(F.col("_end")), "left_semi")
    return (ops.filter(F.col("op") == "create_form").unionByName(kept)
            .unionByName(touched.drop("_a", "_b")))


def category(op: Column) -> Column:
    return lookup(fx.OP_CATEGORY, op, "other")


def plan_counts(ops: DataFrame) -> DataFrame:
    """Planned ops per category, zeros included, other ops left out."""
    spark: SparkSession = ops.sparkSession
    names = small_table(spark, [(c,) for c in fx.CATEGORIES], "category string")
    counted = ops.groupBy(category(F.col("op")).alias("category")).agg(F.count(F.lit(1)).alias("planned"))
    return names.join(counted, "category", "left") \
        .select("category", F.coalesce("planned", F.lit(0)).alias("planned"))


def reconcile(planned: DataFrame, built: DataFrame) -> DataFrame:
    """Planned against built per category; a category missing on one side counts as 0."""
    p, b = F.coalesce("planned", F.lit(0)), F.coalesce("built", F.lit(0))
    return (planned.join(built, "category", "full_outer")
            .select("category", p.alias("planned"), b.alias("built"), (p == b).alias("match")))


def all_match(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(F.coalesce(F.bool_and("match"), F.lit(False)).alias("all_match"))


def case_balances(reconciled: DataFrame, case: str) -> DataFrame:
    """Account rows of a case actor: PLAN and FACT per category, in counts."""
    pairs = F.array(F.struct(F.concat(F.lit("PLAN "), "category").alias("account_name"),
                             F.col("planned").alias("amount")),
                    F.struct(F.concat(F.lit("FACT "), "category").alias("account_name"),
                             F.col("built").alias("amount")))
    return reconciled.select(F.lit(case).alias("actor_ref"), F.explode(pairs).alias("p")) \
        .select("actor_ref", "p.account_name", F.lit("count").alias("currency"), "p.amount")


def op_totals(ops: DataFrame) -> DataFrame:
    return ops.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def batches(ops: DataFrame, max_bytes: int = fx.BATCH_BYTES, texts: bool = True) -> DataFrame:
    """(op, place, op_bytes, batch, op_json): serialised ops of each kind in order, cut where a batch is full.

    Without ``texts`` an op is serialised for its size only, and its text is not kept.
    """
    order = ["obj", "pos", "ord", "ref", "source_ref", "target_ref"]
    size = F.char_length(op_json(ops)).cast("bigint").alias("op_bytes")
    listed = ops.select("op", *order, size, *([op_json(ops).alias("op_json")] if texts else []))
    # written out: dealing rows by ranges reads them twice, and an op is long work
    placed = ranked(materialize(listed), ["op"], order, "place", keep_order=False)
    return bounded_batches(placed, ["op"], "place", F.col("op_bytes"), max_bytes)


def batch_totals(batched: DataFrame) -> DataFrame:
    """Per kind of op: ops, batches and the bytes of its largest batch."""
    per_batch = batched.groupBy("op", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("op_bytes").alias("bytes"))
    return per_batch.groupBy("op").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches"),
                                       F.max("bytes").alias("largest_batch"))


def first_ops(ops: DataFrame, limit: int = fx.FIRST_OPS) -> DataFrame:
    return in_dependency_order(ops).limit(limit)


def op_json(ops: DataFrame) -> Column:
    """Serialised op without nulls; its length is the op's size in a batch."""
    return F.to_json(F.struct(*[F.col(c) for c in ops.columns if c not in ("prio", "obj", "pos", "ord")]))


def container_forms(objects: DataFrame) -> DataFrame:
    """Structure-only forms, one per metadata object of a configuration."""
    return objects.select(F.lit("create_form").alias("op"), F.col("key").alias("ref"),
                          F.col("name").alias("title"), F.lit(fx.OTHER_COLOR).alias("color"))

"""Double entry: register postings, document-line postings, balances, accounts.

A transfer row holds one debit and one credit leg of the same amount, so it is
balanced by construction; ``legs`` turns transfers into the long form.
Amounts keep ten decimals, which holds quantities and rates as stored; only
reports round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.keys import amount_text, posting_id, present_id
from tallygraph.operators.actors import ROW_INDEX, named_columns
from tallygraph.operators.links import left_to, repeated_ids
from tallygraph.session import materialize, no_rows, union_all
from tallygraph.sources.catalog import Register, TableObject

AMOUNT, TOTAL = "decimal(28,10)", "decimal(38,10)"
POSTINGS = ("obj int, pos bigint, ord int, ref string, currency string, account_name string, debit_ref string, "
            f"credit_ref string, amount {AMOUNT}, doc string, lineno string")
FLOWS = f"currency string, account_name string, debit_ref string, credit_ref string, amount {TOTAL}, n bigint"
LINES = (f"obj int, pos bigint, doc string, lineno string, amount {AMOUNT}, quantity {AMOUNT}, target string, "
         "target_name string")


def _expense(df: DataFrame, reg: Register):
    """Record kind other than 0, false or null; an unsigned register only receives."""
    if not reg.signed:
        return F.lit(False)
    return F.coalesce(F.col("_RECORDKIND").cast("int") != 0, F.lit(False))


def _text_of(df: DataFrame, column: str) -> Column:
    """Absolute amount as text, from the column's own digits where it is a decimal with a fraction."""
    kind = df.schema[column].dataType
    plain = F.col(column) if kind.typeName() == "decimal" and kind.scale else F.col(column).cast(AMOUNT)
    return amount_text(F.abs(plain))


def _resource_cells(moved: DataFrame, reg: Register):
    """The resources of ``movements`` with their names; made after joins, so that these move plain values only."""
    return F.array(*[F.struct(F.lit(i).alias("res"), F.lit(name).alias("account"), F.lit(kind).alias("kind"),
                              F.col(f"_v{i}").cast(AMOUNT).alias("value"), _text_of(moved, f"_v{i}").alias("text"))
                     for i, (_, name, kind) in enumerate(reg.resources)])


def movements(df: DataFrame, reg: Register) -> DataFrame:
    """Movements whose first dimension is set, with only the columns the ledger needs."""
    currency = present_id(F.col(reg.currency_dim)) if reg.currency_dim else F.lit(None).cast("binary")
    kind = F.col("_RECORDKIND").cast("int") if reg.signed else F.lit(None).cast("int")
    return df.select(present_id(F.col(reg.dims[0][0])).alias("id"), F.col(ROW_INDEX).cast("bigint").alias("pos"),
                     _expense(df, reg).alias("expense"), F.coalesce(kind == 1, F.lit(False)).alias("negative"),
                     currency.alias("currency_id"), *[F.col(c).alias(f"_v{i}") for i, (c, _, _) in enumerate(reg.resources)]) \
        .filter(F.col("id").isNotNull())


def _with_money(moved: DataFrame, reg: Register, currencies: DataFrame | None) -> DataFrame:
    """``money``, the name of the currency dimension."""
    if reg.currency_dim and currencies is not None:
        names = currencies.select(F.col("id").alias("currency_id"), F.col("name").alias("money"))
        return moved.join(names, "currency_id", "left")
    return moved.withColumn("money", F.lit(None).cast("string"))


def _currency(kind: Column) -> Column:
    return F.when(kind == "units", fx.UNIT_CURRENCY).otherwise(F.coalesce("money", F.lit(fx.MONEY_CURRENCY)))


def register_flows(df: DataFrame, reg: Register, ids: DataFrame, currencies: DataFrame | None) -> DataFrame:
    """The register's postings summed by their two accounts, as (FLOWS).

    Movements are summed by raw ids first: ids and currencies are looked up once per sum.
    """
    moved = movements(df, reg)
    cell = moved.select("id", "currency_id", "expense", F.explode(_resource_cells(moved, reg)).alias("c")).filter(F.col("c.value") != 0)
    summed = cell.groupBy("id", "currency_id", "expense", F.col("c.account").alias("account_name"), F.col("c.kind").alias("kind")) \
        .agg(F.sum(F.abs("c.value")).cast(TOTAL).alias("amount"), F.count(F.lit(1)).alias("n"))
    named = _with_money(summed.join(ids.select("id", F.col("ref").alias("actor")), "id"), reg, currencies)
    counter, actor = F.lit(reg.counter), F.col("actor")
    return named.select(_currency(F.col("kind")).alias("currency"), "account_name",
                        F.when(F.col("expense"), actor).otherwise(counter).alias("debit_ref"),
                        F.when(F.col("expense"), counter).otherwise(actor).alias("credit_ref"), "amount", "n")


def register_postings(df: DataFrame, reg: Register, ids: DataFrame,
                      currencies: DataFrame | None) -> DataFrame:
    """Every non-zero resource of a movement as a balanced transfer.

    A receipt moves from the register's counter actor to the actor of the first
    dimension, an expense the other way; the amount is absolute.
    """
    moved = movements(df, reg).join(ids.select("id", F.col("ref").alias("actor")), "id")
    moved = _with_money(moved, reg, currencies)
    cell = (moved.select("pos", "actor", "expense", "money", F.explode(_resource_cells(moved, reg)).alias("c"))
            .filter((F.col("c.value") != 0)))
    amount = F.abs("c.value")
    currency = _currency(F.col("c.kind"))
    counter, actor = F.lit(reg.counter), F.col("actor")
    return cell.select(
        F.lit(reg.idx).alias("obj"), "pos", F.col("c.res").alias("ord"),
        posting_id(F.lit(f"reg{reg.idx}"), actor, F.col("c.account"), F.col("pos"), F.col("c.text")).alias("ref"),
        currency.alias("currency"), F.col("c.account").alias("account_name"),
        F.when(F.col("expense"), actor).otherwise(counter).alias("debit_ref"),
        F.when(F.col("expense"), counter).otherwise(actor).alias("credit_ref"),
        amount.alias("amount"), F.lit(None).cast("string").alias("doc"),
        F.lit(None).cast("string").alias("lineno"))


def primary_form(df: DataFrame, reg: Register, ids: DataFrame) -> DataFrame:
    """(register, form_ref): form of the first movement that resolves; no row when none does."""
    form = (F.when(F.col("ref").rlike("^c[0-9]+-"),
                   F.concat(F.lit("tmpl_ref"), F.regexp_extract("ref", "^c([0-9]+)-", 1)))
            .when(F.col("ref").rlike("^d[0-9]+-"),
                  F.concat(F.lit("tmpl_doc"), F.regexp_extract("ref", "^d([0-9]+)-", 1))))
    first_row = df.select(present_id(F.col(reg.dims[0][0])).alias("id"), F.col(ROW_INDEX).alias("pos")) \
        .filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("pos").alias("pos"))
    return (first_row.join(ids.select("id", "ref"), "id")
            .groupBy(F.lit(reg.idx).alias("register")).agg(F.min_by(form, "pos").alias("form_ref"))
            .filter(F.col("form_ref").isNotNull()))


def counter_actors(spark: SparkSession, regs: list[tuple[Register, DataFrame]]) -> DataFrame:
    """One counter actor per register that has resources and a primary form."""
    parts = [form.select(F.lit(reg.counter).alias("ref"), F.lit(fx.COUNTER_FORM).alias("form_ref"),
                         F.lit(fx.COUNTER_TITLE + reg.name).alias("title"), F.lit(reg.idx).alias("obj"))
             for reg, form in regs]
    return union_all(parts, empty=no_rows(spark, "ref string, form_ref string, title string, obj int"))


def account_totals(regs: list[tuple[Register, DataFrame]], ids: DataFrame) -> DataFrame:
    """Signed total per (actor, account); only record kind 1 is negative.

    Movements are summed per id before the id is looked up, so a hot actor is
    combined in each task and one row per id and account is joined.
    """
    parts = []
    for reg, df in regs:
        moved = movements(df, reg)
        cell = moved.select("id", "negative", F.explode(_resource_cells(moved, reg)).alias("c")) \
            .filter(F.col("c.value").isNotNull())
        signed = F.when(F.col("negative"), -F.col("c.value")).otherwise(F.col("c.value"))
        parts.append(cell.groupBy("id", F.col("c.account").alias("account_name"),
                                  F.col("c.kind").alias("currency"))
                     .agg(F.sum(signed).alias("amount")).withColumn("obj", F.lit(reg.idx)))
    summed = union_all(parts, empty=no_rows(
        ids.sparkSession, f"id binary, account_name string, currency string, amount {TOTAL}, obj int"))
    return (summed.join(ids.select("id", "ref", "cls", "form_ref"), "id")
            .groupBy("ref", "account_name")
            .agg(F.sum("amount").cast(TOTAL).alias("amount"), F.min_by("currency", "obj").alias("currency"),
                 F.min("cls").alias("cls"), F.min("form_ref").alias("form_ref")))


def baseline(totals: DataFrame, classes: list[str] | None = None,
             limit: int = fx.BASELINE_ROWS) -> DataFrame:
    """First rows of the account totals by (ref, account), with class and form."""
    kept = totals.filter(F.col("cls").isin(classes)) if classes else totals
    return kept.select("ref", "account_name", "amount", "currency",
                       F.coalesce("cls", F.lit("")).alias("cls"),
                       F.coalesce("form_ref", F.lit("")).alias("form_ref")) \
        .orderBy("ref", "account_name").limit(limit)


def money_total(totals: DataFrame) -> DataFrame:
    return totals.filter(F.col("currency") == "money").agg(
        F.coalesce(F.sum(F.abs("amount")), F.lit(0)).cast(TOTAL).alias("money_total"))


def _first_of(df: DataFrame, obj: TableObject, pattern: str):
    return next((c for c in named_columns(obj, pattern) if c in df.columns), None)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("decimal", "double", "float", "long", "integer", "short", "byte")
            and "LINENO" not in f.name.upper() and f.name not in (ROW_INDEX, "_LINENO")]


def line_amount(df: DataFrame, column: str | None):
    """The sum column, else the largest numeric field of the line."""
    numbers = [F.col(c).cast(AMOUNT) for c in numeric_columns(df)]
    largest = F.greatest(*numbers) if len(numbers) > 1 else (numbers[0] if numbers else F.lit(None).cast(AMOUNT))
    return F.coalesce(F.col(column).cast(AMOUNT), largest) if column else largest


def document_lines(df: DataFrame, obj: TableObject, doc_ids: DataFrame,
                   catalog_ids: DataFrame | None) -> DataFrame:
    """Lines of known documents with amount, quantity and their first catalog target.

    Without ``catalog_ids`` no target is looked up, which saves a join per
    reference column when only the documents matter.  References after the first are looked up
    only where they can matter: an earlier one names no known row, or the id is held more than
    once and gives its line as often.  That part of the map is mostly small, so lines are moved
    for their document and their first reference only.
    """
    quantity = _first_of(df, obj, fx.QUANTITY_COLUMN)
    refs = [(c, n) for c, n in obj.refs if c != obj.parent_col and c in df.columns] if catalog_ids else []
    targets = [f"_t{i}" for i in range(len(refs))]
    lines = df.select(
        present_id(F.col(obj.parent_col)).alias("doc_id"), F.col(ROW_INDEX).cast("bigint").alias("pos"),
        F.coalesce(F.nullif(F.col("_LINENO").cast("bigint"), F.lit(0)), F.col(ROW_INDEX) + 1).alias("lineno"),
        line_amount(df, _first_of(df, obj, fx.SUM_COLUMN)).alias("amount"),
        (F.col(quantity).cast(AMOUNT) if quantity else F.lit(None).cast(AMOUNT)).alias("quantity"),
        *[present_id(F.col(c)).alias(t) for t, (c, _) in zip(targets, refs)])
    sides = _target_maps(lines.select(*targets), targets, catalog_ids) if refs else []
    docs = doc_ids.select(F.col("id").alias("doc_id"), F.col("ref").alias("doc"))
    target, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (_, label) in reversed(list(enumerate(refs))):
        if i == 0:
            lines = lines.join(docs, "doc_id").drop("doc_id")
        side = sides[i].select(F.col("id").alias(f"_t{i}"), F.col("ref").alias(f"_r{i}"))
        lines = lines.join(side, f"_t{i}", "left").drop(f"_t{i}")
        target = F.coalesce(F.col(f"_r{i}"), target)
        name = F.when(F.col(f"_r{i}").isNotNull(), label).otherwise(name)
    if not refs:
        lines = lines.join(docs, "doc_id")
    return lines.select(F.lit(obj.order).alias("obj"), "pos", "doc", F.col("lineno").cast("string").alias("lineno"), "amount", "quantity",
                        target.alias("target"), name.alias("target_name"))


def _target_maps(named: DataFrame, targets: list[str], catalog_ids: DataFrame) -> list[DataFrame]:
    """The id map of each reference column: whole for the first, of the others what can matter."""
    maps = [catalog_ids]
    if len(targets) > 1:
        twice = repeated_ids(catalog_ids)
        for t, rows in list(zip(targets, left_to(named, targets, catalog_ids)))[1:]:
            wanted = rows.select(F.col(t).alias("id")).unionByName(twice).distinct()
            maps.append(materialize(catalog_ids.join(wanted, "id", "left_semi")))
    return maps


def line_flows(df: DataFrame, obj: TableObject, doc_ids: DataFrame, catalog_ids: DataFrame) -> DataFrame:
    """The line postings of a table summed by their two accounts, as (FLOWS).

    Money is summed by the raw id of the document, quantity, of lines whose document is known,
    by the raw id of the first reference, what that does not resolve by the next; only sums are
    looked up.  Unknown documents are found among the distinct ones.
    """
    quantity = _first_of(df, obj, fx.QUANTITY_COLUMN)
    refs = [c for c, _ in obj.refs if c != obj.parent_col and c in df.columns]
    amount = F.abs(line_amount(df, _first_of(df, obj, fx.SUM_COLUMN)))
    units = F.abs(F.col(quantity).cast(AMOUNT)) if quantity else F.lit(None).cast(AMOUNT)
    lines = df.select(present_id(F.col(obj.parent_col)).alias("doc_id"), amount.alias("amount"), units.alias("units"),
                      *[present_id(F.col(c)).alias(f"_t{i}") for i, c in enumerate(refs)])

    def sums(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
        return rows.filter(F.col(value) != 0).groupBy(*by).agg(F.sum(value).cast(TOTAL).alias("amount"), F.count(F.lit(1)).alias("n"))

    def flow(rows: DataFrame, currency: str, account: str) -> DataFrame:
        return rows.select(F.lit(currency).alias("currency"), F.lit(account).alias("account_name"),
                           F.lit(fx.DOCUMENT_COUNTER).alias("debit_ref"), F.col("ref").alias("credit_ref"), "amount", "n")

    docs = doc_ids.select(F.col("id").alias("doc_id"), "ref")
    money = flow(sums(lines, "amount", ["doc_id"]).join(docs, "doc_id"), fx.MONEY_CURRENCY, fx.DOCUMENT_ACCOUNT)
    if not refs:
        return money
    targets = [f"_t{i}" for i in range(len(refs))]
    unknown = materialize(lines.select(F.col("doc_id").alias("_doc")).distinct().join(docs.withColumnRenamed("doc_id", "_doc"), "_doc", "left_anti"))
    twice = materialize(catalog_ids.join(repeated_ids(catalog_ids), "id", "left_semi").select("id"))
    flows = [money]
    for i, rows in enumerate(left_to(lines, targets, catalog_ids)):
        rows = rows.join(unknown, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti")
        for t in targets[i + 1:]:       # an id held more than once gives its line as often
            rows = rows.join(twice.select(F.col("id").alias(t)), t, "left")
        known = sums(rows, "units", [targets[i]]).join(catalog_ids.select(F.col("id").alias(targets[i]), "ref"), targets[i])
        flows.append(flow(known, fx.UNIT_CURRENCY, fx.STOCK_ACCOUNT))
    return union_all(flows)


def line_legs(lines: DataFrame) -> Column:
    """The two legs of a line: money to its document, quantity to its catalog target."""
    return F.array(
        F.struct(F.lit(0).alias("ord"), F.abs(lines["amount"]).alias("amount"), F.lit(fx.MONEY_CURRENCY).alias("currency"),
                 F.lit(fx.DOCUMENT_ACCOUNT).alias("account_name"), F.col("doc").alias("credit_ref")),
        F.struct(F.lit(1).alias("ord"), F.abs(lines["quantity"]).alias("amount"), F.lit(fx.UNIT_CURRENCY).alias("currency"),
                 F.lit(fx.STOCK_ACCOUNT).alias("account_name"), F.col("target").alias("credit_ref")))


def line_ref() -> Column:
    """Posting id of an exploded leg; computed after the explode, so only where it is read."""
    amount = amount_text(F.col("amount"))
    money = posting_id(F.col("doc"), F.col("account_name"), F.col("lineno"), amount)
    units = posting_id(F.col("doc"), F.col("account_name"), F.col("credit_ref"), F.col("lineno"), amount)
    return F.when(F.col("ord") == 0, money).otherwise(units)


def line_postings(lines: DataFrame) -> DataFrame:
    """Every non-zero leg of the lines as a balanced transfer from the document counter."""
    leg = lines.select("obj", "pos", "doc", "lineno", F.explode(line_legs(lines)).alias("l")) \
        .select("obj", "pos", "doc", "lineno", "l.*")
    return leg.filter((F.col("amount") != 0) & F.col("credit_ref").isNotNull()).select(
        "obj", "pos", "ord", line_ref().alias("ref"), "currency", "account_name",
        F.lit(fx.DOCUMENT_COUNTER).alias("debit_ref"), "credit_ref", "amount", "doc", "lineno")


def line_links(lines: DataFrame) -> DataFrame:
    """One document-to-target link per pair and name, at the place of its first line."""
    return (lines.filter(F.col("target").isNotNull())
            .groupBy(F.col("doc").alias("source_ref"), F.col("target").alias("target_ref"),
                     F.col("target_name").alias("name"))
            .agg(F.min("obj").alias("obj"), F.min("pos").alias("pos")))


def legs(transfers: DataFrame) -> DataFrame:
    """Long form of transfers: a debit leg (out) and a credit leg (in) per transfer."""
    sides = F.array(F.struct(F.lit("from").alias("side"), F.col("debit_ref").alias("actor_ref"),
                             (-F.col("amount")).alias("signed")),
                    F.struct(F.lit("to").alias("side"), F.col("credit_ref").alias("actor_ref"),
                             F.col("amount").alias("signed")))
    return (transfers.select("ref", "currency", "account_name", "amount", F.explode(sides).alias("s"))
            .select("ref", "currency", "account_name", "amount", "s.side", "s.actor_ref", "s.signed"))


def balances(transfers: DataFrame) -> DataFrame:
    """Debit, credit and net per account (actor, name, currency)."""
    entry = legs(transfers)
    return entry.groupBy("actor_ref", "account_name", "currency").agg(
        F.coalesce(F.sum(F.when(F.col("side") == "from", F.col("amount"))), F.lit(0)).cast(TOTAL).alias("debit"),
        F.coalesce(F.sum(F.when(F.col("side") == "to", F.col("amount"))), F.lit(0)).cast(TOTAL).alias("credit"),
        F.sum("signed").cast(TOTAL).alias("net"), F.count(F.lit(1)).alias("entries"))


def flow_balances(flows: DataFrame) -> DataFrame:
    """``balances`` of transfers that are summed by their two accounts already."""
    none = F.lit(0).cast(TOTAL)
    sides = F.array(F.struct(F.col("debit_ref").alias("actor_ref"), F.col("amount").alias("debit"), none.alias("credit")),
                    F.struct(F.col("credit_ref").alias("actor_ref"), none.alias("debit"), F.col("amount").alias("credit")))
    entry = flows.select("account_name", "currency", "n", F.explode(sides).alias("s")).select("account_name", "currency", "n", "s.*")
    summed = entry.groupBy("actor_ref", "account_name", "currency").agg(
        F.sum("debit").cast(TOTAL).alias("debit"), F.sum("credit").cast(TOTAL).alias("credit"), F.sum("n").alias("entries"))
    return summed.select("actor_ref", "account_name", "currency", "debit", "credit",
                         (F.col("credit") - F.col("debit")).cast(TOTAL).alias("net"), "entries")


def accounts_of(balanced: DataFrame) -> DataFrame:
    """``chart_of_accounts`` from balances, which have one row per account."""
    return balanced.groupBy("account_name", "currency").agg(F.count(F.lit(1)).alias("accounts"))


def violations(ops: DataFrame) -> DataFrame:
    """Transfer ops whose to-legs do not sum to their from-legs, compared inside the row."""
    def total(legs_of: str) -> Column:
        return F.aggregate(F.coalesce(legs_of, F.array()), F.lit(0).cast(TOTAL),
                           lambda done, leg: (done + F.coalesce(leg["amount"], F.lit(0))).cast(TOTAL))

    # a generator: a filter would be pushed below the refs and legs and make them again for itself
    difference = F.array(F.struct((total("to_legs") - total("from_legs")).cast(TOTAL).alias("difference")))
    return ops.filter(F.col("op") == "transfer").select("ref", F.inline(F.filter(difference, lambda d: d["difference"] != 0)))


def chart_of_accounts(transfers: DataFrame) -> DataFrame:
    """Distinct (account, currency) pairs with the number of accounts, one per actor and pair."""
    accounts = legs(transfers).select("actor_ref", "account_name", "currency").distinct()
    return accounts.groupBy("account_name", "currency").agg(F.count(F.lit(1)).alias("accounts"))


def new_by_ref(ops: DataFrame, stored_refs: DataFrame) -> DataFrame:
    """The first op of each ref in stream order, without the refs that are already stored."""
    place = F.struct(*([c for c in ("prio", "obj", "pos", "ord") if c in ops.columns] or ["ref"]))
    rest = [c for c in ops.columns if c != "ref"] or ["ref"]
    first = ops.groupBy("ref").agg(F.min_by(F.struct(*[F.col(c).alias(f"_{c}") for c in rest]), place).alias("_row")) \
        .select(*[F.col("ref") if c == "ref" else F.col(f"_row._{c}").alias(c) for c in ops.columns])
    return first.join(stored_refs.select("ref"), "ref", "left_anti")


def document_totals(lines: DataFrame) -> DataFrame:
    """Line count and total per document; lines stay rows, they are not collected."""
    return lines.filter(F.col("amount").isNotNull()).groupBy("doc").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").cast(TOTAL).alias("total"),
        F.min(F.struct("obj", "pos")).alias("first_line"))


def first_documents(lines: DataFrame, limit: int = fx.DOCUMENTS_SHOWN) -> DataFrame:
    """Totals of the first documents, in the order of their first lines."""
    return document_totals(lines).orderBy("first_line").limit(limit).drop("first_line")

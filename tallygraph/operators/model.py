"""One landed base as a whole: tables plus catalog in, every derived table out.

The methods build plans; they run only what a plan needs to know of ids.  ``unique_ids`` says that ids are primary keys,
as a landing job with a key constraint guarantees; otherwise the id map keeps
the last row of each id.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.operators import actors, entities, inventory, ledger, links, plan
from tallygraph.session import no_rows, small_table, union_all
from tallygraph.sources.catalog import Catalog, Register, TableObject


class LandedBase:
    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame], catalog: Catalog,
                 scope: list[str] | None = None, unique_ids: bool = False):
        self.spark, self.tables, self.catalog, self.unique_ids = spark, tables, catalog, unique_ids
        self.scope = list(scope) if scope else None
        self._named: dict[str, DataFrame] = {}

    # ------------------------------------------------------------ objects
    @property
    def objects(self) -> list[TableObject]:
        return [o for o in self.catalog.objects if not self.scope or o.cls in self.scope]

    @property
    def lines(self) -> list[TableObject]:
        return list(self.catalog.lines) if not self.scope or "documents" in self.scope else []

    def ids(self, objects: list[TableObject] | None = None) -> DataFrame:
        """Id map of the given objects (all in scope by default)."""
        if objects is None:
            return self._all_ids
        return self._id_map(objects)

    def _id_map(self, objects: list[TableObject]) -> DataFrame:
        rows = union_all([actors.id_rows(self.tables[o.phys], o) for o in objects
                       if "_IDRREF" in self.tables[o.phys].columns], empty=self._none(actors.ID_ROWS))
        return rows if self.unique_ids else links.last_wins(rows)

    @cached_property
    def _all_ids(self) -> DataFrame:
        return self._id_map(self.objects)

    def _none(self, schema: str) -> DataFrame:
        return no_rows(self.spark, schema)

    # ------------------------------------------------------------ graph
    def forms(self) -> DataFrame:
        return actors.forms(self.spark, self.objects)

    def actors(self) -> DataFrame:
        return union_all([actors.actors(self.tables[o.phys], o) for o in self.objects], empty=self._none(actors.ACTORS))

    def fills(self) -> DataFrame:
        return union_all([actors.fills(self.tables[o.phys], o) for o in self.objects],
                         empty=self._none(actors.SHELLS).drop("title"))

    def links(self) -> DataFrame:
        found = [links.link_candidates(self.tables[o.phys], o) for o in self.objects
                 if links.has_references(self.tables[o.phys], o)]
        return links.resolve_links(union_all(found, empty=self._none(links.CANDIDATES)), self.ids())

    def people(self) -> DataFrame:
        """Roll of the first employees catalog; empty without one."""
        staff = [o for o in self.objects if any(k in o.title.lower() for k in fx.PEOPLE_KEYWORDS)]
        return actors.people(self.tables[staff[0].phys], staff[0]) if staff else self._none(actors.PEOPLE)

    # ------------------------------------------------------------ ledger
    def currencies(self) -> DataFrame | None:
        """(id, ref, name) of the rows of the currency catalogs."""
        found = [o for o in self.catalog.objects if o.kind == "ref"
                 and re.search(fx.CURRENCY_FIELD, o.title, re.I)]
        if not found:
            return None
        parts = []
        for o in found:
            df = self.tables[o.phys]
            parts.append(df.select(F.col("_IDRREF").alias("id"), actors.ref_of(df, o).alias("ref"),
                                   actors.title_of(df, o).alias("name")).filter(F.col("id").isNotNull()))
        return union_all(parts)

    def _active_registers(self):
        return [r for r in self.catalog.registers if r.dims and r.resources and r.phys in self.tables]

    def _register_ids(self, reg: Register) -> DataFrame:
        """The ids that movements of a register name, found once."""
        if reg.phys not in self._named:
            moved = ledger.movements(self.tables[reg.phys], reg)
            self._named[reg.phys] = links.wanted_ids(moved, "id", self.ids().select("id", "ref"))
        return self._named[reg.phys]

    def counters(self) -> DataFrame:
        return ledger.counter_actors(self.spark, [(r, ledger.primary_form(self.tables[r.phys], r, self._register_ids(r)))
                                                  for r in self._active_registers()])

    def register_postings(self) -> DataFrame:
        money = self.currencies()
        return union_all([ledger.register_postings(self.tables[r.phys], r, self._register_ids(r), money)
                       for r in self._active_registers()], empty=self._none(ledger.POSTINGS))

    def document_lines(self, targets: bool = True) -> DataFrame:
        catalogs = self.ids([o for o in self.objects if o.kind == "ref"]) if targets else None
        parts = []
        for v in self.lines:
            owner = [o for o in self.objects if f"{o.phys}_IDRREF".upper() == v.parent_col]
            parts.append(ledger.document_lines(self.tables[v.phys], v, self.ids(owner), catalogs))
        return union_all(parts, empty=self._none(ledger.LINES))

    def line_postings(self) -> DataFrame:
        return ledger.line_postings(self.document_lines())

    def transfers(self) -> DataFrame:
        return self.register_postings().unionByName(self.line_postings())

    def balances(self) -> DataFrame:
        """Debit, credit and net of every account: ``ledger.balances`` of all transfers, summed before any lookup."""
        money, catalogs = self.currencies(), self.ids([o for o in self.objects if o.kind == "ref"])
        parts = [ledger.register_flows(self.tables[r.phys], r, self.ids(), money) for r in self._active_registers()]
        for v in self.lines:
            owner = [o for o in self.objects if f"{o.phys}_IDRREF".upper() == v.parent_col]
            parts.append(ledger.line_flows(self.tables[v.phys], v, self.ids(owner), catalogs))
        return ledger.flow_balances(union_all(parts, empty=self._none(ledger.FLOWS)))

    def account_totals(self) -> DataFrame:
        return ledger.account_totals([(r, self.tables[r.phys]) for r in self.catalog.registers if r.dims],
                                     self.ids())

    # ------------------------------------------------------------ stream and reports
    def op_stream(self, structure: bool = False) -> DataFrame:
        """Every op of the base; the structure scope gives forms only.

        Each table is read once for its shells and fills and once for its
        links, and the lines are joined once for postings and links.
        """
        form_part = plan.form_ops(self.forms())
        if structure:
            return plan.op_stream([form_part])
        counter_form = small_table(
            self.spark, [(10_000, fx.COUNTER_FORM, fx.COUNTER_FORM_TITLE, fx.COUNTER_COLOR, [])],
            f"obj int, ref string, title string, color string, fields {actors.FIELDS_TYPE}")
        parts = [form_part, plan.form_ops(counter_form.withColumn("cls", F.lit(None).cast("string"))),
                 plan.row_ops(union_all([actors.shells_and_fills(self.tables[o.phys], o) for o in self.objects],
                                        empty=self._none(actors.SHELLS))),
                 plan.actor_ops(self.counters().withColumn("pos", F.lit(0))
                                .withColumn("obj", F.col("obj") + 10_000)),
                 plan.transfer_ops(self.register_postings()), plan.link_ops(self.links())]
        if self.lines:
            counter = small_table(
                self.spark, [(20_000, 0, fx.DOCUMENT_COUNTER, fx.COUNTER_FORM, fx.DOCUMENT_COUNTER_TITLE, "registers")],
                "obj int, pos int, ref string, form_ref string, title string, cls string")
            parts += [plan.actor_ops(counter), plan.line_ops(self.document_lines())]
        return plan.op_stream(parts)

    def class_counts(self) -> DataFrame:
        return inventory.class_counts(self.tables, self.catalog, self.counters(), self.scope)

    def inventory(self) -> DataFrame:
        return inventory.base_entities(self.spark, self.tables, self.catalog)

    def entities(self, caps: dict[str, int] | None = None, file_name: str | None = None) -> DataFrame:
        return entities.entities(self.spark, self.tables, self.objects, caps, file_name)

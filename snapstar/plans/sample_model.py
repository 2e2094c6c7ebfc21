"""The source entities derived from the order/line-item tables, with all their rows.

Departments are nations, projects customers, contracts and procedures orders; line items
become bids, annexes, purchase orders and invoices. Frames are lazy and shared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import AWARDED, date_to_serial
from ..operators.snapshots import END, RESCUED, SNAPSHOT_TS, START, dedup_by_key
from .. import session
from ..session import deal_out, has_hot_key, scratch_dir, stored_bytes
from ..sources.landing import write_gold
from . import gold
from .entities import ENTITIES, typed

AS_OF = "2000-06-30"
PAID, UNPAID = "Plaćeno", "Neplaćeno"
LINE = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount", "l_returnflag",
        "l_linestatus", "l_shipdate"]


def _always_valid(df: DataFrame) -> DataFrame:
    return df.withColumns({
        START: F.lit("1995-01-01").cast("timestamp"), END: F.lit(None).cast("timestamp")})


def _shuffled(df: DataFrame) -> DataFrame:
    """A side of a join with a row for each order. The planner would broadcast it as long as its columns take few bytes in the compressed file, up to
    many millions of rows, which every task then counts whole."""
    return df.hint("merge")


_SCHEMAS: dict[str, StructType] = {}


class GoldTables(Mapping[str, DataFrame]):
    """The 16 gold tables by name, each built when first asked for.

    With a ``folder`` those in ``stored`` (all, if not given) are also written there, and they and everything built from them read the
    written table; ``rows`` then tells how many rows were written.
    """

    def __init__(self, model: SampleModel, folder: str | None = None, stored: Sequence[str] | None = None) -> None:
        self._built: dict[str, DataFrame] = {}
        self._folder, self._stored = folder, stored
        self._seen: dict[str, Observation] = {}
        self._spark = model.spark
        g, m = self, model
        self._makers: dict[str, Callable[[], DataFrame]] = {
            "dim_department": lambda: gold.dim_department(m.departments),
            "dim_supplier": lambda: gold.dim_supplier(m.suppliers),
            "dim_cpv": lambda: gold.dim_cpv(m.cpv),
            "dim_date": lambda: gold.dim_date(m.spark, "1995-01-01", "2002-12-31"),
            "dim_project": lambda: gold.dim_project(m.projects),
            "dim_contract": lambda: gold.dim_contract(m.contracts, m.annexes),
            "dim_procedure": lambda: gold.dim_procedure(m.procedures, m.plan),
            "fact_invoices": lambda: gold.fact_invoices(m.invoices),
            "fact_purchase_orders": lambda: gold.fact_purchase_orders(m.purchase_orders),
            "fact_contract_financials": lambda: gold.fact_contract_financials(m.contracts, m.annexes),
            "fact_procurement_bids": lambda: gold.fact_procurement_bids(m.bids),
            "fact_procurement_performance": lambda: gold.fact_procurement_performance(
                m.plan, m.procedures, g["fact_procurement_bids"]),
            "fact_project_financials": lambda: gold.fact_project_financials(
                m.projects, g["fact_contract_financials"], gold.current(m.contracts), m.invoices),
            "mv_procurement_savings_kpi": lambda: gold.mv_procurement_savings_kpi(
                g["fact_procurement_performance"], g["dim_procedure"], g["dim_project"], g["dim_department"],
                g["dim_cpv"], g["dim_supplier"]),
            "mv_project_realization_kpi": lambda: gold.mv_project_realization_kpi(
                g["fact_project_financials"], g["dim_project"], g["dim_department"]),
            "mv_avg_payment_delay_kpi": lambda: gold.mv_avg_payment_delay_kpi(
                g["fact_invoices"], g["dim_project"], g["dim_department"]),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            table = self._makers[name]()
            if self._folder and (self._stored is None or name in self._stored):
                self._seen[name] = Observation()
                write_gold(table.observe(self._seen[name], F.count(F.lit(1)).alias("rows")), f"{self._folder}/{name}")
                table = table.sparkSession.read.schema(table.schema).parquet(f"{self._folder}/{name}")
            self._built[name] = table
        return self._built[name]

    def rows(self, name: str) -> int:
        """Rows of a stored table, counted while it was written."""
        return self[name] is not None and self._seen[name].get["rows"]

    def build_all(self) -> GoldTables:
        """Build every table, those of one wave side by side; a wave needs only tables of the waves before it."""
        for wave in gold.WAVES:
            gold.side_by_side(self._spark, [lambda n=name: self[n] for name in wave])
        return self

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


class SampleModel:
    """Silver and gold tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._shared = False
        self._tables: dict[str, DataFrame] = {}
        self._bytes: dict[str, int] = {}
        self._hot: dict[tuple[str, str], bool] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is read from the files once per process."""
        if name not in self._tables:
            path = f"{self.sf_dir}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._tables[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._tables[name]

    def dealt(self, name: str, key: str | None = None, like: str | None = None) -> DataFrame:
        """A given table for steps that sort or hash what they scan: in pieces whose size doesn't follow the row groups of its files.

        With a ``key`` its rows meet in one piece, so that joins and groups by it need no further exchange; a table with a hot key is dealt evenly.
        There are as many pieces as the table ``like`` has, if one is given.
        """
        stored = self._stored_bytes(like or name)
        by_key = key and stored > session.PIECE and not self.has_hot(name, key)
        return deal_out(self.table(name), stored, *([key] if by_key else []))

    def _stored_bytes(self, name: str) -> int:
        if name not in self._bytes:
            self._bytes[name] = stored_bytes(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._bytes[name]

    def has_hot(self, name: str, key: str) -> bool:
        """Whether a key of a given table holds far more rows than others; asked once."""
        if (name, key) not in self._hot:
            self._hot[name, key] = has_hot_key(self.table(name), key)
        return self._hot[name, key]

    # Shared parts

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").withColumn("o_orderdate", F.to_date("o_orderdate"))

    @cached_property
    def _orders_to_join(self) -> DataFrame:
        """Orders for joins by key: a shuffle holds the rows that a task scans, so those are pieces here, as many as there are of line items."""
        return self.dealt("orders", "o_orderkey", like="lineitem").withColumn("o_orderdate", F.to_date("o_orderdate"))

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with one row per (order, line number)."""
        return dedup_by_key(self.dealt("lineitem", "l_orderkey").select(*LINE), ["l_orderkey", "l_linenumber"]).withColumn(
            "l_shipdate", F.to_date("l_shipdate"))

    @cached_property
    def first_parts(self) -> DataFrame:
        """The smallest part number of every order that has lines."""
        return self._per_order.select("o_orderkey", "first_part")

    @cached_property
    def _per_order(self) -> DataFrame:
        """What an order's lines come to: the smallest part number and the supplier of the cheapest one."""
        return self.dealt("lineitem", "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.min("l_partkey").alias("first_part"),
            F.min(F.struct("l_extendedprice", "l_suppkey"))["l_suppkey"].alias("best_supplier"))

    @cached_property
    def decided(self) -> DataFrame:
        """Orders with the supplier of their cheapest line, if any."""
        return self._orders_to_join.join(_shuffled(self._per_order.select("o_orderkey", "best_supplier")), "o_orderkey", "left")

    # Silver

    @cached_property
    def departments(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("department_id"), F.col("n_name").alias("department_name"))

    @cached_property
    def suppliers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self.table("supplier").join(nation, "s_nationkey", "left").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
            F.col("n_name").alias("supplier_city"))

    @cached_property
    def cpv(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("cpv_code"), F.concat_ws(" ", "p_type", "p_name").alias("cpv_description"))

    @cached_property
    def projects(self) -> DataFrame:
        external = F.col("c_mktsegment").isin("MACHINERY", "AUTOMOBILE")
        planned = F.round(F.col("c_acctbal") * 100).cast("int")
        return _always_valid(self.table("customer").select(
            F.col("c_custkey").alias("project_id"), F.col("c_name").alias("project_name"),
            F.when(F.col("c_acctbal") > 0, "Active").otherwise("On hold").alias("project_status"),
            F.col("c_mktsegment").alias("funding_source"),
            F.when(external, "External").otherwise("City").alias("funding_type"),
            F.when(external, F.concat(F.lit("EU-"), F.substring("c_mktsegment", 1, 3))).alias("eu_program"),
            (F.lit(1995) + F.length("c_mktsegment")).cast("int").alias("year"),
            F.col("c_nationkey").alias("department_id"), F.col("c_nationkey").cast("bigint").alias("cpv_code"),
            planned.alias("planned_amount"),
            F.when(external, 0).otherwise(planned).cast("int").alias("city_share_amount"),
            F.when(external, planned).otherwise(0).cast("int").alias("external_share_amount"),
        ))

    @cached_property
    def plan(self) -> DataFrame:
        quarter = F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"), F.quarter("o_orderdate").cast("string"))
        return _always_valid(self._orders_to_join.join(_shuffled(self.first_parts), "o_orderkey").select(
            F.col("o_orderkey").alias("evidence_number"), F.col("first_part").alias("cpv_code"),
            quarter.alias("planned_quarter"), F.col("o_totalprice").alias("estimated_value")))

    @cached_property
    def procedures(self) -> DataFrame:
        raw = self.orders.select(
            F.col("o_orderkey").alias("procedure_id"), F.col("o_orderkey").alias("evidence_number"),
            F.col("o_custkey").alias("project_id"), F.col("o_orderpriority").alias("procedure_type"),
            F.col("o_orderstatus").alias("procedure_status"),
            date_to_serial("o_orderdate").alias("publication_date"),
            (date_to_serial("o_orderdate") + 30).alias("selection_decision_date"))
        return _always_valid(typed(raw, ENTITIES["procurement_procedures"]))

    @cached_property
    def bids(self) -> DataFrame:
        """One bid per (order, supplier); the cheapest wins unless the order is pending."""
        offers = self.dealt("lineitem", "l_orderkey").groupBy("l_orderkey", "l_suppkey").agg(
            F.min("l_extendedprice").alias("bid_amount"))
        decided = self.decided.select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "best_supplier")
        status = F.when(F.col("o_orderstatus") != "P", F.when(
            F.col("l_suppkey") == F.col("best_supplier"), AWARDED).otherwise("Rejected"))
        return _always_valid(offers.join(_shuffled(decided), "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_suppkey").alias("bid_id"), F.col("l_orderkey").alias("procedure_id"),
            F.col("l_suppkey").alias("supplier_id"), "bid_amount", status.alias("bid_status")))

    @cached_property
    def contracts(self) -> DataFrame:
        """Orders as contracts with history: pending for 30 days, then their final status."""
        start = F.col("o_orderdate").cast("timestamp")
        decided = F.date_add("o_orderdate", 30).cast("timestamp")
        never = F.lit(None).cast("timestamp")

        def version(status, begin, end):
            return F.struct(status.alias("contract_status"), begin.alias(START), end.alias(END))

        pending = F.lit("P")
        spans = F.when(F.col("o_orderstatus") == "P", F.array(version(pending, start, never))).otherwise(
            F.array(version(pending, start, decided), version(F.col("o_orderstatus"), decided, never)))
        raw = self.decided.select(
            F.col("o_orderkey").alias("contract_id"), F.col("o_custkey").alias("project_id"),
            F.col("o_orderpriority").alias("budget_item_id"), F.col("o_orderkey").alias("procedure_id"),
            F.col("best_supplier").alias("supplier_id"), F.col("o_totalprice").alias("contract_amount"),
            date_to_serial("o_orderdate").alias("signature_date"),
            (date_to_serial("o_orderdate") + 180).alias("contract_deadline"), F.inline(spans))
        return typed(raw, ENTITIES["contracts"])

    @cached_property
    def annexes(self) -> DataFrame:
        """Returned lines, with parts of cents; open ones change the amount but set no new deadline."""
        change = -F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)")
        raw = self.lines.filter(F.col("l_returnflag") == "R").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("annex_id"),
            F.col("l_orderkey").alias("contract_id"), change.cast("double").alias("amount_change"),
            date_to_serial("l_shipdate").alias("annex_date"),
            F.when(F.col("l_linestatus") == "F", date_to_serial("l_shipdate")).cast("double").alias("new_deadline"))
        return _always_valid(typed(raw, ENTITIES["contract_annexes"]))

    @cached_property
    def _headed(self) -> DataFrame:
        """Lines with the headers of their order: one for each row that the orders have of it, null without any."""
        headers = self._orders_to_join.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(
            F.collect_list(F.struct("o_custkey", "o_orderdate")).alias("headers"))
        return self.lines.join(_shuffled(headers), "l_orderkey", "left")

    @cached_property
    def _lines_by_order(self) -> DataFrame:
        return self.lines

    @cached_property
    def _billed(self) -> DataFrame:
        header = self.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
        return self.lines.join(header, "l_orderkey")

    @cached_property
    def purchase_orders(self) -> DataFrame:
        per_supplier = self._lines_by_order.groupBy("l_orderkey", "l_suppkey").agg(
            F.min("l_shipdate").alias("d"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("order_amount"))
        header = self.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        raw = per_supplier.join(header, "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_suppkey").alias("purchase_order_id"),
            F.col("l_orderkey").alias("contract_id"), F.col("o_custkey").alias("project_id"),
            date_to_serial("d").alias("order_date"), "order_amount",
            F.concat(F.lit("Supply from "), F.col("l_suppkey").cast("string")).alias("order_description"))
        return _always_valid(typed(raw, ENTITIES["purchase_orders"]))

    @cached_property
    def raw_invoices(self) -> DataFrame:
        """Invoices as exported: serial dates, an empty payment date when unpaid."""
        paid = F.col("l_linestatus") == "F"
        return self._billed.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("invoice_id"),
            F.concat_ws("-", "l_orderkey", "l_suppkey").alias("purchase_order_id"),
            F.col("l_orderkey").alias("contract_id"), F.col("o_custkey").alias("project_id"),
            date_to_serial("o_orderdate").alias("issue_date"), (date_to_serial("o_orderdate") + 60).alias("due_date"),
            F.when(paid, date_to_serial("l_shipdate")).cast("double").alias("payment_date"),
            F.col("l_extendedprice").alias("invoice_amount"), F.lit("EUR").alias("currency"),
            F.when(paid, PAID).otherwise(UNPAID).alias("payment_status"))

    @cached_property
    def invoices(self) -> DataFrame:
        return _always_valid(typed(self.raw_invoices, ENTITIES["invoices"], AS_OF))

    # Gold

    @cached_property
    def gold(self) -> GoldTables:
        return GoldTables(self)

    def store_shared(self) -> SampleModel:
        """Store the parts that several silver tables are made of, before any of those is built: lines without copies, with their orders'
        headers, and orders with their cheapest supplier and first part. Each is then shuffled once, however many tables read it."""
        if self._shared:
            return self
        self._shared, base = True, scratch_dir(self.spark, "shared")

        def keep(name: str, df: DataFrame) -> DataFrame:
            write_gold(df, f"{base}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{base}/{name}")

        def lines() -> None:
            if self.has_hot("orders", "o_orderkey") or self.has_hot("lineitem", "l_orderkey"):  # its rows must not meet in one task
                self.lines = keep("lines", self.lines)
                return
            headed = keep("lines", self._headed)
            self.lines = headed.drop("headers")
            self._billed = headed.select(*self.lines.columns, F.inline("headers"))
            self._lines_by_order = self.lines.repartition("l_orderkey")  # for a group and a join

        def orders() -> None:
            self._per_order = keep("per_order", self._per_order)
            self.decided = keep("decided", self.decided)

        gold.side_by_side(self.spark, [lines, orders])
        return self

    @cached_property
    def stored_gold(self) -> GoldTables:
        """Gold for queries that read one table several times; no table is computed twice."""
        return GoldTables(self.store_shared(), scratch_dir(self.spark, "gold"))

    def gold_storing(self, *names: str) -> GoldTables:
        """Gold of which only the named tables are stored: those that a query reads twice."""
        return GoldTables(self, scratch_dir(self.spark, "gold"), names)

    # Snapshots

    @cached_property
    def _export_bounds(self) -> tuple[int, int]:
        """First and last year with orders; one small aggregate. Without orders one year stands in."""
        first, last = self.orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
        return (first, last) if first is not None else (2000, 2000)

    @property
    def export_years(self) -> tuple[int, ...]:
        """The years that have a year-end export."""
        return tuple(range(self._export_bounds[0], self._export_bounds[1] + 1))

    @cached_property
    def snapshots(self) -> DataFrame:
        """Year-end exports of the order register.

        An order enters in its year as pending. Low-priority orders are missing from the
        next export and return in the one after; high-priority orders leave for good after
        two years. Unspecified ones have no amount in their first export. The rescued
        column differs in every export and must open no version.
        """
        year, at, priority = F.year("o_orderdate"), F.col("_y"), F.col("o_orderpriority")
        first = at == year
        exported = self.orders.withColumn("_y", F.explode(F.sequence(*map(F.lit, self._export_bounds)))).filter(
            (year <= at) & ~((priority == "5-LOW") & (at == year + 1)) & ~((priority == "2-HIGH") & (at >= year + 2)))
        return exported.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.when(first, "P").otherwise(F.col("o_orderstatus")).alias("status"),
            F.when(~(first & (priority == "4-NOT SPECIFIED")), F.col("o_totalprice")).alias("amount"),
            F.concat(F.lit("run "), at.cast("string")).alias(RESCUED),
            F.make_timestamp(at, F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias(SNAPSHOT_TS))

    def snapshot(self, year: int) -> DataFrame:
        return self.snapshots.filter(F.col(SNAPSHOT_TS) == F.lit(f"{year}-12-31").cast("timestamp"))

"""The star schema: seven dimensions, six facts, three KPI views.

Every function takes the tables it reads as DataFrames and returns a lazy DataFrame, so
a caller may chain them in one plan or write each one between steps. Amounts are added
as exact decimals and leave as doubles.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MONEY, AWARDED, exact, guarded_ratio, money
from ..operators.snapshots import current
from ..sources.calendars import dim_date
from ..sources.landing import write_gold

# The columns of the tables.
DEPARTMENT = ["department_id", "department_name"]
SUPPLIER = ["supplier_id", "supplier_name", "supplier_city"]
CPV = ["cpv_code", "cpv_description"]
PROJECT = ["project_id", "project_name", "project_status", "funding_source", "funding_type", "eu_program",
           "year", "department_id", "cpv_code"]
CONTRACT = ["contract_id", "project_id", "budget_item_id", "procedure_id", "supplier_id", "signature_date",
            "contract_deadline", "contract_status"]
INVOICE = ["invoice_id", "purchase_order_id", "contract_id", "project_id", "issue_date", "due_date",
           "payment_date", "invoice_amount", "currency", "payment_status", "invoice_status", "days_late"]


def _or_zero(c: str) -> Column:
    return money(F.coalesce(F.col(c), F.lit(0))).cast("double").alias(c)


def _count_or_zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)


def dim_department(departments: DataFrame) -> DataFrame:
    return departments.select(*DEPARTMENT)


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(*SUPPLIER)


def dim_cpv(cpv: DataFrame) -> DataFrame:
    return cpv.select(*CPV)


def dim_project(projects: DataFrame) -> DataFrame:
    return current(projects).select(*PROJECT)


def annex_totals(annexes: DataFrame) -> DataFrame:
    """Latest deadline, summed change and number of annexes per contract, in one aggregate."""
    return current(annexes).groupBy("contract_id").agg(
        F.max("new_deadline").alias("annex_deadline"),
        F.sum(exact("amount_change")).alias("annex_sum"),
        F.count(F.lit(1)).alias("annex_count"),
    )


def dim_contract(contracts: DataFrame, annexes: DataFrame) -> DataFrame:
    """Contracts with the deadline in force: the latest annex deadline, else the signed one."""
    deadline = F.coalesce("annex_deadline", "contract_deadline").alias("current_deadline")
    return current(contracts).join(annex_totals(annexes), "contract_id", "left").select(*CONTRACT, deadline)


def dim_procedure(procedures: DataFrame, plan: DataFrame) -> DataFrame:
    """Procedures with the category and quarter of their plan item, if there is one."""
    planned = current(plan).select("evidence_number", "cpv_code", "planned_quarter")
    return current(procedures).join(planned, "evidence_number", "left").select(
        "evidence_number", "procedure_id", "project_id", "procedure_type", "publication_date",
        "selection_decision_date", "procedure_status", "cpv_code", "planned_quarter",
    )


def fact_invoices(invoices: DataFrame) -> DataFrame:
    return current(invoices).withColumn("invoice_amount", money("invoice_amount")).select(*INVOICE)


def fact_purchase_orders(orders: DataFrame) -> DataFrame:
    return current(orders).select(
        "purchase_order_id", "contract_id", "project_id", "order_date",
        money("order_amount").alias("order_amount"), "order_description",
    )


def fact_contract_financials(contracts: DataFrame, annexes: DataFrame) -> DataFrame:
    """Contract amount, annex adjustments and their total."""
    change = F.coalesce(F.col("annex_sum"), F.lit(0).cast(MONEY))
    return current(contracts).join(annex_totals(annexes), "contract_id", "left").select(
        "contract_id",
        money("contract_amount").alias("contract_amount"),
        money(change).cast("double").alias("total_annex_adjustments"),
        _count_or_zero("annex_count"),
        money(exact("contract_amount") + change).cast("double").alias("total_contract_value"),
    )


def fact_procurement_bids(bids: DataFrame, awarded: str = AWARDED) -> DataFrame:
    """Every bid with its award flag; a missing status leaves the flag null."""
    return current(bids).select(
        "bid_id", "procedure_id", "supplier_id", money("bid_amount").alias("bid_amount"), "bid_status",
        (F.col("bid_status") == F.lit(awarded)).alias("is_awarded"),
    )


def fact_procurement_performance(plan: DataFrame, procedures: DataFrame, bids: DataFrame) -> DataFrame:
    """Planned procedures with award, bid count and savings; savings are null without an award.

    More than one awarded bid repeats the procedure, which the uniqueness gate reports.
    """
    numbers = current(plan).select("evidence_number", "estimated_value").join(
        current(procedures).select("evidence_number", "procedure_id"), "evidence_number")
    # One pass over the bids: their number, and the awarded ones, of which a procedure has one.
    award = F.when(F.col("is_awarded"), F.struct(
        F.col("supplier_id").alias("awarded_supplier_id"), F.col("bid_amount").alias("awarded_bid_amount")))
    offers = bids.groupBy("procedure_id").agg(F.count(F.lit(1)).alias("bid_count"), F.collect_list(award).alias("_awards"))
    saved = money(exact("estimated_value") - exact("awarded_bid_amount")).cast("double")
    opened = numbers.join(offers, "procedure_id", "left").select("*", F.explode_outer("_awards").alias("_award"))
    return opened.select("*", "_award.awarded_supplier_id", "_award.awarded_bid_amount").select(
        "procedure_id",
        money("estimated_value").alias("estimated_value"),
        "awarded_supplier_id",
        money("awarded_bid_amount").alias("awarded_bid_amount"),
        _count_or_zero("bid_count"),
        saved.alias("procurement_savings"),
    )


def fact_project_financials(
    projects: DataFrame, contract_financials: DataFrame, contracts: DataFrame, invoices: DataFrame
) -> DataFrame:
    """Plan, contracted, invoiced and paid amounts per project; zero where nothing exists.

    ``contracts`` needs contract_id and project_id. Invoiced and paid amounts come from
    one pass, and both sides are reduced to one row per project before they join.
    """
    contracted = contract_financials.join(contracts.select("contract_id", "project_id"), "contract_id").groupBy(
        "project_id").agg(
            F.sum(exact("total_contract_value")).alias("total_contracted_value"),
            F.count(F.lit(1)).alias("contract_count"),
        )
    paid = F.when(F.col("payment_date").isNotNull(), exact("invoice_amount"))
    billed = current(invoices).groupBy("project_id").agg(
        F.sum(exact("invoice_amount")).alias("total_invoiced_amount"), F.sum(paid).alias("total_paid_amount"))
    planned = ["planned_amount", "city_share_amount", "external_share_amount"]
    return (
        current(projects).select("project_id", *[money(c).alias(c) for c in planned])
        .join(contracted, "project_id", "left").join(billed, "project_id", "left")
        .select(
            "project_id", *planned, _or_zero("total_contracted_value"), _count_or_zero("contract_count"),
            _or_zero("total_invoiced_amount"), _or_zero("total_paid_amount"),
        )
    )


def mv_procurement_savings_kpi(
    performance: DataFrame, procedures: DataFrame, projects: DataFrame,
    departments: DataFrame, cpv: DataFrame, suppliers: DataFrame,
) -> DataFrame:
    """Savings per procedure with every descriptive column beside it."""
    winner = suppliers.select(
        F.col("supplier_id").alias("awarded_supplier_id"), F.col("supplier_name").alias("awarded_supplier_name"))
    described = (
        performance
        .join(procedures.select("procedure_id", "evidence_number", "project_id", "cpv_code"), "procedure_id", "left")
        .join(projects.select("project_id", "project_name", "department_id"), "project_id", "left")
        .join(departments, "department_id", "left")
        .join(cpv, "cpv_code", "left")
        .join(winner, "awarded_supplier_id", "left")
    )
    return described.select(
        "procedure_id", "evidence_number", "project_id", "project_name", *DEPARTMENT, *CPV,
        "estimated_value", "awarded_bid_amount", "awarded_supplier_name", "procurement_savings",
        guarded_ratio("procurement_savings", "estimated_value").alias("savings_pct"), "bid_count",
    )


def mv_project_realization_kpi(
    financials: DataFrame, projects: DataFrame, departments: DataFrame,
    realized_over: str = "total_contracted_value", eu_share_over: str = "total_contracted_value",
) -> DataFrame:
    """Realization, contracted and external shares per project.

    The two denominators are parameters because descriptions of these shares differ on
    them; the defaults give the figures the reports show.
    """
    about = projects.select("project_id", "project_name", "project_status", "funding_source", "eu_program",
                            "year", "department_id")
    return financials.join(about, "project_id", "left").join(departments, "department_id", "left").select(
        "project_id", "project_name", "project_status", *DEPARTMENT, "funding_source", "eu_program", "year",
        "planned_amount", "city_share_amount", "external_share_amount", "total_contracted_value",
        "contract_count", "total_invoiced_amount", "total_paid_amount",
        guarded_ratio("total_paid_amount", realized_over).alias("realization_pct"),
        guarded_ratio("total_contracted_value", "planned_amount").alias("contracted_pct"),
        guarded_ratio("external_share_amount", eu_share_over).alias("eu_share_pct"),
    )


def mv_avg_payment_delay_kpi(invoices: DataFrame, projects: DataFrame, departments: DataFrame) -> DataFrame:
    """Paid invoices and their average delay per department; none paid, no row.

    Invoices shrink to one row per project before any join. Unknown projects or
    departments form a null group.
    """
    per_project = invoices.filter(F.col("payment_date").isNotNull()).groupBy("project_id").agg(
        F.count("invoice_id").alias("_n"), F.count("days_late").alias("_known"),
        F.sum(F.col("days_late").cast("bigint")).alias("_days"))
    placed = per_project.join(projects.select("project_id", "department_id"), "project_id", "left").join(
        departments, "department_id", "left")
    return placed.groupBy(*DEPARTMENT).agg(
        F.sum("_n").alias("paid_invoice_count"),
        guarded_ratio(F.sum("_days"), F.sum("_known"), 2).alias("avg_days_late"),
    )


# Tables that need no other gold table, those that need these, and so on.
WAVES = (
    ("fact_invoices", "fact_procurement_bids", "fact_contract_financials", "dim_contract", "dim_procedure", "fact_purchase_orders", "dim_project",
     "dim_department", "dim_supplier", "dim_cpv", "dim_date"),
    ("fact_procurement_performance", "fact_project_financials", "mv_avg_payment_delay_kpi"),
    ("mv_procurement_savings_kpi", "mv_project_realization_kpi"),
)


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]], at_once: int = 4) -> None:
    """Run driver-side calls that start Spark jobs a few at a time, so that small jobs don't wait for each other."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


def build_gold(spark: SparkSession, silver: Mapping[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Write all 16 tables below ``out``, each read back before another one uses it; independent ones are written side by side."""
    gold: dict[str, DataFrame] = {}
    s = silver
    makers: dict[str, Callable[[], DataFrame]] = {
        "dim_department": lambda: dim_department(s["department_lookup"]),
        "dim_supplier": lambda: dim_supplier(s["supplier_lookup"]),
        "dim_cpv": lambda: dim_cpv(s["cpv_lookup"]),
        "dim_date": lambda: dim_date(spark),
        "dim_project": lambda: dim_project(s["projects"]),
        "dim_contract": lambda: dim_contract(s["contracts"], s["contract_annexes"]),
        "dim_procedure": lambda: dim_procedure(s["procurement_procedures"], s["procurement_plan"]),
        "fact_invoices": lambda: fact_invoices(s["invoices"]),
        "fact_purchase_orders": lambda: fact_purchase_orders(s["purchase_orders"]),
        "fact_contract_financials": lambda: fact_contract_financials(s["contracts"], s["contract_annexes"]),
        "fact_procurement_bids": lambda: fact_procurement_bids(s["procurement_bids"]),
        "fact_procurement_performance": lambda: fact_procurement_performance(
            s["procurement_plan"], s["procurement_procedures"], gold["fact_procurement_bids"]),
        "fact_project_financials": lambda: fact_project_financials(
            s["projects"], gold["fact_contract_financials"], gold["dim_contract"], s["invoices"]),
        "mv_procurement_savings_kpi": lambda: mv_procurement_savings_kpi(
            gold["fact_procurement_performance"], gold["dim_procedure"], gold["dim_project"], gold["dim_department"],
            gold["dim_cpv"], gold["dim_supplier"]),
        "mv_project_realization_kpi": lambda: mv_project_realization_kpi(
            gold["fact_project_financials"], gold["dim_project"], gold["dim_department"]),
        "mv_avg_payment_delay_kpi": lambda: mv_avg_payment_delay_kpi(
            gold["fact_invoices"], gold["dim_project"], gold["dim_department"]),
    }

    def keep(name: str) -> None:
        table = makers[name]()
        write_gold(table, f"{out}/{name}")
        gold[name] = spark.read.schema(table.schema).parquet(f"{out}/{name}")

    for wave in WAVES:
        side_by_side(spark, [lambda n=name: keep(n) for name in wave])
    return {name: gold[name] for name in makers}

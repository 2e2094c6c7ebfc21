"""Report pages and questions over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AWARDED, exact, exact_sum, guarded_ratio, money
from ..functions.measures import count_other_than, selected_value
from ..operators.matrix import drill_matrix, ratio_of_sums
from ..operators.relations import related
from ..operators.snapshots import slice_by


def savings_matrix(savings: DataFrame, bids: DataFrame, awarded: str = AWARDED) -> DataFrame:
    """Project, plan item, procedure, bid: bid totals, awarded and rejected amounts, savings.

    Bids shrink to one row per procedure before they are expanded to the depths above; the rows of single bids are added as they
    are. Both come from one join, whose exchanges they share.
    """
    levels = ["project_id", "evidence_number", "procedure_id"]
    # A procedure with several awards has several rows, each of which counts with all bids.
    plans = savings.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(exact("estimated_value")).alias("_estimated"), F.sum(exact("procurement_savings")).alias("_saved"))
    facts = bids.select("procedure_id", "bid_id", "bid_amount", "bid_status").join(plans, "procedure_id")
    won = F.col("bid_status") == F.lit(awarded)
    offered = exact("bid_amount") * F.col("_rows")

    def shown(one: Column, all_won: Column) -> list[Column]:
        return [F.when(all_won, one).alias("awarded_bid_amount"), F.when(~all_won, one).alias("rejected_bid_amount")]

    sums = facts.groupBy(*levels).agg(
        F.sum(offered).alias("_offered"), F.sum(F.when(won, F.col("_estimated"))).alias("_estimated"), F.sum(F.when(won, F.col("_saved"))).alias("_saved"),
        F.count(F.lit(1)).alias("_n"), F.count_if(won).alias("_won"), F.min("bid_amount").alias("_low"), F.max("bid_amount").alias("_high"),
        F.count("bid_amount").alias("_known"))
    one = F.when(F.min("_low").eqNullSafe(F.max("_high")) & (F.sum("_known") == F.sum("_n")), F.max("_high"))
    total = lambda c: money(F.sum(c)).cast("double")
    awarded_amounts = dict(zip(("awarded_bid_amount", "rejected_bid_amount"), shown(one, F.sum("_won") == F.sum("_n"))))
    totals = drill_matrix(sums, levels, {
        "bid_amount_sum": total("_offered"), "estimated_value_awarded": total("_estimated"), **awarded_amounts, "procurement_savings_awarded": total("_saved")},
        summed=True)
    is_won = F.coalesce(won, F.lit(False))
    leaves = facts.select(
        F.lit(len(levels) + 1).cast("bigint").alias("level"), *levels, "bid_id", money(offered).cast("double").alias("bid_amount_sum"),
        F.when(is_won, money("_estimated").cast("double")).alias("estimated_value_awarded"), *shown(F.col("bid_amount"), is_won),
        F.when(is_won, money("_saved").cast("double")).alias("procurement_savings_awarded"))
    return leaves.unionByName(totals.withColumn("bid_id", F.lit(None).cast(bids.schema["bid_id"].dataType)))


def savings_cards(savings: DataFrame, bids: DataFrame, awarded: str = AWARDED) -> DataFrame:
    """Per project: savings, procedures with a bid count, the percentage if it is one, rejected bids."""
    refused = bids.groupBy("procedure_id").agg(count_other_than("bid_status", awarded).alias("_refused"))
    return savings.join(refused, "procedure_id", "left").groupBy("project_id").agg(
        exact_sum("procurement_savings").alias("procurement_savings"),
        F.count("bid_count").alias("bid_count_non_null"),
        selected_value("savings_pct").alias("savings_pct"),
        F.sum("_refused").alias("rejected_bid_count"),
    ).orderBy(F.col("procurement_savings").desc_nulls_last(), "project_id")


def realization_matrix(realization: DataFrame, savings: DataFrame) -> DataFrame:
    """Department, project, procedure: planned to paid amounts, awarded bids, shares.

    Project amounts count once per project at every depth; a procedure row shows those
    of its project. ``sum_*`` adds the stored shares as the report does, the plain names
    are ratios of sums, which stay right on subtotals.
    """
    awards = savings.groupBy("project_id", "procedure_id").agg(F.sum(exact("awarded_bid_amount")).alias("awarded_bid"))
    per_procedure = awards.withColumn("awarded_bid", money("awarded_bid").cast("double"))
    per_project = awards.groupBy("project_id").agg(exact_sum("awarded_bid").alias("awarded_bid"))
    amounts = ["planned_amount", "total_contracted_value", "total_invoiced_amount", "total_paid_amount",
               "external_share_amount"]
    shares = ["eu_share_pct", "contracted_pct"]
    base = realization.select("department_id", "project_id", *amounts, *shares)
    totals = drill_matrix(base.join(per_project, "project_id", "left"), ["department_id", "project_id"], {
        **{c: exact_sum(c) for c in [*amounts, "awarded_bid"]},
        **{f"sum_{c}": F.round(F.sum(F.col(c).cast("decimal(18,4)")).cast("double"), 4) for c in shares},
    }).withColumn("procedure_id", F.lit(None).cast(savings.schema["procedure_id"].dataType))
    leaves = per_procedure.join(base, "project_id").withColumn(
        "level", F.lit(3).cast("bigint")).withColumnsRenamed({c: f"sum_{c}" for c in shares})
    both = totals.unionByName(leaves.select(*totals.columns))
    return both.select(
        "level", "department_id", "project_id", "procedure_id",
        *[F.col(c).cast("double").alias(c) for c in amounts[:4]], "awarded_bid",
        *[f"sum_{c}" for c in shares],
        guarded_ratio("external_share_amount", "total_contracted_value").alias("eu_share_pct"),
        guarded_ratio("total_contracted_value", "planned_amount").alias("contracted_pct"),
    )


def realization_cards(realization: DataFrame) -> DataFrame:
    """Per project: smallest status, program and department, summed realization share."""
    return realization.groupBy("project_id").agg(
        F.min("project_status").alias("project_status"),
        F.min("eu_program").alias("eu_program"),
        F.min("department_id").alias("department_id"),
        F.sum(F.col("realization_pct").cast("decimal(18,4)")).cast("double").alias("realization_pct"),
    ).orderBy("project_status", "project_id")


def invoice_drilldown(
    invoices: DataFrame, purchase_orders: DataFrame, contracts: DataFrame, projects: DataFrame
) -> DataFrame:
    """Department, project, contract, purchase order, invoice, along the order's chain of keys.

    The chain is made from its far end, of the smaller tables; invoices move once.
    """
    placed = related(contracts.select("contract_id", "project_id"), projects, "project_id", "department_id")
    ordered = related(purchase_orders.select("purchase_order_id", "contract_id"), placed, "contract_id", "project_id", "department_id")
    return _invoice_levels(related(_billed(invoices), ordered, "purchase_order_id", "contract_id", "project_id", "department_id"))


def _billed(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "invoice_id", "purchase_order_id", "invoice_amount", "payment_status", "invoice_status", "days_late")


def _invoice_levels(chain: DataFrame) -> DataFrame:
    """Invoices as they are, and totals of every depth above from one sum per purchase order.

    Invoice ids are unique, so only the sums are expanded to the depths of the drill path.
    """
    levels = ["department_id", "project_id", "contract_id", "purchase_order_id"]
    sums = chain.groupBy(*levels).agg(
        F.sum(exact("invoice_amount")).alias("invoice_amount"), F.min("payment_status").alias("payment_status"),
        F.min("invoice_status").alias("invoice_status"), F.sum(F.col("days_late").cast("bigint")).alias("days_late"))
    totals = drill_matrix(sums, levels, {
        "invoice_amount": money(F.sum("invoice_amount")).cast("double"), "payment_status": F.min("payment_status"),
        "invoice_status": F.min("invoice_status"), "days_late": F.sum("days_late")}, summed=True)
    leaves = chain.withColumn("level", F.lit(len(levels) + 1).cast("bigint")).withColumns({
        "days_late": F.col("days_late").cast("bigint"), "invoice_amount": exact("invoice_amount").cast("double")})
    both = totals.withColumn("invoice_id", F.lit(None).cast(chain.schema["invoice_id"].dataType)).unionByName(
        leaves.select("level", *levels, "invoice_amount", "payment_status", "invoice_status", "days_late", "invoice_id"))
    return both.select("level", *levels, "invoice_id", "invoice_amount", "payment_status", "invoice_status", "days_late")


def drillthrough(
    department: object, invoices: DataFrame, purchase_orders: DataFrame, contracts: DataFrame, projects: DataFrame
) -> DataFrame:
    """The invoice drill-down of one department; its projects are selected before any join."""
    chosen = slice_by(projects, "department_id", [department]).select("department_id", "project_id")
    kept = chosen.join(contracts.select("contract_id", "project_id"), "project_id")
    ordered = kept.join(purchase_orders.select("purchase_order_id", "contract_id"), "contract_id")
    return _invoice_levels(ordered.join(_billed(invoices), "purchase_order_id"))


def savings_pct_by_department(savings: DataFrame) -> DataFrame:
    """Savings share per department as a ratio of sums."""
    return ratio_of_sums(savings, ["department_id", "department_name"], "procurement_savings", "estimated_value",
                         "savings_pct")


def worst_department(savings: DataFrame, projects: DataFrame, year: int) -> DataFrame:
    """The department with the lowest savings share among one planning year's projects."""
    of_year = projects.filter(F.col("year") == year).select("project_id")
    rated = savings_pct_by_department(savings.join(of_year, "project_id"))
    return rated.filter(F.col("savings_pct").isNotNull()).orderBy("savings_pct", "department_id").limit(1)


def supplier_win_rate(bids: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Bids, wins and win rate per supplier; bids are counted before the lookup."""
    counted = bids.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("bid_count"), F.count_if(F.col("is_awarded")).alias("wins"))
    return counted.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id", "left").select(
        "supplier_id", "supplier_name", "bid_count", "wins", guarded_ratio("wins", "bid_count").alias("win_rate"),
    ).orderBy(F.col("wins").desc(), "supplier_id")


def invoices_by_month(invoices: DataFrame, calendar: DataFrame, date_column: str = "due_date") -> DataFrame:
    """Invoice count and amount per month of the chosen date role.

    Invoices collapse to one row per day before they meet the calendar.
    """
    per_day = invoices.groupBy(F.col(date_column).alias("date")).agg(
        F.count(F.lit(1)).alias("_n"), exact_sum("invoice_amount").alias("_v"))
    return per_day.join(calendar.select("date", "year", "month", "month_name"), "date").groupBy(
        "year", "month", "month_name").agg(
            F.sum("_n").alias("invoice_count"), exact_sum("_v").alias("invoice_amount"))

"""Declared metadata of the 16 gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from ..operators.relations import Relationship
from ..operators.surface import TableMeta

# What columns mean beyond their names. One meaning holds wherever a column of that name occurs, unless the table has its own.
COLUMNS: Mapping[str, str] = {
    "cpv_code": "procurement category", "cpv_description": "the category in words", "date": "calendar day", "is_weekend": "Saturday or Sunday",
    "eu_program": "European program that pays, null for the city's own projects", "planned_quarter": "quarter the purchase was planned for, such as 1998-Q2",
    "evidence_number": "item of the procurement plan", "contract_deadline": "deadline as signed", "current_deadline": "deadline in force after all annexes",
    "payment_date": "null while unpaid", "invoice_status": "payment status, or Overdue if unpaid after the due date",
    "days_late": "days from due date to payment; null while unpaid, negative if paid early", "order_amount": "amount of the order in euro",
    "invoice_amount": "amount of the invoice", "contract_amount": "amount as signed", "total_annex_adjustments": "sum of all annexes, zero without any",
    "annex_count": "number of annexes", "total_contract_value": "signed amount and all annexes", "is_awarded": "whether the bid won; null without a status",
    "estimated_value": "planned value of the procedure", "awarded_bid_amount": "amount of the winning bid, null without one",
    "awarded_supplier_id": "supplier of the winning bid", "awarded_supplier_name": "name of the winning supplier", "bid_count": "number of bids, zero without any",
    "procurement_savings": "estimate less winning bid; null without an award, negative if dearer",
    "savings_pct": "savings over the estimate; roll up as a ratio of sums", "planned_amount": "planned cost of the project",
    "city_share_amount": "part of the plan the city pays", "external_share_amount": "part of the plan others pay", "contract_count": "number of contracts, zero without any",
    "total_contracted_value": "value of all contracts with annexes", "total_invoiced_amount": "all invoices", "total_paid_amount": "invoices with a payment date",
    "realization_pct": "paid over contracted; null if nothing is contracted", "contracted_pct": "contracted over planned",
    "eu_share_pct": "external share over contracted", "paid_invoice_count": "invoices with a payment date", "avg_days_late": "mean of days late over paid invoices",
}

# name, kind, primary key, grain, description, foreign keys (column -> table, column)
GOLD_TABLES = tuple(
    TableMeta(name, kind, grain, description, key, refs, COLUMNS)
    for name, kind, key, grain, description, refs in (
        ("dim_department", "dimension", "department_id", "one row per department", "Departments.", {}),
        ("dim_supplier", "dimension", "supplier_id", "one row per supplier", "Suppliers and their city.", {}),
        ("dim_cpv", "dimension", "cpv_code", "one row per category code", "Procurement categories.", {}),
        ("dim_date", "dimension", "date", "one row per day", "Calendar for any date column of a fact.", {}),
        ("dim_project", "dimension", "project_id", "one row per project",
         "Projects with funding, planning year, department and category.",
         {"department_id": ("dim_department", "department_id"), "cpv_code": ("dim_cpv", "cpv_code")}),
        ("dim_contract", "dimension", "contract_id", "one row per contract",
         "Contracts; the current deadline accounts for annexes.",
         {"project_id": ("dim_project", "project_id"), "procedure_id": ("dim_procedure", "procedure_id"),
          "supplier_id": ("dim_supplier", "supplier_id")}),
        ("dim_procedure", "dimension", "procedure_id", "one row per procedure",
         "Procurement procedures with their plan item's category and quarter.",
         {"project_id": ("dim_project", "project_id"), "cpv_code": ("dim_cpv", "cpv_code")}),
        ("fact_invoices", "fact", "invoice_id", "one row per invoice",
         "Invoices with three dates, status and days late.",
         {"purchase_order_id": ("fact_purchase_orders", "purchase_order_id"),
          "contract_id": ("dim_contract", "contract_id"), "project_id": ("dim_project", "project_id")}),
        ("fact_purchase_orders", "fact", "purchase_order_id", "one row per purchase order", "Purchase orders.",
         {"contract_id": ("dim_contract", "contract_id"), "project_id": ("dim_project", "project_id")}),
        ("fact_contract_financials", "fact", "contract_id", "one row per contract",
         "Contract amount, annex changes and their total.", {"contract_id": ("dim_contract", "contract_id")}),
        ("fact_procurement_bids", "fact", "bid_id", "one row per bid",
         "All bids with an award flag, for win rates by supplier.",
         {"procedure_id": ("dim_procedure", "procedure_id"), "supplier_id": ("dim_supplier", "supplier_id")}),
        ("fact_procurement_performance", "fact", "procedure_id", "one row per planned procedure",
         "Estimate, award, bid count and savings; roll a rate up as a ratio of sums.",
         {"procedure_id": ("dim_procedure", "procedure_id"), "awarded_supplier_id": ("dim_supplier", "supplier_id")}),
        ("fact_project_financials", "fact", "project_id", "one row per project",
         "Planned, contracted, invoiced and paid amounts.", {"project_id": ("dim_project", "project_id")}),
        ("mv_procurement_savings_kpi", "kpi_view", "procedure_id", "one row per planned procedure",
         "Savings with all descriptions; never average the percentage.",
         {"project_id": ("dim_project", "project_id"), "department_id": ("dim_department", "department_id"),
          "cpv_code": ("dim_cpv", "cpv_code")}),
        ("mv_project_realization_kpi", "kpi_view", "project_id", "one row per project",
         "Realization, contracted and external shares; never average them.",
         {"department_id": ("dim_department", "department_id")}),
        ("mv_avg_payment_delay_kpi", "kpi_view", "department_id", "one row per department with paid invoices",
         "Paid invoices and average days late.", {"department_id": ("dim_department", "department_id")}),
    )
)
PRIMARY_KEYS = {m.name: m.primary_key for m in GOLD_TABLES}

# Active relationships of the report model, as a tree; the payment delay by department joins it at its department.
# From table and column, to table and column, whether selections travel both ways.
RELATIONSHIPS = tuple(
    Relationship(*r)
    for r in (
        ("fact_procurement_bids", "procedure_id", "mv_procurement_savings_kpi", "procedure_id", False),
        ("fact_procurement_performance", "procedure_id", "mv_procurement_savings_kpi", "procedure_id", True),
        ("fact_project_financials", "project_id", "mv_project_realization_kpi", "project_id", True),
        ("dim_project", "project_id", "mv_project_realization_kpi", "project_id", True),
        ("dim_project", "department_id", "dim_department", "department_id", False),
        ("dim_contract", "contract_id", "fact_contract_financials", "contract_id", True),
        ("fact_procurement_bids", "procedure_id", "dim_procedure", "procedure_id", False),
        ("dim_contract", "supplier_id", "dim_supplier", "supplier_id", False),
        ("dim_project", "cpv_code", "dim_cpv", "cpv_code", False),
        ("fact_invoices", "purchase_order_id", "fact_purchase_orders", "purchase_order_id", False),
        ("dim_project", "project_id", "dim_contract", "project_id", True),
        ("fact_purchase_orders", "contract_id", "dim_contract", "contract_id", False),
        ("fact_invoices", "due_date", "dim_date", "date", False),
        ("mv_procurement_savings_kpi", "project_id", "mv_project_realization_kpi", "project_id", True),
        ("mv_avg_payment_delay_kpi", "department_id", "dim_department", "department_id", False),
    )
)

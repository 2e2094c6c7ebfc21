from datetime import date

import pytest
from pyspark.sql import functions as F

from snapstar.operators.quality import ExpectationFailed, require, uniqueness
from snapstar.operators.snapshots import END
from snapstar.plans import gold, report


@pytest.fixture(scope="module")
def live(spark):
    """Build a frame of open versions from rows."""

    def make(rows, schema, closed=()):
        df = spark.createDataFrame(list(rows), schema).withColumn(END, F.lit(None).cast("timestamp"))
        if closed:
            old = spark.createDataFrame(list(closed), schema).withColumn(END, F.lit("2020-01-01").cast("timestamp"))
            df = df.unionByName(old)
        return df

    return make


CONTRACT = ("contract_id string, project_id string, budget_item_id string, procedure_id string, supplier_id string, "
            "signature_date date, contract_deadline date, contract_status string, contract_amount double")
D = date(2024, 5, 1)


@pytest.fixture(scope="module")
def contracts(live):
    rows = [(c, "P1", "B", "Q", "S", D, D, "open", 100.10) for c in ("C0", "C1", "C2", "C3")]
    return live(rows, CONTRACT, closed=[("C0", "P1", "B", "Q", "S", D, D, "draft", 1.0)])


@pytest.fixture(scope="module")
def annexes(live):
    return live(
        [("C1", date(2024, 6, 1), 10.05), ("C2", date(2024, 7, 1), -0.1), ("C2", date(2024, 6, 15), -0.2),
         ("C3", None, 5.0)],
        "contract_id string, new_deadline date, amount_change double", closed=[("C0", date(2030, 1, 1), 999.0)])


def test_contract_deadlines(contracts, annexes):
    got = {r["contract_id"]: r["current_deadline"] for r in gold.dim_contract(contracts, annexes).collect()}
    assert got == {"C0": D, "C1": date(2024, 6, 1), "C2": date(2024, 7, 1), "C3": D}


def test_contract_financials(contracts, annexes):
    got = {r[0]: tuple(r)[1:] for r in gold.fact_contract_financials(contracts, annexes).collect()}
    assert got == {"C0": (100.1, 0.0, 0, 100.1), "C1": (100.1, 10.05, 1, 110.15), "C2": (100.1, -0.3, 2, 99.8),
                   "C3": (100.1, 5.0, 1, 105.1)}


@pytest.fixture(scope="module")
def procurement(live):
    plan = live([("E1", "V1", "Q1", 100.0), ("E2", "V1", "Q1", 50.0)],
                "evidence_number string, cpv_code string, planned_quarter string, estimated_value double")
    procedures = live(
        [("R1", "E1", "P1", "t", D, D, "s"), ("R2", "E2", "P1", "t", D, D, "s"), ("R3", "E9", "P2", "t", D, D, "s")],
        "procedure_id string, evidence_number string, project_id string, procedure_type string, "
        "publication_date date, selection_decision_date date, procedure_status string")
    bids = live(
        [("b1", "R1", "S1", 90.004, "Odabrana"), ("b2", "R1", "S2", 95.0, "no"), ("b3", "R3", "S1", 9.0, None)],
        "bid_id string, procedure_id string, supplier_id string, bid_amount double, bid_status string")
    return plan, procedures, bids


def test_procurement_performance(procurement):
    plan, procedures, bids = procurement
    facts = gold.fact_procurement_bids(bids)
    assert {r["bid_id"]: r["is_awarded"] for r in facts.collect()} == {"b1": True, "b2": False, "b3": None}
    got = {r[0]: tuple(r)[1:] for r in gold.fact_procurement_performance(plan, procedures, facts).collect()}
    # R3 has no plan item and vanishes; R2 has no bid: a zero count, null award and savings
    assert got == {"R1": (100.0, "S1", 90.0, 2, 10.0), "R2": (50.0, None, None, 0, None)}
    kept = {r["procedure_id"]: r["cpv_code"] for r in gold.dim_procedure(procedures, plan).collect()}
    assert kept == {"R1": "V1", "R2": "V1", "R3": None}


def test_two_awarded_bids_fail_the_gate(procurement, live):
    plan, procedures, bids = procurement
    second = live([("b4", "R1", "S3", 80.0, "Odabrana")],
                  "bid_id string, procedure_id string, supplier_id string, bid_amount double, bid_status string")
    facts = gold.fact_procurement_performance(
        plan, procedures, gold.fact_procurement_bids(bids.unionByName(second)))
    with pytest.raises(ExpectationFailed, match="1 of 2"):
        require(uniqueness(facts, ["procedure_id"]), "unique_key", "num_entries = 1")


PROJECT = ("project_id string, project_name string, project_status string, funding_source string, "
           "funding_type string, eu_program string, year int, department_id string, cpv_code string, "
           "planned_amount int, city_share_amount int, external_share_amount int")


@pytest.fixture(scope="module")
def projects(live):
    return live([("P1", "one", "open", "f", "t", "eu", 2024, "D1", "V1", 250, 100, 150),
                 ("P2", "two", "open", "f", "t", None, 2024, "D2", "V1", 0, 0, 0)], PROJECT)


INVOICE = ("invoice_id string, purchase_order_id string, contract_id string, project_id string, issue_date date, "
           "due_date date, payment_date date, invoice_amount double, currency string, payment_status string, "
           "invoice_status string, days_late int")


@pytest.fixture(scope="module")
def invoices(live):
    return live([
        ("I1", "O1", "C0", "P1", D, D, D, 10.1, "EUR", "paid", "paid", 5),
        ("I2", "O1", "C0", "P1", D, D, None, 20.2, "EUR", "open", "Overdue", None),
        ("I3", "O1", "C0", "P1", D, D, D, 1.0, "EUR", "paid", "paid", -2),
        ("I4", "O2", "C9", "PX", D, D, D, 1.0, "EUR", "paid", "paid", 4),
        ("I5", "O3", "C9", "P2", D, D, None, 1.0, "EUR", "open", "open", None),
    ], INVOICE, closed=[("I1", "O1", "C0", "P1", D, D, D, 5000.0, "EUR", "paid", "paid", 900)])


def test_realization_and_zero_denominators(projects, contracts, annexes, invoices, spark):
    money = gold.fact_contract_financials(contracts, annexes)
    fin = gold.fact_project_financials(projects, money, gold.dim_contract(contracts, annexes), invoices)
    got = {r["project_id"]: r for r in fin.collect()}
    assert tuple(got["P1"])[4:] == (415.15, 4, 31.3, 11.1)
    assert tuple(got["P2"])[4:] == (0.0, 0, 1.0, 0.0)
    departments = spark.createDataFrame([("D1", "Roads")], "department_id string, department_name string")
    dims = gold.dim_project(projects)
    kpi = {r["project_id"]: r for r in gold.mv_project_realization_kpi(fin, dims, departments).collect()}
    assert [kpi["P1"][c] for c in ("realization_pct", "contracted_pct", "eu_share_pct")] == [0.0267, 1.6606, 0.3613]
    assert [kpi["P2"][c] for c in ("realization_pct", "contracted_pct", "eu_share_pct")] == [None, None, None]
    planned = gold.mv_project_realization_kpi(fin, dims, departments, "planned_amount", "planned_amount")
    row = planned.filter("project_id = 'P1'").first()
    assert (row["realization_pct"], row["eu_share_pct"]) == (0.0444, 0.6)


def test_payment_delay(projects, invoices, spark):
    departments = spark.createDataFrame(
        [("D1", "Roads"), ("D2", "Parks")], "department_id string, department_name string")
    got = {tuple(r) for r in gold.mv_avg_payment_delay_kpi(
        gold.fact_invoices(invoices), gold.dim_project(projects), departments).collect()}
    # Parks has no paid invoice and is absent; the unknown project forms a null group
    assert got == {("D1", "Roads", 2, 1.5), (None, None, 1, 4.0)}


def test_rollup_total_is_the_sum_of_leaves(projects, contracts, annexes, invoices, live):
    orders = live([("O1", "C0", "P1", D, 1.0, "x"), ("O2", "C9", "PX", D, 1.0, "x"), ("O3", "C9", "P2", D, 1.0, "x")],
                  "purchase_order_id string, contract_id string, project_id string, order_date date, "
                  "order_amount double, order_description string")
    args = (gold.fact_invoices(invoices), gold.fact_purchase_orders(orders), gold.dim_contract(contracts, annexes),
            gold.dim_project(projects))
    rows = report.invoice_drilldown(*args).collect()
    total = next(r for r in rows if r["level"] == 0)
    leaves = [r for r in rows if r["level"] == 5]
    assert len(leaves) == 5
    assert total["invoice_amount"] == round(sum(r["invoice_amount"] for r in leaves), 2) == 33.3
    assert (total["invoice_status"], total["days_late"]) == ("Overdue", 7)
    # a missing parent is its own group, not a subtotal
    assert any(r["level"] == 1 and r["department_id"] is None for r in rows)
    only = report.drillthrough("D1", *args).collect()
    assert sorted(r["invoice_id"] for r in only if r["level"] == 5) == ["I1", "I2", "I3"]


def test_build_gold_writes_every_table(spark, tmp_path, projects, contracts, annexes, invoices, procurement, live):
    plan, procedures, bids = procurement
    silver = {
        "projects": projects, "contracts": contracts, "contract_annexes": annexes, "invoices": invoices,
        "procurement_plan": plan, "procurement_procedures": procedures, "procurement_bids": bids,
        "purchase_orders": live([("O1", "C0", "P1", D, 1.0, "x")],
                                "purchase_order_id string, contract_id string, project_id string, order_date date, "
                                "order_amount double, order_description string"),
        "department_lookup": spark.createDataFrame([("D1", "Roads")], "department_id string, department_name string"),
        "supplier_lookup": spark.createDataFrame(
            [("S1", "Acme", "Split")], "supplier_id string, supplier_name string, supplier_city string"),
        "cpv_lookup": spark.createDataFrame([("V1", "works")], "cpv_code string, cpv_description string"),
    }
    tables = gold.build_gold(spark, silver, str(tmp_path))
    assert len(tables) == 16
    row = tables["mv_procurement_savings_kpi"].filter("procedure_id = 'R1'").first()
    assert (row["awarded_supplier_name"], row["savings_pct"], row["department_name"]) == ("Acme", 0.1, "Roads")
    cards = report.savings_cards(tables["mv_procurement_savings_kpi"], tables["fact_procurement_bids"]).collect()
    assert tuple(cards[0]) == ("P1", 10.0, 2, None, 1)
    best = report.worst_department(tables["mv_procurement_savings_kpi"], tables["dim_project"], 2024).first()
    assert (best["department_id"], best["savings_pct"]) == ("D1", 0.0667)


def test_shared_parts_are_shuffled_once_for_all_tables(spark):
    """Lines without copies and decided orders are stored before gold is built, so no table ranks or groups them again."""
    from snapstar.plans.sample_model import SampleModel

    lazy, stored = (SampleModel(spark, "/root/testdata/sf0.001") for _ in range(2))
    stored.stored_gold  # noqa: B018
    for name in ("annexes", "raw_invoices", "contracts", "plan"):
        frame = getattr(stored, name)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Aggregate" not in plan and "lineitem.parquet" not in plan
        assert frame.exceptAll(getattr(lazy, name)).count() == 0 and frame.count() == getattr(lazy, name).count()

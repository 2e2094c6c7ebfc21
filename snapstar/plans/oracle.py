"""Independent SQL for every query, written for DuckDB over the same tables."""

from __future__ import annotations

import re

from .metadata import GOLD_TABLES, PRIMARY_KEYS


def _r(expression: str, scale: int) -> str:
    """Round a double half away from zero on its decimal value."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,12)), {scale}) AS DOUBLE)"


def _m(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,6))"


def _sum(expression: str) -> str:
    return f"CAST(ROUND(SUM({_m(expression)}), 2) AS DOUBLE)"


def _ratio(n: str, d: str, scale: int = 4) -> str:
    return f"CASE WHEN ({d}) > 0 THEN {_r(f'CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE)', scale)} END"


def _one(c: str) -> str:
    return f"CASE WHEN MIN({c}) = MAX({c}) AND COUNT(*) = COUNT({c}) THEN MAX({c}) END"


COMMON = {
    "lines": """SELECT * EXCLUDE rn FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_discount,
        l_returnflag, l_linestatus, l_shipdate, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_suppkey, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate) AS rn
        FROM lineitem) WHERE rn = 1""",
    "winner": """SELECT l_orderkey, l_suppkey FROM (SELECT l_orderkey, l_suppkey, ROW_NUMBER() OVER (
        PARTITION BY l_orderkey ORDER BY l_extendedprice, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
    "ord": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "dim_department": "SELECT n_nationkey AS department_id, n_name AS department_name FROM nation",
    "dim_supplier": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS supplier_city
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "dim_cpv": "SELECT p_partkey AS cpv_code, p_type || ' ' || p_name AS cpv_description FROM part",
    "days": """SELECT CAST(d AS DATE) AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
        monthname(d) AS month_name, day(d) AS day, dayname(d) AS day_of_week_name,
        dayofweek(d) IN (0, 6) AS is_weekend
        FROM generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY) AS g(d)""",
    "project": """SELECT *, CASE WHEN funding_type = 'External' THEN 0 ELSE planned_amount END AS city_share_amount,
        CASE WHEN funding_type = 'External' THEN planned_amount ELSE 0 END AS external_share_amount FROM (
        SELECT c_custkey AS project_id, c_name AS project_name,
        CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'On hold' END AS project_status, c_mktsegment AS funding_source,
        CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'External' ELSE 'City' END AS funding_type,
        CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'EU-' || c_mktsegment[1:3] END AS eu_program,
        CAST(1995 + length(c_mktsegment) AS INTEGER) AS year, c_nationkey AS department_id,
        CAST(c_nationkey AS BIGINT) AS cpv_code, CAST(ROUND(c_acctbal * 100) AS INTEGER) AS planned_amount
        FROM customer)""",
    "dim_project": """SELECT project_id, project_name, project_status, funding_source, funding_type, eu_program,
        year, department_id, cpv_code FROM project""",
    "annex": f"""SELECT l_orderkey || '-' || l_linenumber AS annex_id, l_orderkey AS contract_id,
        -CAST({_m('l_extendedprice')} * {_m('l_discount')} AS DECIMAL(38,6)) AS amount_change,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS new_deadline
        FROM lines WHERE l_returnflag = 'R'""",
    "dim_contract": """SELECT o_orderkey AS contract_id, o_custkey AS project_id, o_orderpriority AS budget_item_id,
        o_orderkey AS procedure_id, w.l_suppkey AS supplier_id, o_orderdate AS signature_date,
        o_orderdate + 180 AS contract_deadline, o_orderstatus AS contract_status,
        COALESCE((SELECT MAX(new_deadline) FROM annex a WHERE a.contract_id = o_orderkey), o_orderdate + 180)
        AS current_deadline FROM ord LEFT JOIN winner w ON w.l_orderkey = o_orderkey""",
    "plan_item": """SELECT o_orderkey AS evidence_number, MIN(l_partkey) AS cpv_code,
        year(MIN(o_orderdate)) || '-Q' || quarter(MIN(o_orderdate)) AS planned_quarter,
        MIN(o_totalprice) AS estimated_value FROM ord JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "dim_procedure": """SELECT o_orderkey AS evidence_number, o_orderkey AS procedure_id, o_custkey AS project_id,
        o_orderpriority AS procedure_type, o_orderdate AS publication_date,
        o_orderdate + 30 AS selection_decision_date, o_orderstatus AS procedure_status, cpv_code, planned_quarter
        FROM ord LEFT JOIN plan_item ON evidence_number = o_orderkey""",
    "fact_invoices": """SELECT *, CASE WHEN payment_date IS NULL AND due_date < DATE '2000-06-30' THEN 'Overdue'
        ELSE payment_status END AS invoice_status, CAST(payment_date - due_date AS INTEGER) AS days_late FROM (
        SELECT l_orderkey || '-' || l_linenumber AS invoice_id, l_orderkey || '-' || l_suppkey AS purchase_order_id,
        l_orderkey AS contract_id, o_custkey AS project_id, o_orderdate AS issue_date, o_orderdate + 60 AS due_date,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS payment_date,
        l_extendedprice AS invoice_amount, 'EUR' AS currency,
        CASE WHEN l_linestatus = 'F' THEN 'Plaćeno' ELSE 'Neplaćeno' END AS payment_status
        FROM lines JOIN ord ON o_orderkey = l_orderkey)""",
    "fact_purchase_orders": f"""SELECT l_orderkey || '-' || l_suppkey AS purchase_order_id,
        l_orderkey AS contract_id, MIN(o_custkey) AS project_id, CAST(MIN(l_shipdate) AS DATE) AS order_date,
        {_sum('l_extendedprice')} AS order_amount, 'Supply from ' || l_suppkey AS order_description
        FROM lines JOIN ord ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_suppkey""",
    "fact_contract_financials": f"""SELECT o_orderkey AS contract_id, o_totalprice AS contract_amount,
        CAST(ROUND(COALESCE(SUM(amount_change), 0), 2) AS DOUBLE) AS total_annex_adjustments,
        COUNT(annex_id) AS annex_count,
        CAST(ROUND({_m('o_totalprice')} + COALESCE(SUM(amount_change), 0), 2) AS DOUBLE) AS total_contract_value
        FROM ord LEFT JOIN annex ON contract_id = o_orderkey GROUP BY o_orderkey, o_totalprice""",
    "fact_procurement_bids": """SELECT *, bid_status = 'Odabrana' AS is_awarded FROM (
        SELECT b.l_orderkey || '-' || b.l_suppkey AS bid_id, b.l_orderkey AS procedure_id,
        b.l_suppkey AS supplier_id, b.price AS bid_amount, CASE WHEN o_orderstatus = 'P' THEN NULL
        WHEN b.l_suppkey = w.l_suppkey THEN 'Odabrana' ELSE 'Rejected' END AS bid_status
        FROM (SELECT l_orderkey, l_suppkey, MIN(l_extendedprice) AS price FROM lineitem GROUP BY ALL) b
        JOIN ord ON o_orderkey = b.l_orderkey JOIN winner w ON w.l_orderkey = b.l_orderkey)""",
    "fact_procurement_performance": f"""SELECT p.evidence_number AS procedure_id, p.estimated_value,
        a.supplier_id AS awarded_supplier_id, a.bid_amount AS awarded_bid_amount,
        (SELECT COUNT(*) FROM fact_procurement_bids b WHERE b.procedure_id = p.evidence_number) AS bid_count,
        CAST({_m('p.estimated_value')} - {_m('a.bid_amount')} AS DOUBLE) AS procurement_savings
        FROM plan_item p LEFT JOIN fact_procurement_bids a
        ON a.procedure_id = p.evidence_number AND a.is_awarded""",
    "fact_project_financials": f"""SELECT p.project_id, planned_amount, city_share_amount, external_share_amount,
        COALESCE(c.v, 0.0::DOUBLE) AS total_contracted_value, COALESCE(c.n, 0) AS contract_count,
        COALESCE(i.v, 0.0::DOUBLE) AS total_invoiced_amount, COALESCE(q.v, 0.0::DOUBLE) AS total_paid_amount
        FROM project p
        LEFT JOIN (SELECT o_custkey, {_sum('total_contract_value')} AS v, COUNT(*) AS n
            FROM fact_contract_financials JOIN ord ON o_orderkey = contract_id GROUP BY o_custkey) c
            ON c.o_custkey = p.project_id
        LEFT JOIN (SELECT project_id, {_sum('invoice_amount')} AS v FROM fact_invoices GROUP BY 1) i
            ON i.project_id = p.project_id
        LEFT JOIN (SELECT project_id, {_sum('invoice_amount')} AS v FROM fact_invoices
            WHERE payment_date IS NOT NULL GROUP BY 1) q ON q.project_id = p.project_id""",
    "mv_procurement_savings_kpi": f"""SELECT f.procedure_id, d.evidence_number, d.project_id, p.project_name,
        p.department_id, e.department_name, d.cpv_code, v.cpv_description, f.estimated_value, f.awarded_bid_amount,
        s.supplier_name AS awarded_supplier_name, f.procurement_savings,
        {_ratio('procurement_savings', 'estimated_value')} AS savings_pct, f.bid_count
        FROM fact_procurement_performance f LEFT JOIN dim_procedure d USING (procedure_id)
        LEFT JOIN dim_project p ON p.project_id = d.project_id
        LEFT JOIN dim_department e ON e.department_id = p.department_id
        LEFT JOIN dim_cpv v ON v.cpv_code = d.cpv_code
        LEFT JOIN dim_supplier s ON s.supplier_id = f.awarded_supplier_id""",
    "mv_project_realization_kpi": f"""SELECT f.project_id, p.project_name, p.project_status, p.department_id,
        e.department_name, p.funding_source, p.eu_program, p.year, f.planned_amount, f.city_share_amount,
        f.external_share_amount, total_contracted_value, contract_count, total_invoiced_amount, total_paid_amount,
        {_ratio('total_paid_amount', 'total_contracted_value')} AS realization_pct,
        {_ratio('total_contracted_value', 'f.planned_amount')} AS contracted_pct,
        {_ratio('f.external_share_amount', 'total_contracted_value')} AS eu_share_pct
        FROM fact_project_financials f LEFT JOIN dim_project p USING (project_id)
        LEFT JOIN dim_department e ON e.department_id = p.department_id""",
    "mv_avg_payment_delay_kpi": f"""SELECT department_id, department_name, COUNT(invoice_id) AS paid_invoice_count,
        {_ratio('SUM(days_late)', 'COUNT(days_late)', 2)} AS avg_days_late
        FROM fact_invoices LEFT JOIN dim_project USING (project_id) LEFT JOIN dim_department USING (department_id)
        WHERE payment_date IS NOT NULL GROUP BY department_id, department_name""",
    "snap": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE WHEN year(o_orderdate) = y THEN 'P' ELSE o_orderstatus END AS status,
        CASE WHEN year(o_orderdate) = y AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
        ELSE o_totalprice END AS amount, 'run ' || y AS _rescued_data,
        make_timestamp(y, 12, 31, 0, 0, 0) AS _snapshot_ts, y
        FROM ord, (SELECT unnest(range(MIN(year(o_orderdate)), MAX(year(o_orderdate)) + 1)) AS y FROM ord)
        WHERE year(o_orderdate) <= y AND NOT (o_orderpriority = '5-LOW' AND y = year(o_orderdate) + 1)
        AND NOT (o_orderpriority = '2-HIGH' AND y >= year(o_orderdate) + 2)""",
}


def _history(name: str, changed: str) -> None:
    COMMON[f"{name}_runs"] = f"""SELECT *, SUM(CASE WHEN before IS NULL OR before <> y - 1 OR {changed}
        THEN 1 ELSE 0 END) OVER (PARTITION BY order_id ORDER BY y) AS run FROM (
        SELECT *, LAG(y) OVER w AS before, LAG(status) OVER w AS was_status, LAG(amount) OVER w AS was_amount,
        LAG(customer_id) OVER w AS was_customer FROM snap WINDOW w AS (PARTITION BY order_id ORDER BY y))"""
    COMMON[name] = f"""SELECT order_id, arg_max(customer_id, y) AS customer_id, arg_max(status, y) AS status,
        MAX(CASE WHEN y = last THEN amount END) AS amount, MIN(_snapshot_ts) AS __START_AT,
        CASE WHEN last < (SELECT MAX(y) FROM snap) THEN make_timestamp(last + 1, 12, 31, 0, 0, 0) END AS __END_AT
        FROM (SELECT *, MAX(y) OVER (PARTITION BY order_id, run) AS last FROM {name}_runs)
        GROUP BY order_id, run, last"""


_KEPT = "status IS DISTINCT FROM was_status OR customer_id IS DISTINCT FROM was_customer"
_history("hist", f"{_KEPT} OR amount IS DISTINCT FROM was_amount")
_history("hist_loose", _KEPT)


# Base relation of each entity's export: key, changed column and its changed value, columns that come out unchanged.
_ENTITY_ROWS = {
    "projects": ("project", "project_id", "project_name", "project_name || '!'", ()),
    "budget_plan": ("part", "p_partkey AS budget_item_id", "p_retailprice AS amount", "p_retailprice + 1", ()),
    "procurement_plan": ("ord WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)", "o_orderkey AS evidence_number", "o_totalprice AS estimated_value", "o_totalprice + 1", ()),
    "procurement_procedures": ("ord", "o_orderkey AS procedure_id", "o_orderstatus AS procedure_status", "o_orderstatus || '!'",
                               ("o_orderdate AS publication_date", "o_orderdate + 30 AS selection_decision_date")),
    "procurement_bids": ("fact_procurement_bids", "bid_id", "bid_amount", "bid_amount + 1", ()),
    "contracts": ("dim_contract", "contract_id", "contract_status", "contract_status || '!'", ("signature_date", "contract_deadline")),
    "contract_annexes": ("(SELECT *, l_orderkey || '-' || l_linenumber AS annex_id FROM lines WHERE l_returnflag = 'R')", "annex_id", "l_orderkey AS contract_id", "l_orderkey + 1",
                         ("CAST(l_shipdate AS DATE) AS annex_date", "CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS new_deadline")),
    "purchase_orders": ("fact_purchase_orders", "purchase_order_id", "order_description", "order_description || '!'", ("order_date",)),
    "cpv_lookup": ("dim_cpv", "cpv_code", "cpv_description", "cpv_description || '!'", ()),
    "department_lookup": ("dim_department", "department_id", "department_name", "department_name || '!'", ()),
    "dashboard_summary": ("(SELECT event_type AS metric, COUNT(*) AS value FROM events GROUP BY event_type)", "metric", "value", "value + 1", ()),
    "summary_by_year": ("(SELECT year(o_orderdate) AS year, COUNT(*) AS orders FROM ord GROUP BY 1)", "year", "orders", "orders + 1", ()),
    "source_notes": ("nation", "n_name AS source_name", "CAST(n_regionkey AS VARCHAR) AS note", "n_regionkey || '!'", ()),
}
_LOOKUPS = ("cpv_lookup", "department_lookup", "dashboard_summary", "summary_by_year", "source_notes")


def _entity(name: str) -> str:
    """Two exports of an entity, as type 1 or type 2."""
    relation, key, column, changed, others = _ENTITY_ROWS[name]
    named = lambda e: e.split(" AS ")[-1]
    k, c = named(key), named(column)
    kind = "DOUBLE" if c in ("amount", "estimated_value", "bid_amount") else "VARCHAR"
    rest = "".join(f", {o}" for o in others)
    base = f"""SELECT *, ascii(right({k}, 1)) AS n FROM (SELECT CAST({key.rsplit(" AS ", 1)[0]} AS VARCHAR) AS {k}, CAST({column.rsplit(" AS ", 1)[0]} AS {kind}) AS {c},
        CAST({changed} AS {kind}) AS changed{rest} FROM {relation})"""
    kept = "".join(f", {named(o)}" for o in others)
    later = f"SELECT {k}, CASE WHEN n % 3 = 0 THEN changed ELSE {c} END AS {c}{kept} FROM ({base}) WHERE n % 7 <> 2"
    if name in _LOOKUPS:
        return later
    seen = f"""SELECT {k}, {c}{kept}, TIMESTAMP '1997-12-31' AS since FROM ({base}) WHERE n % 5 <> 1
        UNION ALL SELECT *, TIMESTAMP '1998-12-31' FROM ({later})"""
    return f"""SELECT {k}, {c}{kept}, since AS __START_AT,
        CASE WHEN since = TIMESTAMP '1997-12-31' AND NOT (has_next AND {c} IS NOT DISTINCT FROM next) THEN TIMESTAMP '1998-12-31' END AS __END_AT
        FROM (SELECT *, LEAD({c}) OVER w AS next, LEAD(since) OVER w IS NOT NULL AS has_next, LAG({c}) OVER w AS before, LAG(since) OVER w IS NOT NULL AS had FROM ({seen})
        WINDOW w AS (PARTITION BY {k} ORDER BY since)) WHERE NOT (had AND {c} IS NOT DISTINCT FROM before)"""


def _status(day: str) -> str:
    """An invoice's status on a day."""
    return f"(CASE WHEN payment_date IS NULL AND due_date < {day} THEN 'Overdue' ELSE payment_status END)"


def _with(body: str) -> str:
    """Prefix the common tables the query needs, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in COMMON:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(COMMON[name])

    visit(body)
    ranked: list[str] = []

    def place(name: str) -> None:
        if name in ranked:
            return
        for other in COMMON:
            if other != name and other in needed and re.search(rf"\b{other}\b", COMMON[name]):
                place(other)
        ranked.append(name)

    for name in COMMON:
        if name in needed:
            place(name)
    tables = ",\n".join(f"{n} AS ({COMMON[n]})" for n in ranked)
    return f"WITH {tables}\n{body}" if ranked else body


_EXPORT_TOTALS = f"""SELECT _snapshot_ts, status, COUNT(*) AS rows, COUNT(amount) AS amounts,
    {_sum('amount')} AS amount FROM snap GROUP BY _snapshot_ts, status"""
_HIST = "SELECT order_id, customer_id, status, amount, __START_AT, __END_AT FROM hist"


def _profile(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
        {_r(f'(COUNT(*) - COUNT({c})) * 100.0 / COUNT(*)', 4)} AS null_pct,
        COUNT(DISTINCT {c}) AS distinct_values FROM {table}""" for c in columns)


# What every gold table holds, column by column with its type.
GOLD_COLUMNS = """
dim_department department_id:int department_name:string
dim_supplier supplier_id:bigint supplier_name:string supplier_city:string
dim_cpv cpv_code:bigint cpv_description:string
dim_date date:date year:int quarter:int month:int month_name:string day:int day_of_week_name:string is_weekend:boolean
dim_project project_id:bigint project_name:string project_status:string funding_source:string funding_type:string eu_program:string year:int department_id:int cpv_code:bigint
dim_contract contract_id:bigint project_id:bigint budget_item_id:string procedure_id:bigint supplier_id:bigint signature_date:date contract_deadline:date contract_status:string current_deadline:date
dim_procedure evidence_number:bigint procedure_id:bigint project_id:bigint procedure_type:string publication_date:date selection_decision_date:date procedure_status:string cpv_code:bigint planned_quarter:string
fact_invoices invoice_id:string purchase_order_id:string contract_id:bigint project_id:bigint issue_date:date due_date:date payment_date:date invoice_amount:double currency:string payment_status:string invoice_status:string days_late:int
fact_purchase_orders purchase_order_id:string contract_id:bigint project_id:bigint order_date:date order_amount:double order_description:string
fact_contract_financials contract_id:bigint contract_amount:double total_annex_adjustments:double annex_count:bigint total_contract_value:double
fact_procurement_bids bid_id:string procedure_id:bigint supplier_id:bigint bid_amount:double bid_status:string is_awarded:boolean
fact_procurement_performance procedure_id:bigint estimated_value:double awarded_supplier_id:bigint awarded_bid_amount:double bid_count:bigint procurement_savings:double
fact_project_financials project_id:bigint planned_amount:int city_share_amount:int external_share_amount:int total_contracted_value:double contract_count:bigint total_invoiced_amount:double total_paid_amount:double
mv_procurement_savings_kpi procedure_id:bigint evidence_number:bigint project_id:bigint project_name:string department_id:int department_name:string cpv_code:bigint cpv_description:string estimated_value:double awarded_bid_amount:double awarded_supplier_name:string procurement_savings:double savings_pct:double bid_count:bigint
mv_project_realization_kpi project_id:bigint project_name:string project_status:string department_id:int department_name:string funding_source:string eu_program:string year:int planned_amount:int city_share_amount:int external_share_amount:int total_contracted_value:double contract_count:bigint total_invoiced_amount:double total_paid_amount:double realization_pct:double contracted_pct:double eu_share_pct:double
mv_avg_payment_delay_kpi department_id:int department_name:string paid_invoice_count:bigint avg_days_late:double
"""


def _gold_columns() -> dict[str, list[tuple[str, str]]]:
    lines = (line.split() for line in GOLD_COLUMNS.strip().splitlines())
    return {name: [tuple(c.split(":")) for c in columns] for name, *columns in lines}


def _relation(table: str) -> str:
    """The calendar's common table has a name of its own."""
    return "days" if table == "dim_date" else table


def _built(table: str) -> str:
    """Rows and one exact total of a written table; the default calendar has 16 years."""
    totals = {"fact_invoices": "invoice_amount", "fact_contract_financials": "total_contract_value",
              "mv_project_realization_kpi": "total_paid_amount", "mv_procurement_savings_kpi": "procurement_savings"}
    rows = "CAST(5844 AS BIGINT)" if table == "dim_date" else f"(SELECT COUNT(*) FROM {table})"
    total = f"(SELECT {_sum(totals[table])} FROM {table})" if table in totals else "CAST(NULL AS DOUBLE)"
    return f"SELECT '{table}' AS table_name, {rows} AS rows, {total} AS total"


def _catalog_columns(tables: dict[str, list[tuple[str, str]]]) -> str:
    parts = []
    for m in GOLD_TABLES:
        for i, (c, kind) in enumerate(tables.get(m.name, ()), 1):
            to = m.foreign_keys.get(c, (None, None))
            refs = ", ".join("NULL" if x is None else f"'{x}'" for x in to)
            meaning = m.columns.get(c, "").replace("'", "''")
            parts.append(f"""SELECT '{m.name}', '{c}', {i}, '{kind}', {c == m.primary_key}, {refs}, '{meaning}',
                COUNT(*) - COUNT({c}), COUNT(DISTINCT {c}) FROM {_relation(m.name)}""")
    names = ('table_name, "column", position, type, is_primary_key, references_table, references_column, description, '
             "nulls, distinct_values")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) AS t({names})"


def _document(name: str, columns: list[tuple[str, str]]) -> str:
    m = next(t for t in GOLD_TABLES if t.name == name)
    head = (f"Table: {m.name} ({m.kind})\nGrain: {m.grain}\nDescription: {m.description}\nColumns: "
            + ", ".join(f"{c} ({k})" + (f" - {m.columns[c]}" if m.columns.get(c) else "") for c, k in columns) + "\nSample rows:\n").replace("'", "''")
    cells = " || ', ' || ".join(f"'{c}=' || COALESCE(CAST({c} AS VARCHAR), 'null')" for c, _ in columns)
    return f"""SELECT '{name}' AS table_name, '{head}' || string_agg({cells}, chr(10) ORDER BY {m.primary_key})
        AS document FROM (SELECT * FROM {_relation(name)} ORDER BY {m.primary_key} LIMIT 3)"""


_PROTOTYPES = """proto AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM (
    SELECT label, i, AVG(CAST(embedding[i] AS DOUBLE)) AS x
    FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY label, i) GROUP BY label),
    scored AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS sim
    FROM embeddings, proto),
    ranked AS (SELECT query_id, vec_id, sim, ROW_NUMBER() OVER (PARTITION BY query_id
    ORDER BY ROUND(sim, 10) DESC, vec_id) AS n FROM scored)"""


def _cosine(k: int, threshold: str = "") -> str:
    return f"""WITH {_PROTOTYPES} SELECT query_id, vec_id, {_r('sim', 4)} AS similarity, CAST(n AS INTEGER) AS rank
        FROM ranked WHERE n <= {k} {threshold and f'AND {_r("sim", 4)} >= {threshold}'}"""


def _cosine_all(k: int) -> str:
    return f"""WITH unit AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        sims AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.v, b.v), 10) AS sim FROM unit a, unit b),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS n FROM sims)
        SELECT query_id, CAST(n - 1 AS INTEGER) AS rank, {_r('sim', 4)} AS similarity FROM ranked WHERE n BETWEEN 2 AND {k}"""


def _typed_export(run: int) -> str:
    """Column and type of each column of one of the two exports of the orders, from their values."""
    columns = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus", "o_totalprice": "o_totalprice",
               "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "o_orderpriority": "o_orderpriority"}
    if run == 2:
        del columns["o_orderpriority"]
        columns |= {"o_custkey": "CASE WHEN o_custkey % 7 = 0 THEN 'C' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END",
                    "o_batch": "o_orderkey * 5000000000", "o_totalprice": "CAST(floor(o_totalprice) AS BIGINT)"}
    columns["_snapshot_ts"] = f"'200{run - 1}-12-31 00:00:00'"
    texts = " UNION ALL ".join(f"SELECT '{c}' AS c, CAST({e} AS VARCHAR) AS x FROM orders" for c, e in columns.items())
    return f"""SELECT c, CASE WHEN bool_and(regexp_full_match(x, '-?[0-9]+') AND try_cast(x AS INTEGER) IS NOT NULL) THEN 'int'
        WHEN bool_and(regexp_full_match(x, '-?[0-9]+')) THEN 'bigint' WHEN bool_and(try_cast(x AS DOUBLE) IS NOT NULL) THEN 'double'
        WHEN bool_and(try_cast(x AS TIMESTAMP) IS NOT NULL) THEN 'timestamp' ELSE 'string' END AS t FROM ({texts}) GROUP BY c"""


def _graph_selection() -> str:
    """What two selections leave of each table, each written as nested conditions of its own."""
    chosen, pending = "department_id IN (3, 7)", "contract_status = 'P'"
    own = f"SELECT project_id FROM dim_project WHERE {chosen}"
    by_pending = f"project_id IN (SELECT project_id FROM dim_contract WHERE {pending})"
    contract = f"{pending} AND project_id IN ({own})"
    project = f"{chosen} AND {by_pending}"
    inside = f"project_id IN (SELECT project_id FROM dim_project WHERE {project})"
    realized = f"project_id IN (SELECT project_id FROM mv_project_realization_kpi WHERE {inside})"
    saved = f"procedure_id IN (SELECT procedure_id FROM mv_procurement_savings_kpi WHERE {realized})"
    ordered = f"contract_id IN (SELECT contract_id FROM dim_contract WHERE {contract})"
    billed = f"purchase_order_id IN (SELECT purchase_order_id FROM fact_purchase_orders WHERE {ordered})"
    department = f"{chosen} AND department_id IN (SELECT department_id FROM dim_project WHERE {by_pending})"
    kept = {
        "dim_department": department, "dim_project": project, "dim_contract": contract, "mv_project_realization_kpi": inside,
        "dim_supplier": f"supplier_id IN (SELECT supplier_id FROM dim_contract WHERE {contract})",
        "dim_cpv": f"cpv_code IN (SELECT cpv_code FROM dim_project WHERE {project})",
        "dim_date": f"date IN (SELECT due_date FROM fact_invoices WHERE {billed})",
        "dim_procedure": f"procedure_id IN (SELECT procedure_id FROM fact_procurement_bids WHERE {saved})",
        "fact_invoices": billed, "fact_purchase_orders": ordered, "fact_contract_financials": ordered,
        "fact_procurement_bids": saved, "fact_procurement_performance": saved,
        "fact_project_financials": realized, "mv_procurement_savings_kpi": realized,
        "mv_avg_payment_delay_kpi": f"department_id IN (SELECT department_id FROM dim_department WHERE {department})"}
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, COUNT(*) AS rows, CAST(MIN({PRIMARY_KEYS[t]}) AS VARCHAR) AS first_key,
        CAST(MAX({PRIMARY_KEYS[t]}) AS VARCHAR) AS last_key FROM {"days" if t == "dim_date" else t} WHERE {where}""" for t, where in kept.items())


_LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate")


def _composite_keys() -> str:
    singles = " UNION ALL ".join(f"SELECT '{c}' AS a, '' AS b, COUNT(DISTINCT {c}) AS d FROM lineitem" for c in _LINE_COLUMNS)
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, (SELECT COUNT(*) FROM (SELECT DISTINCT {a}, {b} FROM lineitem)) AS d"
                               for i, a in enumerate(_LINE_COLUMNS) for b in _LINE_COLUMNS[i + 1:])
    return f"""WITH n AS (SELECT COUNT(*) AS n FROM lineitem), one AS ({singles}), keys AS (SELECT a FROM one, n WHERE d = n), two AS ({pairs})
        SELECT a AS columns, CAST(1 AS BIGINT) AS size, n AS rows FROM keys, n UNION ALL SELECT a || ', ' || b, 2, n FROM two, n WHERE d = n
        AND a NOT IN (SELECT a FROM keys) AND b NOT IN (SELECT a FROM keys)"""


# Whole-number and text columns of the star tables.
_COMPARED = {
    "integer": {"region": ("r_regionkey",), "nation": ("n_nationkey", "n_regionkey"), "customer": ("c_custkey", "c_nationkey"),
                "supplier": ("s_suppkey", "s_nationkey"), "part": ("p_partkey", "p_size"), "orders": ("o_orderkey", "o_custkey"),
                "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), "events": ("event_id", "user_id")},
    "string": {"region": ("r_name",), "nation": ("n_name",), "customer": ("c_name", "c_mktsegment"), "supplier": ("s_name",),
               "part": ("p_name", "p_brand", "p_type"), "orders": ("o_orderstatus", "o_orderpriority"),
               "lineitem": ("l_returnflag", "l_linestatus"), "events": ("event_type", "props")},
}


def _inclusions() -> str:
    values = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{t}' AS t, '{c}' AS c, CAST({c} AS VARCHAR) AS v FROM (SELECT DISTINCT {c} FROM {t} WHERE {c} IS NOT NULL)"
        for kind, tables in _COMPARED.items() for t, columns in tables.items() for c in columns)
    return f"""WITH cells AS MATERIALIZED ({values}), own AS (SELECT t, c, COUNT(*) AS d FROM cells GROUP BY t, c)
        SELECT a.t AS table_name, a.c AS "column", b.t AS references_table, b.c AS references_column, MIN(d) AS distinct_values,
        COUNT(*) AS matched_values, {_r('COUNT(*) * 100.0 / MIN(d)', 4)} AS share_pct FROM cells a
        JOIN cells b ON a.kind = b.kind AND a.v = b.v AND (a.t <> b.t OR a.c <> b.c) JOIN own ON own.t = a.t AND own.c = a.c
        GROUP BY a.t, a.c, b.t, b.c HAVING COUNT(*) * 100.0 / MIN(d) >= 90"""


_BID_LEVELS = "project_id, evidence_number, procedure_id, bid_id"
_INVOICE_LEVELS = "department_id, project_id, contract_id, purchase_order_id, invoice_id"


def _drilldown(where: str = "") -> str:
    return f"""SELECT 5 - CAST(bit_count(GROUPING({_INVOICE_LEVELS})) AS BIGINT) AS level, {_INVOICE_LEVELS},
        {_sum('invoice_amount')} AS invoice_amount, MIN(payment_status) AS payment_status,
        MIN(invoice_status) AS invoice_status, CAST(SUM(days_late) AS BIGINT) AS days_late FROM (
        SELECT p.department_id, p.project_id, c.contract_id, o.purchase_order_id, i.invoice_id, i.invoice_amount,
        i.payment_status, i.invoice_status, i.days_late FROM fact_invoices i
        LEFT JOIN fact_purchase_orders o ON o.purchase_order_id = i.purchase_order_id
        LEFT JOIN dim_contract c ON c.contract_id = o.contract_id
        LEFT JOIN dim_project p ON p.project_id = c.project_id {where})
        GROUP BY ROLLUP ({_INVOICE_LEVELS})"""


_REALIZATION_MATRIX = f"""SELECT level, department_id, project_id, procedure_id,
    planned_amount, total_contracted_value, total_invoiced_amount, total_paid_amount, awarded_bid,
    sum_eu_share_pct, sum_contracted_pct, {_ratio('ext', 'total_contracted_value')} AS eu_share_pct,
    {_ratio('total_contracted_value', 'planned_amount')} AS contracted_pct FROM (
    SELECT 2 - CAST(bit_count(GROUPING(department_id, project_id)) AS BIGINT) AS level, department_id, project_id,
    CAST(NULL AS BIGINT) AS procedure_id, CAST(SUM(planned_amount) AS DOUBLE) AS planned_amount,
    {_sum('total_contracted_value')} AS total_contracted_value,
    {_sum('total_invoiced_amount')} AS total_invoiced_amount, {_sum('total_paid_amount')} AS total_paid_amount,
    {_sum('award')} AS awarded_bid, CAST(SUM(CAST(eu_share_pct AS DECIMAL(18,4))) AS DOUBLE) AS sum_eu_share_pct,
    CAST(SUM(CAST(contracted_pct AS DECIMAL(18,4))) AS DOUBLE) AS sum_contracted_pct,
    CAST(SUM(external_share_amount) AS DOUBLE) AS ext
    FROM (SELECT r.*, (SELECT SUM({_m('s.awarded_bid_amount')}) FROM mv_procurement_savings_kpi s
        WHERE s.project_id = r.project_id) AS award FROM mv_project_realization_kpi r)
    GROUP BY ROLLUP (department_id, project_id)
    UNION ALL
    SELECT 3, r.department_id, r.project_id, s.procedure_id, r.planned_amount, r.total_contracted_value,
    r.total_invoiced_amount, r.total_paid_amount, s.awarded_bid_amount, r.eu_share_pct, r.contracted_pct,
    r.external_share_amount
    FROM mv_procurement_savings_kpi s JOIN mv_project_realization_kpi r ON r.project_id = s.project_id)"""

_GOLD = {
    "avg_payment_delay_kpi": "mv_avg_payment_delay_kpi",
    "dim_department": "dim_department",
    "dim_supplier": "dim_supplier",
    "dim_cpv": "dim_cpv",
    "dim_project": "dim_project",
    "dim_contract": "dim_contract",
    "dim_procedure": "dim_procedure",
    "invoices": "fact_invoices",
    "purchase_orders": "fact_purchase_orders",
    "contract_financials": "fact_contract_financials",
    "procurement_bids": "fact_procurement_bids",
    "procurement_performance": "fact_procurement_performance",
    "project_financials": "fact_project_financials",
    "procurement_savings_kpi": "mv_procurement_savings_kpi",
    "project_realization_kpi": "mv_project_realization_kpi",
}

_BODIES = {
    **{name: f"SELECT * FROM {table}" for name, table in _GOLD.items()},
    **{
        f"uniqueness_{t}": f"SELECT {k}, COUNT(*) AS num_entries FROM {t} GROUP BY {k}"
        for t, k in PRIMARY_KEYS.items() if t != "dim_date"
    },
    "uniqueness_dim_date": """SELECT CAST(d AS DATE) AS date, CAST(1 AS BIGINT) AS num_entries FROM generate_series(
        (SELECT make_date(year(MIN(o_orderdate)), 1, 1) FROM orders),
        (SELECT make_date(year(MAX(o_orderdate)), 12, 31) FROM orders), INTERVAL 1 DAY) AS g(d)""",
    "expect_unique_violations": """SELECT 'unique_line' AS expectation, COUNT(*) AS rows,
        COUNT(*) FILTER (n <> 1) AS violations
        FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "expect_fail": """SELECT invoice_id, COUNT(*) AS num_entries, (SELECT COUNT(*) FROM fact_invoices) > 0 AS raised
        FROM fact_invoices GROUP BY invoice_id""",
    "expect_drop": f"""SELECT payment_status, COUNT(*) AS kept, {_sum('invoice_amount')} AS amount
        FROM fact_invoices WHERE days_late <= 0 GROUP BY payment_status""",
    "expect_warn": """SELECT payment_status, COUNT(*) AS rows, (SELECT COUNT(*) FROM fact_invoices
        WHERE COALESCE(days_late, 1) > 0) AS violations FROM fact_invoices GROUP BY payment_status""",
    "dim_date": """SELECT days.*, n AS due_invoices FROM days JOIN (
        SELECT due_date, COUNT(*) AS n FROM fact_invoices GROUP BY due_date) ON due_date = date""",
    "calendar_for_column": """SELECT CAST(d AS DATE) AS date, year(d) AS year, quarter(d) AS quarter_no,
        'Qtr ' || quarter(d) AS quarter, month(d) AS month_no, monthname(d) AS month, day(d) AS day
        FROM generate_series((SELECT make_date(year(MIN(l_shipdate)), 1, 1) FROM lineitem),
        (SELECT make_date(year(MAX(l_shipdate)), 12, 31) FROM lineitem), INTERVAL 1 DAY) AS g(d)""",
    "date_hierarchy_rollup": f"""SELECT 4 - CAST(bit_count(GROUPING(year, quarter, month_no, day)) AS BIGINT) AS level,
        year, quarter, month_no, day, COUNT(*) AS row_count, {_sum('v')} AS total,
        CASE WHEN GROUPING(month_no) = 0 THEN monthname(make_date(2000, month_no, 1)) END AS month
        FROM (SELECT year(l_shipdate) AS year, 'Qtr ' || quarter(l_shipdate) AS quarter,
        month(l_shipdate) AS month_no, day(l_shipdate) AS day, l_extendedprice AS v FROM lineitem)
        GROUP BY ROLLUP (year, quarter, month_no, day)""",
    "date_part_join": f"""SELECT year(ts) AS year, monthname(ts) AS month, day(ts) AS day, COUNT(*) AS events,
        {_sum('value')} AS value FROM events GROUP BY 1, 2, 3""",
    "invoices_by_due_month": f"""SELECT year(due_date) AS year, month(due_date) AS month,
        monthname(due_date) AS month_name, COUNT(*) AS invoice_count, {_sum('invoice_amount')} AS invoice_amount
        FROM fact_invoices GROUP BY 1, 2, 3""",
    "invoice_status": """SELECT payment_status, invoice_status, COUNT(*) AS invoices,
        CAST(MIN(days_late) AS BIGINT) AS min_days_late, CAST(MAX(days_late) AS BIGINT) AS max_days_late,
        CAST(SUM(days_late) AS BIGINT) AS sum_days_late FROM fact_invoices GROUP BY 1, 2""",
    "latest_snapshot": "SELECT * EXCLUDE y FROM snap WHERE y = (SELECT MAX(y) FROM snap)",
    "dedup_by_key": "SELECT * FROM lines",
    "scd2_replay": _HIST,
    "scd2_apply": _HIST,
    "scd2_stored": _HIST,
    "exports_in_one_pass": f"""SELECT *, CAST((SELECT CASE WHEN MIN(year(o_orderdate)) < MAX(year(o_orderdate)) THEN 2 ELSE 1 END FROM ord) AS BIGINT) AS folds
        FROM ({_HIST})""",
    "scd2_untracked": _HIST.replace("FROM hist", "FROM hist_loose"),
    "scd2_current": "SELECT order_id, customer_id, status, amount, __START_AT FROM hist WHERE __END_AT IS NULL",
    "scd2_as_of": _HIST + """ WHERE __START_AT <= TIMESTAMP '1998-06-30'
        AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '1998-06-30')""",
    "scd2_lost_keys": """SELECT DISTINCT order_id FROM snap
        WHERE order_id NOT IN (SELECT order_id FROM snap WHERE y = (SELECT MAX(y) FROM snap))""",
    "scd1_apply": "SELECT * EXCLUDE y FROM snap WHERE y = 2000",
    "snapshot_deletes": """SELECT order_id, customer_id, status, amount FROM snap
        WHERE y = 1999 AND order_id NOT IN (SELECT order_id FROM snap WHERE y = 2000)""",
    "snapshot_diff": """SELECT CASE WHEN a.order_id IS NULL THEN 'inserted' WHEN b.order_id IS NULL THEN 'deleted'
        WHEN a.status IS DISTINCT FROM b.status OR a.amount IS DISTINCT FROM b.amount
        OR a.customer_id IS DISTINCT FROM b.customer_id THEN 'updated' ELSE 'unchanged' END AS change,
        COUNT(*) AS rows FROM (SELECT * FROM snap WHERE y = 1999) a
        FULL JOIN (SELECT * FROM snap WHERE y = 2000) b ON a.order_id = b.order_id GROUP BY 1""",
    "land_snapshot": _EXPORT_TOTALS,
    "csv_infer": _EXPORT_TOTALS,
    "bronze_ingest": _EXPORT_TOTALS,
    "ingest_entity": f"""SELECT invoice_id, due_date, payment_date, invoice_amount, status AS invoice_status, days_late,
        CAST(since AS TIMESTAMP) AS __START_AT, CAST(until AS TIMESTAMP) AS __END_AT FROM (
        SELECT *, {_status("DATE '1997-12-31'")} AS status, DATE '1997-12-31' AS since,
        CASE WHEN {_status("DATE '1997-12-31'")} <> {_status("DATE '2001-12-31'")} THEN DATE '2001-12-31' END AS until
        FROM fact_invoices WHERE issue_date < DATE '1998-01-01'
        UNION ALL SELECT *, {_status("DATE '2001-12-31'")}, DATE '2001-12-31', NULL FROM fact_invoices
        WHERE issue_date >= DATE '1998-01-01' OR {_status("DATE '1997-12-31'")} <> {_status("DATE '2001-12-31'")})""",
    "status_flip": f"""SELECT invoice_id, invoice_amount, {_status("DATE '1997-12-31'")} AS invoice_status,
        TIMESTAMP '1997-12-31' AS __START_AT, CASE WHEN {_status("DATE '1997-12-31'")} <> {_status("DATE '2000-06-30'")}
        THEN TIMESTAMP '2000-06-30' END AS __END_AT FROM fact_invoices UNION ALL
        SELECT invoice_id, invoice_amount, {_status("DATE '2000-06-30'")}, TIMESTAMP '2000-06-30', NULL FROM fact_invoices
        WHERE {_status("DATE '1997-12-31'")} <> {_status("DATE '2000-06-30'")}""",
    "same_day_export": f"""SELECT invoice_id, invoice_amount, invoice_status, __START_AT,
        LEAD(__START_AT) OVER (PARTITION BY invoice_id ORDER BY __START_AT) AS __END_AT FROM (
        SELECT *, LAG(__START_AT) OVER w AS t, LAG(invoice_amount) OVER w AS a, LAG(invoice_status) OVER w AS s FROM (
        SELECT invoice_id, invoice_amount, {_status("DATE '1997-12-31'")} AS invoice_status, TIMESTAMP '1997-12-31' AS __START_AT FROM fact_invoices
        UNION ALL SELECT invoice_id, invoice_amount, {_status("DATE '1998-06-30'")}, TIMESTAMP '1998-06-30' FROM fact_invoices
        UNION ALL SELECT invoice_id, invoice_amount + 1, {_status("DATE '1998-12-31'")}, TIMESTAMP '1998-12-31' FROM fact_invoices
        UNION ALL SELECT invoice_id, invoice_amount + CASE WHEN CAST(split_part(invoice_id, '-', 2) AS INTEGER) % 3 = 0 THEN 2 ELSE 1 END,
        {_status("DATE '1999-12-31'")}, TIMESTAMP '1999-12-31' FROM fact_invoices) WINDOW w AS (PARTITION BY invoice_id ORDER BY __START_AT))
        WHERE t IS NULL OR a IS DISTINCT FROM invoice_amount OR s IS DISTINCT FROM invoice_status""",
    "ingest_partial_run": f"""SELECT invoice_id, invoice_amount, {_status("DATE '1997-12-31'")} AS invoice_status,
        TIMESTAMP '1997-12-31' AS __START_AT, CAST(NULL AS TIMESTAMP) AS __END_AT, CAST(0 AS BIGINT) AS rows_before
        FROM fact_invoices""",
    "ingest_added_column": """SELECT CAST(c_custkey AS BIGINT) AS project_id, c_name AS project_name, CAST(NULL AS VARCHAR) AS segment,
        TIMESTAMP '1997-12-31' AS __START_AT, CASE WHEN c_acctbal > 0 THEN TIMESTAMP '1998-12-31' END AS __END_AT FROM customer
        UNION ALL SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '1998-12-31', NULL FROM customer WHERE c_acctbal > 0""",
    "ingest_lookup": """SELECT CAST(s_suppkey AS BIGINT) AS supplier_id, upper(s_name) AS supplier_name FROM supplier
        WHERE s_suppkey % 3 <> 0""",
    "slicer_values": "SELECT DISTINCT department_id FROM mv_project_realization_kpi",
    "slicer_filter": """SELECT department_id, project_id, total_contracted_value, realization_pct
        FROM mv_project_realization_kpi WHERE department_id IN (3, 7)""",
    "cross_filter": """SELECT 'project' AS side, project_id AS id FROM dim_project WHERE project_status = 'On hold'
        AND project_id IN (SELECT project_id FROM dim_contract WHERE contract_status = 'P') UNION ALL
        SELECT 'contract', contract_id FROM dim_contract WHERE contract_status = 'P'
        AND project_id IN (SELECT project_id FROM dim_project WHERE project_status = 'On hold')""",
    "awarded_estimated_value": f"""SELECT b.supplier_id, CAST(SUM(CASE WHEN bid_status = 'Odabrana'
        THEN {_m('f.estimated_value')} END) AS DOUBLE) AS estimated_value_awarded
        FROM fact_procurement_bids b LEFT JOIN fact_procurement_performance f USING (procedure_id)
        GROUP BY b.supplier_id""",
    "awarded_savings": f"""SELECT department_id, CAST(SUM(CASE WHEN bid_status = 'Odabrana'
        THEN {_m('procurement_savings')} END) AS DOUBLE) AS procurement_savings_awarded
        FROM fact_procurement_bids LEFT JOIN mv_procurement_savings_kpi USING (procedure_id)
        GROUP BY department_id""",
    "rejected_bid_count": """SELECT procedure_id, NULLIF(COUNT(*) FILTER (bid_status IS DISTINCT FROM 'Odabrana'), 0)
        AS rejected_bid_count FROM fact_procurement_bids GROUP BY procedure_id""",
    "selected_value_measures": f"""SELECT procedure_id, status AS bid_status,
        CASE WHEN status = 'Odabrana' THEN amount END AS awarded_bid_amount,
        CASE WHEN status IS DISTINCT FROM 'Odabrana' THEN amount END AS rejected_bid_amount
        FROM (SELECT procedure_id, {_one('bid_status')} AS status, {_one('bid_amount')} AS amount
        FROM fact_procurement_bids GROUP BY procedure_id)""",
    "savings_pct_by_department": f"""SELECT *, {_ratio('procurement_savings', 'estimated_value')} AS savings_pct FROM (
        SELECT department_id, department_name, {_sum('procurement_savings')} AS procurement_savings,
        {_sum('estimated_value')} AS estimated_value FROM mv_procurement_savings_kpi GROUP BY 1, 2)""",
    "savings_matrix": f"""SELECT level, {_BID_LEVELS}, bid_amount_sum, estimated_value_awarded,
        CASE WHEN status = 'Odabrana' THEN amount END AS awarded_bid_amount,
        CASE WHEN status IS DISTINCT FROM 'Odabrana' THEN amount END AS rejected_bid_amount,
        procurement_savings_awarded FROM (
        SELECT 4 - CAST(bit_count(GROUPING({_BID_LEVELS})) AS BIGINT) AS level, {_BID_LEVELS},
        {_sum('bid_amount')} AS bid_amount_sum,
        CAST(SUM(CASE WHEN bid_status = 'Odabrana' THEN {_m('estimated_value')} END) AS DOUBLE)
        AS estimated_value_awarded, {_one('bid_status')} AS status, {_one('bid_amount')} AS amount,
        CAST(SUM(CASE WHEN bid_status = 'Odabrana' THEN {_m('procurement_savings')} END) AS DOUBLE)
        AS procurement_savings_awarded
        FROM (SELECT s.project_id, s.evidence_number, b.procedure_id, b.bid_id, b.bid_amount, b.bid_status,
        s.estimated_value, s.procurement_savings
        FROM fact_procurement_bids b JOIN mv_procurement_savings_kpi s ON s.procedure_id = b.procedure_id)
        GROUP BY ROLLUP ({_BID_LEVELS}))""",
    "savings_cards": f"""SELECT project_id, {_sum('procurement_savings')} AS procurement_savings,
        COUNT(bid_count) AS bid_count_non_null, {_one('savings_pct')} AS savings_pct,
        CAST(SUM(refused) AS BIGINT) AS rejected_bid_count FROM (SELECT s.*, (SELECT NULLIF(COUNT(*), 0)
        FROM fact_procurement_bids b WHERE b.procedure_id = s.procedure_id
        AND b.bid_status IS DISTINCT FROM 'Odabrana') AS refused FROM mv_procurement_savings_kpi s)
        GROUP BY project_id""",
    "realization_matrix": _REALIZATION_MATRIX,
    "realization_cards": """SELECT project_id, MIN(project_status) AS project_status, MIN(eu_program) AS eu_program,
        MIN(department_id) AS department_id, CAST(SUM(CAST(realization_pct AS DECIMAL(18,4))) AS DOUBLE)
        AS realization_pct FROM mv_project_realization_kpi GROUP BY project_id""",
    "invoice_drilldown": _drilldown(),
    "drillthrough": _drilldown("WHERE p.department_id = 3"),
    "worst_savings_department": f"""SELECT *, {_ratio('procurement_savings', 'estimated_value')} AS savings_pct FROM (
        SELECT s.department_id, s.department_name, {_sum('procurement_savings')} AS procurement_savings,
        {_sum('estimated_value')} AS estimated_value FROM mv_procurement_savings_kpi s
        JOIN dim_project p ON p.project_id = s.project_id AND p.year = 2004 GROUP BY 1, 2)
        WHERE estimated_value > 0 ORDER BY savings_pct, department_id LIMIT 1""",
    "supplier_win_rate": f"""SELECT b.supplier_id, s.supplier_name, COUNT(*) AS bid_count,
        COUNT(*) FILTER (is_awarded) AS wins, {_ratio('COUNT(*) FILTER (is_awarded)', 'COUNT(*)')} AS win_rate
        FROM fact_procurement_bids b LEFT JOIN dim_supplier s ON s.supplier_id = b.supplier_id GROUP BY 1, 2""",
    "profile_columns": _profile("fact_invoices", [
        "invoice_id", "purchase_order_id", "contract_id", "project_id", "issue_date", "due_date", "payment_date",
        "invoice_amount", "currency", "payment_status", "invoice_status", "days_late"]),
    "candidate_keys": "SELECT \"column\", rows FROM (" + _profile("orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    ]) + ") WHERE nulls = 0 AND distinct_values = rows",
    "fk_containment": f"""SELECT COUNT(*) AS child_keys, COUNT(hit) AS matched_keys,
        {_r('COUNT(hit) * 100.0 / COUNT(*)', 4)} AS containment_pct
        FROM (SELECT DISTINCT o_orderkey FROM orders) LEFT JOIN (SELECT DISTINCT l_orderkey AS hit FROM lineitem)
        ON hit = o_orderkey""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, COUNT(*) AS num_entries FROM lineitem
        GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "relationship_check": """SELECT *, declared = 'many_to_one' AND repeated_to_keys = 0 AND orphan_keys = 0
        OR repeated_from_keys = 0 AND repeated_to_keys = 0 AND orphan_keys = 0 AS holds FROM (
        SELECT 'one_to_one' AS declared,
        (SELECT COUNT(*) FROM (SELECT project_id FROM dim_contract GROUP BY 1 HAVING COUNT(*) > 1))
        AS repeated_from_keys,
        (SELECT COUNT(*) FROM (SELECT project_id FROM dim_project GROUP BY 1 HAVING COUNT(*) > 1))
        AS repeated_to_keys,
        (SELECT COUNT(DISTINCT project_id) FROM dim_contract
        WHERE project_id NOT IN (SELECT project_id FROM dim_project)) AS orphan_keys
        UNION ALL SELECT 'many_to_one',
        (SELECT COUNT(*) FROM (SELECT procedure_id FROM fact_procurement_bids GROUP BY 1 HAVING COUNT(*) > 1)),
        (SELECT COUNT(*) FROM (SELECT procedure_id FROM dim_procedure GROUP BY 1 HAVING COUNT(*) > 1)),
        (SELECT COUNT(DISTINCT procedure_id) FROM fact_procurement_bids
        WHERE procedure_id NOT IN (SELECT procedure_id FROM dim_procedure)))""",
    "orphans": """SELECT DISTINCT o_orderkey FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "governed_select": """SELECT n_name, COUNT(*) AS customers FROM customer
        JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
    "catalog_tables": " UNION ALL ".join(
        f"""SELECT '{m.name}' AS table_name, '{m.kind}' AS kind, '{m.grain}' AS grain,
        '{m.description.replace("'", "''")}' AS description,
        (SELECT COUNT(*) FROM {"days" if m.name == "dim_date" else m.name}) AS rows""" for m in GOLD_TABLES),
    **{f"ingest_{name}": _entity(name) for name in _ENTITY_ROWS},
    "governed_answers": """SELECT * FROM (VALUES (1, FALSE, 'n_name, customers', (SELECT COUNT(DISTINCT c_nationkey) FROM customer), FALSE),
        (2, FALSE, 'c_custkey', (SELECT LEAST(COUNT(*), 500) FROM customer), (SELECT COUNT(*) > 500 FROM customer)), (3, TRUE, '', 0, FALSE),
        (4, TRUE, '', 0, FALSE), (5, TRUE, '', 0, FALSE), (6, TRUE, '', 0, FALSE)) v(statement, is_error, columns, row_count, capped)""",
    "catalog_columns": _catalog_columns(_gold_columns()),
    "table_sample": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
        ORDER BY o_orderkey LIMIT 3""",
    "table_document": " UNION ALL ".join(_document(name, columns) for name, columns in _gold_columns().items()),
    "build_gold": " UNION ALL ".join(_built(m.name) for m in GOLD_TABLES),
    "schema_drift": f"""SELECT COALESCE(a.c, b.c) AS "column", CASE WHEN a.c IS NULL THEN 'new' WHEN b.c IS NULL THEN 'missing' ELSE 'retyped' END AS change,
        a.t AS old_type, b.t AS new_type FROM ({_typed_export(1)}) a FULL JOIN ({_typed_export(2)}) b ON a.c = b.c WHERE a.t IS DISTINCT FROM b.t""",
    "widened_types": f"""SELECT c AS "column", CASE WHEN COUNT(DISTINCT t) = 1 THEN MIN(t)
        WHEN bool_and(t IN ('int', 'bigint')) THEN 'bigint' WHEN bool_and(t IN ('int', 'bigint', 'double')) THEN 'double' ELSE 'string' END AS type,
        CASE c WHEN 'o_custkey' THEN (SELECT COUNT(*) FROM orders WHERE o_custkey % 7 = 0) WHEN 'o_batch' THEN (SELECT COUNT(*) FROM orders) ELSE 0 END AS misfits,
        CASE c WHEN 'o_custkey' THEN (SELECT MIN('C' || o_custkey) FROM orders WHERE o_custkey % 7 = 0)
        WHEN 'o_batch' THEN (SELECT MIN(CAST(o_orderkey * 5000000000 AS VARCHAR)) FROM orders) END AS least_misfit
        FROM ({_typed_export(1)} UNION ALL {_typed_export(2)}) GROUP BY c""",
    "history_lookup": f"""SELECT * FROM (WITH counted AS (SELECT customer_id, y, COUNT(*) AS orders, COUNT(amount) AS amounts FROM snap GROUP BY customer_id, y),
        runs AS (SELECT *, SUM(CASE WHEN before IS NULL OR before <> y - 1 OR o <> orders OR a <> amounts THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY y) AS run
        FROM (SELECT *, LAG(y) OVER w AS before, LAG(orders) OVER w AS o, LAG(amounts) OVER w AS a FROM counted WINDOW w AS (PARTITION BY customer_id ORDER BY y))),
        versions AS (SELECT customer_id, orders, amounts, make_timestamp(MIN(y), 12, 31, 0, 0, 0) AS since,
        CASE WHEN MAX(y) < (SELECT MAX(y) FROM snap) THEN make_timestamp(MAX(y) + 1, 12, 31, 0, 0, 0) END AS until FROM runs GROUP BY customer_id, run, orders, amounts),
        asked AS (SELECT event_id, user_id AS customer_id, make_timestamp((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) * 80 + epoch_us(TIMESTAMP '1995-06-01')) AS "at" FROM events)
        SELECT event_id, a.customer_id, a."at" AS "at", v.orders, v.amounts, v.since AS __START_AT FROM asked a LEFT JOIN versions v
        ON a.customer_id = v.customer_id AND v.since <= a."at" AND (v.until IS NULL OR v.until > a."at"))""",
    "graph_selection": _graph_selection(),
    "composite_keys": _composite_keys(),
    "inclusion_dependencies": _inclusions(),
    "vector_store": """SELECT vec_id, CASE WHEN n <= 3 THEN 103 ELSE label END AS label, len(embedding) AS dimensions, TRUE AS only_touched
        FROM (SELECT *, row_number() OVER (ORDER BY vec_id) AS n FROM embeddings)""",
    "trace_quantiles": """SELECT event_type AS event, COUNT(*) AS calls, COUNT(value) AS timed, TRUE AS p5_within, TRUE AS p50_within,
        TRUE AS p95_within, TRUE AS distinct_within FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY event_type""",
    "stream_gate": """SELECT *, (SELECT COUNT(*) FROM events) AS observed_rows,
        (SELECT COUNT(*) FROM events WHERE COALESCE(event_type = 'error', TRUE) OR COALESCE(value >= 90, TRUE)) AS observed_refused FROM (
        SELECT CASE WHEN bad = '' THEN 'kept' ELSE bad END AS place, COUNT(*) AS rows FROM (SELECT concat_ws('+',
        CASE WHEN COALESCE(event_type = 'error', TRUE) THEN 'no_error' END, CASE WHEN COALESCE(value >= 90, TRUE) THEN 'small' END) AS bad FROM events) GROUP BY 1)""",
    "scd2_rerun": _HIST,
    "vector_upsert": """SELECT vec_id, CASE WHEN label = 3 THEN 103 ELSE label END AS label,
        len(embedding) AS dimensions FROM embeddings UNION ALL
        SELECT vec_id + (SELECT MAX(vec_id) FROM embeddings) + 1, label, len(embedding)
        FROM embeddings WHERE label = 4""",
    "trace_summary": f"""SELECT event, model, tool, COUNT(*) AS calls, CAST(SUM({_m('value')}) AS DOUBLE) AS total_s,
        {_r(f"CAST(SUM({_m('value')}) AS DOUBLE) / COUNT(value)", 4)} AS avg_s, MAX(value) AS max_s,
        CAST(SUM(tokens) AS BIGINT) AS input_tokens, CAST(NULL AS BIGINT) AS output_tokens FROM (
        SELECT event_type AS event, value, CASE WHEN event_type IN ('view', 'click') THEN 'm' END AS model,
        CASE WHEN event_type NOT IN ('view', 'click') THEN 't' END AS tool,
        CASE WHEN event_type IN ('view', 'click')
        THEN CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) END AS tokens FROM events)
        GROUP BY event, model, tool""",
}

ORACLE = {
    **{name: _with(body) for name, body in _BODIES.items()},
    "cosine_top_k": _cosine(4),
    "cosine_top_k_all": _cosine_all(4),
    "cosine_top_k_threshold": _cosine(25, "0.2"),
}

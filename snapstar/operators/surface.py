"""Query surface: governed read-only SQL, table catalog, table documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

ROW_CAP = 500
# Functions that run code outside Spark SQL.
FORBIDDEN_FUNCTIONS = {"java_method", "reflect", "try_reflect"}
# Parsed nodes through which a statement could reach what its text does not name as a table.
FORBIDDEN_NODES = ("TableValuedFunction", "TVF", "ScriptTransformation", "UnresolvedIdentifier", "TimeTravel", "TableFunction")


class QueryRejected(Exception):
    """The statement is not a plain query over the allowed tables."""


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _check_parsed(spark: SparkSession, node, allowed: set[str]) -> None:
    """Refuse any relation, table function or function of a parsed tree that is not allowed, in subqueries too.

    A name counts as a common table only where its definition is in scope, so a definition can't lend its name to a
    hidden table inside itself.
    """
    kind = node.getClass().getSimpleName()
    if any(word in kind for word in FORBIDDEN_NODES):
        raise QueryRejected(f"not allowed: {kind}")
    if kind == "UnresolvedRelation":
        parts = _items(node.multipartIdentifier())
        if len(parts) != 1 or parts[0].lower() not in allowed:
            raise QueryRejected(f"table not allowed: {'.'.join(parts)}")
    if kind == "UnresolvedFunction":
        parts = _items(node.nameParts())
        if len(parts) != 1 or parts[0].lower() in FORBIDDEN_FUNCTIONS:
            raise QueryRejected(f"function not allowed: {'.'.join(parts)}")
    visible = allowed
    if kind == "UnresolvedWith":
        for definition in _items(node.cteRelations()):
            _check_parsed(spark, definition.productElement(1), visible)
            visible = visible | {definition.productElement(0).lower()}
    for child in _items(node.children()):
        _check_parsed(spark, child, visible)
    if _is_a(spark, node, "plans.QueryPlan"):
        for expression in _items(node.expressions()):
            _check_parsed(spark, expression, visible)
    elif _is_a(spark, node, "expressions.PlanExpression"):
        _check_parsed(spark, node.plan(), visible)


def _is_a(spark: SparkSession, node, name: str) -> bool:
    return is_instance_of(spark.sparkContext._gateway, node, f"org.apache.spark.sql.catalyst.{name}")


def governed_select(
    spark: SparkSession, query: str, allowed: Mapping[str, Callable[[SparkSession], DataFrame]], cap: int = ROW_CAP,
) -> DataFrame:
    """Run one SELECT that can see only ``allowed`` and returns at most ``cap`` rows.

    Spark's own parser reads the statement, and every table it names must be an allowed one or a common table in scope;
    names with a catalog or database, table functions and functions that run other code are refused by the parsed
    tree. The query then runs in a child session with just the allowed views, inside a subquery, where the grammar
    admits no command, no second statement and no setting. The cap applies to the result, whatever limits the query
    itself contains; ``governed_rows`` tells whether it cut any.
    """
    return _governed(spark, query, allowed).limit(cap)


def governed_rows(
    spark: SparkSession, query: str, allowed: Mapping[str, Callable[[SparkSession], DataFrame]], cap: int = ROW_CAP,
) -> tuple[list[Row], bool]:
    """At most ``cap`` rows of a governed query, and whether there were more."""
    rows = _governed(spark, query, allowed).limit(cap + 1).collect()
    return rows[:cap], len(rows) > cap


@dataclass(frozen=True)
class Answer:
    """What a question by SQL comes to: columns, rows and their number, or why there is none."""

    columns: tuple[str, ...] = ()
    rows: tuple[Row, ...] = ()
    row_count: int = 0
    capped: bool = False
    error: str | None = None


def governed_answer(
    spark: SparkSession, query: str, allowed: Mapping[str, Callable[[SparkSession], DataFrame]], cap: int = ROW_CAP,
) -> Answer:
    """At most ``cap`` rows of a governed query as a whole answer. A refused or failing statement is an answer, too, so that the one who
    asks can mend it; nothing is raised."""
    try:
        found = _governed(spark, query, allowed)
        rows = found.limit(cap + 1).collect()
    except QueryRejected as error:
        return Answer(error=f"refused: {error}")
    except Exception as error:  # whatever the statement's execution runs into
        return Answer(error=f"failed: {str(error).splitlines()[0]}")
    return Answer(tuple(found.columns), tuple(rows[:cap]), min(len(rows), cap), len(rows) > cap)


def _governed(spark: SparkSession, query: str, allowed: Mapping[str, Callable[[SparkSession], DataFrame]]) -> DataFrame:
    wrapped = f"SELECT * FROM (\n{query.strip().rstrip(';')}\n)"
    child = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        child.conf.set(key, spark.conf.get(key))
    child.conf.set("spark.sql.runSQLOnFiles", "false")
    try:
        parsed = child._jsparkSession.sessionState().sqlParser().parsePlan(wrapped)
    except Exception as error:
        raise QueryRejected(str(error).splitlines()[0]) from error
    _check_parsed(spark, parsed, {name.lower() for name in allowed})
    for name, build in allowed.items():
        build(child).createOrReplaceTempView(name)
    try:
        return child.sql(wrapped)
    except Exception as error:
        raise QueryRejected(str(error).splitlines()[0]) from error


@dataclass(frozen=True)
class TableMeta:
    """What is declared about a table; column types come from the table itself."""

    name: str
    kind: str
    grain: str
    description: str
    primary_key: str
    foreign_keys: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    columns: Mapping[str, str] = field(default_factory=dict)  # what a column means, where its name doesn't say it


def catalog_tables(spark: SparkSession, meta: Sequence[TableMeta]) -> DataFrame:
    """One row per table: name, kind, grain, description."""
    rows = [(m.name, m.kind, m.grain, m.description) for m in meta]
    return spark.createDataFrame(rows, "table_name string, kind string, grain string, description string")


def catalog_columns(
    spark: SparkSession, frames: Mapping[str, DataFrame], meta: Sequence[TableMeta], table: str | None = None, described: bool = False,
) -> DataFrame:
    """One row per column with its type, key role and reference, and what it means if ``described``; an unknown table is an error."""
    known = {m.name: m for m in meta}
    if table is not None and table not in known:
        raise KeyError(f"unknown table {table!r}; known: {sorted(known)}")
    rows = []
    for name in [table] if table else list(known):
        m = known[name]
        for position, f in enumerate(frames[name].schema, 1):
            to = m.foreign_keys.get(f.name)
            rows.append((name, position, f.name, f.dataType.simpleString(), f.name == m.primary_key,
                         to and to[0], to and to[1], m.columns.get(f.name, "")))
    listed = spark.createDataFrame(
        rows, "table_name string, position int, column string, type string, is_primary_key boolean, "
              "references_table string, references_column string, description string",
    )
    return listed if described else listed.drop("description")


def sample_rows(df: DataFrame, n: int = 3, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows in key order, so that the sample is the same each time."""
    return df.orderBy(*(order_by or df.columns)).limit(n)


def table_document(frames: Mapping[str, DataFrame], meta: Sequence[TableMeta], n: int = 3) -> DataFrame:
    """One text per table: header, columns and ``n`` sample rows, ready for embedding."""
    documents = []
    for m in meta:
        df = frames[m.name]
        head = (f"Table: {m.name} ({m.kind})\nGrain: {m.grain}\nDescription: {m.description}\nColumns: "
                + ", ".join(f"{f.name} ({f.dataType.simpleString()})" + (f" - {m.columns[f.name]}" if m.columns.get(f.name) else "") for f in df.schema)
                + "\nSample rows:\n")
        cells = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in df.columns]
        sample = sample_rows(df, n, [m.primary_key]).select(
            F.col(m.primary_key).alias("_k"), F.concat_ws(", ", *cells).alias("_line"))
        lines = F.transform(F.array_sort(F.collect_list(F.struct("_k", "_line"))), lambda r: r["_line"])
        documents.append(sample.agg(F.concat(F.lit(head), F.array_join(lines, "\n")).alias("document")).select(
            F.lit(m.name).alias("table_name"), "document"))
    whole = documents[0]
    for d in documents[1:]:
        whole = whole.unionByName(d)
    return whole

"""Compare registered queries with their SQL on one data folder: python -m tests.compare [folder] [name ...]."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb

from __spark_entry__ import oracle_sql, queries
from snapstar.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    """Rows as sorted text, columns by name, one spelling per value."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v: object) -> str:
        if v is None:
            return "NULL"
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark, con, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    got = queries()[name](spark, folder)
    want = con.sql(oracle_sql()[name])
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    theirs = dict(zip(want.columns, (str(t) for t in want.types)))
    loose = [f"{f.name}: {f.dataType.simpleString()} / {theirs[f.name]}" for f in got.schema
             if SQL_TYPES.get(f.dataType.simpleString()) != theirs[f.name]]
    rows = canonical(got.columns, got.collect())
    other = canonical(want.columns, want.fetchall())
    if rows != other:
        bad = [(a, b) for a, b in zip(rows, other) if a != b][:2]
        return f"rows {len(rows)} / {len(other)}; first differences {bad}"
    return f"types {loose}" if loose else None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(queries())
    shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")}
    spark, con = local_session(cores=os.environ.get("CORES", "8"), **shared), duck(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                result = difference(spark, con, folder, name)
            else:
                result = f"rows only: {queries()[name](spark, folder).count()}"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += result is not None and not result.startswith("rows only")
        print(f"{'ok ' if result is None else '-- '} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print("failed", failed, "of", len(names))


if __name__ == "__main__":
    main()

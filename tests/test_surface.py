import numpy as np
import pytest

from snapstar.operators.surface import (
    QueryRejected, TableMeta, catalog_columns, governed_answer, governed_rows, governed_select, table_document,
)
from snapstar.operators.vectors import cosine_top_k, vector_upsert
from snapstar.plans.metadata import GOLD_TABLES
from snapstar.sources.traces import append_traces, read_traces, trace_summary


@pytest.fixture(scope="module")
def allowed(spark):
    spark.range(5).createOrReplaceTempView("hidden")
    return {"numbers": lambda s: s.range(1000).withColumnRenamed("id", "n")}


@pytest.mark.parametrize("sql, rows", [
    ("SELECT n FROM numbers WHERE n < 3", 3),
    ("select n from numbers;", 500),
    ("SELECT n FROM numbers LIMIT 900", 500),
    ("SELECT * FROM (SELECT n FROM numbers LIMIT 10) a, numbers b", 500),
    ("WITH c AS (SELECT max(n) AS m FROM numbers) SELECT m FROM c -- comment", 1),
])
def test_governed_queries_run(spark, allowed, sql, rows):
    assert governed_select(spark, sql, allowed).count() == rows


@pytest.mark.parametrize("sql", [
    "DROP TABLE numbers", "CREATE TABLE t AS SELECT 1", "INSERT INTO numbers VALUES (1)", "SET a = b", "SHOW TABLES",
    "SELECT 1; DROP TABLE numbers", "SELECT 1) UNION ALL SELECT (2; SELECT 3", "SELECT n FROM numbers, hidden",
    "SELECT * FROM hidden", "SELECT * FROM parquet.`/tmp/x`", "SELECT * FROM (SELECT * FROM hidden) numbers",
    "SELECT reflect('java.lang.System', 'currentTimeMillis')", "CACHE TABLE numbers",
    "SELECT TRANSFORM(n) USING 'cat' AS (x) FROM numbers", "SELECT java_method('java.lang.System', 'nanoTime')",
])
def test_everything_else_is_rejected(spark, allowed, sql):
    with pytest.raises(QueryRejected):
        governed_select(spark, sql, allowed)


@pytest.mark.parametrize("sql", [
    "SELECT * FROM global_temp.secret", "SELECT * FROM default.kept", "SELECT * FROM spark_catalog.default.kept",
    "SELECT * FROM kept", "SELECT n FROM numbers WHERE n IN (SELECT id FROM kept)",
    "SELECT (SELECT max(id) FROM global_temp.secret) AS m FROM numbers", "WITH kept AS (SELECT * FROM kept) SELECT * FROM kept",
    "SELECT " + ", ".join(f"n + {i} AS c{i}" for i in range(60)) + ", java_method('java.lang.System', 'nanoTime') AS x FROM numbers",
    "SELECT * FROM range(10)", "SELECT n, x FROM numbers, LATERAL explode(array(1, 2)) AS t(x)",
    "SELECT * FROM IDENTIFIER('global_temp.secret')", "SELECT n FROM numbers WHERE EXISTS (SELECT 1 FROM kept)",
    "SELECT n FROM numbers ORDER BY (SELECT max(id) FROM kept)", "SELECT spark_catalog.default.f(n) FROM numbers",
    "SELECT n FROM numbers UNION ALL SELECT id FROM kept", "SELECT a.n FROM numbers a JOIN kept b ON a.n = b.id",
])
def test_nothing_else_is_reached(spark, allowed, sql):
    spark.range(5).createOrReplaceGlobalTempView("secret")
    spark.sql("DROP TABLE IF EXISTS kept")
    spark.range(5).write.mode("overwrite").saveAsTable("kept")
    try:
        with pytest.raises(QueryRejected):
            governed_select(spark, sql, allowed)
    finally:
        spark.sql("DROP TABLE kept")


def test_literals_are_no_functions_and_the_cap_is_told(spark, allowed):
    assert governed_select(spark, "SELECT 'reflect(' AS x, n FROM numbers LIMIT 2", allowed).count() == 2
    assert [r.n for r in governed_rows(spark, "SELECT n FROM numbers ORDER BY n", allowed, cap=2)[0]] == [0, 1]
    assert [governed_rows(spark, "SELECT n FROM numbers", allowed, cap=c)[1] for c in (999, 1000)] == [True, False]


def test_order_survives_the_cap(spark, allowed):
    got = governed_select(spark, "SELECT n FROM numbers ORDER BY n DESC", allowed, cap=3)
    assert [r["n"] for r in got.collect()] == [999, 998, 997]


def test_catalog(spark):
    assert len(GOLD_TABLES) == 16
    meta = [TableMeta("t", "fact", "g", "d", "id", {"p": ("parent", "id")})]
    frames = {"t": spark.createDataFrame([(2, 5), (1, None)], "id int, p int")}
    got = [tuple(r) for r in catalog_columns(spark, frames, meta).orderBy("position").collect()]
    assert got == [("t", 1, "id", "int", True, None, None), ("t", 2, "p", "int", False, "parent", "id")]
    with pytest.raises(KeyError):
        catalog_columns(spark, frames, meta, "nope")
    text = table_document(frames, meta, 3).first()["document"]
    assert text.endswith("Columns: id (int), p (int)\nSample rows:\nid=1, p=null\nid=2, p=5")


def brute_force(queries, corpus, k):
    out = set()
    for qid, q in queries:
        sims = sorted(((-round(float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)), 10), i)
                       for i, v in corpus if np.linalg.norm(v)))
        out |= {(qid, i, rank + 1) for rank, (_, i) in enumerate(sims[:k])}
    return out


@pytest.mark.parametrize("bound", [100, 2])
def test_cosine_matches_brute_force_in_blocks(spark, bound):
    rng = np.random.default_rng(1)
    corpus = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    corpus += [(100 + i, corpus[0][1]) for i in range(20)]  # many equal copies
    corpus.append((999, [0.0] * 5))
    queries = [(i, corpus[i][1]) for i in range(6)]
    q = spark.createDataFrame(queries, "query_id bigint, query_vector array<double>")
    c = spark.createDataFrame(corpus, "vec_id bigint, embedding array<double>").repartition(3)
    got = cosine_top_k(q, c, 4, block_rows=bound).collect()
    assert {(r["query_id"], r["vec_id"], r["rank"]) for r in got} == brute_force(queries, corpus, 4)
    strict = cosine_top_k(q, c, 4, min_sim=0.9, block_rows=bound).collect()
    assert {tuple(r) for r in strict} == {tuple(r) for r in got if r["similarity"] >= 0.9}


def test_vector_upsert(spark):
    store = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "id int, v string")
    assert sorted(map(tuple, vector_upsert(store, batch, "id").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_traces_of_two_shapes(spark, tmp_path):
    path = str(tmp_path / "log")
    append_traces(spark.createDataFrame([("model_call", "m", 1.5, 10)],
                                        "event string, model string, elapsed_s double, input_tokens bigint"), path)
    append_traces(spark.createDataFrame([("tool_call", "t", 0.5), ("tool_call", "t", 2.5)],
                                        "event string, tool string, elapsed_s double"), path)
    got = {r["event"]: r for r in trace_summary(read_traces(spark, path), quantiles=[0.5]).collect()}
    assert (got["tool_call"]["calls"], got["tool_call"]["avg_s"], got["tool_call"]["input_tokens"]) == (2, 1.5, None)
    assert (got["model_call"]["input_tokens"], got["model_call"]["p50_s"]) == (10, 1.5)


def test_answers_carry_columns_rows_and_errors(spark, allowed):
    whole = governed_answer(spark, "SELECT n AS a, n + 1 AS b FROM numbers WHERE n < 2 ORDER BY n", allowed)
    assert (whole.columns, [tuple(r) for r in whole.rows], whole.row_count, whole.capped, whole.error) == (("a", "b"), [(0, 1), (1, 2)], 2, False, None)
    cut = governed_answer(spark, "SELECT n FROM numbers", allowed, cap=7)
    assert (cut.row_count, len(cut.rows), cut.capped) == (7, 7, True)
    assert governed_answer(spark, "SELECT n FROM numbers LIMIT 7", allowed, cap=7).capped is False
    for sql, start in (("DELETE FROM numbers", "refused"), ("SELECT * FROM hidden", "refused"), ("SELECT nope FROM numbers", "refused"),
                       ("SELECT raise_error('no') FROM numbers", "failed"), ("", "refused")):
        answer = governed_answer(spark, sql, allowed)
        assert answer.error.startswith(start) and not answer.rows and not answer.columns


def test_columns_are_described(spark):
    meta = [TableMeta("t", "fact", "one row per id", "Things.", "id", columns={"v": "what it is worth"})]
    frames = {"t": spark.createDataFrame([(1, 2.0)], "id int, v double")}
    got = {r["column"]: r["description"] for r in catalog_columns(spark, frames, meta, described=True).collect()}
    assert got == {"id": "", "v": "what it is worth"}
    assert "v (double) - what it is worth" in table_document(frames, meta).first()["document"]
    used = {f for m in GOLD_TABLES for f in m.columns}
    assert len(used) > 30

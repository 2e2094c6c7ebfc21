"""Keys, inclusions, types, selections, lookups in time, vectors and gates against plain counterparts."""

import random
import time
from datetime import datetime, timedelta
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snapstar.operators import profile
from snapstar.operators.point_in_time import valid_versions
from snapstar.operators.profile import composite_keys, inclusion_dependencies
from snapstar.operators.relations import Relationship, select_across
from snapstar.operators.snapshots import END, START
from snapstar.operators.vectors import VectorStore, _best, cosine_top_k, unit_rows, visited_share
from snapstar.plans.metadata import GOLD_TABLES, RELATIONSHIPS
from snapstar.sources import landing
from snapstar.sources.landing import retyped, widened, widest_types
from snapstar.sources.traces import daily_sketches, merged_summary, rank_errors
from snapstar.streaming.gate import BatchCounts, gate_stream, read_gate

from .test_surface import brute_force


# Lookup in time

@pytest.mark.parametrize("hot_events", [10**6, 5])
def test_valid_versions(spark, hot_events):
    pick, day = random.Random(4), timedelta(days=1)
    start = datetime(2024, 1, 1)
    versions, events = [], []
    for key in (None, "a", "b", "c", "hot"):
        at = start
        for v in range(pick.randint(0, 12) if key != "hot" else 40):
            since = at + pick.randint(0, 2) * day
            at = since + pick.randint(1, 4) * day
            versions.append((key, since, at, f"{key}{v}"))
        if versions and versions[-1][0] == key and pick.random() < 0.5:
            versions[-1] = (*versions[-1][:2], None, versions[-1][3])
        for e in range(20 if key != "hot" else 300):
            events.append((key, start + pick.randint(-2, 130) * day, f"{key}/{e}"))
    events += [("a", None, "no time"), ("nobody", start, "no key")]
    asked = spark.createDataFrame(events, "k string, t timestamp, name string")
    known = spark.createDataFrame([(k, a, b, v) for k, a, b, v in versions], f"k string, {START} timestamp, {END} timestamp, name string")
    got = valid_versions(asked.repartition(3), known.repartition(3), ["k"], "t", ["name", START], hot_events=hot_events, ranges=8)
    assert got.columns == ["k", "t", "name", "valid_name", START]
    want = []
    for k, t, name in events:
        found = [(v, s) for key, s, e, v in versions if key == k and t is not None and s <= t and (e is None or e > t)]
        want.append((k, t, name, *(found[0] if found else (None, None))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


# Selections over the graph

def test_select_across_a_small_tree(spark):
    frames = {"d": spark.createDataFrame([(1,), (2,), (3,)], "d int"),
              "p": spark.createDataFrame([(10, 1), (11, 1), (20, 2), (30, None)], "p int, d int"),
              "c": spark.createDataFrame([(100, 10, "P"), (101, 10, "F"), (110, 11, "F"), (200, 20, "P")], "c int, p int, s string"),
              "x": spark.createDataFrame([(1,)], "x int")}
    tree = [Relationship("p", "d", "d", "d"), Relationship("c", "p", "p", "p")]

    def ids(selections, **how):
        return {t: sorted(r[0] for r in df.collect()) for t, df in select_across(frames, tree, selections, **how).items()}

    everything = {"d": [1, 2, 3], "p": [10, 11, 20, 30], "c": [100, 101, 110, 200], "x": [1]}
    assert ids({}) == everything
    assert ids({"c": F.col("s") == "P"}) == {"d": [1, 2], "p": [10, 20], "c": [100, 200], "x": [1]}
    assert ids({"c": F.col("s") == "P", "d": F.col("d") == 1}) == {"d": [1], "p": [10], "c": [100], "x": [1]}
    # As declared, a selection only travels to the many side.
    assert ids({"c": F.col("s") == "P"}, all_ways=False) == {**everything, "c": [100, 200]}
    assert ids({"d": F.col("d") == 1}, all_ways=False) == {"d": [1], "p": [10, 11], "c": [100, 101, 110], "x": [1]}
    with pytest.raises(ValueError, match="cycle"):
        select_across(frames, [*tree, Relationship("c", "c", "d", "d")], {})


def test_relationships_make_a_tree_over_all_tables():
    assert len(RELATIONSHIPS) == len(GOLD_TABLES) - 1
    assert {t for r in RELATIONSHIPS for t in (r.from_table, r.to_table)} == {m.name for m in GOLD_TABLES}


# Keys and inclusions

def test_composite_keys(spark):
    rows = [(i, i // 10, i % 10, i % 7, None if i == 3 else i, "x", i / 3) for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, a int, b int, c int, n int, x string, f double")
    got = {(r["columns"], r["size"]) for r in composite_keys(frame).collect()}
    assert got >= {("id", 1), ("f", 1), ("a, b", 2)}
    for columns, _ in got:  # minimal keys, no more and no less
        names = columns.split(", ")
        assert "n" not in names and frame.select(*names).distinct().count() == 200
        assert all(frame.select(*(set(names) - {c})).distinct().count() < 200 for c in names if len(names) > 1)
    assert composite_keys(frame.limit(0)).count() == 0
    assert composite_keys(frame.unionByName(frame)).count() == 0


def test_inclusion_dependencies(spark):
    a = spark.createDataFrame([(i, f"s{i % 4}", float(i)) for i in range(20)] + [(None, None, None)], "id bigint, s string, f double")
    b = spark.createDataFrame([(i % 5, f"s{i}") for i in range(10)], "ref int, t string")
    got = {(r.table_name, r.column, r.references_table, r.references_column, r.distinct_values, r.matched_values, r.share_pct)
           for r in inclusion_dependencies({"a": a, "b": b}, least_pct=40.0).collect()}
    assert got == {("b", "ref", "a", "id", 5, 5, 100.0), ("a", "s", "b", "t", 4, 4, 100.0), ("b", "t", "a", "s", 10, 4, 40.0)}
    assert inclusion_dependencies({"a": a.limit(0), "b": b}).count() == 0


# Types

def test_types_widen_over_exports(spark):
    first = spark.createDataFrame([("1", "1.5", "2024-01-01", "x", None, "true"), ("-2", "7", "2024-02-01", "1", "", "false")], "i string, d string, t string, s string, n string, b string")
    second = spark.createDataFrame([("5000000000", "oops", "2024-01-01 10:00:00", "x", "3", "1")], first.schema)
    types = lambda s: {f.name: f.dataType.simpleString() for f in s}
    one, two = widest_types(first), widest_types(second)
    assert types(one) == {"i": "int", "d": "double", "t": "date", "s": "string", "n": "string", "b": "boolean"}
    assert types(two) == {"i": "bigint", "d": "string", "t": "timestamp", "s": "string", "n": "int", "b": "int"}
    assert types(widened(one, two)) == {"i": "bigint", "d": "string", "t": "timestamp", "s": "string", "n": "string", "b": "string"}
    assert widened(one, two).fieldNames() == one.fieldNames()
    row = retyped(second.withColumn("more", F.lit("m")), one).first()
    assert row["_misfits"] == {"i": "5000000000", "d": "oops", "more": "m"} | ({"t": "2024-01-01 10:00:00"} if row["t"] is None else {})
    assert (row["i"], row["d"], row["n"], row["b"]) == (None, None, "3", True)
    assert retyped(first, one).filter(F.size("_misfits") > 0).count() == 0


# Sketches

def test_sketches_of_days_merge_to_those_of_the_range(spark):
    days = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("event"), F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"),
        F.when(F.col("id") % 10 != 0, F.pow(F.col("id").cast("double") % 1000, F.lit(2.0))).alias("elapsed_s"), (F.col("id") % 5000).cast("string").alias("input"))
    sketches = daily_sketches(days)
    assert sketches.count() > 30
    levels = [0.01, 0.5, 0.99]
    answers = merged_summary(sketches, levels, first="2023-11-16", last="2023-11-28")
    chosen = days.filter("to_date(ts) BETWEEN '2023-11-16' AND '2023-11-28'")
    exact = {r.event: r for r in chosen.groupBy("event").agg(F.count("*").alias("calls"), F.count("elapsed_s").alias("timed"), F.count_distinct("input").alias("d")).collect()}
    for r in answers.collect():
        assert (r.calls, r.timed) == (exact[r.event].calls, exact[r.event].timed)
        assert abs(r.distinct_values / exact[r.event].d - 1) < 0.05
    errors = rank_errors(chosen, answers, levels).collect()
    assert len(errors) == 2 and all(r[f"p{q}_within"] for r in errors for q in (1, 50, 99))
    wrong = rank_errors(chosen, answers.withColumn("p50_s", F.col("p99_s")), levels).collect()
    assert not any(r.p50_within for r in wrong)


# Gate

def test_gate_splits_counts_and_survives_a_repeat(spark, tmp_path):
    base = str(tmp_path)
    schema = "id int, v int"
    spark.createDataFrame([(1, 5), (2, -5), (3, None)], schema).write.parquet(f"{base}/in")
    rules = {"positive": "v > 0", "odd": F.col("id") % 2 == 1}
    counts = BatchCounts()
    spark.streams.addListener(counts)
    try:
        for rows in ([], [(4, 4), (5, 1)], []):
            if rows:
                spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/in")
            gate_stream(spark.readStream.schema(schema).parquet(f"{base}/in"), rules, f"{base}/out", f"{base}/checkpoint")
        for _ in range(100):
            if len(counts.batches) == 2:
                break
            __import__("time").sleep(0.05)
    finally:
        spark.streams.removeListener(counts)
    types = spark.createDataFrame([], schema).schema
    kept = sorted(map(tuple, read_gate(spark, f"{base}/out", types).collect()))
    refused = sorted(map(tuple, read_gate(spark, f"{base}/out", types, refused=True).collect()))
    assert kept == [(1, 5, 0), (5, 1, 1)]
    assert refused == [(2, -5, ["positive", "odd"], 0), (3, None, ["positive"], 0), (4, 4, ["odd"], 1)]
    assert counts.batches == {0: {"rows": 3, "refused": 2, "positive": 2, "odd": 1}, 1: {"rows": 2, "refused": 1, "positive": 0, "odd": 1}}


# Vectors

def clustered(rng, n, width=8, groups=20):
    centers = rng.normal(size=(groups, width))
    return centers[rng.integers(0, groups, n)] + 0.05 * rng.normal(size=(n, width))


def test_top_k_of_many_queries_in_small_blocks(spark):
    rng = np.random.default_rng(2)
    corpus = [(i, v.tolist()) for i, v in enumerate(clustered(rng, 400))]
    corpus += [(1000 + i, corpus[3][1]) for i in range(60)]
    odd = [(2000, None), (2001, [0.0] * 8), (2002, [1.0] * 7), (2003, [float("nan")] * 8), (2004, [None] + [1.0] * 7)]
    queries = [(i, v.tolist()) for i, v in enumerate(clustered(rng, 150))]
    q = spark.createDataFrame(queries + odd[:4], "query_id bigint, query_vector array<double>").repartition(4)
    c = spark.createDataFrame(corpus + odd, "vec_id bigint, embedding array<double>").repartition(3)
    for block in (7, 4096):
        got = cosine_top_k(q, c, 5, block_rows=block).collect()
        assert {(r["query_id"], r["vec_id"], r["rank"]) for r in got} == brute_force(queries, corpus, 5)
    assert cosine_top_k(q, c.limit(0)).count() == cosine_top_k(q.limit(0), c).count() == 0


def test_bounds_rule_out_most_pairs_of_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    both = clustered(rng, 4000, groups=60)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both[:3000])], "vec_id bigint, embedding array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both[3000:])], "query_id bigint, query_vector array<double>")
    assert visited_share(q, c) < 0.2


def test_vector_store_rewrites_touched_buckets_only(spark, tmp_path):
    rows = spark.range(200).selectExpr("id AS vec_id", "array(float(id), float(1)) AS embedding", "0 AS label")
    store = VectorStore(spark, str(tmp_path / "v"), rows.schema, "vec_id", buckets=16)
    assert store.read().count() == 0 and store.upsert(rows.limit(0)) == []
    assert len(store.upsert(rows)) == 16
    change = rows.filter("vec_id IN (3, 4)").withColumn("label", F.lit(7)).unionByName(rows.limit(1).withColumn("vec_id", F.lit(900).cast("bigint")))
    touched = store.upsert(change)
    assert len(touched) <= 3 and set(store.writes()[2]) == set(touched)
    got = {r.vec_id: r.label for r in store.read().collect()}
    assert got == {**{i: 0 for i in range(200)}, 3: 7, 4: 7, 900: 0}
    # A write that died before its record is not read, and can be repeated.
    rows.withColumn("label", F.lit(99)).withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(str(tmp_path / "v" / "_write=3"))
    assert {r.vec_id: r.label for r in store.read().collect()} == got
    assert store.upsert(change) == touched and {r.vec_id: r.label for r in store.read().collect()} == got


def test_texts_that_are_no_numbers_are_refused_by_their_look(spark):
    """A look must refuse no double that Spark reads; and no cast may run into an error for each row of text, which is slow."""
    texts = ["0x1p3", "0X1.8P1d", "1e5", "1E+5", "1.", "1.5d", "2F", ".5e-3", "+1", "1e400", "1e", "1_0", "1.2.3", "2024-01-01", "5-LOW", "0x10", "1 x"]
    texts += ["".join(t) for n in (2, 3, 4) for t in product("0.e+xpd-", repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    reads = F.col("t").try_cast("double").isNotNull() & F.col("t").rlike(r"^[+-]?(\d|\.\d)")
    number = landing._kind(F.col("t")).isin([landing._bit(t) for t in landing.LATTICE[0]])
    assert df.filter(number != reads).count() == 0

    def seconds(text):
        frame = spark.range(200_000, numPartitions=1).select(F.concat(F.col("id").cast("string"), F.lit(text)).alias("t"))
        landing.widest_types(frame)
        start = time.perf_counter()
        landing.widest_types(frame)
        return time.perf_counter() - start

    assert seconds("-LOW") < 3 * seconds(".5") + 0.2


def test_only_keys_are_counted_over_all_rows(spark, monkeypatch):
    """A set that repeats values is found out in one slice of them, and a repeated value outside it by the exact count."""
    looked = []

    def spy(hashed, columns, sets, sliced, real=profile._repeated):
        looked.append((sliced, len(sets), real(hashed, columns, sets, sliced)))
        return looked[-1][2]

    monkeypatch.setattr(profile, "_repeated", spy)
    df = spark.range(20_000).select("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id")).alias("nearly"), (F.col("id") - F.col("id") % 10 * (F.col("id") % 9 == 0).cast("int")).alias("often"))
    assert [tuple(r) for r in composite_keys(df, most=1).collect()] == [("id", 1, 20_000)]
    # "often" is out before the exact count; "nearly" has a single repeated value, which may lie in any slice.
    assert looked[0][0] and looked[0][1] == 3 and len(looked[0][2]) >= 1 and not looked[1][0] and looked[1][1] <= 2


def test_vectors_become_rows_without_a_loop_and_only_what_reaches_a_bound_is_kept():
    listed = pa.array([[9.0, 9.0], [3.0, 4.0], None, [1.0], [0.0, 0.0], [None, 1.0], [float("inf"), 1.0], [0.0, -2.0]], pa.list_(pa.float32()))
    rows = unit_rows(listed.slice(1), 2)
    assert rows[[0, 6]].tolist() == [[0.6, 0.8], [0.0, -1.0]] and np.isnan(rows[1:6]).any(1).all()
    sims = np.array([[0.5, 0.9, 0.5 + 1e-12, 0.1], [0.2, 0.1, 0.2, 0.2], [0.1, 0.1, 0.1, 0.1]])
    at, place, values = _best(sims, np.array([0.4, 0.0, 0.8]), 2)
    assert list(zip(at.tolist(), place.tolist(), values.tolist())) == [(0, 1, 0.9), (0, 0, 0.5), (1, 0, 0.2), (1, 2, 0.2)]


def test_many_queries_of_one_file_are_dealt_out_and_floats_move_as_floats(spark, tmp_path):
    rng = np.random.default_rng(4)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 6)).astype(np.float32))]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "v"))
    c = spark.read.parquet(str(tmp_path / "v"))
    q = c.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = cosine_top_k(q, c, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [qid" in plan and "array<double>" not in plan
    assert {(r["query_id"], r["vec_id"], r["rank"]) for r in found.collect()} == brute_force(vectors, vectors, 3)

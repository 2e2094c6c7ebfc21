import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from snapstar.operators.profile import candidate_keys, profile
from snapstar.operators.quality import (
    ExpectationFailed, check, duplicate_keys, expect, fk_containment, orphans, relationship_check, require,
    schema_drift, uniqueness,
)
from snapstar.operators.relations import cross_filter


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "k int, v string")


def test_expect_drop_and_warn(rows):
    assert expect(rows, "has key", "k > 1", "drop").count() == 2
    seen = Observation("keys")
    assert expect(rows, "has key", F.col("k") > 1, "warn", seen).count() == 4
    assert seen.get == {"rows": 4, "violations": 2}


def test_expect_fail_aborts_the_job(rows):
    assert expect(rows, "any", "v IS NOT NULL").count() == 4
    with pytest.raises(Exception, match="expectation failed: has key"):
        expect(rows, "has key", "k > 0").select("v").collect()


def test_require_counts_first(rows):
    require(rows, "has value", "v IS NOT NULL")
    with pytest.raises(ExpectationFailed, match="unique: 1 of 3"):
        require(uniqueness(rows, ["k"]), "unique", "num_entries = 1")
    assert tuple(check(rows, "x", "k IS NOT NULL").first()) == ("x", 4, 1)


def test_unknown_action(rows):
    with pytest.raises(ValueError):
        expect(rows, "x", "true", "ignore")


def test_profile(spark, rows):
    got = {r["column"]: tuple(r)[1:] for r in profile(rows).collect()}
    assert got == {"k": (4, 1, 25.0, 2), "v": (4, 0, 0.0, 3)}
    near = {r["column"]: r["distinct_values"] for r in profile(rows, approximate=True).collect()}
    assert near == {"k": 2, "v": 3}
    zeros = spark.createDataFrame([(0.0, [1]), (-0.0, [1])], "z double, a array<int>")
    assert {r["distinct_values"] for r in profile(zeros).collect()} == {1}
    assert [r["column"] for r in candidate_keys(spark.range(3).withColumn("c", F.lit(1))).collect()] == ["id"]


def test_keys_and_relationships(spark, rows):
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    assert [r["k"] for r in orphans(rows, "k", parent, "id").collect()] == [2]
    assert tuple(fk_containment(rows, "k", parent, "id").first()) == (2, 1, 50.0)
    assert [tuple(r) for r in duplicate_keys(rows, ["k"]).collect()] == [(2, 2)]
    assert tuple(relationship_check(rows, "k", parent, "id").first()) == ("many_to_one", 1, 0, 1, False)
    whole = spark.createDataFrame([(1,), (2,)], "id int")
    assert relationship_check(rows, "k", whole, "id").first()["holds"]
    assert not relationship_check(rows, "k", whole, "id", "one_to_one").first()["holds"]


def test_cross_filter_works_both_ways(spark, rows):
    other = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k int, w string")
    a, b = cross_filter(rows, other, "k", on_b=F.col("w") == "x")
    assert [r["v"] for r in a.collect()] == ["a"]
    a, b = cross_filter(rows, other, "k", on_a=F.col("v") == "b")
    assert [r["w"] for r in b.collect()] == ["y"]


def test_schema_drift(spark):
    old = spark.createDataFrame([], "a int, b string, c date").schema
    new = spark.createDataFrame([], "a double, c date, d int").schema
    got = {tuple(r) for r in schema_drift(spark, old, new).collect()}
    assert got == {("a", "retyped", "int", "double"), ("b", "missing", "string", None), ("d", "new", None, "int")}
    assert schema_drift(spark, old, old).count() == 0

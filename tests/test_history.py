from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapstar.operators.history import (
    apply_snapshot_scd1, apply_snapshot_scd2, lost_keys, replay_scd2, snapshot_deletes, snapshot_diff,
)
from snapstar.operators.snapshots import (
    END, RESCUED, SNAPSHOT_TS, START, as_of, current, dedup_by_key, latest_snapshot, lookup_join, slice_by,
)
from snapstar.streaming.history import HistoryTable

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
UNTRACKED = (SNAPSHOT_TS, RESCUED)
SCHEMA = f"id string, amount int, {RESCUED} string, {SNAPSHOT_TS} timestamp"
# I1 unchanged; I2 changes at T2; I3 leaves at T2 and returns; I4 arrives at T2; I5 differs in untracked columns only.
EXPORTS = [
    ("I1", 1, None, T1), ("I2", 2, None, T1), ("I3", 3, None, T1), ("I5", 5, "a", T1),
    ("I1", 1, None, T2), ("I2", 20, None, T2), ("I4", None, None, T2), ("I5", 5, "b", T2),
    ("I1", 1, None, T3), ("I2", 20, None, T3), ("I3", 3, None, T3), ("I4", None, None, T3), ("I5", 5, "c", T3),
]
EXPECTED = {
    ("I1", 1, T1, None), ("I2", 2, T1, T2), ("I2", 20, T2, None), ("I3", 3, T1, T2), ("I3", 3, T3, None),
    ("I4", None, T2, None), ("I5", 5, T1, None),
}


def versions(df):
    rows = [tuple(r) for r in df.select("id", "amount", START, END).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def fold(spark, bronze, stamps):
    history = bronze.limit(0).withColumns({START: F.lit(None).cast("timestamp"), END: F.lit(None).cast("timestamp")})
    for at in stamps:
        history = apply_snapshot_scd2(history, bronze.filter(F.col(SNAPSHOT_TS) == F.lit(at)), ["id"], at, UNTRACKED)
        history = spark.createDataFrame(history.collect(), history.schema)
    return history


def test_fixture_versions(spark):
    bronze = spark.createDataFrame(EXPORTS, SCHEMA)
    replayed = replay_scd2(bronze, ["id"], untracked=UNTRACKED)
    assert versions(replayed) == EXPECTED
    folded = fold(spark, bronze, (T1, T2, T3))
    assert versions(folded) == EXPECTED
    assert {tuple(r) for r in folded.select(*replayed.columns).collect()} == {tuple(r) for r in replayed.collect()}
    assert current(replayed).filter("id = 'I5'").first()[RESCUED] == "c"  # the newest untracked value
    assert versions(as_of(replayed, "2024-02-15")) == {
        ("I1", 1, T1, None), ("I2", 20, T2, None), ("I4", None, T2, None), ("I5", 5, T1, None)}
    assert lost_keys(bronze, replayed, ["id"]).count() == 0


def test_same_snapshot_twice_changes_nothing(spark):
    bronze = spark.createDataFrame(EXPORTS, SCHEMA)
    history = replay_scd2(bronze, ["id"], untracked=UNTRACKED)
    again = apply_snapshot_scd2(history, latest_snapshot(bronze), ["id"], "2024-04-01", UNTRACKED)
    assert versions(again) == EXPECTED


def test_replay_without_broadcast_is_the_same(spark):
    bronze = spark.createDataFrame(EXPORTS, SCHEMA)
    assert versions(replay_scd2(bronze, ["id"], untracked=UNTRACKED, unique_per_snapshot=True)) == EXPECTED


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(
    st.tuples(st.sampled_from("abcd"), st.one_of(st.none(), st.integers(0, 1)), st.integers(0, 3)),
    min_size=1, max_size=14))
def test_fold_equals_replay(spark, cells):
    stamps = [datetime(2024, 1, d + 1) for d in sorted({d for _, _, d in cells})]
    rows = [(k, v, None, datetime(2024, 1, d + 1)) for k, v, d in cells]
    bronze = spark.createDataFrame(rows, SCHEMA)
    replayed, folded = replay_scd2(bronze, ["id"], untracked=UNTRACKED), fold(spark, bronze, stamps)
    found = versions(replayed)
    assert found == versions(folded)
    live = {k for k, _, d in cells if datetime(2024, 1, d + 1) == stamps[-1]}
    assert sorted(k for k, _, _, end in found if end is None) == sorted(live)
    for key in "abcd":  # validity windows follow each other without overlap
        spans = sorted((s, e or datetime.max) for k, _, s, e in found if k == key)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_stored_history(spark, tmp_path):
    bronze = spark.createDataFrame(EXPORTS, SCHEMA)
    table = HistoryTable(spark, str(tmp_path / "h"), bronze.schema, ["id"], UNTRACKED)
    assert table.read().count() == 0
    assert table.apply_all(bronze) == 3
    assert versions(table.read()) == EXPECTED
    assert table.apply_all(bronze) == 0  # nothing newer
    assert versions(table.current()) == {v for v in EXPECTED if v[3] is None}
    # A run that died before its commit leaves files that are not read.
    junk = spark.createDataFrame([("X", 1, None, T3, T3, None)], table._stored)
    junk.write.parquet(str(tmp_path / "h" / "_version=9999999999999999" / "is_current=true"))
    assert versions(table.read()) == EXPECTED


def test_everything_deleted(spark, tmp_path):
    bronze = spark.createDataFrame(EXPORTS[:4], SCHEMA)
    table = HistoryTable(spark, str(tmp_path / "h"), bronze.schema, ["id"], UNTRACKED)
    table.apply_all(bronze)
    table.apply(bronze.limit(0), T2)
    assert table.current().count() == 0
    assert {v[3] for v in versions(table.read())} == {T2}


def test_scd1_overwrites_and_deletes(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, v int, note string")
    new = spark.createDataFrame([("b", 3), ("c", 4), ("c", 4)], "id string, v int")
    got = {tuple(r) for r in apply_snapshot_scd1(old, new, ["id"]).collect()}
    assert got == {("b", 3, None), ("c", 4, None)}


def test_snapshot_diff_and_deletes(spark):
    bronze = spark.createDataFrame(EXPORTS, SCHEMA)
    one, two = (bronze.filter(F.col(SNAPSHOT_TS) == F.lit(t)) for t in (T1, T2))
    got = {r["change"]: r["rows"] for r in snapshot_diff(one, two, ["id"], UNTRACKED).collect()}
    assert got == {"inserted": 1, "deleted": 1, "updated": 1, "unchanged": 2}
    assert [r["id"] for r in snapshot_deletes(one, two, ["id"]).collect()] == ["I3"]


def test_dedup_is_deterministic_and_prunes_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr(
        "CASE WHEN id < 999 THEN 'hot' ELSE 'cold' END AS k", "CAST(id % 7 AS int) AS v", "CAST(id AS string) AS w")
    assert {tuple(r) for r in dedup_by_key(df, ["k"]).collect()} == {("hot", 0, "0"), ("cold", 5, "999")}
    assert dedup_by_key(df.withColumn("x", -F.col("v")), ["k"], ["x"]).filter("k = 'hot'").first()["v"] == 6
    plan = dedup_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial")  # the partial limit runs below the exchange


def test_lookup_join_of_every_kind(spark):
    big = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN 0 ELSE id END AS k", "id AS v")
    small = spark.range(2000).selectExpr("id AS k", "id * 2 AS twice")
    counts = {"inner": 1000, "left": 1000, "right": 2899, "full": 2899}
    limit = "spark.sql.autoBroadcastJoinThreshold"
    for threshold in ("10m", "-1"):  # a lookup that counts as small, and one that doesn't
        before = spark.conf.get(limit)
        spark.conf.set(limit, threshold)
        try:
            assert {how: lookup_join(big, small, "k", how).count() for how in counts} == counts
        finally:
            spark.conf.set(limit, before)


def test_null_keys_equal_each_other(spark):
    frame = spark.createDataFrame([(None, 1), ("a", 2)], "id string, amount int")
    assert snapshot_deletes(frame, frame, ["id"]).count() == 0
    assert lost_keys(frame, frame, ["id"]).count() == 0
    assert [tuple(r) for r in lost_keys(frame, frame.filter("id = 'a'"), ["id"]).collect()] == [(None,)]


def test_slicer(spark):
    df = spark.range(5)
    assert slice_by(df, "id", [1, 3]).count() == 2
    assert slice_by(df, "id", []).count() == 5

"""A stored history under exports and re-datings in every order of arrival."""

from datetime import datetime
from itertools import permutations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from snapstar.operators.history import replay_scd2
from snapstar.operators.snapshots import END, SNAPSHOT_TS, START
from snapstar.plans.entities import ENTITIES, ingest_entity
from snapstar.sources.landing import infer_csv_schema, is_missing, land_snapshot
from snapstar.streaming.bronze import LateRows, checksum, read_exports
from snapstar.streaming.history import AT, Export, HistoryTable, View

from .test_ingest import COLUMNS, invoice

T = [datetime(2024, m, 1) for m in range(1, 13)]


def land(spark, root, run, at, amount, keys=("INV-1", "INV-2", "INV-3")):
    rows = [invoice(k, amount + i, 45380.0 if i == 0 else None) for i, k in enumerate(keys)]
    land_snapshot({"invoices": spark.createDataFrame(rows, COLUMNS)}, f"{root}/landing", run, at)


def spans(silver):
    return sorted((r.invoice_id, r.invoice_amount, r.invoice_status, str(r[START])[:10], r[END] and str(r[END])[:10]) for r in silver.collect())


def ingest(spark, root, as_of):
    cfg = ENTITIES["invoices"]
    return ingest_entity(spark, cfg, root, infer_csv_schema(spark, f"{root}/landing/invoices"), as_of)


def test_export_stamped_like_an_earlier_run_date(spark, tmp_path):
    """Equal numbers of rows, other amounts: the export counts under its own date, once."""
    root = str(tmp_path)
    land(spark, root, "r1", "2024-02-01", 10.0)
    before = spans(ingest(spark, root, "2024-06-01"))
    assert ("INV-2", 11.0, "Overdue", "2024-06-01", None) in before
    land(spark, root, "r2", "2024-06-01", 20.0)
    want = [("INV-1", 10.0, "Plaćeno", "2024-02-01", "2024-06-01"), ("INV-1", 20.0, "Plaćeno", "2024-06-01", None)]
    for key, add in (("INV-2", 1.0), ("INV-3", 2.0)):
        want += [(key, 10.0 + add, "Otvoreno", "2024-02-01", "2024-06-01"), (key, 20.0 + add, "Overdue", "2024-06-01", None)]
    assert spans(ingest(spark, root, "2024-06-01")) == want
    assert spans(ingest(spark, root, "2024-06-01")) == want


@pytest.mark.parametrize("keys", [("INV-1", "INV-2", "INV-3"), ("INV-1", "INV-3")])
def test_export_stamped_before_an_earlier_run_date(spark, tmp_path, keys):
    root = str(tmp_path)
    land(spark, root, "r1", "2024-02-01", 10.0)
    ingest(spark, root, "2024-03-20")
    ingest(spark, root, "2024-06-01")
    land(spark, root, "r2", "2024-04-01", 20.0, keys)
    got = spans(ingest(spark, root, "2024-06-01"))
    assert ("INV-1", 10.0, "Plaćeno", "2024-02-01", "2024-04-01") in got and ("INV-1", 20.0, "Plaćeno", "2024-04-01", None) in got
    assert ("INV-2", 11.0, "Otvoreno", "2024-02-01", "2024-03-20") in got  # an earlier re-dating stays
    assert ("INV-2", 11.0, "Overdue", "2024-03-20", "2024-04-01") in got
    assert (("INV-2", 21.0, "Overdue", "2024-04-01", None) in got) == ("INV-2" in keys)
    # Everything that comes later goes on from there.
    land(spark, root, "r3", "2024-07-01", 20.0, keys)
    assert spans(ingest(spark, root, "2024-07-01")) == got


def test_a_changed_export_under_a_known_time_raises(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, T[0]), ("b", 2, T[0])], f"id string, v int, {SNAPSHOT_TS} timestamp")
    table = HistoryTable(spark, str(tmp_path), rows.schema, ["id"], (SNAPSHOT_TS,))
    assert table.apply_all(rows) == 1
    assert table.apply_all(rows.orderBy(F.desc("id"))) == 0
    with pytest.raises(LateRows):
        table.apply_all(rows.withColumn("v", F.when(F.col("id") == "a", 7).otherwise(F.col("v"))))
    with pytest.raises(LateRows):
        table.apply(rows.withColumn("v", -F.col("v")), T[0])


def test_changed_lookup_under_a_known_time_raises(spark, tmp_path):
    root, cfg = str(tmp_path), ENTITIES["department_lookup"]
    frame = spark.createDataFrame([("D1", "Roads")], "department_id string, department_name string")
    land_snapshot({cfg.name: frame}, f"{root}/landing", "r1", "2024-01-01")
    schema = infer_csv_schema(spark, f"{root}/landing/{cfg.name}")
    ingest_entity(spark, cfg, root, schema)
    record = read_exports(spark, f"{root}/bronze/{cfg.name}")[0]
    spark.createDataFrame([(record["at"], "r9", 1, "other")], "at bigint, run_id string, rows bigint, checksum string").write.mode("append").json(
        f"{root}/bronze/{cfg.name}/_exports")
    with pytest.raises(LateRows):
        ingest_entity(spark, cfg, root, schema)


def test_checksum_is_of_the_rows_alone(spark):
    rows = [("a", 1, None), ("a", 1, None), ("b", None, 2), ("b", 2, None)]
    frame = spark.createDataFrame(rows, "k string, v int, w int")

    def of(df):
        return df.agg(*checksum(df.columns)).first()[1]

    assert of(frame) == of(frame.repartition(3).select("w", "k", "v"))
    different = [frame.distinct(), frame.limit(0), frame.filter("k = 'a'"), frame.toDF("k", "w", "v"),
                 spark.createDataFrame([rows[0], rows[1], ("b", 2, None), ("b", 2, None)], frame.schema)]
    assert len({of(frame), *map(of, different)}) == 6


def exports(spark, n=10):
    """Keys that change, leave, return and repeat."""
    rows = [(f"k{k}", (k * t) % 3 if k % 2 else k, f"note {t}", T[t]) for t in range(n) for k in range(12) if (k + t) % 5 or not k % 4]
    rows += [rows[0]] * 3
    return spark.createDataFrame(rows, f"id string, v int, note string, {SNAPSHOT_TS} timestamp")


def test_many_exports_in_one_fold_equal_steps_and_replay(spark, tmp_path):
    bronze, untracked = exports(spark), (SNAPSHOT_TS, "note")

    def versions(df):
        return sorted(map(tuple, df.select("id", "v", "note", START, END).collect()), key=str)

    steps = HistoryTable(spark, str(tmp_path / "steps"), bronze.schema, ["id"], untracked)
    for t in T[:10]:
        steps.apply(bronze.filter(F.col(SNAPSHOT_TS) == F.lit(t)), t)
    once = HistoryTable(spark, str(tmp_path / "once"), bronze.schema, ["id"], untracked)
    assert once.apply_all(bronze) == 10
    some = HistoryTable(spark, str(tmp_path / "some"), bronze.schema, ["id"], untracked)
    for upto in (T[0], T[3], T[4], T[9]):
        some.apply_all(bronze.filter(F.col(SNAPSHOT_TS) <= F.lit(upto)))
    assert [len(t.folds()) for t in (steps, once, some)] == [10, 1, 4]
    replayed = versions(replay_scd2(bronze, ["id"], untracked=untracked))
    assert versions(steps.read()) == versions(once.read()) == versions(some.read()) == replayed
    assert versions(some.current()) == [v for v in replayed if v[4] is None]


def test_one_exchange_of_open_rows_for_any_number_of_exports(spark, tmp_path):
    from snapstar.operators.history import fold_scd2

    bronze = exports(spark)
    table = HistoryTable(spark, str(tmp_path), bronze.schema, ["id"], (SNAPSHOT_TS,))
    times = [int(t.timestamp() * 1e6) for t in T[:10]]
    folded = fold_scd2(table.current(), bronze.withColumn(AT, F.unix_micros(SNAPSHOT_TS)), times, ["id"], AT, (SNAPSHOT_TS,))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    # One for the versions by key; duplicates within an export collapse before theirs.
    assert plan.count("Exchange hashpartitioning(id") == 2


def test_arrivals_in_any_order_of_runs_give_one_history(spark, tmp_path):
    """Re-datings before, between and after exports; each order of landing that keeps exports in theirs ends alike."""
    ends = set()
    for number, order in enumerate(permutations(["2024-03-20", "2024-06-01", "E2"])):
        if order.index("2024-03-20") > order.index("2024-06-01"):
            continue
        root = str(tmp_path / str(number))
        land(spark, root, "r1", "2024-02-01", 10.0)
        for step in order:
            if step == "E2":
                land(spark, root, "r2", "2024-04-01", 20.0)
            else:
                ingest(spark, root, step)
        ends.add(tuple(spans(ingest(spark, root, "2024-06-01"))))
    # The export that lands first takes the first re-dating's place: that date lies before it and was never asked for.
    assert len(ends) == 2


def test_only_a_missing_path_counts_as_nothing(spark, tmp_path):
    with pytest.raises(AnalysisException) as missing:
        spark.read.parquet(str(tmp_path / "none"))
    assert is_missing(missing.value)
    with pytest.raises(AnalysisException) as wrong:
        spark.range(1).select("nothing")
    assert not is_missing(wrong.value)


def _moved(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_re_dating_moves_no_row_and_equals_its_rows_read_again(spark, tmp_path):
    """Views of an export after the first: by rows read again, and by the rows that are at hand."""
    schema = f"id string, due int, late boolean, note string, {SNAPSHOT_TS} timestamp"
    day = [int(t.timestamp() * 1e6) for t in T]

    def late(at):
        return {"late": F.col("due") < F.month(at)}

    def rows(t, note):
        made = [(f"k{k}", k % 7 + 2, None, f"{note}{k % 3}", T[t]) for k in range(20) if (k + t) % 4] + [("k1", 3, None, f"{note}1", T[t])] * 2
        return spark.createDataFrame(made, schema).withColumns(late(F.col(SNAPSHOT_TS)))

    exports = {day[0]: rows(0, "a"), day[4]: rows(4, "a"), day[5]: rows(5, "b")}

    def rows_of(views):
        parts = [exports[v.export.at].withColumns(late(F.timestamp_micros(F.lit(v.at)))).withColumn(AT, F.lit(v.at)) for v in views]
        frame = parts[0]
        for part in parts[1:]:
            frame = frame.unionByName(part)
        return frame

    def spans(table):
        return sorted(map(tuple, table.read().select("id", "due", "late", "note", START, END).collect()), key=str)

    known = [Export(at, 0, str(at)) for at in exports]
    steps = [(known[:1], day[2]), (known[:1], day[6]), (known[:2], day[6]), (known, day[7])]
    plain, derived = (HistoryTable(spark, str(tmp_path / n), rows(0, "a").schema, ["id"], (SNAPSHOT_TS,)) for n in ("plain", "derived"))
    for upto, date in steps:
        plain.catch_up(upto, rows_of, date)
        derived.catch_up(upto, lambda views: rows_of(views) if all(v.is_export for v in views) else None, date, late)
        assert spans(plain) == spans(derived)
    base = derived.folds()[-1]
    assert _moved(derived._versions(base, [View(day[8], base.views[-1].export)], rows_of, late)) == 0
    assert _moved(derived._versions(None, [View(day[0], known[0]), View(day[2], known[0])], rows_of, late)) == 1
    # One for duplicates within an export, one for the versions by key; content is compared behind the latter.
    seen_again = derived._versions(base, [View(day[8], Export(day[8], 0, "x")), View(day[9], Export(day[8], 0, "x"))], lambda v: exports[day[5]].withColumn(AT, F.lit(day[8])), late)
    assert _moved(seen_again) == 2

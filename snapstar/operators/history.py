"""Type 1 and type 2 history from full snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import is_large_and_even
from .snapshots import END, SNAPSHOT_TS, START, dedup_by_key

VALIDITY = (START, END)


def _tracked(columns: Sequence[str], keys: Sequence[str], untracked: Sequence[str]) -> list[str]:
    skip = {*keys, *untracked, *VALIDITY}
    return [c for c in columns if c not in skip]


def _paired(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two key-unique frames as nullable structs ``o`` and ``n``."""
    left = old.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], F.struct("*").alias("o"))
    right = new.select(*[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)], F.struct("*").alias("n"))
    same_key = F.expr(" AND ".join(f"_o{i} <=> _n{i}" for i in range(len(keys))))
    return left.join(right, same_key, "full_outer").select("o", "n")


def _same(tracked: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"o.`{c}` <=> n.`{c}`" for c in tracked) or "true")


def apply_snapshot_scd1(target: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite by key and remove keys missing from the snapshot.

    Every surviving row comes from the snapshot, so the target is never read; only its
    columns are kept, with nulls for those the snapshot lacks.
    """
    fresh = dedup_by_key(snapshot, keys)
    lost = {f.name: F.lit(None).cast(f.dataType) for f in target.schema if f.name not in snapshot.columns}
    return fresh.withColumns(lost) if lost else fresh


def scd2_delta(
    open_rows: DataFrame, snapshot: DataFrame, keys: Sequence[str],
    version: dt.datetime | str | Column, untracked: Sequence[str] = (),
) -> DataFrame:
    """What one snapshot does to the open versions: rows still or newly open, and rows it closes.

    One shuffle per side on the key; both sides hold a key once, so no task gets a
    disproportionate group. Closed history is not read.
    """
    at = version if isinstance(version, Column) else F.lit(str(version)).cast("timestamp")
    incoming = dedup_by_key(snapshot, keys)
    pairs = _paired(open_rows.select(*incoming.columns, *VALIDITY), incoming, keys)
    never = F.lit(None).cast("timestamp")
    closed = F.col("o").withField(END, at)
    kept = F.struct("n.*", F.col("o")[START].alias(START), never.alias(END))
    opened = F.struct("n.*", at.alias(START), never.alias(END))

    had, has = F.col("o").isNotNull(), F.col("n").isNotNull()
    versions = (
        F.when(had & has & _same(_tracked(incoming.columns, keys, untracked)), F.array(kept))
        .when(had & has, F.array(closed, opened))
        .when(had, F.array(closed))
        .otherwise(F.array(opened))
    )
    return pairs.select(F.inline(versions))


def apply_snapshot_scd2(
    target: DataFrame, snapshot: DataFrame, keys: Sequence[str],
    version: dt.datetime | str | Column, untracked: Sequence[str] = (),
) -> DataFrame:
    """The whole history after one more snapshot; closed versions pass through unshuffled."""
    closed = target.filter(F.col(END).isNotNull())
    opened = target.filter(F.col(END).isNull())
    return closed.unionByName(scd2_delta(opened, snapshot, keys, version, untracked))


def replay_scd2(
    bronze: DataFrame, keys: Sequence[str], ts_col: str = SNAPSHOT_TS, untracked: Sequence[str] = (),
    unique_per_snapshot: bool = False,
) -> DataFrame:
    """The full type 2 history of every snapshot in ``bronze`` at once.

    A version ends where the key's content changes or the key skips a snapshot. After
    deduplication a key has at most one row per snapshot, which bounds every window group.
    Versions come out of a single window pass; with ``unique_per_snapshot`` (the export
    already guarantees its keys) that pass is also the only shuffle.
    """
    untracked = [*untracked, ts_col] if ts_col not in untracked else list(untracked)
    rows = bronze if unique_per_snapshot else dedup_by_key(bronze, [*keys, ts_col])
    # One entry per export, gathered as a scalar subquery: no join, and no window without a key.
    stamps = bronze.select(F.array_sort(F.collect_set(ts_col))).scalar()
    placed = rows.withColumn("_stamps", stamps).withColumn("_pos", F.array_position("_stamps", F.col(ts_col))).withColumn(
        "_next", F.get("_stamps", F.col("_pos").cast("int"))).drop("_stamps")

    by_key = Window.partitionBy(*keys).orderBy("_pos")
    content = F.struct(*[F.col(c) for c in _tracked(bronze.columns, keys, untracked)])
    flagged = placed.withColumn("_content", content).select(
        "*", F.lag("_pos").over(by_key).alias("_prev"), F.lag("_content").over(by_key).alias("_before")
    ).withColumn(
        "_opens",
        F.col("_prev").isNull() | (F.col("_prev") != F.col("_pos") - 1)
        | ~F.col("_content").eqNullSafe(F.col("_before")),
    )
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = flagged.select(
        "*",
        F.max(F.when(F.col("_opens"), F.col(ts_col))).over(so_far).alias(START),
        F.lead("_opens").over(by_key).alias("_reopens"),
    )
    last = spans.filter(F.coalesce(F.col("_reopens"), F.lit(True)))
    return last.select(*bronze.columns, START, F.col("_next").alias(END))


def fold_scd2(
    open_rows: DataFrame | None, views: DataFrame, times: Sequence[int], keys: Sequence[str], at_col: str, untracked: Sequence[str] = (),
    again: Mapping[int, Sequence[int]] | None = None, derived: Callable[[Column], Mapping[str, Column]] | None = None,
) -> DataFrame:
    """What any number of snapshots do to the open versions, in one pass: the versions open after the last of them and all that they closed.

    ``times`` are the snapshots' times in microseconds, in order, and ``at_col`` holds the one of each row; a snapshot without
    rows closes everything. The open versions stand before the first snapshot, so a key's versions come out of a single
    window over its rows, however many snapshots there are. After deduplication a key has one row per snapshot at most.
    ``again`` names the places, after the one it has, at which a snapshot is seen again with its ``derived`` columns as of then; place 0 is that of the
    open versions, the first time has place 1. These rows are made behind the shuffle, so a snapshot moves once however often it is seen.
    Content is compared behind it, too.
    """
    columns = [c for c in views.columns if c != at_col]
    stamps = F.array(*(F.timestamp_micros(F.lit(t)) for t in times))
    # Copies collapse in every task before they move, to meet those of other tasks by key and time, and rows move once more to meet by key. Many
    # rows without a hot key meet by key at once.
    once = is_large_and_even(views, *keys)
    found = (views if once else dedup_by_key(views, [*keys, at_col])).withColumn(
        "_pos", F.array_position(F.array(*(F.lit(t).cast("long") for t in times)), F.col(at_col)).cast("int"))
    rows = found.select(*columns, F.timestamp_micros(at_col).alias("_since"), "_pos")
    if open_rows is not None:
        rows = rows.unionByName(open_rows.select(*columns, F.col(START).alias("_since"), F.lit(0).alias("_pos")))
    rows = rows.repartition(*keys)
    if once:
        rows = dedup_by_key(rows, [*keys, "_pos"])
    if again:
        places = F.array(*(F.array(F.lit(p), *map(F.lit, again.get(p, ()))) for p in range(len(times) + 1)))
        rows = rows.withColumn("_own", F.col("_pos")).withColumn("_pos", F.explode(F.get(places, F.col("_own"))))
        is_again, at = F.col("_pos") != F.col("_own"), F.get(stamps, F.col("_pos") - 1)
        seen = {c: F.when(is_again, e).otherwise(F.col(c)) for c, e in derived(at).items()}
        rows = rows.withColumns({**seen, "_since": F.when(is_again, at).otherwise(F.col("_since"))}).drop("_own")

    by_key = Window.partitionBy(*keys).orderBy("_pos")
    content = F.struct(*[F.col(c) for c in _tracked(columns, keys, untracked)])
    flagged = rows.withColumn("_content", content).select(
        "*", F.lag("_pos").over(by_key).alias("_prev"), F.lag("_content").over(by_key).alias("_before")
    ).withColumn(
        "_opens",
        F.col("_prev").isNull() | (F.col("_prev") != F.col("_pos") - 1) | ~F.col("_content").eqNullSafe(F.col("_before")),
    )
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = flagged.select(
        "*", F.max(F.when(F.col("_opens"), F.col("_since"))).over(so_far).alias(START), F.lead("_opens").over(by_key).alias("_reopens"))
    last = spans.filter(F.coalesce(F.col("_reopens"), F.lit(True)))
    return last.select(*columns, START, F.get(stamps, F.col("_pos")).alias(END))


def redate_scd2(
    versions: DataFrame, at: int, derived: Callable[[Column], Mapping[str, Column]], keys: Sequence[str], untracked: Sequence[str] = (),
) -> DataFrame:
    """Versions after the snapshot that opened them is seen again at a later time, in microseconds: an open version whose
    ``derived`` columns differ then is closed and opened anew. Every row is judged by itself, so none is moved."""
    stamp, never = F.timestamp_micros(F.lit(at)), F.lit(None).cast("timestamp")
    seen = derived(stamp)
    tracked = _tracked(list(seen), keys, untracked)
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(seen[c])

    def version(begin: Column, end: Column, values: Mapping[str, Column]) -> Column:
        changed = {**values, START: begin, END: end}
        return F.struct(*(changed.get(c, F.col(c)).alias(c) for c in versions.columns))

    start, end = F.col(START), F.col(END)
    return versions.select(F.inline(
        F.when(end.isNotNull(), F.array(version(start, end, {})))
        .when(differs, F.array(version(start, stamp, {}), version(stamp, never, seen)))
        .otherwise(F.array(version(start, never, seen)))))


def snapshot_deletes(previous: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is missing from the new snapshot; null keys equal each other."""
    return _without(previous, new, keys)


def _without(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``known`` lacks, nulls compared as values."""
    named = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return rows.join(named, F.expr(" AND ".join(f"`{k}` <=> _k{i}" for i, k in enumerate(keys))), "left_anti")


def snapshot_diff(
    previous: DataFrame, new: DataFrame, keys: Sequence[str], untracked: Sequence[str] = ()
) -> DataFrame:
    """Number of inserted, updated, deleted and unchanged keys between two snapshots."""
    tracked = _tracked(new.columns, keys, untracked)
    needed = [*keys, *tracked]
    pairs = _paired(dedup_by_key(previous.select(*needed), keys), dedup_by_key(new.select(*needed), keys), keys)
    change = (
        F.when(F.col("o").isNull(), "inserted")
        .when(F.col("n").isNull(), "deleted")
        .when(_same(tracked), "unchanged")
        .otherwise("updated")
    )
    return pairs.groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("rows"))


def lost_keys(bronze: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen in any snapshot but absent from the history; empty when all is well. Null keys equal each other."""
    return _without(bronze.select(*keys).distinct(), history, keys)

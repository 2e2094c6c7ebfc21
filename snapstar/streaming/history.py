"""A type 2 history on disk, fed by batches or a stream of snapshots.

The history is a chain of *views*: what was known at a time. An export is a view at its own time; seeing the newest export
again at a later date (derived columns may depend on the date) is a *re-dating*, a view at that date with an
older source. Views are folded in order of their time, all that are due in one pass. An export that arrives stamped before a
re-dating belongs between the views that are there: the folds from that time on are given up, and their views are folded again
after it, each re-dating with the export that is now the newest at its date.

An export is known by its time and by the checksum of its rows, so the same rows again change nothing and other rows under a known time
raise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampType

from ..operators.history import VALIDITY, fold_scd2, redate_scd2
from ..operators.snapshots import END, SNAPSHOT_TS, START, dedup_by_key
from ..sources.landing import is_missing
from .bronze import LateRows, checksum

AT = "_view_at"
# The columns of an export that depend on the date it is seen at, by their names.
Derived = Callable[[Column], Mapping[str, Column]]


@dataclass(frozen=True)
class Export:
    """One export: its time in microseconds, its rows and their checksum."""

    at: int
    rows: int
    checksum: str


@dataclass(frozen=True)
class View:
    """An export as seen at a time; at its own time it is the export itself."""

    at: int
    export: Export

    @property
    def is_export(self) -> bool:
        return self.at == self.export.at


@dataclass(frozen=True)
class Fold:
    """A commit record: the views of one pass, the fold before it, and the folder with the versions that are open after it."""

    number: int
    before: int | None
    opened: int
    views: tuple[View, ...]


RECORDS = ("number bigint, before bigint, opened bigint, "
           "views array<struct<at: bigint, kind: string, source: bigint, rows: bigint, checksum: string>>")


class HistoryTable:
    """History as parquet partitioned by fold and openness.

    A fold writes all open versions and the versions it closed under a new ``_version`` folder; closed versions of
    earlier folds are neither read nor rewritten. A fold counts once its commit record exists, so a run that dies can be
    repeated; folds that were given up keep their folders, which nothing reads.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
                 untracked: Sequence[str] = ()) -> None:
        self.spark, self.path, self.keys, self.untracked = spark, path, list(keys), list(untracked)
        self.columns = [*[f.name for f in schema], START, END]
        validity = [StructField(START, TimestampType()), StructField(END, TimestampType())]
        folders = [StructField("_version", LongType()), StructField("is_current", BooleanType())]
        self._stored = StructType([*schema.fields, *validity])
        self._layout = StructType([*schema.fields, *validity, *folders])

    # What is there

    def folds(self) -> list[Fold]:
        """The folds that count, oldest first: those the newest record leads back to."""
        records = {f.number: f for f in _records(self.spark, self.path)}
        chain, at = [], max(records, default=None)
        while at is not None:
            chain.append(records[at])
            at = records[at].before
        return chain[::-1]

    def views(self) -> list[View]:
        """Every view the history shows, in order."""
        return [v for f in self.folds() for v in f.views]

    def last_version(self) -> int | None:
        """The time of the newest view, in microseconds."""
        return max((v.at for v in self.views()), default=None)

    def _open_after(self, fold: Fold | None) -> DataFrame:
        if fold is None:
            return self.spark.createDataFrame([], self._stored)
        return self._files().filter((F.col("_version") == fold.opened) & F.col("is_current")).select(*self.columns)

    def _files(self) -> DataFrame:
        return self.spark.read.schema(self._layout).parquet(self.path)

    def current(self) -> DataFrame:
        """Open versions; reads only the newest folder."""
        folds = self.folds()
        return self._open_after(folds[-1] if folds else None)

    def read(self) -> DataFrame:
        """Open and closed versions."""
        folds = self.folds()
        if not folds:
            return self.spark.createDataFrame([], self._stored)
        # One number for each fold; with a pass a day, a few thousand after ten years.
        closed = F.col("_version").isin([f.number for f in folds])
        kept = F.when(F.col("is_current"), F.col("_version") == folds[-1].opened).otherwise(closed)
        return self._files().filter(kept).select(*self.columns)

    # What changes it

    def catch_up(self, exports: Sequence[Export], rows_of: Callable[[Sequence[View]], DataFrame], redate: int | None = None,
                 derived: Derived | None = None) -> int:
        """Fold all exports that are new, and a re-dating at ``redate`` if it is later than every view, in one pass.

        ``rows_of`` gives the rows of some views with the time of the view in the column ``AT``. It is asked for views of known
        exports only if an export arrived before a re-dating. With ``derived``, which must depend on the other columns of a row and the time alone, it is
        asked for exports at their own time only; their re-datings are made of the same rows. Returns the number of views that were folded. A known export with other rows, and an
        export older than the newest known one, raise ``LateRows``.
        """
        folds = self.folds()
        live = [v for f in folds for v in f.views]
        known = {v.at: v.export for v in live if v.is_export}
        for e in exports:
            if e.at in known and known[e.at].checksum != e.checksum:
                raise LateRows(f"snapshot {e.at}: {e.rows} rows with other content than the {known[e.at].rows} applied")
            if e.at not in known and known and e.at < max(known):
                raise LateRows(f"snapshot {e.at}: {e.rows} rows now, none when later ones were applied")
        every = {**known, **{e.at: e for e in exports}}
        dates = {v.at for v in live if not v.is_export}
        if redate is not None and every and redate > max([*every, *dates]):
            dates.add(redate)
        wanted = [View(at, every[at] if at in every else every[max(t for t in every if t < at)]) for at in sorted({*every, *dates})]

        kept, place = [], 0
        for fold in folds:
            if tuple(wanted[place:place + len(fold.views)]) != fold.views:
                break
            kept.append(fold)
            place += len(fold.views)
        due = wanted[place:]
        if due:
            missing = {v.export.at for v in due} - {e.at for e in exports} - set(known)
            if missing:
                raise LateRows(f"rows of snapshots {sorted(missing)} are needed again")
            base, number = kept[-1] if kept else None, max((f.number for f in _records(self.spark, self.path)), default=0) + 1
            # Re-datings after the last export move no row. They are a fold of their own, so that an export that takes the place of one needs
            # none of the exports before it again.
            exported = max((i for i, v in enumerate(due, 1) if v.is_export), default=0) if base is not None and derived is not None else len(due)
            for views in filter(None, (due[:exported], due[exported:])):
                base, number = self._fold(base, number, views, rows_of, derived), number + 1
        return len(due)

    def _fold(self, base: Fold | None, number: int, views: list[View], rows_of: Callable[[Sequence[View]], DataFrame], derived: Derived | None) -> Fold:
        versions = self._versions(base, views, rows_of, derived)
        opened = number
        if base is not None and not any(v.is_export for v in views):
            # Only dates passed. Most of them change nothing, and then there is nothing to write.
            since = F.timestamp_micros(F.lit(views[0].at))
            if versions.filter((F.col(START) >= since) | F.col(END).isNotNull()).isEmpty():
                opened = base.opened
        if opened == number:
            versions.select(*self.columns, F.col(END).isNull().alias("is_current")).write.mode("overwrite").partitionBy(
                "is_current").option("compression", "zstd").parquet(f"{self.path}/_version={number}")
        fold = Fold(number, base.number if base else None, opened, tuple(views))
        _record(self.spark, self.path, fold)
        return fold

    def _versions(self, base: Fold | None, views: list[View], rows_of: Callable[[Sequence[View]], DataFrame], derived: Derived | None) -> DataFrame:
        """The versions open after the views and those they close. A re-dating shows the export of the view before it, so its rows are at hand."""
        exports = [v for v in views if v.is_export]
        if derived is None or (len(exports) == len(views) and (base is not None or len(views) > 1)):
            return fold_scd2(self._open_after(base), rows_of(views), [v.at for v in views], self.keys, AT, self.untracked)
        if exports and (base is not None or len(exports) > 1):
            again: dict[int, list[int]] = {}
            own = 0  # the place of the export that is newest
            for place, v in enumerate(views, 1):
                if v.is_export:
                    own = place
                else:
                    again.setdefault(own, []).append(place)
            opened = self._open_after(base) if base is not None else None
            return fold_scd2(opened, rows_of(exports), [v.at for v in views], self.keys, AT, self.untracked, again, derived)
        if exports:  # the first one: no key has another version
            at = F.timestamp_micros(F.lit(views[0].at))
            validity = {START: at, END: F.lit(None).cast("timestamp")}
            versions = dedup_by_key(rows_of(exports).drop(AT), self.keys).withColumns(validity)
        else:
            versions = self._open_after(base)
        for v in views[len(exports):]:
            versions = redate_scd2(versions, v.at, derived, [*self.keys, *VALIDITY], self.untracked)
        return versions

    def apply(self, snapshot: DataFrame, version: dt.datetime | str | int) -> bool:
        """Apply one whole export under its time; the same export again is left out.

        ``version`` is the snapshot's time, or its microseconds since the epoch.
        """
        at = version if isinstance(version, int) else micros(self.spark, version)
        found = snapshot.agg(*checksum([c for c in snapshot.columns if c != SNAPSHOT_TS])).first()
        export = Export(at, found.rows, found.checksum)
        return self.catch_up([export], lambda views: _at_own_time(self._only(views, export, snapshot), F.lit(at))) > 0

    def _only(self, views: Sequence[View], export: Export, snapshot: DataFrame) -> DataFrame:
        if [v for v in views if v.export != export or not v.is_export]:
            raise LateRows(f"snapshot {export.at} lies before a re-dating; offer it with the exports from there on")
        return snapshot

    def apply_all(self, snapshots: DataFrame, ts_col: str = SNAPSHOT_TS) -> int:
        """Fold every newer snapshot in ``snapshots``, one or many, in one pass.

        Rows that were not there when their snapshot was applied, or that differ now, and whole snapshots older than the newest applied
        one, would be lost: they raise ``LateRows``. A snapshot that is offered again as it was is left out.
        """
        found = snapshots.groupBy(F.unix_micros(ts_col).alias("at")).agg(*checksum([c for c in snapshots.columns if c != ts_col]))
        exports = [Export(r["at"], r["rows"], r["checksum"]) for r in found.collect()]  # one row for each export

        def rows_of(views: Sequence[View]) -> DataFrame:
            late = [v.at for v in views if not v.is_export or v.export not in exports]
            if late:
                raise LateRows(f"rows of views {late} are needed again")
            at = F.unix_micros(ts_col)
            return _at_own_time(snapshots.filter(at.isin([v.at for v in views])), at)

        return self.catch_up(exports, rows_of)


def _at_own_time(rows: DataFrame, at: Column) -> DataFrame:
    return rows.withColumn(AT, at.cast("long"))


def micros(spark: SparkSession, at: dt.datetime | str) -> int:
    """A time as microseconds since the epoch, in the session's time zone."""
    return spark.range(1).select(F.unix_micros(F.lit(str(at)).cast("timestamp"))).first()[0]


def _records(spark: SparkSession, path: str) -> list[Fold]:
    """All commit records below ``path``; one small row for each fold."""
    try:
        rows = spark.read.schema(RECORDS).json(f"{path}/_commits").collect()
    except AnalysisException as error:
        if is_missing(error):
            return []
        raise
    return [Fold(r.number, r.before, r.opened, tuple(View(v["at"], Export(v.source, v["rows"], v.checksum)) for v in r["views"])) for r in rows]


def _record(spark: SparkSession, path: str, fold: Fold) -> None:
    """Declare a fold applied; written after its data."""
    views = [(v.at, "export" if v.is_export else "re-dating", v.export.at, v.export.rows, v.export.checksum) for v in fold.views]
    row = [(fold.number, fold.before, fold.opened, views)]
    spark.createDataFrame(row, RECORDS).coalesce(1).write.mode("append").json(f"{path}/_commits")


def follow_snapshots(
    stream: DataFrame, table: HistoryTable, checkpoint: str, ts_col: str = SNAPSHOT_TS
) -> StreamingQuery:
    """Feed a stream of whole snapshots into a history and stop when it is caught up.

    A batch must hold complete snapshots, so leave the source without a file limit. A
    batch that is retried finds its snapshots applied and changes nothing.
    """
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: table.apply_all(batch, ts_col) and None)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query

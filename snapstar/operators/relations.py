"""Relationship-driven filters and joins of the report layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir


@dataclass(frozen=True)
class Relationship:
    """A declared relationship of two tables. A selection on ``to_table``, the one side, restricts ``from_table``; one on
    ``from_table`` restricts the other only if ``both``."""

    from_table: str
    from_column: str
    to_table: str
    to_column: str
    both: bool = False


def cross_filter(
    a: DataFrame, b: DataFrame, key: str, on_a: Column | None = None, on_b: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a relationship after a selection on either: each keeps keys the other kept.

    The selecting side is reduced to distinct keys before it is shuffled.
    """
    chosen_a = a if on_a is None else a.filter(on_a)
    chosen_b = b if on_b is None else b.filter(on_b)
    return (
        chosen_a.join(chosen_b.select(key).distinct(), key, "left_semi"),
        chosen_b.join(chosen_a.select(key).distinct(), key, "left_semi"),
    )


def join_on_date_part(fact: DataFrame, ts_col: str, calendar: DataFrame, how: str = "inner") -> DataFrame:
    """Match timestamps to calendar days, ignoring the time of day.

    The planner broadcasts a calendar that is small, as they are; a larger frame is shuffled.
    """
    return fact.join(calendar, F.to_date(fact[ts_col]) == calendar["date"], how)


def related(fact: DataFrame, lookup: DataFrame, on: str, *columns: str) -> DataFrame:
    """Add columns of the many-to-one lookup to each fact row."""
    return fact.join(lookup.select(on, *columns), on, "left")


def select_across(
    frames: Mapping[str, DataFrame], relationships: Sequence[Relationship], selections: Mapping[str, Column], all_ways: bool = True,
) -> dict[str, DataFrame]:
    """Every table after selections on any number of them, carried along a tree of relationships by semi-joins.

    A table sends each neighbour the distinct keys that it keeps under its own selection and what its other
    neighbours have sent it. Sides of the tree without a selection send nothing and so restrict nothing. Keys are stored
    once and read by all that depend on them: each relationship costs at most one semi-join each way, however many tables there
    are. With ``all_ways`` selections also travel from the many to the one side; otherwise only where a relationship says so.
    """
    near: dict[str, list[tuple[str, str, str]]] = {t: [] for t in frames}  # table -> (neighbour, own column, the neighbour's)
    for r in relationships:
        near[r.from_table].append((r.to_table, r.from_column, r.to_column))
        if all_ways or r.both:
            near[r.to_table].append((r.from_table, r.to_column, r.from_column))
    _refuse_cycles(frames, relationships)
    sent: dict[tuple[str, str], DataFrame | None] = {}

    def kept(table: str, but: str | None = None) -> tuple[DataFrame, bool]:
        df, restricted = frames[table], table in selections
        if restricted:
            df = df.filter(selections[table])
        for neighbour, own, other in near[table]:
            if neighbour != but:
                keys = message(neighbour, table, other)
                if keys is not None:
                    df, restricted = df.join(keys.select(F.col("key").alias(own)), own, "left_semi"), True
        return df.select(*frames[table].columns), restricted

    def message(sender: str, to: str, column: str) -> DataFrame | None:
        if (sender, to) not in sent:
            df, restricted = kept(sender, but=to)
            sent[sender, to] = None
            if restricted:
                keys = df.select(F.col(column).alias("key")).filter("key IS NOT NULL").distinct()
                folder = scratch_dir(df.sparkSession, "keys")
                keys.write.parquet(folder)
                sent[sender, to] = df.sparkSession.read.schema(keys.schema).parquet(folder)
        return sent[sender, to]

    return {table: kept(table)[0] for table in frames}


def _refuse_cycles(frames: Mapping[str, DataFrame], relationships: Sequence[Relationship]) -> None:
    group = {t: t for t in frames}

    def root(t: str) -> str:
        while group[t] != t:
            t = group[t]
        return t

    for r in relationships:
        if root(r.from_table) == root(r.to_table):
            raise ValueError(f"relationships form a cycle at {r.from_table} - {r.to_table}")
        group[root(r.from_table)] = root(r.to_table)

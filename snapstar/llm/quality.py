"""Quality rules with thresholds that adapt to language and source, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated 5-word windows. The adaptive part describes each document
by whole-numbered metrics, gathers one quantile sketch per language, source and metric, turns sketch quantiles into
fences, and joins the fences back to the documents.

The sketch is a histogram over a grid whose cells are at most 1/16 of their value wide: exact below 16, then 16 cells
per doubling. Cells are counts, so sketches merge by addition in any order, are the same on every run, and have a
bounded size whatever the data. Groups under ``LEAST`` documents use the merged sketch of their language, and
languages under it the sketch of everything.

Null texts and texts without words have no words and fail the base rules; null languages and sources are groups of
their own. Repeated rows count as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20  # base rules: words, and percent of words in repeated windows
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEAST = 50  # documents a group needs for fences of its own
SPREAD = 4  # a fence lies this many times the spread beyond the median
# Metric -> (value per thousand words or lines, least distance of the upper and of the lower fence from the median).
# The least distances keep a group of near-equal documents from refusing harmless ones.
FENCES = {
    "word_length": (1500, 1000),
    "symbols": (400, None),
    "dup_lines": (300, None),
    "repeats": (150, None),
}
SHARES = ("dup_lines", "repeats")  # at most 1,000 per thousand
# Percent. The spread is the lesser of the quartiles' distances from the median, so junk on one side of it, up to nearly half
# of a group, moves a fence no further than clean documents on the other side reach.
OUTER_LOW, OUTER_HIGH = 25, 75


def measure(df: DataFrame, text: str) -> DataFrame:
    """Replace the ``text`` column by the base measures. Window equality is by 64-bit hash of its words, within one
    document. Each step names what the next one uses several times, so that arrays are made once for each text.
    """
    kept = [c for c in df.columns if c != text]
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = df.select(
        *kept,
        F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(whole, "\n", -1), lambda line: F.translate(line, SPACES, "") != "").alias("lines"),
        F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    done = [*kept, "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    sized = counted.select(
        *kept, "word_chars", "n_symbols", "words", F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    # Windows by hash and position; neighbours with equal hashes are repeats; their sorted positions give the union.
    starts = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(0), F.size("words") - WINDOW)).otherwise(F.array().cast("array<int>"))
    hashed = sized.select(*done, F.sort_array(F.transform(starts, lambda i: F.struct(
        F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW))).alias("h"), i.alias("i")))).alias("windows"))
    repeated = hashed.select(*done, F.array_compact(F.transform("windows", lambda x, k: F.when(
        (F.get("windows", k - 1)["h"] == x["h"]) | (F.get("windows", k + 1)["h"] == x["h"]), x["i"]))).alias("repeated"))
    covered = F.aggregate(
        F.sort_array("repeated"), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")))
    return repeated.select(*done, covered["n"].cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def metrics() -> dict[str, Column]:
    """Whole-numbered metrics per thousand from the base measures; null without words."""
    def share(part: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.expr(f"(1000 * {part}) div {of}"))

    return {
        "word_length": share("word_chars", "n_words"), "symbols": share("n_symbols", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
    }


def cell(value: Column) -> Column:
    """Smallest value of the grid cell that holds a whole number >= 0: its five leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return value - value % step


def sketches(df: DataFrame, lang: str, source: str) -> DataFrame:
    """Counts per language, source, metric and cell, over documents that pass the base rules. Rows are summed before the shuffle."""
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), cell(v).alias("cell")) for n, v in metrics().items())))
    rows = df.filter(~base_failed()).select(F.col(lang).alias("g_lang"), F.col(source).alias("g_source"), each.alias("m"))
    return rows.groupBy("g_lang", "g_source", "m.metric", "m.cell").agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketch.groupBy(*keys, "metric", "cell").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: ``n`` documents, and per metric the lower and upper fence. A quantile is the smallest cell
    at which the running count reaches its share."""
    group = Window.partitionBy(*keys, "metric")
    running = F.sum("n").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    counted = sketch.withColumn("running", running).withColumn("total", F.sum("n").over(group))
    quantile = {q: F.min(F.when(F.col("running") * 100 >= F.col("total") * q, F.col("cell"))) for q in (OUTER_LOW, 50, OUTER_HIGH)}
    per_metric = counted.groupBy(*keys, "metric").agg(
        F.max("total").alias("n"), *(v.alias(f"q{q}") for q, v in quantile.items()))
    columns = []
    for name, (up, down) in FENCES.items():
        here = F.col("metric") == name
        spread = SPREAD * F.least(F.col(f"q{OUTER_HIGH}") - F.col("q50"), F.col("q50") - F.col(f"q{OUTER_LOW}"))
        high = F.col("q50") + F.greatest(spread, F.lit(up))
        high = F.least(high, F.lit(1000)) if name in SHARES else high
        low = F.col("q50") - F.greatest(spread, F.lit(down)) if down else F.lit(-1).cast("long")
        columns += [F.max(F.when(here, high)).alias(f"{name}_high"), F.max(F.when(here, low)).alias(f"{name}_low")]
    return per_metric.groupBy(*keys).agg(F.max("n").alias("n"), *columns)


def thresholds(sketch: DataFrame) -> DataFrame:
    """Fences of every language and source, of the finest level that has ``LEAST`` documents."""
    names = [f"{m}_{side}" for m in FENCES for side in ("high", "low")]

    def level(keys: list[str], mark: str) -> DataFrame:
        rows = fences(merge(sketch, keys) if len(keys) < 2 else sketch, keys)
        return rows.select(*(F.col(k).alias(f"{mark}_{k}") for k in keys),
                           F.struct(F.col("n"), *names).alias(mark))

    fine, middle, top = level(["g_lang", "g_source"], "a"), level(["g_lang"], "b"), level([], "c")
    joined = (fine.join(middle, F.col("a_g_lang").eqNullSafe(F.col("b_g_lang"))).join(F.broadcast(top)))  # one row
    pick = F.when(F.col("a.n") >= LEAST, F.col("a")).when(F.col("b.n") >= LEAST, F.col("b")).otherwise(F.col("c"))
    return joined.select("a_g_lang", "a_g_source", pick.alias("t")).select(
        F.col("a_g_lang").alias("t_lang"), F.col("a_g_source").alias("t_source"), *(f"t.{n}" for n in names))


def apply_rules(df: DataFrame, text: str, lang: str, source: str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus base measures, ``base_failed`` and ``kept``.

    Measures are stored once without the texts, sketched, and joined with the thresholds, which hold one row per
    language and source; a hot group is split by the planner or avoided by a broadcast it sizes itself.
    """
    named = df.select(*(F.col(c).alias(f"k_{c}") for c in keep), F.col(lang).alias("g_lang"), F.col(source).alias("g_source"), F.col(text).alias("x"))
    stored = materialize(measure(named, "x"), "quality")
    limits = thresholds(sketches(stored, "g_lang", "g_source"))
    joined = stored.join(limits, F.col("g_lang").eqNullSafe(F.col("t_lang")) & F.col("g_source").eqNullSafe(F.col("t_source")), "left")
    failed = base_failed()
    # Compared in whole cells, as the fences are.
    within = reduce(and_, (cell(v).between(F.col(f"{n}_low"), F.col(f"{n}_high")) for n, v in metrics().items()))
    return joined.select(
        *(F.col(f"k_{c}").alias(c) for c in keep), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.coalesce(within, F.lit(False))).alias("kept"))

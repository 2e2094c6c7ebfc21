"""MinHash near-duplicates from fast similarity sketches, banding and exact verification.

Two texts link if the Jaccard similarity of their sets of word shingles is at least ``PERCENT``; a group is a connected
component of links.

A sketch has ``COORDINATES`` numbers. In round i every shingle falls into a hashed bin with the value i plus a hashed
fraction, and a bin keeps its least value, so bins that a round fills stay as they are. After as many rounds as there
are bins, round COORDINATES + b fills bin b if it is still empty, so every coordinate is filled, in expected time
n + COORDINATES * log(COORDINATES). The share of equal coordinates estimates the similarity, at least as concentrated
as with independent ones.

1. Rows with the same set become one; its copies take no further part.
2. A sketch is cut into bands of ``ROWS`` coordinates. Two sets of similarity 0.8 miss all 48 bands with
   probability 5e-7; those of similarity 0.01 share one with probability 5e-11.
3. Every set that shares a band is compared, on the whole sets, with the one set that it shares most bands with among the
   first sets of its bands. Groups that these links join are one from then on, so groups of copies of any size collapse
   without their pairs.
4. What this leaves: sets that shared bands connect form a cluster, and in a cluster all sets outside its largest group are compared with all sets
   of other groups, first by sketches, then, if these agree in as many coordinates as a linked pair does but with
   probability 3e-7, on the whole sets. A task holds blocks of ``BLOCK`` sets and returns links that join groups, no pairs. The largest
   group's members don't meet each other, so a set moves as often as there are blocks of sets outside it.

Texts are shuffled for sets that share a band only, and a set many others are compared with is dealt out to several
tasks. Shingles of a text are compared by 64-bit hashes. Sets with fewer than 4 shingles link with equal sets only, as
0.8 needs 4 of 5. Null texts and texts without words have an empty set, link with nothing and are groups of their own. Rows
that repeat a key with other texts are separate texts under one key. A null key counts only in groups where all are null. An
empty table gives an empty result. No column of the table is carried, so names can't clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .components import components

SHINGLE, PERCENT, SEED = 2, 80, 11
ROWS, BANDS = 6, 48
COORDINATES = ROWS * BANDS
AGREE = 196  # of 288 coordinates: five standard deviations below 80 %
LEAST = 4  # shingles of the smaller of two different linked sets
BLOCK = 1024  # sets of one side of a cluster, or texts compared with one set, in a task
HASHES_AT_ONCE = 1 << 13
UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; the whole text if it has fewer words."""
    words = (text or "").encode("utf-8").lower().split()  # both of ASCII only
    if len(words) < size:
        shingles = iter([b" ".join(words)] if words else [])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    parts = []
    while chunk := set(itertools.islice(shingles, 1 << 16)):
        parts.append(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in chunk), np.uint64, len(chunk)))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(hashes: np.ndarray, rounds: np.ndarray) -> np.ndarray:
    """A fresh hash of every shingle for every round."""
    return _mix(hashes[None, :] + (rounds[:, None] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def sketch(hashes: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """One byte of each coordinate of a non-empty set."""
    slots = np.full(size, UNFILLED)
    low = np.uint64(0xFFFFFFFF)
    with np.errstate(over="ignore"):
        step = max(1, HASHES_AT_ONCE // len(hashes))
        for first in range(0, size, step):
            rounds = np.arange(first, min(first + step, size), dtype=np.uint64)
            for at in range(0, len(hashes), HASHES_AT_ONCE):
                drawn = _drawn(hashes[at: at + HASHES_AT_ONCE], rounds)
                bins = ((drawn >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
                np.minimum.at(slots, bins.ravel().astype(np.int64), ((rounds[:, None] << np.uint64(32)) | (drawn & low)).ravel())
            if slots.max() != UNFILLED:
                break
        empty = np.flatnonzero(slots == UNFILLED)
        if len(empty):  # only sets with few shingles come here
            rounds = empty.astype(np.uint64) + np.uint64(size)
            drawn = _drawn(hashes, rounds) & low
            slots[empty] = ((rounds[:, None] << np.uint64(32)) | drawn).min(1)
        return (_mix(slots) >> np.uint64(56)).astype(np.uint8)


def sketch_column(text: Column, size: int = SHINGLE) -> Column:
    """``name`` (128 bits of the set, null if empty), ``n`` (its size) and ``sketch`` (null below ``LEAST``)."""
    @F.arrow_udf("name binary, n bigint, sketch binary")
    def sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for value in batch:
                own = shingle_hashes(value.as_py(), size)
                rows.append((xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None, len(own),
                             sketch(own).tobytes() if len(own) >= LEAST else None))
            names, counts, sketched = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(counts, pa.int64()), pa.array(sketched, pa.binary())],
                                             names=["name", "n", "sketch"])

    return sketches(text)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets of sorted hashes have at least the similarity."""
    place = np.searchsorted(a, b)
    place[place == len(a)] = 0
    shared = int((a[place] == b).sum()) if len(a) else 0
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar, from texts (sid, text). Every text is shuffled to the
    pairs once; the texts compared with one set a are dealt out in blocks, each with a copy of a's text."""
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.lit(1)).cast("int")
    counted = pairs.groupBy("a").agg(F.count("*").alias("m"))
    dealt = pairs.join(counted, "a").select("a", "b", F.pmod(F.xxhash64("b"), blocks).cast("int").alias("block"))
    whole = counted.select(F.col("a").alias("sid"), "a", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(0).alias("other"))
    wanted = dealt.select(F.col("b").alias("sid"), "a", "block", F.lit(1).alias("other")).unionByName(whole)
    brought = wanted.join(texts, "sid").repartition("a", "block").sortWithinPartitions("a", "block", "other").select("a", "sid", "other", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, u, v = np.zeros(0, np.uint64), [], []
        for batch in batches:
            for a, sid, other, text in zip(*batch.columns):
                own = shingle_hashes(text.as_py(), size)
                if not other.as_py():
                    held = own
                elif similar(held, own, percent):
                    u.append(a.as_py())
                    v.append(sid.as_py())
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
            u, v = [], []

    return brought.mapInArrow(compare, "u bigint, v bigint")


def star_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """For each set one pair (a, b): itself as b with the first set that it shares most bands with. ``rows`` are
    (key, sid, n, first), with first = (sid, n) of the band's first set."""
    fits = 100 * F.least("n", "first.n") >= percent * F.greatest("n", "first.n")
    apart = rows.filter((F.col("sid") != F.col("first.sid")) & fits)
    shared = apart.groupBy(F.col("sid").alias("b"), F.col("first.sid").alias("a")).agg(F.count("*").alias("bands"))
    return shared.groupBy("b").agg(F.max_by("a", F.struct("bands", "a")).alias("a")).select("a", "b")


def two_components(rows: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of shared bands, and of links, each as (node, root): one graph that has every set twice."""
    shared = rows.select(F.col("sid") * 2, F.col("first.sid") * 2)
    both = components(shared.unionByName(links.select(F.col("u") * 2 + 1, F.col("v") * 2 + 1).toDF(*shared.columns)).toDF("u", "v"))
    return tuple(both.filter(F.pmod("node", F.lit(2)) == side).select((F.expr("node div 2")).alias("node"), F.expr("root div 2").alias("root")) for side in (0, 1))


def open_clusters(clusters: DataFrame, roots: DataFrame) -> DataFrame:
    """(sid, root, cluster, main, own, task): sets of clusters that hold several groups, once for each task that compares
    them. A cluster is a component of shared bands, ``main`` marks the members of its largest group, and ``own`` is a set's block
    among the main or the other sets. Main blocks meet blocks of others, and those meet each other; main sets don't."""
    clusters = clusters.select(F.col("node").alias("sid"), F.col("root").alias("cluster"))
    clusters = clusters.unionByName(clusters.select(F.col("cluster").alias("sid"), "cluster").distinct())
    named = clusters.join(roots, F.col("sid") == F.col("node"), "left").select("sid", "cluster", F.coalesce("root", "sid").alias("root"))
    named = materialize(named, "minhash-clusters")
    sizes = named.groupBy("cluster", "root").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("m", "root")).alias("most"), F.sum("m").alias("all")).filter("all > most.m")
    blocks = lambda n: F.ceil(n / BLOCK).cast("bigint")
    sized = largest.select("cluster", F.col("most.root").alias("main_root"), blocks(F.col("most.m")).alias("mains"),
                           blocks(F.col("all") - F.col("most.m")).alias("others"))
    both = named.join(sized, "cluster").withColumn("main", F.col("root") == F.col("main_root"))
    own = F.pmod(F.xxhash64("sid"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("others")))
    both = both.withColumn("own", own)
    count = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    of_main = F.transform(count(F.col("others")), lambda j: F.col("own") * F.col("others") + j)
    with_main = F.transform(count(F.col("mains")), lambda i: i * F.col("others") + F.col("own"))
    with_other = F.transform(count(F.col("others")), lambda o: -1 - F.least("own", o) * F.col("others") - F.greatest("own", o))
    tasks = F.when(F.col("main"), of_main).otherwise(F.concat(with_main, with_other))
    return both.select("sid", "root", "cluster", "main", "own", F.explode(tasks).alias("task"))


class _Groups:
    """Groups that links join."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def of(self, x: int) -> int:
        while x in self.up:
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.of(a)] = self.of(b)


def compare_block(held: list[tuple], size: int, percent: int, agree: int) -> Iterator[tuple[int, int]]:
    """Links that join different groups among the sets (sid, root, main, own, task, sketch, text) of one task: a spanning
    forest of all links there. Pairs whose sketches agree enough are compared on the whole sets, the likeliest first."""
    if not held:
        return
    roots = np.array([h[1] for h in held], np.int64)
    main, own = np.array([h[2] for h in held], bool), np.array([h[3] for h in held], np.int64)
    marks = np.stack([np.frombuffer(h[5], np.uint8) for h in held])
    across = held[0][4] >= 0
    apart = not across and len(np.unique(own)) > 1  # two blocks: pairs within one have a task of their own
    groups, sets = _Groups(), {}

    def whole(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_hashes(held[i][6], size)
        return sets[i]

    for i in np.flatnonzero(~main) if across else range(len(held)):
        other = np.flatnonzero(main) if across else np.flatnonzero((roots != roots[i]) & (np.arange(len(held)) > i) & (~apart | (own != own[i])))
        equal = (marks[other] == marks[i]).sum(1)
        for place in np.argsort(-equal, kind="stable")[: int((equal >= agree).sum())]:
            j = int(other[place])
            if groups.of(int(roots[i])) != groups.of(int(roots[j])) and similar(whole(i), whole(j), percent):
                groups.join(int(roots[i]), int(roots[j]))
                yield held[i][0], held[j][0]


def rest_links(members: DataFrame, sketches: DataFrame, texts: DataFrame, size: int, percent: int, agree: int = AGREE) -> DataFrame:
    """Links (u, v) between different groups of a cluster; at most one from each set and task to each group."""
    brought = members.join(sketches.select("sid", "sketch").join(texts, "sid"), "sid")
    together = brought.repartition("cluster", "task").sortWithinPartitions("cluster", "task")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[tuple]) -> pa.RecordBatch:
            u, v = list(zip(*compare_block(held, size, percent, agree))) or ((), ())
            return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        held, at = [], None
        for batch in batches:
            for cluster, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (cluster, row[4]):
                    yield found(held)
                    held, at = [], (cluster, row[4])
                held.append(tuple(row))
        yield found(held)

    return together.select("cluster", "sid", "root", "main", "own", "task", "sketch", "text").mapInArrow(compare, "u bigint, v bigint")


def crowded_bands(banded: DataFrame) -> DataFrame:
    """Each row with the first set of its band; bands with one set go."""
    order = Window.partitionBy("key").orderBy("sid")
    marked = banded.select("*", F.first(F.struct("sid", "n")).over(order).alias("first"), F.lead("sid").over(order).alias("next"))
    return marked.filter((F.col("sid") != F.col("first.sid")) | F.col("next").isNotNull()).drop("next")


def near_duplicates(df: DataFrame, key: str, text: str, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``df``: ``doc_key``, ``n_shingles`` and ``component_id``, the least key of the group."""
    twin = F.xxhash64(F.lit("twin"), F.col(text))
    prints = df.select(F.col(key).alias("doc_key"), F.xxhash64(text).alias("t1"), twin.alias("t2"), sketch_column(F.col(text), size).alias("s"))
    prints = materialize(prints.select("doc_key", "t1", "t2", "s.name", "s.n", "s.sketch"), "minhash")

    # One row stands for all with the same set; its number is fixed once it is written.
    row = F.struct(F.col("doc_key").isNull().alias("unknown"), "doc_key", "t1", "t2")
    merged = prints.filter(F.col("name").isNotNull()).groupBy("name").agg(F.min(row).alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sets = materialize(merged.withColumn("sid", F.monotonically_increasing_id()), "minhash-sets")

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("sketch", i * ROWS + 1, F.lit(ROWS))))
    banded = sets.filter(F.col("sketch").isNotNull()).select("sid", "n", F.explode(bands).alias("key"))
    rows = materialize(crowded_bands(banded), "minhash-bands")

    crowded = rows.select("sid").distinct().join(sets, "sid").select("sid", "row.doc_key", "row.t1", "row.t2")
    texts = df.select(F.col(key).alias("doc_key"), F.xxhash64(text).alias("t1"), twin.alias("t2"), F.col(text).alias("text"))
    once = texts.withColumn("copy", F.row_number().over(Window.partitionBy("t1", "t2", "doc_key").orderBy(F.lit(0)))).filter("copy = 1").alias("x")
    same = (F.col("x.t1") == F.col("c.t1")) & (F.col("x.t2") == F.col("c.t2")) & F.col("x.doc_key").eqNullSafe(F.col("c.doc_key"))
    texts = materialize(once.join(crowded.alias("c"), same).select("sid", "text"), "minhash-texts")

    pairs = materialize(star_pairs(rows, percent), "minhash-pairs")
    stars = materialize(verified(pairs, texts, size, percent), "minhash-links")
    members = open_clusters(*two_components(rows, stars))
    rest = materialize(rest_links(members, sets, texts, size, percent), "minhash-links")
    roots = components(stars.unionByName(rest))

    grouped = sets.join(roots, F.col("sid") == F.col("node"), "left").select("name", F.col("row.doc_key").alias("own"), F.coalesce("root", "sid").alias("root"))
    grouped = materialize(grouped, "minhash-groups")
    least = grouped.groupBy("root").agg(F.min("own").alias("component_id"))
    told = grouped.join(least, "root").select("name", "component_id")
    full = prints.filter(F.col("name").isNotNull()).select("doc_key", "name", F.col("n").alias("n_shingles")).join(told, "name")
    empty = prints.filter(F.col("name").isNull()).select("doc_key", F.col("n").alias("n_shingles"), F.col("doc_key").alias("component_id"))
    return full.select("doc_key", "n_shingles", "component_id").unionByName(empty)

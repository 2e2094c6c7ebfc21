"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint takes, bit by bit, the majority over the XXH64 hashes of a text's shingles. Two texts link if their
fingerprints differ in at most ``RADIUS`` bits, and a group is a connected component of links.

Equal fingerprints are merged first. The 64 bits are grouped so that correlated ones share a partition, and every
partition gets its own threshold t, such that the sum of (t + 1) is at least RADIUS + 1: then any two linked
fingerprints agree within t bits in some partition. A dynamic programme picks the thresholds, and a loop the number of
partitions, with the least estimated work: probe rows exactly, candidates by a bounded sample of fingerprints. The plan
changes cost only; every plan finds every link. Candidates share a key, are compared in full, and reduce to a spanning
forest before they leave their task, so groups of any size give no more edges than members. Keys with more than
``BLOCK`` members are cut into blocks, and each pair of blocks is a task's work of its own.

Texts without words and null texts have fingerprint zero and link like any other. Ties at half the shingles give a
bit of 0. Rows that repeat a key or a text share one component; its id is the least key in it, and null keys count only
if all are null. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
BITS = 64
SAMPLE = 4096  # fingerprints for the estimate of candidates
BLOCK = 8192  # members of a key compared in one task
RUN = 64  # members up to which runs are compared side by side
ROW_COST, PAIR_COST = 1.0, 0.02  # of moving a row and of comparing a candidate
PARTITIONS = range(2, 7)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a text."""
    words = (text or "").encode("utf-8").lower().split()  # both of ASCII only
    if not words:
        return 0
    if len(words) < size:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    ones, n = np.zeros(BITS, np.int64), 0
    while chunk := list(itertools.islice(shingles, 1 << 14)):
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in chunk), "<u8", len(chunk))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(chunk)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, size: int = SHINGLE) -> Column:
    @F.arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(v.as_py(), size) for v in batch], pa.int64())

    return fingerprints(text)


@dataclass(frozen=True)
class Part:
    """Bits of a partition, lowest first, and the differing bits it allows; -1 leaves it out."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)


def probe_rows(width: int, threshold: int) -> float:
    """Rows a fingerprint sends for a partition, on average. One flip turns a 0 into a 1 only, as the other fingerprint
    of the pair has the 1; two flips meet half way, so each side flips any one bit."""
    return {-1: 0.0, 0: 1.0, 1: 1 + width / 2, 2: 1.0 + width}[threshold]


def bit_groups(bits: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Groups of near-equal size; each grows from the lowest free bit by the bit most correlated with its members."""
    spread = bits - bits.mean(0)
    norm = np.sqrt((spread**2).sum(0))
    likeness = np.abs(spread.T @ spread) / np.maximum(np.outer(norm, norm), 1e-9)
    free, groups = set(range(BITS)), []
    for part in range(parts):
        group = [min(free)]
        free -= set(group)
        while len(group) < len(range(part, BITS, parts)):
            best = max(sorted(free), key=lambda b: likeness[b, group].sum())
            group.append(best)
            free.remove(best)
        groups.append(tuple(sorted(group)))
    return groups


def allocate(costs: list[dict[int, float]], radius: int) -> tuple[float, list[int]]:
    """Thresholds with the least total cost whose sum of (t + 1) reaches radius + 1, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for have, (spent, chosen) in best.items():
            for threshold, more in cost.items():
                now = min(radius + 1, have + threshold + 1)
                if now not in step or spent + more < step[now][0]:
                    step[now] = (spent + more, [*chosen, threshold])
        best = step
    return best.get(radius + 1, (float("inf"), []))


def plan_parts(sample: np.ndarray, total: int, radius: int = RADIUS) -> list[Part]:
    """The cheapest plan for ``total`` fingerprints of which ``sample`` is a uniform part."""
    values = sample.astype(np.int64).view(np.uint64)
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    scale = (total / max(len(values), 1)) ** 2
    plans = []
    for parts in PARTITIONS:
        groups = bit_groups(bits, parts)
        costs = []
        for group in groups:
            own = values & np.uint64(sum(1 << b for b in group))
            near = np.zeros(BITS + 1)
            for start in range(0, len(own), 256):
                near += np.bincount(np.bitwise_count(own[start: start + 256, None] ^ own[None, :]).ravel(), minlength=BITS + 1)
            near[0] -= len(own)  # itself
            within = np.cumsum(near) / 2 * scale
            costs.append({t: ROW_COST * total * probe_rows(len(group), t) + PAIR_COST * (float(within[t]) if t >= 0 else 0.0)
                          for t in range(-1, min(radius, 2) + 1)})
        cost, thresholds = allocate(costs, radius)
        plans.append((cost, parts, [Part(g, t) for g, t in zip(groups, thresholds)]))
    return min(plans, key=lambda p: p[:2])[2]


def probes(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """Rows (part, key, fp, flipped): the masked fingerprint, and its one-bit neighbours where the threshold asks."""
    rows = []
    for i, part in enumerate(parts):
        if part.threshold < 0:
            continue
        own = F.col("fp").bitwiseAND(F.lit(_signed(part.mask)))
        rows.append(F.array(F.struct(F.lit(i).alias("part"), own.alias("key"), F.lit(False).alias("flipped"))))
        if part.threshold:
            flips = F.array(*(F.lit(_signed(1 << b)) for b in part.bits))
            wanted = F.filter(flips, lambda b: own.bitwiseAND(b) == 0) if part.threshold == 1 else flips
            rows.append(F.transform(wanted, lambda b: F.struct(F.lit(i).alias("part"), own.bitwiseXOR(b).alias("key"), F.lit(True).alias("flipped"))))
    return fps.select("fp", F.explode(F.concat(*rows)).alias("p")).select("p.part", "p.key", "fp", "p.flipped")


def links(rows: DataFrame, parts: list[Part], radius: int) -> DataFrame:
    """Star edges (u, v) that connect what the probes link. Rows with the same key stand together in one task; keys
    beyond ``BLOCK`` rows are first dealt out by pairs of blocks."""
    hot = materialize(rows.groupBy("part", "key").count().filter(F.col("count") > BLOCK), "simhash-hot")
    if hot.isEmpty():
        blocked = rows.withColumn("block", F.lit(0))
    else:
        marked = rows.join(hot, ["part", "key"], "left")
        blocks = F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)).cast("int")
        own = F.pmod(F.xxhash64("fp", "flipped"), blocks).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.least(own, other) * blocks + F.greatest(own, other))
        blocked = marked.select("part", "key", "fp", "flipped", F.explode(pairs).alias("block"))
    together = blocked.repartition("part", "key", "block").sortWithinPartitions("part", "key", "block")
    both_flip = frozenset(i for i, p in enumerate(parts) if p.threshold == 2)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _whole_runs(batches):
            u, v = _compare(*run, both_flip, radius)
            yield pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

    return together.mapInArrow(linked, "u bigint, v bigint")


def _whole_runs(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns (run number, part, fp, flipped) of sorted rows, cut only between keys."""
    held: list[np.ndarray] = []

    def columns(table: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        part, key, block, fp, flipped = (table.column(n).to_numpy(zero_copy_only=False) for n in ("part", "key", "block", "fp", "flipped"))
        return part, key, block, fp, flipped

    def numbered(c: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        changes = (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1]) | (c[2][1:] != c[2][:-1])
        return np.concatenate([[0], np.cumsum(changes)]), c[0], c[3], c[4]

    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = columns(batch)
        held = [np.concatenate(x) for x in zip(held, fresh)] if held else list(fresh)
        if len(held[0]) >= rows:
            run = numbered(held)
            cut = int(np.searchsorted(run[0], run[0][-1]))
            if cut:
                yield tuple(x[:cut] for x in run)
                held = [x[cut:] for x in held]
    if held and len(held[0]):
        yield numbered(held)


def _compare(run: np.ndarray, part: np.ndarray, fp: np.ndarray, flipped: np.ndarray, both_flip: frozenset[int], radius: int):
    """Edges of a spanning forest over the links in each run."""
    found_u, found_v = [], []
    meets = np.isin(part, list(both_flip))
    sizes = np.bincount(run)
    small = sizes[run] <= RUN
    r, f, s, m = run[small], fp[small], flipped[small], meets[small]
    for lag in range(1, RUN):
        same = np.flatnonzero(r[lag:] == r[:-lag])
        if not len(same):
            break
        same = same[m[same] | ~(s[same] & s[same + lag])]
        near = np.bitwise_count((f[same] ^ f[same + lag]).view(np.uint64)) <= radius
        found_u.append(f[same][near])
        found_v.append(f[same + lag][near])
    for number in np.flatnonzero(sizes > RUN):
        members = np.unique(fp[slice(*np.searchsorted(run, [number, number + 1]))])
        u, v = _spanning(members, radius)
        found_u.append(u)
        found_v.append(v)
    return forest(np.concatenate(found_u or [fp[:0]]), np.concatenate(found_v or [fp[:0]]))


def _spanning(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A search over one large run: each member is compared once with all that no component has reached."""
    left, us, vs = members, [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= radius
            if near.any():
                reached = left[near]
                us.append(np.full(len(reached), at))
                vs.append(reached)
                queue += list(reached)
                left = left[~near]
    return np.concatenate(us or [members[:0]]), np.concatenate(vs or [members[:0]])


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, root) of the components of edges, by hooking and pointer jumping."""
    nodes, inverse = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inverse[: len(u)], inverse[len(u):]
    parent = np.arange(len(nodes))
    while True:
        pa_, pb = parent[a], parent[b]
        if (pa_ == pb).all():
            break
        np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    moved = parent != np.arange(len(nodes))
    return nodes[moved], nodes[parent[moved]]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def group_fingerprints(prints: DataFrame, key: str, radius: int = RADIUS) -> DataFrame:
    """From stored rows (key, fp): one row per fingerprint with ``component_id`` and ``root``, a fingerprint of the
    component. Reads the rows twice; the driver sees a bounded sample and counts."""
    fps = materialize(prints.groupBy("fp").agg(F.min(key).alias("least")), "simhash-fps")
    total = fps.count()
    sample = np.array([r.fp for r in fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64)
    if not total:
        return fps.select("fp", F.col("least").alias("component_id"), F.col("fp").alias("root"))
    parts = plan_parts(sample, total, radius)
    member = components(links(probes(fps, parts), parts, radius))
    rooted = fps.join(member, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id", "root")


def near_duplicates(df: DataFrame, key: str, text: str, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One row per row of ``df``: ``doc_key``, ``fp`` and ``component_id``. Texts stay where they are read."""
    prints = materialize(df.select(F.col(key).alias("doc_key"), fingerprint_column(F.col(text), size).alias("fp")), "simhash")
    groups = materialize(group_fingerprints(prints, "doc_key", radius).select("fp", "component_id"), "simhash-groups")
    return prints.join(groups, "fp").select("doc_key", "fp", "component_id")


def keep_one(df: DataFrame, key: str, text: str, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """The rows of ``df`` with the least key of each component, one each; of rows that share that key, the one whose
    columns hash lowest. Choosing moves keys and hashes only; texts are shuffled once, to meet the chosen."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.array(*(c.isNull() for c in columns))  # hashing passes over nulls
    row = {"__row": F.xxhash64(nulls, *columns), "__twin": F.xxhash64(F.lit("twin"), nulls, *columns)}  # 128 bits name a row
    prints = materialize(df.select(F.col(key).alias("doc_key"), *(v.alias(n) for n, v in row.items()),
                                   fingerprint_column(F.col(text), size).alias("fp")), "simhash")
    groups = materialize(group_fingerprints(prints, "doc_key", radius).select("fp", "root"), "simhash-groups")
    # Nulls last, then the least key and row.
    order = F.struct(F.col("doc_key").isNull().alias("unknown"), "doc_key", *row)
    first = prints.join(groups, "fp").groupBy("root").agg(F.min(order).alias("first"))
    chosen = first.select(*(f"first.{n}" for n in row)).distinct()
    # The row rides along in one column, so no name of the table can meet a name of the plan.
    kept = df.select(F.struct(*columns).alias("row"), *(v.alias(n) for n, v in row.items())).join(chosen, list(row))
    # Rows that repeat in every column meet here, in the partitioning of the join.
    ranked = kept.withColumn("__n", F.row_number().over(Window.partitionBy(*row).orderBy(F.lit(0))))
    return ranked.filter("__n = 1").select("row.*")

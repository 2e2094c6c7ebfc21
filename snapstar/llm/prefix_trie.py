"""The trie of conversation prefixes: who shares which opening turns, and what keeping each opening once would save.

1. Distinct turns get dense numbers, the dictionary: by rank within hash buckets, from 128-bit digests, so texts are never shuffled.
2. Every conversation becomes the list of its turns' numbers. Lists are sorted over range shards, by list and then conversation, so a
   list that very many conversations have is dealt out to many shards.
3. Each shard cuts its lists into runs of bounded size and builds a ternary search tree of each run: a node holds a turn's
   number, smaller and larger siblings, and the tree of the turns that follow it. Lists are inserted median first, which
   balances the siblings. An iterative traversal adds up members, leaves and savings from the leaves to the root.
4. Prefixes of a run's first and last list may go on in its neighbours; all others are done. Only those boundary nodes move on:
   neighbours are merged ``FAN`` shards at a time, level by level, and each merge is done with all but the prefixes of
   its own first and last list.

A task holds one run, or the boundary nodes of ``FAN`` neighbours. Conversations that end in a boundary node come as text in
pieces of at most a run, in order, and are hashed as a stream. A conversation is held as numbers, 8 bytes a turn, and has to fit a task.

Turns are ordered by turn, null first, then by their number in the dictionary. Null role or text is empty. Rows without a
conversation take no part. Repeated rows are repeated turns. An empty table gives an empty result. Only the four named
columns are read, so further ones can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BUCKETS = 4096  # of the dictionary
RUN_TURNS, RUN_LISTS = 1 << 17, 1 << 14  # turns and conversations of a run; a longer conversation is a run of its own
FAN = 64
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODES = ("kind int, run bigint, on_first boolean, on_last boolean, key binary, parent binary, depth bigint, length bigint, n bigint, "
         "least bigint, children bigint, leaves bigint, saved bigint, parent_least bigint, ends string")
COLUMNS = [c.split()[0] for c in NODES.split(", ")]
TYPES = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
SCHEMA = pa.schema([(c.split()[0], TYPES[c.split()[1]]) for c in NODES.split(", ")])
DONE, BOUNDARY, ENDS = 0, 1, 2  # finished nodes, boundary nodes, and the members that end in a boundary node


@dataclass
class Tree:
    """A ternary search tree in lists. Node 0 is the root of the trie and has no turn; ``low`` and ``high`` are siblings,
    ``next`` is the tree of the turns after this one, and -1 is none."""

    turn: list[int] = field(default_factory=lambda: [0])
    length: list[int] = field(default_factory=lambda: [0])
    low: list[int] = field(default_factory=lambda: [-1])
    high: list[int] = field(default_factory=lambda: [-1])
    next: list[int] = field(default_factory=lambda: [-1])
    ends: dict[int, list[int]] = field(default_factory=dict)

    def _add(self, turn: int, length: int) -> int:
        for column, value in ((self.turn, turn), (self.length, length), (self.low, -1), (self.high, -1), (self.next, -1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, turns: list[int], lengths: list[int], members: list[int]) -> list[int]:
        """Add a list that isn't there yet; returns the nodes of its path, root first."""
        path = [0]
        for turn, length in zip(turns, lengths):
            side, at = self.next, path[-1]
            while side[at] >= 0:
                at = side[at]
                if turn == self.turn[at]:
                    break
                side = self.low if turn < self.turn[at] else self.high
            else:
                side[at] = self._add(turn, length)
                at = side[at]
            path.append(at)
        self.ends[path[-1]] = members
        return path

    def top_down(self) -> Iterator[tuple[int, int]]:
        """Nodes with their parent in the trie (-1: none), parents first."""
        yield 0, -1
        stack = [(self.next[0], 0)]
        while stack:
            at, parent = stack.pop()
            if at >= 0:
                yield at, parent
                stack += [(self.low[at], parent), (self.high[at], parent), (self.next[at], at)]


def median_order(n: int) -> Iterator[int]:
    """Places of a sorted list, the middle of every part before its halves."""
    parts = [(0, n)]
    while parts:
        low, high = parts.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            parts += [(low, middle), (middle + 1, high)]


def build_tree(lists: list[tuple[list[int], list[int], list[int]]]) -> tuple[Tree, list[int], list[int]]:
    """Tree of sorted distinct lists (turns, lengths, members), and the paths of the first and the last."""
    tree, paths = Tree(), {}
    for i in median_order(len(lists)):
        path = tree.insert(*lists[i])
        if i in (0, len(lists) - 1):
            paths[i] = path
    return tree, paths[0], paths[len(lists) - 1]


def _digest(members: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, members)).encode()).hexdigest()


def run_nodes(lists: list[tuple[list[int], list[int], list[int]]], run: int) -> list[tuple]:
    """Rows of ``NODES`` of one run."""
    tree, first, last = build_tree(lists)
    size = len(tree.turn)
    on_first, on_last = set(first), set(last)
    keys = {0: ROOT}
    for path in (first, last):
        for parent, at in zip(path, path[1:]):
            keys[at] = hashlib.blake2b(keys[parent] + tree.turn[at].to_bytes(8, "little"), digest_size=16).digest()
    order = list(tree.top_down())
    parent, depth = [-1] * size, [0] * size
    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for at, up in order:
        parent[at], depth[at] = up, depth[up] + 1 if up >= 0 else 0
    for at, up in reversed(order):
        own = tree.ends.get(at)
        if own:
            members[at] += len(own)
            least[at] = own[0] if least[at] is None else min(least[at], own[0])
        if at not in keys:
            leaves[at] = leaves[at] if children[at] else 1
            saved[at] += (members[at] - 1) * tree.length[at]
            children[up], leaves[up], saved[up] = children[up] + 1, leaves[up] + leaves[at], saved[up] + saved[at]
        if up >= 0:
            members[up] += members[at]
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
    rows = []
    for at, up in order:
        measures = (depth[at], tree.length[at], members[at], least[at], children[at], leaves[at], saved[at])
        if at not in keys:
            ends = _digest(tree.ends[at]) if at in tree.ends else NO_ENDS
            rows.append((DONE, None, None, None, None, keys.get(up), *measures, None if up in keys else least[up], ends))
        else:
            rows.append((BOUNDARY, run, at in on_first, at in on_last, keys[at], keys.get(up), *measures, None, None))
            if at in tree.ends:
                rows.append((ENDS, run, None, None, keys[at], *[None] * 9, ",".join(map(str, tree.ends[at]))))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(SCHEMA)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def shard_nodes(sequences: DataFrame) -> DataFrame:
    """``NODES`` of every run, from (conv_id, turns, lengths)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shards are numbered in the order of their lists, runs within them; 24 bits take the runs of a shard.
        run, held, turns, lists = TaskContext.get().partitionId() << 24, [], 0, 0
        for batch in batches:
            for conversation, own, lengths in zip(*batch.columns):
                own = own.as_py()
                if lists and (turns >= RUN_TURNS or lists >= RUN_LISTS):
                    yield _batch(run_nodes(held, run))
                    run, held, turns, lists = run + 1, [], 0, 0
                if held and held[-1][0] == own:
                    held[-1][2].append(conversation.as_py())
                else:
                    held.append((own, lengths.as_py(), [conversation.as_py()]))
                    turns += len(own)
                lists += 1
        if held:
            yield _batch(run_nodes(held, run))

    ordered = sequences.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    return ordered.mapInArrow(build, NODES)


def merge_boundaries(rows: list[dict], top: bool) -> list[tuple]:
    """Boundary nodes of neighbours as one. Those on the first list of the first or the last list of the last stay boundary nodes,
    unless this is the whole (``top``); the others are done and count in their parents."""
    nodes: dict[bytes, dict] = {}
    first, last = min(r["run"] for r in rows), max(r["run"] for r in rows)
    for r in rows:
        r["on_first"], r["on_last"] = r["on_first"] and r["run"] == first, r["on_last"] and r["run"] == last
        node = nodes.setdefault(r["key"], r)
        if node is not r:
            node["least"] = min(node["least"], r["least"])
            for c in ("n", "children", "leaves", "saved"):
                node[c] += r[c]
            for c in ("on_first", "on_last"):
                node[c] = node[c] or r[c]
    out = []
    for node in sorted(nodes.values(), key=lambda r: -r["depth"]):
        if not top and (node["on_first"] or node["on_last"]):
            # One number for the whole group from here on: it neighbours as one.
            out.append(node | {"run": first})
            continue
        node["leaves"] = node["leaves"] if node["children"] else 1
        node["saved"] += (node["n"] - 1) * node["length"]
        if node["parent"] is not None:
            up = nodes[node["parent"]]
            up["children"], up["leaves"], up["saved"] = up["children"] + 1, up["leaves"] + node["leaves"], up["saved"] + node["saved"]
        out.append(node | {"kind": DONE, "on_first": None, "on_last": None})
    return [tuple(r[c] for c in COLUMNS) for r in out]


def merged_nodes(boundary: DataFrame) -> DataFrame:
    """All boundary nodes as whole nodes, by merging neighbouring shards level by level."""
    def merge(top: bool):
        return lambda near: pa.Table.from_batches([_batch(merge_boundaries(near.drop_columns(["neighbours"]).to_pylist(), top))])

    done, level = None, 0
    most = boundary.agg(F.max(F.shiftright("run", 24))).first()[0]
    while True:
        top = most is None or FAN**level > most
        group = F.floor(F.shiftright("run", 24) / F.lit(FAN**level))
        near = boundary.withColumn("neighbours", group).groupBy("neighbours")
        step = materialize(near.applyInArrow(merge(top), NODES), "trie-level")
        ended = step.filter(F.col("kind") == DONE)
        done = ended if done is None else done.unionByName(ended)
        if top:
            return done
        boundary, level = step.filter(F.col("kind") == BOUNDARY), level + 1


def _hashed_ends(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the pieces of each key, joined by commas in the order of runs, one piece at a time."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, keys, digests = None, None, [], []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key != at:
                    if at is not None:
                        keys.append(at)
                        digests.append(state.hexdigest())
                    at, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_py().encode())
        if at is not None:
            keys.append(at)
            digests.append(state.hexdigest())
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "own_ends"])

    ordered = pieces.repartition("key").sortWithinPartitions("key", "run").select("key", "ends")
    return ordered.mapInArrow(hashed, "key binary, own_ends string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per prefix of the lists (conv_id, turns, lengths): see the query for the columns."""
    stored = materialize(shard_nodes(sequences), "trie")
    whole = merged_nodes(stored.filter(F.col("kind") == BOUNDARY))
    known = whole.select(F.col("key").alias("up"), F.col("least").alias("up_least"))
    ends = _hashed_ends(stored.filter(F.col("kind") == ENDS).select("key", "run", "ends"))
    closed = whole.drop("ends").join(ends, "key", "left").withColumn("ends", F.coalesce("own_ends", F.lit(NO_ENDS))).drop("own_ends")
    inner = stored.filter(F.col("kind") == DONE)
    settled = inner.filter(F.col("parent").isNull()).withColumn("up_least", F.col("parent_least"))
    below = inner.filter(F.col("parent").isNotNull()).unionByName(closed).join(known, F.col("parent") == F.col("up"), "left").drop("up")
    return settled.unionByName(below).select(
        F.col("least").alias("conv_id"), "depth", F.col("up_least").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def code_turns(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns): the structs (id, length) of each conversation in order, ``id`` from the dictionary and
    ``length`` the text's code points."""
    said, what = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    name = F.unhex(F.md5(F.concat_ws(":", F.char_length(said).cast("string"), said, what).cast("binary")))
    rows = df.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), name.alias("name"), F.char_length(what).alias("length"))
    rows = materialize(rows, "turns")
    bucket = F.pmod(F.xxhash64("name"), F.lit(BUCKETS))
    ranked = rows.select("name").distinct().withColumn("bucket", bucket)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("name"))
    dictionary = ranked.select("name", (F.shiftleft(F.col("bucket").cast("bigint"), 40) + place).alias("id"))
    step = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "id", "length")
    gathered = rows.join(dictionary, "name").groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("turns"))
    return gathered.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["length"].alias("length"))).alias("turns"))


def share_openings(coded: DataFrame, opening: Column, family: Column, most: int) -> DataFrame:
    """Conversations whose first ``opening`` turns (below ``most``) are replaced by those of the conversation ``family``
    names, all if it has fewer and none if it isn't there."""
    coded = materialize(coded, "conversations")
    heads = coded.filter(family == F.col("conv_id")).select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, most).alias("head"))
    joined = coded.select("conv_id", "turns", opening.alias("h"), family.alias("family")).join(heads, F.col("family") == F.col("first_id"), "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    whole = joined.select("conv_id", F.concat(head, tail).alias("turns"))
    return whole.select("conv_id", F.col("turns.id").alias("turns"), F.col("turns.length").alias("lengths"))

"""Removal of passages that already stand in an earlier document, by fixed-block anchors.

A word goes if a window of ``WINDOW`` words that covers it also starts in a document with a smaller key. Any window of
50 words holds a whole block of 25 that starts at a multiple of 25 in its document, so:

1. index and probe: every document sends the hash of each rolling window of 25 words; those at multiples of 25 are the
   reference blocks. A hash with a block that occurs twice or more is an anchor.
2. extend: a document with anchors hashes (96 bits) each of its 50-word windows that holds one, and every such hash gets the least
   key it starts in. Overlapping windows with a smaller key make up the maximal repeats.
3. cut: the words those windows cover go.

Rows that leave a task are packed: one for each hash bucket and batch of documents, with the documents it concerns and no others, and
on the way back one for each bucket and group of documents. Hashes that a batch holds more than
once are settled within it, and the batch sends one of each, so a passage that a third of all documents share
costs a few bytes a batch. The number of buckets follows the input. Texts cross the network once.

Null texts have no words. Shorter texts than a window lose nothing. Repeats within one document stay, as do those among rows
that share a key. A null key is greater than all others. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, BLOCK = 50, 25
BATCH_WORDS = 1 << 20  # words of documents packed together
BUCKET_BYTES = 16 << 20  # bytes of text for each bucket
NO_KEY = (1 << 63) - 1
PACKED = "bucket int, payload binary"
CACHE_WORDS, CACHE_BYTES = 500_000, 64


class WordHashes(dict):
    """64-bit hashes of words, kept for those seen lately."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_BYTES:
            if len(self) > CACHE_WORDS:
                self.clear()
            self[word] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8").split()  # at ASCII white space only
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Rolling:
    """Hashes of all windows of a length: a polynomial in an odd base, modulo 2**64, from running sums."""

    def __init__(self, length: int, base: int) -> None:
        self.length, self.base, self.inverse = length, base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                self.up, self.down = (np.multiply.accumulate(np.append(np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)))
                                      for x in (self.base, self.inverse))

    def __call__(self, words: np.ndarray) -> np.ndarray:
        n = len(words) - self.length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        self._powers(len(words))
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[: len(words)])])
            mixed = (sums[self.length:] - sums[:n]) * self.down[:n]
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            return mixed ^ (mixed >> np.uint64(29))


def anchors_of() -> Rolling:
    return Rolling(BLOCK, 0x9E3779B97F4A7C15)


def windows_of() -> tuple[Rolling, Rolling]:
    return Rolling(WINDOW, 0xC2B2AE3D27D4EB4F), Rolling(WINDOW, 0x165667B19E3779F9)


HEADER = struct.Struct("<cI")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each with type and length. The bytes of wide numbers are dealt out by place, so that zeros stand together and compress."""
    out = []
    for a in arrays:
        out.append(HEADER.pack(a.dtype.char.encode(), len(a)))
        a = np.ascontiguousarray(a)
        out.append((a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if a.dtype.itemsize > 1 else a).tobytes() if len(a) else b"")
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n = HEADER.unpack_from(data, at)
        dtype = np.dtype(kind.decode())
        planes = np.frombuffer(data, np.uint8, n * dtype.itemsize, at + HEADER.size).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += HEADER.size + n * dtype.itemsize
    return out


def _batches(batches: Iterable[pa.RecordBatch], words: WordHashes) -> Iterator[list[tuple]]:
    """Lists of (key, text hash, word hashes, other columns) of documents that have a window, up to BATCH_WORDS words."""
    held, n = [], 0
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for row in zip(*columns):
            hashes = words.of(row[2].as_py())
            if len(hashes) >= WINDOW:
                held.append((row[0].as_py(), row[1].as_py(), hashes, *(c.as_py() for c in row[3:])))
                n += len(hashes)
            if n >= BATCH_WORDS:
                yield held
                held, n = [], 0
    if held:
        yield held


def _doc_table(docs: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], np.int64)


def _owners(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents of rows that are sorted by document: each once, with how many rows it has, if most have several; otherwise
    one for each row, without numbers."""
    starts = _changes(owner)
    if 2 * len(starts) > len(owner):
        return owner, np.zeros(0, np.uint32)
    return owner[starts], np.diff(np.append(starts, len(owner))).astype(np.uint32)


def _each(documents: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The document of each row, from what ``_owners`` tells."""
    return np.repeat(documents, n) if len(n) else documents


def probe(buckets: int):
    """Step 1, by batch: for each bucket that occurs, hashes that occur once with block flag and their documents;
    hashes that occur more often, once each with block flag; and the occurrences of those with their documents, to be passed on.
    A row names the documents that have hashes in its bucket and no others, so rows together are in proportion to the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rolling = WordHashes(), anchors_of()
        for docs in _batches(batches, words):
            names = np.array([d[3] for d in docs], np.uint32)
            parts = [rolling(d[2]) for d in docs]
            hashes = np.concatenate(parts)
            owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            block = np.concatenate([np.arange(len(p)) % BLOCK == 0 for p in parts])
            bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            code = (bucket.astype(np.uint64) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))
            order = np.argsort(code, kind="stable")
            code, owner, block = code[order], owner[order], block[order]
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            counts = np.diff(np.append(starts, len(code)))
            has_block = np.logical_or.reduceat(block, starts)
            repeated = np.repeat(counts > 1, counts)
            bucket = (code >> np.uint64(32)).astype(np.int64)
            edges = _changes(bucket)
            first_of = np.searchsorted(starts, np.append(edges, len(code)))
            rows, low = [], (code & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            for i, (begin, end) in enumerate(zip(edges, np.append(edges[1:], len(code)))):
                here, groups = slice(begin, end), slice(first_of[i], first_of[i + 1])
                once, more = np.flatnonzero(~repeated[here]) + begin, np.flatnonzero(repeated[here]) + begin
                many = counts[groups] > 1
                once, more = once[np.argsort(owner[once], kind="stable")], more[np.argsort(owner[more], kind="stable")]
                (once_doc, once_n), (more_doc, more_n) = _owners(owner[once]), _owners(owner[more])
                rows.append((int(bucket[begin]), pack(
                    low[once], names[once_doc], once_n, np.packbits(block[once]),
                    low[starts[groups]][many], np.packbits(has_block[groups][many]),
                    low[more], names[more_doc], more_n)))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "payload"])

    return run


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows begin that differ from the row before."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _by_document(names: tuple[str, ...], documents: tuple[np.ndarray, ...], values: np.ndarray) -> pa.Table:
    """One row (columns that name a document, packed distinct values) for each document."""
    order = np.lexsort((values, *documents))
    values, documents = values[order], tuple(d[order] for d in documents)
    first = _changes(values, *documents)
    values, documents = values[first], tuple(d[first] for d in documents)
    starts = _changes(*documents)
    packed = [values[s:e].tobytes() for s, e in zip(starts, np.append(starts[1:], len(values)))]
    return pa.table([*(pa.array(d[starts].astype(np.int64)) for d in documents), pa.array(packed, pa.binary())], names=[*names, "found"])


def _by_target(targets: int, documents: tuple[np.ndarray, ...], values: np.ndarray) -> pa.Table:
    """Packed rows (target, documents with their distinct values); the target is a hash of the document."""
    mixed = np.zeros(len(values), np.uint64)
    for d in documents:
        mixed = (mixed ^ d.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    target = (mixed % np.uint64(targets)).astype(np.int64)
    order = np.lexsort((values, *documents, target))
    target, values, documents = target[order], values[order], tuple(d[order] for d in documents)
    first = _changes(values, *documents)
    target, values, documents = target[first], values[first], tuple(d[first] for d in documents)
    starts = _changes(target, *documents)
    counts = np.diff(np.append(starts, len(values))).astype(np.uint32)
    at = _changes(target[starts])
    rows: tuple[list, list] = ([], [])
    for begin, end in zip(at, np.append(at[1:], len(starts))):
        own = starts[begin:end]
        last = starts[end] if end < len(starts) else len(values)
        rows[0].append(int(target[own[0]]))
        rows[1].append(pack(*(d[own] for d in documents), counts[begin:end], values[own[0]:last]))
    return pa.table([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary())], names=["target", "payload"])


def collect(*names: str):
    """All values of each document of a target: one row for each document."""
    def run(group: pa.Table) -> pa.Table:
        documents, values = [], []
        for value in group.column("payload"):
            *own, counts, found = unpack(value.as_py())
            documents.append([np.repeat(d, counts) for d in own])
            values.append(found)
        return _by_document(names, tuple(np.concatenate(d) for d in zip(*documents)), np.concatenate(values))

    return run


TARGETED, ANCHORS, REPEATS = "target int, payload binary", "r bigint, found binary", "k bigint, t bigint, found binary"


def anchor(targets: int):
    """Step 1, by bucket: the anchors of each document."""
    return lambda group: _by_target(targets, *_anchors(group))


def _anchors(group: pa.Table) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    # A hash with two flags, in one number: whether it is a block's, and whether its batch has it more than once.
    codes, owners, values = [], [], []
    for value in group.column("payload"):
        once, once_names, once_n, once_block, many, many_block, more, more_names, more_n = unpack(value.as_py())
        codes += [_flagged(once, once_block, 0), _flagged(many, many_block, 1)]
        owners += [_each(once_names, once_n), _each(more_names, more_n)]
        values += [once, more]
    code = np.concatenate(codes)
    del codes
    code.sort()
    starts = _changes(code >> np.uint64(2))
    flags = np.bitwise_or.reduceat((code & np.uint64(3)).astype(np.uint8), starts)
    repeated = (np.diff(np.append(starts, len(code))) > 1) | (flags & 1 > 0)
    anchors = (code[starts[repeated & (flags & 2 > 0)]] >> np.uint64(2)).astype(np.uint32)
    del code, starts, flags, repeated
    hits = [_among(v, anchors) for v in values]
    return (np.concatenate([o[h] for o, h in zip(owners, hits)]),), np.concatenate([v[h] for v, h in zip(values, hits)])


def _flagged(hashes: np.ndarray, block: np.ndarray, twice: int) -> np.ndarray:
    return (hashes.astype(np.uint64) << np.uint64(2)) | (np.unpackbits(block, count=len(hashes)) << 1 | twice)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among sorted known ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def extend(buckets: int):
    """Step 2, by batch: hashes of the windows that hold an anchor. Of a hash that several documents of the batch have, only the least key
    goes on; the others are settled and passed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rolling, (first, second) = WordHashes(), anchors_of(), windows_of()
        for docs in _batches(batches, words):
            keys, texts = _doc_table(docs)
            high, low, owner = [], [], []
            for i, (_, _, hashes, found) in enumerate(docs):
                hits = np.frombuffer(found, np.uint32)
                codes = (rolling(hashes) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                held = np.concatenate([[0], np.cumsum(np.isin(codes, hits))])
                windows = np.flatnonzero(held[WINDOW - BLOCK + 1:] > held[: len(held) - (WINDOW - BLOCK + 1)])
                high.append(first(hashes)[windows])
                low.append(second(hashes)[windows].astype(np.uint32))
                owner.append(np.full(len(windows), i))
            high, low, owner = np.concatenate(high), np.concatenate(low), np.concatenate(owner)
            bucket = ((high >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((keys[owner], low, high, bucket))
            high, low, owner, bucket = high[order], low[order], owner[order], bucket[order]
            starts = _changes(high, low)
            least = np.repeat(keys[owner[starts]], np.diff(np.append(starts, len(high))))
            gone = keys[owner] > least
            # Rows with the least key stay candidates, each with its own text.
            twin = ~gone
            twin[_changes(high, low, texts[owner])] = False
            sent = ~gone & ~twin
            edges = _changes(bucket)
            rows = []
            for begin, end in zip(edges, np.append(edges[1:], len(bucket))):
                s, g = np.flatnonzero(sent[begin:end]) + begin, np.flatnonzero(gone[begin:end]) + begin
                s, g = s[np.argsort(owner[s], kind="stable")], g[np.argsort(owner[g], kind="stable")]
                (own, own_n), (left, left_n) = _owners(owner[s]), _owners(owner[g])
                rows.append((int(bucket[begin]), pack(high[s], low[s], keys[own], texts[own], own_n, high[g], keys[left], texts[left], left_n)))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "payload"])

    return run


def settle(targets: int):
    """Step 2, by bucket: the windows of each document that also start in one with a smaller key."""
    return lambda group: _by_target(targets, *_settled(group))


def _settled(group: pa.Table) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    own: list[tuple[np.ndarray, ...]] = []
    passed: list[tuple[np.ndarray, ...]] = []
    for value in group.column("payload"):
        high, low, keys, texts, n, gone, gone_keys, gone_texts, gone_n = unpack(value.as_py())
        own.append((_each(keys, n), _each(texts, n), high, low))
        passed.append((_each(gone_keys, gone_n), _each(gone_texts, gone_n), gone))
    keys, texts, high, low = (np.concatenate(c) for c in zip(*own))
    order = np.lexsort((keys, low, high))
    keys, texts, high, low = keys[order], texts[order], high[order], low[order]
    starts = _changes(high, low)
    least = np.repeat(keys[starts], np.diff(np.append(starts, len(high))))
    later = keys > least
    k, t, values = (np.concatenate(c) for c in zip((keys[later], texts[later], high[later]), *passed))
    return (k, t), values


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: words, removed words and what is left of each text."""
    hashes_of, (first, _) = WordHashes(), windows_of()
    for batch in batches:
        counts, removed, kept = [], [], []
        for key, mark, text, found in zip(*(batch.column(c) for c in ("k", "t", "x", "found"))):
            words = (text.as_py() or "").encode("utf-8").split()
            n, gone = len(words), 0
            own = [f["found"] for f in found.as_py() or () if (f["k"], f["t"]) == (key.as_py(), mark.as_py())]
            if own:
                hits = np.unique(np.concatenate([np.frombuffer(f, np.uint64) for f in own]))
                at = np.flatnonzero(np.isin(first(hashes_of.of(text.as_py())), hits))
                edges = np.zeros(n + 1, np.int64)
                edges[at] += 1
                np.subtract.at(edges, at + WINDOW, 1)
                stay = np.cumsum(edges[:-1]) == 0
                words = [w for w, s in zip(words, stay) if s]
                gone = n - len(words)
            counts.append(n)
            removed.append(gone)
            kept.append(b" ".join(words).decode("utf-8"))
        yield pa.record_batch([batch.column("key"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                              names=["key", "n_words", "n_removed", "kept"])


def remove_repeats(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each row of ``df``: ``key``, ``n_words``, ``n_removed`` and the ``kept`` words joined by single spaces. Keys are whole numbers."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    # Both joins need these columns and no others, so their exchanges of texts are one, which the planner reuses.
    known = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("x"))
    k, t = F.coalesce("key", F.lit(NO_KEY)).alias("k"), F.coalesce(F.xxhash64("x"), F.lit(0)).alias("t")
    docs = known.select("key", "x", _name(k, t).alias("r"))
    anchors = docs.select(k, t, "x", "r").mapInArrow(probe(buckets), PACKED).groupBy("bucket").applyInArrow(anchor(buckets), TARGETED)
    # Documents are named by 32 bits so far; ones that share a name get each other's anchors, which only widens the search.
    listed = anchors.groupBy("target").applyInArrow(collect("r"), ANCHORS).hint("shuffle_hash")
    near = docs.join(listed, "r").select(F.col("key"), k, t, "x", "found").drop("key")
    gone = near.mapInArrow(extend(buckets), PACKED).groupBy("bucket").applyInArrow(settle(buckets), TARGETED)
    repeats = gone.groupBy("target").applyInArrow(collect("k", "t"), REPEATS)
    named = repeats.groupBy(_name(F.col("k"), F.col("t")).alias("r")).agg(
        F.collect_list(F.struct("k", "t", "found")).alias("found")).hint("shuffle_hash")
    marked = docs.join(named, "r", "left").select("key", k, t, "x", "found")
    return marked.mapInArrow(cut, "key bigint, n_words bigint, n_removed bigint, kept string")


def _name(k: Column, t: Column) -> Column:
    """32 bits that name a document while anchors are sought."""
    return F.xxhash64(k, t).bitwiseAND(F.lit(0xFFFFFFFF))

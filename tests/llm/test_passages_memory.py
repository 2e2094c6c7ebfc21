"""What a task of op7_passages holds while it seeks anchors."""

import tracemalloc

import numpy as np
import pyarrow as pa

from snapstar.llm import passages


def _group(batches, hashes, seed):
    """Rows of one bucket; a tenth of a batch's hashes occur in other batches too, a tenth are blocks', and some occur twice in the batch."""
    pick = np.random.default_rng(seed)
    rows = []
    for _ in range(batches):
        drawn = np.unique(np.concatenate([pick.integers(0, 1 << 32, hashes, np.uint32), pick.integers(0, hashes, hashes // 10, np.uint32)]))
        many, once = drawn[::50], np.delete(drawn, np.s_[::50])
        block, names = pick.random(len(once)) < 0.1, pick.integers(0, 1 << 32, len(once), np.uint32)
        more = np.repeat(many, 2)
        rows.append((0, passages.pack(once, names, np.zeros(0, np.uint32), np.packbits(block), many, np.packbits(pick.random(len(many)) < 0.5),
                                      more, pick.integers(0, 1 << 32, len(more), np.uint32), np.zeros(0, np.uint32))))
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "payload"])


def test_anchors_are_hashes_of_blocks_that_occur_twice():
    group, seen, blocks, rows = _group(6, 500, 1), {}, set(), []
    for value in group.column("payload"):
        once, names, _, block, many, many_block, more, more_names, _ = passages.unpack(value.as_py())
        for hashes, n, flags in ((once, 1, block), (many, 2, many_block)):
            for h, b in zip(hashes.tolist(), np.unpackbits(flags, count=len(hashes))):
                seen[h] = seen.get(h, 0) + n
                blocks |= {h} if b else set()
        rows += [*zip(names.tolist(), once.tolist()), *zip(more_names.tolist(), more.tolist())]
    want = sorted((o, h) for o, h in rows if seen[h] > 1 and h in blocks)
    (owner,), value = passages._anchors(group)
    assert want and sorted(zip(owner.tolist(), value.tolist())) == want
    (owner,), value = passages._anchors(_group(1, 1, 2))
    assert len(owner) == len(value)


def test_seeking_anchors_holds_few_bytes_a_hash():
    group = _group(20, 20000, 3)
    tracemalloc.start()
    try:
        passages._anchors(group)
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 60 * 20 * 20000, held / (20 * 20000)

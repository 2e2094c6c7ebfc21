"""MinHash groups, clusters and prefix tries against plain versions, and their parts one by one."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstar.llm import clustering, minhash, prefix_trie
from snapstar.llm.common import prepare
from snapstar.llm.queries import QUERIES

from . import plain
from .test_contracts import FOLDER, SCHEMA, awkward_rows, documents, result, same

OP11 = ("doc_id", "n_shingles", "component_id", "kept")
OP12 = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
OP13 = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# MinHash

def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    for n in (4, 7, 30, 400, 9000):
        for share in (0.0, 0.05, 0.2, 0.6):
            a = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.sort(np.concatenate([a[int(n * share):], rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)]))
            exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert abs((minhash.sketch(a) == minhash.sketch(b)).mean() - exact) < 0.13
            assert minhash.similar(a, b) == (exact >= 0.8) == minhash.similar(b, a)


def test_sketch_is_the_least_value_of_every_bin():
    """The rounds written out one by one, up to the last."""
    rng = np.random.default_rng(4)
    for n in (1, 3, 50, 700):
        hashes = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        slots, size, i = [None] * 32, 32, 0
        while None in slots and i < 2 * size:
            with np.errstate(over="ignore"):
                drawn = [int(x) for x in minhash._drawn(hashes, np.array([i], np.uint64))[0]]
            fresh = {}
            for x in drawn:
                place = ((x >> 32) * size) >> 32 if i < size else i - size
                fresh[place] = min(fresh.get(place, x & 0xFFFFFFFF), x & 0xFFFFFFFF)
            for place, value in fresh.items():
                slots[place] = (i << 32) | value if slots[place] is None else slots[place]
            i += 1
        with np.errstate(over="ignore"):
            want = (minhash._mix(np.array(slots, np.uint64)) >> np.uint64(56)).astype(np.uint8)
        assert (minhash.sketch(hashes, size) == want).all()


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """One large group of near copies whose pairs link or not, pairs on the limit, short texts, and the awkward rows."""
    pick = random.Random(8)
    base = [f"w{pick.randrange(900)}" for _ in range(150)]
    rows = awkward_rows()
    for i in range(260):
        words = list(base)
        for _ in range(pick.randint(0, 16)):
            words[pick.randrange(150)] = f"x{pick.randrange(5000)}"
        rows.append((1000 + i, " ".join(words), "en", "hot", 1))
    for i in range(40):  # 4 of 5, 8 of 10 and just below
        words = [f"p{i}a{j}" for j in range(12)]
        rows += [(2000 + 4 * i, " ".join(words[:5]), "en", "a", 1), (2001 + 4 * i, " ".join(words[:6]), "en", "a", 1),
                 (2002 + 4 * i, " ".join(words[6:11]).upper(), "en", "a", 1), (2003 + 4 * i, " ".join(words[6:10]), "en", "a", 1)]
    rows += [(3000 + i, t, "en", "a", 1) for i, t in enumerate(["a", "A", " a\n", "a b", "A  B", "b a", "", None, "Ä", "ä"])]
    folder = str(tmp_path_factory.mktemp("copies"))
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("which", ["given", "copies"])
def test_op11(spark, copies, which):
    folder = FOLDER if which == "given" else copies
    same(result(spark, folder, "op11_minhash", *OP11), plain.op11([d[:2] for d in documents(spark, folder)]))


def test_op11_with_small_blocks(spark, copies, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    same(result(spark, copies, "op11_minhash", *OP11), plain.op11([d[:2] for d in documents(spark, copies)]))


# Clusters

def vectors(spark, path, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")
    extra = {c: F.lit("x") for c in ("id", "vector", "cluster", "distance", "place", "rows")}
    frame.withColumns(extra).repartition(3).write.parquet(f"{path}/embeddings.parquet")


def test_op12(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    same(result(spark, FOLDER, "op12_clusters", *OP12), plain.op12(given))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_op12_awkward(spark, tmp_path, kind):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(64).astype(np.float32) * 2).tolist(), 0) for i in range(150)]
    rows += [(200 + i, [float(i % 3)] * 64, 0) for i in range(60)]  # ties and repeated vectors
    rows += [(300, None, 0), (301, [1.0] * 63, 0), (302, [1.0] * 65, 0), (303, [float("nan")] * 64, 0), (304, [float("inf")] * 64, 0),
             (305, [None] + [1.0] * 63, 0), (306, [], 0), (None, [0.5] * 64, 0), (None, [0.25] * 64, 0), (7, [3.0] * 64, 0)]
    vectors(spark, tmp_path, rows, kind)
    same(result(spark, str(tmp_path), "op12_clusters", *OP12), plain.op12([r[:2] for r in rows]))


def test_op12_few_and_large(spark, tmp_path):
    rows = [(1, [1.0] * 64, 0), (2, [2.0] * 64, 0), (2, [2.0] * 64, 0), (3, [2.0**60] * 64, 0), (4, [-(2.0**60)] * 64, 0)]
    vectors(spark, tmp_path, rows)
    want = plain.op12([r[:2] for r in rows])
    assert all(w[2] == 0 for w in want)
    same(result(spark, str(tmp_path), "op12_clusters", *OP12), want)


def test_op12_beyond_a_long(spark):
    frame = spark.createDataFrame([(i, [float(x)] * 2) for i, x in enumerate([3e38, -3e38, 1, 1e250])], "i bigint, v array<double>")
    rows = clustering.cluster(frame, "i", "v", k=1, dimensions=2).collect()
    assert len(rows) == 4 and all(r.distance is None and r.inertia is None for r in rows)


def test_tree_finds_the_nearest_and_skips_nodes():
    rng = np.random.default_rng(6)
    for k, spread in ((1, 1), (8, 1), (200, 100)):
        middles = rng.integers(-5000, 5000, (k, 8))
        middles[k // 2] = middles[0]
        own = middles[rng.integers(0, k, 700)] + rng.integers(-spread, spread + 1, (700, 8))
        own[:50] = middles[rng.integers(0, k, 50)]
        chosen, distance, taken = clustering.nearest(own, middles, clustering.build_tree(middles.tolist()))
        exact = ((own[:, None] - middles[None]) ** 2).sum(2)
        assert (chosen == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert taken < 0.5 * 700 * 200


def test_limbs_give_the_sum_back():
    for total in (0, -1, 1, 1 << 60, -(1 << 60) - 1, 3 << 200, -(7 << 333) + 5):
        parts = clustering.limbs(total)
        assert sum(p << (clustering.LIMB * i) for i, p in enumerate(parts)) == total and all(-(1 << 61) < p < 1 << 61 for p in parts)


# Prefix tries

def conversations(spark, path, rows):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    extra = {c: F.lit("x") for c in ("name", "id", "turns", "lengths", "length", "key", "n", "h", "family")}
    frame.withColumns(extra).repartition(4).write.parquet(f"{path}/conversations.parquet")


def talk(seed=9):
    """Shared openings, equal conversations, a long one, gaps, nulls, repeated rows and negative ids."""
    pick, rows = random.Random(seed), []
    said = [(r, f"{r} says {i} \U0001f600") for i in range(4) for r in ("user", "bot")] + [(None, "x"), ("user", None), ("user", ""), ("a", "b:c"), ("a:b", "c")]
    for c in range(-205, 420):
        if c % 11:
            rows += [(c, t, *pick.choice(said)) for t in range(pick.choice([1, 2, 5, 7]))]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1100) for t in range(6)]
    rows += [(500, t, *pick.choice(said)) for t in range(300)] + [(501, t, "user", "again") for t in range(4)]
    rows += [(600, None, "user", "first"), (600, 3, "user", "third"), (600, 2, "user", "second"), (None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(700, 1, "bot", "twice"), (700, 1, "bot", "twice")]
    return rows


def test_op13(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(result(spark, FOLDER, "op13_prefixes", *OP13), plain.op13(given))


@pytest.mark.parametrize("limits", [(1 << 17, 1 << 14, 64), (40, 5, 2)])
def test_op13_awkward(spark, tmp_path, monkeypatch, limits):
    """Also with runs of a few conversations, so that most nodes are boundary nodes, merged over several levels."""
    for name, value in zip(("RUN_TURNS", "RUN_LISTS", "FAN"), limits):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = talk()
    conversations(spark, tmp_path, rows)
    same(result(spark, str(tmp_path), "op13_prefixes", *OP13), plain.op13(rows))


def test_runs_anywhere_merge_to_the_same_trie():
    """Cuts at every place, merged in groups of every size."""
    pick = random.Random(2)
    lists = sorted([pick.randrange(3) for _ in range(pick.randrange(6))] for _ in range(60))
    members = [(own, [len(str(t)) for t in own], i) for i, own in enumerate(lists)]

    def trie(cuts, fan):
        runs = [members[a:b] for a, b in zip([0, *cuts], [*cuts, len(members)]) if a < b]
        rows = []
        for number, run in enumerate(runs):
            held = []
            for own, lengths, i in run:
                if held and held[-1][0] == own:
                    held[-1][2].append(i)
                else:
                    held.append((own, lengths, [i]))
            rows += prefix_trie.run_nodes(held, number)
        named = [dict(zip(prefix_trie.COLUMNS, r)) for r in rows]
        done = [r for r in named if r["kind"] == prefix_trie.DONE]
        open_ = [r for r in named if r["kind"] == prefix_trie.BOUNDARY]
        level = 1
        while open_:
            top, step = level > len(runs), []
            for group in sorted({r["run"] // level for r in open_}):
                step += prefix_trie.merge_boundaries([dict(r) for r in open_ if r["run"] // level == group], top)
            step = [dict(zip(prefix_trie.COLUMNS, r)) for r in step]
            done += [r for r in step if r["kind"] == prefix_trie.DONE]
            open_, level = [r for r in step if r["kind"] == prefix_trie.BOUNDARY], level * fan
        return sorted((r["least"], r["depth"], r["n"], r["children"], r["leaves"], r["saved"]) for r in done)

    whole = trie([], 2)
    assert len(whole) == len({tuple(own[:d]) for own in lists for d in range(len(own) + 1)})
    for _ in range(30):
        cuts = sorted(pick.sample(range(1, 60), pick.randint(1, 20)))
        assert trie(cuts, pick.choice([2, 3, 5])) == whole


def test_median_order_visits_every_place_middle_first():
    for n in range(20):
        assert sorted(prefix_trie.median_order(n)) == list(range(n))
    assert next(prefix_trie.median_order(15)) == 7
    tree = prefix_trie.build_tree([([i], [1], [i]) for i in range(1000)])[0]
    depth, stack = 0, [(tree.next[0], 1)]
    while stack:
        at, d = stack.pop()
        if at >= 0:
            depth = max(depth, d)
            stack += [(tree.low[at], d + 1), (tree.high[at], d + 1)]
    assert depth <= 10


@pytest.mark.parametrize("name,table", [("op11_minhash", "documents"), ("op12_clusters", "embeddings"), ("op13_prefixes", "conversations")])
def test_only_nulls(spark, tmp_path, name, table):
    prepare(spark)
    schema = {"documents": SCHEMA, "embeddings": "vec_id bigint, embedding array<float>, label int",
              "conversations": "conv_id bigint, turn bigint, role string, text string"}[table]
    spark.createDataFrame([(None,) * len(schema.split(", "))] * 3, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == (3 if name == "op11_minhash" else 0)

"""Plain versions of the contracts over lists of rows, written independently of the operators."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text):
    return SPLIT.findall(text or "")


def op4_base(text):
    text, spans = text or "", []
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for order, (kind, pattern, good) in enumerate((
            ("assign", assign, lambda m: len(m[2]) >= 12), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
            ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16))):
        spans += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text) if good(m)]
    spans.sort()
    counts = Counter(s[3] for s in spans)
    joined = [f"{k}:{a}:{b}" for a, _, b, k in spans]
    return counts["assign"], counts["access"], counts["hex"], sha(",".join(joined).encode()), joined


def op7(rows):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, sha)."""
    first = {}
    listed = [(d, words(t)) for d, t in rows]
    key = lambda d: float("inf") if d is None else d
    for d, w in listed:
        for i in range(len(w) - 49):
            x = tuple(w[i:i + 50])
            first[x] = min(first.get(x, float("inf")), key(d))
    out = []
    for d, w in listed:
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i:i + 50])] < key(d):
                gone[i:i + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), sha(" ".join(kept).encode())))
    return out


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def op8(rows, radius=4):
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = defaultdict(lambda: float("inf"))
    for (d, _), f in zip(rows, prints):
        least[root(f)] = min(least[root(f)], float("inf") if d is None else d)
    return [(d, f"{f:016x}", None if least[root(f)] == float("inf") else least[root(f)]) for (d, _), f in zip(rows, prints)]


def op10_base(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


def op6_targets(sizes: dict):
    """Rounds of sharing by weight until nothing exceeds its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if target[s] + share * weight[s] >= 2 * sizes[s]}
        for s in full or free:
            more = 2 * sizes[s] - target[s] if full else share * weight[s]
            target[s] += more
            left -= more
        free -= full or free
    return target


def crc_mod(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def op11(rows):
    """rows: (doc_id, text) -> (doc_id, set size, component) by comparing all pairs."""
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((d, frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset((x,) for x in w)))
    group = list(range(len(sets)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = []
    for i, (d, s) in enumerate(sets):
        component = least.get(root(i)) if s else d
        out.append((d, len(s), component, d == component))
    return out


def op12(rows, k=8, rounds=10):
    """rows: (vec_id, vector) -> the contract's columns, with Python integers throughout."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (sha(f"3:{r[0]}".encode()), r[1]))
    order += sorted((r for r in kept if r[0] is None), key=lambda r: r[1])
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(column) // len(members[n]) for column in zip(*members[n])] if members[n] else c for n, c in enumerate(centroids)]
    told = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, n in told:
        per[n] += d
    digests = [sha(",".join(map(str, c)).encode()) for c in centroids]
    return [(i, n, d, per[n], sum(per.values()), digests[n]) for i, d, n in told]


def op13(rows):
    """rows: (conv_id, turn, role, text) -> one tuple per node; turns of equal number must be equal."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return [(m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
             sha(",".join(map(str, ends[p])).encode())) for p, m in members.items()]


def op1_shard(key, shards):
    """Rendezvous of one key over equal shards: the lowest score wins."""
    def score(shard):
        text = ("n" if key is None else f"k{key}") + f"/{shard}"
        return -math.log((int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 16**13)

    return min(range(shards), key=lambda s: (score(s), s))


def kneser_ney(texts, order):
    """Interpolated Kneser-Ney over characters, by nested counting: a function from text to bits and symbols."""
    def symbols(text):
        out = []
        for c in text:
            if c.isalpha():
                out.append(c.lower()[0])
            elif out and out[-1] != "#":
                out.append("#")
        return out + ["#"] if out and out[-1] != "#" else out

    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        line = ["#"] * (order - 1) + symbols(t) if symbols(t) else []
        for i in range(order - 1, len(line)):
            counts[order][tuple(line[i - order + 1: i + 1])] += 1
    seen = set(counts[order])
    for k in range(order - 1, 0, -1):
        for g in {g[order - k - 1:] for g in seen}:
            counts[k][g[1:]] += 1
    discounts, totals, types = [0.0] * (order + 1), [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
    for k in range(1, order + 1):
        ones, twos = (sum(n == x for n in counts[k].values()) for x in (1, 2))
        discounts[k] = ones / (ones + 2 * twos) if ones else 0.5
        for g, n in counts[k].items():
            totals[k][g[:-1]] += n
            types[k][g[:-1]] += 1

    def probability(gram, k):
        if not k:
            return 1 / 1114112
        own, lower = gram[-k:], probability(gram, k - 1)
        if not totals[k][own[:-1]]:
            return lower
        return (max(counts[k][own] - discounts[k], 0) + discounts[k] * types[k][own[:-1]] * lower) / totals[k][own[:-1]]

    def bits(text):
        line = ["#"] * (order - 1) + symbols(text)
        return sum(-math.log2(probability(tuple(line[i - order + 1: i + 1]), order)) for i in range(order - 1, len(line))), len(line) - order + 1

    return bits

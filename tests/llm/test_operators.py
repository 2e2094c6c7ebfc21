"""Cases that the small tables don't reach: every plan, hot keys and blocks, pieces of long texts, drawn examples."""

from __future__ import annotations

import ast
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapstar.llm import bpe, langid, mixing, neighbours, passages, quality, secret_scan, sharding, simhash
from snapstar.llm.components import components

from . import plain

# Sharding


def test_shares_follow_weights_and_growth_moves_rows_into_the_new_shard_only(spark):
    keys = spark.range(20_000).select(F.col("id").alias("k"))
    out = sharding.assign_shards(keys, "k", [1.0, 2.0, 5.0], [2.0]).toPandas()
    shares = out.shard.value_counts(normalize=True)
    assert [abs(shares[i] - w / 8) < 0.02 for i, w in enumerate((1, 2, 5))] == [True] * 3
    assert ((out.grown_shard == out.shard) | (out.grown_shard == 3)).all() and abs((out.grown_shard == 3).mean() - 0.2) < 0.02


def test_clashing_columns_and_bad_weights_are_refused(spark):
    with pytest.raises(ValueError):
        sharding.assign_shards(spark.range(1).withColumn("Shard", F.lit(1)), "id", [1.0])
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [1.0, 0.0])
    with pytest.raises(ValueError):
        mixing.plan_mix(spark.createDataFrame([(1, 2, "a", 3)], "id int, size int, source string, copies int"), "size", "source", "id")
    with pytest.raises(ValueError):
        mixing.emit(spark.createDataFrame([(1, 2, 3)], "id int, copies bigint, Copy int"))


def test_columns_named_like_those_of_the_near_duplicate_stage_come_back_unchanged(spark):
    names = ["doc_id", "text", "__row", "__twin", "__n", "row", "fp", "root", "doc_key", "first"]
    rows = [(i, f"one two three four five {i % 4}", *[f"{n}{i}" for n in names[2:]]) for i in range(12)]
    frame = spark.createDataFrame(rows + rows[:2], names)
    kept = simhash.keep_one(frame, "doc_id", "text")
    assert kept.columns == names and {tuple(r) for r in kept.collect()} <= set(rows) and kept.count() == kept.select("doc_id").distinct().count() > 0


# Neighbours


def test_small_blocks_and_cells_give_the_same_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 12))
    x[300:600] = x[300]  # a third of all vectors are equal, in one cell of several blocks
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>").repartition(5)
    got = defaultdict(list)
    for q, r, v, _ in sorted(map(tuple, neighbours.search(frame, "id", "v", lambda i: i % 30 == 0, k=5).collect())):
        got[q].append(v)
    hits = 0
    for q in range(0, 900, 30):
        scores = neighbours.inner_products(np.broadcast_to(x[q], x.shape), x)
        order = [i for i in np.lexsort((np.arange(900), -scores)) if i != q][:5]
        hits += len(set(order) & set(got[q]))
        if 300 <= q < 600:
            assert got[q] == order
    assert hits >= 0.9 * 5 * 30


def test_fewer_candidates_than_asked(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (None, [1.0, 1.0]), (3, [1.0])], "id bigint, v array<double>")
    assert [tuple(r) for r in neighbours.search(frame, "id", "v", lambda i: i == 0).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]


def test_chi_square_quantile():
    assert abs(neighbours.chi_square_quantile(0.95, 8) - 15.5073) < 1e-3


# Language


def test_models_are_distributions():
    texts = ["the cat sat on the mat", "a cat and a bat", "the end"]
    model = langid.fit_model(texts, 3)
    letters = sorted({c for t in texts for c in langid.symbols(t)})
    for text in ("the c", "xq z", "at"):
        codes = langid.padded(langid.symbols(text), 3)
        total = 0.0
        for letter, times in [*((x, 1) for x in letters), (0x4E00, sys.maxunicode + 1 - len(letters))]:  # a letter never seen stands for all
            now = np.append(codes[-3:-1], np.uint32(letter)).astype(np.uint32)
            hashes = langid.gram_hashes(now, 3)
            before = langid.gram_hashes(np.concatenate([[np.uint32(0)], now[:-1]]), 3)
            total += times * 2.0 ** float(model.log2(hashes, before)[0])
        assert abs(total - 1) < 1e-4


@pytest.mark.parametrize("order", [1, 2, 4])
def test_bits_equal_plain_kneser_ney(order):
    texts = ["The cat sat on the mat.", "A cat, and a bat!", "the end", "", "123", "Größe und Maß", "baaad bad baaa"] * 2 + ["mat", "bat cat"]
    model = langid.fit_model(texts, order)
    identifier, plain_bits = langid.Identifier({"xx": model}, {"xx": 0.0}, {"xx": 1.0}), plain.kneser_ney(texts, order)
    asked = ["the mat", "zebra quiz 漢字", "ÄÖ ßa", "  cat...sat  ", "a", "tttttt"]
    got, lengths = identifier.bits(asked)
    for text, bits, n in zip(asked, got[:, 0], lengths):
        want, symbols = plain_bits(text)
        assert n == symbols and abs(bits - want) < 1e-3 * max(want, 1)


def test_pieces_of_a_long_text_add_up(monkeypatch):
    model = langid.fit_model(["some words of one language and others"] * 3)
    identifier = langid.Identifier({"xx": model}, {"xx": 0.0}, {"xx": float("inf")})
    text = "words and others of no one " * 200
    whole = identifier.bits([text, "others"])
    monkeypatch.setattr(langid, "PIECE", 97)
    parts = identifier.bits([text, "others"])
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()
    assert identifier.predict(["", "123 !", "words"])[:2] == [("und", 0.0, None, 0, True)] * 2


@pytest.mark.parametrize("others", [0, 200])
def test_a_language_with_few_texts_keeps_its_documents(spark, others):
    pick = random.Random(7)
    words = {lang: ["".join(pick.choices(letters, k=pick.randint(2, 7))) for _ in range(60)] for lang, letters in (("aa", "abcdefgh"), ("xx", "pqrstuvw"))}

    def text(lang):
        return " ".join(pick.choices(words[lang], k=pick.randint(20, 120)))

    rows = [("xx", text("xx")) for _ in range(8)] + [("aa", text("aa")) for _ in range(others)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"), "text", "lang")
    assert sum(r[4] for r in model.predict([text("xx") for _ in range(200)])) <= 4
    assert all(r[4] for r in model.predict(["xqz jjk yyz " * 20])) or not others


def test_without_models_only_texts_without_letters_are_rejected(spark):
    model = langid.fit(spark.createDataFrame([(None, "words")], "lang string, text string"), "text", "lang")
    assert model.predict(["", "123 !", "words"]) == [("und", 0.0, None, 0, True)] * 2 + [("und", 0.0, None, 6, False)]


# Secrets


@pytest.mark.parametrize("text, found", [
    ('db_password = "Tr0ub4dor&3x"', ["Tr0ub4dor&3x"]),
    ('key = "k9Xp2mQ7vR4t"\nclientSecret = key', ["k9Xp2mQ7vR4t"]),
    ('a = "k9Xp2"\nb = a + "mQ7vR4tZ"\nauth_token: b', ["k9Xp2", "mQ7vR4tZ"]),
    ('password = "changeme"', []), ('token_type = "bearer-authorization"', []), ("password: a few plain words", []),
    ('password = "${DB_PASSWORD}"', []), ('{"private_key": "MIIEvQIBADANBgkq"}', ["MIIEvQIBADANBgkq"]), ("url: http://example.com/abcdefghijk", []),
])
def test_assignments_to_sensitive_names(text, found):
    assert [text[s.start:s.end] for s in secret_scan.scan(text) if s.kind == "named"] == found


def test_doubling_constants_stay_cheap():
    text = 'a = "x1"\n' + "a = a + a\n" * 200 + "password = a\n"
    assert all(len(a.value or "") <= secret_scan.MOST_CHARS and len(a.spans) <= secret_scan.MOST_TERMS for a in secret_scan.assignments(text))


LONG = "".join(random.Random(3).choices("abcdefghXYZ0123456789+/", k=5000))


@pytest.mark.parametrize("text, found", [
    (f'private_key = "{LONG}"', [LONG]), (f"private_key = {LONG}", [LONG]),
    ("signing_key = " + " + ".join(f'"{LONG[i:i + 40]}"' for i in range(0, 4000, 40)), [LONG[i:i + 40] for i in range(0, 4000, 40)]),
    (f'k = "{LONG}"; signing_key = k', [LONG]), (f'k = "{LONG}"\n' + "k = k + k\n" * 5000 + "pwd = k", [LONG]),
    ("a0 = '" + LONG[:9] + "'\n" + "".join(f'a{i + 1} = a{i} + "{LONG[i]}"\n' for i in range(3000)) + "access_key = a3000", [LONG[:9], *LONG[:3000]]),
    (f'{"n" * 200}.private_key = "{LONG[:40]}"', [LONG[:40]]),
    (f'k = "{LONG[:40]}"\nk = first + second\npwd = k', []),
    (f'private_key = "{"x" * 5000}"', []), (f'private_key = "${{{LONG}}}"', []), (f'private_key = "<{LONG}>"', []), (f'private_key = "{LONG} {LONG}"', []),
])
def test_values_of_any_length_are_scored(text, found):
    assert [text[s.start:s.end] for s in secret_scan.scan(text) if s.kind == "named"] == found


@pytest.mark.parametrize("text, found", [
    (f'private_key = "{LONG[:20]}" + suffix', [LONG[:20]]), (f'private_key = prefix + "{LONG[:20]}"', [LONG[:20]]),
    (f'private_key = "{LONG[:5]}" + "{LONG[5:20]}" + suffix', [LONG[:5], LONG[5:20]]),
    (f'private_key = "two words" + "{LONG[:20]}" + suffix', [LONG[:20]]),
    (f'k = "{LONG[:20]}" + x\nk = y + k\nsigning_key = k', [LONG[:20]]), (f'k = "{LONG[:20]}"\npwd = k + x', [LONG[:20]]),
    (f'label = "{LONG[:20]}" + x', []), ("private_key = first_half_Of_1 + second_half_Of_2", []), ('private_key = "short" + suffix', []),
    (f'k = "{LONG[:20]}"\n' + "k = k + k + x\n" * 5000 + "pwd = k", [LONG[:20]]),
])
def test_literals_next_to_unknown_names_are_scored(text, found):
    assert [text[s.start:s.end] for s in secret_scan.scan(text) if s.kind == "named"] == found


KEY = "Ab3dEf6hIj9lMn2pQr5t"
HALF, REST = KEY[:10], KEY[10:]


@pytest.mark.parametrize("text, found", [
    *((f"signing_key = {p}{q}{KEY}{q}", [KEY]) for p in ("", "b", "f", "r", "u", "rb", "Br") for q in ('"', "'", '"""', "'''")),
    (f"password = b'{KEY}'", [KEY]), (f'api_key: str = "{KEY}"', [KEY]), (f'cfg["password"] = "{KEY}"', [KEY]), (f'token = f"{KEY}"', [KEY]),
    (f"secret = `{KEY}`", [KEY]), (f'signing_key: str = "{KEY}"', [KEY]), (f'signing_key: Optional[str] = "{KEY}"', [KEY]),
    (f'signing_key: str | None = "{KEY}"', [KEY]), (f'const signing_key: string = `{KEY}`;', [KEY]), (f'config["signing_key"] = "{KEY}"', [KEY]),
    (f"conf['db']['signing_key'] = '{KEY}'", [KEY]), (f'signing_key = (\n    "{KEY}"\n)', [KEY]), (f'signing_key = (\n  "{HALF}"\n  "{REST}"\n)', [HALF, REST]),
    (f'signing_key = "{HALF}" "{REST}"', [HALF, REST]), (f"$signing_key = '{HALF}' . '{REST}';", [HALF, REST]), (f'signing_key = "{HALF}" \\\n  "{REST}"', [HALF, REST]),
    (f'signing_key = "{HALF}" +\n  "{REST}"', [HALF, REST]), (f'signing_key = "{HALF}"\nsigning_key += "{REST}"', [HALF, REST]),
    (f'signing_key = """\n{KEY}\n"""', []), (f"signing_key: |\n  {KEY}\n  {KEY[::-1]}\nother: x", [KEY, KEY[::-1]]), (f"a:\n  signing_key: >-\n    {KEY}\n  b: {KEY}", [KEY]),
    (f'{{"signing": {{"key": "{KEY}"}}}}', [KEY]), (f'{{"signing": {{"key": {{"value": "{KEY}"}}}}}}', []), (f'{{"signing_key": {{"value": "{KEY}", "id": "{KEY}"}}}}', [KEY]),
    (f'{{"signing": {{}}, "key": "{KEY}"}}', []), (f"signing:\n  key: {KEY}\nkey: {KEY[::-1]}", [KEY]), (f"[signing]\nkey = {KEY}\n[other]\nkey = {KEY}", [KEY]),
    (f'name, signing_key = "{KEY[::-1]}", "{KEY}"', [KEY]), (f'signing_key, name = "{KEY}", "{KEY[::-1]}"', [KEY]),
    (f"<signing_key>{KEY}</signing_key>", [KEY]), (f"<c:signing-key a='b'>\n  {KEY}\n</c:signing-key>", [KEY]), (f"<name>{KEY}</name>", []),
    (f'signing_keys = ["{KEY}", "{KEY[::-1]}"]', []), (f'credentials = ["{KEY}", "{KEY[::-1]}"]', [KEY, KEY[::-1]]), (f'signing_key == "{KEY}"', []),
])
def test_syntaxes_of_assignments(text, found):
    assert [text[s.start:s.end] for s in secret_scan.scan(text) if s.kind == "named"] == found


def test_python_sources_as_their_own_parser_reads_them():
    """Random programs of assignments, against the syntax tree that Python makes of them."""
    pick = random.Random(13)
    names = ["signing_key", "pwd", "label", "a", "b", "private_key", "title"]

    def literal():
        body = "".join(pick.choices("abcXYZ0123", k=pick.randint(3, 14)))
        return pick.choice(["", "", "r", "u"]) + pick.choice([f'"{body}"', f"'{body}'", f'"""{body}"""'])

    def value():
        return pick.choice([literal, literal, lambda: f"{literal()} {literal()}", lambda: f"{literal()} + {literal()}", lambda: f"(\n    {literal()}\n    {literal()})",
                            lambda: pick.choice(seen), lambda: f"{pick.choice(seen)} + {literal()}", lambda: f"unknown + {literal()}"][: 8 if seen else 5])()

    for _ in range(400):
        lines, seen = [], []  # a bare word that nothing has bound is a token of its own, not a name
        for _ in range(pick.randint(1, 6)):
            target = pick.choice(names)
            lines.append(pick.choice([f"{target} = {value()}", f"{target}: str = {value()}", f'd["{target}"] = {value()}', f"{target} += {literal()}"]))
            seen.append(target)
        source, known, want = "\n".join(lines), {}, set()
        for statement in ast.parse(source).body:
            node = statement.targets[0] if isinstance(statement, ast.Assign) else statement.target
            target = node.id if isinstance(node, ast.Name) else node.slice.value

            def bound(name):
                """A name's parts; a sum with unknown parts doesn't grow together with what comes next to it."""
                parts = known.get(name, [None])
                return [None, *parts, None] if None in parts else parts

            def runs(e):
                """Lists of neighbouring literals' texts, and None for what isn't known."""
                if isinstance(e, ast.BinOp):
                    return runs(e.left) + runs(e.right)
                return [e.value] if isinstance(e, ast.Constant) else bound(e.id)

            parts = (bound(target) if isinstance(statement, ast.AugAssign) else []) + runs(statement.value)
            known[target] = parts
            joined = [""]
            for part in parts:
                joined = [*joined, ""] if part is None else [*joined[:-1], joined[-1] + part]
            for whole in joined:
                if whole and secret_scan.name_score(target) * secret_scan.literal_score(whole) >= secret_scan.THRESHOLD:
                    want.add(whole)
        got = {source[s.start:s.end] for s in secret_scan.scan(source) if s.kind == "named"}
        assert all(any(piece in whole for whole in want) for piece in got) and bool(want) == bool(got), source
        assert all(any(piece in whole for piece in got) for whole in want), source


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("tokenTOKEN secrtapi_ky=:\"'\n0123456789abcdefAKIA+/."), max_size=120))
def test_base_spans_stay(text):
    counts = Counter(s.kind for s in secret_scan.scan(text))
    *want, _, spans = plain.op4_base(text)
    assert [counts[k] for k in secret_scan.BASE] == want
    assert [str(s) for s in secret_scan.scan(text) if s.kind != "named"] == spans
    assert "" == secret_scan.redact(text, [secret_scan.Span("named", 0, len(text))], "")


# Tokens


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(st.sampled_from("aAéÉ 'stlldrevem1２½漢Σςß\ń<|endoftext|>"), max_size=60))
def test_ids_equal_the_library(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    if not CODERS:
        CODERS.extend((bpe.WordBpe(path), Tokenizer.from_file(path)))
    ours, theirs = CODERS
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text).tolist() == ids
    assert ours.decode(ours.encode(text)) == theirs.decode(ids, skip_special_tokens=False)


CODERS: list = []

# Mixing


def test_emitted_rows_follow_the_plan_and_sources_come_near_their_targets(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") < 3000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"), (F.col("id") % 50).alias("size"))
    plan = mixing.plan_mix(rows, "size", "source", "id")
    per = plan.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.1 * r.target for r in per)
    emitted = Counter(r.id for r in mixing.emit(plan).select("id").collect())
    assert emitted == Counter({r.id: r.copies for r in plan.collect() if r.copies})


# Passages


def test_rows_of_a_batch_stay_in_proportion_to_its_text():
    """The bytes that a batch sends, by the number of buckets, which grows with the input."""
    pick = random.Random(7)
    vocabulary = ["".join(pick.choices("abcdefgh", k=pick.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(pick.choices(vocabulary, k=pick.randint(60, 600))) for _ in range(400)]
    texts += [f"{t} {texts[0]}" for t in texts[:40]]
    size, n = sum(map(len, texts)), len(texts)
    ids, marks = pa.array(range(n), pa.int64()), pa.array([pick.getrandbits(60) for _ in range(n)], pa.int64())

    def sent(step, last, kind):
        batch = pa.record_batch([ids, marks, pa.array(texts), pa.array(last, kind)], names=["k", "t", "x", "y"])
        return sum(len(v.as_py()) for out in step([batch]) for v in out.column("payload")) / size

    named = [pick.getrandbits(32) for _ in texts]
    probed = [sent(passages.probe(b), named, pa.int64()) for b in (7, 300, 2000)]
    assert max(probed) <= 1.7 and probed[2] <= 1.2 * probed[1] + 0.2
    every = [(passages.anchors_of()(passages.WordHashes().of(t)) & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for t in texts]
    assert max(sent(passages.extend(b), every, pa.binary()) for b in (7, 300, 2000)) <= 5


def test_packing_is_exact():
    arrays = (np.arange(5, dtype=np.uint64), np.zeros(0, np.uint32), np.array([1, 300, 70_000], np.uint32))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, passages.unpack(passages.pack(*arrays))))


def test_rolling_hashes_tell_windows_apart():
    words = np.random.default_rng(0).integers(0, 1 << 62, 400).astype(np.uint64)
    hashes = passages.anchors_of()(np.concatenate([words, words[:100]]))
    assert len(set(hashes.tolist())) == 400 and (hashes[400:] == hashes[:76]).all()


@pytest.mark.parametrize("batch, bucket", [(1 << 20, 16 << 20), (500, 2000)])
def test_repeats_across_batches_and_buckets(spark, monkeypatch, batch, bucket):
    monkeypatch.setattr(passages, "BUCKET_BYTES", bucket)
    pick = random.Random(batch)
    vocabulary = [f"w{i}" for i in range(300)]
    shared = [[pick.choice(vocabulary) for _ in range(n)] for n in (49, 50, 51, 130)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(pick.randint(0, 4)):
            words += [pick.choice(vocabulary) for _ in range(pick.randint(0, 60))] + pick.choice(shared)[pick.randint(0, 3):]
        rows.append((pick.randint(0, 50) if i % 7 else None, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = passages.remove_repeats(frame, "doc_id", "text").select("key", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert Counter(map(tuple, got)) == Counter(plain.op7(rows))


# SimHash


def near_fingerprints(rng, groups, size):
    out = []
    for _ in range(groups):
        value = int(rng.integers(0, 1 << 63))
        for _ in range(size):
            out.append(value)
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                value ^= 1 << int(b)
    return sorted(set(out))


def linked(values, radius):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {frozenset(w for w in values if root(w) == r) for r in {root(v) for v in values}}


@pytest.mark.parametrize("thresholds", [(2, 1), (1, 1, 0), (2, 0, 0), (0,) * 5, (2, 1, -1), (-1, 1, 1, 0), None])
@pytest.mark.parametrize("block", [8192, 8])
def test_every_plan_finds_every_link(spark, monkeypatch, thresholds, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "RUN", 16)
    rng = np.random.default_rng(7)
    signed = [v - (1 << 64) if v >> 63 else v for v in near_fingerprints(rng, 25, 8)]
    base = int(rng.integers(0, 1 << 62))  # one large group whose members share most keys
    signed = sorted({*signed, *(base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (60, 2)) if a != b)})
    bits = np.unpackbits(np.array(signed, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    if thresholds is None:
        parts = simhash.plan_parts(np.array(signed), len(signed))
        assert sum(p.threshold + 1 for p in parts) >= 5 and sorted(b for p in parts for b in p.bits) == list(range(64))
    else:
        parts = [simhash.Part(g, t) for g, t in zip(simhash.bit_groups(bits, len(thresholds)), thresholds)]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(4)
    member = {r.node: r.root for r in components(simhash.links(simhash.probes(fps, parts), parts, 4)).collect()}
    groups = defaultdict(set)
    for v in signed:
        groups[member.get(v, v)].add(v)
    assert set(map(frozenset, groups.values())) == linked(signed, 4)


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(2)
    costs = [{t: float(rng.random()) for t in (-1, 0, 1, 2)} for _ in range(4)]
    best = min(sum(c[t] for c, t in zip(costs, ts)) for ts in np.ndindex(4, 4, 4, 4) for ts in [[t - 1 for t in ts]] if sum(t + 1 for t in ts) >= 5)
    cost, chosen = simhash.allocate(costs, 4)
    assert abs(cost - best) < 1e-12 and sum(t + 1 for t in chosen) >= 5


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (5, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 50)}}


# Quality


def test_cells_hold_their_values(spark):
    rows = [r for r in spark.range(5000).select("id", quality.cell(F.col("id")).alias("c")).collect()]
    assert all(r.c <= r.id and (r.id - r.c) * 16 <= max(r.id, 1) for r in rows) and all(r.c == r.id for r in rows[:32])


def test_thresholds_adapt_to_groups_and_merge_small_ones(spark):
    rng = random.Random(1)

    def text(length):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(length)) for _ in range(40))

    rows = [(i, text(4), "en", "a") for i in range(200)] + [(1000 + i, text(12), "xx", "b") for i in range(200)]
    rows += [(2000, text(14), "en", "a"), (2001, text(14), "xx", "b"), (2002, text(14), "en", "tiny"), (2003, text(5), None, None), (2004, "short", "en", "a")]
    got = {r.doc_id: r.kept for r in quality.apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), "text", "lang", "source", ["doc_id"]).collect()}
    assert (got[2000], got[2001], got[2002], got[2003], got[2004]) == (False, True, False, True, False)
    assert all(got[i] for i in range(200)) and all(got[1000 + i] for i in range(200))

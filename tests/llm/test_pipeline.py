"""The pipeline stage by stage against plain versions, on given and on awkward rows."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from snapstar.llm.queries import QUERIES

from . import plain
from .test_contracts import FOLDER, SCHEMA, awkward, awkward_rows, empty, folder  # noqa: F401


@pytest.fixture
def stages(spark, folder, tmp_path):  # noqa: F811
    """The rows before the first and after each stage."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], folder).write.parquet(f"{tmp_path}/{name}")
        out.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return out


def test_stages(spark, folder, stages):  # noqa: F811
    columns = stages[0].columns
    assert all(s.columns == columns for s in stages[:-1])
    docs, spoken, single, clean, mixed, coded = ([r.asDict() for r in s.collect()] for s in stages)

    def as_is(r):
        return tuple(r[c] for c in columns)

    # 1. What the query of the same operator rejects goes, and nothing else.
    rejected = Counter(r[0] for r in QUERIES["op3_language"](spark, folder).filter("rejected").select("doc_id").collect())
    gone = Counter(map(as_is, docs)) - Counter(map(as_is, spoken))
    assert Counter(r[0] for r in gone.elements()) == rejected and len(docs) - len(spoken) == sum(rejected.values())
    assert all(any(c.isalpha() for c in r["text"]) for r in spoken)
    # 2. One row of each group: its least doc_id.
    groups = {g for *_, g in plain.op8([(r["doc_id"], r["text"]) for r in spoken])}
    assert Counter(r["doc_id"] for r in single) == Counter(dict.fromkeys(groups, 1))
    assert not Counter(map(as_is, single)) - Counter(map(as_is, spoken))
    # 3. Every row stays; no base secret does; rows without secrets stay as they are.
    before = {r["doc_id"]: r for r in single}
    assert len(clean) == len(single)
    for r in clean:
        old = before[r["doc_id"]]
        assert sum(plain.op4_base(r["text"])[:3]) == 0
        if not old["text"] or "[SECRET]" not in r["text"]:
            assert as_is(r) == as_is(old)
        else:
            pieces = r["text"].split("[SECRET]")
            assert old["text"].startswith(pieces[0]) and old["text"].endswith(pieces[-1]) and r["n_chars"] in (None, len(r["text"]))
    # 4. Each document as often as its source's rate allows.
    sizes = Counter()
    for r in clean:
        sizes[r["source"]] += len(plain.words(r["text"]))
    targets, copies = plain.op6_targets(sizes), Counter(map(as_is, mixed))
    assert not set(copies) - set(map(as_is, clean))
    for r in clean:
        rate = targets[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert int(rate + 1e-9) <= copies[as_is(r)] <= np.ceil(rate - 1e-9)
    # 5. The library's ids, for every copy.
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r["doc_id"], tuple(coder.encode(r["text"] or "", add_special_tokens=False).ids)) for r in mixed)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in coded) == want
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded"] == coder.decode(r["ids"], skip_special_tokens=False) for r in coded)


def test_run_equals_its_stages_on_given_rows(spark, tmp_path):
    got = corpus_pipeline.run(spark, FOLDER)
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, again.collect())) and got.count()


def test_each_stage_on_an_empty_table(spark, empty):  # noqa: F811
    docs = spark.read.parquet(f"{empty}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, empty).count() == 0

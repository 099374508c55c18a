import re
from collections import Counter

import numpy as np
import pytest
from test_packing import by_hand as pieces_of
from test_packing import packed

import corpus_pipeline as pipeline
from chuvisco.llm.secrets import find_secrets
from test_jaccard import shingles


def components(sets, percent):
    top = list(range(len(sets)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                top[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


def without_passages(texts, width):
    held = {d: t.encode() for d, t in texts.items()}
    times = Counter(t[i : i + width] for t in held.values() for i in range(len(t) - width + 1))
    out = {}
    for d, t in held.items():
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if times[t[i : i + width]] > 1:
                gone[i : i + width] = True
        out[d] = bytes(np.frombuffer(t, np.uint8)[~gone]).decode("utf-8", "ignore")
    return out


def masked(text):
    spans = find_secrets(text, {"assign", "access", "hex", "escaped", "unicode", "coded"}, 64 << 20)[1]
    hit = np.zeros(len(text) + 1, bool)
    begins = set()
    until = -1
    for a, b in sorted((a, b) for _, a, b in spans):
        hit[a:b] = True
        if a > until:
            begins.add(a)
        until = max(until, b)
    return "".join(("[SECRET]" if i in begins else "") + ("" if hit[i] else c) for i, c in enumerate(text))


def test_stages_in_the_order_asked_for():
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "ngram_jaccard", "suffix_array_dedup", "secret_scans", "best_fit_packing"]


def test_each_stage_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "12 34", "en", "src0", 5), (10**6 + 1, None, "en", "src0", 0)], docs.schema)
    secret = spark.createDataFrame([(10**6 + 2, "Here is password = hunter22 and a key.", "en", "src0", 38)], docs.schema)
    docs = docs.union(extra).union(secret)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        before = docs
        docs = pipeline.stored(stage(spark, docs, sf_dir))
        if name == "best_fit_packing":
            found = packed(docs)
            assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces_of(list(texts.items()))
            continue
        assert docs.schema == before.schema
        if name == "language_id":
            texts = {d: t for d, t in texts.items() if t and re.search(r"[^\W\d_]", t)}
        elif name == "ngram_jaccard":
            ids = list(texts)
            groups = components([shingles(texts[d], 5) for d in ids], 80)
            best = {}
            for d, g in zip(ids, groups):
                best[g] = min(best.get(g, d), d)
            texts = {d: texts[d] for d in best.values()}
        elif name == "suffix_array_dedup":
            texts = without_passages(texts, pipeline.PASSAGE)
        else:
            texts = {d: masked(t) for d, t in texts.items()}
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == texts and len(rows) == len(texts)
        assert all(r.n_chars == len(r.text) for r in rows)


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    rows = packed(pipeline.run(spark, sf_dir))
    assert {r.doc_id for r in rows} <= {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("stage", [name for name, _ in pipeline.STAGES])
def test_stages_take_empty_tables(spark, sf_dir, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert dict(pipeline.STAGES)[stage](spark, docs, sf_dir).count() == 0

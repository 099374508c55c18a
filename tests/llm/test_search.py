import math

import numpy as np
import pytest

import chuvisco.llm.search as search
from chuvisco.llm.queries import op5_exact_top_k
from chuvisco.llm.search import BallTree, top_products


def by_hand(rows, every, k, scale=1024):
    whole = {}
    for key, v in rows:
        if key is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault(key, set()).add(tuple(math.floor(scale * x) for x in v))
    out = []
    for q in sorted(whole):
        if q % every == 0:
            scores = {
                c: max(p)
                for c, held in whole.items()
                if c != q and (p := [sum(x * y for x, y in zip(a, b)) for a in whole[q] for b in held if len(a) == len(b)])
            }
            ranked = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
            out += [(q, i + 1, c, s) for i, (c, s) in enumerate(ranked)]
    return out


def as_rows(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_trees_find_what_a_full_scan_finds_and_look_at_less():
    rng = np.random.default_rng(1)
    centers = rng.integers(-3000, 3000, (20, 6))
    vectors = (centers[rng.integers(0, 20, 2000)] + rng.integers(-40, 40, (2000, 6))).astype(np.int64)
    tree, looked = BallTree.build(np.arange(2000), vectors), 0
    for q in range(0, 2000, 40):
        best = []
        (reach,) = tree.reach(vectors[q : q + 1].astype(float))
        looked += tree.search(vectors[q], q, best, 10, reach)
        scores = vectors @ vectors[q]
        wanted = sorted(((int(s), -i) for i, s in enumerate(scores) if i != q), reverse=True)[:10]
        assert sorted(best, reverse=True) == wanted
    assert looked < 0.5 * 50 * 2000


@pytest.mark.parametrize("small", [False, True])
def test_rows_equal_brute_force(spark, monkeypatch, small):
    if small:
        for name, n in (("SHARD", 7), ("LEAF", 2), ("ASKED", 11), ("FIRST", 2), ("GROWTH", 2)):
            monkeypatch.setattr(search, name, n)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).round(2).tolist()) for i in range(120)]
    rows += [(200 + i, [0.5, -0.25, 0.0, 1.0, 2.0]) for i in range(30)]  # ties
    rows += [(300, None), (301, []), (305, [1.0, None, 1.0, 1.0, 1.0]), (310, [float("nan")] * 5), (315, [float("inf")] * 5)]
    rows += [(320, [1.0, 2.0]), (325, [2.0, 1.0]), (None, [1.0] * 5), (330, [1e-9] * 5), (330, [1e-9] * 5), (335, [0.0] * 5)]
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<double>, dim int, score int")
    assert as_rows(top_products(df, every=5, k=4)) == by_hand(rows, 5, 4)


def test_several_vectors_of_a_key(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(1, 40)] + [(50, [9.0, x / 8]) for x in range(30)] + [(100, [1.0, 1.0]), (100, [1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert as_rows(top_products(df, every=50, k=5)) == by_hand(rows, 50, 5)


def test_a_floor_lets_only_better_finds_through():
    vectors = np.arange(1, 101, dtype=np.int64)[:, None]
    tree = BallTree.build(np.arange(100), vectors, 4)
    (reach,) = tree.reach(np.array([[2.0]]))
    best = []
    looked = tree.search(np.array([2]), 99, best, 10, reach, (190, -94))
    assert sorted(best) == [(192, -95), (194, -96), (196, -97), (198, -98)] and looked < 30
    assert [sum(1 for _ in search._waves(n)) for n in (0, 1, 8, 9, 32, 33)] == [0, 1, 1, 2, 2, 3]


def test_rounds_hold_bounded_queries():
    rounds = search._rounds({2: 10, 64: 200_000, 1 << 23: 3})
    assert [p for r in rounds for p in r if p[0] == 64] == [(64, i, 4) for i in range(4)]
    assert all(sum(d << 16 >= search.SENT for d, _, _ in r) <= 2 for r in rounds) and len(rounds) >= 6


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(100, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert as_rows(top_products(df)) == [(100, 1, 1, 1024 * 2048)]
    assert as_rows(top_products(df.limit(0))) == []


def test_query_over_the_embeddings(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert as_rows(op5_exact_top_k(spark, sf_dir)) == by_hand(rows, 100, 10)

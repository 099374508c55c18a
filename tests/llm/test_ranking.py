import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chuvisco.llm import ranking
from chuvisco.llm.ranking import BallTree, rank_documents, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, most=10):
    counts = [(key, Counter(split(text))) for key, text in docs]
    counts = [(key, c) for key, c in counts if c]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for key, c in counts:
            m = 10 + 90 * c.total() * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(split(text)) if t in c
            )
            if score > 0 and key is not None:
                scores.append((-score, key))
        out += [(item, i + 1, key, -score) for i, (score, key) in enumerate(sorted(scores)[:most])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "t", 2) for r in docs], "doc_id long, text string, n long, terms string, item int")
    return d, spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, doc_id long, term string")


def words(rng, count, size):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % size}" for _ in range(count))


ODD_DOCS = [
    (1, None), (2, ""), (3, " \t--"), (4, "É é E e"), (5, "É"), (None, "storm storm"), (6, "storm"), (6, "storm"), (6, "storm and rain"),
    (7, "Storm_storm\x00STORM"), (8, "漢字 é ٣ 10%"), (9, "x" * 5000), (10, "storm " * 5000), (-5, "storm"),
]
ODD_ITEMS = [(1, "storm"), (1, "storm"), (1, "rain"), (2, None), (3, ""), (4, "--"), (None, "É storm"), (5, "漢字 10"), (6, "unheard"), (7, "x" * 5000)]


@pytest.mark.parametrize("block_terms", [3, 1 << 14])
def test_rows_equal_brute_force(spark, block_terms):
    rng = random.Random(1)
    docs = ODD_DOCS + [(100 + i, words(rng, rng.choice([1, 5, 60]), 300)) for i in range(1500)]
    docs += [(5000 + i, docs[20][1]) for i in range(40)]  # copies: ties
    items = ODD_ITEMS + [(100 + i, words(rng, 12, 300)) for i in range(6)]
    if block_terms == 3:
        items = items[:12]
    assert rows_of(rank_documents(*frames(spark, docs, items), block_terms=block_terms)) == by_hand(docs, items)


@pytest.mark.parametrize("docs, items", [([], ODD_ITEMS), (ODD_DOCS, []), ([], []), ([(1, None)], ODD_ITEMS), (ODD_DOCS, [(1, None)])])
def test_empty_tables(spark, docs, items):
    assert rows_of(rank_documents(*frames(spark, docs, items))) == []


def test_terms_across_pieces(monkeypatch):
    monkeypatch.setattr(ranking, "PIECE", 5)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab É-\n") for _ in range(rng.randrange(40)))
        assert [t.decode() for piece in terms_of(text.encode()) for t in piece] == split(text)


def vectors(rng, count, width, most):
    rows = [np.sort(rng.choice(width, rng.integers(1, most), replace=False)) for _ in range(count)]
    terms = np.concatenate(rows)
    starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    return starts, terms, rng.integers(1, 1_000_000, len(terms))


def dense(starts, terms, values, width):
    rows = np.zeros((len(starts) - 1, width))
    rows[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), terms] = values
    return rows


def test_no_bound_is_too_low():
    rng = np.random.default_rng(3)
    for count in (1, 2, 33, 700):
        given = vectors(rng, count, 60, 20)
        tree, rows = BallTree(*given, leaf=4), dense(*given, 60)
        for _ in range(20):
            weights = rng.integers(0, 20000, 60) * (rng.random(60) < 0.3)
            products = rows @ weights
            for node, (*_, first, last) in enumerate(tree.nodes):
                assert tree.bound(node, weights) >= products[tree.order[first:last]].max()


def test_equal_vectors_have_small_balls():
    starts, terms, values = np.arange(0, 401, 4), np.tile([1, 5, 9, 11], 100), np.tile([999_999, 3, 500_000, 7], 100)
    assert BallTree(starts, terms, values).nodes[0][2] < 1e-3


def test_subtrees_are_left_out():
    """Documents of separate topics: a search leaves half of them out and finds what a look at all finds."""
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(20, 8, replace=False)) + 20 * (i % 40) for i in range(4000)]
    starts, terms = np.arange(0, 32001, 8), np.concatenate(rows)
    values = rng.integers(400_000, 600_000, 32000)
    tree, weights = BallTree(starts, terms, values), np.zeros(800, np.int64)
    weights[rng.choice(20, 10, replace=False) + 60] = 1000
    best = []
    looked = tree.search(weights, np.arange(4000), best, 10)
    scores = dense(starts, terms, values, 800) @ weights
    assert sorted(best, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(scores)), reverse=True)[:10]
    assert looked < 2100

import random

import numpy as np
import pytest

import chuvisco.llm.jaccard as jaccard
import chuvisco.llm.shared as shared
from chuvisco.llm.jaccard import Bands, near_duplicates, shingle_sets, sketch, without_near_duplicates
from chuvisco.llm.links import components
from chuvisco.llm.queries import op8_ngram_jaccard_join

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return "".join(" " if c in SPACE else c for c in lower).split(" ")


def shingles(text, words):
    held = [w for w in words_of(text) if w]
    if not held:
        return set()
    return {tuple(held[i : i + words]) for i in range(max(1, len(held) - words + 1))}


def by_hand(texts, words, percent):
    sets = [shingles(t, words) for _, t in texts]
    top = list(range(len(texts)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                top[root(i)] = root(j)
    smallest = {}
    for i, (doc, _) in enumerate(texts):
        r = root(i)
        known = smallest.get(r)
        smallest[r] = doc if known is None else known if doc is None else min(known, doc)
    return sorted(repr((doc, len(s), smallest[root(i)] if s else doc)) for i, ((doc, _), s) in enumerate(zip(texts, sets)))


def as_rows(df):
    return sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def test_sets_count_distinct_shingles():
    texts = ["A b c d", "a  B\tc", "x", "", " \n", "a b", "a b c a b c a", "é É e", "ab c d" * 50, "a\x1cb c"]
    held = [t.encode() for t in texts]
    sets = list(shingle_sets(np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]), 3))
    assert [len(s) for s in sets] == [len(shingles(t, 3)) for t in texts]
    assert set(sets[1]) < set(sets[0]) and set(sets[1]) < set(sets[6])


@pytest.mark.parametrize("n", range(8))
def test_few_words_in_all_texts_together(n):
    held = [b"a " * n, b"", b"b"]
    for words in (1, 3, 5):
        sets = list(shingle_sets(np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]), words))
        assert [len(s) for s in sets] == [min(n, 1), 0, 1]


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("n", [1, 2, 5, 10, 19, 20, 40, 100, 333, 1000, 6000])
def test_pairs_at_the_threshold_share_a_key_and_sketches_stay_below(percent, n):
    rng, bands = np.random.default_rng(n), Bands(percent)
    for _ in range(30):
        union = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        lost = n * (100 - percent) // 100
        cut = int(rng.integers(0, lost + 1))
        a, b = np.unique(union[cut:]), np.unique(union[: n - (lost - cut)])
        assert np.intersect1d(bands.keys(a), bands.keys(b)).size
        one, other = (np.frombuffer(sketch(x), np.uint64) for x in (a, b))
        assert np.bitwise_count(one ^ other).sum() <= lost


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 480)]
    top = {i: i for e in links for i in e}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in links:
        ra, rb = sorted((root(a), root(b)))
        top[rb] = ra
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: root(i) for i in {i for a, b in links if a != b for i in (a, b)}}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [rng.choice("abcdefgh") * rng.randint(1, 3) + str(i) for i in range(500)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    texts, boiler = [], text(30)
    for g in range(12):
        base = text(rng.choice([4, 12, 40, 120, 500]))
        for _ in range(rng.randint(1, 8)):
            copy = base.copy()
            for _ in range(rng.randint(0, max(1, len(base) // 50))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
        texts.append(" ".join(boiler + text(rng.randint(1, 60))))
    chain = text(150)
    for _ in range(15):  # each like the one before, the ends not like each other
        chain = chain.copy()
        chain[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(chain))
    rows = list(enumerate(texts)) + [(900, "A b"), (901, "a  B"), (902, ""), (903, None), (None, "a b"), (None, texts[0]), (904, "z " * 4000)]
    rows += [(905, texts[3]), (905, texts[3]), (905, "other words here now")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 3])
@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_rows_equal_brute_force(spark, monkeypatch, block, words, percent):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(shared, "SMALL", 10 if block == 3 else 1 << 20)
    texts = corpus(block + words)
    df = spark.createDataFrame([(k, t, "x", 1, 2) for k, t in texts], "doc_id long, text string, node string, n int, key int")
    assert as_rows(near_duplicates(df, words, percent)) == by_hand(texts, words, percent)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_over_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert as_rows(op8_ngram_jaccard_join(spark, "/root/testdata/sf0.01")) == by_hand([tuple(r) for r in docs], 3, 90)


def test_columns_named_like_our_own_stay(spark):
    rows = [(1, "a b c", 7, "x", 0), (2, "A  b c", 8, "y", 1), (3, None, 9, "z", 2), (4, "d", 6, "w", 3), (4, "d", 6, "w", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __row long, row string, c0 int")
    out = without_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [rows[0], rows[2], rows[3]]))


def test_long_words_of_two_letters_are_told_apart(spark):
    """Words on which polynomials modulo a power of two agree, whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    df = spark.createDataFrame([(1, one), (2, other), (3, one.upper())], "doc_id long, text string")
    assert as_rows(near_duplicates(df, 3, 90)) == by_hand([tuple(r) for r in df.collect()], 3, 90)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_short_sets_that_are_alike_share_a_key(percent):
    rng, bands = np.random.default_rng(5), Bands(percent)
    for _ in range(6000):
        n = int(rng.integers(1, 40))
        one = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        lost, new = (int(x) for x in rng.integers(0, 1 + n * (100 - percent) // 100, 2))
        other = np.unique(np.r_[one[rng.permutation(len(one))[lost:]], rng.integers(0, 2**64, new, dtype=np.uint64)])
        both = len(np.intersect1d(one, other))
        if len(other) and 100 * both >= percent * (len(one) + len(other) - both):
            assert len(np.intersect1d(bands.keys(one), bands.keys(other)))


@pytest.mark.parametrize("percent", [80, 90])
def test_unrelated_short_sets_do_not_meet(percent):
    rng, bands = np.random.default_rng(6), Bands(percent)
    keys = [bands.keys(np.unique(rng.integers(0, 2**64, int(n), dtype=np.uint64))) for n in rng.integers(1, 40, 20_000)]
    assert np.unique(np.concatenate(keys), return_counts=True)[1].max() <= 2

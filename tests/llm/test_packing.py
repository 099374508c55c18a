import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chuvisco.llm.packing import configurations, pack, pack_documents
from chuvisco.llm.queries import op6_best_fit_packing
from chuvisco.llm.units import encode

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ODD = [
    "", " ", "a", "don't  stop\n\nnow", "x.\nY", "é à l'été, naïve", "a b c d", "<|endoftext|> mid <|endoftext|>",
    "tabs\tand  \n spaces ", "1,234.5 (x)'s", "日本 語　x", "she's.'s 'tis", "\u0085 x\x1cy \x7f z", "a ́b",
]


def slots(counts, rows):
    sequences, used = defaultdict(list), Counter()
    for length, place, n, first, each, offset in rows:
        assert place == used[length]
        used[length] += n
        for i in range(n):
            sequences[first + i // each].append((offset + i % each * length, length))
    assert dict(used) == {k: v for k, v in counts.items() if v}
    return sequences


def gapless(sequences, capacity):
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity


@given(st.lists(st.text(alphabet=" \n\t.,'’abséßZ09<|  日", max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_units_give_the_tokenizers_ids(texts):
    held = [t.encode() for t in [*texts, *ODD]]
    ids, bounds = encode(PATH, np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]))
    for i, t in enumerate([*texts, *ODD]):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == TOKENIZER.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece_once_and_use_few_sequences(seed):
    random = np.random.default_rng(seed)
    lengths = random.integers(1, 1025, 3000) if seed % 2 else np.minimum(1024, random.lognormal(5.5, 1, 3000).astype(int) + 1)
    counts = Counter(lengths.tolist())
    sequences = slots(counts, pack(counts))
    gapless(sequences, 1024)
    assert len(sequences) <= -(-int(lengths.sum()) // 1024) * 1.01 + 3


def test_configurations_fill_and_never_exceed_demand():
    sizes, wanted = np.array([512, 256]), np.array([10.0, 20.0])
    found = configurations(sizes, wanted, 1024)
    assert sum(n for _, n in found) <= 10
    for i in range(2):
        assert sum(c[i] * n for c, n in found) <= wanted[i]
    assert all(sizes @ c <= 1024 for c, _ in found)


@given(st.dictionaries(st.integers(1, 16), st.integers(1, 40), max_size=16))
@settings(max_examples=100, deadline=None)
def test_small_capacities_and_few_groups(counts):
    gapless(slots(counts, pack(counts, capacity=16, groups=3, small=4)), 16)


def packed(df):
    rows = df.collect()
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    gapless(held, 1024)
    return rows


def by_hand(texts):
    wanted = Counter()
    for doc, text in texts:
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return wanted


def test_pieces_equal_the_librarys(spark):
    texts = [(i, t) for i, t in enumerate(ODD)]
    texts += [(90, None), (None, "no key"), (None, None), (91, "twice"), (91, "twice"), (92, "long words, " * 3000)]
    df = spark.createDataFrame([(k, t, "x", 1, 2) for k, t in texts], "doc_id long, text string, piece string, length int, part int")
    rows = packed(pack_documents(df, PATH))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == by_hand(texts)
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_query_over_the_documents(spark, sf_dir):
    rows = packed(op6_best_fit_packing(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == by_hand(docs)
    least = -(-sum(r.length for r in rows) // 1024)
    assert len({r.sequence_id for r in rows}) <= least * 1.01 + 3

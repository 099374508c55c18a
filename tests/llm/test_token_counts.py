import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chuvisco.llm.queries import op9_token_counts
from chuvisco.llm.token_counts import count_tokens, token_counts
from chuvisco.llm.transducer import CHUNK, STOP, Transducer, normal, symbols_of

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ODD = [
    "", "a", "don't", "it's 'sam ''s 'll 'r 'rx 've'v", "x1234 ½ ２", "<|endoftext|>a<|startoftext|>", "é à Σας İ", "日本語 text",
    "\u0085x y　z", "!!!...'s", "'", "''", "a'", "'re'", "'é", "é", "\x1cq", "ẞ ŉ ﬁ Ǆ", "<|ENDOFTEXT|>", "🙂🙂 'd", "x'tis",
    " 'l", "'v3", "é ́e", "a\x00b", "'r's", "</w> a</w>b",
]


def by_hand(texts):
    return [len(e.ids) for e in TOKENIZER.encode_batch(list(texts), add_special_tokens=False)]


def test_odd_texts():
    assert count_tokens(PATH, ODD) == by_hand(ODD)


@given(st.lists(st.text(alphabet="aesrtvlmdxTHE'’.,!  \n12éÉßΣ日🙂½ <|", max_size=60), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_random_texts(texts):
    assert count_tokens(PATH, texts) == by_hand(texts)


@given(st.text(max_size=40))
@settings(max_examples=150, deadline=None)
def test_any_characters(text):
    assert count_tokens(PATH, [text]) == by_hand([text])


def test_chunks_compose_wherever_texts_are_cut():
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh'1.") for _ in range(5 * CHUNK))
    texts = [long, " ".join(long[i : i + 7] for i in range(0, len(long), 7)), "x" * (CHUNK - 1) + " y", "ab" * CHUNK, "é" * 2000, "''" * CHUNK]
    assert count_tokens(PATH, texts) == by_hand(texts)


def test_full_tables_are_made_anew():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdeéstrn") for _ in range(rng.randint(1, 12))) for _ in range(3000))
    small = Transducer(PATH, states=40)
    symbols = symbols_of(np.frombuffer(normal(text).encode() + b"\xff", np.uint8))
    assert symbols[-1] == STOP and small.counts(symbols).sum() == by_hand([text])[0]


def test_rows_with_nulls_copies_and_clashing_columns(spark):
    texts = [*enumerate(ODD), (90, None), (None, "a b"), (None, None), (91, "same"), (91, "same"), (92, "word " * 3000)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts], "doc_id long, text string, n_tokens string, n_bytes int")
    n = by_hand([t or "" for _, t in texts])
    wanted = sorted(repr((k, len((t or "").encode()), c, c > 2048)) for (k, t), c in zip(texts, n))
    assert sorted(repr(tuple(r)) for r in token_counts(df, PATH).collect()) == wanted
    assert token_counts(df.limit(0), PATH).count() == 0


def test_query_over_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    wanted = {r.doc_id: n for r, n in zip(docs, by_hand([r.text for r in docs]))}
    assert {r.doc_id: r.n_tokens for r in op9_token_counts(spark, "/root/testdata/sf0.01").collect()} == wanted

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from chuvisco.llm.pieces import _short as short
from chuvisco.llm.pieces import decode, decoded, encode, load, segment, segment_documents, segment_long, segmentations
from chuvisco.llm.queries import op7_sentencepiece_dropout

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "a", "  two  blanks ", "new\n\nline\t", "é à 日本語 🙂", "e.g. don't (x)=1;", "▁ mark ▁▁", "<s>x</s>", "\x00\x1c", "x" * 200]


def encoded(texts, **how):
    held = [t.encode() for t in texts]
    ids, edges = encode(PATH, np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]), np.arange(len(texts)), **how)
    return [ids[a:b] for a, b in zip(edges, edges[1:])]


def test_without_dropout_ids_are_the_librarys():
    texts = [t for t in ODD if "▁" not in t] + ["the  quick brown fox " * 5]
    assert [i.tolist() for i in encoded(texts, rate=0)] == LIBRARY.encode(texts)


@given(st.lists(st.text(alphabet="aeinrst .,\n'éß日🙂▁X1", max_size=60), min_size=1, max_size=5), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
@settings(max_examples=120, deadline=None)
def test_every_segmentation_decodes_to_its_text(texts, rate):
    for text, ids in zip([*texts, *ODD], encoded([*texts, *ODD], rate=rate)):
        assert decode(PATH, ids) == text
        if "▁" not in text and "\x00" not in text:
            assert LIBRARY.decode(ids.tolist()) == text
    if rate == 0:
        plain = [t for t in texts if "▁" not in t]
        assert [i.tolist() for i in encoded(plain, rate=0)] == LIBRARY.encode(plain) if plain else True


@pytest.mark.parametrize("rate", [0.0, 0.2, 0.6])
def test_side_by_side_and_agenda_agree(rate):
    rng, pieces = random.Random(3), load(PATH)
    for _ in range(200):
        word = " " * rng.randint(0, 2) + "".join(rng.choice("aeinrstthing.é\n") for _ in range(rng.randint(1, 30)))
        points, key = np.array([ord(c) for c in word]), np.uint64(rng.getrandbits(64))
        one, _ = segment(pieces, points, np.array([0, len(points)]), np.array([key]), rate)
        assert one.tolist() == segment_long(pieces, points, key, rate).tolist()


def test_seeds_keys_and_places_vary_segmentations():
    text = "internationalization of the representation " * 20
    first, again, other = (encoded([text, text], seed=s, rate=0.2) for s in (1, 1, 2))
    assert all((a == b).all() for a, b in zip(first, again))
    assert first[0].tolist() != other[0].tolist() and first[0].tolist() != first[1].tolist()
    plain = len(LIBRARY.encode(text))
    assert len(first[0]) > plain and len(encoded([text], rate=1.0)[0]) >= len(text)


def test_each_occurrence_is_segmented_by_itself():
    word = " internationalization"
    words = [i.tolist() for i in encoded(["internationalization"] * 400, rate=0.1)]
    (within,) = encoded([(word * 400)[1:]], rate=0.1)
    parts, at = [], 0
    while at < len(within):
        end = at + 1
        while len(b"".join(load(PATH).decoded[i] for i in within[at:end])) < len(word):
            end += 1
        parts.append(tuple(within[at:end].tolist()))
        at = end
    assert len(parts) == 400
    assert len(set(parts)) > 20 and len({tuple(w) for w in words}) > 20


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_shared_segmentations_are_those_of_each_unit_alone(rate):
    text = "the representation of the representation is the internationalization " * 30
    calls = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("chuvisco.llm.pieces._short", lambda *a: calls.append(a) or short(*a))
        (ids,) = encoded([text], rate=rate)
    assert 0 < len(calls[1][3]) < len(text.split())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("chuvisco.llm.pieces.SHORT", 0)
        assert encoded([text], rate=rate)[0].tolist() == ids.tolist()


def test_tables_of_ids_decode_to_the_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None, "a few words " * 50])], "doc_id long, text string")
    ids = segmentations(df, PATH)
    assert {r.doc_id: r.ids_crc32 for r in segment_documents(df, PATH).collect()} == {
        r.doc_id: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in ids.collect()
    }
    assert {r.doc_id: r.ids for r in decoded(ids, PATH).collect()} == {r.doc_id: r.text or "" for r in df.collect()}


def test_rows_with_nulls_copies_and_clashing_columns(spark):
    texts = [*enumerate(ODD), (90, None), (None, "a b"), (91, "same word"), (91, "same word"), (92, "long words " * 30000), (93, "y" * 20000)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts], "doc_id long, text string, lossless string, n_tokens int")
    rows = segment_documents(df, PATH).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in rows) == sorted((k or -1, len(t or "")) for k, t in texts)
    assert all(r.lossless and r.text_sha256 == r.decoded_sha256 for r in rows)
    assert len({r.ids_crc32 for r in rows if r.doc_id == 91}) == 1
    assert segment_documents(df.limit(0), PATH).count() == 0


def test_query_over_the_documents(spark):
    rows = op7_sentencepiece_dropout(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert all(r.lossless for r in rows)
    plain = dict(zip([r.doc_id for r in docs], map(len, LIBRARY.encode([r.text for r in docs]))))
    assert {r.doc_id for r in rows} == plain.keys()
    assert sum(r.n_tokens for r in rows) > 1.02 * sum(plain.values())

import math
import random
import zlib

import numpy as np
import pytest

from chuvisco.llm.language import UNKNOWN, code_words, fit, grams, identify, keep_identified, learned, training_sample
from chuvisco.llm.queries import op10_language_id

SCHEMA = "doc_id long, text string, lang string, score double, held_out string"


@pytest.mark.parametrize("classes", range(2, 20))
def test_code_words_are_far_apart_and_bits_part_the_classes(classes):
    codes = code_words(classes)
    apart = [(a != b).sum() for i, a in enumerate(codes) for b in codes[:i]]
    assert min(apart) * 2 >= codes.shape[1] - 1 or classes > 7 and min(apart) * 3 >= codes.shape[1]
    assert (np.abs(codes.sum(axis=0)) < classes).all()


def test_grams_stay_within_texts():
    def of(*texts):
        held = [t.encode() for t in texts]
        place, owner = grams(np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]))
        return [sorted(place[owner == i].tolist()) for i in range(len(texts))]

    texts = ["ab", "", "abc def", "é!x", "a", "A B"]
    assert of(*texts) == [of(t)[0] for t in texts]
    assert of("A!b") == of("ab")


def test_one_flipped_bit_is_corrected():
    model = fit(["la casa el perro"] * 5 + ["the house dog with"] * 5 + ["das haus der hund"] * 5 + ["le chien la maison"] * 5, [*"aaaaabbbbbcccccddddd"])
    for i, code in enumerate(model.codes):
        margins = 3.0 * code[None, :].repeat(len(code), 0)
        margins[np.arange(len(code)), np.arange(len(code))] *= -1
        assert (model.decode(margins)[0] == i).all()
    assert model.decode(np.zeros((1, model.codes.shape[1])))[2].all()


def rows(spark, *values):
    return spark.createDataFrame([(*v, 0.5, "x") for v in values], SCHEMA)


def test_nulls_copies_and_texts_without_letters(spark):
    learn = [(i, "the house and the dog", "en") if i % 2 else (i, "das haus und der hund", "de") for i in range(40)]
    odd = [(None, "the dog", None), (100, None, "en"), (101, "", None), (102, "12 !?", "en"), (102, "12 !?", "en"), (103, "x " * 90000, None)]
    df = rows(spark, *learn, *odd)
    found = identify(df).collect()
    assert len(found) == len(learn) + len(odd)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
        assert (r.lang_pred == UNKNOWN) == (r.doc_id in (100, 101, 102)) and 0 <= r.score <= 1
    assert {r.doc_id: r.lang_pred for r in found if r.doc_id is not None and r.doc_id < 40} == {k: v for k, _, v in learn}
    kept = keep_identified(df, learned(df.select("doc_id", "text", "lang")))
    assert kept.schema == df.schema and kept.count() == len(learn) + 2


def test_without_labels_or_rows_nothing_is_known(spark):
    df = rows(spark, (1, "some text", None))
    assert [(r.lang_pred, r.score) for r in identify(df).collect()] == [(UNKNOWN, 0.0)]
    assert identify(df.limit(0)).count() == 0


def test_labels_and_keys_of_the_held_out_fold_change_nothing(spark):
    base = [(i, f"the house and {i}", "en") if i % 2 else (i, f"das haus und {i}", "de") for i in range(60)]
    changed = [(k, t, "xx" if zlib.crc32(str(k).encode()) % 5 == 0 else v) for k, t, v in base]
    first, second = ({r.doc_id: (r.lang_pred, r.score) for r in identify(rows(spark, *b)).collect()} for b in (base, changed))
    assert first == second


JUNK = {
    "letters": "".join(chr(97 + i * i * 31 % 26) + chr(65 + i * 7 % 26) + chr(97 + i * i * i * 5 % 26) for i in range(150)),
    "repeated": "zqzqzq xkx " * 40,
    "russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. ",
    "chinese": "人人生而自由在尊嚴和權利上一律平等",
    "one": "人",
    "greek": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια. ",
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. " * 3,
}


def test_junk_and_unseen_scripts_go_and_labelled_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = learned(docs)
    odd = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(JUNK.values())], docs.schema)
    kept = {r.doc_id for r in keep_identified(docs.union(odd), model).collect()}
    assert kept == {r.doc_id for r in docs.collect()}


def test_letters_stay_where_nothing_can_be_learned(spark):
    df = rows(spark, (1, "some text", None), (2, "12 34", None), (3, None, "en"))
    assert [r.doc_id for r in keep_identified(df, learned(df.where("doc_id < 3"))).collect()] == [1]


def test_query_predicts_held_out_documents(spark):
    found = op10_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert len(found) == len(lang)
    held = [r.lang_pred == lang[r.doc_id] for r in found if r.held_out]
    assert len(held) > 100 and np.mean(held) > 0.98


WORDS = {"en": "the and of to in that house with dog", "de": "der und die das ist haus nicht hund mit", "xx": "zorp quib flum wask trin gobb"}


def prose(rng, lang, count):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(count))


def test_learns_beyond_a_shared_opening(spark):
    rng = random.Random(1)
    opening = "qualche testo in comune che sta davanti a tutto il resto " * 60
    docs = [(i, opening + prose(rng, lang, 120), lang) for i, lang in enumerate(["en", "de"] * 150)]
    found = identify(rows(spark, *docs)).collect()
    lang = {k: v for k, _, v in docs}
    held = [r.lang_pred == lang[r.doc_id] for r in found if r.held_out]
    assert len(held) > 30 and np.mean(held) > 0.95


def test_a_language_of_one_row_in_ten_thousand_is_learned_and_kept(spark):
    rng = random.Random(2)
    docs = [(i, prose(rng, lang, 30), lang) for i, lang in enumerate(["en", "de"] * 10_000)]
    rare = [i for i in range(20_000, 20_100) if zlib.crc32(str(i).encode()) % 5 != 0][:2]
    docs += [(i, prose(rng, "xx", 30), "xx") for i in rare] + [(30_000 + i, prose(rng, "xx", 30), None) for i in range(20)]
    df = rows(spark, *docs)
    found = {r.doc_id: r.lang_pred for r in identify(df).where("doc_id >= 20000").collect()}
    assert set(found.values()) == {"xx"} and len(found) == 22
    kept = keep_identified(df, learned(df.select("doc_id", "text", "lang")))
    assert kept.where("doc_id >= 20000").count() == 22


def test_sample_takes_distinct_whole_texts_of_each_language(spark):
    copies = [(i, "the same text in all of these", "en") for i in range(1, 3000)]
    others = [(i, f"another text {i} " * 400, "en" if i % 3 else "de") for i in range(3000, 3400)]
    sample = training_sample(rows(spark, *copies, *others).select("doc_id", "text", "lang"), 0, 5, 100, 10)
    assert [sum(r.lang == x for r in sample) for x in ("en", "de")] == [50, 50]
    assert len({(r.lang, r.order) for r in sample}) == 100
    sizes = {int(np.frombuffer(r.counts, np.int64).sum()) for r in sample}
    assert min(x for x in sizes if x > 100) > 10_000  # pairs and triples of all repeats


def test_margins_and_decoding_equal_brute_force():
    rng = random.Random(3)
    texts = [prose(rng, lang, 25) for lang in ("en", "de", "xx") * 15]
    model = fit(texts, ["en", "de", "xx"] * 15)
    asked = [prose(rng, lang, n) for lang in WORDS for n in (1, 2, 9, 200)] + ["", "12", "É"]
    held = [t.encode() for t in asked]
    margins = model.margins(np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]))
    for text, margin in zip(held, margins):
        kept = [c + 32 if 65 <= c <= 90 else 32 if c in b"\t\n\v\f\r " else c for c in text if c >= 128 or chr(c).isalpha() or chr(c).isspace()]
        found = []
        for a, b, c in zip(kept, kept[1:], [*kept[2:], None]):
            if (a, b) != (32, 32):
                found.append(a << 8 | b)
                if c is not None:
                    found.append(65536 + ((((a << 8 | b) << 8 | c) * 2654435761 % 2**32) >> 16))
        by_hand = [float(np.mean([w[g] for g in found])) + b if found else float(b) for w, b in zip(model.weights, model.bias)]
        assert np.allclose(margin, by_hand, atol=1e-4)
        loss = [sum(math.log1p(math.exp(-m * bit)) for m, bit in zip(by_hand, code)) for code in model.codes]
        best, score, _ = (x[0] for x in model.decode(margin[None, :]))
        assert best == loss.index(min(loss)) and abs(score - math.exp(-min(loss)) / sum(math.exp(-x) for x in loss)) < 1e-3

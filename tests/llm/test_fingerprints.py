import hashlib
import random

import numpy as np
import pytest

from chuvisco.llm.fingerprints import LENGTH, fingerprint_documents, fingerprints
from chuvisco.llm.queries import op2_document_fingerprints


def words(rng, n):
    return " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "é"]) + str(rng.randrange(999)) for _ in range(n))


def test_fingerprints_do_not_depend_on_neighbours():
    rng = random.Random(1)
    texts = [words(rng, n).encode() for n in (0, 1, 3, 40, 400, 4000, 60)] + [b"a" * 5000, b"abcdef", b"abcdefg"]
    together = fingerprints(texts)
    assert together == [fingerprints([t])[0] for t in texts]
    for f in together:
        size, one, two = f.split(":")
        assert len(one) <= LENGTH and len(two) <= LENGTH // 2 and int(size) % 3 == 0


def test_a_local_edit_changes_few_characters():
    rng = random.Random(2)
    for n in (200, 1000, 5000):
        text = words(rng, n)
        half = len(text) // 2
        a, b = fingerprints([text.encode(), (text[:half] + "INSERTED" + text[half:]).encode()])
        if a.split(":")[0] == b.split(":")[0]:
            one, other = a.split(":")[1], b.split(":")[1]
            assert one[:20] == other[:20] and one[-20:] == other[-20:]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def alike(one, other):
    if one == other:
        return 1.0

    def score(a, b):
        def short(s):
            out = ""
            for c in s:
                if not out.endswith(c * 3):
                    out += c
            return out

        a, b = short(a), short(b)
        if not a and not b:
            return 0.0
        if min(len(a), len(b)) >= 7 and not any(a[i : i + 7] in b for i in range(len(a) - 6)):
            return 0.0
        return 1 - distance(a, b) / max(len(a), len(b))

    (s, a1, a2), (t, b1, b2) = one.split(":"), other.split(":")
    s, t = int(s), int(t)
    return max(score(a1, b1), score(a2, b2)) if s == t else score(a1, b2) if s == 2 * t else score(a2, b1) if t == 2 * s else 0.0


def by_hand(texts):
    ordered = sorted(((d, t or "") for d, t in texts), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    rows = []
    for i, (doc, text) in enumerate(ordered):
        other = ordered[(i + 1) % len(ordered)][1]
        k = len(text) // 4
        edited = text[: len(text) - k] + other[:k]
        f, e, n = fingerprints([text.encode(), edited.encode(), other.encode()])
        rows.append(repr((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, round(alike(f, e), 9), round(alike(f, n), 9))))
    return sorted(rows)


def as_rows(df):
    return sorted(
        repr((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)))
        for r in df.collect()
    )


@pytest.mark.parametrize("count", [1, 2, 9, 300])
def test_rows_equal_brute_force(spark, count):
    rng = random.Random(count)
    texts = [(rng.randrange(-5000, 5000), words(rng, rng.choice([0, 1, 5, 50, 300]))) for _ in range(count)]
    if count == 9:
        texts += [(None, "null key"), (None, None), (7, "same"), (7, "same"), (7, ""), (8, None), (9, "long " * 30000)]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in texts], "doc_id long, text string, part int, at string")
    assert as_rows(fingerprint_documents(df)) == by_hand(texts)


def test_empty_table(spark):
    assert fingerprint_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_over_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = op2_document_fingerprints(spark, sf_dir)
    assert as_rows(found) == by_hand([tuple(r) for r in docs])
    rows = found.collect()
    assert np.mean([r.near_edited for r in rows]) > 0.5 > 0.1 > np.mean([r.near_next for r in rows])

import hashlib
import zlib

import pytest

from chuvisco.llm.manifest import PersistentTree, audit, continued, height, manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def fold(levels, i, digest):
    siblings = []
    for level in levels:
        run = level[i - i % 3 : i - i % 3 + 3]
        siblings += [x for j, x in enumerate(run) if j != i % 3]
        run[i % 3] = digest
        digest, i = h("".join(run)), i // 3
    return digest, siblings


def levels_of(nodes):
    levels = []
    while len(nodes) > 1:
        levels.append(nodes)
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return levels, nodes[0]


def by_hand(rows):
    parts = {}
    for row in rows:
        parts.setdefault(row[1], []).append((row, leaf(row, row[4])))
    for held in parts.values():
        held.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    inner = {name: levels_of([x for _, x in parts[name]]) for name in names}
    upper, root = levels_of([inner[name][1] for name in names])
    out = []
    for place, name in enumerate(names):
        for i, (row, own) in enumerate(parts[name]):
            changed = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                changed = leaf(row, row[4] and row[4].replace("\n", ""))
            digest, below = fold(inner[name][0], i, changed)
            digest, above = fold(upper, place, digest)
            out.append((row[0], own, inner[name][1], root, h("".join(below + above)), digest, digest == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


ODD = [
    (None, "a", None, None, "x\ny"),
    (1, None, "en", 3, None),
    (2, None, "", 0, ""),
    (2, None, "", 0, ""),  # a row twice
    (2, None, "", 0, "\n\n"),  # a key twice
    (4, "é", "fr", 1, "é\n"),
    (5, "", "fr", 1, "z\n" * 5000),
    (9, "A", "fr", 1, "\n"),
]


@pytest.mark.parametrize("deep", [1, 6])  # blocks of three and several tiers, or one block
def test_rows_equal_brute_force(spark, deep):
    rows = ODD + [(i, f"s{i % 7}" if i % 3 else "hot", "en", i, f"line {i}\nline" if i % 4 else "one line") for i in range(10, 260)]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA + ", pos int, part string")
    assert rows_of(audit(df, deep)) == by_hand(rows)


@pytest.mark.parametrize("count", [1, 2, 3, 4])
def test_few_rows(spark, count):
    rows = [(i, "a", "en", 1, "a\nb") for i in range(count)]
    found = rows_of(audit(spark.createDataFrame(rows, SCHEMA)))
    assert found == by_hand(rows)
    if count == 1:
        assert found[0][1] == found[0][2] == found[0][3]


def test_no_rows(spark):
    assert rows_of(audit(spark.createDataFrame([], SCHEMA))) == []


def test_a_version_copies_one_node_a_level_and_shares_the_rest():
    digests = [bytes([i]) * 32 for i in range(20)]
    tree = PersistentTree(digests, height(20))
    before = [list(level) for level in tree.levels]
    copies = tree.version(7, b"n" * 32)
    assert len(copies) == height(20) + 1 == 4
    assert tree.levels == before
    digests[7] = b"n" * 32
    again = PersistentTree(digests, height(20))
    assert [level[7 // 3**k] for k, level in enumerate(again.levels)] == copies
    changed = sum(a != b for x, y in zip(tree.levels, again.levels) for a, b in zip(x, y))
    assert changed == len(copies)
    assert continued(copies[0], *tree.path(7)) == copies[1:]


def test_proofs_hold_and_versions_end_in_their_root(spark):
    rows = [(i, "a" if i < 40 else "b", "en", 1, f"t{i}") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = manifest(df, change={"text": df.text}, where=df.doc_id % 2 == 0).collect()
    for r in found:
        assert continued(bytes(r.leaf), bytes(r.slots), bytes(r.siblings))[-1] == bytes(r.root) == bytes(r.copies[-32:])
        assert len(r.copies) == 32 * (len(r.slots) + 1)
        wrong = continued(bytes(32), bytes(r.slots), bytes(r.siblings))
        assert wrong[-1] != bytes(r.root)

"""Links between texts whose sets of word n-grams are alike, by parity sketches."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chuvisco.llm.links import components
from chuvisco.llm.shared import among, flat, numbered_columns, slices, stored, stretch_hashes, table

#: Bits of the sketch that pairs are first compared by.
BITS = 1024
#: Expected number of equal segments that a pair at the threshold keeps where long sketches are thinned out.
SURE = 28
#: Rows of one key that are compared with each other in one task; larger groups are dealt out in blocks.
BLOCK = 1024
#: Bytes up to which a word is hashed as a polynomial, which for long words of two letters can come out alike.
LONG = 64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _OTHER
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (A-Z in lower case), and the number of words before each text."""
    n = len(data)
    visible = ~_SPACE[data]
    begins = visible.copy()
    begins[1:] &= _SPACE[data[:-1]]
    at_start = starts[:-1][starts[:-1] < n]
    begins[at_start] = visible[at_start]
    word = np.flatnonzero(begins)
    ends_here = visible.copy()
    ends_here[:-1] &= ~visible[1:] | begins[1:]
    end = np.flatnonzero(ends_here) + 1
    lower = _LOWER[data]
    hashes = mix(stretch_hashes(lower, int(_ODD))(word, end) + (end - word).astype(np.uint64))
    for i in np.flatnonzero(end - word > LONG):
        hashes[i] = int.from_bytes(blake2b(lower[word[i] : end[i]].data, digest_size=8).digest(), "little")
    return hashes, np.searchsorted(word, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles."""
    hashes, bounds = word_hashes(data, starts)
    n = max(len(hashes) - words + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for i in range(words):
        rolled = mix(rolled * _ODD + hashes[i : i + n])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = mix(np.array([whole]) * _ODD + h)[0]
            yield np.array([whole])
        else:
            yield np.zeros(0, np.uint64)


class Bands:
    """Size bands, and how sketches are cut in each.

    Two sets with a Jaccard similarity of ``percent`` differ in at most ``(100 - p) / (100 + p)`` of their summed sizes.
    Band i is for pairs whose larger set lies in it; ``most[i]`` is what these can differ in. A sketch of the band has
    more segments than that, so some segment has no differing element and is the same in both.
    """

    def __init__(self, percent: int, ratio: float = 1.25, sizes: int = 1 << 40):
        self.percent = percent
        starts = [1]
        while starts[-1] < sizes:
            starts.append(max(starts[-1] + 1, int(starts[-1] * ratio)))
        self.starts = np.array(starts, np.int64)
        tops = self.starts[1:] - 1
        self.most = (100 - percent) * 2 * tops // (100 + percent)
        self.segments = self.most + 1 + (0.05 * tops * (100 - percent) / 20).astype(np.int64)
        alike = self.segments * np.exp(-self.most / self.segments) * 0.6
        self.kept = np.minimum(1.0, SURE / alike)

    def of(self, n: int) -> list[int]:
        """The set's own band, and the next ones as far as a set there could be alike."""
        band = int(np.searchsorted(self.starts, n, "right")) - 1
        last = int(np.searchsorted(self.starts, 100 * n // self.percent, "right")) - 1
        return list(range(band, min(last, len(self.most) - 1) + 1))

    def keys(self, elements: np.ndarray) -> np.ndarray:
        """Hashes of (band, segment, content): of each segment the parity of its elements, one bit each, and the sum
        modulo two of their hashes, which tells contents of equal parity apart.

        Segments with fewer than two elements are left out if, even were all of them among the equal ones, an equal one
        is left. Segments without elements have no keys. So a pair whose equal segments are all empty has none in common;
        then the elements of both stand in no more segments than a pair can differ in. Such sets also have the keys of
        their smallest elements, as many as one more than may be missing from a set that is alike. Where a pair at the threshold would have many more than ``SURE`` equal
        segments, a share is kept, chosen by content and so alike in both.
        """
        found = []
        scrambled = mix(elements * _ODD)
        toggles = np.uint64(1) << (scrambled & np.uint64(63))
        for band in self.of(len(elements)):
            k, slack = int(self.segments[band]), int(self.segments[band] - self.most[band])
            segment = ((elements >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # in order, as elements are
            first = np.r_[0, np.flatnonzero(np.diff(segment)) + 1]
            count = np.diff(np.r_[first, len(elements)])
            parity = np.bitwise_xor.reduceat(toggles, first)
            check = np.bitwise_xor.reduceat(scrambled, first)
            index = segment[first]
            if slack > k - int((count >= 2).sum()):
                many = count >= 2
                index, parity, check = index[many], parity[many], check[many]
            elif slack <= k - len(first):
                missing = len(elements) - -(-self.percent * len(elements) // 100)
                found.append(mix(mix(elements[: missing + 1] ^ _OTHER) + np.uint64(band)))
            key = mix(mix(parity + np.uint64(band)) ^ check * _ODD ^ mix(index + np.uint64(1)))
            found.append(key[mix(key) < np.uint64(min(self.kept[band], 1.0) * (2**64 - 2**12))] if self.kept[band] < 1 else key)
        return np.unique(np.concatenate(found))


def sketch(elements: np.ndarray) -> bytes:
    """One bit toggled per element: two sketches differ in no more bits than their sets in elements."""
    place = (mix(elements ^ _OTHER) >> np.uint64(7)) % np.uint64(BITS)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=BITS) & 1).tobytes()


def _signature(elements: np.ndarray) -> int:
    return int((mix(elements + _ODD).sum(dtype=np.uint64) + np.uint64(len(elements))).view(np.int64)) if len(elements) else 0


_SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("node", pa.int64()),
        ("n", pa.int64()),
        ("sketch", pa.binary()),
        ("keys", pa.list_(pa.int64())),
    ]
)


def _sketched(docs: DataFrame, words: int, bands: Bands) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = {"node": [], "n": [], "sketch": [], "keys": []}
            for elements in shingle_sets(*flat(batch.column("text")), words):
                columns["node"].append(_signature(elements))
                columns["n"].append(len(elements))
                columns["sketch"].append(sketch(elements) if len(elements) else b"")
                columns["keys"].append(bands.keys(elements).view(np.int64) if len(elements) else [])
            yield table(_SETS, doc_id=batch.column("doc_id"), row=batch.column("row"), **columns)

    return docs.mapInArrow(emit, "doc_id long, row long, node long, n long, sketch binary, keys array<long>")


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` that are alike, by their sets themselves."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "row"), "node"))
    chosen = among(docs, wanted.select("row").distinct(), "row").join(wanted, "row").dropDuplicates(["node"]).select("node", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("elements", pa.binary())])
        for batch in slices(batches):
            held = [s.tobytes() for s in shingle_sets(*flat(batch.column("text")), words)]
            yield table(schema, node=batch.column("node"), elements=held)

    sets = stored(chosen.mapInArrow(gather, "node long, elements binary"))
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("one"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("other"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for one, other in zip(batch.column("one"), batch.column("other"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                alike.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(alike))

    return stored(pairs.join(left, "a").join(right, "b").mapInArrow(verify, "a long, b long"))


def _near(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs sizes and sketches leave open."""
    differing = np.bitwise_count(one ^ other).sum(axis=-1, dtype=np.int64)
    total = n_one + n_other
    fits = 100 * np.minimum(n_one, n_other) >= percent * np.maximum(n_one, n_other)
    return fits & (differing * (100 + percent) <= (100 - percent) * total)


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), BITS // 64)


def _open_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``pairs (a, b)`` that their sketches do not rule out."""

    def rule_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = _sketches(batch.column("s_a")), _sketches(batch.column("s_b"))
                near = _near(one, other, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array(near))

    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    return stored(pairs.join(a, "a").join(b, "b").mapInArrow(rule_out, "a long, b long"))


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a key, unless sketches rule them out.

    ``rows (key, node, component, n, sketch, crowd)``: a key's rows are dealt into blocks of about ``BLOCK``, and every
    two blocks meet in a task of their own. Within a task, pairs are told apart by whole columns of sketches; what
    leaves it are pairs that still have to be looked at.
    """
    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")
    dealt = (
        rows.withColumn("blocks", blocks)
        .withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("mine", "other"))
        .withColumn("second", F.greatest("mine", "other"))
        .select("key", "first", "second", "mine", "node", "component", "n", "sketch")
        .repartition("key", "first", "second")
        .sortWithinPartitions("key", "first", "second")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs_of(part: pa.Table) -> np.ndarray:
        node, component = part.column("node").to_numpy(), part.column("component").to_numpy()
        n, held = part.column("n").to_numpy(), _sketches(part.column("sketch").combine_chunks())
        mine, first, second = (part.column(c).to_numpy() for c in ("mine", "first", "second"))
        found = []
        for i in range(len(node) - 1):
            later = np.flatnonzero(component[i + 1 :] != component[i]) + i + 1
            if first[0] != second[0]:
                later = later[mine[later] != mine[i]]
            if len(later):
                near = later[_near(held[later], held[i], n[later], n[i], percent)]
                found.append(np.stack([np.minimum(node[near], node[i]), np.maximum(node[near], node[i])], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "first", "second")])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                piece = batch.slice(a, b - a)
                if held and any(held[-1].column(c)[0] != piece.column(c)[0] for c in ("key", "first", "second")):
                    done = pairs_of(pa.Table.from_batches(held))
                    held = []
                    if len(done):
                        yield table(schema, a=done[:, 0], b=done[:, 1])
                held.append(piece)
        if held and len(done := pairs_of(pa.Table.from_batches(held))):
            yield table(schema, a=done[:, 0], b=done[:, 1])

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``.

    Two texts are linked if the Jaccard similarity of their sets of ``words``-word shingles is ``percent`` in a hundred
    or more; a component is all that links reach, named by its smallest key. Texts with fewer words have one shingle,
    empty and null ones none and no links. A null key is a row like any other but names no component that has another
    key. ``row`` is a hash of key and text, ``component_row`` that of the row that names the component. Other columns are
    not looked at.

    Texts with equal sets are one node. Each sketch segment that two nodes have in common makes them candidates: all
    nodes of a segment's key are first held against the smallest and the largest; what then is in one component needs
    no more looking at, and nodes of different components are held against each other in blocks. A link at the very
    threshold between sets that differ in more than about a hundred elements can be missed with a probability below
    1e-11 (see ``SURE``); all others are found.
    """
    bands = Bands(percent)
    plain = docs.select(
        F.xxhash64(F.col(text).cast("string"), F.col(key).cast("long")).alias("row"),
        F.col(key).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    )
    sets = stored(_sketched(plain, words, bands))
    nodes = stored(
        sets.where("n > 0").groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    )
    rows = sets.where("n > 0").select(F.explode("keys").alias("key"), "node")
    groups = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = stored(rows.join(groups, "key").distinct())
    stars = members.select("node", F.explode(F.array("low", "high")).alias("center")).where("node <> center")
    stars = stars.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()
    texts = plain.select("row", "text")
    links = _linked(_open_pairs(stars, nodes, percent), texts, nodes, words, percent)
    parts = components(links)

    labelled = members.select("key", "node").join(parts, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("crowd"))
        .where("least < most")
        .select("key", "crowd")
    )
    across = _across(labelled.join(mixed, "key").join(nodes.select("node", "n", "sketch"), "node"), percent)
    links = links.union(_linked(stored(across), texts, nodes, words, percent))
    parts = components(links)

    named = sets.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    smallest = named.where("n > 0").groupBy("part").agg(F.min(F.struct(F.isnull("doc_id").alias("no_key"), "doc_id", "row")).alias("smallest"))
    return named.join(smallest, "part", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "row",
        F.when(F.col("n") > 0, F.col("smallest.row")).otherwise(F.col("row")).alias("component_row"),
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest key; of repeated rows, and of rows of one key
    with equal texts, one stays. Texts without words, empty and null ones among them, stay unless the row is repeated. A
    null key counts as greater than any other. An empty table stays empty; other columns stay, whatever their names."""
    found = stored(near_duplicates(docs, words, percent, key, text).select("row", "component_row"))
    gone = found.where("row <> component_row").select("row").distinct()
    twice = stored(found.where("row = component_row").groupBy("row").count().where("count > 1").select("row"))
    plain = numbered_columns(docs)
    place = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    marked = plain.withColumn("__row", F.xxhash64(place[text].cast("string"), place[key].cast("long")))
    rows = twice.withColumnRenamed("row", "__row")
    single = among(marked, stored(gone.union(twice)).withColumnRenamed("row", "__row"), "__row", "left_anti")
    return single.unionByName(among(marked, rows, "__row").dropDuplicates(["__row"])).drop("__row").toDF(*docs.columns)

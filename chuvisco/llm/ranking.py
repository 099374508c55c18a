"""Ranked lexical search: the documents of highest score for each item, by ball trees over sparse vectors."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chuvisco.llm.shared import flat, slices, stored

#: Documents of a tree and of one of its leaves.
SHARD, LEAF = 4096, 32
#: Terms that the items of a block have together, more or less; documents are gone through once a block.
BLOCK_TERMS = 1 << 14
#: Parts in which an item's best documents are brought together first.
PARTS = 64
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20

# Bytes of a term, letters in lower case; all others part terms.
_KEPT = bytes(b for b in range(256) if chr(b).isalnum() or b >= 128)
_CUT = bytes(ord(" ") if b not in _KEPT else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, about a megabyte of it at a time."""
    begin = 0
    while begin < len(text):
        end = begin + PIECE
        piece = text[begin:end].translate(_CUT)
        while end < len(text) and piece[-1:] != b" ":  # up to the end of the term
            more = text[end : end + PIECE].translate(_CUT)
            gap = more.find(b" ") + 1 or len(more)
            piece, end = piece + more[:gap], end + gap
        yield piece.split()
        begin = end


class BallTree:
    """A tree over sparse vectors of non-negative integers, none of them empty: vector ``i`` has ``values`` at ``terms``
    from ``starts[i]`` to ``starts[i + 1]``. A node has the mean of its vectors and the radius of a ball around it that
    holds them all, or more tightly what of them goes beyond the mean: a query has no negative weights, so where a vector
    falls short of the mean, it scores no more than the mean.

    Bounds are worked out in doubles. What rounding can take from sums of so many terms that are not negative is far
    below the billionth part that is added, so no bound is too low.
    """

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, leaf: int = LEAF) -> None:
        self.starts, self.terms, self.values, self.leaf = starts, terms, values, leaf
        self.squares = np.add.reduceat(values.astype(float) ** 2, starts[:-1])
        self.nodes: list[tuple] = []  # terms and values of the mean, radius, children or first and last place
        order: list[np.ndarray] = []
        self._grow(np.arange(len(starts) - 1), order, 0)
        self.order = np.concatenate(order)
        at, sizes = self._places(self.order)
        self.terms, self.values = terms[at], values[at]
        self.starts = np.concatenate(([0], np.cumsum(sizes)))

    def _places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.starts[rows + 1] - self.starts[rows]
        begin = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.starts[rows] - begin, sizes), sizes

    def _grow(self, rows: np.ndarray, order: list[np.ndarray], place: int) -> int:
        at, sizes = self._places(rows)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        held, column = np.unique(self.terms[at], return_inverse=True)
        values, squares = self.values[at].astype(float), self.squares[rows]

        def apart(vector: np.ndarray, square: float) -> np.ndarray:
            return squares + square - 2 * np.add.reduceat(values * vector[column], begin)

        def other(i: int) -> np.ndarray:
            vector = np.zeros(len(held))
            vector[column[begin[i] : ends[i]]] = values[begin[i] : ends[i]]
            return apart(vector, squares[i])

        mean = np.bincount(column, values) / len(rows)
        beyond = np.maximum(values - mean[column], 0)
        radius = math.sqrt(float(np.add.reduceat(beyond * beyond, begin).max()))
        me = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= self.leaf:
            order.append(rows)
            self.nodes[me] = (held, mean, radius, None, place, place + len(rows))
            return me
        near = other(int(apart(mean, float(mean @ mean)).argmax()))
        far = other(int(near.argmax()))
        split = rows[np.argsort(near - far, kind="stable")]
        middle = len(rows) // 2
        left = self._grow(split[:middle], order, place)
        right = self._grow(split[middle:], order, place + middle)
        self.nodes[me] = (held, mean, radius, (left, right), place, place + len(rows))
        return me

    def bound(self, node: int, weights: np.ndarray) -> float:
        """At least the inner product of any vector of ``node`` with ``weights``, of which those of terms that the node's
        vectors have play a part: the product with the mean, and what a vector of the radius' length can add."""
        held, mean, radius = self.nodes[node][:3]
        own = weights[held].astype(float)
        return (float(own @ mean) + math.sqrt(float(own @ own)) * radius) * (1 + 1e-9) + 1

    def search(self, weights: np.ndarray, keys: np.ndarray, best: list[tuple[int, int]], most: int) -> int:
        """Put the vectors of highest inner product with ``weights`` among ``best``, a heap of pairs of score and negated
        key; the number of vectors looked at. Nodes are taken by their bounds, the highest first, and left out where
        the bound is below the score of the last one of a full heap; the exact score is made of integers."""
        looked = 0
        queue = [(-self.bound(0, weights), 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if len(best) == most and -bound < best[0][0]:
                break
            *_, children, first, last = self.nodes[node]
            if children:
                for child in children:
                    above = min(self.bound(child, weights), -bound)
                    if len(best) < most or above >= best[0][0]:
                        heapq.heappush(queue, (-above, child))
                continue
            a, b = self.starts[first], self.starts[last]
            scores = np.add.reduceat(weights[self.terms[a:b]] * self.values[a:b], self.starts[first:last] - a)
            looked += last - first
            for row in np.flatnonzero(scores >= max(1, best[0][0] if len(best) == most else 1)):
                pair = int(scores[row]), -int(keys[self.order[first + row]])
                if len(best) < most:
                    heapq.heappush(best, pair)
                else:
                    heapq.heappushpop(best, pair)
        return looked


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])


def _counted(numbers: dict[bytes, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the number of their terms and the counts of those that ``numbers`` has."""
    for batch in slices(batches):
        data, starts = flat(batch.column("text"))
        sizes, terms, tfs = [], [], []
        for a, b in zip(starts[:-1], starts[1:]):
            counts: Counter = Counter()
            for piece in terms_of(data[a:b].tobytes()):
                counts.update(piece)
            found = sorted((numbers[t], c) for t, c in counts.items() if t in numbers)
            sizes.append(counts.total())
            terms.append([t for t, _ in found])
            tfs.append([c for _, c in found])
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, _COUNTS.field(2).type), pa.array(tfs, _COUNTS.field(3).type)]
        yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's occurrences in a document count, before the term's weight; ``m`` follows from the document's length."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _best(
    items: list[tuple[int, np.ndarray, np.ndarray]], width: int, n_docs: int, total: int, most: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each item; trees are built one after another and share each item's last score."""
    best: list[list[tuple[int, int]]] = [[] for _ in items]
    weights = np.zeros(width, np.int64)

    def searched(held: list[pa.RecordBatch]) -> None:
        shard = pa.Table.from_batches(held).combine_chunks()
        terms, tfs = (shard.column(c).combine_chunks() for c in ("terms", "tfs"))
        starts = terms.offsets.to_numpy().astype(np.int64)
        lengths = np.array([10 + 90 * n * n_docs // total for n in shard.column("n").to_pylist()], np.int64)
        values = saturated(tfs.flatten().to_numpy(), np.repeat(lengths, np.diff(starts)))
        tree = BallTree(starts - starts[0], terms.flatten().to_numpy(), values)
        keys = shard.column("doc_id").to_numpy()
        for (_, places, own), heap in zip(items, best, strict=True):
            weights[places] = own
            tree.search(weights, keys, heap, most)
            weights[places] = 0

    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            taken = batch.slice(0, SHARD - sum(b.num_rows for b in held))
            held.append(taken)
            batch = batch.slice(taken.num_rows)
            if sum(b.num_rows for b in held) == SHARD:
                searched(held)
                held = []
    if held:
        searched(held)
    rows = [(item, -key, score) for (item, *_), heap in zip(items, best, strict=True) for score, key in heap]
    columns = zip(*rows) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, starts = flat(batch.column("text"))
        items, terms = [], []
        for item, a, b in zip(batch.column("item").to_pylist(), starts[:-1], starts[1:]):
            own = sorted({t for piece in terms_of(data[a:b].tobytes()) for t in piece})
            items += [item] * len(own)
            terms += own
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(terms, pa.binary())], ["item", "term"])


def _block(docs: DataFrame, wanted: Sequence, most: int) -> DataFrame | None:
    numbers = {term: i for i, term in enumerate(sorted({bytes(r.term) for r in wanted}))}
    counts = stored(docs.mapInArrow(partial(_counted, numbers), "doc_id long, n long, terms array<int>, tfs array<long>"))
    n_docs, total = counts.filter(F.col("n") > 0).agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    holding = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # the block's terms at most
    logs = np.zeros(len(numbers), np.int64)
    for r in holding:
        logs[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    places: dict[int, list[int]] = {}
    for r in wanted:
        places.setdefault(r.item, []).append(numbers[bytes(r.term)])
    items = [(item, np.array(own), logs[own]) for item, own in places.items()]
    able = counts.filter((F.size("terms") > 0) & F.col("doc_id").isNotNull())
    return able.mapInArrow(partial(_best, items, len(numbers), n_docs, total, most), "item long, doc_id long, score long")


def rank_documents(
    docs: DataFrame,
    queries: DataFrame,
    most: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``most`` documents of highest score above 0 for each item: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``;
    equal scores by ascending key.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case. A term's weight follows
    from the number of documents that hold it; its occurrences count less and less, and less in longer documents; all but
    the weight's logarithm is integer arithmetic. A score is the inner product of item and document.

    A null or empty text has no terms: such a document is not counted, such an item has no rows. A document without key
    counts in the statistics and is no result; rows that repeat a key are documents of their own, and may follow one
    another. Equal items are one; items that share an id but not the text are ranked each by itself. Empty tables give
    no rows, other columns take no part.

    Items come in blocks of about ``block_terms`` terms, whose terms go to all tasks. For a block, texts are read
    once and kept as counts of its terms; then tasks build trees of 4,096 documents and keep the best of each item. What is
    shuffled are those and, once per task, the number of documents of each term.
    """
    asked = queries.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = stored(asked.filter(F.col("text").isNotNull()).distinct().withColumn("item", F.monotonically_increasing_id()))
    terms = stored(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary"))
    blocks = max(1, -(-terms.count() // block_terms))
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = []
    for i in range(blocks):
        wanted = terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).collect()
        found = _block(texts, wanted, most) if wanted else None
        if found is not None:
            parts.append(stored(found))
    if not parts:
        return asked.limit(0).select("item_id", F.lit(1).alias("rank"), F.col("item").alias("doc_id"), F.col("item").alias("score"))
    order = (F.desc("score"), F.asc("doc_id"))
    found = reduce(DataFrame.unionAll, parts).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for by in (("item", "part"), ("item",)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= most)
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

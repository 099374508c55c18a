"""Exact search for the largest inner products, by ball trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chuvisco.llm.shared import stored

#: Vectors of a shard and of a leaf.
SHARD, LEAF = 8192, 64
#: Queries and their components that go to all tasks together (32 MB at most).
ASKED, SENT = 1 << 16, 1 << 22
#: Shards of the first wave, and how many times as many have been searched after each further one.
FIRST, GROWTH = 8, 4


@dataclass
class BallTree:
    """Nodes in order of their making: ``left[i]`` and ``left[i] + 1`` are the children of node i, -1 at a leaf, which
    holds the vectors ``begin[i] .. end[i]``; all of a node's vectors lie within ``radius`` of ``center``."""

    ids: np.ndarray
    vectors: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    left: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @staticmethod
    def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> BallTree:
        order = np.lexsort((ids,))
        real = vectors.astype(float)
        center, radius, left, begin, end = [], [], [], [], []

        def node(a: int, b: int) -> None:
            held = real[order[a:b]]
            middle = held.mean(axis=0)
            center.append(middle)
            radius.append(np.sqrt(((held - middle) ** 2).sum(axis=1).max()))
            left.append(-1)
            begin.append(a)
            end.append(b)

        node(0, len(ids))
        i = 0
        while i < len(left):
            a, b = begin[i], end[i]
            if b - a > leaf and radius[i] > 0:
                # part by the nearer of two far points: the one farthest from the centre, and the one farthest from that
                held = real[order[a:b]]
                one = held[np.argmax(((held - center[i]) ** 2).sum(axis=1))]
                away = ((held - one) ** 2).sum(axis=1)
                other = held[np.argmax(away)]
                nearer = away <= ((held - other) ** 2).sum(axis=1)
                if nearer.all():
                    nearer = np.arange(b - a) < (b - a) // 2
                order[a:b] = np.r_[order[a:b][nearer], order[a:b][~nearer]]
                left[i] = len(left)
                cut = a + int(nearer.sum())
                node(a, cut)
                node(cut, b)
            i += 1
        made = (np.array(x) for x in (center, radius, left, begin, end))
        return BallTree(ids[order], vectors[order], *made)

    def reach(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node what no product with a vector of the node exceeds: ``query . center + |query| radius``.

        These are real numbers and products whole ones, so each is taken half a unit too large, and a little for rounding.
        """
        lengths = np.sqrt((queries * queries).sum(axis=1))
        bounds = queries @ self.center.T + lengths[:, None] * self.radius
        return bounds + 0.5 + 1e-9 * (np.abs(bounds) + lengths[:, None] * np.sqrt((self.center**2).sum(axis=1)))

    def search(
        self, query: np.ndarray, own: int, best: list[tuple[int, int]], k: int, reach: np.ndarray, floor: tuple[int, int] | None = None
    ) -> int:
        """Puts into ``best``, a heap of ``(score, -id)``, what belongs among the ``k`` best ids and above ``floor``, and
        returns how many vectors were looked at.

        Nodes are taken in descending order of ``reach``, until it is below the k-th score so far or that of the floor.
        An id that several vectors have counts with its best.
        """
        seen = 0
        least = _least(best, k, floor)
        queue = [(-reach[0], 0)]
        while queue:
            bound, i = heapq.heappop(queue)
            if least is not None and -bound < least[0]:
                break
            child = self.left[i]
            if child >= 0:
                for c in (child, child + 1):
                    if least is None or reach[c] >= least[0]:
                        heapq.heappush(queue, (-reach[c], int(c)))
                continue
            a, b = self.begin[i], self.end[i]
            seen += b - a
            scores = self.vectors[a:b] @ query
            among = range(b - a) if least is None else np.flatnonzero(scores >= least[0]).tolist()
            for j in among:
                found = (int(scores[j]), -int(self.ids[a + j]))
                if -found[1] == own or (least is not None and found <= least):
                    continue
                same = next((n for n, (_, other) in enumerate(best) if other == found[1]), None)
                if same is not None:
                    if found > best[same]:
                        best[same] = found
                        heapq.heapify(best)
                elif len(best) < k:
                    heapq.heappush(best, found)
                else:
                    heapq.heapreplace(best, found)
                least = _least(best, k, floor)
        return seen


def _least(best: list[tuple[int, int]], k: int, floor: tuple[int, int] | None) -> tuple[int, int] | None:
    """What a find has to exceed."""
    if len(best) < k:
        return floor
    return best[0] if floor is None else max(best[0], floor)


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``(vec_id, dim, vector)`` of vectors without null or non-finite components, each made ``floor(scale * x)``."""
    held = F.col(vector).cast("array<double>")
    whole = F.transform(held, lambda x: F.floor(x * F.lit(float(scale))))
    proper = held.isNotNull() & (F.size(held) > 0) & F.forall(held, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col(key).isNotNull() & F.coalesce(proper, F.lit(False))).select(
        F.col(key).cast("long").alias("vec_id"), F.size(held).alias("dim"), whole.alias("vector")
    )


def _shards(vectors: DataFrame, counts: dict[int, int]) -> DataFrame:
    """A row ``(dim, shard, ids, vectors)`` for each shard of about ``SHARD`` vectors of one dimension."""
    shards = F.create_map(*[F.lit(x) for dim, n in counts.items() for x in (dim, -(-n // SHARD))])
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.hash("vector")), shards[F.col("dim")]).cast("int"))
    return dealt.groupBy("dim", "shard").agg(F.collect_list(F.struct("vec_id", "vector")).alias("held")).select(
        "dim", "shard", F.col("held.vec_id").alias("ids"), F.col("held.vector").alias("vectors")
    )


def _rounds(asked: dict[int, int]) -> list[list[tuple[int, int, int]]]:
    """Parts ``(dim, part, parts)`` of the queries of each dimension, put together up to ``ASKED`` queries of ``SENT`` components."""
    rounds: list[list[tuple[int, int, int]]] = []
    room = 0.0
    for dim, n in sorted(asked.items()):
        parts = -(-n // max(1, min(ASKED, SENT // dim)))
        for part in range(parts):
            share = n / parts / max(1, min(ASKED, SENT // dim))
            if share > room:
                rounds.append([])
                room = 1.0
            rounds[-1].append((dim, part, parts))
            room -= share
    return rounds


def _waves(shards: int) -> Iterator[tuple[int, int]]:
    """Stretches of shards, each so large that ``GROWTH`` times as many have been searched after it."""
    low, high = 0, FIRST
    while low < shards:
        yield low, min(high, shards)
        low, high = high, high * GROWTH


def top_products(
    rows: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each vector whose key is divisible by ``every`` the ``k`` vectors of
    other keys with the largest integer inner products, equal ones by smaller key.

    Rows with a null key and vectors that are null, empty or hold null or non-finite components take no part; vectors
    meet those of their own dimension alone. A repeated row is one vector; if a key has several vectors, each is a
    query of its own rank order merged with the others, and the best score of a key counts. Scores must fit in 63 bits.

    Vectors are dealt into shards of ``SHARD``, each a ball tree that one task builds and holds; queries come to it, up to
    ``ASKED`` at a time. Shards are searched in waves, the first of ``FIRST``, and after each ``GROWTH`` times as many
    have been searched. Every search starts with the k-th find of all waves before, and only finds above it leave a task.
    As the shards of a wave are dealt by hash, a query has about ``k * GROWTH`` such finds in a wave, however many
    shards there are.
    """
    spark = rows.sparkSession
    vectors = stored(whole_vectors(rows, key, vector, scale).distinct())
    queried = F.col("vec_id") % every == 0
    sizes = vectors.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(queried).alias("asked")).collect()
    counts = {r.dim: r.n for r in sizes}
    rounds = _rounds({r.dim: r.asked for r in sizes if r.asked})
    if not rounds:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = stored(_shards(vectors, counts))
    found: list[DataFrame] = []
    for parts in rounds:
        dims = [dim for dim, _, _ in parts]
        sent = _queries(vectors.where(queried), parts)
        floors: dict[tuple[int, int], tuple[int, int]] = {}
        finds: list[DataFrame] = []
        waves = list(_waves(max(-(-counts[dim] // SHARD) for dim in dims)))
        for low, high in waves:
            held = shards.where(F.col("dim").isin(dims) & F.col("shard").between(low, high - 1))
            tasks = min(len(dims) * (high - low), 4 * spark.sparkContext.defaultParallelism)
            told = spark.sparkContext.broadcast((sent, floors))
            dealt = held.repartition(tasks, "dim", "shard")
            finds.append(stored(dealt.mapInArrow(_searcher(told, k), "dim int, query int, query_id long, vec_id long, score long")))
            told.unpersist()
            if high < waves[-1][1]:
                best = _best(reduce(DataFrame.unionAll, finds), ["dim", "query"]).where(F.col("rank") == k)
                floors = {(r.dim, r.query): (r.score, -r.vec_id) for r in best.collect()}
        found += finds
    ranked = _best(reduce(DataFrame.unionAll, found), ["query_id"])
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(finds: DataFrame, query: list[str]) -> DataFrame:
    """The finds of each query, once each with the best score, and their rank."""
    order = Window.partitionBy(*query).orderBy(F.desc("score"), "vec_id")
    return finds.groupBy(*query, "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))


def _queries(queries: DataFrame, parts: list[tuple[int, int, int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Keys and vectors of a round's queries, which are of bounded number and size, per dimension."""
    among = reduce(
        lambda a, b: a | b,
        [(F.col("dim") == dim) & (F.pmod(F.xxhash64("vec_id", F.hash("vector")), F.lit(parts)) == part) for dim, part, parts in parts],
    )
    out = {}
    rows = queries.where(among).toArrow()
    for dim in dict.fromkeys(d for d, _, _ in parts):
        held = rows.filter(pc.equal(rows["dim"], dim)).combine_chunks()
        if held.num_rows:
            values = held["vector"].combine_chunks().flatten() if held["vector"].num_chunks else pa.array([], pa.int64())
            out[dim] = (held["vec_id"].to_numpy(), values.to_numpy(zero_copy_only=False).reshape(-1, dim))
    return out


def _searcher(told, k: int):
    """Searches shard after shard with all queries of the round; finds are handed on at the end of the task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, floors = told.value
        state: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, vectors = (batch.column(n)[i] for n in ("dim", "ids", "vectors"))
                dim = dim.as_py()
                if dim not in sent:
                    continue
                owns, queries = sent[dim]
                held = np.array(vectors.values.flatten(), np.int64).reshape(-1, dim)
                # products below 2**53 are exact as doubles, which multiply faster
                exact = float(np.abs(held.astype(float)).max()) * float(np.abs(queries.astype(float)).max()) * dim < 2.0**53
                tree = BallTree.build(np.array(ids.values), held.astype(float) if exact else held)
                for begin in range(0, len(owns), 256):
                    block = queries[begin : begin + 256]
                    asked = block.astype(float)
                    for j, reach in enumerate(tree.reach(asked)):
                        at = (dim, begin + j)
                        best = state.get(at, [])
                        tree.search(asked[j] if exact else block[j], int(owns[begin + j]), best, k, reach, floors.get(at))
                        if best:
                            state[at] = best
        found = [(dim, j, int(sent[dim][0][j]), -neg, score) for (dim, j), best in state.items() for score, neg in best]
        for begin in range(0, len(found), 1 << 16):
            columns = zip(*found[begin : begin + (1 << 16)], strict=True)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["dim", "query", "query_id", "vec_id", "score"]
            )

    return search

"""Packing documents into sequences of bounded length by linear grouping, then best fit."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chuvisco.llm.shared import flat, slices, stored, table, texts_of
from chuvisco.llm.units import encode

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int32()),
        ("place", pa.int64()),
    ]
)


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str, text: str) -> DataFrame:
    """Each document's ids and ``end_id``, cut from the end into pieces of ``capacity``; the first may be shorter.

    ``place`` counts the pieces of one length that a task has made before, ``part`` is the task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), defaultdict(int)
        for batch in slices(batches):
            data, starts = flat(batch.column("text"))
            ids, bounds = encode(tokenizer, data, starts)
            rows = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                whole = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                n, begin = len(whole), 0
                for piece in range(-(-n // capacity)):
                    size = (n - 1) % capacity + 1 if piece == 0 else capacity
                    rows.append((doc, piece, begin, size, zlib.crc32(whole[begin : begin + size]), part, made[size]))
                    made[size] += 1
                    begin += size
            yield table(_PIECES, **dict(zip(_PIECES.names, zip(*rows, strict=True), strict=True)))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
    return texts_of(docs, key, text).mapInArrow(cut, schema)


def configurations(sizes: np.ndarray, wanted: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Few-size cutting stock: how often to use which multiset of sizes, whole numbers rounded down.

    The linear programme over all configurations is solved by column generation: the dual prices of the sizes give a
    knapsack problem, whose best filling enters the basis as long as it is worth more than one sequence.
    """
    m = len(sizes)
    columns = [np.eye(m, dtype=np.int64)[i] * (capacity // sizes[i]) for i in range(m)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    amount = wanted * np.diag(inverse)
    for _ in range(40 * m):
        price = inverse.sum(axis=0)
        filling = _knapsack(sizes, price, capacity)
        if price @ filling <= 1 + TOL:
            break
        direction = inverse @ filling
        usable = direction > 1e-9
        if not usable.any():
            break
        ratio = np.where(usable, amount / np.where(usable, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        step = ratio[out]
        amount = np.maximum(amount - step * direction, 0)
        amount[out] = step
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        columns[out] = filling
    return [(c, int(a + 1e-6)) for c, a in zip(columns, amount, strict=True) if a >= 1 - 1e-6]


def _knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size fill ``capacity`` at the highest price."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, s in enumerate(sizes):
        if price[i] <= 0:
            continue
        for _ in range(capacity // s):
            value = best[:-s] + price[i]
            better = value > best[s:] + 1e-12
            if not better.any():
                break
            best[s:][better] = value[better]
            last[s:][better] = i
    return _refill(sizes, price, capacity, best)


def _refill(sizes: np.ndarray, price: np.ndarray, capacity: int, best: np.ndarray) -> np.ndarray:
    taken, room = np.zeros(len(sizes), np.int64), capacity
    while best[room] > 1e-12:
        fits = np.flatnonzero(sizes <= room)
        gain = price[fits] + best[room - sizes[fits]]
        i = fits[int(np.argmax(gain))]
        taken[i] += 1
        room -= sizes[i]
    return taken


#: A configuration enters while it is worth this much more than one sequence; finer steps cost more than they save.
TOL = 1e-2


class _Plan:
    """Slots for runs of pieces of one length. A run's sequences are filled alike, so the plan stays small however many
    pieces there are: its size depends on the capacity and the number of groups alone."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences, self.rows, self.used = capacity, 0, [], defaultdict(int)
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room -> (first sequence, how many)

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def put(self, length: int, n: int, first: int, each: int, offset: int) -> None:
        self.rows.append((length, self.used[length], n, first, each, offset))
        self.used[length] += n

    def best_fit(self, length: int, n: int) -> None:
        """``n`` pieces go where the least room is left that takes them, then into new sequences."""
        while n:
            rooms = [r for r, runs in self.open.items() if runs and r >= length]
            if not rooms:
                need = -(-n // (self.capacity // length))
                self.open[self.capacity].append((self.new(need), need))
                continue
            room = min(rooms)
            first, have = self.open[room].pop()
            each = min(room // length, n)
            take = min(have, n // each)
            if take < have:
                self.open[room].append((first + take, have - take))
            self.put(length, take * each, first, each, self.capacity - room)
            self.open[room - each * length].append((first, take))
            n -= take * each


def pack(counts: dict[int, int], capacity: int = 1024, groups: int = 500, small: int = 340) -> list[tuple]:
    """Slots ``(length, place, n, sequence, each, offset)``: pieces ``place .. place + n - 1`` of a length, ``each`` of
    them one after another from ``offset`` on, in sequences from ``sequence`` on.

    Lengths of ``small`` or more are sorted and dealt into ``groups`` groups of equal cardinality; all of a group count
    as long as its longest, so that few sizes are left to find configurations for. Real pieces then take the places of
    the rounded ones; what configurations leave over and the small ones go where they fit best.
    """
    plan = _Plan(capacity)
    left = {n: c for n, c in counts.items() if c}
    if whole := left.pop(capacity, 0):
        plan.put(capacity, whole, plan.new(whole), 1, 0)
    large = [[n, left[n]] for n in sorted(left, reverse=True) if n >= small]
    if large:
        total = sum(c for _, c in large)
        share = -(-total // groups)
        queues: list[list[list[int]]] = [[]]
        room = share
        for n, c in large:
            if 2 * c >= share:  # as many as half a group: a size of its own
                queues += [[[n, c]], []]
                room = share
                continue
            while c:
                if not room:
                    queues.append([])
                    room = share
                take = min(c, room)
                queues[-1].append([n, take])
                c, room = c - take, room - take
        queues = [q for q in queues if q]
        sizes = np.array([q[0][0] for q in queues])
        wanted = np.array([sum(c for _, c in q) for q in queues], float)
        for filling, times in configurations(sizes, wanted, capacity):
            _substitute(plan, queues, [g for g in np.flatnonzero(filling) for _ in range(filling[g])], times)
        left |= dict.fromkeys((n for n, _ in large), 0)
        for n, c in (head for q in queues for head in q):
            left[n] += c
    for n in sorted(left, reverse=True):
        plan.best_fit(n, left[n])
    return plan.rows


def _substitute(plan: _Plan, queues: list, slots: list[int], times: int) -> None:
    """Real pieces, longest first, take the places that a configuration holds for their groups."""
    while times:
        heads = [queues[g] for g in slots]
        if not all(heads):
            return
        shared = {g: slots.count(g) for g in slots}
        run = min(times, *(queues[g][0][1] // k for g, k in shared.items()))
        single = run == 0  # some group's longest length has too few pieces left for all slots of one sequence
        run = 1 if single else run
        if single and any(sum(c for _, c in queues[g]) < k for g, k in shared.items()):
            return
        first, offset = plan.new(run), 0
        for g in slots:
            n = queues[g][0][0]
            plan.put(n, run, first, 1, offset)
            offset += n
            queues[g][0][1] -= run
            if not queues[g][0][1]:
                queues[g].pop(0)
        plan.open[plan.capacity - offset].append((first, run))
        times -= run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = 1024,
    groups: int = 500,
    small: int = 340,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Places of all pieces of all documents in sequences of ``capacity`` tokens.

    Null and empty texts have the end id alone; null or repeated keys are rows like any other; an empty table gives no
    rows; other columns are not looked at. Only counts by length (``capacity`` rows at most) go to the driver. Which
    piece of a length takes which slot follows from how many come before it: in its task, and in the tasks before.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, tokenizer, end_id, capacity, key, text))
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        pack(counts, capacity, groups, small),
        "size long, from_rank long, n long, first long, each long, at long",
    )
    before = by_part.selectExpr(
        "length",
        "part",
        "sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before",
    )
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.coalesce("before", F.lit(0)) + F.col("place"))
    # a bounded number of slots, whatever the number of pieces: see _Plan
    placed = ranked.join(
        F.broadcast(slots),
        (F.col("length") == F.col("size")) & F.expr("rank >= from_rank AND rank < from_rank + n"),
    )
    return placed.selectExpr(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        "first + (rank - from_rank) DIV each AS sequence_id",
        "at + (rank - from_rank) % each * length AS offset",
    )

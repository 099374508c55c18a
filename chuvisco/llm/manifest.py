"""A Merkle manifest of a table as a persistent tree: a changed leaf is a version that copies its ancestors alone."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chuvisco.llm.shared import stored

#: Nodes of a run, and levels of an aligned block, which has ``WAYS**DEEP`` leaves.
WAYS, DEEP = 3, 6

# Columns of a leaf, in the order in which they are hashed.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def height(count: int) -> int:
    """Levels from ``count`` nodes to one."""
    levels = 0
    while count > 1:
        count, levels = -(-count // WAYS), levels + 1
    return levels


def joined(digests: Sequence[bytes]) -> bytes:
    """Digest of a run, which is hashed as hex text."""
    return sha256("".join([d.hex() for d in digests]).encode()).digest()


class PersistentTree:
    """The nodes of one aligned block, ``levels[0]`` the lowest. They are made once and never changed: a version is the
    list of the nodes it copies, one per level, and shares all others."""

    def __init__(self, digests: list[bytes], levels: int) -> None:
        self.levels = [list(digests)]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([joined(below[i : i + WAYS]) for i in range(0, len(below), WAYS)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, i: int) -> tuple[bytes, bytes]:
        """For each level one byte, ``4 * width + slot`` of the run that node ``i`` or its ancestor stands in, and the
        digests of the run's other nodes, left to right."""
        slots, others = bytearray(), []
        for level in self.levels[:-1]:
            slot = i % WAYS
            run = level[i - slot : i - slot + WAYS]
            slots.append(4 * len(run) + slot)
            others += run[:slot] + run[slot + 1 :]
            i //= WAYS
        return bytes(slots), b"".join(others)

    def version(self, i: int, digest: bytes) -> list[bytes]:
        """The copies that a new node ``i`` makes necessary: itself, then its ancestors up to the block's root."""
        copies = [digest]
        for level in self.levels[:-1]:
            slot = i % WAYS
            copies.append(joined([*level[i - slot : i], copies[-1], *level[i + 1 : i - slot + WAYS]]))
            i //= WAYS
        return copies


def continued(digest: bytes, slots: bytes, siblings: bytes) -> list[bytes]:
    """The ancestors of ``digest`` along a path as :meth:`PersistentTree.path` gives it; the last is the root."""
    copies, at = [], 0
    for mark in slots:
        width, slot = divmod(mark, 4)
        others = [siblings[at + 32 * j : at + 32 * j + 32] for j in range(width - 1)]
        at += 32 * (width - 1)
        digest = joined([*others[:slot], digest, *others[slot:]])
        copies.append(digest)
    return copies


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of values one after another, each as its length in bytes, a colon and its text; of a null, ``-``."""
    texts = [v.cast("string") for v in values]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*sized), 256))


def numbered(rows: DataFrame, part: str, order: Sequence[str]) -> DataFrame:
    """``rows``, which are stored, with their place ``pos`` in their part by ``order`` and the part's size ``n``.

    Rows are dealt out in ranges of part and order, so a part of any size takes many tasks; what comes together for the
    places is one row per task and part. ``order`` must end in a column without ties, so that copies can be parted.
    """
    keys = (part, *order)
    ranged = stored(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("seq", F.monotonically_increasing_id())
    ).withColumn("task", F.shiftright("seq", 33))
    runs = ranged.groupBy(part, "task").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy(part)
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        part,
        "task",
        (F.col("first") - F.coalesce(F.sum("held").over(before), F.lit(0))).alias("_from"),
        F.sum("held").over(whole).alias("n"),
    )
    return ranged.join(offsets, [part, "task"]).withColumn("pos", F.col("seq") - F.col("_from")).drop("task", "seq", "_from")


def _blocks(nodes: DataFrame, carried: Sequence[str], deep: int) -> DataFrame:
    """A row for each aligned block of ``deep`` levels of a part's nodes, in the order of their places."""
    held = F.array_sort(F.collect_list(F.struct("pos", *carried)))
    block = F.floor(F.col("pos") / WAYS**deep).cast("long").alias("block")
    return nodes.groupBy("part", block).agg(F.first("n").alias("n"), held.alias("held"))


def _roots(deep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = [
            PersistentTree(digests, min(deep, height(n))).root
            for n, digests in zip(batch.column("n").to_pylist(), _lists(batch, "digest"), strict=True)
        ]
        sizes = [-(-n // WAYS**deep) for n in batch.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(roots, pa.binary())],
            ["part", "pos", "n", "digest"],
        )


def _lists(batch: pa.RecordBatch, name: str) -> Iterator[list]:
    held = batch.column("held")
    values = held.values.field(name)
    for a, b in zip(held.offsets.to_pylist(), held.offsets.to_pylist()[1:]):
        yield values.slice(a, b - a).to_pylist()


_PATHS = "part string, pos long, slots binary, siblings binary, subroot binary"
_VERSIONS = "doc_id long, leaf binary, slots binary, siblings binary, subroot binary, copies binary"


def _paths(deep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths of a tier's nodes: those in their block, then the block's own."""
    for batch in batches:
        rows = []
        upper = zip(*(batch.column(c).to_pylist() for c in ("part", "n", "slots", "siblings", "subroot")), strict=True)
        for (part, n, slots, siblings, subroot), digests, places in zip(upper, _lists(batch, "digest"), _lists(batch, "pos")):
            tree = PersistentTree(digests, min(deep, height(n)))
            for i, pos in enumerate(places):
                inner = tree.path(i)
                rows.append((part, pos, inner[0] + slots, inner[1] + siblings, subroot))
        yield _table(rows, [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], _PATHS)


def _versions(deep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The leaves of blocks with their paths and, for each, the version made by its change (or by itself): ancestors
    within the block are copied from the block's tree, those above it along the block's path."""
    for batch in batches:
        rows = []
        upper = zip(*(batch.column(c).to_pylist() for c in ("n", "slots", "siblings", "subroot")), strict=True)
        parts = zip(*(_lists(batch, c) for c in ("doc_id", "digest", "changed")), strict=True)
        for (n, slots, siblings, subroot), (ids, digests, changed) in zip(upper, parts, strict=True):
            tree = PersistentTree(digests, min(deep, height(n)))
            for i, (doc_id, digest, new) in enumerate(zip(ids, digests, changed, strict=True)):
                inner = tree.path(i)
                copies = tree.version(i, digest if new is None else new)
                copies += continued(copies[-1], slots, siblings)
                rows.append((doc_id, digest, inner[0] + slots, inner[1] + siblings, subroot, b"".join(copies)))
            if len(rows) >= 4096:
                yield _table(rows, [pa.int64(), *[pa.binary()] * 5], _VERSIONS)
                rows = []
        yield _table(rows, [pa.int64(), *[pa.binary()] * 5], _VERSIONS)


def _table(rows: list[tuple], types: list[pa.DataType], schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _tiers(leaves: DataFrame, carried: Sequence[str], deep: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each tier from the leaves up, and the node ``(part, digest)`` that is left of each part."""
    tiers: list[DataFrame] = []
    nodes, names = leaves, carried
    while True:
        tiers.append(stored(_blocks(nodes, names, deep)))
        most = tiers[-1].agg(F.max("n")).first()[0]
        nodes, names = tiers[-1].mapInArrow(partial(_roots, deep), "part string, pos long, n long, digest binary"), ("digest",)
        if most is None or most <= WAYS**deep:
            return tiers, stored(nodes.select("part", "digest"))


def _downwards(tiers: list[DataFrame], tops: DataFrame, deep: int) -> DataFrame:
    """Paths of the lowest tier's blocks, from those of each part's last node (``tops``) down."""
    paths = tops
    for blocks in reversed(tiers[1:]):
        paths = stored(_with_path(blocks, paths).mapInArrow(partial(_paths, deep), _PATHS))
    return paths


def _with_path(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.join(paths.withColumnRenamed("pos", "block"), ["part", "block"])


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = LEAF_COLUMNS,
    part: str = "source",
    key: str = "doc_id",
    change: Mapping[str, Column] | None = None,
    where: Column | None = None,
    deep: int = DEEP,
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``leaf``, ``subroot`` and ``root`` of the table as it is, its inclusion proof
    and the version of the tree that a change of this row alone makes.

    A leaf is the digest of ``columns``. Leaves of one ``part`` ascend by ``key``; runs of three become the digest of
    their nodes until one is left, and so do the parts' last nodes in the order of the parts. ``siblings`` holds the
    other digests of each run on the way to the root, 32 bytes each, and ``slots`` a byte for each run
    (:meth:`PersistentTree.path`). Where ``where`` holds, ``change`` gives other values for columns; ``copies`` holds
    the digests that this version copies, from the leaf to its root, the last 32 bytes. Elsewhere they are the way
    from the leaf itself to the root.

    A null is hashed as ``-``, an empty text as ``0:``. A null part is one part, the first; null keys come first in a
    part, and rows of one key are ordered by leaf, so that equal rows have equal places but for their order. Other
    columns take no part. A null ``where`` is false. No rows give none.

    A part is cut into aligned blocks of ``3**deep`` leaves (729), whose roots are the nodes of the next tier, and so on, so that a
    part with most rows takes as many tasks as others. A block's siblings up to the root come to it in one row, and the
    versions of its leaves are continued there.
    """
    given = [F.col(c) for c in columns]
    altered = [(change or {}).get(c, F.col(c)) for c in columns]
    digest = leaf_digest(given)
    new = F.when(F.lit(False) if where is None else where, leaf_digest(altered))
    leaves = stored(
        docs.select(
            F.when(F.col(part).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(part).cast("string"))).alias("part"),
            F.col(key).cast("long").alias("doc_id"),
            digest.alias("digest"),
            new.alias("changed"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    placed = numbered(leaves, "part", ("doc_id", "digest", "row"))
    tiers, subroots = _tiers(placed, ("doc_id", "digest", "changed"), deep)
    parts = numbered(subroots.withColumn("all", F.lit("")), "all", ("part",))
    named = parts.select(F.col("all").alias("part"), F.col("part").alias("name"), "pos", "n", "digest")
    upper, root = _tiers(named, ("name", "digest"), deep)
    nothing = F.lit(b"")
    ends = [nothing.alias(c) for c in ("slots", "siblings", "subroot")]
    top = root.select("part", F.lit(0).cast("long").alias("pos"), *ends)
    ways = _with_path(upper[0], _downwards(upper, top, deep))
    tops = stored(ways.mapInArrow(partial(_named_paths, deep), _PATHS))
    found = _with_path(tiers[0], _downwards(tiers, tops, deep)).mapInArrow(partial(_versions, deep), _VERSIONS)
    whole = root.select("digest").first()
    return found.withColumn("root", F.lit(bytes(whole.digest) if whole else b""))


def _named_paths(deep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths of the parts' last nodes to the root, each under the name of its part and with its digest."""
    for batch in batches:
        rows = []
        upper = zip(*(batch.column(c).to_pylist() for c in ("n", "slots", "siblings")), strict=True)
        for (n, slots, siblings), digests, names in zip(upper, _lists(batch, "digest"), _lists(batch, "name"), strict=True):
            tree = PersistentTree(digests, min(deep, height(n)))
            for i, name in enumerate(names):
                inner = tree.path(i)
                rows.append((name, 0, inner[0] + slots, inner[1] + siblings, digests[i]))
        yield _table(rows, [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], _PATHS)


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def audit(docs: DataFrame, deep: int = DEEP) -> DataFrame:
    """The manifest of ``docs`` and what comes of deleting the line ends of texts whose key has an even CRC-32, one text
    at a time: the root recomputed along the proof and whether it still is the manifest's."""
    drawn = F.crc32(F.col("doc_id").cast("long").cast("string")) % 2 == 0
    found = manifest(docs, change={"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}, where=drawn, deep=deep)
    folded = F.expr("substring(copies, -32)")
    return found.select(
        "doc_id",
        hex_of(F.col("leaf")).alias("leaf"),
        hex_of(F.col("subroot")).alias("subroot"),
        hex_of(F.col("root")).alias("root"),
        F.sha2(hex_of(F.col("siblings")), 256).alias("proof_sha256"),
        hex_of(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )

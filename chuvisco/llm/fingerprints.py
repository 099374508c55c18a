"""Fingerprints of texts by context-triggered piecewise hashing, and how alike two are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chuvisco.llm.shared import slices, stretch_hashes, table

#: Smallest block size, characters of a signature, and bytes that decide on a boundary.
LEAST, LENGTH, WINDOW = 3, 64, 7
#: Characters that two signatures must have in common for any likeness.
COMMON = 7
_CHARACTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BASE = 0x9E3779B97F4A7C15


def fingerprints(texts: list[bytes]) -> list[str]:
    """``block size:signature:signature at twice the block size`` for each text.

    A hash of the last seven bytes ends a piece where it leaves the remainder block size - 1 modulo the block size, so
    boundaries move with their surroundings. Each piece gives one character. The block size is three times a power of
    two: the largest at which about ``LENGTH`` pieces are expected, halved while there are fewer than half as many.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    rolled = np.zeros(len(data), np.uint32)
    for i in range(min(WINDOW, len(data))):
        rolled[i:] += (data[: len(data) - i].astype(np.uint32) + np.uint32(i + 1)) * np.uint32(pow(2654435761, i + 1, 1 << 32))
    rolled ^= rolled >> np.uint32(15)
    rolled = rolled * np.uint32(0x2C1B3C6D) + np.uint32(1)
    piece = stretch_hashes(data, _BASE)
    return [_one(rolled, piece, a, b) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def _one(rolled: np.ndarray, piece, start: int, end: int) -> str:
    size = end - start
    if not size:
        return f"{LEAST}::"
    power = max(0, int(np.ceil(np.log2(size / (LEAST * LENGTH)))))
    own = rolled[start + WINDOW - 1 : end]
    while True:
        at = np.flatnonzero((own & np.uint32((1 << power) - 1)) == 0)
        at = at[own[at] % LEAST == 0]
        if len(at) >= LENGTH // 2 or not power:
            break
        power -= 1
    double = at[own[at] & np.uint32(1 << power) == 0]
    shift = start + WINDOW
    return f"{LEAST << power}:{_signature(piece, at + shift, start, end, LENGTH)}:{_signature(piece, double + shift, start, end, LENGTH // 2)}"


def _signature(piece, ends: np.ndarray, start: int, end: int, length: int) -> str:
    """A character for each piece; the last one takes in all that is left."""
    ends = np.append(ends[ends < end][: length - 1], end)
    begins = np.append(start, ends[:-1])
    hashed = piece(begins, ends) * np.uint64(0xBF58476D1CE4E5B9)
    return _CHARACTERS[(hashed >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: equal fingerprints 1; else by the edit distance of signatures at one block size, 0 if there is none or
    the signatures have no stretch of seven characters in common. Runs of a character count three at most."""

    def part(of: Column, i: int) -> Column:
        return F.split_part(of, F.lit(":"), F.lit(i))

    def score(a: Column, b: Column) -> Column:
        a, b = (F.regexp_replace(x, r"(.)\1{3,}", "$1$1$1") for x in (a, b))
        longest, shortest = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
        windows = F.sequence(F.lit(1), F.greatest(F.length(a) - COMMON + 1, F.lit(1)))
        shared = F.exists(windows, lambda i: F.contains(b, F.substring(a, i, F.lit(COMMON))))
        alike = 1 - F.levenshtein(a, b) / longest
        return F.when(longest == 0, 0.0).when((shortest < COMMON) | shared, alike).otherwise(0.0)

    size, size_other = part(one, 1).cast("long"), part(other, 1).cast("long")
    return (
        F.when(one == other, 1.0)
        .when(size == size_other, F.greatest(score(part(one, 2), part(other, 2)), score(part(one, 3), part(other, 3))))
        .when(size == 2 * size_other, score(part(one, 2), part(other, 3)))
        .when(size_other == 2 * size, score(part(one, 3), part(other, 2)))
        .otherwise(0.0)
    )


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("next_fingerprint", pa.string()),
    ]
)


def _followed(docs: DataFrame) -> DataFrame:
    """Rows in ranges of ascending key, each range in one task and closed by a copy of the row that comes after it."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = np.unique(docs.approxQuantile("at", [i / parts for i in range(1, parts)], 0.2 / parts) or [])

    @F.pandas_udf("int")
    def range_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splits, at.to_numpy(), "right"))

    dealt = docs.withColumn("part", range_of("at"))
    # one row per range: as many as there are shuffle partitions
    firsts = sorted((r.part, r.at) for r in dealt.groupBy("part").agg(F.min("at").alias("at")).collect())
    after = [(part, firsts[(i + 1) % len(firsts)][1]) for i, (part, _) in enumerate(firsts)]
    guests = (
        docs.join(F.broadcast(spark.createDataFrame(after, "part int, at long")), "at")
        .groupBy("part")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("at"), "part", F.lit(True).alias("guest"))
    )
    rows = dealt.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "at", "part", F.lit(False).alias("guest"))
    return rows.union(guests).repartition("part").sortWithinPartitions("part", "guest", "at", "text")


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited one, and their likeness; a row per row of ``docs``.

    The edited text has its last quarter (rounded down, in code points) replaced by as many of the next document, or all
    it has. Next is by ascending key, then text; null keys come first, and after the last row comes the first. Null
    texts are empty; an empty table gives no rows; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "guest")]
            rows = held + list(zip(*columns, strict=True))
            held = rows[-1:]
            own = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[3]]
            if not own:
                continue
            edited = []
            for (_, one, _, _), (_, other, _, _) in own:
                k = len(one) // 4
                edited.append((one[: len(one) - k] + other[:k]).encode())
            marks = fingerprints([r[1].encode() for r in rows])
            follow = [(marks[i], marks[i + 1]) for i in range(len(rows) - 1) if not rows[i][3]]
            yield table(
                _OUT,
                doc_id=[a[0] for a, _ in own],
                n_chars=[len(a[1]) for a, _ in own],
                edited_sha256=[hashlib.sha256(e).hexdigest() for e in edited],
                fingerprint=[f for f, _ in follow],
                edited_fingerprint=fingerprints(edited),
                next_fingerprint=[f for _, f in follow],
            )

    plain = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("at"),
    )
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    found = _followed(plain).mapInArrow(run, schema)
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )

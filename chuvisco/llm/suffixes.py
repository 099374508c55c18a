"""Removal of long repeated substrings by suffix arrays."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chuvisco.llm.shared import among, flat, numbered_columns, slices, stored, stretch_hashes, table

#: Bytes of contexts that one suffix array takes together.
BUCKET = 1 << 16
#: Windows of a context that are looked at together once their key is known to have unlike contexts.
PIECE = 32
#: Different contexts of one piece's key beyond which its windows are compared one by one instead.
CROWD = 2048


def suffix_array(text: bytes) -> list[int]:
    """Starts of the suffixes in order, by linear grouping.

    First the suffixes are grouped by their longest Lyndon prefix: groups are taken from the highest to the lowest, and
    from each member a pointer leads to the nearest suffix before it that lies in a lower group. Suffixes that are
    pointed to move behind the rest of their group, those pointed to more often further. Then the groups' order is
    given out: from the smallest suffix on, the suffix before a placed one, and those its pointers lead to, take the
    next free place of their groups. Nothing is ever renamed or sorted again.
    """
    n = len(text) + 1
    values = np.r_[np.frombuffer(text, np.uint8).astype(np.int16) + 1, 0].astype(np.int16)
    by_value = np.argsort(values, kind="stable")
    begin = np.r_[0, np.cumsum(np.bincount(values, minlength=257))]
    group = begin[values].tolist()
    order = by_value.tolist()
    place = np.empty(n, np.int64)
    place[by_value] = np.arange(n)
    place = place.tolist()
    size = [0] * (n + 1)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b > a:
            size[a] = b - a
    previous = [-1] * n

    def move(suffix: int, to: int) -> None:
        at, other = place[suffix], order[to]
        order[at], place[other] = other, at
        order[to], place[suffix] = suffix, to

    end = n
    while end > 0:
        start = group[order[end - 1]]
        if end - start == 1:
            suffix = order[start]
            p = suffix - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[suffix] = p
            if p >= 0:
                g = group[p]
                left = size[g] - 1
                if left:
                    move(p, g + left)
                    size[g] = left
                    group[p] = g + left
                    size[g + left] = 1
        else:
            times = {}
            for suffix in sorted(order[start:end]):
                p = suffix - 1
                while p >= 0 and group[p] >= start:
                    p = previous[p]
                previous[suffix] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            pointed = defaultdict(lambda: defaultdict(list))
            for p, k in times.items():
                pointed[k][group[p]].append(p)
            for k in sorted(pointed, reverse=True):
                for g, members in pointed[k].items():
                    left = size[g] - len(members)
                    if left:
                        behind = g + left
                        for i, p in enumerate(members):
                            move(p, g + size[g] - 1 - i)
                        for p in members:
                            group[p] = behind
                        size[g], size[behind] = left, len(members)
        end = start

    free, placed = list(range(n)), [-1] * n
    placed[0] = n - 1
    group[n - 1] = -1
    for i in range(n):
        p = placed[i] - 1
        while p >= 0 and group[p] >= 0:
            g = group[p]
            placed[free[g]] = p
            free[g] += 1
            group[p] = -1
            p = previous[p]
    return placed[1:]


def repeated_windows(contexts: list[bytes], width: int) -> list[np.ndarray]:
    """For each context the starts of its ``width``-byte windows that also stand elsewhere in the contexts."""
    joined = b"".join(contexts)
    starts = np.cumsum([0, *map(len, contexts)])
    usable = np.ones(len(joined), bool)
    for end in starts[1:]:
        usable[max(end - width + 1, 0) : end] = False
    order = np.array(suffix_array(joined), np.int64)
    order = order[usable[order]]
    found = np.zeros(len(joined), bool)
    windows = order.tolist()
    for one, other in zip(windows, windows[1:], strict=False):
        if joined[one : one + width] == joined[other : other + width]:
            found[one] = found[other] = True
    return [np.flatnonzero(found[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]


_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_BITS = 30


def anchors(data: np.ndarray, starts: np.ndarray, width: int, reach: int) -> tuple[np.ndarray, ...]:
    """Which stretches of window starts belong to which anchor, with a hash of what all windows of such an anchor share
    and one of all that its windows cover.

    A window's anchor is its 16-byte string of lowest hash among those that start in its first ``reach`` bytes, so equal
    windows have equal anchors at equal places. Every window of an anchor holds the ``width - reach + 1`` bytes from the
    anchor on: the key. Windows are found through their keys, wherever they stand.
    """
    n, shared = len(data), width - reach + 1
    empty = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    if n < width:
        return empty
    grown = {1: data.astype(np.uint64) + np.uint64(1)}
    size, factor = 1, _ODD
    while 2 * size <= max(shared, 16):
        h = grown[size]
        if len(h) <= size:
            return empty
        grown[2 * size] = h[:-size] + factor * h[size:]
        size, factor = 2 * size, np.uint64(pow(int(_ODD), 2 * size, 1 << 64))
        if size > 16 and not shared & (size // 2) and size // 2 != 16:
            del grown[size // 2]
    mixed = grown[16] * _OTHER
    mixed ^= mixed >> np.uint64(29)
    mixed *= _ODD
    low = np.uint64((1 << _BITS) - 1)
    mixed = (mixed & ~low) | np.arange(len(mixed), dtype=np.uint64)
    least, span = mixed, 1
    while 2 * span <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < reach:
        least = np.minimum(least[: -(reach - span)], least[reach - span :])
    owner = (least & low).astype(np.int64)[: n - width + 1]
    # windows that lie in one text
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = text[: n - width + 1] == text[width - 1 :]
    first = inside.copy()
    first[1:] &= (owner[1:] != owner[:-1]) | ~inside[:-1] | (text[1 : len(owner)] != text[: len(owner) - 1])
    lo = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    hi = np.flatnonzero(last)
    at = owner[lo]
    key, done, factor = np.zeros(len(at), np.uint64), 0, np.uint64(1)
    for size in sorted(grown):
        if shared & size:
            key += factor * grown[size][at + done]
            done += size
            factor = np.uint64(pow(int(_ODD), done, 1 << 64))
    whole = stretch_hashes(data, int(_OTHER))(lo, hi + width)
    whole ^= ((at - lo).astype(np.uint64) << np.uint64(40)) ^ ((hi - lo).astype(np.uint64) << np.uint64(52))
    return text[lo], at, lo, hi, key, whole


_ANCHORS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("at", pa.int32()),
        ("lo", pa.int32()),
        ("hi", pa.int32()),
        ("key", pa.int64()),
        ("ctx", pa.int64()),
    ]
)


def _spans(found: DataFrame, width: int, reach: int) -> DataFrame:
    """Stretches ``(row, doc_id, lo, hi)`` of window starts that occur twice or more."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, starts = flat(batch.column("text"))
            text, at, lo, hi, key, whole = anchors(data, starts, width, reach)
            if len(text):
                index = pa.array(text)
                yield table(
                    _ANCHORS,
                    row=batch.column("row").take(index),
                    doc_id=batch.column("doc_id").take(index),
                    at=at - starts[text],
                    lo=lo - starts[text],
                    hi=hi - starts[text],
                    key=key.view(np.int64),
                    ctx=whole.view(np.int64),
                )

    marks = stored(found.mapInArrow(emit, "row long, doc_id long, at int, lo int, hi int, key long, ctx long"))
    twice = stored(marks.groupBy("key").count().where("count > 1").select("key"))
    likely = stored(among(marks, twice, "key"))
    # copies of a whole context: each of its windows occurs as often; one of them stands for all from here on
    contexts = likely.groupBy("key", "ctx").agg(F.count("*").alias("copies"), F.min(F.struct("row", "doc_id", "at", "lo", "hi")).alias("rep"))
    copied = likely.join(contexts.where("copies > 1").select("key", "ctx"), ["key", "ctx"]).select("row", "doc_id", "lo", "hi")
    open_ = contexts.join(_unlike(contexts, "key"), "key").select("key", "copies", "rep.*")
    wanted = open_.groupBy("row", "doc_id").agg(F.collect_list(F.struct("key", "copies", "at", "lo", "hi")).alias("wanted"))
    wanted = stored(wanted)
    found = among(found, wanted.select("row").distinct(), "row")
    texts = found.join(wanted, (found.row == wanted.row) & found.doc_id.eqNullSafe(wanted.doc_id)).select(
        found.row, found.doc_id, F.encode("text", "UTF-8").alias("bytes"), "wanted"
    )
    cut = stored(
        texts.dropDuplicates(["row", "doc_id"])
        .select("row", "doc_id", "bytes", F.explode("wanted").alias("w"))
        .select("row", "doc_id", "w.*", F.expr(f"substring(bytes, w.lo + 1, w.hi - w.lo + {width})").alias("bytes"))
    )
    return copied.unionByName(_in_pieces(cut, width))


def _unlike(contexts: DataFrame, key: str) -> DataFrame:
    """Keys with several contexts of which one at least has no copy."""
    counted = contexts.groupBy(key).agg(F.count("*").alias("crowd"), F.min("copies").alias("least"))
    return counted.where("crowd > 1 AND least = 1").select(key, "crowd")


def _in_pieces(cut: DataFrame, width: int) -> DataFrame:
    """Repeated windows of contexts whose key other contexts have.

    Once more by keys and copies, now for ``PIECE`` windows at a time, which have nearly all of their bytes in common:
    most contexts differ in those and drop out before suffix arrays are built.
    """
    size = min(PIECE, width)
    each = cut.withColumn("j", F.expr(f"explode(sequence((at - hi) DIV {size}, (at - lo) DIV {size}))")).withColumns(
        {"from": F.expr(f"greatest(lo, at - {size} * j - {size - 1})"), "to": F.expr(f"least(hi, at - {size} * j)")}
    )
    shared = F.expr(f"substring(bytes, at - {size} * j - lo + 1, {width - size + 1})")
    whole = F.expr(f"substring(bytes, from - lo + 1, to - from + {width})")
    pieces = stored(
        each.select(
            "row",
            "doc_id",
            "lo",
            "from",
            "to",
            "copies",
            F.xxhash64("key", "j", shared).alias("piece"),
            F.md5(F.concat(F.encode(F.concat_ws(" ", F.col("at") - F.col("from"), F.col("to") - F.col("from")), "UTF-8"), whole)).alias("ctx"),
        )
    )
    contexts = pieces.groupBy("piece", "ctx").agg(F.sum("copies").alias("copies"), F.min(F.struct("row", "doc_id", "lo", "from", "to")).alias("rep"))
    several = contexts.where("copies > 1").select("piece", "ctx")
    copied = pieces.where("copies = 1").join(several, ["piece", "ctx"]).select("row", "doc_id", F.col("from").alias("lo"), F.col("to").alias("hi"))
    open_ = contexts.join(_unlike(contexts, "piece"), "piece").select("piece", "crowd", "copies", "rep.*")
    held = cut.select("row", "doc_id", F.col("lo").alias("base"), "bytes")
    same = (open_.row == held.row) & open_.doc_id.eqNullSafe(held.doc_id) & (open_.lo == held.base)
    left = stored(
        open_.join(held, same).select(
            open_.row,
            open_.doc_id,
            F.col("piece").alias("key"),
            "crowd",
            "copies",
            F.col("from").alias("lo"),
            F.col("to").alias("hi"),
            F.expr(f"substring(bytes, from - lo + 1, to - from + {width})").alias("bytes"),
        )
    )
    return copied.unionByName(_by_suffixes(left.where(f"crowd <= {CROWD}"), width)).unionByName(
        _by_windows(left.where(f"crowd > {CROWD}"), width)
    )


def _by_suffixes(contexts: DataFrame, width: int) -> DataFrame:
    """Windows of contexts without copies that occur again in another context, by suffix arrays over the contexts of a
    few keys at a time; contexts of one key always meet."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def compare(rows: list[tuple]) -> Iterator[tuple]:
        for (row, doc, lo, _, copies, _), windows in zip(rows, repeated_windows([r[5] for r in rows], width), strict=True):
            if copies == 1 and len(windows):
                breaks = np.flatnonzero(np.diff(windows) > 1)
                for a, b in zip(windows[np.r_[0, breaks + 1]], windows[np.r_[breaks, len(windows) - 1]], strict=True):
                    yield row, doc, lo + int(a), lo + int(b)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        columns = ("row", "doc_id", "lo", "key", "copies", "bytes")
        for batch in batches:
            out = []
            for r in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if size >= BUCKET and r[3] != held[-1][3]:
                    out += compare(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
            if out:
                yield table(schema, **dict(zip(schema.names, zip(*out, strict=True), strict=True)))
        if held and (out := list(compare(held))):
            yield table(schema, **dict(zip(schema.names, zip(*out, strict=True), strict=True)))

    together = contexts.repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(search, "row long, doc_id long, lo int, hi int")


def _by_windows(contexts: DataFrame, width: int) -> DataFrame:
    """The same for keys with so many different contexts that one task must not gather them: single windows are
    grouped, of which equal ones are merged before they move."""
    windows = contexts.select("row", "doc_id", "lo", F.expr("explode(sequence(0, hi - lo))").alias("at"), "bytes", "copies").select(
        "row", "doc_id", (F.col("lo") + F.col("at")).alias("lo"), "copies", F.expr(f"sha1(substring(bytes, at + 1, {width}))").alias("window")
    )
    twice = windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    return windows.where("copies = 1").join(twice, "window").select("row", "doc_id", "lo", F.col("lo").alias("hi"))


def covered(spans: list, width: int) -> list[tuple[int, int]]:
    """Maximal stretches of bytes under windows that start in the given stretches."""
    merged: list[list[int]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi + width)
        else:
            merged.append([lo, hi + width])
    return [tuple(m) for m in merged]


def with_repeats(docs: DataFrame, width: int = 400, reach: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``__repeats``: an array of stretches of window starts, null where nothing repeats.

    Only texts in which something repeats are moved. Rows without text have no repeats.
    """
    reach = reach or max(1, min(256, max(width - 144, width // 2)))
    if width < 16 + reach:
        raise ValueError("width must be 17 at least")
    marked = docs.withColumn("__row", F.xxhash64(F.col(text).cast("string"), F.col(key).cast("long")))
    plain = marked.where(F.octet_length(text) >= width).select(
        F.col("__row").alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    spans = stored(
        _spans(plain, width, reach)
        .groupBy("row", "doc_id")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("__repeats"))
        .select(F.col("row").alias("__row"), F.col("doc_id").alias("__doc"), "__repeats")
    )
    rows = spans.select("__row").distinct()
    same = (F.col("one.__row") == F.col("other.__row")) & F.col(f"one.{key}").cast("long").eqNullSafe(F.col("__doc"))
    touched = among(marked, rows, "__row").alias("one").join(spans.alias("other"), same, "left").select("one.*", "__repeats")
    left_alone = among(marked, rows, "__row", "left_anti").withColumn("__repeats", F.lit(None).cast("array<struct<lo:int,hi:int>>"))
    return touched.unionByName(left_alone).drop("__row")


_REMOVED = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _kept(text: bytes, repeats: list | None, width: int) -> tuple[bytes, list[tuple[int, int]]]:
    gone = covered([(r["lo"], r["hi"]) for r in repeats], width) if repeats else []
    parts, at = [], 0
    for start, end in gone:
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]]), gone


def remove_repeats(docs: DataFrame, width: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What is left of each text without every byte under a ``width``-byte string that also starts elsewhere.

    A row per row of ``docs``. Texts are UTF-8 bytes, null is empty; repeats are looked for in all texts, not across
    them, and overlapping ones count. A repeated row repeats all of its text. Other columns are not looked at.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
            columns = {n: [] for n in _REMOVED.names} | {"doc_id": batch.column("doc_id")}
            for value, repeats in zip(texts, batch.column("__repeats").to_pylist(), strict=True):
                whole = value.as_py()
                left, gone = _kept(whole, repeats, width)
                columns["n_bytes"].append(len(whole))
                columns["n_removed"].append(len(whole) - len(left))
                columns["n_spans"].append(len(gone))
                columns["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            yield table(_REMOVED, **columns)

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return with_repeats(plain, width).mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, width: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of their texts, and bytes of characters cut in two with them.

    A row per row of ``docs``, in any order. Null texts stay null, empty and short ones as they are; a text that stands
    twice, by a repeated row or otherwise, loses all of it where it has ``width`` bytes. Null keys are keys like others. An
    empty table stays empty; other columns stay as they are, whatever their names.
    """
    place, schema = docs.columns.index(text), docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"c{place}"):
            columns = list(batch.columns[:-1])
            values = columns[place].to_pylist()
            for i, repeats in enumerate(batch.columns[-1].to_pylist()):
                if repeats:
                    values[i] = _kept(values[i].encode(), repeats, width)[0].decode("utf-8", "ignore")
            columns[place] = pa.array(values, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = with_repeats(numbered_columns(docs), width, key=f"c{docs.columns.index(key)}", text=f"c{place}")
    return found.mapInArrow(cut, schema)

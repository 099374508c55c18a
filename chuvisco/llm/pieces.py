"""Varied segmentations by a SentencePiece BPE model that skips merges by a keyed hash, and their decoding."""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from chuvisco.llm.jaccard import mix
from chuvisco.llm.shared import flat, slices, strings, table, texts_of

SPACE = "▁"
#: Letters of a unit up to which all units are merged side by side; longer ones have an agenda of their own.
SHORT = 48
#: Bytes of text whose units are segmented together.
STEP = 1 << 20
_NEVER = np.int64(1) << 40


@dataclass(frozen=True)
class Pieces:
    """``pairs`` (sorted) are left id * size + right id of all merges, ``merged`` and ``ranks`` their piece and order."""

    size: int
    ids: dict[str, int]
    letters: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray
    ranks: np.ndarray
    first_byte: int
    decoded: list[bytes]

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging neighbours; no merge has rank ``_NEVER``."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        there = (self.pairs[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(there, self.ranks[at], _NEVER), self.merged[at]


@cache
def load(path: str) -> Pieces:
    from sentencepiece import SentencePieceProcessor

    made = SentencePieceProcessor(model_file=path)
    size = made.get_piece_size()
    ids, decoded, first_byte = {}, [], -1
    for i in range(size):
        piece = made.id_to_piece(i)
        if made.is_byte(i):
            first_byte = i if first_byte < 0 else first_byte
            decoded.append(bytes([int(piece[3:5], 16)]))
        elif made.is_control(i) or made.is_unknown(i) or made.is_unused(i):
            decoded.append(b"")
        else:
            ids[piece] = i
            decoded.append(piece.replace(SPACE, " ").encode())
    by_score = sorted(ids.values(), key=lambda i: (-made.get_score(i), i))
    rank = dict(zip(by_score, range(size), strict=False))
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                found.append((left * size + right, i, rank[i]))
    found.sort()
    letters = np.full(0x110000, -1, np.int64)
    for piece, i in ids.items():
        if len(piece) == 1:
            letters[ord(piece)] = i
    letters[32], letters[ord(SPACE)] = ids[SPACE], -1  # a mark in the text itself is not a blank: it goes out as bytes
    return Pieces(size, ids, letters, *np.array(found, np.int64).reshape(-1, 3).T.copy(), first_byte, decoded)


def skipped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
    """Whether the merge of the stretches ``start .. middle`` and ``middle .. end`` of a unit is left out."""
    if rate <= 0:
        return np.zeros(len(key), bool)
    return _lost(key, _places(start, middle, end), rate)


def _places(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    place = (start.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
    return mix(place + np.uint64(1))


def _lost(key: np.ndarray, places: np.ndarray, rate: float) -> np.ndarray:
    return mix(key ^ places) < np.uint64(min(rate, 1.0) * (2**64 - 2**12))


def segment(
    pieces: Pieces, points: np.ndarray, starts: np.ndarray, keys: np.ndarray, rate: float, merges: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all units one after another: ids, or for a letter without a piece -1 - its code point; and how many
    each unit has. ``merges`` gets the units, starts, middles and ends of the merges that were made.

    Units merge side by side: in each round every unit takes the candidate of the best rank, leftmost first, that its
    key does not skip, and only the pairs beside a merge are looked up anew. A candidate is known by where it starts,
    divides and ends, so it is decided on once.
    """
    symbol = np.where(pieces.letters[points] >= 0, pieces.letters[points], -1 - points)
    unit = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    start = np.arange(len(points)) - starts[unit]
    end = start + 1
    rank, result = np.full(len(points), _NEVER), np.zeros(len(points), np.int64)

    def look(at: np.ndarray) -> None:
        at = at[(at >= 0) & (at < len(symbol) - 1)]
        nxt = at + 1
        found, made = pieces.look(symbol[at], symbol[nxt])
        found[unit[at] != unit[nxt]] = _NEVER
        open_ = np.flatnonzero(found < _NEVER)
        lost = skipped(keys[unit[at[open_]]], start[at[open_]], end[at[open_]], end[nxt[open_]], rate)
        found[open_[lost]] = _NEVER
        rank[at], result[at] = found, made

    look(np.arange(len(points)))
    done: list[tuple] = []
    while len(symbol):
        head = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        best = np.minimum.reduceat(rank * np.int64(1 << 22) + np.minimum(start, (1 << 22) - 1), head)
        going = best < _NEVER << 22
        size = np.diff(np.r_[head, len(symbol)])
        if not going.all():
            out = np.repeat(~going, size)
            done.append((unit[out], symbol[out]))
            keep = ~out
            symbol, unit, start, end, rank, result = (x[keep] for x in (symbol, unit, start, end, rank, result))
            best, size = best[going], size[going]
            if not len(symbol):
                break
        chosen = np.flatnonzero(np.repeat(best, size) == rank * np.int64(1 << 22) + start)
        if merges is not None:
            merges.append((unit[chosen], start[chosen], end[chosen], end[chosen + 1]))
        symbol[chosen], end[chosen] = result[chosen], end[chosen + 1]
        rank[chosen] = _NEVER
        keep = np.ones(len(symbol), bool)
        keep[chosen + 1] = False
        symbol, unit, start, end, rank, result = (x[keep] for x in (symbol, unit, start, end, rank, result))
        chosen -= np.arange(len(chosen))
        look(np.concatenate([chosen, chosen - 1]))
    if not done:
        return np.zeros(0, np.int64), np.zeros(len(starts) - 1, np.int64)
    units, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(units, kind="stable")
    return symbols[order], np.bincount(units, minlength=len(starts) - 1)


def segment_long(pieces: Pieces, points: np.ndarray, key: np.uint64, rate: float) -> np.ndarray:
    """The same for one unit, with an agenda."""
    n = len(points)
    symbol = np.where(pieces.letters[points] >= 0, pieces.letters[points], -1 - points).tolist()
    before, after, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))

    def look(left: list[int], right: list[int], middles: list[int], ends: list[int]) -> list[tuple]:
        ranks, made = pieces.look(np.array([symbol[i] for i in left]), np.array([symbol[i] for i in right]))
        lost = skipped(np.full(len(left), key), np.array(left), np.array(middles), np.array(ends), rate)
        return [(int(r), i, m, e, int(x)) for r, i, m, e, x, gone in zip(ranks, left, middles, ends, made, lost, strict=True) if r < _NEVER and not gone]

    agenda = look(list(range(n - 1)), list(range(1, n)), end[: n - 1], end[1:]) if n > 1 else []
    heapq.heapify(agenda)
    while agenda:
        _, i, middle, last, made = heapq.heappop(agenda)
        j = after[i]
        if symbol[i] is None or end[i] != middle or j >= n or end[j] != last:
            continue
        symbol[i], symbol[j], end[i], after[i] = made, None, last, after[j]
        if after[j] < n:
            before[after[j]] = i
        beside = [(a, b) for a, b in ((before[i], i), (i, after[i])) if a >= 0 and b < n]
        if beside:
            left, right = map(list, zip(*beside, strict=True))
            for found in look(left, right, [end[a] for a in left], [end[b] for b in right]):
                heapq.heappush(agenda, found)
    return np.array([s for s in symbol if s is not None], np.int64)


def encode(
    path: str, data: np.ndarray, starts: np.ndarray, owners: np.ndarray, seed: int = 0, rate: float = 0.1
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text's start. Texts get a blank in front.

    A unit is a run of blanks and what follows up to the next blank; no piece reaches from one into the next. Each
    unit's merges are skipped by the seed, its owner and its place, so every occurrence has skips of its own. Where
    none of the merges is skipped that are made without skips, the segmentation is the one without skips, which equal
    units share; only the other occurrences are segmented by themselves.
    """
    pieces = load(path)
    texts = len(starts) - 1
    padded = np.full(len(data) + texts, 32, np.uint8)
    begin = starts[:-1] + np.arange(texts)
    inside = np.ones(len(padded), bool)
    inside[begin] = False
    padded[inside] = data
    cut = padded == 32
    cut[1:] &= padded[:-1] != 32
    cut[begin] = True
    first = np.flatnonzero(cut)
    bounds = np.searchsorted(first, np.r_[begin, len(padded)])
    # a text that is empty has no unit
    nothing = np.diff(np.r_[begin, len(padded)]) == 1
    coded = pc.dictionary_encode(strings(padded, np.r_[first, len(padded)]))
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.arange(len(code)) - np.repeat(bounds[:-1], np.diff(bounds))
    owner = np.repeat(mix(owners.astype(np.uint64) + mix(np.array([seed & (2**64 - 1)], np.uint64))), np.diff(bounds))
    keys = mix(owner + place.astype(np.uint64))
    held, at = flat(coded.dictionary)
    points = np.frombuffer(bytes(held).decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.r_[0, np.cumsum((held & 0xC0) != 0x80)][at]
    sizes = np.diff(letter)
    short = np.flatnonzero(sizes <= SHORT)

    # all short units without skips, and which occurrences skip a merge of these
    merges: list[tuple] = []
    plain, counts = _short(pieces, points, letter, short, np.zeros(len(short), np.uint64), 0.0, merges)
    n, begins = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    kind = np.full(len(sizes), -1)
    kind[short] = np.arange(len(short))
    kind = kind[code]
    is_short = kind >= 0
    n[is_short], begins[is_short] = counts[kind[is_short]], (np.cumsum(counts) - counts)[kind[is_short]]
    parts, total = [plain], len(plain)
    own = np.zeros(len(code), bool)
    if rate > 0 and merges:
        units, *ends = (np.concatenate(x) for x in zip(*merges, strict=True))
        order = np.argsort(units, kind="stable")
        places = _places(*ends)[order]
        made = np.bincount(units, minlength=len(short))
        offset = np.cumsum(made) - made
        some = np.flatnonzero(is_short)
        for low in range(0, len(some), 1 << 16):
            part = some[low : low + (1 << 16)]
            times = made[kind[part]]
            before = np.cumsum(times) - times
            which = np.arange(int(times.sum())) + np.repeat(offset[kind[part]] - before, times)
            lost = _lost(np.repeat(keys[part], times), places[which], rate)
            own[np.repeat(part, times)[lost]] = True
    varied = np.flatnonzero(own)
    for low in range(0, len(varied), 1 << 16):
        part = varied[low : low + (1 << 16)]
        symbols, counts = _short(pieces, points, letter, code[part], keys[part], rate)
        n[part], begins[part] = counts, total + np.cumsum(counts) - counts
        parts.append(symbols)
        total += len(symbols)
    for u in np.flatnonzero(~is_short).tolist():
        parts.append(segment_long(pieces, points[letter[code[u]] : letter[code[u] + 1]], keys[u], rate))
        begins[u], n[u] = total, len(parts[-1])
        total += n[u]
    symbols = np.concatenate(parts)
    ends = np.cumsum(n)
    where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - n), n)
    ids = symbols[where]
    edges = np.r_[0, ends][bounds]
    gone = np.repeat(nothing, np.diff(edges))
    ids, edges = ids[~gone], np.r_[0, np.cumsum(np.where(nothing, 0, np.diff(edges)))]
    return _as_bytes(pieces, ids, edges)


def _short(
    pieces: Pieces, points: np.ndarray, letter: np.ndarray, units: np.ndarray, keys: np.ndarray, rate: float, merges: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``segment`` for some of the units that ``letter`` parts ``points`` into."""
    sizes = letter[units + 1] - letter[units]
    edges = np.r_[0, np.cumsum(sizes)]
    which = np.arange(edges[-1]) + np.repeat(letter[units] - edges[:-1], sizes)
    return segment(pieces, points[which], edges, keys, rate, merges)


def _as_bytes(pieces: Pieces, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters without a piece as the ids of their bytes."""
    lone = np.flatnonzero(ids < 0)
    if not len(lone):
        return ids, edges
    coded = [chr(-1 - c).encode("utf-8", "replace") for c in ids[lone].tolist()]
    width = np.ones(len(ids), np.int64)
    width[lone] = [len(c) for c in coded]
    place = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.int64)
    out[place[ids >= 0]] = ids[ids >= 0]
    inner = np.repeat(place[lone], width[lone]) + np.concatenate([np.arange(len(c)) for c in coded])
    out[inner] = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64) + pieces.first_byte
    return out, np.r_[place, len(out)][edges]


def decode(path: str, ids: np.ndarray) -> str:
    """The text of ids; the blank in front goes."""
    decoded = load(path).decoded
    return b"".join([decoded[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("text_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
        ("lossless", pa.bool_()),
    ]
)


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _segmented(batches: Iterator[pa.RecordBatch], model: str, seed: int, rate: float) -> Iterator[tuple]:
    for batch in slices(batches, limit=STEP):
        data, starts = flat(batch.column("text"))
        owners = pc.fill_null(batch.column("doc_id"), -1).to_numpy(zero_copy_only=False).view(np.uint64)
        yield batch, data, starts, *encode(model, data, starts, owners, seed, rate)


def segmentations(
    docs: DataFrame, model: str, seed: int = 0, rate: float = 0.1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and the ids of a varied segmentation of each whole text, a row per row of ``docs``; those whose digests
    ``segment_documents`` gives. Null texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _, ids, edges in _segmented(batches, model, seed, rate):
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))
            yield table(_IDS, doc_id=batch.column("doc_id"), ids=lists)

    return texts_of(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(found: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``found`` with the column ``ids`` decoded to the texts it was made of; null stays null."""
    place = found.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = pa.array([None if i is None else decode(model, np.array(i, np.int64)) for i in columns[place].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    schema = ", ".join(f"`{f.name}` {'string' if f.name == ids else f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(run, schema)


def segment_documents(
    docs: DataFrame, model: str, seed: int = 0, rate: float = 0.1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Digests of a varied segmentation of each whole text and of what it decodes to, a row per row of ``docs``; the ids
    themselves are those of ``segmentations``.

    Segmentations follow from text, key, ``seed`` and ``rate`` alone; each occurrence of a word has one of its own. Null
    texts are empty and have no tokens; null and repeated keys are rows like any other; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, starts, ids, edges in _segmented(batches, model, seed, rate):
            columns = {n: [] for n in _OUT.names} | {"doc_id": batch.column("doc_id"), "n_tokens": np.diff(edges)}
            for a, b, c, d in zip(starts[:-1], starts[1:], edges[:-1], edges[1:], strict=True):
                own, whole = ids[c:d], bytes(data[a:b])
                back = decode(model, own).encode()
                columns["n_chars"].append(len(whole.decode("utf-8", "replace")))
                columns["ids_crc32"].append(zlib.crc32(own.astype("<u4").tobytes()))
                columns["text_sha256"].append(hashlib.sha256(whole).hexdigest())
                columns["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
                columns["lossless"].append(back == whole)
            yield table(_OUT, **columns)

    schema = "doc_id long, n_chars long, n_tokens long, ids_crc32 long, text_sha256 string, decoded_sha256 string, lossless boolean"
    return texts_of(docs, key, text).mapInArrow(run, schema)

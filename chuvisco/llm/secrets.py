"""Secrets in texts, also in what URL, Unicode, base64 and compressed layers hide."""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from chuvisco.llm.shared import slices, table, texts_of

KINDS = ("assign", "access", "hex")
#: How often the layers that are not compressed may be as long as the document together; see ``_Room``.
DEPTH = 64
_ORDER = {kind: i for i, kind in enumerate(KINDS)}
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_ESCAPED = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"(?:\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})"
    r"|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
#: A run of both base64 alphabets, line breaks inside it included, and what may stand in it where compressed bytes begin.
_CODED = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{12}|[A-Za-z0-9+/_-]++[ \t]*+[\r\n])[A-Za-z0-9+/_-]+(?:(?:[ \t]*+[\r\n])++[ \t]*+[A-Za-z0-9+/_-]+)*={0,2}"
)
_PACKED = re.compile(r"(?=H4sI|e[A-P][A-Za-z0-9+/]|Qlpo|/Td6WFoA)")
#: A word and a blank after it that no pattern and no code crosses.
_CUT = re.compile(r"(?<!\S)[^\s%\\&:=\"']++\x20(?=[^\s%\\&:=\"'])")
_ALPHABET = str.maketrans("-_", "+/", " \t\r\n")
#: No secret, and no code for one, is without so many of these in a row.
_PLAIN = re.compile(rb"[\t\r\n\x20-\x7e]{12}")
_UTF8 = re.compile(rb"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")

#: Where compressed bytes may begin: gzip, zlib, bzip2 and xz (fixed values).
_MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
_CONTROL = {"0": 0, "a": 7, "b": 8, "t": 9, "n": 10, "v": 11, "f": 12, "r": 13}


@dataclass(frozen=True)
class _Bytes:
    """A way to write bytes in a text. All of its escapes begin with ``mark``. ``unit`` matches one byte: its groups are two
    hexadecimal digits, a decimal number, a letter after a backslash, and a character that stands for itself; ``begin``
    matches where compressed bytes may begin."""

    mark: str
    unit: re.Pattern
    begin: re.Pattern

    @staticmethod
    def of(mark: str, hexadecimal: str, plain: str, decimal: str = "(?!)()", short: str = "(?!)()") -> _Bytes:
        unit = re.compile(f"{hexadecimal}|{decimal}|{short}|({plain})")

        def one(*values: int) -> str:
            # the escapes of a byte by their digits, which the groups of a unit would take as any
            ways = []
            for v in values:
                ways.append(hexadecimal.replace("([0-9A-Fa-f]{2})", f"(?i:{v:02x})"))
                ways.append(decimal.replace("([0-9]{1,3})", str(v)))
                ways += [re.escape("\\" + letter) for letter, value in _CONTROL.items() if value == v and "([0abtnvfr" in short]
                if re.fullmatch(plain, chr(v)):
                    ways.append(re.escape(chr(v)))
            return f"(?:{'|'.join(ways)})"

        magics = ([[0x1F], [0x8B], [8]], [[0x78], [1, 0x5E, 0x9C, 0xDA]], [[0x42], [0x5A], [0x68], range(0x31, 0x3A)], [[0xFD], [0x37], [0x7A], [0x58], [0x5A], [0]])
        return _Bytes(mark, unit, re.compile("|".join("".join(one(*held) for held in magic) for magic in magics)))

    def read(self, text: str, at: int) -> tuple[bytes, list[int], bytes]:
        """The bytes written from ``at`` on as far as they go, where each begins, and at last where they end; and the bytes
        with blanks for plus signs that stand for themselves."""
        data, places, match = bytearray(), [at], self.unit.scanner(text, at).match
        blanks = []
        while (m := match()) is not None:
            digits, number, letter, plain = m.groups()
            if digits is not None:
                value = int(digits, 16)
            elif number is not None:
                value = int(number)
            elif letter is not None:
                value = _CONTROL.get(letter, ord(letter))
            else:
                value = ord(plain)
                if plain == "+":
                    blanks.append(len(data))
            if value > 255:
                break
            data.append(value)
            places.append(m.end())
        spaced = data.copy()
        for i in blanks:
            spaced[i] = 0x20
        return bytes(data), places, bytes(spaced)


_WRITTEN = (
    _Bytes.of("%", "%([0-9A-Fa-f]{2})", "[!-$&-~]"),
    _Bytes.of("\\", r"\\(?:x|u00)([0-9A-Fa-f]{2})", r"[\x20-\x5b\x5d-\x7f]", short=r"\\([0abtnvfr\\'\"])"),
    _Bytes.of("&#", "&#[xX]0*([0-9A-Fa-f]{2});", "[\\x20-\\x25\\x27-\\x7e]|&(?!#)", decimal="&#0*([0-9]{1,3});"),
)

#: What a text must hold for a step to find anything, for a first look at many texts at once.
_HINTS = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "escaped": r"%[0-9A-Fa-f]{2}",
    "unicode": r"\\[ux]|&#",
    "coded": r"[A-Za-z0-9+/_-](?:(?:[ \t]*[\r\n][\r\n\t ]*)?[A-Za-z0-9+/_-]){11}",
}


def base_spans(text: str, hints: set[str] = frozenset(KINDS)) -> list[tuple[str, int, int]]:
    """Spans of each kind, from left to right without overlap; code points, end exclusive."""
    spans = []
    if "assign" in hints:
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "access" in hints:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if "hex" in hints:
        spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return spans


@dataclass(frozen=True)
class Layer:
    """A text and where it comes from in the document: each code point by itself (``starts`` and ``ends``; none: the
    document's own text), or all of it from one stretch (``region``)."""

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None
    region: tuple[int, int] | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.region:
            return self.region
        return (int(self.starts[start]), int(self.ends[end - 1])) if self.starts is not None else (start, end)

    def part(self, start: int, end: int) -> Layer:
        text = self.text[start:end]
        if self.region:
            return Layer(text, region=self.region)
        if self.starts is not None:
            return Layer(text, self.starts[start:end], self.ends[start:end])
        return Layer(text, np.arange(start, end, dtype=np.int32), np.arange(start + 1, end + 1, dtype=np.int32))

    def replaced(self, found: list[tuple[int, int, str]]) -> Layer:
        """With stretches replaced by other text, each of whose code points comes from the whole stretch."""
        parts, at = [], 0
        for start, end, text in found:
            parts += [self.text[at:start], text]
            at = end
        parts.append(self.text[at:])
        if self.region:
            return Layer("".join(parts), region=self.region)
        size = np.ones(len(self.text), np.int32)
        first = np.array([f[0] for f in found])
        inner = np.zeros(len(self.text) + 1, np.int32)
        np.add.at(inner, first, 1)
        np.add.at(inner, [f[1] for f in found], -1)
        size[np.cumsum(inner[:-1]) > 0] = 0
        size[first] = [len(f[2]) for f in found]
        starts, ends = self.starts.copy(), self.ends.copy()
        ends[first] = self.ends[[f[1] - 1 for f in found]]
        return Layer("".join(parts), np.repeat(starts, size), np.repeat(ends, size))


def _escapes(layer: Layer) -> Iterator[Layer]:
    """The stretches of a text that hold escapes, up to where nothing reaches across: a single blank between what is no
    part of an escape, a quote or a sign of assignment."""
    text = layer.text
    first = min((m.start() for m in (_ESCAPED.search(text), _UNICODE.search(text)) if m), default=-1)
    if first < 0:
        return
    begin = 0
    for m in _CUT.finditer(text):
        if m.end() > first:
            if _ESCAPED.search(text, begin, m.end()) or _UNICODE.search(text, begin, m.end()):
                yield layer.part(begin, m.end())
        begin = m.end()
    if _ESCAPED.search(text, begin) or _UNICODE.search(text, begin):
        yield layer.part(begin, len(text))


def _url(layer: Layer) -> Iterator[Layer]:
    found = []
    for m in _ESCAPED.finditer(layer.text):
        run = bytes.fromhex(m[0].replace("%", ""))
        at = 0
        while at < len(run):  # one character after another, so that each maps to its own escapes
            for size in (1, 2, 3, 4):
                try:
                    text = run[at : at + size].decode()
                except UnicodeDecodeError:
                    continue
                found.append((m.start() + 3 * at, m.start() + 3 * (at + size), text))
                break
            else:
                size = 1
            at += size
    if found:
        yield layer.replaced(found)


def _unicode(layer: Layer) -> Iterator[Layer]:
    found = []
    for m in _UNICODE.finditer(layer.text):
        if m.lastindex is None:
            text = bytes.fromhex(m[0][2:6] + m[0][8:]).decode("utf-16-be")
        else:
            code = int(m[m.lastindex], 10 if m.lastindex == 5 else 16)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                continue
            text = chr(code)
        found.append((*m.span(), text))
    if found:
        yield layer.replaced(found)


def _written(layer: Layer, room: _Room) -> Iterator[Layer]:
    """What compressed bytes hold that are written as URL escapes, with backslashes (as in source code or JSON) or as
    references, next to characters that stand for themselves. In URLs a plus sign may be a blank as well."""
    for way in _WRITTEN:
        if way.mark not in layer.text:
            continue
        at = 0
        while (m := way.begin.search(layer.text, at)) is not None:
            data, places, spaced = way.read(layer.text, m.start())
            at = max(places[-1], m.end())
            for held in dict.fromkeys((data, spaced) if way is _WRITTEN[0] else (data,)):
                until = 0
                for hit in _MAGIC.finditer(held):
                    first = hit.start()
                    if first < until:
                        continue
                    try:
                        found = _unpacked(memoryview(held)[first:], room)
                    except _Full:
                        room.refused.append(layer.origin(places[first], places[-1]))
                        continue
                    if found:
                        until = first + found[1]
                        if _PLAIN.search(found[0]):
                            yield Layer(found[0].decode("utf-8", "replace"), region=layer.origin(places[first], places[until]))


class _Room:
    """What one document may still unpack, so that a few compressed bytes cannot fill a task's memory; and how much text
    its other layers, which are never longer than what they come from, may be looked at together: ``DEPTH`` times the
    document and what was unpacked, beside ``most``, so that no depth of codes takes more than linear time."""

    def __init__(self, most: int, length: int):
        self.left, self.steps, self.refused = most, most + DEPTH * length, []

    def take(self, n: int) -> bool:
        if n > self.left:
            return False
        self.left -= n
        self.steps += DEPTH * n
        return True

    def look(self, n: int) -> bool:
        if n > self.steps:
            return False
        self.steps -= n
        return True


class _Full(Exception):
    """There is no room for a layer."""


def _unpacked(data: memoryview, room: _Room) -> tuple[bytes, int] | None:
    """What the compressed bytes that ``data`` begins with hold, without further compressed layers, and how many they
    are; None if it does not begin with such."""
    found, seen = None, set()
    while True:
        if data[:2] == b"\x1f\x8b":
            codec = zlib.decompressobj(31)
        elif data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
            codec = zlib.decompressobj()
        elif data[:3] == b"BZh":
            codec = bz2.BZ2Decompressor()
        elif data[:6] == b"\xfd7zXZ\x00":
            codec = lzma.LZMADecompressor()
        else:
            return found
        try:
            out = codec.decompress(data, room.left + 1)
        except (zlib.error, OSError, lzma.LZMAError, EOFError):
            return found
        if not room.take(len(out)):
            raise _Full
        found = out, found[1] if found else len(data) - len(codec.unused_data)
        if out in seen:
            return found
        seen.add(out)
        data = out


def _coded(layer: Layer, room: _Room) -> Iterator[Layer]:
    """What base64 runs hold. Both alphabets are read as one and line breaks are left out. Where in a run the code begins
    is not known (a path or a word may stand before it), so it is read from each of four places on, which are all there
    are: compressed bytes are looked for everywhere, other text is what is UTF-8."""
    for m in _CODED.finditer(layer.text):
        if m.end() - m.start() < 12:
            continue
        run = m[0].rstrip("=")
        body = run.translate(_ALPHABET)
        n = len(body)
        if n < 12:
            continue

        def stretch(first: int, last: int) -> tuple[int, int]:
            if n < len(run):
                kept = [i for i, c in enumerate(run) if c not in " \t\r\n"]
                begin, end = kept[first], kept[min(last, n) - 1] + 1
            else:
                begin, end = first, last
            return layer.origin(m.start() + begin, m.end() if last >= n - 1 else m.start() + end)

        phases: dict[int, bytes] = {}

        def phase(p: int) -> bytes:
            if p not in phases:
                text = body[p : n - (n - p) % 4] if (n - p) % 4 == 1 else body[p:]
                phases[p] = base64.b64decode(text + "=" * (-len(text) % 4))
            return phases[p]

        until, packed = 0, []
        for hit in _PACKED.finditer(body):
            first = hit.start()
            if first < until:
                continue
            try:
                found = _unpacked(memoryview(phase(first % 4))[first // 4 * 3 :], room)
            except _Full:
                room.refused.append(stretch(first, n))
                continue
            if found:
                until = first + -(-found[1] * 4 // 3)
                packed.append((first, until))
                if _PLAIN.search(found[0]):
                    yield Layer(found[0].decode("utf-8", "replace"), region=stretch(first, until))
        if n < 16:
            continue
        for p in range(4):
            data = phase(p)
            if not _PLAIN.search(data):
                continue
            for part in _UTF8.finditer(data):
                if _PLAIN.search(part[0]):
                    ends = p + part.start() * 4 // 3, p + -(-part.end() * 4 // 3)
                    # names and short contents stand readable in compressed bytes, all of which are then the stretch
                    whole = next(((a, b) for a, b in packed if a <= ends[0] < b), ends)
                    yield Layer(part[0].decode("utf-8", "replace"), region=stretch(*whole))


def find_secrets(text: str, hints: set[str], most: int) -> tuple[list, set, int, int]:
    """Base spans; all spans, those of inner layers where the outermost encoded text stands; layers; layers refused."""
    base, spans, layers, refused = search(text, hints, most)
    return base, spans, layers, len(refused)


def search(text: str, hints: set[str], most: int) -> tuple[list, set, int, list[tuple[int, int]]]:
    """The same, with the stretches of the document that hold the refused layers.

    A worklist holds the layers not yet looked at. Each is searched, and what its escapes, escapes of code points and
    base64 runs decode to, bytes in any of them unpacked if compressed, is put on the list, until nothing new comes. Escapes are decoded in
    the stretches that hold them, as far as a pattern may reach around them. A layer that was seen at the same place of
    the document is not looked at again, which also ends cycles.
    """
    base = base_spans(text, hints)
    spans, room = set(base), _Room(most, len(text))
    if not hints & {"escaped", "unicode", "coded"}:
        return base, spans, 0, []
    work, seen, layers = [Layer(text)], set(), 0
    while work:
        layer = work.pop()
        decoded = (inner for part in _escapes(layer) for step in (_url, _unicode) for inner in step(part))
        for inner in chain(decoded, _coded(layer, room), _written(layer, room)):
            if not inner.text:
                continue
            place = inner.origin(0, len(inner.text))
            mark = (inner.region is None, place, inner.text)
            if mark in seen:
                continue
            if not room.look(len(inner.text)):
                room.refused.append(place)
                continue
            seen.add(mark)
            layers += 1
            spans |= {(kind, *inner.origin(a, b)) for kind, a, b in base_spans(inner.text)}
            work.append(inner)
    return base, spans, layers, room.refused


def _listed(spans) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("n_layers", pa.int64()),
        ("n_refused", pa.int64()),
    ]
)
_NONE = hashlib.sha256(b"").hexdigest()


def hints_of(texts: pa.Array) -> list[set[str]]:
    """What each text can hold, by a first look at the whole batch."""
    held = [set() for _ in range(len(texts))]
    for name, pattern in _HINTS.items():
        for i in pc.indices_nonzero(pc.match_substring_regex(texts, pattern)).to_pylist():
            held[i].add(name)
    return held


def scan_secrets(docs: DataFrame, most: int = 64 << 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of secrets in each whole text, a row per row of ``docs``.

    ``n_assign``, ``n_access``, ``n_hex`` and ``base_sha256`` are of the text as it stands; ``spans`` adds those of
    decoded layers. ``most`` is the number of bytes all compressed layers of one document may unpack to together; layers
    beyond it, and those of codes in codes after ``DEPTH`` times the document's length of other layers and as much again
    as ``most``, are not looked at and are counted in ``n_refused``. Null is an empty text, which has no
    spans; null and repeated keys are rows like any other; other columns are not looked at.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            columns = {n: [] for n in _FOUND.names}
            columns["doc_id"] = batch.column("doc_id").to_pylist()
            for hints, value in zip(hints_of(texts), texts, strict=True):
                if hints:
                    base, spans, layers, refused = find_secrets(value.as_py(), hints, most)
                else:
                    base, spans, layers, refused = [], (), 0, 0
                for kind in KINDS:
                    columns[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                columns["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest() if base else _NONE)
                columns["spans"].append(_listed(spans))
                columns["n_layers"].append(layers)
                columns["n_refused"].append(refused)
            yield table(_FOUND, **columns)

    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_refused long"
    )
    return texts_of(docs, key, text).mapInArrow(scan, schema)


def redact(docs: DataFrame, mask: str = "[SECRET]", most: int = 64 << 20, text: str = "text") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mask``; spans that touch or overlap get one. A stretch whose
    layers there is no room for (see ``scan_secrets``) may hide a secret and is masked as a whole. All other columns and
    rows stay, null texts stay null."""
    place = docs.columns.index(text)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            values = batch.column(place)
            texts = pc.fill_null(values, "")
            out = values.to_pylist()
            for i, hints in enumerate(hints_of(texts)):
                if hints:
                    _, spans, _, refused = search(out[i], hints, most)
                    out[i] = _masked(out[i], spans | {("refused", *place) for place in refused}, mask)
            columns = list(batch.columns)
            columns[place] = pa.array(out, values.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(rewrite, docs.schema)


def _masked(text: str, spans: set, mask: str) -> str:
    parts, at, until = [], 0, -1
    for start, end in sorted((a, b) for _, a, b in spans):
        if start > until:
            if until >= 0:
                at = until
            parts += [text[at:start], mask]
        until = max(until, end)
    return "".join(parts) + text[max(until, 0) :]

import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest

from chuvisco.llm.archives import ArchiveReader, archived_pages, read_archives, write_archives

SCHEMA = "page_id long, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def by_hand(rows, least=0):
    payloads = [(i, (html or "").encode()) for i, _, html, *_ in rows]
    first = {}
    for i, p in payloads:
        if i is not None and len(p) >= least:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payloads:
        again = p in first and first[p] != i
        out.append((i, len(p), digest(p), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


rng = random.Random(3)
ODD = [
    (1, "http://a/", "x"),
    (2, None, "x"),
    (-3, "http://a/ b\r\nWARC-Type: fake", "x"),
    (4, "u", None),
    (5, "u", ""),
    (5, "u", ""),  # a row twice
    (5, "u", "another"),  # a key twice
    (None, "u", "x"),
    (None, "u", "only"),
    (6, "u", "ends\r\n"),
    (7, "u", "\r\n\r\n"),
    (8, "u", "WARC/1.1\r\nContent-Length: 9\r\n\r\nfake\r\n\r\nWARC/1.1\r\n"),
    (9, "u", "é漢😀" * 40),
    (10, "u", "\r\n\r" * 33),
    (11, "u", "".join(rng.choice("ab\n\ré") for _ in range(5000))),
    (12, "u", "z" * 64),
    (13, "u", "z" * 65),
    (14, "u", "z" * 63),
]


@pytest.mark.parametrize("chunk", [64, 1 << 18])
@pytest.mark.parametrize("least", [0, 1, 70])
def test_rows_equal_brute_force(spark, chunk, least):
    copies = [(100 + i, "v", "a copy of many\n" * 9) for i in range(60)]
    df = spark.createDataFrame([(*r, 1, "p") for r in ODD + copies], SCHEMA + ", first int, payload string")
    assert rows_of(archived_pages(df, least, chunk)) == by_hand(ODD + copies, least)


def test_joined_where_repeated_payloads_are_many(spark, monkeypatch, settings):
    monkeypatch.setattr("chuvisco.llm.archives.SMALL", 0)
    settings(spark__sql__autoBroadcastJoinThreshold=-1)
    df = spark.createDataFrame(ODD, SCHEMA)
    assert rows_of(archived_pages(df)) == by_hand(ODD)


def test_no_pages(spark):
    assert rows_of(archived_pages(spark.createDataFrame([], SCHEMA))) == []


def test_chunks_give_back_payloads_and_running_digests(spark, tmp_path):
    write_archives(spark.createDataFrame(ODD, SCHEMA).coalesce(2), str(tmp_path / "a"), chunk=64)
    chunks = {}
    for r in read_archives(spark, str(tmp_path / "a"), chunk=64).collect():
        assert len(r.data) == r.size <= 64
        chunks.setdefault((r.record_id, r.record_type, r.declared), []).append(r)
    payloads = {(i, (html or "").encode()) for i, _, html in ODD}
    seen = set()
    for (name, kind, declared), rows in chunks.items():
        if kind == "revisit":
            continue
        rows.sort(key=lambda r: r.chunk)
        if name == "<urn:page:5>" and declared == "sha1:" + digest(b""):
            rows = rows[:1]
        held = b""
        for n, r in enumerate(rows):
            assert (r.chunk, r.start) == (n, len(held))
            held += r.data
            assert r.digest == digest(held) and r.last == (n == len(rows) - 1)
        assert declared == "sha1:" + digest(held)
        key = name[len("<urn:page:") : -1]
        seen.add((int(key) if key else None, held))
    # what a revisit refers to stands for it
    assert {p for _, p in seen} == {p for _, p in payloads}


def test_files_are_warc(spark, tmp_path):
    """A reader of another make: header lines, then as many bytes as they say, then two line ends."""
    write_archives(spark.createDataFrame(ODD, SCHEMA), str(tmp_path / "a"), chunk=64)
    kinds, lines_of = [], []
    for file in Path(tmp_path / "a").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(line.split(b": ", 1) for line in lines[1:])
            assert {b"WARC-Record-ID", b"WARC-Date", b"WARC-Type"} <= fields.keys()
            size = int(fields[b"Content-Length"])
            assert data[size : size + 4] == b"\r\n\r\n"
            data = data[size + 4 :]
            kinds.append(fields[b"WARC-Type"])
            lines_of.append(fields[b"WARC-Record-ID"])
    assert kinds.count(b"response") + kinds.count(b"revisit") == len(ODD)
    assert kinds.count(b"continuation") > 10


def archive(*records):
    return b"".join(b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(p), p) for i, p in enumerate(records))


@pytest.mark.parametrize("step", [1, 7, 10_000])
def test_a_record_in_one_piece_comes_in_chunks_however_it_is_fed(step):
    data, reader, rows = archive(b"a" * 1000, b"", b"\r\n\r\n"), ArchiveReader(300), []
    for i in range(0, len(data), step):
        rows += reader.feed(data[i : i + step])
    reader.finish()
    assert [(r[0], r[5], r[6], r[7], r[9]) for r in rows] == [
        ("<0>", 0, 0, 300, False), ("<0>", 1, 300, 300, False), ("<0>", 2, 600, 300, False), ("<0>", 3, 900, 100, True),
        ("<1>", 0, 0, 0, True), ("<2>", 0, 0, 4, True),
    ]


def test_broken_archives_are_refused():
    for data in (archive(b"abc")[:-6], b"junk\r\n\r\n", archive(b"abc").replace(b"Length: 3", b"Length: 2")):
        reader = ArchiveReader(300)
        with pytest.raises(ValueError):
            list(reader.feed(data))
            reader.finish()

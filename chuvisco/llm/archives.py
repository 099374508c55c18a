"""WARC archives written and read as a table of chunks, so that no task holds a large record whole."""

from __future__ import annotations

from base64 import b32encode
from collections.abc import Iterator
from functools import partial
from hashlib import sha1
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chuvisco.llm.shared import stored, work_folder

#: Payload bytes of a row; a larger payload takes several.
CHUNK = 1 << 18
#: Groups of equal payloads that a join may send to all tasks (40 bytes each).
SMALL = 1 << 19

# Line ends of the format, its digits of base 32 and those of Spark's ``conv``.
END = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_of(hexadecimal: Column) -> Column:
    """Forty hexadecimal digits in base 32: five of the former are four of the latter."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def _head(*lines: Column) -> Column:
    """Lines of a header, each with its end, and an empty one; a null line is left out."""
    ended = [F.coalesce(F.concat(line, F.lit(END)), F.lit("")) for line in lines]
    return F.concat(*ended, F.lit(END))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def key_of(record: Column) -> Column:
    return F.nullif(F.regexp_extract(record, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    chunk: int = CHUNK,
) -> None:
    """Each of ``pages`` as a WARC 1.1 record in gzip files below ``path``, one file a task.

    Of pages with equal payloads of ``least`` bytes or more, the ones with the smallest key are ``response`` records, the
    others ``revisit`` records without payload that name it. A payload of more than ``chunk`` bytes goes on in
    ``continuation`` records right after. A null payload is empty. Pages with a null key revisit a page with equal payload
    that has one; without such a page they are responses. Rows that repeat key and payload are alike: all of the smallest
    key are responses. A null URL is left out. Other columns take no part; no pages give no record.

    Payloads stay in the tasks that read them, as what a join needs to know is a row for each *repeated* payload. Only
    where these are too many to be sent to all tasks do payloads move; a payload that a third of the pages have is
    then split by adaptive execution.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("id"),
        F.regexp_replace(F.col(url).cast("string"), "[\\x00-\\x20\\x7F]", "%20").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"size": F.octet_length("payload"), "same": F.unhex(F.sha2("payload", 256))})
    groups = rows.filter(F.col("size") >= least).groupBy("same").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = stored(groups.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("same", "first"))
    marked = rows.join(F.broadcast(repeated) if repeated.count() <= SMALL else repeated, "same", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    cuts = F.when(again, 0).otherwise(F.floor((F.col("size") - 1) / chunk))
    sized = marked.select(
        "id", "url", "first", "size", "payload", again.alias("again"), F.greatest(cuts, F.lit(0)).cast("int").alias("cuts"),
        base32_of(F.sha1("payload")).alias("digest"),
    )
    parts = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("cuts"))))
    part, several = F.col("part"), F.col("cuts") > 0
    body = F.when(F.col("again"), F.lit(b"")).otherwise(F.substring("payload", part * chunk + 1, F.lit(chunk)))
    answer = _head(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _line("Content-Length", F.col("size")))
    http = F.when(part == 0, answer).otherwise("")
    kind = F.when(part > 0, "continuation").when(F.col("again"), "revisit").otherwise("response")
    own = F.concat(F.rtrim("own", F.lit(">")), F.lit("-"), part + 1, F.lit(">"))
    head = _head(
        F.lit("WARC/1.1"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.when(part == 0, F.col("own")).otherwise(own)),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        F.when(part == 0, _line("Content-Type", F.lit("application/http;msgtype=response"))),
        F.when(part == 0, _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))),
        F.when(F.col("again"), _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.when(F.col("again"), _line("WARC-Refers-To", record_id(F.col("first")))),
        F.when(several, _line("WARC-Segment-Number", part + 1)),
        F.when(part > 0, _line("WARC-Segment-Origin-ID", F.col("own"))),
        F.when(several & (part == F.col("cuts")), _line("WARC-Segment-Total-Length", F.col("size") + F.octet_length(answer))),
        _line("Content-Length", F.octet_length(http) + F.octet_length("body")),
    )
    records = parts.withColumns({"own": record_id(F.col("id")), "body": body})
    value = F.concat(F.encode(head, "UTF-8"), F.encode(http, "UTF-8"), F.col("body")).cast("string")
    records.select(value.alias("value")).write.option("lineSep", END + END).option("compression", "gzip").text(path)


class ArchiveReader:
    """Takes the bytes of one archive as they come and gives payloads in chunks, each with the digest up to its end."""

    def __init__(self, chunk: int) -> None:
        self.chunk, self.held = chunk, bytearray()
        self.left: int | None = None  # bytes of the block still to come; None before a header
        self.open: str | None = None  # record whose payload goes on

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.held += data
        at = 0
        while True:
            if self.left is None:
                end = self.held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self._begin(bytes(self.held[at:end]))
                at = end + 4
            elif self.left:
                taken = bytes(self.held[at : at + min(self.left, self.chunk)])
                if not taken:
                    break
                yield from self._add(taken)
                at += len(taken)
                self.left -= len(taken)
            else:
                if len(self.held) - at < 4:
                    break
                if self.held[at : at + 4] != b"\r\n\r\n":
                    raise ValueError("a record is longer than it says")
                at, self.left = at + 4, None
                if self.last:
                    yield self._row(True)
                    self.open = None
        del self.held[:at]

    def finish(self) -> None:
        if self.held.strip() or self.left is not None or self.open is not None:
            raise ValueError("an archive ends within a record")

    def _begin(self, head: bytes) -> None:
        first, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record starts with {first[:40]!r}")
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        self.left = int(fields["content-length"])
        if fields["warc-type"] == "continuation":
            if fields["warc-segment-origin-id"] != self.open:
                raise ValueError(f"a segment of {fields['warc-segment-origin-id']} does not follow it")
            self.last = "warc-segment-total-length" in fields
            return
        if self.open is not None:
            raise ValueError(f"{self.open} is not continued")
        self.open, self.last = fields["warc-record-id"], "warc-segment-number" not in fields
        declared = fields.get("warc-payload-digest")
        self.about = (self.open, fields["warc-type"], fields.get("warc-target-uri"), fields.get("warc-refers-to"), declared)
        self.http = bytearray() if fields.get("content-type", "").startswith("application/http") else None
        self.sum, self.body, self.place, self.start = sha1(), bytearray(), 0, 0

    def _add(self, data: bytes) -> Iterator[tuple]:
        if self.http is not None:
            self.http += data
            end = self.http.find(b"\r\n\r\n")
            if end < 0:
                return
            data, self.http = bytes(self.http[end + 4 :]), None
        self.body += data
        while len(self.body) > self.chunk:
            yield self._row(False)

    def _row(self, last: bool) -> tuple:
        data = bytes(self.body[: self.chunk])
        del self.body[: self.chunk]
        self.sum.update(data)
        row = (*self.about, self.place, self.start, len(data), b32encode(self.sum.digest()).decode(), last, data)
        self.place, self.start = self.place + 1, self.start + len(data)
        return row


_NAMES = "record_id", "record_type", "target_uri", "refers_to", "declared", "chunk", "start", "size", "digest", "last", "data"
_TYPES = [*[pa.string()] * 5, pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.binary()]


def _chunks(chunk: int, with_data: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = len(_NAMES) - (not with_data)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))[:width]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], list(_NAMES[:width]))

    name, reader, rows, room = None, ArchiveReader(chunk), [], 0
    for batch in batches:
        lines = zip(batch.column("file").to_pylist(), batch.column("line").to_pylist())
        for file, held in groupby(lines, lambda x: x[0]):
            if file != name:
                reader.finish()
                name, reader = file, ArchiveReader(chunk)
            for _, line in held:
                for row in reader.feed(line + b"\n"):
                    rows.append(row if with_data else row[:width])
                    room += row[7] if with_data else 100
                    if room > 1 << 22:
                        yield made(rows)
                        rows, room = [], 0
    reader.finish()
    if rows:
        yield made(rows)


def read_archives(spark: SparkSession, path: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The records of gzip archives below ``path`` as rows of ``record_id`` and ``chunk`` (from 0).

    ``data`` are up to ``chunk`` bytes of payload from byte ``start`` on (left out without ``with_data``), ``digest`` the
    SHA-1 in base 32 of the payload up to their end, so that of the ``last`` row is the whole payload's. An empty payload
    has one row. Segments of a record are joined and must follow one another. HTTP headers are no payload.

    A task streams the lines of an archive; what it holds is a line and a chunk. A file that ends within a record, or a
    record of another length than it says, makes the query fail. No archives give no rows.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    schema = (
        "record_id string, record_type string, target_uri string, refers_to string, declared string, chunk int, start long, "
        "size int, digest string, last boolean" + (", data binary" if with_data else "")
    )
    return lines.mapInArrow(partial(_chunks, chunk, with_data), schema)


def archived_pages(pages: DataFrame, least: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Writes ``pages`` to archives, reads these and gives a row per record: its page, the length and digest of its payload,
    its type and, for a revisit, the page it refers to, whose payload it has. Odd rows as for :func:`write_archives`.

    A revisit's length is that of the record it refers to, found by key and digest. A payload that does not have the
    digest its record gives makes the query fail.
    """
    spark = pages.sparkSession
    folder = work_folder(spark)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    write_archives(pages, folder, least=least, chunk=chunk)
    ends = read_archives(spark, folder, chunk, with_data=False).filter("last")
    found = stored(
        ends.select(
            key_of(F.col("record_id")).alias("page_id"),
            (F.col("start") + F.col("size")).alias("payload_bytes"),
            F.col("digest").alias("payload_digest"),
            "record_type",
            key_of(F.col("refers_to")).alias("refers_to"),
            F.regexp_replace("declared", "^sha1:", "").alias("declared"),
        )
    )
    same = F.col("payload_digest") == F.col("declared")
    message = F.concat(F.lit("wrong digest in record of page "), F.col("page_id").cast("string"))
    whole = found.filter(F.col("record_type") == "response").withColumn(
        "payload_digest", F.when(same, F.col("payload_digest")).otherwise(F.raise_error(message))
    )
    lengths = whole.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared")).agg(
        F.max("payload_bytes").alias("payload_bytes")
    )
    again = found.filter(F.col("record_type") == "revisit").drop("payload_bytes", "payload_digest")
    again = again.join(lengths, ["refers_to", "declared"], "left").withColumn("payload_digest", F.col("declared"))
    return whole.drop("declared").unionByName(again.drop("declared"))

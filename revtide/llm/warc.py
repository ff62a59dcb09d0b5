"""WARC archives: written as one gzip stream each, normalised to one member per record, with an index.

Crawlers that compress an archive as a whole make every read start at its first byte. The normaliser
inflates each such stream once, in pieces, cuts it into records, compresses every record as a gzip
member of its own and writes the members one after the other, with a sidecar index of their offsets. A
reader then opens single records.

All files are written and read by Spark, so they may be in any store that Spark reaches. The text sink
writes rows and separators as they are: with the record separator between records, and gzip, it makes a
WARC stream. For members the separator is one zero byte. The last byte of a gzip member is the highest of the
32 bits of its length, zero below 16 MiB, so it is left to the separator; a longer record is followed by an
empty member, which ends in zero too.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from revtide.llm.common import text_batches
from revtide.session import scratch_path, stored

#: Payloads from this size on are stored once.
MIN_DEDUP_BYTES = 1_000
RECORDS_PER_ARCHIVE = 20_000
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
PIECE = 1 << 20

# Fixed values of the format.
BREAK = "\r\n"
RECORD_END = BREAK * 2
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = "record_id string, offset long, length long"


def decided(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """page_id, url, payload, digest, size, and first: the id of the record that holds the payload.

    Of equal payloads of at least ``MIN_DEDUP_BYTES`` bytes the largest id holds it (rows that share
    that id all do); a null payload is empty; without any id every row holds its own. Digests that occur
    once are left out before the join, so pages do not move unless duplicates abound.
    """
    payload = F.coalesce(pages[html], F.lit("")).cast("binary")
    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size"),
    )
    large = rows.filter(F.col("size") >= MIN_DEDUP_BYTES).groupBy(F.col("digest").alias("_digest"))
    several = large.agg(F.max("page_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    several = stored(several.select("_digest", "first"), "several")
    same = (rows["digest"] == several["_digest"]) & (rows["size"] >= MIN_DEDUP_BYTES)
    return rows.join(several, same, "left").drop("_digest")


@pandas_udf(StringType())
def _quoted(urls: pd.Series) -> pd.Series:
    return urls.map(lambda u: None if u is None else quote(u, safe="!#$&'()*+,/:;=?@[]~"))


def record(rows: DataFrame) -> Column:
    """A record as binary: header lines, the HTTP head, and the payload unless it is a revisit."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("first").isNotNull() & (F.coalesce("page_id", F.lit(-1)) != F.col("first")) | (
        F.col("first").isNotNull() & F.col("page_id").isNull()
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.col("size").cast("string"), F.lit(RECORD_END),
    )
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), _quoted(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(
            F.lit("Content-Length: "),
            (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))).cast("string"),
        ),
    ]
    head = F.concat_ws(BREAK, *lines)
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    return F.concat(F.concat(head, F.lit(RECORD_END), http).cast("binary"), body)


def write_monolithic(pages: DataFrame, path: str, page_id="page_id", url="url", html="html") -> None:
    """Archives below ``path``, each one gzip stream."""
    text_batches(pages.sparkSession)
    records = decided(pages, page_id, url, html)
    records.select(record(records).cast("string").alias("value")).write.option(
        "compression", "gzip").option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


def inflated(content: bytes) -> Iterator[bytes]:
    """A gzip file in pieces, whatever its number of members."""
    view, at, size = memoryview(content), 0, len(content)
    while at < size:
        engine = zlib.decompressobj(wbits=31)
        pending = b""
        while not engine.eof and (pending or at < size):
            if not pending:
                pending, at = bytes(view[at:at + PIECE]), at + PIECE
            yield engine.decompress(pending, PIECE)
            pending = engine.unconsumed_tail
        if not engine.eof:
            raise EOFError("the gzip stream ends early")
        at = min(at, size) - len(engine.unused_data)
        while at < size and view[at] == 0:
            at += 1


def head_fields(head: bytes) -> dict[str, str]:
    """Header lines of a record by lower-case name."""
    lines = head.decode("utf-8", "replace").split(BREAK)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record with its end) of a WARC stream; at most one record is held."""
    end, buffer = RECORD_END.encode(), bytearray()

    def grown(enough) -> bool:
        while not enough():
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while grown(lambda: buffer.find(end) >= 0):
        cut = buffer.find(end) + len(end)
        fields = head_fields(bytes(buffer[:cut - len(end)]))
        size = cut + int(fields["content-length"]) + len(end)
        if not grown(lambda: len(buffer) >= size):
            raise EOFError("the archive ends inside a record")
        yield fields, bytes(buffer[:size])
        del buffer[:size]
    if buffer.strip():
        raise EOFError("the archive ends inside a header")


def member(raw: bytes) -> bytes:
    """A gzip member whose last byte is zero."""
    packed_record = gzip.compress(raw, LEVEL, mtime=0)
    return packed_record if packed_record[-1] == 0 else packed_record + gzip.compress(b"", LEVEL, mtime=0)


def _normalised(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (archive, part, at, value): the members of each archive, then its index as one more row.

    Values lack their last byte, a zero.
    """
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            archive = path.rsplit("/", 1)[1].split(".")[0]
            offset, entries, batch = 0, [], []
            for at, (fields, raw) in enumerate(records_of(inflated(content))):
                data = member(raw)
                entries.append(json.dumps(
                    {"id": fields["warc-record-id"], "offset": offset, "length": len(data)}
                ))
                offset += len(data)
                batch.append((archive, "data", at, data[:-1]))
                if len(batch) == 64:
                    yield pd.DataFrame(batch, columns=["archive", "part", "at", "value"])
                    batch = []
            index = member("\n".join(entries).encode())
            batch.append((archive, "index", 0, index[:-1]))
            yield pd.DataFrame(batch, columns=["archive", "part", "at", "value"])


def normalise(spark: SparkSession, source: str, path: str) -> None:
    """Rewrite the archives of ``source``: ``archive=…/part=data`` has a file of members, ``part=index``
    the gzipped sidecar, a JSON line (id, offset, length) per record.

    An archive is read whole as one row, so its compressed size is what a task holds at least.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    rows = files.select("path", "content").mapInPandas(
        _normalised, "archive string, part string, at long, value binary"
    ).sortWithinPartitions("archive", "part", "at")
    rows.select("archive", "part", F.col("value").cast("string").alias("value")).write.partitionBy(
        "archive", "part").option("lineSep", "\0").text(path)


def _entries(index: pd.Series) -> pd.Series:
    return index.map(lambda raw: [
        (e["id"], e["offset"], e["length"]) for e in map(json.loads, gzip.decompress(raw).decode().splitlines())
    ])


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(archive, record_id, record_type, url, date, payload_digest, payload_bytes, refers_to, payload) of
    every record, each opened at its place in the index.

    The payload is null for revisits, and for all without ``payloads``; payload_bytes is the length that the HTTP head states. A record whose
    payload differs from its digest or length, or whose id is not that of the index, fails the job.
    """
    def files(part: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.txt").load(path)
        return found.filter(F.col("path").contains(f"/part={part}/")).select(
            F.regexp_extract("path", "archive=([^/]*)/", 1).alias("archive"), F.col("content").alias(part)
        )

    both = files("data").join(files("index"), "archive")
    columns = (
        "archive string, record_id string, record_type string, url string, date string, "
        "payload_digest string, payload_bytes long, refers_to string, payload binary"
    )
    return both.mapInPandas(lambda frames: _opened(frames, payloads), columns)


def _opened(frames: Iterator[pd.DataFrame], payloads: bool) -> Iterator[pd.DataFrame]:
    names = [
        "archive", "record_id", "record_type", "url", "date",
        "payload_digest", "payload_bytes", "refers_to", "payload",
    ]
    for frame in frames:
        for archive, data, entries in zip(frame["archive"], frame["data"], _entries(frame["index"])):
            view, rows = memoryview(data), []
            for record_id, offset, length in entries:
                raw = gzip.decompress(view[offset:offset + length])
                (fields, whole), = records_of(iter([raw]))
                head = whole.index(RECORD_END.encode()) + 4
                block = whole[head:-4]
                http, _, payload = block.partition(RECORD_END.encode())
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                kind, uri = fields["warc-type"], fields.get("warc-target-uri")
                if fields["warc-record-id"] != record_id or kind == "response" and (
                    len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
                ):
                    raise ValueError(f"record {record_id} of {archive} is damaged")
                rows.append((
                    archive, record_id, kind, uri and unquote(uri), fields["warc-date"], digest, size,
                    fields.get("warc-refers-to"), payload if payloads and kind == "response" else None,
                ))
                if len(rows) == 256:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)


def page_of(record_id: Column) -> Column:
    """The page id in a record id, null if the page has none."""
    return F.regexp_extract(record_id, "<urn:page:(.*)>", 1).try_cast("long")


def archived(
    pages: DataFrame, page_id="page_id", url="url", html="html", payloads: bool = True
) -> DataFrame:
    """Write pages to archives in the shared folder, normalise them and read all records back."""
    spark = pages.sparkSession
    write_monolithic(pages, source := scratch_path(spark, "monolithic"), page_id, url, html)
    normalise(spark, source, path := scratch_path(spark, "normalised"))
    return read_records(spark, path, payloads)

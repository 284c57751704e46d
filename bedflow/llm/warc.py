"""WARC archives with their revisits resolved.

``deduplicated`` takes records (one row each, with the payload), finds those
with equal payloads from their headers alone, and writes archives in which the
first of each group is a ``response`` and the others are ``revisit`` records
that refer to it.  ``read_archives`` parses archives back into records, and
``resolved`` joins revisits with the responses they refer to, so that every
record has its full payload's size and digest again.  ``rewritten`` reads
existing archives, with revisits of their own, and writes them anew.

Headers (row, id, digest, size, address; never the payload) are shuffled by payload digest.
A digest that occurs once needs nothing more; the first record of each other
digest is joined back to the group's headers, and digests of very many records
apart from the rest (``looked_up``).  The payloads move once, dealt by row over as many archives as
their bytes need; an archive holds about ``ARCHIVE_BYTES``, or one record.

An archive is a gzip file of WARC/1.1 records.  A record's block is an HTTP
response head, and for a response the payload in UTF-8; a revisit keeps the head,
with the length of the full payload.  Ids are made from the row, so a repeated
task writes the same bytes.  Blocks are read by Content-Length: a payload may hold
anything, header lines included.

Null payloads are empty.  Records with a null page_id come last in a group, and
their archive record has no ``WARC-X-Page-Id``.  Rows that repeat a page_id are
records of their own (equal ones: the first read is the response).  Control
characters in an address are percent-encoded, a null address is
``urn:page:unknown``.  Other columns are ignored, whatever their names.  An
empty table gives no records.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedflow.llm.common import stage
from bedflow.session import shared_dir

#: Payloads below this size are always written in full.
MIN_REVISIT = 100
#: Bytes of payload that an archive is meant to hold.
ARCHIVE_BYTES = 16 << 20
#: A key of more rows than this is joined apart; such keys are at most one in HOT_ROWS rows.
HOT_ROWS = 10_000
#: Hot keys up to this number (under 200 bytes each) are broadcast; beyond it their rows are salted.
BROADCAST_KEYS = 50_000
SALTS = 64
#: Bytes handed from an archive to the parser at once.
CHUNK = 1 << 20

# The record format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-15T04:00:00Z"
CRLF = "\r\n"
RECORD_END = CRLF + CRLF

HEADERS = ("row", "page_id", "uri", "date", "payload_bytes", "payload_digest")
RECORDS = ("page_id long, record_id string, record_type string, uri string, date string, refers_to_id string, "
           "payload_bytes long, payload_digest string, declared_digest string, payload string")


# --- joins with hot keys -------------------------------------------------------

def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` inner-joined with ``table``, which has a ``key`` at most once and
    a count ``n`` of the rows that ask for it.  Keys of more than ``HOT_ROWS``
    rows are broadcast if a count shows that they are few, else salted."""
    hot = table.where(F.col("n") > HOT_ROWS)
    number = hot.limit(BROADCAST_KEYS + 1).count()
    if not number:
        return rows.join(table, key)
    cold = table.where(F.col("n") <= HOT_ROWS)
    if number <= BROADCAST_KEYS:
        return rows.join(cold, key).unionByName(rows.join(F.broadcast(hot), key))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    copies = hot.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(cold, key).unionByName(salted.join(copies, [key, "_salt"]).drop("_salt"))


# --- writing -------------------------------------------------------------------

def page_records(pages: DataFrame) -> DataFrame:
    """Records of a table of pages (page_id, url, html): row, page_id, uri,
    date, payload, payload_bytes, payload_digest, refers_to_id."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("uri"),
        F.lit(DATE).alias("date"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"))


def revisits(headers: DataFrame) -> DataFrame:
    """(row, original): the records that revisit another one's payload, with
    the header (page_id, row, uri, date) of that record.

    ``headers`` has row, page_id, uri, date, payload_bytes and payload_digest.  The
    group's first record by page_id (nulls last), then row, is the original.
    """
    sized = headers.where(F.col("payload_bytes") >= MIN_REVISIT)
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row", "uri", "date"))
    groups = stage(sized.groupBy("payload_digest").agg(first.alias("original"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1"), "warc-originals")
    return (looked_up(sized.select("row", "payload_digest"), groups, "payload_digest")
            .where(F.col("row") != F.col("original.row")).select("row", "original"))


def record_id(row: Column, run: str) -> Column:
    """The id of a row's record: a version 5 style UUID of the row and the run."""
    digest = F.md5(F.concat(F.lit(run + ":"), row.cast("string")).cast("binary"))
    cut = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2], F.lit("-8"), cut[3],
                    F.lit("-"), cut[4], F.lit(">"))


def _address(uri: Column) -> Column:
    """One line without blanks at its ends; control characters percent-encoded."""
    safe = F.coalesce(uri, F.lit("urn:page:unknown"))
    for code in (*range(33), 127):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return safe


def record_text(run: str) -> Column:
    """A record without the two empty lines that end it, from row, page_id,
    uri, date, payload, payload_bytes, payload_digest, original (null: a
    response) and outside (the id that a revisit of an unknown response refers to)."""
    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))

    first = F.col("original")
    again = first.isNotNull() | F.col("outside").isNotNull()
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(head, F.when(again, "").otherwise(F.col("payload")))
    return F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("row"), run)),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", _address(F.col("uri"))),
        line("WARC-X-Page-Id", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(again, REVISIT_PROFILE)),
        line("WARC-Refers-To", F.coalesce(F.when(first.isNotNull(), record_id(first["row"], run)),
                                          F.nullif(F.col("outside"), F.lit("")))),
        line("WARC-Refers-To-Target-URI", F.when(first.isNotNull(), _address(first["uri"]))),
        line("WARC-Refers-To-Date", first["date"]),
        F.lit("Content-Type: application/http;msgtype=response" + CRLF),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block)


def deduplicated(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Writes the archives of ``records`` (as of ``page_records``) under ``path``."""
    # payloads are kept twice for a while (here and in the shuffle), so compressed well
    staged = stage(records.withColumn("row", F.monotonically_increasing_id()), "warc-records", compression="zstd")
    again = stage(revisits(staged.select(*HEADERS)), "warc-revisits")
    return _written(staged.withColumn("outside", F.lit(None).cast("string")), again, path, archive_bytes)


def _written(records: DataFrame, again: DataFrame, path: str, archive_bytes: int) -> str:
    size = records.agg(F.sum("payload_bytes")).first()[0] or 0
    archives = max(1, math.ceil(size / archive_bytes))
    # the join deals the rows over the archives; the payloads move once
    rows = records.repartition(archives, "row").join(again.repartition(archives, "row"), "row", "left")
    rows.select(record_text(uuid.uuid4().hex).alias("value")).write.option("lineSep", RECORD_END).option(
        "compression", "gzip").text(path)
    return path


# --- reading -------------------------------------------------------------------

class Stream:
    """Bytes of an archive (gzip, of one member or many, or plain), decompressed as they are asked for."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = memoryview(data), 0
        self.packed = bytes(self.data[:2]) == b"\x1f\x8b"
        self.unzip = zlib.decompressobj(31) if self.packed else None
        self.buffer = bytearray()

    def more(self) -> bool:
        if not self.packed or not self.unzip.eof:
            chunk = self.data[self.at:self.at + CHUNK]
            self.at += len(chunk)
            if not chunk:
                return False
            self.buffer += self.unzip.decompress(chunk) if self.packed else chunk
            if self.packed and self.unzip.eof:
                self.at -= len(self.unzip.unused_data)
            return True
        if self.at >= len(self.data):
            return False
        self.unzip = zlib.decompressobj(31)
        return self.more()

    def line(self) -> bytes | None:
        """The next line without its end; None after the last."""
        while (end := self.buffer.find(b"\n")) < 0:
            if not self.more():
                if not self.buffer:
                    return None
                end = len(self.buffer)
                break
        out = bytes(self.buffer[:end]).rstrip(b"\r")
        del self.buffer[:end + 1]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.more():
                raise ValueError(f"archive ends {n - len(self.buffer)} bytes before its record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record."""
    stream = Stream(data)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers: dict[str, str] = {}
        while line := stream.line():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.take(int(headers["content-length"]))


def record_row(headers: dict[str, str], block: bytes) -> dict:
    """A record as a row of ``RECORDS``; of a revisit the size and digest are those declared."""
    head, _, payload = block.partition(b"\r\n\r\n")
    kind = headers["warc-type"]
    declared = headers.get("warc-payload-digest", "").partition(":")[2] or None
    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    if kind == "revisit":
        lengths = [x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size, digest = (int(lengths[0]) if lengths else None), declared
    elif declared and declared != digest:
        raise ValueError(f"payload of {headers.get('warc-record-id')} does not match its digest")
    page = headers.get("warc-x-page-id")
    return {"page_id": int(page) if page else None, "record_id": headers.get("warc-record-id"), "record_type": kind,
            "uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"),
            "refers_to_id": headers.get("warc-refers-to"), "payload_bytes": size, "payload_digest": digest,
            "declared_digest": declared, "payload": payload}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records (``RECORDS``) of all archives under
    ``path``; ``payloads`` = False leaves the payload null, after its size and
    digest are taken."""
    types = {"long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in RECORDS.split(", ")]
    schema = pa.schema([(n, types[t]) for n, t in fields])

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files.column("content"):
                rows, held = [], 0
                for headers, block in parsed(content.as_py()):
                    if headers.get("warc-type") not in ("response", "revisit"):
                        continue
                    row = record_row(headers, block)
                    row["payload"] = row["payload"].decode("utf-8") if payloads else None
                    rows.append(row)
                    held += len(block) if payloads else 1000
                    if held >= CHUNK:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def _asks(records: DataFrame) -> DataFrame:
    """The revisits, with the ``key`` of the response they ask for: the record
    they refer to, or without one a record with their digest."""
    by_digest = F.concat(F.lit("sha256:"), F.col("declared_digest"))
    return records.where("record_type = 'revisit'").withColumn(
        "key", F.coalesce("refers_to_id", by_digest, F.lit("")))


def _answers(records: DataFrame, asks: DataFrame) -> DataFrame:
    """(key, n, and the header of the response asked for, or nulls), one row a
    key: of a digest's responses the first."""
    wanted = asks.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    response = F.struct(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("answer_bytes"),
                        F.col("payload_digest").alias("answer_digest"), F.col("record_id").alias("answer_id"))
    responses = records.where("record_type = 'response'").select("row", "record_id", "payload_digest",
                                                                 response.alias("r"))
    keyed = responses.select("row", "r", F.explode(F.array(
        "record_id", F.concat(F.lit("sha256:"), F.col("payload_digest")))).alias("key"))
    first = keyed.groupBy("key").agg(F.min(F.struct("row", "r")).alias("first"))
    return stage(wanted.join(first, "key", "left").select("key", "n", "first.r.*"), "warc-answers")


def resolved(records: DataFrame) -> DataFrame:
    """Records (row, page_id, record_type, payload_bytes, payload_digest,
    refers_to) with revisits joined to the responses they refer to, whose size
    and digest they take.  A revisit whose response is not among the records
    keeps the size and digest it declares, and refers to null."""
    numbered = records.withColumn("row", F.monotonically_increasing_id())
    asks = _asks(numbered).select("row", "page_id", "payload_bytes", "payload_digest", "key")
    found = looked_up(asks, _answers(numbered, _asks(numbered)), "key").select(
        "row", "page_id", F.lit("revisit").alias("record_type"),
        F.coalesce("answer_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("answer_digest", "payload_digest").alias("payload_digest"), "refers_to")
    whole = numbered.where("record_type = 'response'").select(
        "row", "page_id", "record_type", "payload_bytes", "payload_digest", F.lit(None).cast("long").alias("refers_to"))
    return whole.unionByName(found)


def rewritten(spark: SparkSession, source: str, target: str, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Reads the archives under ``source`` and writes their records anew under
    ``target``, with fresh headers and the revisits that the payloads call for.

    Headers decide which record holds a payload; a payload moves only to a
    record that had none and now is the response.  A revisit whose response is
    not in the archives is written as it was.
    """
    records = stage(read_archives(spark, source).withColumn("row", F.monotonically_increasing_id()), "warc-read")
    asks = _asks(records).drop("payload")
    answers = _answers(records, asks)
    found = stage(looked_up(asks, answers, "key").select(
        "row", "page_id", "uri", "date", F.coalesce("answer_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("answer_digest", "payload_digest").alias("payload_digest"), F.col("answer_id").alias("key"),
        F.when(F.col("answer_id").isNull(), F.coalesce("refers_to_id", F.lit(""))).alias("outside")), "warc-asks")
    whole = records.where("record_type = 'response'").select(*HEADERS, "payload")
    known = found.where("outside is null")
    again = stage(revisits(whole.select(*HEADERS).unionByName(known.select(*HEADERS))), "warc-revisits")
    moved = known.join(again.select("row"), "row", "left_anti")
    held = moved.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(
        records.where("record_type = 'response'").select(F.col("record_id").alias("key"), "payload"), "key")
    # only payloads below MIN_REVISIT are asked for more than once, so a broadcast one is small
    none = F.lit(None).cast("string")
    parts = [whole.withColumn("outside", none),
             looked_up(moved.drop("outside"), held, "key").select(*HEADERS, "payload").withColumn("outside", none),
             known.join(again.select("row"), "row", "left_semi").select(
                 *HEADERS, none.alias("payload"), none.alias("outside")),
             found.where("outside is not null").select(*HEADERS, none.alias("payload"), "outside")]
    return _written(stage(reduce(DataFrame.unionByName, parts), "warc-records"), again, target, archive_bytes)


def archived_pages(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    page, read back from the archives written for ``pages``."""
    spark = pages.sparkSession
    path = deduplicated(page_records(pages), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    records = stage(read_archives(spark, path, payloads=False).drop("payload"), "warc-read")
    return resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

"""WARC archives: a writer and a sequential reader, one gzip member per record (operator 12).

Method.  Spark finds the record of smallest id of each payload digest; ids are pre-aggregated by digest and salt, so a
payload that many records share stays spread.  Tasks append records to archives and start a new one at
``ROLL_BYTES``; each attempt writes files of its own, and only those that finished attempts report are read, so a lost
executor leaves unread files, never half an archive.  A response record holds an HTTP header and the payload; a
revisit record holds the header alone, with the payload's digest and length, and names the record that it repeats.

The reader goes through an archive once: it inflates one gzip member at a time piece by piece, parses the record
header, frames the block by its Content-Length, and hashes block and payload on the way, so a record of any length
needs one piece of memory (the payload itself is only kept on request).  Digests are compared with the header's.

Archives lie below the shared folder and are opened by ``pyarrow.fs`` from its URI.

Defined results: a null payload is empty; a null id counts as larger than all others; rows with the same id and payload
are written once each, as responses if theirs is the smallest id; a null url leaves its header line out, other
characters than printable ASCII are percent-encoded in it; very long payloads are written and read whole; an empty
table gives no archive and no record.  A record that breaks the format or a digest gives a row with ``error``; what
follows a broken gzip member in the same archive cannot be framed and is named by that one row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import parallelism, shared_folder, stored

REVISIT_BYTES = 100          # payloads below this are always written as responses
ROLL_BYTES = 256 << 20       # of a compressed archive
PIECE = 1 << 16              # compressed bytes read, and inflated bytes handled, at once
HEADER_BYTES = 1 << 16       # longest record header that is read
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the WARC/1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

ARCHIVES = "path string, records long, bytes long"
RECORDS = ("path string, place long, type string, record_id string, uri string, refers_to string, payload_bytes long, "
           "payload_digest string, payload binary, error string")


# ------------------------------------------------------------------ which record repeats which

def with_originals(rows: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``rows(id, payload)`` with ``original``: the smallest id with an equal payload, null for short payloads."""
    n = parallelism(rows.sparkSession)
    keyed = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(n)))
    part = keyed.where(F.length("payload") >= min_bytes).groupBy("digest", "salt").agg(F.min("id").alias("least"))
    least = part.select("digest", "salt", F.min("least").over(Window.partitionBy("digest")).alias("original"))
    return keyed.join(least, ["digest", "salt"], "left").drop("salt")


# ------------------------------------------------------------------ writing

def record_id(key) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def printable(url: str) -> str:
    return quote(url, safe="".join(map(chr, range(0x21, 0x7f))))


def sha256_label(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode().rstrip("=")


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in fields),
            f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head_bytes = "\r\n".join(head).encode() + b"\r\n\r\n"
    return packer.compress(head_bytes) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(key, url: str | None, payload: bytes, digest: str, original) -> bytes:
    """A page as a response, or as a revisit of ``original`` if that is another page."""
    kind = "response" if original is None or original == key else "revisit"
    block = HTTP_HEAD.format(len(payload)).encode()
    fields = [("WARC-Record-ID", record_id(key))]
    if url is not None:
        fields.append(("WARC-Target-URI", printable(url)))
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if kind == "response":
        block += payload
    else:
        fields += [("WARC-Refers-To", record_id(original)), ("WARC-Profile", PROFILE)]
    fields.append(("WARC-Block-Digest", sha256_label(block)))
    return record(kind, fields, block)


def info_record(name: str) -> bytes:
    block = b"software: marquee\r\nformat: WARC File Format 1.1\r\n"
    return record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Filename", name),
                               ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", sha256_label(block))], block)


def write_archives(rows: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes ``rows(id, url, payload, digest, original)`` below ``folder``; one row per finished archive."""

    def run(batches):
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
            fs.LocalFileSystem(), folder)
        store.create_dir(top, recursive=True)
        out, path, records, size, done = None, None, 0, 0, []

        def finished():
            out.close()
            done.append((f"{folder}/{path}", records, size))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "original"))):
                if out is None:
                    path, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{path}", compression=None)
                    size += out.write(info_record(path))
                size += out.write(page_record(*row))
                records += 1
                if size >= roll_bytes:
                    finished()
                    out = None
        if out is not None:
            finished()
        cols = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "records", "bytes"])

    return rows.select("id", "url", "payload", "digest", "original").mapInArrow(run, ARCHIVES)


# ------------------------------------------------------------------ reading

class BadRecord(ValueError):
    pass


class _Member:
    """The inflated bytes of one gzip member after another, by ``read(n)`` (at most n) and ``line block``."""

    def __init__(self, stream):
        self.stream, self.packed, self.unpacker = stream, b"", None

    def start(self) -> bool:
        """Goes to the next member; False at the end of the archive."""
        if not self.packed:
            self.packed = self.stream.read(PIECE)
        self.unpacker, self.buffer = zlib.decompressobj(31), b""
        return bool(self.packed)

    def _fill(self) -> bool:
        while not self.buffer and not self.unpacker.eof:
            if not self.packed:
                self.packed = self.stream.read(PIECE)
                if not self.packed:
                    raise BadRecord("truncated gzip member")
            try:
                self.buffer = self.unpacker.decompress(self.packed, PIECE)
            except zlib.error as e:
                raise BadRecord(f"broken gzip member: {e}") from None
            self.packed = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
        return bool(self.buffer)

    def read(self, n: int) -> bytes:
        if not self._fill():
            return b""
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            piece = self.read(min(n, PIECE))
            if not piece:
                raise BadRecord("member ends within the record")
            n -= len(piece)
            yield piece

    def until(self, mark: bytes, limit: int) -> bytes:
        """All bytes before the first ``mark``, which is passed."""
        seen = b""
        while True:
            at = seen.find(mark)
            if at >= 0:
                self.buffer = seen[at + len(mark):] + self.buffer
                return seen[:at]
            if len(seen) > limit or not self._fill():
                raise BadRecord("no end of the record header")
            seen, self.buffer = seen + self.buffer, b""

    def rest(self) -> None:
        while self.read(PIECE):
            pass


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise BadRecord("no WARC version line")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord("header line without a colon")
        out[name.strip().lower()] = value.strip()
    return out


def _digests(label: str | None, data) -> bool:
    """Whether a header's digest (hex or base 32) is that of the hashed data; other algorithms are not compared."""
    name, _, value = (label or "").partition(":")
    if name.lower() not in ("sha256", "sha-256"):
        return True
    return value.lower() == data.hexdigest() or value.upper().rstrip("=") == base64.b32encode(
        data.digest()).decode().rstrip("=")


def _read_record(member: _Member, keep: bool) -> tuple:
    """(type, record_id, uri, refers_to, payload_bytes, payload_digest, payload, error) of the member's record."""
    f = _fields(member.until(b"\r\n\r\n", HEADER_BYTES))
    if not re.fullmatch(r"[0-9]+", f.get("content-length", "")):
        raise BadRecord("no Content-Length")
    kind, http = f.get("warc-type"), f.get("content-type", "").startswith("application/http")
    whole, body, n_body, kept, head = hashlib.sha256(), hashlib.sha256(), 0, [], b"" if http else None
    for piece in member.exactly(int(f["content-length"])):
        whole.update(piece)
        if head is not None:                                  # still in the HTTP header
            seen = head + piece
            at = seen.find(b"\r\n\r\n")
            if at < 0:
                head = seen
                if len(head) > HEADER_BYTES:
                    raise BadRecord("no end of the HTTP header")
                continue
            f["http"], head, piece = seen[:at].decode("latin-1"), None, seen[at + 4:]
        body.update(piece)
        n_body += len(piece)
        if keep:
            kept.append(piece)
    if b"".join(member.exactly(4)) != b"\r\n\r\n":
        raise BadRecord("no blank lines after the block")
    if member.read(1):
        raise BadRecord("more than one record in a gzip member")
    error = None
    if not _digests(f.get("warc-block-digest"), whole):
        error = "block digest differs"
    digest = body.hexdigest()
    if kind == "revisit":
        said = re.search(r"(?im)^content-length:\s*([0-9]+)\s*$", f.get("http", "").replace("\r", ""))
        n_body, digest = (int(said[1]) if said else None), f.get("warc-payload-digest", "").partition(":")[2].lower()
    elif not _digests(f.get("warc-payload-digest"), body):
        error = "payload digest differs"
    return (kind, f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-refers-to"), n_body, digest,
            b"".join(kept) if keep else None, error)


def records(stream, keep: bool = False) -> Iterator[tuple]:
    """(place, type, record_id, uri, refers_to, payload_bytes, payload_digest, payload, error) of a stream's records.

    A record that breaks off or cannot be framed has only ``error``; the members after it are read as long as the
    gzip framing holds.
    """
    member, place = _Member(stream), 0
    while member.start():
        try:
            try:
                row = _read_record(member, keep)
            except BadRecord as e:
                row = (None,) * 7 + (str(e),)
                member.rest()
        except BadRecord as e:                                # the gzip framing is gone
            yield place, *(None,) * 7, str(e)
            return
        yield place, *row
        place += 1


def read_archives(paths: DataFrame, keep: bool = False) -> DataFrame:
    """The records of all archives of ``paths(path)``, in rows as ``RECORDS`` says; ``keep`` adds the payloads."""

    def run(batches):
        from pyarrow import fs

        kinds = (pa.string(), pa.int64(), *(pa.string(),) * 4, pa.int64(), pa.string(), pa.binary(), pa.string())
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def batch_of(rows):
            cols = zip(*rows) if rows else ((),) * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
                    fs.LocalFileSystem(), path)
                rows, size = [], 0
                with store.open_input_stream(place, compression=None, buffer_size=PIECE) as stream:
                    for row in records(stream, keep):
                        rows.append((path, *row))
                        size += 200 + len(row[7] or b"")
                        if size > 4 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    return paths.select("path").mapInArrow(run, RECORDS)


# ------------------------------------------------------------------ pages through archives

def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = REVISIT_BYTES,
                  roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` to archives below ``folder``; the archives' paths, records and bytes."""
    spark: SparkSession = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    return stored(write_archives(with_originals(rows, min_bytes), folder, roll_bytes), "archives")


def read_pages(archives: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page record; a broken one raises."""
    # One archive per task: their number is what bounds the readers.
    n = max(1, archives.count())
    found = read_archives(archives.repartition(n, "path"))
    found = found.where(F.col("error").isNull() | F.raise_error(F.concat_ws(": ", "path", "error")).isNull())
    key = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return found.where("type in ('response', 'revisit')").select(
        key("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.when(F.col("type") == "revisit", key("refers_to")).alias("refers_to"))

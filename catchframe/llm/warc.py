"""WARC archives: a writer with revisit records and a sequential reader.

The writer makes one gzip member per record.  Of records with equal payloads one is a
response, the others are revisits that name it.  Archives are rolled over by size; each
task writes under names of its own attempt, and the table that the job commits lists the
archives that count, so a lost or repeated task leaves no record twice.

The reader goes through an archive in chunks: it inflates member by member, frames each
record by its Content-Length and checks block and payload digests as the bytes pass.
Its memory is a chunk and a record's header, and the payload only where it is asked for.

Archives of other writers are read too.  Digests are optional: one that is stated under a known algorithm is
checked, in base 32 or hex.  Only a block of type ``application/http`` has an HTTP head; the payload of any other
(``warcinfo``, ``metadata``, ``resource``) is its block.  A chunked body is joined, and its digest may be that
of either form.  A member may hold several records, and a file that is not compressed is read as one.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe.llm.common import map_arrow, pieces, stored
from catchframe.session import shared_dir

CHUNK = 1 << 18
# An HTTP block without the end of a head in so many bytes has none.
MOST_HEAD = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORD_FIELDS = (
    ("page_id", T.LongType(), pa.int64()), ("url", T.StringType(), pa.string()),
    ("record_id", T.StringType(), pa.string()), ("record_type", T.StringType(), pa.string()),
    ("payload_bytes", T.LongType(), pa.int64()), ("payload_digest", T.StringType(), pa.string()),
    ("refers_to", T.LongType(), pa.int64()), ("refers_to_record", T.StringType(), pa.string()),
    ("payload", T.BinaryType(), pa.binary()),
    ("archive", T.StringType(), pa.string()), ("offset", T.LongType(), pa.int64()),
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder that all executors share, such as ``file:``, ``hdfs:`` or ``s3:``."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if ":/" not in uri:
        raise ValueError(f"no file system is named: {uri}")
    return pa.fs.FileSystem.from_uri("s3" + uri[3:] if uri.startswith("s3a:") else uri)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system: one without a scheme is on the cluster's default one, as it is for Spark."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def _line(text: str | None) -> str:
    """A header value on one line."""
    return " ".join((text or "").split())


def make_record(page_id: int | None, url: str | None, payload: bytes, refers: tuple | None) -> bytes:
    """One record, not compressed.  ``refers``: id and address of the response that has this payload."""
    digest = base32_sha1(payload)
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url)}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers[0], refers[1], digest)}",
                 f"WARC-Refers-To-Target-URI: {_line(refers[1])}", f"Refers-To-Page-ID: {refers[0]}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_responses(pages: DataFrame, payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (UTF-8, missing: empty) and the response that each page revisits.

    Among equal payloads the page with the smallest id is the response; a missing id is
    larger than all others.  Only digests are grouped.  Rows that repeat the id of the
    response are responses too, and so are payloads of under ``least_bytes`` bytes.
    The payloads that occur twice are stored: Spark knows the size of that table, and
    payloads are not shuffled where it is within the limit of broadcasts.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    firsts = stored(keyed.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("least"),
    ).where("n > 1").select(
        F.col("digest").alias("d"), F.col("bytes").alias("b"),
        F.col("least.page_id").alias("first_id"), F.col("least.url").alias("first_url"),
    ), "repeated_payloads")
    joined = keyed.join(firsts, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left")
    revisit = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.struct("first_id", "first_url")).alias("refers"))


def write_archives(rows: DataFrame, archive_bytes: int = 64 << 20, level: int = 6) -> DataFrame:
    """Write ``with_responses`` rows as ``.warc.gz`` files in the shared folder.

    Returns the stored list of archives: ``path``, ``records``, ``bytes``.
    """
    folder = qualified(rows.sparkSession, f"{shared_dir(rows.sparkSession)}/warc")
    schema = "path string, records long, bytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        out, path, records, size, done = None, "", 0, 0, []
        for part in (p for b in batches for p in pieces(b, "payload")):
            for row in part.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, records, size = fs.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0, 0
                refers = row["refers"] and (row["refers"]["first_id"], row["refers"]["first_url"])
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(make_record(row["page_id"], row["url"], row["payload"], refers)) + packer.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "records", "bytes"])

    return stored(map_arrow(rows, run, schema), "archives")


class Members:
    """Bytes of a gzip file, member by member, inflated in chunks."""

    def __init__(self, stream: io.IOBase):
        self.stream, self.left, self.place = stream, b"", 0

    def fill(self) -> bool:
        if not self.left:
            self.left = self.stream.read(CHUNK)
        return bool(self.left)

    def __iter__(self) -> Iterator[tuple[int, Iterator[bytes]]]:
        plain = self.fill() and self.left.startswith(b"WARC/")
        while self.fill():
            chunks = self.rest() if plain else self.member()
            yield self.place, chunks
            for _ in chunks:  # what the caller left of the member
                pass

    def rest(self) -> Iterator[bytes]:
        """All bytes of a file that is not compressed."""
        while self.fill():
            data, self.left = self.left, b""
            self.place += len(data)
            yield data

    def member(self) -> Iterator[bytes]:
        packer = zlib.decompressobj(31)
        while not packer.eof:
            given = self.left if self.fill() else b""
            data = packer.decompress(given, CHUNK)
            if not given and not data and not packer.eof:
                raise ValueError(f"archive ends inside the member at {self.place}")
            self.left = packer.unconsumed_tail or packer.unused_data
            self.place += len(given) - len(self.left)
            if data:
                yield data


class Framed:
    """A member's bytes read by line and by length."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.buffer = chunks, b""

    def more(self) -> bool:
        data = next(self.chunks, b"")
        self.buffer += data
        return bool(data)

    def header(self) -> list[str]:
        """Lines up to the empty one."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise ValueError("header without end")
        head, self.buffer = self.buffer[:end], self.buffer[end + 4:]
        return head.decode("utf-8", "replace").split("\r\n")

    def take(self, size: int) -> Iterator[bytes]:
        """Exactly ``size`` bytes in pieces."""
        while size:
            if not self.buffer and not self.more():
                raise ValueError("record shorter than its length")
            part, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(part)
            yield part

    def take_all(self, size: int) -> bytes:
        return b"".join(self.take(size))


def named_values(lines: list[str]) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with a blank continues the one before."""
    named, name = {}, ""
    for line in lines:
        if line[:1] in (" ", "\t"):
            named[name] = f"{named.get(name, '')} {line.strip()}".strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            named[name] = value.strip()
    return named


class Digest:
    """A stated digest such as ``sha1:ABC``, checked as the bytes pass; of an unknown algorithm nothing is checked."""

    def __init__(self, stated: str | None):
        algorithm, _, self.value = (stated or "").partition(":")
        algorithm = algorithm.strip().lower().replace("-", "")
        self.hash = hashlib.new(algorithm) if algorithm in ("md5", "sha1", "sha256", "sha512") else None
        self.update = self.hash.update if self.hash else lambda data: None

    def holds(self) -> bool:
        if not self.hash:
            return True
        value, digest = self.value.strip(), self.hash.digest()
        return value.lower() == digest.hex() or value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


class Joined:
    """A chunked HTTP body, joined piece by piece.  ``ok`` turns false where the body is not chunked after all."""

    def __init__(self):
        self.buffer, self.left, self.end, self.ok = b"", -1, False, True

    def feed(self, data: bytes) -> Iterator[bytes]:
        self.buffer += data
        while self.buffer and self.ok and not self.end:
            if self.left > 0:
                part, self.buffer = self.buffer[:self.left], self.buffer[self.left:]
                self.left -= len(part)
                yield part
            elif self.left == 0:
                if len(self.buffer) < 2:
                    return
                self.ok = self.buffer.startswith(b"\r\n")
                self.buffer, self.left = self.buffer[2:], -1
            else:
                line, closed, rest = self.buffer.partition(b"\r\n")
                if not closed and len(line) < 1024:
                    return
                size = line.split(b";")[0].strip()
                self.ok = bool(closed) and bool(re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size))
                if self.ok:
                    self.buffer, self.left = rest, int(size, 16)
                    self.end = self.left == 0


def _number(text: str | None) -> int | None:
    """A whole number of 64 bits, else nothing."""
    number = int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def read_record(framed: Framed, with_payload: bool) -> dict:
    """One record with its digests checked; raises ``ValueError`` where bytes and header disagree.

    ``payload_digest`` is the stated digest without a ``sha1:`` before it; a record without one gets the SHA-1 of its payload as
    it is in the record, a revisit none.  ``payload_bytes`` of a revisit is what its HTTP head says.  A chunked payload is joined.
    """
    version, *lines = framed.header()
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]}")
    named = named_values(lines)
    length = _number(named.get("content-length"))
    if length is None or length < 0:
        raise ValueError(f"a record without a length: {named.get('warc-record-id')}")
    kind, stated = named.get("warc-type", "").lower(), named.get("warc-payload-digest")
    block, body, own, whole = Digest(named.get("warc-block-digest")), Digest(stated), Digest(None if stated else "sha1:"), Digest(stated)
    in_head = named.get("content-type", "").lower().startswith("application/http")
    head, http, raw, made, chunked, size, joined_size = b"", {}, [], [], None, 0, 0
    for part in framed.take(length):
        block.update(part)
        if in_head:
            head += part
            end = head.find(b"\r\n\r\n")
            if end < 0 and len(head) < MOST_HEAD:
                continue
            in_head, part = False, head[end + 4:] if end >= 0 else head
            http = named_values(head[:max(end, 0)].decode("latin-1").split("\r\n")[1:])
            chunked = Joined() if http.get("transfer-encoding", "").lower() == "chunked" else None
        body.update(part)
        own.update(part)
        size += len(part)
        if with_payload:
            raw.append(part)
        for piece in chunked.feed(part) if chunked else ():
            whole.update(piece)
            joined_size += len(piece)
            if with_payload:
                made.append(piece)
    if framed.take_all(4) != b"\r\n\r\n":
        raise ValueError("record is not closed at its length")
    joined = chunked is not None and chunked.ok and chunked.end
    if not block.holds():
        raise ValueError(f"block digest of {named.get('warc-record-id')}")
    revisit, cut = kind == "revisit", "warc-truncated" in named
    if not (revisit or cut or body.holds() or (joined and whole.holds())):
        raise ValueError(f"payload digest of {named.get('warc-record-id')}")
    if stated:
        digest = stated.removeprefix("sha1:")
    else:
        digest = None if revisit else base64.b32encode(own.hash.digest()).decode()
    kept = b"".join(made if joined else raw) if with_payload and not revisit else None
    return {
        "page_id": _number(named.get("page-id")), "url": named.get("warc-target-uri"), "record_id": named.get("warc-record-id"),
        "record_type": kind, "payload_bytes": _number(http.get("content-length")) if revisit else joined_size if joined else size,
        "payload_digest": digest, "refers_to": _number(named.get("refers-to-page-id")),
        "refers_to_record": named.get("warc-refers-to"), "payload": kept,
    }


def read_archive(open_stream: Callable[[], io.IOBase], with_payload: bool = False) -> Iterator[dict]:
    """All records of an archive in order; records of one member share its offset."""
    with open_stream() as stream:
        for offset, chunks in Members(stream):
            framed = Framed(chunks)
            while framed.buffer or framed.more():
                yield read_record(framed, with_payload) | {"offset": offset}


def read_archives(spark: SparkSession, archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the listed archives (column ``path``), with the columns of ``RECORD_FIELDS``.

    Archives are dealt to tasks by their path; one without a scheme is on the cluster's default file system.  A damaged
    archive stops the job.  No archives give no rows; a missing path is left out, a repeated one is read again.
    """
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    arrow = pa.schema([(n, kind) for n, _, kind in RECORD_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = file_system(path)
                for record in read_archive(lambda: fs.open_input_stream(name, compression=None), with_payload):
                    rows.append(record | {"archive": path})
                    held += 300 + len(record["payload"] or b"")
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    schema = T.StructType([T.StructField(n, t) for n, t, _ in RECORD_FIELDS])
    here, top, path = qualified(spark, "."), qualified(spark, "/").rstrip("/"), F.col("path")
    full = F.when(path.contains(":/"), path).when(path.startswith("/"), F.concat(F.lit(top), path))
    listed = archives.select(full.otherwise(F.concat(F.lit(f"{here}/"), path)).alias("path")).where("path IS NOT NULL")
    return map_arrow(listed.repartition(parts, "path"), run, schema)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: type, size, digest and reference of each page's record."""
    records = read_archives(spark, write_archives(with_responses(pages)))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id", "refers_to_record"
    )

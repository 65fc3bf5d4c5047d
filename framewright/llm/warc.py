"""WARC files: a writer that stores equal payloads once, and a salvage reader.

Files are gzip members of one record or more each, or plain.  When a record
fails a check (framing, length, payload digest) or a member is damaged, the
reader searches for the next place where a whole member, or a version line,
begins, in the file or in the member's own data, goes on there, and logs the
bytes between as a gap.  Records before the damage are kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm._shared import filesystem, task_file, tidy, work_path

FILE_BYTES = 1 << 30
READ_BYTES = 1 << 20
MOST_BYTES = (1 << 31) - 1  # of a record, which is held whole
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"(?:\A|(?<=\n))WARC/[0-9]\.[0-9]\r?\n")
VERSION_LINE = re.compile(rb"\nWARC/[0-9]\.[0-9]\r?\n")
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "framewright:page").int >> 64 << 64
_MASK = (1 << 64) - 1


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=_SPACE | ((page_id or 0) & _MASK))}>"


def page_of(urn: str) -> int | None:
    """The page id of one of our record ids; null for any other."""
    try:
        whole = uuid.UUID(urn.strip().strip("<>").removeprefix("urn:uuid:")).int
    except ValueError:
        return None
    n = whole & _MASK
    return None if whole ^ n != _SPACE else n - (1 << 64) if n >> 63 else n


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_bytes(page_id: int | None, url: str | None, sha1: bytes, size: int, payload: bytes | None, refers_to: int | None) -> bytes:
    """A response record, or a revisit record if payload is None; its HTTP
    header gives the full payload's length either way."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest_text(sha1)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is None:
        head.append("Page-Id-Null: 1")
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if payload is None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes = field(repr=False)

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        head, _, body = self.block.partition(b"\r\n\r\n")
        pairs = (x.split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
        return {k.decode("latin-1").strip().lower(): v.decode("latin-1").strip() for k, v in pairs}, body


@dataclass
class Gap:
    start: int
    end: int
    reason: str


class Inflated:
    """A gzip member's data as a stream, by its own positions.  What a damaged
    or cut member still gives comes first; ``error`` says what was wrong."""

    def __init__(self, salvage: "Salvage", offset: int):
        self.salvage, self.end, self.error = salvage, offset, ""
        self.unpacker, self.base, self.data, self.whole = zlib.decompressobj(31), 0, bytearray(), False

    def _more(self) -> bool:
        if self.whole or self.error:
            return False
        chunk = self.salvage._at(self.end, 1 << 16)
        before = self.unpacker.copy()
        try:
            self.data += self.unpacker.decompress(chunk)
            self.end += len(chunk) - len(self.unpacker.unused_data)
        except zlib.error as error:
            for i in range(len(chunk)):  # what there is before the damage
                try:
                    self.data += before.decompress(chunk[i : i + 1])
                except zlib.error:
                    break
            self.error = str(error)
        self.whole = self.unpacker.eof
        if not chunk and not self.whole:
            self.error = "cut short"
        return True

    def has(self, at: int, n: int) -> bool:
        while len(self.data) < at - self.base + n and self._more():
            pass
        return len(self.data) >= at - self.base + n

    def get(self, at: int, n: int) -> bytes:
        """n bytes, fewer at the end."""
        self.has(at, n)
        return bytes(self.data[at - self.base : at - self.base + n])

    def drop(self, at: int) -> None:
        del self.data[: at - self.base]
        self.base = at

    def next_version(self, at: int) -> int:
        """Where the next version line begins, or the end."""
        while True:
            if found := VERSION_LINE.search(self.data, max(0, at - 1 - self.base)):
                return self.base + found.start() + 1
            at = max(at, self.base + len(self.data) - 16)
            if not self._more():
                return self.base + len(self.data)
            self.drop(max(self.base, at - 1))


class Salvage:
    """Iterates over the records and gaps of one open file.  Memory: the
    largest record, and READ_BYTES.  Records that claim more than MOST_BYTES
    are quarantined."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.base, self.data = 0, b""

    def _at(self, offset: int, n: int) -> bytes:
        """n bytes at an offset, fewer at the file's end."""
        if not (self.base <= offset and offset + n <= self.base + len(self.data)):
            self.source.seek(offset)
            self.base, self.data = offset, self.source.read(max(n, READ_BYTES))
        return self.data[offset - self.base : offset - self.base + n]

    def __iter__(self) -> Iterator[Record | Gap]:
        offset = 0
        while offset < self.size:
            if self._at(offset, 3) == MEMBER:
                offset = yield from self._member(offset)
                continue
            try:
                found, end = self._plain(offset)
                yield from found
            except ValueError as error:
                end = self._next(offset + 1)
                yield Gap(offset, end, str(error))
            offset = end

    def _member(self, offset: int) -> Iterator[Record | Gap]:
        """A member's records, each as it passes its checks; within it the
        search goes on at the next version line.  Returns where to go on in
        the file."""
        data, at, n = Inflated(self, offset), 0, 0
        while data.has(at, 1):
            try:
                record, end = self._record(data, at, offset)
                yield record
                n += 1
            except ValueError as error:
                end = data.next_version(at + 1)
                if end == at + 1 or not data.has(end, 1) and not n and data.error:
                    break
                yield Gap(offset, offset, f"{error}; bytes {at} to {end} of the member's data")
            at = end
            data.drop(at)
        if data.whole and not data.error and at:
            return data.end
        end = self._next(offset + 1)  # a cut member's data may have run on into the next one's
        yield Gap(offset, end, f"{data.error or 'empty member'}; {n} records before")
        return end

    def _record(self, data: Inflated, at: int, offset: int) -> tuple[Record, int]:
        n = 1 << 12
        while (cut := (head := data.get(at, n)).find(b"\r\n\r\n")) < 0:
            if len(head) < n or n >= 16 * READ_BYTES or not VERSION.match(head):
                raise ValueError("header without end" if VERSION.match(head) else "no version line")
            n *= 4
        length = content_length(headers_of(head[:cut]))
        record, size = parse(data.get(at, cut + 4 + length + 4), 0, offset)
        return record, at + size

    def _inflate(self, offset: int, most: int) -> bytes:
        """The first bytes of a member's data."""
        return zlib.decompressobj(31).decompress(self._at(offset, 1 << 12), most)

    def _plain(self, offset: int) -> tuple[list[Record], int]:
        n = READ_BYTES
        while True:
            data = self._at(offset, n)
            if not VERSION.match(data):
                raise ValueError("no version line")
            cut = data.find(b"\r\n\r\n")
            if cut >= 0:
                break
            if len(data) < n or n >= 16 * READ_BYTES:
                raise ValueError("header without end")
            n *= 2
        length = content_length(headers_of(data[:cut]))
        record, at = parse(self._at(offset, cut + 4 + length + 4), 0, offset)
        return [record], offset + at

    def _next(self, offset: int) -> int:
        """Where the next whole member or version line begins, or the end."""
        while offset < self.size:
            data, base = self._at(offset - 1, READ_BYTES), offset - 1  # with the byte before, for a line's begin
            marks = sorted({m.start() for m in re.finditer(re.escape(MEMBER), data) if m.start()} | {m.start() + 1 for m in re.finditer(rb"\nWARC/[0-9]\.[0-9]\r?\n", data)})
            for mark in marks:
                if self._at(base + mark, 3) != MEMBER:
                    return base + mark
                try:
                    if VERSION.match(self._inflate(base + mark, 16)):
                        return base + mark
                except (ValueError, zlib.error):
                    pass
            if len(data) < READ_BYTES:
                break
            offset += len(data) - 16
        return self.size


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def content_length(headers: dict[str, str]) -> int:
    if not re.fullmatch("[0-9]{1,18}", text := headers.get("content-length", "")):
        raise ValueError("no content length")
    if int(text) > MOST_BYTES:
        raise ValueError("too long to hold")
    return int(text)


def parse(data: bytes, at: int, offset: int) -> tuple[Record, int]:
    """The record at a place of the data, checked, and where it ends."""
    if not VERSION.match(data[at : at + 16]):
        raise ValueError("no version line")
    cut = data.find(b"\r\n\r\n", at)
    if cut < 0:
        raise ValueError("header without end")
    headers = headers_of(data[at:cut])
    end = cut + 4 + content_length(headers)
    if "warc-type" not in headers or "warc-record-id" not in headers:
        raise ValueError("no type or id")
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("block of another length")
    record = Record(offset, headers, data[cut + 4 : end])
    claimed = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and claimed.startswith("sha1:"):
        if digest_text(hashlib.sha1(record.http[1]).digest()) != claimed[5:]:
            raise ValueError("payload digest differs")
    return record, end + 4


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> list[str]:
    """Write a record per row; returns the files, one or more per partition.

    A null html is an empty payload; a null url leaves the target out.  Of
    rows with equal payloads of at least ``min_bytes``, those with the largest
    id are responses and the others revisit them; rows that share that id
    (repeated rows) are all responses, and so are rows whose ids are all null.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).alias("u"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("p"))
    rows = rows.withColumn("d", F.sha1("p"))
    size, salts = F.octet_length("p"), 16  # keys that an often repeated payload's rows are dealt over
    kept = rows.groupBy("d").agg(F.max("i").alias("r"), F.count("*").alias("m")).where("m > 1 and r is not null")
    kept = kept.select("d", "r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("z"))
    same = (size < min_bytes) | F.col("r").isNull() | F.coalesce(F.col("i") == F.col("r"), F.lit(False))
    dealt = rows.withColumn("z", F.pmod(F.xxhash64("i"), F.lit(salts)).cast("int")).join(kept, ["d", "z"], "left")
    plan = dealt.select("i", "u", F.unhex("d").alias("d"), size.alias("n"), F.when(same, F.col("p")).alias("p"), F.when(~same, F.col("r")).alias("r"))

    def write(batches):
        part, k = TaskContext.get().partitionId(), 0
        batch = next((b for b in batches if b.num_rows), None)
        names: list[str] = []
        at = 0
        while batch is not None:
            name, written = f"pages-{part:06d}-{k:04d}.warc.gz", 0
            with task_file(folder, name) as out:
                while batch is not None and written < FILE_BYTES:
                    if at == batch.num_rows:
                        batch, at = next(batches, None), 0
                        continue
                    i, u, d, n, p, r = (batch.column(c)[at].as_py() for c in range(6))
                    at += 1
                    out.write(data := gzip_member(record_bytes(i, u, bytes(d), n, None if p is None else bytes(p), r)))
                    written += len(data)
            if written:
                names.append(f"{folder}/{name}")
            k += 1
        if names:
            yield pa.RecordBatch.from_pydict({"file": names})

    return sorted(x["file"] for x in plan.mapInArrow(tidy(write), "file string").collect())


READ = "file string, offset long, end long, gap string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(spark, files: list[str]) -> DataFrame:
    """One row per record and per gap.  Records: file, offset of the member,
    page_id, url, payload_bytes, payload_digest, record_type, refers_to; a
    response's length and digest come from its payload, a revisit's from its
    headers.  Gaps: file, offset, end, and gap, the reason.  Each file is read
    by one task."""
    names = list(files)

    def read(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                system, path = filesystem(names[k])
                out: list[tuple] = []
                with system.open_input_file(path) as source:
                    for x in Salvage(source, source.size()):
                        out.append((names[k], x.start, x.end, x.reason, None, None, None, None, None, None) if isinstance(x, Gap) else (names[k], x.offset, None, None, *page_row(x)))
                        if len(out) == 5000:
                            yield _batch(out)
                            out = []
                if out:
                    yield _batch(out)

    if not names:
        return spark.createDataFrame([], READ)
    return spark.range(0, len(names), 1, len(names)).mapInArrow(tidy(read), READ)


def page_row(record: Record) -> tuple:
    h = record.headers
    http, payload = record.http
    kind = h.get("warc-type")
    if kind == "revisit":
        text = http.get("content-length", "")
        size, digest = int(text) if re.fullmatch("[0-9]{1,18}", text) else None, h.get("warc-payload-digest", "").removeprefix("sha1:")
    else:
        size, digest = len(payload), digest_text(hashlib.sha1(payload).digest())
    page = None if "page-id-null" in h else page_of(h.get("warc-record-id", ""))
    refers = page_of(h["warc-refers-to"]) if "warc-refers-to" in h else None
    return page, h.get("warc-target-uri"), size, digest, kind, refers


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split() for x in READ.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for (_, k), x in zip(names, zip(*rows, strict=True), strict=True)], names=[n for n, _ in names])


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to the shared folder and read the archives back."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, work_path(spark, "warc"), **options))

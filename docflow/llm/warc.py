"""Legacy archives: ARC records parsed by their version's header line and converted to WARC.

An ARC archive starts with a `filedesc://` record whose second line names the version (1 or 2) and whose third line names
the header fields; each record is a header line and as many bytes as its last field declares. Header lines are read from
their end, so a url may hold spaces. What cannot be read (no header line, a length beyond the end, an unknown version) becomes a row of
`quarantine`, and reading goes on at the next line that is a header line.

The converter synthesises WARC headers. Record identifiers are version-8 UUIDs of a hash of archive name, offset, url, date and block digest, so a
repeated conversion gives the same ones. Dates of 4 to 17 digits are completed with the earliest moment they can mean; one that is no
date gives way to the file description's. The type follows from the record: the file description becomes warcinfo, blocks that begin
with an HTTP status line are responses, all others (`dns:`, ftp) are resources with the declared content type. Digests are SHA-256 of block and payload.
Of responses with equal payloads of at least `LEAST_REVISIT` bytes the first one stays, by source id, then archive name and offset, and
the others are revisits, which keep their HTTP header but not the payload.

Source ids (page_id) travel beside the archives, in a column `ids` in the order of the records, and as the extension fields `X-Source-Id` and
`X-Refers-To-Source-Id`; archives from elsewhere have none.

WARC archives are written by Spark's own text writer (any file system it knows): a row is one record as a gzip member of its own, and the
line separator is an empty gzip member, so each file is a valid compressed WARC file whose records can be read one by one. Reading decompresses
in steps, follows the declared lengths, and verifies digests. Files are split by bytes, and each task streams its own.

The decision shuffles only digests and places, which combine on the map side. Digests that occur twice are broadcast if they measure
below `max_broadcast_bytes`; beyond it the records join them by digest, large groups of copies dealt over parts.

Defined results: a null html is an empty payload; a null url is written as `-`; rows with a null page_id are records without a source id, which
come after all others; rows that repeat a page_id are records of their own, of which equal payloads revisit the
smallest id; extra columns are ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, discard, materialise, scratch_path, spread_join, table

LEAST_REVISIT = 100
ARCHIVE_BYTES, FILE_BYTES = 4 << 20, 64 << 20
DATE = "20200101000000"
_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
_TYPE = rb"([^\s;]+(?:; ?[^\s;]+)*;?)"
#: A header line of each version; all fields but the url and the content type are without spaces.
_LINES = {
    1: re.compile(rb"(?m)^(\S[^\n]*) (\S+) (\d{4,17}|-) " + _TYPE + rb" (\d+)\r?$"),
    2: re.compile(rb"(?m)^(\S[^\n]*) (\S+) (\d{4,17}|-) " + _TYPE + rb" (\S+) (\S+) (\S+) (\d+|-) (\S+) (\d+)\r?$"),
}
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes
    version: int
    offset: int
    status: str = ""

    @property
    def described(self) -> bool:
        return self.url.startswith("filedesc://")


@dataclass
class Broken:
    """A place that cannot be read."""

    offset: int
    reason: str
    line: str


def _line(version: int, url: str, content_type: str, length: int, offset: int, name: str) -> bytes:
    own = [_uri(url), "0.0.0.0", DATE, content_type]
    if version == 2:
        own += ["200", "-", "-", str(offset), name]
    return " ".join([*own, str(length)]).encode("utf-8") + b"\n"


def _uri(url: str) -> str:
    """White space would split a header, whatever a url holds."""
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8")), url) or "-"


def write_arc(name: str, version: int, records: list[tuple[str, str, bytes]]) -> bytes:
    """An ARC archive of (url, content type, block)."""
    body = f"{version} 0 docflow\n{' '.join(_FIELDS[version])}\n".encode()
    out = [_line(version, f"filedesc://{name}", "text/plain", len(body), 0, name), body, b"\n"]
    at = sum(map(len, out))
    for url, kind, block in records:
        out += [_line(version, url, kind, len(block), at, name), block, b"\n"]
        at += sum(map(len, out[-3:]))
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[ArcRecord | Broken]:
    """The records of an ARC archive of either version, the file description first; without one version 1 is assumed."""
    at, version, size = 0, 1, len(data)
    while at < size:
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        # The file description's own line has the fields of its version.
        tried = (version,) if at else (2, 1)
        m = next((found for v in tried if (found := _LINES[v].match(data, at))), None)
        end = -1 if m is None else m.end() + 1
        length = 0 if m is None else int(m[len(m.groups())])
        reason = "no header line" if m is None else "the record is cut off" if end + length > size else ""
        if not at and m and not reason:
            version = 2 if len(m.groups()) == 10 else 1
            if m[1].startswith(b"filedesc://"):
                told = data[end : end + length].split(b" ", 1)[0].strip()
                if told not in (b"1", b"2"):
                    reason = f"unknown version {told[:20].decode('latin-1')}"
                else:
                    version = int(told)
        if reason:
            stop = data.find(b"\n", at)
            yield Broken(at, reason, data[at : stop if stop >= 0 else size][:200].decode("utf-8", errors="replace"))
            again = _LINES[version].search(data, stop + 1) if stop >= 0 else None
            if again is None:
                return
            at = again.start()
            continue
        text = [(x or b"").decode("utf-8", errors="replace") for x in m.groups()]
        yield ArcRecord(text[0], text[1], text[2], text[3], data[end : end + length], version, at, text[4] if len(text) == 10 else "")
        at = end + length


def warc_date(digits: str) -> str | None:
    """The ISO form of 4 to 17 digits, completed with the earliest moment; None for what is no date."""
    if not re.fullmatch(r"\d{4,17}", digits, re.ASCII):
        return None
    whole = digits + "00000101000000000"[len(digits) :]
    try:
        at = datetime.datetime.strptime(whole[:14], "%Y%m%d%H%M%S")
    except ValueError:
        return None
    part = f".{whole[14:]}" if len(digits) > 14 else ""
    return f"{at:%Y-%m-%dT%H:%M:%S}".rjust(19, "0") + f"{part}Z"


def record_id(name: str, arc: ArcRecord) -> str:
    """A version-8 UUID of a hash of where the record stands and what it holds."""
    place = f"{name}\n{arc.offset}\n{arc.url}\n{arc.date}\n{hashlib.sha256(arc.block).hexdigest()}"
    n = int.from_bytes(hashlib.sha256(place.encode("utf-8", "surrogatepass")).digest()[:16], "big")
    return f"<urn:uuid:{uuid.UUID(int=n & ~(0xF << 76) & ~(3 << 62) | 8 << 76 | 2 << 62)}>"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP header with its empty line, payload); a block without HTTP is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    for line_end in (b"\r\n\r\n", b"\n\n"):
        head, mark, payload = block.partition(line_end)
        if mark:
            return head + mark, payload
    return block, b""


def kind_of(arc: ArcRecord) -> tuple[str, str]:
    """(WARC type, content type) that follow from the record."""
    if arc.described:
        return "warcinfo", "application/warc-fields"
    if arc.block.startswith(b"HTTP/"):
        return "response", "application/http; msgtype=response"
    return "resource", arc.content_type if "/" in arc.content_type else "application/octet-stream"


@dataclass
class Original:
    """What a revisit refers to."""

    record: str
    url: str
    date: str
    source: int | None = None


def warc_record(name: str, arc: ArcRecord, *, source: int | None = None, original: Original | None = None, default_date: str = DATE) -> bytes:
    """The WARC record of an ARC record, with its final two line ends."""
    kind, content_type = kind_of(arc)
    head, payload = split_http(arc.block)
    block = arc.block
    if kind == "warcinfo":
        told = "; ".join(arc.block.decode("utf-8", errors="replace").split("\n")).strip("; \r")
        block = f"software: docflow\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\ndescription: converted from ARC version {arc.version}: {told}\r\n".encode()
    elif original is not None:
        kind, block = "revisit", head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(name, arc)}",
        f"WARC-Date: {warc_date(arc.date) or warc_date(default_date) or warc_date(DATE)}",
    ]
    if kind == "warcinfo":
        lines.append(f"WARC-Filename: {_uri(name)}")
    else:
        lines += [f"WARC-Target-URI: {_uri(arc.url)}", f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}", f"X-Payload-Length: {len(payload)}"]
        if arc.ip not in ("-", "0.0.0.0"):
            lines.append(f"WARC-IP-Address: {arc.ip}")
    lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    if source is not None:
        lines.append(f"X-Source-Id: {source}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {original.record}", f"WARC-Refers-To-Target-URI: {_uri(original.url)}", f"WARC-Refers-To-Date: {original.date}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        if original.source is not None:
            lines.append(f"X-Refers-To-Source-Id: {original.source}")
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Source:
    """Bytes of a file, decompressed in steps; each gzip member is left where it ends."""

    STEP = 1 << 16

    def __init__(self, data: bytes, packed: bool):
        self.data, self.at = memoryview(data), 0
        self.packed, self.unpack = packed, None
        self.ready = bytearray()

    def _more(self) -> bool:
        if self.at >= len(self.data):
            if self.unpack is not None:
                raise ValueError("the archive ends within a compressed record")
            return False
        part = self.data[self.at : self.at + self.STEP]
        self.at += len(part)
        if not self.packed:
            self.ready += part
            return True
        self.unpack = self.unpack or zlib.decompressobj(31)
        try:
            self.ready += self.unpack.decompress(part)
        except zlib.error as e:
            raise ValueError(f"broken compression before byte {self.at}") from e
        if self.unpack.eof:
            self.at -= len(self.unpack.unused_data)
            self.unpack = None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with the mark; None at the end."""
        seen = 0
        while (k := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if not self._more():
                if self.ready.strip():
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(k + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields in lower case, block) of the records of a WARC file, plain or gzip."""
    source = _Source(data, data[:2] == b"\x1f\x8b")
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8").strip().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record starts with {lines[0][:40]!r}")
        own = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = source.take(int(own["content-length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is longer than it declares")
        digest = own.get("warc-block-digest", "")
        if digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:]:
            raise ValueError(f"the block of {own.get('warc-record-id')} has another digest")
        yield own, block


def archive_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(name, content, ids): ARC archives of up to about `ARCHIVE_BYTES`, of both versions in turn."""

    def run(batches):
        n = 0
        for b in chunks(batches, "html", ARCHIVE_BYTES):
            records, ids = [], col(b, "id")
            for url, html in zip(col(b, "url").to_pylist(), col(b, "html").to_pylist(), strict=True):
                payload = (html or "").encode("utf-8")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                records.append((url or "-", "text/html", head.encode() + payload))
            place = hashlib.sha256(repr((ids.to_pylist(), [(r[0], zlib.crc32(r[2])) for r in records], n)).encode("utf-8", "surrogatepass")).hexdigest()[:24]
            name = f"pages-{place}.arc"
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([write_arc(name, 1 + n % 2, records)], pa.binary()), pa.array([ids.to_pylist()], pa.list_(pa.int64()))], ["name", "content", "ids"])
            n += 1

    source = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return source.mapInArrow(run, "name string, content binary, ids array<long>")


def _archives(archives: DataFrame) -> DataFrame:
    """(name, content, ids), where ids may be missing."""
    ids = F.col("ids").cast("array<long>") if "ids" in archives.columns else F.lit(None).cast("array<long>")
    return archives.select(F.col("name").cast("string").alias("name"), "content", ids.alias("ids"))


def _each(batch: pa.RecordBatch) -> Iterator[tuple[str, ArcRecord | Broken, int | None, str]]:
    """(archive name, record or broken place, source id, the file description's date) of the archives of a batch."""
    for k in range(batch.num_rows):
        name, data, ids = (col(batch, c)[k].as_py() for c in ("name", "content", "ids"))
        n, date = 0, DATE
        for r in read_arc(data or b""):
            if isinstance(r, ArcRecord) and r.described:
                date = r.date
                yield name, r, None, date
                continue
            source = None
            if isinstance(r, ArcRecord):
                source = ids[n] if ids is not None and n < len(ids) else None
                n += 1
            yield name, r, source, date


def _row_batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 2_000, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most `limit` rows, or about `size` bytes of their binary values."""
    own, held = [], 0
    make = lambda: pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*own, strict=True), schema, strict=True)], schema=schema)
    for r in rows:
        own.append(r)
        held += sum(len(x) for x in r if isinstance(x, bytes))
        if len(own) >= limit or held >= size:
            yield make()
            own, held = [], 0
    if own:
        yield make()


def quarantine(archives: DataFrame) -> DataFrame:
    """(name, offset, reason, line): the places that cannot be read."""
    schema = pa.schema([("name", pa.string()), ("offset", pa.int64()), ("reason", pa.string()), ("line", pa.string())])

    def run(batches):
        yield from _row_batches(((name, r.offset, r.reason, r.line) for b in batches for name, r, _, _ in _each(b) if isinstance(r, Broken)), schema)

    return _archives(archives).mapInArrow(run, "name string, offset long, reason string, line string")


def originals(archives: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(digest, n, first): payload digests that several responses have, how many, and the first of these: source, name, offset, record, url, date."""
    schema = pa.schema([("digest", pa.binary()), ("source", pa.int64()), ("name", pa.string()), ("offset", pa.int64()), ("record", pa.string()), ("url", pa.string()), ("date", pa.string())])

    def rows(batches):
        for b in batches:
            for name, r, source, date in _each(b):
                if isinstance(r, ArcRecord) and kind_of(r)[0] == "response":
                    payload = split_http(r.block)[1]
                    if len(payload) >= least:
                        yield hashlib.sha256(payload).digest(), source, name, r.offset, record_id(name, r), r.url, warc_date(r.date) or warc_date(date) or warc_date(DATE)

    def run(batches):
        yield from _row_batches(rows(batches), schema)

    found = _archives(archives).mapInArrow(run, "digest binary, source long, name string, offset long, record string, url string, date string")
    # A null source comes after all others.
    place = F.struct(F.col("source").isNull().alias("none"), "source", "name", "offset", "record", "url", "date")
    return found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")


_RECORD = [("name", pa.string()), ("source", pa.int64()), ("digest", pa.binary()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("default_date", pa.string()), ("content_type", pa.string()), ("block", pa.binary()), ("version", pa.int32()), ("offset", pa.int64()), ("status", pa.string())]


def convert(archives: DataFrame, known: DataFrame, *, max_broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(record): the WARC record of every readable ARC record as a gzip member, as bytes in a string column, for `write_warc`.

    known: `originals`, written, of the same archives.
    """
    schema = pa.schema(_RECORD)

    def parts(batches):
        for b in batches:
            rows = ((name, source, hashlib.sha256(split_http(r.block)[1]).digest() if kind_of(r)[0] == "response" else None, r.url, r.ip, r.date, date, r.content_type, r.block, r.version, r.offset, r.status) for name, r, source, date in _each(b) if isinstance(r, ArcRecord))
            yield from _row_batches(rows, schema, 200)

    def run(batches):
        for b in batches:
            out, held = [], 0
            for x in b.to_pylist():
                arc = ArcRecord(x["url"], x["ip"], x["date"], x["content_type"], x["block"], x["version"], x["offset"], x["status"])
                f = x["first"]
                again = f is not None and (f["name"], f["offset"]) != (x["name"], x["offset"]) and (x["source"] is None or f["source"] != x["source"])
                original = Original(f["record"], f["url"], f["date"], f["source"]) if again else None
                out.append(gzip.compress(warc_record(x["name"], arc, source=x["source"], original=original, default_date=x["default_date"]), 6, mtime=0))
                held += len(out[-1])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    kinds = "name string, source long, digest binary, url string, ip string, date string, default_date string, content_type string, block binary, version int, offset long, status string"
    records = _archives(archives).mapInArrow(parts, kinds)
    size = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("first.url") + F.octet_length("first.name")), F.lit(0)).alias("b")).first()
    if 300 * size["n"] + 2 * size["b"] <= max_broadcast_bytes:
        joined = records.join(F.broadcast(known.select("digest", "first")), "digest", "left")
    else:
        # A group of copies is dealt over as many parts as it needs.
        joined = spread_join(records, known.select("digest", "n", "first"), "digest", "n", ["name", "offset"], per_task=2_000, how="left")
    return joined.select(*[n for n, _ in _RECORD], "first").mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("record"))


def records_per_file(pages: DataFrame, html_col: str = "html") -> int:
    """So many that a file holds about `FILE_BYTES` on average and, whatever is in it, below 1 GB of payload, unless one record has more."""
    size = F.octet_length(html_col)
    row = pages.agg(F.avg(size).alias("mean"), F.max(size).alias("most")).first()
    return max(1, min(5_000, FILE_BYTES // (int(row["mean"] or 0) + 1_000), (1 << 30) // (int(row["most"] or 0) + 1_000)))


def write_warc(records: DataFrame, path: str, *, per_file: int = 5_000) -> None:
    """Compressed WARC files of at most `per_file` records in the folder `path`, by Spark's text writer."""
    records.select("record").write.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER.decode("latin-1")).option("compression", "none").option("maxRecordsPerFile", per_file).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records but warcinfo in a folder of WARC files."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    number = lambda x: None if x is None else int(x)

    def rows(batches):
        for b in batches:
            for data in col(b, "content").to_pylist():
                for own, block in read_warc(data):
                    kind = own["warc-type"]
                    if kind == "warcinfo":
                        continue
                    digest, payload = own["warc-payload-digest"].removeprefix("sha256:"), split_http(block)[1]
                    if kind != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"the payload of {own['warc-record-id']} has another digest")
                    yield number(own.get("x-source-id")), int(own.get("x-payload-length", len(payload))), digest, kind, number(own.get("x-refers-to-source-id"))

    def run(batches):
        yield from _row_batches(rows(batches), schema)

    kinds = T.StructType.fromDDL("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("content").mapInArrow(run, kinds)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC archives, converted, written as WARC files to the shared folder and read back."""
    pages, kept = table(spark, sf_dir, "pages"), []
    archives = materialise(archive_pages(pages), "arc", kept)
    known = materialise(originals(archives), "arc-originals", kept)
    path = scratch_path(spark, "warc")
    write_warc(convert(archives, known), path, per_file=records_per_file(pages))
    discard(spark, kept)
    return read_archives(spark, path)

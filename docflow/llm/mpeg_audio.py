"""Media columns: MPEG audio frames, with resynchronisation, tags, variable-bitrate tables, checksums and seek offsets.

`write` stores bytes losslessly as a Layer III stream: an ID3v2 tag with the true length, an Info frame with frame
count, byte count and seek table, then one mono frame of 240 bytes (80 kbit/s at 48 kHz, 24 ms) per 192 bytes. A frame
has its header, a checksum over header and side information, empty side information (it decodes as silence), the 192
bytes as ancillary data and their CRC-32.

`parse` reads any MPEG-1, 2 or 2.5 stream of Layers I to III but free-format ones: it skips ID3v2, APEv2 and ID3v1 tags and returns their
texts, looks for a header that a second header of the same kind follows (or that ends the stream), takes up again after broken
bytes, reads Xing, Info and VBRI tables with their seek points, verifies the checksums of all layers, and returns the exact number of
samples and each frame's offset, by which `offset_at` finds the frame of any sample.

Defined results: null and empty texts are stored as 192 spaces; equal texts give equal values; repeated rows are stored
each; extra columns are ignored; bytes without any frame parse to no frames and a duration of zero.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, sha256_hex, table

UNIT = 192
FRAME = 240
_SIDE = 17  # side information of a mono Layer III frame
_HEADER = bytes([0xFF, 0xFA, 0x64, 0xC4])  # MPEG-1 Layer III with checksum, 80 kbit/s, 48 kHz, mono, original

# Fixed values of ISO 11172-3 and 13818-3: kbit/s by bitrate index 1 to 14, samples a second by version.
_RATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
_HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


def _crc_table() -> list[int]:
    out = []
    for b in range(256):
        r = b << 8
        for _ in range(8):
            r = (r << 1) ^ (0x8005 if r & 0x8000 else 0)
        out.append(r & 0xFFFF)
    return out


_CRC = _crc_table()


def crc16(data: bytes) -> int:
    """The checksum of MPEG audio: polynomial 0x8005, all ones at the start."""
    return crc16_bits(data, 8 * len(data))


def crc16_bits(data: bytes, n: int) -> int:
    """The checksum of the first n bits."""
    r = 0xFFFF
    for b in data[: n // 8]:
        r = ((r << 8) & 0xFFFF) ^ _CRC[(r >> 8) ^ b]
    for k in range(n % 8):
        top = (r >> 15) ^ (data[n // 8] >> 7 - k & 1)
        r = (r << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return r


@dataclass(frozen=True)
class Header:
    version: int  # 3: MPEG-1, 2: MPEG-2, 0: MPEG-2.5
    layer: int
    checked: bool
    size: int
    hertz: int
    samples: int
    side: int
    kind: int  # bits that all frames of a stream share
    channels: int = 1
    bound: int = 32  # subbands below it have an allocation for each channel
    rate: int = 0  # kbit/s


_HEADERS: dict[bytes, Header | None] = {}


def header(word: bytes) -> Header | None:
    """The frame header in four bytes; None for no header, and for free-format streams, whose size it does not tell."""
    if word not in _HEADERS:
        if len(_HEADERS) > 10_000:
            _HEADERS.clear()
        _HEADERS[word] = _header(word)
    return _HEADERS[word]


def _header(word: bytes) -> Header | None:
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
    rate, hz = word[2] >> 4, word[2] >> 2 & 3
    if version == 1 or layer == 4 or rate in (0, 15) or hz == 3 or word[3] & 3 == 2:
        return None
    bits = _RATES[1 if version == 3 else 2, layer][rate - 1] * 1000
    hertz, pad, mono = _HERTZ[version][hz], word[2] >> 1 & 1, word[3] >> 6 == 3
    samples = 384 if layer == 1 else 576 if layer == 3 and version != 3 else 1152
    size = (12 * bits // hertz + pad) * 4 if layer == 1 else samples // 8 * bits // hertz + pad
    side = ((17 if mono else 32) if version == 3 else (9 if mono else 17)) if layer == 3 else 0
    joint = word[3] >> 6 == 1
    return Header(version, layer, not word[1] & 1, size, hertz, samples, side, word[1] & 0x1E | (word[2] & 0x0C) << 8, 1 if mono else 2, 4 * ((word[3] >> 4 & 3) + 1) if joint else 32, bits // 1000)


#: Fixed values of ISO 11172-3 (tables B.2a to B.2d) and 13818-3 (B.1): how many subbands have allocations of so many bits.
_ALLOCATIONS = {"a": ((11, 4), (12, 3), (4, 2)), "b": ((11, 4), (12, 3), (7, 2)), "c": ((2, 4), (6, 3)), "d": ((2, 4), (10, 3)), "low": ((4, 4), (7, 3), (19, 2))}


def _allocations(h: Header) -> list[int]:
    """Layer II: the bits of the allocation of each subband."""
    each = h.rate // h.channels
    if h.version != 3:
        name = "low"
    elif each in (32, 48):
        name = "d" if h.hertz == 32000 else "c"
    else:
        name = "a" if h.hertz == 48000 or each <= 80 else "b"
    return [bits for n, bits in _ALLOCATIONS[name] for _ in range(n)]


def protected_bits(h: Header, body: bytes) -> int:
    """How many bits behind the checksum it covers: side information, or allocations and the selection of scale factors."""
    if h.layer == 3:
        return 8 * h.side
    if h.layer == 1:
        return 4 * (h.channels * min(h.bound, 32) + 32 - min(h.bound, 32))
    widths = _allocations(h)
    bits, at, used = int.from_bytes(body, "big"), 0, 0
    for band, width in enumerate(widths):
        for _ in range(h.channels if band < h.bound else 1):
            value = bits >> max(0, 8 * len(body) - at - width) & (1 << width) - 1
            # A shared allocation has scale factors for each channel.
            used += (1 if band < h.bound else h.channels) if value else 0
            at += width
    return at + 2 * used


def checksum_holds(h: Header, frame: bytes) -> bool:
    body = frame[6 : 6 + 96]
    n = protected_bits(h, body)
    if n > 8 * (len(frame) - 6):
        return False
    part = frame[2:4] + frame[6 : 6 + -(-n // 8)]
    return _sum(part, 16 + n) == struct.unpack(">H", frame[4:6])[0]


@dataclass
class Stream:
    hertz: int = 0
    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    samples: int = 0
    bad_checksums: int = 0
    skipped: int = 0  # bytes that were neither tag nor frame
    tags: dict[str, str] = field(default_factory=dict)
    table: dict[str, int] = field(default_factory=dict)  # frames and bytes by the variable-bitrate table
    seek: list[tuple[int, int]] = field(default_factory=list)  # (sample, bytes from the table's frame) by that table

    def offset_at(self, sample: int) -> int | None:
        """The offset of the frame that holds a sample; None beyond the stream."""
        each = self.samples // len(self.offsets) if self.offsets else 0
        return self.offsets[sample // each] if 0 <= sample < self.samples else None

    @property
    def seconds(self) -> Fraction:
        return Fraction(self.samples, self.hertz) if self.hertz else Fraction(0)


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _id3(data: bytes, out: Stream) -> int:
    """The end of an ID3v2 tag at the start; its text frames go to tags."""
    if data[:3] != b"ID3" or len(data) < 10:
        return 0
    end = min(len(data), 10 + _syncsafe(data[6:10]) + (10 if data[5] & 16 else 0))
    version, at = data[3], 10
    if data[5] & 0x40 and version >= 3 and len(data) >= 14:
        # An extended header counts itself in version 4, not in version 3.
        at += _syncsafe(data[10:14]) if version >= 4 else 4 + struct.unpack(">I", data[10:14])[0]
    # Version 2 has names of three letters and sizes of three bytes.
    n, lead = (3, 6) if version == 2 else (4, 10)
    while at + lead <= end and data[at : at + n].isalnum():
        raw = data[at + n : at + 2 * n]
        size = _syncsafe(raw) if version >= 4 else int.from_bytes(raw, "big")
        body = data[at + lead : min(end, at + lead + size)]
        if data[at : at + 1] == b"T" and body:
            code = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
            out.tags[data[at : at + n].decode("latin-1")] = body[1:].decode(code, errors="replace").rstrip("\0")
        at += lead + size
    return end


def _tail(data: bytes, start: int, out: Stream) -> int:
    """Where the frames end: before an ID3v1 and an APEv2 tag. ID3v1 fields go to tags where ID3v2 has none, APE items as APE:key."""
    end = len(data)
    if end - start >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        text = lambda low, high: data[end + low : end + high].split(b"\0")[0].decode("latin-1").rstrip(" ")
        own = {"TIT2": text(3, 33), "TPE1": text(33, 63), "TALB": text(63, 93), "TDRC": text(93, 97), "COMM": text(97, 127)}
        if not data[end + 125] and data[end + 126]:
            own["TRCK"] = str(data[end + 126])
        for k, v in own.items():
            if v:
                out.tags.setdefault(k, v)
    if end - start >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        size, items, flags = struct.unpack("<III", data[end - 20 : end - 8])
        at, stop = max(start, end - size), end - 32
        end = max(start, end - size - (32 if flags >> 31 else 0))
        for _ in range(items):
            mark = data.find(b"\0", at + 8, stop)
            if mark < 0:
                break
            length, kind = struct.unpack("<II", data[at : at + 8])
            # Binary items have no text.
            if not kind & 2:
                out.tags["APE:" + data[at + 8 : mark].decode("latin-1")] = data[mark + 1 : mark + 1 + length].decode("utf-8", errors="replace")
            at = mark + 1 + length
    return end


def _vbr(data: bytes, at: int, h: Header, out: Stream) -> bool:
    """Whether the frame at `at` is an Xing, Info or VBRI table; its counts and seek points go to the stream."""
    if h.layer != 3:
        return False
    frame = data[at : at + h.size]
    for p in (4 + 2 * h.checked + h.side, 4 + h.side):
        if frame[p : p + 4] in (b"Xing", b"Info") and len(frame) >= p + 8:
            flags, q = struct.unpack(">I", frame[p + 4 : p + 8])[0], p + 8
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit and len(frame) >= q + 4:
                    out.table[name] = struct.unpack(">I", frame[q : q + 4])[0]
                    q += 4
            if flags & 4 and len(frame) >= q + 100:
                whole = out.table.get("frames", 0) * h.samples
                out.seek = [(k * whole // 100, x * out.table.get("bytes", 0) // 256) for k, x in enumerate(frame[q : q + 100])]
                q += 100
            if flags & 8 and len(frame) >= q + 4:
                out.table["quality"] = struct.unpack(">I", frame[q : q + 4])[0]
            return True
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        out.table["quality"], out.table["bytes"], out.table["frames"], n, scale, width, each = struct.unpack(">HIIHHHH", frame[44:62])
        total = 0
        for k in range(min(n, (len(frame) - 62) // max(1, width))):
            out.seek.append((k * each * h.samples, total))
            total += int.from_bytes(frame[62 + k * width : 62 + (k + 1) * width], "big") * scale
        return True
    return False


_SUMS: dict[tuple[bytes, int], int] = {}


def _sum(data: bytes, n: int) -> int:
    if (data, n) not in _SUMS:
        if len(_SUMS) > 10_000:
            _SUMS.clear()
        _SUMS[data, n] = crc16_bits(data, n)
    return _SUMS[data, n]


def parse(data: bytes) -> Stream:
    out = Stream()
    at = _id3(data, out)
    end = _tail(data, at, out)
    kind, synced = None, False
    while at + 4 <= end:
        h = header(data[at : at + 4])
        good = h is not None and at + h.size <= end and (kind is None or h.kind == kind)
        if good and not synced:
            # A lone header may be chance: the next one must follow, or the stream end.
            after = at + h.size
            following = header(data[after : after + 4])
            good = after == end or (following is not None and following.kind == h.kind)
        if not good:
            to = data.find(b"\xff", at + 1, end)
            to = end if to < 0 else to
            out.skipped += to - at
            at, synced = to, False
            continue
        synced = True
        if h.checked and not checksum_holds(h, data[at : at + h.size]):
            out.bad_checksums += 1
        if kind is None:
            kind, out.hertz = h.kind, h.hertz
        if out.offsets or out.table or not _vbr(data, at, h, out):
            out.offsets.append(at)
            out.sizes.append(h.size)
            out.samples += h.samples
        at += h.size
    out.skipped += max(0, end - at)
    return out


_FRAME_SUM = struct.pack(">H", crc16(_HEADER[2:] + bytes(_SIDE)))
_LEAD = _HEADER + _FRAME_SUM + bytes(_SIDE)


def _syncsafe_bytes(n: int) -> bytes:
    return bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127])


def payload_of(text: str | None) -> tuple[bytes, int]:
    """(UTF-8 bytes with spaces up to a positive multiple of 192, bytes without them)."""
    raw = (text or "").encode("utf-8")
    return raw + b" " * (-len(raw) % UNIT or (0 if raw else UNIT)), len(raw)


def write(payload: bytes, n_bytes: int) -> bytes:
    """The stream of a payload, a positive multiple of 192 bytes; `n_bytes` of them count."""
    n = len(payload) // UNIT
    length = b"\x03n_bytes\0" + str(n_bytes).encode()
    tag = b"TXXX" + _syncsafe_bytes(len(length)) + b"\0\0" + length
    tag = b"ID3\x04\0\0" + _syncsafe_bytes(len(tag)) + tag
    toc = bytes(min(255, 256 * (k * n // 100 + 1) // (n + 1)) for k in range(100))
    info = (_LEAD + b"Info" + struct.pack(">III", 7, n, FRAME * (n + 1)) + toc).ljust(FRAME, b"\0")
    frames = np.zeros((n, FRAME), dtype=np.uint8)
    frames[:, : len(_LEAD)] = np.frombuffer(_LEAD, dtype=np.uint8)
    frames[:, len(_LEAD) : len(_LEAD) + UNIT] = np.frombuffer(payload, dtype=np.uint8).reshape(n, UNIT)
    sums = np.array([zlib.crc32(payload[k : k + UNIT]) for k in range(0, len(payload), UNIT)], dtype=">u4")
    frames[:, len(_LEAD) + UNIT : len(_LEAD) + UNIT + 4] = sums.view(np.uint8).reshape(n, 4)
    return tag + info + frames.tobytes()


def read(media: bytes, stream: Stream | None = None) -> tuple[bytes, int]:
    """(payload, number of bytes that count) of a stream that `write` made; broken frames raise."""
    stream = stream or parse(media)
    if stream.bad_checksums or stream.skipped or stream.table.get("frames") != len(stream.offsets):
        raise ValueError("the stream is damaged")
    at = len(_LEAD)
    parts = [media[o + at : o + at + UNIT] for o in stream.offsets]
    for o, part in zip(stream.offsets, parts, strict=True):
        if zlib.crc32(part) != struct.unpack(">I", media[o + at + UNIT : o + at + UNIT + 4])[0]:
            raise ValueError(f"the frame at {o} has another checksum")
    return b"".join(parts), int(stream.tags["TXXX"].partition("\0")[2])


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and media, the MPEG audio stream that holds the text."""

    def run(batches):
        for b in chunks(batches, "text"):
            media = [write(*payload_of(t)) for t in col(b, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([col(b, "id"), pa.array(media, pa.binary())], ["id", "media"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("media", T.BinaryType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


_PROBED = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, hertz int, n_frames long, n_samples long, seconds double, bad_checksums long, frame_offsets array<int>"


def probe(media: DataFrame, *, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Per row: id, the stored payload's length and digests, rate, frames, exact samples, duration, frame seek offsets."""

    def run(batches):
        for b in chunks(batches, "media"):
            rows = []
            for data in col(b, "media").to_pylist():
                s = parse(data)
                payload, n = read(data, s)
                rows.append((n, len(payload), sha256_hex(payload), zlib.crc32(payload[-16:]), len(data), sha256_hex(data), s.hertz, len(s.offsets), s.samples, float(s.seconds), s.bad_checksums, s.offsets))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([col(b, "id"), *[pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names)

    fields = T.StructType.fromDDL(_PROBED)
    names = ["id", *fields.names]
    schema = T.StructType([T.StructField("id", media.schema[id_col].dataType), *fields])
    return media.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op8_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as MPEG audio and read back; the feature is rate, frames, samples and the seek offsets' digest."""
    found = probe(encode(table(spark, sf_dir, "documents")))
    seek = F.md5(F.array_join("frame_offsets", ",").cast("binary"))
    feature = F.format_string("hz=%d;frames=%d;samples=%d;seek=%s", "hertz", "n_frames", "n_samples", seek)
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))

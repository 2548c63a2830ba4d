"""Streams round trip; damaged and foreign streams are parsed as far as they go."""

import hashlib
import struct
import zlib
from fractions import Fraction

import pytest

from docflow.llm import mpeg_audio as m


@pytest.mark.parametrize("text", [None, "", "x", "é" * 96, "x" * 193, "long 你 " * 30_000])
def test_round_trip(text):
    payload, n = m.payload_of(text)
    assert len(payload) % 192 == 0 and payload and n == len((text or "").encode())
    media = m.write(payload, n)
    s = m.parse(media)
    assert m.read(media) == (payload, n)
    assert len(s.offsets) == len(payload) // 192 == s.table["frames"] and s.seconds == Fraction(1152 * len(s.offsets), 48000)
    assert not s.bad_checksums and not s.skipped and all(media[o] == 0xFF for o in s.offsets)


def test_resynchronisation_and_checksums():
    media = m.write(*m.payload_of("hello " * 200))
    whole = m.parse(media)
    junk = b"junk\xff\xfb\x90\x00" + media[: whole.offsets[3]] + b"\xff\xe0 noise" + media[whole.offsets[3] :]
    s = m.parse(junk)
    assert len(s.offsets) == len(whole.offsets) and s.skipped > 0
    broken = bytearray(media)
    broken[whole.offsets[2] + 8] ^= 1
    assert m.parse(bytes(broken)).bad_checksums == 1
    with pytest.raises(ValueError):
        m.read(bytes(broken))
    broken = bytearray(media)
    broken[whole.offsets[2] + 50] ^= 1
    with pytest.raises(ValueError):
        m.read(bytes(broken))


def test_foreign_streams():
    def frame(word, fill=b"\0"):
        return word + fill * (m.header(word).size - 4)

    two = bytes([0xFF, 0xF5, 0x80, 0x00])  # MPEG-2 Layer II, 64 kbit/s, 22.05 kHz
    s = m.parse(frame(two) * 5 + b"TAG" + b"title".ljust(30, b"\0") + bytes(95))
    assert (s.hertz, len(s.offsets), s.samples, s.tags["TIT2"]) == (22050, 5, 5 * 1152, "title")
    one = bytes([0xFF, 0xFF, 0x14, 0x00])  # MPEG-1 Layer I, 32 kbit/s, 48 kHz
    assert m.header(one).size == 32 and m.parse(frame(one) * 3).samples == 3 * 384
    three = bytes([0xFF, 0xE3, 0x20, 0x00])  # MPEG-2.5 Layer III
    vbri = bytearray(frame(three) if m.header(three).size >= 60 else frame(bytes([0xFF, 0xE3, 0x80, 0x00])))
    vbri[36:40] = b"VBRI"
    vbri[46:54] = struct.pack(">II", 777, 2)
    word = bytes(vbri[:4])
    s = m.parse(bytes(vbri) + frame(word) * 2)
    assert s.table == {"quality": 0, "bytes": 777, "frames": 2} and len(s.offsets) == 2
    for data in (b"", b"\xff", b"no audio here", b"\xff" * 500, b"ID3\x04\0\0\0\0\0\x7f"):
        assert m.parse(data).offsets == [] and m.parse(data).seconds == 0


def test_checksum_polynomial():
    # The check value of the CRC with polynomial 0x8005 and all ones at the start, without reflection.
    assert m.crc16(b"123456789") == 0xAEE7


def test_frames(spark):
    texts = ["same", "same", None, "", "é" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' as media", "1 as n_bytes")
    out = {r.doc_id: r for r in m.probe(m.encode(df)).collect()}
    for k, t in enumerate(texts):
        payload, n = m.payload_of(t)
        r = out[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert out[0].media_sha256 == out[1].media_sha256 and out[0].frame_offsets == out[1].frame_offsets
    assert m.probe(m.encode(df.limit(0))).count() == 0


def bitwise(bits):
    """The checksum by its definition, bit by bit."""
    r = 0xFFFF
    for b in bits:
        top = r >> 15 ^ b
        r = (r << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return r


def bits_of(data):
    return [b >> 7 - k & 1 for b in data for k in range(8)]


@pytest.mark.parametrize(
    ("word", "protected"),
    [
        (bytes([0xFF, 0xFE, 0x14, 0xC0]), lambda bits: 32 * 4),  # Layer I, mono
        (bytes([0xFF, 0xFE, 0x44, 0x00]), lambda bits: 64 * 4),  # Layer I, stereo
        (bytes([0xFF, 0xFE, 0x44, 0x50]), lambda bits: (2 * 8 + 24) * 4),  # Layer I, joint stereo from subband 8
        (bytes([0xFF, 0xFC, 0x64, 0xC0]), lambda bits: two(bits, [4] * 11 + [3] * 12 + [2] * 4, 1, 32)),  # Layer II, 48 kHz, mono, 80 kbit/s
        (bytes([0xFF, 0xFC, 0xA0, 0x00]), lambda bits: two(bits, [4] * 11 + [3] * 12 + [2] * 7, 2, 32)),  # 44.1 kHz, stereo, 192 kbit/s
        (bytes([0xFF, 0xFC, 0x40, 0x50]), lambda bits: two(bits, [4] * 2 + [3] * 6, 2, 8)),  # 64 kbit/s, joint stereo from 8
        (bytes([0xFF, 0xFC, 0xA0, 0x40]), lambda bits: two(bits, [4] * 11 + [3] * 12 + [2] * 7, 2, 4)),  # joint stereo from 4
        (bytes([0xFF, 0xFC, 0x18, 0xC0]), lambda bits: two(bits, [4] * 2 + [3] * 10, 1, 32)),  # 32 kHz, mono, 32 kbit/s
        (bytes([0xFF, 0xF4, 0x80, 0x00]), lambda bits: two(bits, [4] * 4 + [3] * 7 + [2] * 19, 2, 32)),  # MPEG-2
    ],
)
def test_checksums_of_layers_one_and_two(word, protected):
    import random

    rng, frames = random.Random(word[2]), []
    for _ in range(4):
        body = bytes(rng.randrange(256) for _ in range(m.header(word).size - 6))
        n = protected(bits_of(body))
        frames.append(word + struct.pack(">H", bitwise(bits_of(word[2:]) + bits_of(body)[:n])) + body)
    whole = m.parse(b"".join(frames))
    assert len(whole.offsets) == 4 and not whole.bad_checksums and not whole.skipped
    broken = bytearray(b"".join(frames))
    broken[len(frames[0]) + 6] ^= 0x80
    assert m.parse(bytes(broken)).bad_checksums == 1


def two(bits, widths, channels, bound):
    at = used = 0
    for band, width in enumerate(widths):
        for _ in range(channels if band < bound else 1):
            used += (1 if band < bound else channels) * any(bits[at : at + width])
            at += width
    return at + 2 * used


def test_seek_tables():
    media = m.write(*m.payload_of("seek " * 20_000))
    s = m.parse(media)
    table = s.offsets[0] - 240
    assert len(s.seek) == 100 and [b for _, b in s.seek] == sorted(b for _, b in s.seek)
    for sample, place in s.seek:
        # A point is coarse: 1 / 256 of the stream.
        assert abs(s.offset_at(sample) - table - place) <= s.table["bytes"] / 256 + 480
    assert s.offset_at(0) == s.offsets[0] and s.offset_at(s.samples - 1) == s.offsets[-1] and s.offset_at(s.samples) is None
    word = bytes([0xFF, 0xFB, 0x90, 0x00])
    size = m.header(word).size
    frame = word + bytes(32) + b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 75, 5_000, 12, 3, 10, 2, 4) + struct.pack(">HHH", 100, 110, 120)
    s = m.parse(frame.ljust(size, b"\0") + (word + bytes(size - 4)) * 12)
    assert s.table == {"quality": 75, "bytes": 5_000, "frames": 12} and s.seek == [(0, 0), (4 * 1152, 1000), (8 * 1152, 2100)] and len(s.offsets) == 12


def test_tags():
    word = bytes([0xFF, 0xFB, 0x90, 0x00])
    frames = (word + bytes(m.header(word).size - 4)) * 3
    old = b"ID3\x02\0\0" + m._syncsafe_bytes(6 + 6) + b"TT2" + (6).to_bytes(3, "big") + b"\0Title"
    v1 = b"TAG" + b"Other".ljust(30, b"\0") + b"Artist".ljust(30) + b"Album".ljust(30, b"\0") + b"1999" + b"Note".ljust(28, b"\0") + b"\0\x07\x01"
    item = struct.pack("<II", 5, 0) + b"Genre\0" + "Bléu".encode() + struct.pack("<II", 3, 2) + b"Cover\0" + b"\xff\xfb\x90"
    foot = b"APETAGEX" + struct.pack("<IIII", 2000, len(item) + 32, 2, 0) + bytes(8)
    s = m.parse(old + frames + item + foot + v1)
    assert s.tags == {"TT2": "Title", "TIT2": "Other", "TPE1": "Artist", "TALB": "Album", "TDRC": "1999", "COMM": "Note", "TRCK": "7", "APE:Genre": "Bléu"} and len(s.offsets) == 3 and not s.skipped


def stored(text):
    """The stream of a text, put together without the operator."""
    raw = (text or "").encode()
    payload = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
    n = len(payload) // 192
    head = bytes([0xFF, 0xFA, 0x64, 0xC4])
    lead = head + struct.pack(">H", bitwise(bits_of(head[2:] + bytes(17)))) + bytes(17)
    body = b"\x03n_bytes\0" + str(len(raw)).encode()
    size = lambda k: bytes([k >> 21 & 127, k >> 14 & 127, k >> 7 & 127, k & 127])
    tag = b"TXXX" + size(len(body)) + b"\0\0" + body
    out = b"ID3\x04\0\0" + size(len(tag)) + tag
    start = len(out) + 240
    out += (lead + b"Info" + struct.pack(">III", 7, n, 240 * (n + 1)) + bytes(min(255, 256 * (k * n // 100 + 1) // (n + 1)) for k in range(100))).ljust(240, b"\0")
    for k in range(0, len(payload), 192):
        out += (lead + payload[k : k + 192] + struct.pack(">I", zlib.crc32(payload[k : k + 192]))).ljust(240, b"\0")
    offsets = ",".join(str(start + 240 * k) for k in range(n))
    feature = f"hz=48000;frames={n};samples={1152 * n};seek={hashlib.md5(offsets.encode()).hexdigest()}"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(raw), len(payload), sha(payload), zlib.crc32(payload[-16:]), len(out), sha(out), feature)


@pytest.mark.parametrize("empty", [False, True])
def test_query(spark, tmp_path, empty):
    """All columns against a stream put together here, over null, empty, repeated and very long texts, null ids and clashing names."""
    texts = [None, "", "x", "é" * 96, "y" * 193, "long 你 " * 60_000]
    rows = [(k, t, "m", 1) for k, t in enumerate(texts)] + [(2, "x", "m", 2), (None, "x", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string, n_bytes int")
    (df.limit(0) if empty else df).write.parquet(str(tmp_path / "documents.parquet"))
    out = m.op8_mpeg_audio(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    assert sorted(map(repr, map(tuple, out.collect()))) == ([] if empty else sorted(repr((k, *stored(t))) for k, t, *_ in rows))

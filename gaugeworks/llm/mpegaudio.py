"""Media columns, MPEG audio: payload bytes in Layer III frames, and a reader that resynchronises, verifies and indexes them.

Stored form: an ID3v2.4 tag (the payload's length as a TXXX frame), a Xing frame (frame count, byte count, table of
contents), then one MPEG-1 Layer III mono frame for each 576 payload bytes: header, CRC-16 over header and side
information, side information, 576 bytes as the frame's unit, and a CRC-32 of these in the ancillary bytes.

The reader takes any MPEG-1, 2 or 2.5 stream of Layer I, II or III with constant or variable bitrate. It trusts nothing but bytes: it
skips tags by their declared size (ID3v2.2 to 2.4 with extended headers and unsynchronisation, ID3v1 at the end),
searches frame headers anew wherever the next one isn't where it should be (sync bits alone do not count: bytes 255 fill the
payloads), checks the CRC of every frame that has one, reads Xing, Info and VBRI tables with an encoder's delay and padding,
and takes durations as exact sample counts and seek offsets as byte offsets of frames. Streams of free bitrate are not read: their
headers don't state a length.

Defined results: a null text is an empty one, stored as one frame of padding; equal texts have equal media; an empty
table gives no rows; extra columns are ignored. Damaged frames are counted and left out of the payload; media not written here have null in the columns of the payload.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import small_batches, stored

UNIT = 576
# Fixed values of MPEG audio: bitrates by (MPEG-1, layer), sampling rates of MPEG-1 (halved in MPEG-2, quartered in 2.5), samples of a frame.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = (44100, 48000, 32000)
SAMPLES = {(True, 1): 384, (True, 2): 1152, (True, 3): 1152, (False, 1): 384, (False, 2): 1152, (False, 3): 576}
# Fixed values of Layer II: bits of the allocation fields by subband, for the two wide tables, the two narrow ones and MPEG-2.
WIDE, NARROW, LOW = (4,) * 11 + (3,) * 12 + (2,) * 7, (4,) * 2 + (3,) * 10, (4,) * 4 + (3,) * 7 + (2,) * 19
SIDE_MONO = 17
RATE, BITRATE = 48000, 224
FRAME = 144 * BITRATE * 1000 // RATE
HEADER = bytes([0xFF, 0xFA, BITRATES[True, 3].index(BITRATE) << 4 | RATES.index(RATE) << 2, 0xC0])
AT_CRC, AT_SIDE, AT_DATA = 4, 6, 6 + SIDE_MONO
AT_SUM = AT_DATA + UNIT


def _crc16_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32) << 8
    for _ in range(8):
        t = np.where(t & 0x8000, t << 1 ^ 0x8005, t << 1) & 0xFFFF
    return t


CRC16 = _crc16_table()


def crc16(rows: np.ndarray) -> np.ndarray:
    """CRC-16 (polynomial 8005, initial value FFFF) of each row of bytes."""
    crc = np.full(len(rows), 0xFFFF, dtype=np.uint32)
    for k in range(rows.shape[1]):
        crc = (crc << 8 & 0xFFFF) ^ CRC16[(crc >> 8) ^ rows[:, k]]
    return crc


def padded(data: bytes) -> bytes:
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def encode(data: bytes) -> bytes:
    """The stored form of one payload."""
    payload = np.frombuffer(padded(data), dtype=np.uint8).reshape(-1, UNIT)
    n = len(payload)
    frames = np.zeros((n + 1, FRAME), dtype=np.uint8)
    frames[:, :4] = np.frombuffer(HEADER, dtype=np.uint8)
    frames[1:, AT_DATA:AT_SUM] = payload
    sums = np.array([zlib.crc32(p) for p in payload], dtype=">u4")
    frames[1:, AT_SUM : AT_SUM + 4] = sums.view(np.uint8).reshape(n, 4)
    toc = bytes(min(255, 256 * (i * (n + 1) // 100) // (n + 1)) for i in range(100))
    xing = b"Xing" + struct.pack(">III", 7, n, (n + 1) * FRAME) + toc
    frames[0, AT_DATA : AT_DATA + len(xing)] = np.frombuffer(xing, dtype=np.uint8)
    crc = crc16(np.concatenate([frames[:, 2:4], frames[:, AT_SIDE:AT_DATA]], axis=1)).astype(">u2")
    frames[:, AT_CRC:AT_SIDE] = crc.view(np.uint8).reshape(n + 1, 2)
    text = b"\x03payload_bytes\x00" + str(len(data)).encode()
    tag = b"TXXX" + _syncsafe(len(text)) + b"\x00\x00" + text
    return b"ID3\x04\x00\x00" + _syncsafe(len(tag)) + tag + frames.tobytes()


@dataclass(frozen=True)
class Head:
    """A frame header's fields. length: bytes of the frame, header included."""

    mpeg1: bool
    layer: int
    rate: int
    bitrate: int
    protected: bool
    mode: int
    bound: int
    length: int
    samples: int

    @property
    def channels(self) -> int:
        return 1 if self.mode == 3 else 2

    @property
    def side(self) -> int:
        """Bytes of Layer III's side information."""
        return (17 if self.mode == 3 else 32) if self.mpeg1 else (9 if self.mode == 3 else 17)


@lru_cache(maxsize=4096)
def head_of(h: bytes) -> Head | None:
    """The header in these 4 bytes; None if they are none, or of free bitrate."""
    if len(h) < 4 or h[0] != 0xFF or h[1] & 0xE0 != 0xE0:
        return None
    version, layer = h[1] >> 3 & 3, 4 - (h[1] >> 1 & 3)
    if version == 1 or layer == 4 or h[2] >> 4 in (0, 15) or h[2] >> 2 & 3 == 3 or h[3] & 3 == 2:
        return None
    mpeg1 = version == 3
    rate = RATES[h[2] >> 2 & 3] >> (0 if mpeg1 else 1 if version == 2 else 2)
    bitrate, pad, samples = BITRATES[mpeg1, layer][h[2] >> 4], h[2] >> 1 & 1, SAMPLES[mpeg1, layer]
    length = (12000 * bitrate // rate + pad) * 4 if layer == 1 else samples // 8 * 1000 * bitrate // rate + pad
    mode = h[3] >> 6
    return Head(mpeg1, layer, rate, bitrate, not h[1] & 1, mode, 4 * ((h[3] >> 4 & 3) + 1) if mode == 1 else 32, length, samples)


def protected_bits(head: Head, frame: bytes) -> int:
    """How many bits after the CRC it covers, besides the header's last 16."""
    if head.layer == 3:
        return 8 * head.side
    both = min(head.bound, 32) if head.channels == 2 else 0
    if head.layer == 1:
        return 4 * (32 + both if head.channels == 2 else 32)
    per = head.bitrate // head.channels
    if not head.mpeg1:
        fields = LOW
    elif per <= 48 and head.rate != 32000:
        fields = NARROW[:8]
    elif per <= 48:
        fields = NARROW
    elif per <= 80 or head.rate == 48000:
        fields = WIDE[:27]
    else:
        fields = WIDE
    value, size, at, chosen = int.from_bytes(frame[AT_SIDE : AT_SIDE + 128], "big"), 8 * len(frame[AT_SIDE : AT_SIDE + 128]), 0, 0
    for band, n in enumerate(fields):
        apart = head.channels if band < head.bound else 1
        for _ in range(apart):
            at += n
            # Where channels share an allocation each still has its own scale factor selection.
            chosen += (value >> max(0, size - at) & (1 << n) - 1 > 0) * (head.channels // apart)
    return at + 2 * chosen


def crc16_bits(data: bytes, bits: int) -> int:
    """The same CRC over the first bits of some bytes."""
    crc, whole = 0xFFFF, bits // 8
    for b in data[:whole]:
        crc = (crc << 8 & 0xFFFF) ^ int(CRC16[(crc >> 8) ^ b])
    for k in range(bits % 8):
        top = (crc >> 15) ^ (data[whole] >> (7 - k) & 1)
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return crc


def crc_right(head: Head, rows: np.ndarray) -> np.ndarray:
    """Of frames with one header: is the CRC right? True where there is none."""
    if not head.protected:
        return np.ones(len(rows), dtype=bool)
    if rows.shape[1] < AT_SIDE:
        return np.zeros(len(rows), dtype=bool)
    want = rows[:, AT_CRC].astype(np.uint32) << 8 | rows[:, AT_CRC + 1]
    if head.layer != 2:
        end = AT_SIDE + protected_bits(head, b"") // 8
        if rows.shape[1] < end:
            return np.zeros(len(rows), dtype=bool)
        return crc16(np.concatenate([rows[:, 2:4], rows[:, AT_SIDE:end]], axis=1)) == want
    out = []
    for r, w in zip(rows, want, strict=True):
        frame = r.tobytes()
        bits = protected_bits(head, frame)
        out.append(AT_SIDE + (bits + 7) // 8 <= len(frame) and crc16_bits(frame[2:4] + frame[AT_SIDE:], 16 + bits) == w)
    return np.array(out, dtype=bool)


@dataclass
class Audio:
    """What the reader found. offsets: byte offset of each sound frame; samples: of all sound frames; delay, padding: the encoder's, so that samples - delay - padding is the exact length at `rate`."""

    tags: dict[str, str] = field(default_factory=dict)
    kind: str = ""
    rate: int = 0
    channels: int = 0
    samples: int = 0
    frames: int = 0
    bad_crc: int = 0
    resyncs: int = 0
    vbr: tuple[int, int] | None = None
    toc: bytes = b""
    delay: int = 0
    padding: int = 0
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    payload: bytes = b""


def _text(raw: bytes) -> list[str]:
    """Strings of a text frame: a byte for the encoding, then strings with a zero between."""
    name = ("latin-1", "utf-16", "utf-16-be", "utf-8")[raw[0]] if raw and raw[0] < 4 else "latin-1"
    return raw[1:].decode(name, "replace").rstrip("\x00").split("\x00")


def read_tags(data: bytes) -> tuple[dict[str, str], int]:
    """Text frames of a leading ID3v2 tag by their id, or by their name for TXXX, and where the tag ends."""
    if data[:3] != b"ID3" or len(data) < 10 or max(data[6:10]) > 127:
        return {}, 0
    safe = lambda b: b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]
    version, flags, end = data[3], data[5], 10 + safe(data[6:10])
    body, tags, at = data[10:end], {}, 0
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\x00", b"\xff")
    if flags & 0x40 and version >= 3 and len(body) >= 4:
        at = safe(body) if version == 4 else 4 + int.from_bytes(body[:4], "big")
    name_size, head_size = (3, 6) if version == 2 else (4, 10)
    while at + head_size <= len(body) and body[at : at + name_size].strip(b"\x00"):
        name, size = body[at : at + name_size].decode("latin-1"), body[at + name_size : at + 2 * name_size]
        n = safe(size) if version == 4 else int.from_bytes(size, "big")
        raw = body[at + head_size : at + head_size + n]
        if version == 4:
            raw = raw[4:] if body[at + 9] & 1 else raw
            raw = raw.replace(b"\xff\x00", b"\xff") if body[at + 9] & 2 else raw
        if name in ("TXXX", "TXX"):
            first, *rest = _text(raw)
            tags[first] = "\x00".join(rest)
        elif name[0] == "T":
            tags[name] = "\x00".join(_text(raw))
        at += head_size + n
    return tags, end + (10 if flags & 0x10 else 0)


def read_end_tag(data: bytes) -> tuple[dict[str, str], int]:
    """Fields of an ID3v1 tag, and where the sound ends."""
    if data[-128:-125] != b"TAG" or len(data) < 128:
        return {}, len(data)
    tag = data[-128:]
    said = {k: tag[a:b].split(b"\x00")[0].decode("latin-1").rstrip() for k, a, b in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97), ("comment", 97, 127))}
    if tag[125] == 0 and tag[126]:
        said["track"] = str(tag[126])
    return {f"v1.{k}": v for k, v in said.items() if v}, len(data) - 128


def read_table(head: Head, frame: bytes, out: Audio) -> bool:
    """Reads a Xing, Info or VBRI table; False if the frame holds none."""
    if head.layer != 3:
        return False
    for at in (4 + head.side, 6 + head.side):
        if frame[at : at + 4] in (b"Xing", b"Info"):
            flags, at = int.from_bytes(frame[at + 4 : at + 8], "big"), at + 8
            fields = {}
            for bit, size in ((1, 4), (2, 4), (4, 100), (8, 4)):
                if flags & bit:
                    fields[bit], at = frame[at : at + size], at + size
            number = lambda b: int.from_bytes(fields.get(b, b""), "big")
            out.vbr, out.toc = (number(1), number(2)) if flags & 3 == 3 else None, fields.get(4, b"")
            if frame[at : at + 4].isalnum() and len(frame) >= at + 24:
                out.delay, out.padding = frame[at + 21] << 4 | frame[at + 22] >> 4, (frame[at + 22] & 15) << 8 | frame[at + 23]
            return True
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        _, delay, _, size, frames, entries, _, width, _ = struct.unpack(">HHHIIHHHH", frame[40:62])
        out.vbr, out.delay, out.toc = (frames, size), delay, frame[62 : 62 + entries * width]
        return True
    return False


def _run(data: np.ndarray, at: int, end: int, length: int) -> int:
    """How many frames with the first one's header bytes follow one another from here, at the first one's length."""
    n = (end - at) // length
    if n < 2:
        return n
    heads = data[at : at + n * length].reshape(n, length)[:, :4]
    same = (heads == heads[0]).all(axis=1)
    return n if same.all() else int(np.argmin(same))


def decode(media: bytes) -> Audio:
    """Reads one stream. Frames that follow one another are taken as one block; a lost position is searched anew byte by byte. A header counts only if its frame's CRC is there and right, or another header of its kind follows it, or its frame ends where the sound does."""
    out = Audio()
    out.tags, at = read_tags(media)
    more, end = read_end_tag(media)
    out.tags |= more
    data, offsets, parts, lost = np.frombuffer(media, dtype=np.uint8), [], [], False
    own = "payload_bytes" in out.tags
    kin = lambda a, b: b is not None and (a.mpeg1, a.layer, a.rate) == (b.mpeg1, b.layer, b.rate)
    while at + 4 <= end:
        head = head_of(media[at : at + 4])
        stop = at + head.length if head else at
        good = head is not None and stop <= end and (stop == end or kin(head, head_of(media[stop : stop + 4])))
        if head and stop <= end and not good:
            good = head.protected and bool(crc_right(head, data[at:stop][None, :])[0])
        if not good:
            here = media.find(b"\xff", at + 1, end)
            out.resyncs += not lost
            at, lost = here if here >= 0 else end, True
            continue
        lost = False
        n = _run(data, at, end, head.length)
        rows = data[at : at + n * head.length].reshape(n, head.length)
        right = crc_right(head, rows)
        first = int(not offsets and not out.rate and read_table(head, rows[0].tobytes(), out))
        if not out.rate:
            out.rate, out.channels, out.kind = head.rate, head.channels, f"mpeg{1 if head.mpeg1 else 2 if head.rate >= 16000 else 2.5}-layer{head.layer}"
        out.bad_crc += int((~right[:first]).sum())
        kept_rows = rows[first:]
        whole = right[first:]
        if own and head.length >= AT_SUM + 4 and len(kept_rows):
            units = np.ascontiguousarray(kept_rows[:, AT_DATA:AT_SUM])
            sums = np.ascontiguousarray(kept_rows[:, AT_SUM : AT_SUM + 4]).view(">u4").ravel()
            whole = whole & (sums == np.array([zlib.crc32(u) for u in units], dtype=np.uint32))
            parts.append(units[whole].tobytes())
        out.bad_crc += int((~whole).sum())
        out.frames += len(kept_rows)
        out.samples += len(kept_rows) * head.samples
        offsets.append(at + head.length * np.arange(first, n))
        at += n * head.length
    out.offsets = np.concatenate(offsets).astype(np.int64) if offsets else out.offsets
    out.payload = b"".join(parts)
    return out


def write_media(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Stores the media column of all documents: doc_id, media."""
    small_batches(docs.sparkSession)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame({"doc_id": x["doc_id"].astype("Int64"), "media": [encode(bytes(b)) for b in x["data"]]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    return stored(rows.mapInPandas(build, "doc_id long, media binary"), "mpeg-media")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, duration_samples long, sample_rate int, frame_offsets array<long>"


def read_media(media: DataFrame) -> DataFrame:
    """Features of stored media (doc_id, media), all of them from the bytes read back."""
    small_batches(media.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for i, m in zip(x["doc_id"].astype("object"), x["media"], strict=True):
                m = bytes(m)
                a = decode(m)
                own = "payload_bytes" in a.tags
                feature = f"{a.kind};rate={a.rate};frames={a.frames};samples={a.samples};xing_frames={a.vbr[0] if a.vbr else ''};bad_crc={a.bad_crc};resyncs={a.resyncs};first={a.offsets[0] if len(a.offsets) else ''};offsets_crc32={zlib.crc32(a.offsets.astype('<i8').tobytes())}"
                payload = (int(a.tags["payload_bytes"]), len(a.payload), hashlib.sha256(a.payload).hexdigest(), zlib.crc32(a.payload[-32:])) if own else (None,) * 4
                rows.append((i, *payload, len(m), hashlib.sha256(m).hexdigest(), feature, a.samples, a.rate, a.offsets))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in FEATURES.split(", ")])
            yield out.astype(dict.fromkeys(("doc_id", "n_bytes", "payload_bytes", "tail_crc32"), "Int64"))

    return media.mapInPandas(scan, FEATURES)

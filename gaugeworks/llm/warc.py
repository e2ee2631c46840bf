"""WARC bundles in seekable Zstandard: records grouped into independent frames, a footer seek table, an index of records.

A bundle is a valid .warc.zst stream: frames one after the other, then a skippable frame in the layout of the
public seekable format (per frame: stored and decoded size, u32 each; then frame count, flags, magic number).
Each record maps to (bundle, frame offset, offset inside the frame). The map is made while records are packed and stored beside the bundles, a
column of its own; read_records() looks ids up in it, reads the bundles that hold them and decompresses one frame for each record.

Records with equal payloads are written once: the smallest page_id is the response, the others are revisits with
the profile of identical payload digests. Every payload travels only once, with its own row.

Defined results: null html is an empty payload; rows that share the smallest page_id of their payload are all
responses; a null page_id is a revisit if another row has the payload under an id, else a response; payloads under
`least_bytes` are never revisits; an empty table gives no bundles and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import small_batches, stored

# Fixed values of the Zstandard seekable format and of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 23
DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    clean = "".join(c for c in url or "" if c > " ")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, bytes, int]:
    """The record at an offset: its headers, its HTTP head, its payload (empty for revisits) and the next offset."""
    end = raw.index(b"\r\n\r\n", at)
    version, *lines = raw[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    body = raw[end + 4 : end + 4 + int(head["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return head, http, payload, end + 8 + len(body)


class BundleWriter:
    """Collects records; `done()` gives the bundle's bytes."""

    def __init__(self) -> None:
        self.pack, self.frames, self.sizes = zstandard.ZstdCompressor(level=6, write_checksum=True).compress, [], []
        self.now, self.pending, self.size, self.stored = [], 0, 0, 0
        self.index: list[tuple[int | None, int, int]] = []

    def add(self, page_id: int | None, rec: bytes) -> None:
        self.index.append((page_id, self.stored, self.pending))
        self.now.append(rec)
        self.size, self.pending = self.size + len(rec), self.pending + len(rec)
        if self.pending >= FRAME_BYTES:
            self.close()

    def close(self) -> None:
        if self.now:
            raw = b"".join(self.now)
            self.frames.append(self.pack(raw))
            self.sizes.append((len(self.frames[-1]), len(raw)))
            self.stored += len(self.frames[-1])
            self.now, self.pending = [], 0

    def done(self) -> bytes:
        self.close()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE, len(table)), table])


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, stored size, decoded size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or flags & 0x80:
        raise ValueError("not a seekable bundle")
    out, at = [], 0
    for k in range(n):
        size, raw = struct.unpack_from("<II", bundle, len(bundle) - 9 - 8 * (n - k))
        out.append((at, size, raw))
        at += size
    return out


def read_record(bundle: bytes, frame_offset: int, record_offset: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; decodes one frame."""
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(bundle[frame_offset:])
    head, _, payload, _ = parse(raw, record_offset)
    return head, payload


BUNDLES = "bundle string, records array<struct<page_id:long,frame_offset:long,record_offset:long>>, data binary"


def page_of(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def write_bundles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Stores all pages. Returns the bundles: bundle, records (the map of its records' ids), data."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # One row per payload, from partial minima; read back as a table, so that Spark can split a payload with very many pages in the join.
    firsts = stored(rows.groupBy("sha").agg(F.min("page_id").alias("first_id")), "warc-firsts")
    rows = rows.join(firsts, "sha").drop("sha")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, k, w = TaskContext.get().partitionId(), 0, BundleWriter()
        whole = lambda i: None if pd.isna(i) else int(i)

        def row(k: int, w: BundleWriter) -> pd.DataFrame:
            data = w.done()
            return pd.DataFrame({"bundle": [f"{part:06d}-{k:04d}"], "records": [[dict(zip(("page_id", "frame_offset", "record_offset"), r, strict=True)) for r in w.index]], "data": [data]})

        for x in batches:
            for i, url, payload, first in zip(x["page_id"].astype("object"), x["url"], x["payload"], x["first_id"].astype("object"), strict=True):
                payload, i, first = bytes(payload), whole(i), whole(first)
                revisit = len(payload) >= least_bytes and i != first
                w.add(i, record(i, url, payload, base64.b32encode(hashlib.sha1(payload).digest()).decode(), first if revisit else None, revisit))
                if w.size >= BUNDLE_BYTES:
                    yield row(k, w)
                    k, w = k + 1, BundleWriter()
        if w.size:
            yield row(k, w)

    # The frames are compressed already.
    return stored(rows.mapInPandas(build, BUNDLES), "warc-bundles", "uncompressed")


def record_index(bundles: DataFrame) -> DataFrame:
    """page_id, bundle, frame_offset, record_offset of every record, from the stored map: no frame is read."""
    return bundles.select("bundle", F.explode("records").alias("r")).select("r.page_id", "bundle", "r.frame_offset", "r.record_offset")


def read_records(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to and payload (empty for revisits) of the records whose page_id is in `wanted`, through the stored map."""
    ids = wanted.select(F.col("page_id").cast("long").alias("page_id")).distinct()
    found = record_index(bundles)
    found = found.join(ids, found["page_id"].eqNullSafe(ids["page_id"]), "left_semi").groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("frame_offset", "record_offset"))).alias("places"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for data, places in zip(x["data"], x["places"], strict=True):
                got = [read_record(bytes(data), p["frame_offset"], p["record_offset"]) for p in places]
                out = pd.DataFrame({"page_id": [page_of(h["WARC-Record-ID"]) for h, _ in got], "record_type": [h["WARC-Type"] for h, _ in got], "refers_to": [page_of(h.get("WARC-Refers-To")) for h, _ in got], "payload": [p for _, p in got]})
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return bundles.select("bundle", "data").join(found, "bundle").mapInPandas(read, "page_id long, record_type string, refers_to long, payload binary")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Per record, from the bundles: page_id, payload_bytes, payload_digest, record_type, refers_to, bundle, frame_offset, record_offset. A response's digest is computed anew and must match."""
    small_batches(bundles.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for x in batches:
            for name, data in zip(x["bundle"], x["data"], strict=True):
                data, out = bytes(data), []
                for at, size, _ in seek_table(data):
                    raw, k = unpack(data[at : at + size]), 0
                    while k < len(raw):
                        head, http, payload, following = parse(raw, k)
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if head["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
                        out.append((page_of(head["WARC-Record-ID"]), int(http.rpartition(b"Content-Length: ")[2]), digest, head["WARC-Type"], page_of(head.get("WARC-Refers-To")), name, at, k))
                        k = following
                got = pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame_offset", "record_offset"])
                yield got.assign(page_id=got["page_id"].astype("Int64"), refers_to=got["refers_to"].astype("Int64"))

    return bundles.select("bundle", "data").mapInPandas(scan, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, bundle string, frame_offset long, record_offset long")

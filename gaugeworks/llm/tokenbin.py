"""Token ids as binary files: independent zstandard frames, a trailing seek table, a checksum per frame.

File layout, little-endian:
    8 bytes  b"GWTOKEN1"
    frames   zstandard, each decodable alone; content: the ids of its documents, uint32
    index    zstandard frame: doc_id int64[], flags uint8[] (1: null id), n_tokens int64[] in file order
    table    per frame: offset u64, stored u64, documents u64, tokens u64, crc32 of the decoded content u32
    footer   index offset u64, table offset u64, frames u32, crc32 of index and table u32, b"GWTOKEND"
A reader fetches the footer, the table and the index, then only the frames of the documents that it needs.

Files are binary values of a table that Spark writes and reads, so any store that Spark reaches can hold them; beside each stand the ids of
its documents, a column of its own. read_documents() finds the files of the requested ids by that column, reads these files alone and decompresses
only the frames that hold them.

Encoding is fast where the tokenizer is a plain byte-level one (no normal form, its own cutting pattern, no prefix blank); any other file of the
tokenizers library is encoded by the library alone, with equal results.

Defined results: null text encodes as empty, which is the end id alone; repeated ids keep one entry per
row, ordered by text; null ids come first; an empty table gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.bpe import byte_symbols
from gaugeworks.llm.common import kept, small_batches, stored

HEAD, TAIL = b"GWTOKEN1", b"GWTOKEND"
ROW, FOOT = "<QQQQI", "<QQII8s"
ROW_BYTES, FOOT_BYTES = struct.calcsize(ROW), struct.calcsize(FOOT)
FRAME_TOKENS = 1 << 16
FILE_TOKENS = 1 << 22
CACHE_WORDS = 400_000
# Fixed value: where the library's ByteLevel pre-tokenizer cuts.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Words(dict):
    """Ids of words as bytes; a word not known yet is encoded when it is asked for."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.encode(word)
        return ids


class WordEncoder:
    """Encodes whole texts with a byte-level tokenizer of the tokenizers library, each distinct word of a batch once, remembering the ids of words.

    A text is cut before single blanks. The tokenizer's own cuts fall there too unless a blank stands inside a
    longer run of white space or ends such a run at the end of the text; such texts, and those that hold a
    special token's string, go to the library whole. A new word is cut by the tokenizer's pattern and its pieces are
    encoded by the library's model; words with letters beyond Latin or unusual blanks go through the library's own cutting.
    The memories are bounded by CACHE_WORDS.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cuts, model = spec.get("pre_tokenizer") or {}, spec["model"]
        odd = [spec.get("normalizer"), spec.get("truncation"), spec.get("padding"), *(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))]
        self.simple = cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts.get("add_prefix_space") and model["type"] == "BPE" and not any(odd)
        self.simple = self.simple and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        # White space, a blank, and white space or the end again; the first as the library's pattern has it.
        space = "\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self.whole = f"[{space}] (?:[{space}]|\\z)"
        self.plain = re.compile("[\n -~\u00a1-\u00ac\u00ae-\u024f]*")
        self.cut = regex.compile(CUTS)
        self.symbols = {b: c for b, c in enumerate(byte_symbols()) if chr(b) != c}
        self.blank = byte_symbols()[32]
        self.model = self.library.model
        self.pieces, self.inner, self.first = Words(self.piece), Words(lambda w: self.word(" " + w)), Words(self.word)

    def piece(self, piece: str) -> bytes:
        # Of printable ASCII only the blank has another symbol.
        symbols = piece.replace(" ", self.blank) if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.symbols)
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def word(self, word: str) -> bytes:
        if word[1:].isalpha() and word.isascii() and (word[0] == " " or word[0].isalpha()):
            return self.pieces[word]
        # Letters and one sign after them: two pieces, as the pattern cuts.
        if word[1:-1].isalpha() and word[-1] in ".,;:!?" and word.isascii() and (word[0] == " " or word[0].isalpha()):
            return self.pieces[word[:-1]] + self.pieces[word[-1]]
        if self.plain.fullmatch(word):
            return b"".join([self.pieces[p] for p in self.cut.findall(word)])
        return self.text(word)

    def text(self, text: str) -> bytes:
        return array("I", self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def known(self, words: pa.Array, table: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct words one after the other, where each begins, and the distinct word of each word."""
        coded = words.dictionary_encode()
        if len(table) > CACHE_WORDS:
            table.clear()
        ids = [table[w] for w in coded.dictionary.to_pylist()]
        starts = np.concatenate([[0], np.cumsum([len(b) // 4 for b in ids])]).astype(np.int64)
        return np.frombuffer(b"".join(ids), dtype="<u4"), starts, coded.indices.to_numpy(zero_copy_only=False)

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, which must not be null, as little-endian uint32."""
        if not len(texts):
            return []
        odd = pc.match_substring_regex(texts, self.whole)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        odd = odd.to_numpy(zero_copy_only=False)
        if not self.simple:
            odd[:] = True
        if len(self.pieces) > CACHE_WORDS:
            self.pieces.clear()
        out = [self.text(t.as_py()) if o else b"" for t, o in zip(texts, odd, strict=True)]
        at = np.flatnonzero(~odd)
        if not len(at):
            return out
        cut = pc.split_pattern(texts.take(pa.array(at)), " ")
        words, begins = cut.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())]).astype(np.int64)
        ids, starts, code = self.known(words, self.inner)
        first, first_starts, first_code = self.known(words.take(pa.array(begins[:-1])), self.first)
        # The first words of texts have no blank before them: their ids stand behind those of the others.
        low, size = starts[:-1][code], np.diff(starts)[code]
        low[begins[:-1]], size[begins[:-1]] = len(ids) + first_starts[:-1][first_code], np.diff(first_starts)[first_code]
        ends = np.cumsum(size)
        flat = np.concatenate([ids, first])[np.repeat(low - (ends - size), size) + np.arange(ends[-1])].tobytes()
        bounds = 4 * np.concatenate([[0], ends])[begins]
        for k, a, b in zip(at, bounds, bounds[1:], strict=False):
            out[k] = flat[a:b]
        return out


def write_file(rows: list[tuple[int | None, bytes]], level: int = 3) -> bytes:
    """One file for (id, token ids as little-endian uint32) in the order given."""
    pack = zstandard.ZstdCompressor(level=level).compress
    out, table, frame, docs, tokens, at = [HEAD], [], [], 0, 0, len(HEAD)

    def close() -> None:
        nonlocal frame, docs, tokens, at
        if docs:
            raw = b"".join(frame)
            out.append(pack(raw))
            table.append(struct.pack(ROW, at, len(out[-1]), docs, tokens, zlib.crc32(raw)))
            at, frame, docs, tokens = at + len(out[-1]), [], 0, 0

    for _, ids in rows:
        frame.append(ids)
        docs, tokens = docs + 1, tokens + len(ids) // 4
        if tokens >= FRAME_TOKENS:
            close()
    close()
    ids = np.array([-1 if i is None else i for i, _ in rows], dtype="<i8")
    null = np.array([i is None for i, _ in rows], dtype="u1")
    n = np.array([len(x) // 4 for _, x in rows], dtype="<i8")
    index, tab = pack(ids.tobytes() + null.tobytes() + n.tobytes()), b"".join(table)
    return b"".join([*out, index, tab, struct.pack(FOOT, at, at + len(index), len(table), zlib.crc32(index + tab), TAIL)])


class FileReader:
    """Random access to one file; `fetch(offset, length)` gives its bytes, so only what is asked for is read."""

    def __init__(self, size: int, fetch: Callable[[int, int], bytes]) -> None:
        index_at, table_at, frames, crc, tail = struct.unpack(FOOT, fetch(size - FOOT_BYTES, FOOT_BYTES))
        if tail != TAIL:
            raise ValueError("not a token file")
        both = fetch(index_at, size - FOOT_BYTES - index_at)
        if zlib.crc32(both) != crc:
            raise ValueError("the index or the seek table is damaged")
        self.fetch, self.unpack = fetch, zstandard.ZstdDecompressor().decompress
        tab = both[table_at - index_at :]
        self.frames = [struct.unpack_from(ROW, tab, k * ROW_BYTES) for k in range(frames)]
        raw = self.unpack(both[: table_at - index_at])
        docs = sum(f[2] for f in self.frames)
        self.ids = [None if z else int(i) for i, z in zip(np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, "u1", docs, 8 * docs), strict=True)]
        self.n = np.frombuffer(raw, "<i8", docs, 9 * docs)
        self.first = np.cumsum([0, *[f[2] for f in self.frames]])
        self.start = np.concatenate([[0], np.cumsum(self.n)])

    def frame(self, k: int) -> bytes:
        at, stored_bytes, _, _, crc = self.frames[k]
        raw = self.unpack(self.fetch(at, stored_bytes))
        if zlib.crc32(raw) != crc:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document; decodes its frame alone."""
        f = int(np.searchsorted(self.first, k, side="right")) - 1
        at = 4 * int(self.start[k] - self.start[self.first[f]])
        return np.frombuffer(self.frame(f), "<u4", int(self.n[k]), at)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(id, start in this file, ids as bytes) of all documents, frame by frame."""
        for f in range(len(self.frames)):
            raw, base = self.frame(f), self.start[self.first[f]]
            for k in range(self.first[f], self.first[f + 1]):
                a = 4 * int(self.start[k] - base)
                yield self.ids[k], int(self.start[k]), raw[a : a + 4 * int(self.n[k])]


FILES = "part int, file int, tokens long, doc_ids array<long>, data binary"


def write_files(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id") -> DataFrame:
    """Encodes and stores all documents in id order. Returns the files: part, file, tokens, doc_ids (of its documents in order), data."""
    spark = docs.sparkSession
    small_batches(spark)
    end = struct.pack("<I", end_id)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, file, rows, tokens = kept(f"words {path}", lambda: WordEncoder(path)), TaskContext.get().partitionId(), 0, [], 0

        def row() -> pa.RecordBatch:
            columns = {"part": pa.array([part], pa.int32()), "file": pa.array([file], pa.int32()), "tokens": pa.array([tokens], pa.int64()), "doc_ids": pa.array([[i for i, _ in rows]], pa.list_(pa.int64())), "data": pa.array([write_file(rows)], pa.binary())}
            return pa.RecordBatch.from_pydict(columns)

        for x in batches:
            for i, b in zip(x.column("doc_id").to_pylist(), encoder.ids(x.column("text")), strict=True):
                rows.append((i, b + end))
                tokens += len(b) // 4 + 1
                if tokens >= FILE_TOKENS:
                    yield row()
                    file, rows, tokens = file + 1, [], 0
        if rows:
            yield row()

    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    # The frames are compressed already.
    return stored(ordered.mapInArrow(build, FILES), "token-files", "uncompressed")


def read_documents(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and ids (array) of the documents whose doc_id is in `wanted`: only the files that hold one are read, and of these only its frame is decompressed. A repeated or null id gives a row for each of its documents."""
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    at = files.select("part", "file", F.posexplode("doc_ids").alias("k", "doc_id"))
    hits = at.join(ids, at["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").groupBy("part", "file").agg(F.array_sort(F.collect_list("k")).alias("ks"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for data, ks in zip(x["data"], x["ks"], strict=True):
                reader = FileReader(len(data), lambda at, n, d=data: d[at : at + n])
                rows = [(reader.ids[k], reader.document(int(k)).astype(np.int64)) for k in ks]
                yield pd.DataFrame({"doc_id": pd.array([i for i, _ in rows], dtype="Int64"), "ids": [b for _, b in rows]})

    return files.select("part", "file", "data").join(hits, ["part", "file"]).mapInPandas(read, "doc_id long, ids array<long>")


def read_files(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, part, file."""
    small_batches(files.sparkSession)
    # One row per file, of whole partitions in order: small beside the files, 1 row for FILE_TOKENS tokens.
    heads = files.select("part", "file", "tokens")
    base = heads.groupBy("part").agg(F.sum("tokens").alias("all"))
    base = base.select("part", (F.sum("all").over(W.orderBy("part")) - F.col("all")).alias("before"))
    inner = heads.select("part", "file", (F.sum("tokens").over(W.partitionBy("part").orderBy("file")) - F.col("tokens")).alias("inside"))
    base = inner.join(base, "part").select("part", "file", (F.col("before") + F.col("inside")).alias("base"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for part, file, data in zip(x["part"], x["file"], x["data"], strict=True):
                reader = FileReader(len(data), lambda at, n, d=data: d[at : at + n])
                rows = [(i, s, len(b) // 4, zlib.crc32(b)) for i, s, b in reader.documents()]
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"), part=part, file=file)

    rows = files.select("part", "file", "data").mapInPandas(scan, "doc_id long, start long, n_tokens long, ids_crc32 long, part int, file int")
    return rows.join(base, ["part", "file"]).select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", "part", "file")

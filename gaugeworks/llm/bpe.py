"""BPE encoding and decoding by dynamic programming over prefixes.

For each prefix of a word there is exactly one token that its encoding ends with. It is the one among the vocabulary's
tokens ending there (found by an automaton with suffix links) that may follow the last token of what remains
before it. Following these back-pointers from the whole word gives the exact ids, without running merges.

Two tokens may stand side by side if no merge across their border would have come before the merges that made them.
A token's border pieces form a chain from its outermost unit to itself, each piece absorbed by the next at
the rank of that merge. Walking both chains in the order of absorption meets every pair of pieces that ever faced
each other.

Defined results: null text has no ids and decodes to the empty text; long texts are encoded whole; repeated rows get
equal answers; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import kept, small_batches

#: Stands for the end of a word inside the automaton; byte symbols are printable, so it can't occur otherwise.
END = "\n"
NEVER = 1 << 60
WORDS_KEPT = 300_000
#: White space as the library's patterns see it.
BLANKS = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies: Latin-1's printable ones stand for themselves, the others follow from 256 on."""
    out, more = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(256 + more))
            more += 1
    return out


class WordCodec:
    """Exact ids of single words (byte symbols, then END) from a vocabulary and its merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        inner = lambda s: s[: -len(suffix)] + END if suffix and s.endswith(suffix) else s
        self.ids = {inner(s): i for s, i in vocab.items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str, int]] = {}
        for r, (a, b) in enumerate(merges):
            a, b = inner(a), inner(b)
            self.rank.setdefault((a, b), r)
            self.parts.setdefault(a + b, (a, b, r))
        self.automaton = ahocorasick.Automaton()
        for s in self.ids:
            if s in self.parts or len(s.removesuffix(END)) == 1:
                self.automaton.add_word(s, (len(s), self.ids[s]))
        self.automaton.make_automaton()
        self.token = {i: s for s, i in self.ids.items()}
        self.fits: dict[int, bool] = {}
        self.left: dict[str, list[tuple[str, int]]] = {}
        self.right: dict[str, list[tuple[str, int]]] = {}

    def border(self, token: str, side: int) -> list[tuple[str, int]]:
        """The pieces at one side of a token, outermost unit first, each with the rank at which the next absorbs it."""
        known = self.right if side else self.left
        if token not in known:
            pieces, absorbed, now = [], NEVER, token
            while True:
                pieces.append((now, absorbed))
                if now not in self.parts:
                    break
                *two, absorbed = self.parts[now]
                now = two[side]
            known[token] = pieces[::-1]
        return known[token]

    def may_follow(self, before: str, token: str) -> bool:
        """Do the two stay two when their joined text is encoded? Of equal ranks the merge further left comes first."""
        a, b, i, j = self.border(before, 1), self.border(token, 0), 0, 0
        while True:
            (x, gone_x), (y, gone_y) = a[i], b[j]
            r = self.rank.get((x, y), NEVER)
            if r < gone_x and r <= gone_y and r < NEVER:
                return False
            if gone_x >= NEVER and gone_y >= NEVER:
                return True
            if gone_x <= gone_y:
                i += 1
            else:
                j += 1

    def encode(self, word: str) -> list[int]:
        fits, last, size = self.fits, [-1] * (len(word) + 1), [0] * (len(word) + 1)
        for end, (n, token) in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            if n < end:
                before = last[end - n]
                if before < 0:
                    continue
                key = before << 20 | token
                fit = fits.get(key)
                if fit is None:
                    fit = fits[key] = self.may_follow(self.token[before], self.token[token])
                if not fit:
                    continue
            last[end], size[end] = token, n
        out, at = [], len(word)
        while at:
            if last[at] < 0:
                raise ValueError("the vocabulary does not cover this word")
            out.append(last[at])
            at -= size[at]
        return out[::-1]


class TextCodec:
    """Whole texts: special tokens, normal form, white space, lower case, cuts, then words; and back."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.words = WordCodec(model["vocab"], [tuple(m) for m in model["merges"]], self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.cut = regex.compile(next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"])
        self.blanks = regex.compile(BLANKS)
        self.odd = regex.compile(r"[\x1c-\x1f]")
        self.symbols = byte_symbols()
        self.surface = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.known: dict[str, tuple[bytes, str]] = {}
        self.chunks: dict[str, tuple[bytes, str]] = {}

    def word(self, piece: str) -> tuple[bytes, str]:
        pair = self.known.get(piece)
        if pair is None:
            symbols = piece if piece.isascii() and piece.isprintable() else "".join([self.symbols[b] for b in piece.encode("utf-8", "surrogatepass")])
            ids = array("I", self.words.encode(symbols + END)).tobytes()
            pair = self.known[piece] = ids, self.decode(ids)
        return pair

    def chunk(self, text: str) -> tuple[bytes, str]:
        """Ids and decoded form of a run without white space. Lower case goes letter by letter, so a final sigma is like any other."""
        low = text.lower()
        if not text.isascii():
            low = unicodedata.normalize("NFC", text)
            low = low.lower() if "Σ" not in low else "".join(c.lower() for c in low)
        if low.isalpha() and low.isascii():
            return self.word(low)
        pairs = [self.word(w) for w in self.cut.findall(low)]
        return b"".join([i for i, _ in pairs]), " ".join([d for _, d in pairs])

    def decode(self, ids: bytes) -> str:
        """Tokens joined by blanks: the library's decoding where a tokenizer states no decoder."""
        return " ".join(map(self.surface.__getitem__, array("I", ids)))

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian uint32, and their decoded text."""
        if len(self.words.fits) > 4 * WORDS_KEPT:
            self.words.fits = {}
        if len(self.known) > WORDS_KEPT:
            self.known = {}
        if len(self.chunks) > WORDS_KEPT:
            self.chunks = {}
        ids, said = [], []
        get = self.chunks.get
        for k, part in enumerate(self.split.split(text) if any(s in text for s in self.special) else [text]):
            if k % 2:
                ids.append(array("I", [self.special[part]]).tobytes())
                said.append(part)
                continue
            # str.split also takes four control characters for white space
            for run in filter(None, self.blanks.split(part)) if self.odd.search(part) else part.split():
                pair = get(run)
                if pair is None:
                    pair = self.chunks[run] = self.chunk(run)
                if pair[0]:
                    ids.append(pair[0])
                    said.append(pair[1])
        return b"".join(ids), " ".join(said)


ROWS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; with keep_ids also ids (binary) and decoded (text)."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = kept(f"bpe {path}", lambda: TextCodec(path))
        for x in batches:
            pairs = [codec.encode(t) if t is not None else (b"", "") for t in x["text"]]
            out = pd.DataFrame(
                {
                    "doc_id": x["doc_id"].astype("Int64"),
                    "n_tokens": [len(i) // 4 for i, _ in pairs],
                    "ids_sha256": [hashlib.sha256(i).hexdigest() for i, _ in pairs],
                    "decoded_sha256": [hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest() for _, d in pairs],
                }
            )
            yield out.assign(ids=[i for i, _ in pairs], decoded=[d for _, d in pairs]) if keep_ids else out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(scan, ROWS + ", ids binary, decoded string" * keep_ids)

"""Chat formatting with typed content parts.

A turn's content is an array of parts: text, image, audio, document. A visitor flattens them in order: text is escaped, any other part becomes a placeholder `<|type_k|>`, k being its
number among its turn's attachments, and is recorded with its reference and the number of tokens that the placeholder expands into.

Template: `<|im_start|>` role newline content `<|im_end|>` newline for each turn. Escaping puts one more backslash between `<` and `|` wherever those two stand in a text with only
backslashes between them, so no text can hold a control string, and taking one away gives the text back. In roles a backslash and a newline are written as two characters.

Output: blocks of whole turns of one conversation, of BLOCK characters or one turn, with the loss mask (spans of code points over the assistant's text
parts, nothing else) and the attachments. Turns are ordered by range partitions and cut into blocks there, so a conversation that holds a third of all
rows is formatted by many tasks, and only its blocks, read in order, one at a time, meet in the task that hashes it.

Defined results: null text or content is empty; a null role is empty; turns go by turn (null first), then role, then content; equal rows are turns of their own; a null conv_id is a conversation; a
part of another type, or with a null type, is text; texts of any length are formatted whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.offsets import running
from gaugeworks.llm.common import small_batches, stored

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
BLOCK = 1 << 16
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PIECE = "struct<content:string,text:boolean,type:string,ref:string,tokens:long>"
BLOCKS = "conv_id long, part int, block int, turns int, formatted string, mask array<struct<start:int,end:int>>, attachments array<struct<turn:int,k:int,type:string,ref:string,tokens:long>>"


class Flattener:
    """Visits a part and gives its content in the template, its type, reference and token count. One method for each type; another model's counts go in a subclass."""

    patch, image_tokens = 28, 256
    audio_tokens_a_second = 25
    page_tokens = 1024
    types = ("image", "audio", "document")

    def text(self, part: Column, k: Column) -> Column:
        return self.piece(escaped(F.coalesce(part["text"], F.lit(""))), None, part, F.lit(0))

    def image(self, part: Column, k: Column) -> Column:
        """One token for each patch; images of unknown size count as image_tokens."""
        patches = F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)
        return self.piece(placeholder("image", k), "image", part, F.coalesce(patches, F.lit(self.image_tokens)))

    def audio(self, part: Column, k: Column) -> Column:
        return self.piece(placeholder("audio", k), "audio", part, F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_tokens_a_second))

    def document(self, part: Column, k: Column) -> Column:
        return self.piece(placeholder("document", k), "document", part, F.coalesce(part["pages"], F.lit(1)) * self.page_tokens)

    def piece(self, content: Column, kind: str | None, part: Column, tokens: Column) -> Column:
        ref = part["ref"] if kind else F.lit(None).cast("string")
        return F.struct(content.alias("content"), F.lit(kind is None).alias("text"), F.lit(kind).cast("string").alias("type"), ref.alias("ref"), tokens.cast("long").alias("tokens"))

    def visit(self, part: Column, k: Column) -> Column:
        out = self.text(part, k)
        for kind in self.types:
            out = F.when(part["type"] == kind, getattr(self, kind)(part, k)).otherwise(out)
        return out

    def flatten(self, parts: Column) -> Column:
        """array<PIECE> of parts in their order; attachments are numbered from 1."""
        attached = lambda p: F.coalesce(p["type"].isin(*self.types), F.lit(False)).cast("int")
        return running(parts, F.lit(0), lambda k, p: k + attached(p), lambda k, p: self.visit(p, k + 1), f"array<{PIECE}>")


def placeholder(kind: str, k: Column) -> Column:
    return F.concat(F.lit(f"<|{kind}_"), k.cast("string"), F.lit("|>"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def plain_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def text_parts(text: Column) -> Column:
    """A plain text as the content of a turn: one part."""
    none = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), none("string").alias("ref"), none("int").alias("width"), none("int").alias("height"), none("double").alias("seconds"), none("int").alias("pages")))


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns in order as blocks."""
    part = TaskContext.get().partitionId()
    names = [c.split(" ")[0] for c in re.sub(r"<.*?>>?", "", BLOCKS).split(", ")]
    conv, number, size, texts, mask, attachments = (), 0, 0, [], [], []

    def done() -> tuple:
        return (conv[0], part, number, len(texts), "".join(texts), mask, attachments)

    for x in batches:
        rows = []
        for c, role, pieces in zip(x["conv_id"], x["role"], x["pieces"], strict=True):
            c = (None if pd.isna(c) else int(c),)
            head = f"{START}{role}\n"
            whole = head + "".join(p["content"] for p in pieces) + END + "\n"
            if texts and (c != conv or size + len(whole) > BLOCK):
                rows.append(done())
                number, size, texts, mask, attachments = number + 1, 0, [], [], []
            conv = c
            at, k = size + len(head), 0
            for p in pieces:
                if not p["text"]:
                    k += 1
                    attachments.append({"turn": len(texts), "k": k, "type": p["type"], "ref": p["ref"], "tokens": p["tokens"]})
                elif role == LEARNED and p["content"]:
                    mask.append({"start": at, "end": at + len(p["content"])})
                at += len(p["content"])
            texts.append(whole)
            size += len(whole)
        if rows:
            yield _frame(rows, names)
    if texts:
        yield _frame([done()], names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    out["conv_id"] = pd.array([r[0] for r in rows], dtype="Int64")
    return out


def format_conversations(turns: DataFrame, flattener: Flattener | None = None) -> DataFrame:
    """Writes conversations as blocks and returns them. turns: conv_id, turn, role, and parts (array of PART) or text."""
    small_batches(turns.sparkSession)
    parts = F.col("parts").cast(f"array<{PART}>") if "parts" in turns.columns else text_parts(F.col("text"))
    role = F.regexp_replace(F.replace(F.coalesce(F.col("role").cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\")), "\n", r"\\n")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), (flattener or Flattener()).flatten(F.coalesce(parts, F.array().cast(f"array<{PART}>"))).alias("pieces"))
    rows = rows.withColumn("content", F.xxhash64("pieces"))
    # Ranges are of (conversation, turn, ...), so those of a long conversation are many; their order in full is by content.
    dealt = rows.repartitionByRange(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "content")
    ordered = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.transform("pieces", lambda p: p["content"]))
    return stored(ordered.select("conv_id", "role", "pieces").mapInPandas(_blocks, BLOCKS), "chat-blocks")


TURN = re.compile(re.escape(START) + r"([^\n]*)\n")


def parsed(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, content) of a block's turns; contents are still escaped."""
    at = 0
    while at < len(formatted):
        head = TURN.match(formatted, at)
        end = formatted.find(END + "\n", head.end()) if head else -1
        if end < 0:
            raise ValueError(f"no turn at character {at}")
        yield plain_role(head[1]), formatted[head.end() : end]
        at = end + len(END) + 1


def read_turns(blocks: DataFrame) -> DataFrame:
    """The turns back from blocks: conv_id, part, block, at (its number in the block), role, text (its text parts; placeholders stay)."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = [(c, p, b, k, role, unescaped(text)) for c, p, b, f in zip(x["conv_id"].astype("Int64"), x["part"], x["block"], x["formatted"], strict=True) for k, (role, text) in enumerate(parsed(f))]
            yield _frame(rows, ["conv_id", "part", "block", "at", "role", "text"])

    return blocks.select("conv_id", "part", "block", "formatted").mapInPandas(scan, "conv_id long, part int, block int, at int, role string, text string")


def digests(blocks: DataFrame) -> DataFrame:
    """Per conversation, read back from its blocks: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, attachment_tokens."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "attachment_tokens"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, turns, loss, n = (), None, None, [0] * 5

        def done() -> tuple:
            return (conv[0], n[0], turns.hexdigest(), n[1], loss.hexdigest(), *n[2:])

        for x in batches:
            rows = []
            for c, formatted, mask, attached in zip(x["conv_id"], x["formatted"], x["mask"], x["attachments"], strict=True):
                c = (None if pd.isna(c) else int(c),)
                if c != conv:
                    if conv:
                        rows.append(done())
                    conv, turns, loss, n = c, hashlib.sha256(), hashlib.sha256(), [0] * 5
                for role, text in parsed(formatted):
                    turns.update(f"{role}\n{unescaped(text)}\n".encode("utf-8", "surrogatepass"))
                    n[0] += 1
                for m in mask:
                    text = unescaped(formatted[m["start"] : m["end"]])
                    loss.update(text.encode("utf-8", "surrogatepass"))
                    n[1] += len(text)
                n[2] += len(formatted)
                n[3] += len(attached)
                n[4] += sum(a["tokens"] for a in attached)
            if rows:
                yield _frame(rows, names)
        if conv:
            yield _frame([done()], names)

    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return ordered.select("conv_id", "formatted", "mask", "attachments").mapInPandas(scan, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, attachment_tokens long")

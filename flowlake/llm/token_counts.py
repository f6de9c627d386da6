"""Token counts of the sections of a document, from one encoding of the whole document.

Encoding sections one by one gives other tokens than encoding the document, so the whole
text is encoded once. Each token covers a span of characters; the spans are joined with
the section intervals, both being sorted, by binary search. A token inside one section
counts there; one that crosses a border is allocated by an explicit rule:

* ``start``: to the section of its first character;
* ``majority``: to the section that holds most of its characters, the first such on ties;
* ``share``: to each section by its share of the token's characters.

A token that is a part of one character (bytes of an emoji, say) starts at that character;
its length in characters is that character's for all parts that begin in it.

Sections are intervals that tile the text: from each match of a pattern's end to the next
(lines by default). Named fields are sections too, if they are joined with line feeds.

Defined cases: a null or empty text has one empty section without tokens; repeated rows
give their rows again; other columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from flowlake.llm import worker
from flowlake.llm.bpe import PATTERN, parts

RULES = ("start", "majority", "share")
COUNTS = "doc_id bigint, section int, start_char bigint, end_char bigint, n_tokens double, n_crossing bigint"


class Encoder:
    """A vocabulary of ranks, and the length in bytes of each token."""

    def __init__(self, content: str):
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        for token, rank in ranks.items():
            self.bytes_of[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character, and the one after the last, of each token."""
        ids = [np.array(self.encoding.encode_ordinary(part), np.int64) for part in parts(text)]
        ends = np.cumsum(self.bytes_of[np.concatenate(ids)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if text.isascii():
            return starts, ends
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        return char[starts], char[ends - 1] + 1


def encoder(content: str) -> Encoder:
    return worker.kept("token counts", Encoder, content)


def intervals(text: str, border: re.Pattern) -> np.ndarray:
    """Section borders, from 0 to the text's length."""
    inner = [m.end() for m in border.finditer(text) if 0 < m.end() < len(text)]
    return np.array([0, *inner, len(text)], np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and border-crossing tokens of each section."""
    sections = len(borders) - 1
    first = np.searchsorted(borders, starts, "right") - 1
    last = np.searchsorted(borders, ends, "left") - 1
    inside = first == last
    tokens = np.bincount(first[inside], minlength=sections).astype(float)
    crossing = np.zeros(sections, np.int64)
    for i in np.flatnonzero(~inside):
        touched = np.arange(first[i], last[i] + 1)
        length = np.minimum(ends[i], borders[touched + 1]) - np.maximum(starts[i], borders[touched])
        crossing[touched] += 1
        if rule == "share":
            tokens[touched] += length / (ends[i] - starts[i])
        else:
            tokens[touched[0 if rule == "start" else int(np.argmax(length))]] += 1
    return tokens, crossing


def section_counts(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text", border: str = r"\n", rule: str = "majority") -> DataFrame:
    """One row per section of each document: its span and its tokens."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    with open(ranks_path, encoding="ascii") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pattern = encoder(sent.value), re.compile(border)
        for batch in batches:
            ids, columns = batch.column(0), []
            for value in batch.column(1):
                whole = value.as_py()
                borders = intervals(whole, pattern)
                tokens, crossing = allocate(*known.spans(whole), borders, rule) if whole else (np.zeros(1), np.zeros(1, np.int64))
                columns.append((borders[:-1], borders[1:], tokens, crossing))
            if not columns:
                continue
            sizes = [len(c[0]) for c in columns]
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            section = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            joined = [pa.array(np.concatenate(part)) for part in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), pa.array(section), *joined], names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"]
            )

    return rows.mapInArrow(count, COUNTS)

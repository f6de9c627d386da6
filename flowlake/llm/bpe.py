"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

A byte-pair encoding has a helpful property: the encoding of a prefix ends in one
token that nothing else decides. That token is the only one that (a) is a suffix of
the prefix and (b) could stand behind the last token of the shorter prefix without
any merge across the border between the two. So one pass over a piece of text keeps
a single token per prefix, and walking back from the end gives the ids:

* the suffix matches come from an automaton over all tokens of the vocabulary;
* the border test walks down the merge trees of the two neighbours.

Texts are first cut into pieces by the vocabulary's own pattern, so the work per
piece is small and equal pieces are encoded once per worker.

Defined cases: a null text is the empty text, which has no tokens. Special tokens
written out in a text become their ids, as the public library does by default.
Texts of any length are read in parts that end where a space follows a non-space; no
piece crosses such a place. Columns named like the results are replaced.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, DataType, StringType

from flowlake.llm import worker

#: The published splitting pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PART = 1 << 20
WHOLE = float("inf")
#: Bytes of a remembered border test.
BORDER = worker.ENTRY + 40


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(256):
        letters.append(chr(byte) if byte in plain else chr(spare))
        spare += byte not in plain
    return letters


def read_tokens(spec: dict) -> tuple[dict[int, str], dict[str, int]]:
    """Tokens as strings with one character per byte, and the ids of special tokens."""
    back = {letter: chr(byte) for byte, letter in enumerate(byte_letters())}
    tokens = {i: "".join(map(back.__getitem__, name)) for name, i in spec["model"]["vocab"].items()}
    return tokens, {t["content"]: t["id"] for t in spec["added_tokens"]}


class Decoder:
    """The bytes of each id; special tokens stand for their own text."""

    def __init__(self, content: str):
        tokens, special = read_tokens(json.loads(content))
        self.bytes_of = [tokens.get(i, "").encode("latin-1") for i in range(max([*tokens, *special.values()], default=-1) + 1)]
        for text, i in special.items():
            self.bytes_of[i] = text.encode()

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; ids outside the vocabulary stand for nothing, and
        bytes that are no text become replacement characters."""
        table, numbers = self.bytes_of, memoryview(ids).cast("I").tolist()
        try:
            raw = b"".join(map(table.__getitem__, numbers))
        except IndexError:
            raw = b"".join(table[i] for i in numbers if i < len(table))
        return raw.decode("utf-8", "replace")


class Vocabulary:
    """Tokens, merge trees and the suffix automaton of one vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids = spec["model"]["vocab"]
        tokens, self.special = read_tokens(spec)
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made, pair = ids[left + right], (ids[left], ids[right])
            self.merge[pair] = rank
            if made not in self.rank:
                self.rank[made], self.halves[made] = rank, pair
        self.matches = ahocorasick.Automaton()
        for i, token in tokens.items():
            self.matches.add_word(token, (i, len(token)))
        self.matches.make_automaton()
        self.borders = worker.Memory(3 * worker.MEMORY_BYTES)
        self.pattern = regex.compile(PATTERN)
        # The pattern library and the vocabulary's own library know different Unicode
        # versions; they agree on everything before this block.
        self.newer = re.compile("[^\x00-ԯ]")
        self.specials = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self.kept = worker.Memory(3 * worker.MEMORY_BYTES)

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay apart when their bytes are encoded together.

        The tokens that ever touch the border are those on the right edge of the one
        merge tree and on the left edge of the other. Each lives from its own merge to
        the merge that takes it up. The border falls if two that live at the same time
        have a merge before either is taken up; at the same rank the one further left
        goes first.
        """
        pair = left << 32 | right
        known = self.borders.get(pair)
        if known is not None:
            return known
        a, b, a_end, b_end, apart = left, right, WHOLE, WHOLE, True
        while True:
            rank = self.merge.get((a, b), WHOLE)
            if rank < a_end and rank <= b_end and rank != WHOLE:
                apart = False
                break
            a_born, b_born = self.rank.get(a, -1), self.rank.get(b, -1)
            if a_born < 0 and b_born < 0:
                break
            if a_born >= b_born:
                a, a_end = self.halves[a][1], a_born
            else:
                b, b_end = self.halves[b][0], b_born
        if self.borders.full:
            self.borders.clear()
        self.borders[pair] = apart
        self.borders.size += BORDER
        return apart

    def encode_piece(self, piece: str) -> bytes:
        """The ids of one piece, packed as little-endian unsigned 32-bit integers."""
        letters = piece.encode().decode("latin-1")
        last: list[tuple[int, int] | None] = [None] * (len(letters) + 1)
        for end, (token, length) in self.matches.iter(letters):
            end += 1
            if last[end] is None:
                before = last[end - length]
                if length == end or before is not None and self.compatible(before[0], token):
                    last[end] = (token, length)
        ids, at = [], len(letters)
        while at:
            token, length = last[at]
            ids.append(token)
            at -= length
        ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids)

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or not self.newer.search(text):
            return self.pattern.findall(text)
        from tokenizers import pre_tokenizers

        cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in cut.pre_tokenize_str(text)]

    def encode_plain(self, text: str) -> bytes:
        pieces = self.pieces(text)
        kept = self.kept
        distinct = set(pieces)
        new = [p for p in distinct if p not in kept]
        if new and kept.full:
            kept.clear()
            new = distinct
        for piece in new:
            kept[piece] = ids = self.encode_piece(piece)
            kept.grow(piece, ids)
        return b"".join(map(kept.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        out = []
        for part in parts(text):
            start = 0
            for found in self.specials.finditer(part):
                out.append(self.encode_plain(part[start:found.start()]))
                out.append(struct.pack("<I", self.special[found[0]]))
                start = found.end()
            out.append(self.encode_plain(part[start:] if start else part))
        return b"".join(out)


def parts(text: str) -> Iterator[str]:
    """A long text in parts that end where a space follows a letter or digit."""
    start, size = 0, len(text)
    border = re.compile(r"(?<=\w)(?= )")
    while size - start > PART:
        found = border.search(text, start + PART)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text


def read_vocabulary(spark: SparkSession, path: str):
    """The file, read once and sent to the workers; its size is that of the vocabulary."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def with_column(rows: DataFrame, source: str, name: str, kind: DataType, make: Callable[[], Callable]) -> DataFrame:
    """``rows`` with a column that ``make()`` gives from a source column."""
    rows = rows.drop(name) if name != source and name in rows.columns else rows
    column, arrow = rows.columns.index(source), pa.string() if kind == StringType() else pa.binary()

    def made():
        function = make()
        return lambda part: [pa.array([function(value.as_py()) for value in part.column(column)], arrow)]

    return worker.with_columns(rows, [(name, kind)], made)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``ids`` (packed little-endian unsigned 32-bit) and ``n_tokens``."""
    content = read_vocabulary(docs.sparkSession, path)

    def make():
        known = worker.kept("bpe", Vocabulary, content.value)
        return lambda value: known.encode(value or "")

    return with_column(docs, text, "ids", BinaryType(), make).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows of ``docs`` with the text of their ids as ``decoded``."""
    content = read_vocabulary(docs.sparkSession, path)

    def make():
        known = worker.kept("bpe", Decoder, content.value)
        return lambda value: known.decode(value or b"")

    return with_column(docs, ids, "decoded", StringType(), make)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without the text, with ``ids``, ``n_tokens`` and the text decoded from the ids, in one go."""
    content = read_vocabulary(docs.sparkSession, path)
    docs = docs.drop(*[c for c in ("ids", "decoded") if c != text])
    column = docs.columns.index(text)

    def make():
        encoder, decoder = worker.kept("bpe", Vocabulary, content.value), worker.kept("bpe", Decoder, content.value)

        def both(part: pa.RecordBatch) -> list[pa.Array]:
            ids = [encoder.encode(value.as_py() or "") for value in part.column(column)]
            return [pa.array(ids, pa.binary()), pa.array([decoder.decode(i) for i in ids], pa.string())]

        return both

    found = worker.with_columns(docs, [("ids", BinaryType()), ("decoded", StringType())], make, drop=(text,))
    return found.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))

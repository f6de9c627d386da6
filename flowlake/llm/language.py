"""Language identification with unigrams over pieces, summed over all segmentations.

Each language has a probability for every piece of one fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces, by the forward
algorithm; a text is scored word by word, and the score is the posterior under equal
priors. The piece probabilities come from expectation-maximisation: the expected count
of a piece over all segmentations of all training words, by forward and backward sums.

Words are runs of letters, lower-cased, read with a mark for the word's start. Runs of up to
``LONGEST`` letters are worked on many at a time, longer ones one by one, with the last sums
carried on, so that every segmentation counts whatever the length. Words count once per
occurrence and are worked out once per worker as long as its memory of words lasts.

Training reads distinct texts, ``rows_per_language`` of each language or all it has, picked by
a hash of the text, so copies neither use up the bound nor break it; the lexicon of their words is counted by Spark and the
expectation step runs on it in parallel. The model (languages x pieces) is bounded by
the vocabulary and by ``MOST_LANGUAGES``.

Defined cases: a text that is null or without a letter is ``und`` with score 0, as is
every text if there are no labelled rows; ties go to the language first in order; extra
columns pass through, those named like the results are replaced; repeated rows are
scored alike.
"""

from __future__ import annotations

import functools
import io
import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window
from pyspark.sql.types import DoubleType, StringType

from flowlake.llm import worker
from flowlake.session import scratch_path

START = "▁"
WORD = re.compile(r"[^\W\d_]+")
LONGEST = 32
LONG_TEXT = 1 << 20
LETTERS_AT_ONCE = 1 << 14
PRIOR = 0.01
MOST_LANGUAGES = 500
#: Chosen texts, 16 bytes each, that are sent to all tasks at most.
BROADCAST_TEXTS = 1_000_000
UNKNOWN = "und"
STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> Counter:
    """Lower-case letter runs of a text and how often they occur."""
    lowered = text.lower()
    if len(lowered) > LONG_TEXT:
        return Counter(found[0] for found in WORD.finditer(lowered))
    return Counter(WORD.findall(lowered))


def public_pieces(path: str) -> list[str]:
    """The lower-case pieces of a public vocabulary of word pieces, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    reader = SentencePieceProcessor(model_file=path)
    ids = range(reader.get_piece_size())
    plain = [reader.id_to_piece(i) for i in ids if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i))]
    return sorted({p for p in plain if p == p.lower() and len(p) <= LONGEST})


def codes(same_length: list[str]) -> np.ndarray:
    joined = "".join(same_length).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, "<u4").reshape(len(same_length), -1).astype(np.uint64)


def by_length(texts: list[str], most: int = 1 << 14) -> Iterator[list[int]]:
    """Positions of equally long texts together, in blocks of bounded size."""
    lengths: dict[int, list[int]] = defaultdict(list)
    for at, text in enumerate(texts):
        lengths[len(text)].append(at)
    for found in lengths.values():
        for start in range(0, len(found), most):
            yield found[start:start + most]


@dataclass
class PieceModel:
    """Pieces by hash, and their probabilities: one column per language.

    Row ``len(hashes)`` is any letter that is no piece; the row after it is everything
    else that is no piece and has no probability.
    """

    languages: list[str]
    hashes: np.ndarray
    chance: np.ndarray
    longest: int

    @classmethod
    def uniform(cls, pieces: list[str], languages: list[str]) -> PieceModel:
        hashes = np.zeros(len(pieces), np.uint64)
        for block in by_length(pieces):
            hashed = np.zeros(len(block), np.uint64)
            for column in codes([pieces[i] for i in block]).T:
                hashed = (hashed + column) * STEP
            hashes[block] = hashed
        hashes.sort()
        chance = np.full((len(pieces) + 2, len(languages)), 1.0 / (len(pieces) + 1))
        chance[-1] = 0.0
        return cls(languages, hashes, chance, max(map(len, pieces), default=1))

    def lattice(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, row of the piece) for every span that may be a piece."""
        n, known = letters.shape[1], len(self.hashes)
        for start in range(n):
            hashed = np.zeros(len(letters), np.uint64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                hashed = (hashed + letters[:, end - 1]) * STEP
                at = np.searchsorted(self.hashes, hashed)
                at[at == known] = 0
                found = self.hashes[at] == hashed if known else np.zeros(len(letters), bool)
                rows = np.where(found, at, known if end == start + 1 else known + 1)
                if found.any() or end == start + 1:
                    yield start, end, rows

    @functools.cached_property
    def logs(self) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(self.chance)

    def rows_of_spans(self, letters: np.ndarray) -> np.ndarray:
        """The row of the piece of each length - 1 (down) and start (across) of one text; that without probability where none is."""
        n, known = len(letters), len(self.hashes)
        rows, hashed = np.full((self.longest, n), known + 1), np.zeros(n, np.uint64)
        for length in range(1, min(n, self.longest) + 1):
            hashed = (hashed[:n - length + 1] + letters[length - 1:]) * STEP
            at = np.searchsorted(self.hashes, hashed)
            at[at == known] = 0
            found = self.hashes[at] == hashed if known else np.zeros(len(hashed), bool)
            rows[length - 1, :n - length + 1] = np.where(found, at, known if length == 1 else known + 1)
        return rows

    def forward(self, text: str, logs: np.ndarray) -> Iterator[np.ndarray]:
        """Log-probability of all segmentations of each beginning of a long text, from its first letter on.

        Only the last ``longest`` sums are kept, in logarithms, so length neither costs memory nor underflows."""
        letters = codes([text])[0]
        recent = np.zeros((1, logs.shape[1]))
        for first in range(0, len(letters), LETTERS_AT_ONCE):
            begin, behind = max(0, first - self.longest + 1), min(len(letters), first + LETTERS_AT_ONCE)
            rows = self.rows_of_spans(letters[begin:behind])
            for end in range(first + 1, behind + 1):
                lengths = np.arange(1, len(recent) + 1)
                ways = recent + logs[rows[lengths - 1, end - lengths - begin]]
                value = np.logaddexp.reduce(ways, axis=0)
                recent = np.concatenate([value[None], recent[:self.longest - 1]])
                yield value

    def expected_in_long(self, text: str, weight: float, language: int) -> np.ndarray:
        """Expected uses of the pieces in one long text, some letters at a time from its end."""
        logs, letters, n = self.logs[:, language], codes([text])[0], len(text)
        forward = np.zeros(n + 1)
        forward[1:] = np.fromiter((v[0] for v in self.forward(text, logs[:, None])), float, n)
        total, backward = np.zeros(len(logs)), np.zeros(1)  # backward sums from the present letter on
        for behind in range(n, 0, -LETTERS_AT_ONCE):
            first = max(0, behind - LETTERS_AT_ONCE)
            rows = self.rows_of_spans(letters[first:min(n, behind + self.longest - 1)])
            for start in range(behind - 1, first - 1, -1):
                here = rows[:len(backward), start - first]
                ways = logs[here] + backward
                np.add.at(total, here, weight * np.exp(forward[start] + ways - forward[n]))
                backward = np.concatenate([[np.logaddexp.reduce(ways)], backward[:self.longest - 1]])
        return total

    def log_chances(self, texts: list[str]) -> np.ndarray:
        """Log-probability of each text in each language, over all segmentations."""
        out = np.zeros((len(texts), len(self.languages)))
        most = max(64, (1 << 21) // (LONGEST * max(1, len(self.languages))))
        for block in by_length(texts, most):
            if len(texts[block[0]]) > LONGEST:
                for i in block:
                    out[i] = deque(self.forward(texts[i], self.logs), 1)[0]
                continue
            letters = codes([texts[i] for i in block])
            sums = np.zeros((letters.shape[1] + 1, len(block), len(self.languages)))
            sums[0] = 1.0
            for start, end, rows in self.lattice(letters):
                sums[end] += sums[start] * self.chance[rows]
            out[block] = np.log(sums[-1])
        return out

    def expected(self, texts: list[str], weights: np.ndarray, language: int) -> np.ndarray:
        """Expected number of uses of each piece over all segmentations of the texts."""
        chance, total = self.chance[:, language], np.zeros(len(self.chance))
        for block in by_length(texts):
            if len(texts[block[0]]) > LONGEST:
                for i in block:
                    total += self.expected_in_long(texts[i], weights[i], language)
                continue
            letters = codes([texts[i] for i in block])
            n = letters.shape[1]
            spans = list(self.lattice(letters))
            forward, backward = np.zeros((n + 1, len(block))), np.zeros((n + 1, len(block)))
            forward[0], backward[n] = 1.0, 1.0
            for start, end, rows in spans:
                forward[end] += forward[start] * chance[rows]
            for start, end, rows in reversed(spans):
                backward[start] += backward[end] * chance[rows]
            share = weights[block] / forward[n]
            for start, end, rows in spans:
                total += np.bincount(rows, forward[start] * chance[rows] * backward[end] * share, len(total))
        return total

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, languages=np.array(self.languages, dtype=str), hashes=self.hashes, chance=self.chance, longest=self.longest)
        return out.getvalue()

    @classmethod
    def load(cls, content: bytes) -> PieceModel:
        saved = np.load(io.BytesIO(content))
        return cls(saved["languages"].tolist(), saved["hashes"], saved["chance"], int(saved["longest"]))


class WordScores(worker.Memory):
    """Log-probabilities of words, worked out when first met; forgets all when full."""

    def __init__(self, content: bytes):
        super().__init__()
        self.model = PieceModel.load(content)
        self.values = np.zeros((0, len(self.model.languages)))

    def learn(self, words: set[str]) -> None:
        new = sorted(w for w in words if w not in self)
        if new and self.full:
            self.clear()
            self.values, new = self.values[:0], sorted(words)
        if not new:
            return
        found = self.model.log_chances([START + w for w in new])
        for at, word in enumerate(new, len(self)):
            self[word] = at
            self.grow(word, found[0])
        self.values = np.concatenate([self.values, found])

    def score(self, words: Counter) -> np.ndarray:
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.fromiter(words.values(), np.float64, len(words)) @ self.values[at]


def distinct_texts(rows: DataFrame, counts: dict[str, int], bound: int) -> DataFrame:
    """(lang, text) of each language's ``counts`` distinct texts, or of ``bound`` of them by hash. Copies count once."""
    spark = rows.sparkSession
    rows = rows.withColumn("text_no", F.xxhash64("text"))
    if any(n > bound for n in counts.values()):
        # Somewhat more than the bound by share; of these few, exactly the bound by rank.
        some = bound + 8 * bound**0.5 + 20
        share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, some / n))])
        few = rows.filter(F.pmod("text_no", F.lit(1_000_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000_000)
        rank = F.row_number().over(Window.partitionBy("lang").orderBy("text_no"))
        path = scratch_path(spark, "texts")
        few.select("lang", "text_no").distinct().withColumn("rank", rank).filter(F.col("rank") <= bound).drop("rank").write.parquet(path)
        chosen = spark.read.schema("lang string, text_no bigint").parquet(path)
        chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_TEXTS else chosen
        rows = rows.join(chosen, ["lang", "text_no"], "left_semi")
    return rows.groupBy("lang", "text_no").agg(F.first("text").alias("text")).select("lang", "text")


def fit(labelled: DataFrame, text: str, label: str, pieces_path: str, rows_per_language: int = 5000, rounds: int = 3) -> PieceModel:
    """Piece probabilities per language by ``rounds`` of expectation-maximisation."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{label}`").cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null")
    texts = rows.select("lang", F.xxhash64("text").alias("text_no")).distinct()
    counts = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(counts)
    model = PieceModel.uniform(public_pieces(pieces_path), languages)
    if not languages:
        return model

    picked = distinct_texts(rows, counts, rows_per_language)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for words, lang in zip(batch["text"], batch["lang"]):
                found[lang].update(words_of(words))
            rows = [(lang, word, n) for lang, words in found.items() for word, n in words.items()]
            yield pd.DataFrame(rows, columns=["lang", "word", "n"])

    path = scratch_path(spark, "lexicon")
    lexicon = picked.mapInPandas(count, "lang string, word string, n bigint")
    lexicon.groupBy("lang", "word").agg(F.sum("n").alias("n")).write.parquet(path)
    lexicon = spark.read.schema("lang string, word string, n bigint").parquet(path)

    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model.dump())

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            current = worker.kept("language", PieceModel.load, sent.value)
            for batch in batches:
                for lang, part in batch.groupby("lang"):
                    marked = [START + word for word in part["word"]]
                    got = current.expected(marked, part["n"].to_numpy(float), current.languages.index(lang))
                    at = np.flatnonzero(got)
                    yield pd.DataFrame({"lang": lang, "piece": at, "uses": got[at]})

        uses = lexicon.mapInPandas(expect, "lang string, piece int, uses double")
        total = np.full_like(model.chance, PRIOR)
        total[-1] = 0.0
        # At most languages x pieces rows.
        for row in uses.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            total[row["piece"], languages.index(row["lang"])] += row["uses"]
        model = PieceModel(languages, model.hashes, total / total.sum(axis=0), model.longest)
    return model


def posterior(scores: np.ndarray) -> tuple[int, float]:
    best = int(np.argmax(scores))
    return best, float(1.0 / np.exp(scores - scores[best]).sum())


def identify(docs: DataFrame, model: PieceModel, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The rows of ``docs`` with the language and its posterior probability, in columns of these names."""
    sent = docs.sparkSession.sparkContext.broadcast(model.dump())
    docs = docs.drop(*[n for n in names if n in docs.columns and n != text])
    if text in names:
        raise ValueError(f"{text} cannot be replaced")
    column = docs.columns.index(text)
    # Letters as Unicode has them: numbers that only look like words to the word pattern do not count.
    docs = docs.withColumn("__letter", F.coalesce(F.col(f"`{text}`").cast("string").rlike(r"\p{L}"), F.lit(False)))

    def make():
        known = worker.kept("language", WordScores, sent.value)

        def predict(part: pa.RecordBatch) -> list[pa.Array]:
            texts, letter = part.column(column), part.column(part.num_columns - 1)
            counted = [words_of(str(t.as_py())) if has.as_py() else Counter() for t, has in zip(texts, letter)]
            known.learn(set().union(*counted))
            out = [(UNKNOWN, 0.0)] * len(counted)
            for i, words in enumerate(counted):
                if words and known.model.languages:
                    best, score = posterior(known.score(words))
                    out[i] = known.model.languages[best], score
            return [pa.array([lang for lang, _ in out], pa.string()), pa.array([score for _, score in out], pa.float64())]

        return predict

    return worker.with_columns(docs, list(zip(names, (StringType(), DoubleType()))), make, drop=("__letter",))

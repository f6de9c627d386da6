"""Language-model scoring by deleted interpolation of word n-grams.

    P(w | v) = a_b c(v w) / c(v)  +  u_b c(w) / N  +  z_b / (V + 1)

The weights (a, u, z) belong to the bucket b of the context's frequency c(v), by powers
of two. They are learned by expectation-maximisation on documents that are held out of
the counting: their own counts are deleted from the totals. The final counts hold all
training documents. A text starts after, and ends with, an end token. For a context that
was never seen only u and z count.

How the counts meet the texts without a table of n-grams in any one place:

1. Each task numbers the words of a *block* of documents and stores the block: word
   hashes and the texts as numbers.
2. A block asks for the counts of its distinct uni- and bigrams, and brings its own. The
   requests are dealt by ranges of the n-gram hash, so a range gets at most one entry per
   block and n-gram, however frequent the n-gram is. The range adds up and answers with
   the totals in the order of the request.
3. A block meets its answers and scores its documents.

The held-out documents are in blocks of their own, so learning the weights reads only
those. What reaches the driver is N, V and a table of cells (bucket and rounded
probabilities), whose size depends on the logarithm of the corpus only.

N-grams are told apart by 56 bits of a hash. The number of ranges is that of the shuffle
partitions, so it follows the cluster's setting for the data's size.

Defined cases: a null text is empty and has the end token only; without any training
text all tokens are unknown and have probability 1 / (0 + 1); repeated rows are scored
alike, each as one row; a null id is never held out, and trains if ``train`` says so.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from flowlake.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from flowlake.session import scratch_path

BITS = 56
#: Characters of text in one block; what a task holds at once follows it.
BLOCK = 8_000_000
#: Cells per doubling of a probability, in which held-out tokens are pooled.
FINE = 4
ROUNDS = 60
#: Held-out tokens that the weights of all buckets together count for in each.
PRIOR_TOKENS = 5.0
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: No word has a space.
END = xxhash.xxh3_64_intdigest(b" end")
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

BLOCKS = "block bigint, dev boolean, doc_ids array<bigint>, train array<boolean>, lengths binary, words binary, tokens binary, train_tokens bigint"
REQUESTS = "block bigint, dev boolean, range int, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWERS = "block bigint, dev boolean, range int, words binary, pairs binary, dev_words binary, dev_pairs binary, distinct bigint"
SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def block_row(block: int, dev: bool, ids: list, train: list, texts: list) -> dict:
    """The stored form of some documents: token 0 is the end."""
    number: defaultdict[bytes, int] = defaultdict(count(1).__next__)
    tokens, lengths = [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
        found = np.zeros(len(words) + 1, np.int32)
        found[:-1] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        tokens.append(found)
        lengths.append(len(found))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    return {
        "block": block, "dev": dev, "doc_ids": ids, "train": train,
        "lengths": pack(np.array(lengths, np.int64))[0].tobytes(),
        "words": np.concatenate([[np.uint64(END)], hashes]).astype(np.uint64).tobytes(),
        "tokens": pack(np.concatenate(tokens))[0].tobytes(),
        "train_tokens": int(sum(n for n, t in zip(lengths, train) if t)),
    }


@dataclass
class Grams:
    """The distinct words and pairs of a block in the order of their keys, and where each token's are."""

    lengths: np.ndarray
    word_keys: np.ndarray
    pair_keys: np.ndarray
    word_at: np.ndarray
    context_at: np.ndarray
    pair_at: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Grams:
        lengths, tokens = unpack(row["lengths"]), unpack(row["tokens"]).astype(np.int32)
        hashes = np.frombuffer(row["words"], np.uint64)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[0] = 0
        before[np.cumsum(lengths)[:-1]] = 0
        word_keys, place = np.unique(hashes >> np.uint64(64 - BITS), return_inverse=True)
        mixed = (hashes[before] * A + hashes[tokens]) * B
        mixed ^= mixed >> np.uint64(31)
        mixed *= A
        mixed >>= np.uint64(64 - BITS)
        pair_keys, pair_at = np.unique(mixed, return_inverse=True)
        del mixed
        place, pair_at = place.astype(np.int32), pair_at.astype(np.int32)
        return cls(lengths, word_keys.astype(np.int64), pair_keys.astype(np.int64), place[tokens], place[before], pair_at)


def cut(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of keys starts, and the end."""
    bounds = [((1 << BITS) * r) // ranges for r in range(ranges + 1)]
    return np.searchsorted(keys, np.array(bounds, np.int64))


def requests(row: dict, ranges: int) -> Iterator[dict]:
    grams = Grams.of(row)
    counted = np.repeat(np.array(row["train"], bool), grams.lengths)
    sides = []
    for keys, at in ((grams.word_keys, grams.word_at), (grams.pair_keys, grams.pair_at)):
        sides.append((keys, np.bincount(at[counted], minlength=len(keys)), cut(keys, ranges)))
    (words, word_counts, w), (pairs, pair_counts, p) = sides
    for r in range(ranges):
        if w[r] < w[r + 1] or p[r] < p[r + 1]:
            yield {
                "block": row["block"], "dev": row["dev"], "range": r,
                "words": pack_sorted(words[w[r]:w[r + 1]]), "word_counts": pack(word_counts[w[r]:w[r + 1]])[0].tobytes(),
                "pairs": pack_sorted(pairs[p[r]:p[r + 1]]), "pair_counts": pack(pair_counts[p[r]:p[r + 1]])[0].tobytes(),
            }


def add_up(keys: list[bytes], counts: list[bytes], dev: list[bool]) -> tuple[list[bytes], list[bytes | None], int]:
    """Totals for each request in its own order, those of held-out blocks where they ask, and the number of keys that were counted."""
    lists = [unpack_sorted(k) for k in keys]
    sizes = [len(x) for x in lists]
    distinct, at = np.unique(np.concatenate(lists), return_inverse=True)
    numbers = np.concatenate([unpack(c) for c in counts])
    total = np.bincount(at, numbers, len(distinct)).astype(np.int64)
    held = np.bincount(at, numbers * np.repeat(dev, sizes), len(distinct)).astype(np.int64)
    ends = np.cumsum(sizes)
    places = [at[e - s:e] for s, e in zip(sizes, ends)]
    answers = [pack(total[p])[0].tobytes() for p in places]
    return answers, [pack(held[p])[0].tobytes() if d else None for p, d in zip(places, dev)], int((total > 0).sum())


def answer(group: pa.Table) -> pa.Table:
    rows = group.to_pydict()
    words, dev_words, distinct = add_up(rows["words"], rows["word_counts"], rows["dev"])
    pairs, dev_pairs, _ = add_up(rows["pairs"], rows["pair_counts"], rows["dev"])
    first = [distinct] + [0] * (len(words) - 1)
    return pa.table(
        [rows["block"], rows["dev"], rows["range"], words, pairs, dev_words, dev_pairs, first],
        schema=pa.schema([
            ("block", pa.int64()), ("dev", pa.bool_()), ("range", pa.int32()), ("words", pa.binary()), ("pairs", pa.binary()),
            ("dev_words", pa.binary()), ("dev_pairs", pa.binary()), ("distinct", pa.int64()),
        ]),
    )


def joined(answers: pa.Table, column: str) -> np.ndarray:
    return np.concatenate([unpack(c) for c in answers.column(column).to_pylist()])


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + the whole part of the binary logarithm."""
    return np.frexp(context.astype(np.float64))[1]


def estimates(context: np.ndarray, pair: np.ndarray, word: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    return pair / np.maximum(context, 1), word / max(total, 1)


def learn_weights(cells: np.ndarray, floor: float) -> np.ndarray:
    """Weights (pair, word, uniform) per bucket from cells (bucket, tokens, pair and word estimate)."""
    weights = np.full((64, 3), 1 / 3)
    if len(cells):
        bucket, tokens = cells[:, 0].astype(int), cells[:, 1]
        chances = np.column_stack([cells[:, 2], cells[:, 3], np.full(len(cells), floor)])
        pooled = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = chances * pooled
            share *= (tokens / share.sum(axis=1))[:, None]
            pooled = share.sum(axis=0) / tokens.sum()
        pooled = (pooled * tokens.sum() + 1) / (tokens.sum() + 3)
        weights[:] = pooled
        for _ in range(ROUNDS):
            share = chances * weights[bucket]
            share *= (tokens / share.sum(axis=1))[:, None]
            sums = np.tile(pooled * PRIOR_TOKENS, (64, 1))
            np.add.at(sums, bucket, share)
            weights = sums / sums.sum(axis=1, keepdims=True)
    weights[0, 0] = 0.0
    weights[0] /= weights[0].sum()
    return weights


def held_out_cells(spark_blocks: DataFrame, answers: DataFrame, total: int, floor: float) -> np.ndarray:
    """Held-out tokens pooled by bucket and rounded estimates, with their counts deleted."""

    def pool(block: pa.Table, found: pa.Table) -> pa.Table:
        grams = Grams.of(block.to_pylist()[0])
        found = found.sort_by("range")
        words = joined(found, "words") - joined(found, "dev_words")
        pairs = joined(found, "pairs") - joined(found, "dev_pairs")
        context = words[grams.context_at]
        two, one = estimates(context, pairs[grams.pair_at], words[grams.word_at], total)
        bucket = bucket_of(context)
        level = lambda p: np.where(p > 0, np.round(FINE * np.log2(np.maximum(p, 1e-300) / floor)), -9999).astype(np.int64)
        cells, at = np.unique(np.column_stack([bucket, level(two), level(one)]), axis=0, return_inverse=True)
        at = at.reshape(-1)
        sums = [np.bincount(at, w, len(cells)) for w in (np.ones(len(at)), two, one)]
        return pa.table([*cells.T, *sums], names=["bucket", "pair_level", "word_level", "n", "two", "one"])

    pooled = spark_blocks.filter("dev").groupBy("block").cogroup(answers.filter("dev").groupBy("block")).applyInArrow(
        pool, "bucket bigint, pair_level bigint, word_level bigint, n double, two double, one double"
    )
    rows = pooled.groupBy("bucket", "pair_level", "word_level").agg(F.sum("n").alias("n"), F.sum("two").alias("two"), F.sum("one").alias("one"))
    found = rows.orderBy("bucket", "pair_level", "word_level").collect()
    return np.array([(r["bucket"], r["n"], r["two"] / r["n"], r["one"] / r["n"]) for r in found]).reshape(-1, 4)


def store_blocks(docs: DataFrame) -> DataFrame:
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "blocks")
    schema = pa.schema([
        ("block", pa.int64()), ("dev", pa.bool_()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
        ("lengths", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary()), ("train_tokens", pa.int64()),
    ])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), count()
        open_: dict[bool, list] = {False: [], True: []}
        sizes = {False: 0, True: 0}

        def close(dev: bool) -> pa.RecordBatch:
            row = block_row(task << 32 | next(made), dev, *map(list, zip(*open_[dev])))
            open_[dev], sizes[dev] = [], 0
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc, text, train, dev in zip(*(batch.column(i).to_pylist() for i in range(4))):
                open_[dev].append((doc, train, text))
                sizes[dev] += len(text or "") + 16
                if sizes[dev] >= BLOCK:
                    yield close(dev)
        for dev, rows in open_.items():
            if rows:
                yield close(dev)

    docs.select("doc_id", "text", "train", "dev").mapInArrow(make, BLOCKS).write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


def score_documents(docs: DataFrame, doc_id: str, text: str, train: Column, held_out_share: float = 0.05) -> DataFrame:
    """One row per document: tokens, known tokens, unigram and model log10-probability.

    ``train`` says which rows teach the model; of these a share, by a hash of the id, is
    held out for the weights. Rows without an id are counted.
    """
    spark = docs.sparkSession
    identity = F.col(f"`{doc_id}`").cast("bigint")
    rows = docs.select(
        identity.alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"),
    )
    dev = F.pmod(F.xxhash64("doc_id"), F.lit(10_000)) < round(10_000 * held_out_share)
    blocks = store_blocks(rows.withColumn("dev", F.col("train") & F.col("doc_id").isNotNull() & dev))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("block", pa.int64()), ("dev", pa.bool_()), ("range", pa.int32()), ("words", pa.binary()), ("word_counts", pa.binary()),
            ("pairs", pa.binary()), ("pair_counts", pa.binary()),
        ])
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist(list(requests(one, ranges)), schema)

    asked = blocks.mapInArrow(ask, REQUESTS)
    path = scratch_path(spark, "answers")
    asked.groupBy("range").applyInArrow(answer, ANSWERS).write.parquet(path)
    answers = spark.read.schema(ANSWERS).parquet(path)

    sums = blocks.agg(
        F.coalesce(F.sum("train_tokens"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("dev"), F.col("train_tokens"))), F.lit(0)).alias("dev"),
    ).first()
    total, held = int(sums["n"]), int(sums["dev"])
    known = int(answers.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0])
    floor = 1.0 / (known + 1)
    weights = learn_weights(held_out_cells(blocks, answers, total - held, floor), floor)
    if not total:
        weights[:] = 0.0, 0.0, 1.0

    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        grams = Grams.of(row)
        found = found.sort_by("range")
        words, pairs = joined(found, "words"), joined(found, "pairs")
        context, word = words[grams.context_at], words[grams.word_at]
        two, one = estimates(context, pairs[grams.pair_at], word, total)
        bucket = bucket_of(context)
        model = np.log10(weights[bucket, 0] * two + weights[bucket, 1] * one + weights[bucket, 2] * floor)
        del two, one, context, bucket
        base = np.log10((word + 0.5) / (total + 0.5 * (known + 1)))
        starts = np.cumsum(grams.lengths) - grams.lengths
        add = lambda x: np.add.reduceat(x, starts)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "n_tokens": pa.array(grams.lengths),
            "n_known": pa.array(add((word > 0).astype(np.int64))), "base_score": pa.array(add(base)), "score": pa.array(add(model)),

        })

    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORES)
    return scored.withColumn("train_tokens", F.lit(total).cast("bigint"))

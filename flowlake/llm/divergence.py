"""Audit of how the sources of a language differ in their words, on run-length columns.

Every source of a language gives each term of the language's vocabulary a smoothed whole-number
share. Two sources are compared by the sum of the absolute differences over the vocabulary,
and each source's most overused terms are listed against its language.

The counts of a source are a column over the vocabulary. The vocabulary is put in an order
in which terms with equal counts stand together (by their counts, source after source); it is cut into
segments, and a source's column in a segment is stored as runs of equal counts, zeros
included. For a pair of sources the starts of both columns' runs are merged; between two starts
both counts are constant, so the difference is taken once and multiplied by the length.

At scale: words are counted inside tasks into a bounded table of partial counts and merged in two
steps (by source and term, then by term), so a frequent word is no hot key. Documents are read once for words.
The vocabulary is ordered by ranges, never in one task. A comparison job has one segment and two
blocks of ``BLOCK`` sources; segments have at most as many terms as an Arrow batch has rows. What
grows with the square of the sources of a language is the result itself.

Arithmetic is exact: shares by decimal division, sums in 64 bits.

Defined cases: null text, language and source are empty strings; texts without words give
their group and no terms; a language whose terms are all too rare has differences of 0; a
language with one source has no pairs; repeated rows count each; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flowlake.llm import worker
from flowlake.session import materialize

SCALE = 1_000_000_000
ADDED = 5
#: Distinct terms that a task holds before it sends partial counts on, and bytes of a text that are cut into words at a time.
HELD = 200_000
SLICE = 1 << 20
#: Sources in a block, and rows of a table of groups up to which it is sent to all tasks.
BLOCK = 32
SMALL = 100_000

#: What a byte becomes: letters are lower-cased, bytes of other scripts stay, all others separate words.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
COLUMNS = pa.schema([
    ("lang", pa.string()), ("segment", pa.int64()), ("width", pa.int64()), ("source", pa.string()),
    ("starts", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())),
])
PAIRS = "lang string, a string, b string, value bigint"


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a slice at a time; slices end between words."""
    text = text.translate(BYTES)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE) if at + SLICE < len(text) else -1
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per language, source and term, as far as one task sees them."""
    worker.begin("divergence")
    held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            texts = pa.array(list(n), pa.binary()).cast(pa.string(), safe=False)
            one = lambda value: pa.repeat(pa.scalar(value, pa.binary()), len(n)).cast(pa.string(), safe=False)
            columns = [one(lang), one(source), texts, pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=COUNTS)
        held.clear()

    size = 0
    for batch in batches:
        langs, sources, texts = (batch.column(c).cast(pa.large_binary()) for c in ("lang", "source", "text"))
        for lang, source, text in zip(langs, sources, texts):
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(n), set()
            for part in words(text.as_py()):
                n.update(part)
                seen.update(part)
            docs.update(seen)
            size += len(n) - before
            if size >= HELD:
                yield from sent()
                size = 0
    yield from sent()
    worker.give_back()


def vocabulary(docs: DataFrame, min_docs: int) -> DataFrame:
    """Terms in at least ``min_docs`` documents of their language: (lang, term, n, entries of source and n), stored."""
    worker.small_batches(docs.sparkSession)
    found = docs.mapInArrow(partial_counts, "lang string, source string, term string, n bigint, docs bigint")
    by_source = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    entries = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("entries")
    terms = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), entries)
    return materialize(terms.filter(F.col("docs") >= min_docs).drop("docs"), "divergence-terms")


def group_table(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Every group with its total over the vocabulary, the language's total, the vocabulary's size and its block, stored."""
    totals = terms.select("lang", F.explode("entries").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("total"))
    whole = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("lang_total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(whole, "lang", "left")
    groups = groups.na.fill(0, ["total", "size", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumns({"block": F.floor(number / BLOCK).cast("int"), "sources": F.count(F.lit(1)).over(Window.partitionBy("lang"))})
    return materialize(groups, "divergence-groups")


def runs(rows: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of the runs of a column that is zero but at ``rows`` (ascending)."""
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (np.diff(rows) > 1) | (counts[1:] != counts[:-1])
    ends = np.append(rows[1:], width)  # where the next nonzero count stands
    gap = ends > rows + 1
    starts = np.concatenate([rows[fresh], rows[gap] + 1, [0] if not len(rows) or rows[0] > 0 else []]).astype(np.int32)
    values = np.concatenate([counts[fresh], np.zeros(len(starts) - int(fresh.sum()), np.int64)])
    order = np.argsort(starts, kind="stable")
    return starts[order], values[order].astype(np.int64)


def run_length_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered terms as one column of runs per source that has any of them; a segment is a language's part of a batch."""
    context = TaskContext.get()
    segment = (context.partitionId() if context else 0) << 33
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        entries = batch.column("entries")
        bounds = entries.offsets.to_numpy().astype(np.int64)
        flat = entries.values
        codes = flat.field("source").dictionary_encode()
        names, codes, counts = codes.dictionary.to_pylist(), codes.indices.to_numpy(), flat.field("n").to_numpy()
        cuts = [0, *[i for i in range(1, len(langs)) if langs[i] != langs[i - 1]], len(langs)]
        for first, last in zip(cuts, cuts[1:]):
            if first == last:
                continue
            low, high = bounds[first], bounds[last]
            rows = np.repeat(np.arange(last - first), np.diff(bounds[first : last + 1]))
            order = np.argsort(codes[low:high], kind="stable")
            code, row, count = codes[low:high][order], rows[order], counts[low:high][order]
            at = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, int)
            columns = [runs(r, c, last - first) for r, c in zip(np.split(row, at[1:]), np.split(count, at[1:]))]
            yield pa.RecordBatch.from_pydict({
                "lang": [langs[first]] * len(at), "segment": [segment] * len(at), "width": [last - first] * len(at),
                "source": [names[c] for c in code[at]], "starts": [c[0] for c in columns], "counts": [c[1] for c in columns],
            }, schema=COLUMNS)
            segment += 1


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], width: int) -> int:
    """Sum over a segment of the differences of two columns, from the runs' merged starts."""
    at = np.union1d(a[0], b[0])
    lengths = np.diff(np.append(at, width))
    left = a[1][np.searchsorted(a[0], at, "right") - 1]
    right = b[1][np.searchsorted(b[0], at, "right") - 1]
    return int(np.dot(np.abs(left - right), lengths))


def compare_blocks(table: pa.Table) -> pa.Table:
    """Differences of all pairs between two blocks of sources (or within one), in one segment."""
    table = table.sort_by("source").combine_chunks()
    lang, width = table["lang"][0].as_py(), table["width"][0].as_py()
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    names, blocks = table["source"].to_pylist(), table["block"].to_pylist()
    columns = [(np.asarray(s.values, np.int64), np.asarray(p.values, np.int64)) for s, p in zip(table["starts"], table["shares"])]
    out: dict[str, list] = {"lang": [], "a": [], "b": [], "value": []}
    for i, name in enumerate(names):
        for j in range(i + 1, len(names)):
            if (blocks[i], blocks[j]) == (low, high):
                for key, value in zip(out, (lang, name, names[j], overlap(columns[i], columns[j], width))):
                    out[key].append(value)
    return pa.table(out, pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())]))


def sized(frame: DataFrame) -> DataFrame:
    """The stored frame, marked for broadcast if it has few rows."""
    return F.broadcast(frame) if frame.limit(SMALL + 1).count() <= SMALL else frame


def share(count: str, total: str) -> str:
    return f"1 + ((cast({count} + {ADDED} as decimal(20,0)) * {SCALE}) div greatest({total} + {ADDED} * size, 1))"


def pair_differences(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """The sum of differences of every two sources of a language (lang, a, b, value), a before b."""
    # Ranges follow the counts; the order within them is what clusters equal counts.
    key = ["lang", "entries", "term"]
    ordered = terms.repartitionByRange(*key).sortWithinPartitions(*key).select("lang", "entries")
    columns = materialize(ordered.mapInArrow(run_length_columns, "lang string, segment bigint, width bigint, source string, starts array<int>, counts array<bigint>"), "divergence-columns")
    # A segment of no width gives every pair a row, also where there are no terms.
    none = groups.select("lang", F.lit(-1).cast("bigint").alias("segment"), F.lit(0).cast("bigint").alias("width")).distinct()
    segments = columns.select("lang", "segment", "width").distinct().unionByName(none)
    every = segments.join(sized(groups), "lang").join(columns.drop("width"), ["lang", "segment", "source"], "left")
    zero = F.array(F.lit(0))
    every = every.withColumns({"starts": F.coalesce("starts", zero), "counts": F.coalesce("counts", zero.cast("array<bigint>"))})
    every = every.withColumn("shares", F.expr(f"transform(counts, c -> cast({share('c', 'total')} as bigint))"))
    partners = F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / BLOCK).cast("int"))
    dealt = every.withColumn("other", F.explode(partners)).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    dealt = dealt.select("lang", "segment", "low", "high", "block", "width", "source", "starts", "shares")
    found = dealt.groupBy("lang", "segment", "low", "high").applyInArrow(compare_blocks, PAIRS)
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def overused_terms(terms: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """Each source's terms with a share above the language's, the ``ranks`` largest differences."""
    single = terms.select("lang", "term", F.col("n").alias("lang_n"), F.explode("entries").alias("e"))
    single = single.select("lang", F.col("e.source").alias("source"), F.col("term").alias("item"), F.col("e.n").alias("n"), "lang_n")
    value = F.expr(f"cast(({share('n', 'total')}) - ({share('lang_n', 'lang_total')}) as bigint)")
    found = single.join(sized(groups), ["lang", "source"]).select("lang", "source", "item", value.alias("value")).filter("value > 0")
    return ranked(found).filter(F.col("rank") <= ranks)


def ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = 30, ranks: int = 50) -> DataFrame:
    """Pairs and overused terms: (lang, source, part, item, value, rank)."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    terms = vocabulary(docs, min_docs)
    groups = group_table(docs, terms)
    pairs = materialize(pair_differences(terms, groups), "divergence-pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    parts = [ranked(both).withColumn("part", F.lit("pair")), overused_terms(terms, groups, ranks).withColumn("part", F.lit("term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")

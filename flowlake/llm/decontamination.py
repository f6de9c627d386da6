"""A distributed positional inverted index of documents, and phrase search in it.

The index is a stored table. Each task indexes the documents of one batch as a *block*:
every token gets a running number in the block (documents are one number apart, so no
phrase runs across two), and one row per term holds the term's sorted numbers. One more
row per block is its directory of documents. A term that is in every document is many
rows of bounded size, one per block; nothing about a term is ever gathered in one place.

A search sends windows of consecutive test words to the blocks. In each block a window
starts from its rarest term: the term's numbers, moved back by the term's place in the
window, are the candidate starts, and the lists of the other terms, moved likewise and
taken from rare to frequent, are intersected with them. With ``slop`` > 0 a term may be
up to that many words from its place (proximity).

The test set is sent in parts of at most ``WORDS_AT_ONCE`` words, so its size is no limit.

Windows of the same words are searched once, whatever items have them; the hits of a document are
merged to stretches and its items are a set, so neither equal items nor overlapping windows
multiply what comes back.

Defined cases: null and empty texts have no words and are in no match; a test item with
fewer words than the window, but not none, is one window; ids may be of any type, items
without an id hit and are counted (told apart by their text) but have no place in the list of ids; rows of the same id
are one item; documents come back once per input row, with null ids too.
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
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.llm import worker
from flowlake.llm.packing import gaps, pack, pack_sorted, unpack_sorted
from flowlake.session import scratch_path

WORDS_AT_ONCE = 500_000
#: Characters of text in one block.
BLOCK = 4_000_000

#: Bytes of words to themselves, A-Z to lower case, all others to a space.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
INDEX_SCHEMA = "block bigint, term binary, positions binary, doc_ids array<{}>"


def words(text: str | None) -> list[bytes]:
    """Lower-case words of ASCII letters and digits and all characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def block_rows(block: int, ids: list, texts: list, kind: pa.DataType) -> pa.RecordBatch:
    """Index rows of one block: its terms, and its directory as the row without a term. ``kind`` is the ids' type."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    found, starts, at = [], [], 0
    for text in texts:
        these = words(text)
        found.append(np.fromiter(map(number.__getitem__, these), np.int32, len(these)))
        starts.append(at)
        at += len(these) + 1
    starts.append(at)
    terms = np.concatenate(found) if found else np.zeros(0, np.int32)
    lengths = np.array([len(f) for f in found], np.int64)
    places = np.arange(len(terms)) + np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(terms, kind="stable")
    sizes = np.bincount(terms, minlength=len(number))
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
    content, ends = pack(gaps(places[order], first))
    directory = pack_sorted(np.array(starts))
    buffer = pa.py_buffer(content.tobytes() + directory)
    lists = np.concatenate([[0], ends])[np.append(first, len(terms))]
    bounds = np.append(lists, len(content) + len(directory)).astype(np.int32)
    n = len(number) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block, np.int64)),
            pa.array([*number, None], pa.binary()),
            pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.tobytes()), buffer]),
            pa.array([None] * (n - 1) + [ids], pa.list_(kind)),
        ],
        names=["block", "term", "positions", "doc_ids"],
    )


def store_index(docs: DataFrame, doc_id: str, text: str, path: str | None = None) -> DataFrame:
    """Index ``docs`` by position, write the index and return it as a table."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "positions")
    schema = INDEX_SCHEMA.format(docs.schema[doc_id].dataType.simpleString())
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    worker.small_batches(spark)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("decontamination")
        task, block, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        kind = pa.null()
        for batch in batches:
            kind = batch.column(0).type
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc)
                texts.append(value)
                size += len(value or "")
                if size >= BLOCK:
                    yield block_rows(task << 32 | block, ids, texts, kind)
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield block_rows(task << 32 | block, ids, texts, kind)
        del ids, texts
        worker.give_back()

    rows.mapInArrow(index, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass
class Windows:
    """Distinct windows of test words as rows of term numbers; short rows are filled with -1.

    Windows of the same words are one row, whatever items have them. ``owners`` names a row's set of
    items, ``sets`` has the items of each such set.
    """

    terms: list[bytes]
    rows: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    sets: list[np.ndarray]
    items: list[str | None]

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]], width: int) -> Windows:
        number: defaultdict[bytes, int] = defaultdict(count().__next__)
        holders: defaultdict[tuple[int, ...], list[int]] = defaultdict(list)
        for item, (_, text) in enumerate(items):
            ids = [number[w] for w in words(text)]
            for at in range(max(1, len(ids) - width + 1) if ids else 0):
                own = holders[tuple(ids[at:at + width])]
                if not own or own[-1] != item:
                    own.append(item)
        rows = np.full((len(holders), width), -1, np.int64)
        for row, window in zip(rows, holders):
            row[:len(window)] = window
        sets: dict[tuple[int, ...], int] = {}
        owners = [sets.setdefault(tuple(own), len(sets)) for own in holders.values()]
        lengths = np.fromiter(map(len, holders), np.int64, len(holders))
        return cls(list(number), rows, lengths, np.array(owners, np.int64), [np.array(s) for s in sets], [item for item, _ in items])

    def search(self, postings: dict[int, np.ndarray], slop: int) -> Iterator[tuple[int, np.ndarray]]:
        """(window, starts in the block) for the windows that occur."""
        df = np.zeros(len(self.terms) + 1, np.int64)
        for term, numbers in postings.items():
            df[term] = len(numbers)
        df[-1] = 1  # filled places
        counts = df[self.rows]
        for window in np.flatnonzero((counts > 0).all(axis=1)):
            n = self.lengths[window]
            starts = None
            for place in np.argsort(counts[window, :n], kind="stable"):
                numbers = postings[self.rows[window, place]] - place
                if starts is None:
                    starts = numbers if not slop else np.unique(np.concatenate([numbers + d for d in range(-slop, slop + 1)]))
                else:
                    low = np.searchsorted(numbers, starts - slop)
                    starts = starts[(low < len(numbers)) & (numbers[np.minimum(low, len(numbers) - 1)] <= starts + slop)]
                if not len(starts):
                    break
            if len(starts):
                yield int(window), starts


def merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals of whole numbers, as few intervals in order."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    fresh = np.append(True, first[1:] > reach[:-1] + 1)
    return first[fresh], reach[np.append(fresh[1:], True)]


def merged_lists(hits: pa.ListArray) -> pa.ListArray:
    """The union of the stretches in each row."""
    sizes, first, last = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in hits:
        a, b = (row.values.field(name).to_numpy() for name in ("first", "last"))
        a, b = merged(a, b) if len(a) else (a, b)
        sizes.append(len(a))
        first.append(a)
        last.append(b)
    values = pa.StructArray.from_arrays([pa.array(np.concatenate(first)), pa.array(np.concatenate(last))], ["first", "last"])
    return pa.ListArray.from_arrays(np.cumsum([0, *sizes]).astype(np.int32), values)


def search(index: DataFrame, items: DataFrame, item_id: str, text: str, width: int = 10, slop: int = 0) -> DataFrame:
    """One row per indexed document: its words, the stretches of words inside matches, and the items that match.

    ``hits`` are (first, last) places, in order and apart; ``items`` are the ids as texts, in order and once;
    ``n_items`` counts the ids and the different texts without an id. With ``slop`` a hit is
    where the window stands when all terms are near their places; it lies in the document.
    """
    queries = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text"))
    queries = queries.filter("text is not null").distinct()
    size = queries.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    pieces = max(1, -(-size // (6 * WORDS_AT_ONCE)))
    found = None
    for piece in range(pieces):
        part = queries.filter(F.pmod(F.xxhash64("text"), F.lit(pieces)) == piece)
        one = search_part(index, [tuple(r) for r in part.orderBy("item_id", "text").collect()], width, slop)
        found = one if found is None else found.unionByName(one)
    if pieces > 1:
        together = [F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items", "nameless")]
        found = found.groupBy("__row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *together)
        place = found.columns.index("hits")

        def make():
            return lambda part: [merged_lists(part.column(place))]

        found = worker.with_columns(found, [("__hits", found.schema["hits"].dataType)], make, drop=("hits",))
        found = found.withColumnRenamed("__hits", "hits").withColumn("items", F.array_sort("items"))
    named = F.array_distinct("items")
    return found.select("doc_id", "n_words", "hits", named.alias("items"), (F.size(named) + F.size(F.array_distinct("nameless"))).cast("bigint").alias("n_items"))


def search_part(index: DataFrame, items: list[tuple[str | None, str | None]], width: int, slop: int) -> DataFrame:
    spark: SparkSession = index.sparkSession
    windows = Windows.of(items, width)
    sent = spark.sparkContext.broadcast(windows)
    wanted = spark.createDataFrame([(bytearray(t), i) for i, t in enumerate(windows.terms)], "term binary, term_no int")
    ids = index.schema["doc_ids"].dataType
    postings = index.filter("term is not null").join(F.broadcast(wanted), "term").select("block", "term_no", "positions", F.lit(None).cast(ids).alias("doc_ids"))
    directory = index.filter("term is null").select("block", F.lit(-1).alias("term_no"), "positions", "doc_ids")

    def look_up(block: pa.Table) -> pa.Table:
        known: Windows = sent.value
        postings, starts, ids = {}, np.zeros(1, np.int64), block.column("doc_ids").combine_chunks().flatten()
        for term, content in zip(*(block.column(c).to_pylist() for c in ("term_no", "positions"))):
            if term < 0:
                starts = unpack_sorted(content)
            else:
                postings[term] = unpack_sorted(content)
        n_words = np.diff(starts) - 1
        firsts, lasts, docs, owners = [], [], [], set()
        for window, places in known.search(postings, slop):
            doc = np.searchsorted(starts, places, "right") - 1
            inside = (doc >= 0) & (doc < len(ids))
            doc, places = doc[inside], places[inside]
            inside = places - starts[doc] + known.lengths[window] <= n_words[doc]
            doc, places = doc[inside], places[inside]
            firsts.append(places)
            lasts.append(places + known.lengths[window] - 1)
            docs.append(doc)
            owners.update((d, int(known.owners[window])) for d in np.unique(doc).tolist())
        none = [np.zeros(0, np.int64)]
        first, last, doc = (np.concatenate(x or none).astype(np.int64) for x in (firsts, lasts, docs))
        if len(first):
            # Documents stand one number apart, so no stretch runs across two.
            first, last = merged(first, last)
            doc = np.searchsorted(starts, first, "right") - 1
        at = np.searchsorted(doc, np.arange(len(ids) + 1)).astype(np.int32)
        begins = starts[doc] if len(doc) else 0
        hits = pa.StructArray.from_arrays([pa.array(first - begins), pa.array(last - begins)], ["first", "last"])
        held: defaultdict[int, set[int]] = defaultdict(set)
        for d, owner in owners:
            held[d].update(known.sets[owner].tolist())
        names = [sorted({known.items[i] for i in held.get(d, ()) if known.items[i] is not None}) for d in range(len(ids))]
        nameless = [sorted({items_of[i] for i in held.get(d, ()) if known.items[i] is None}) for d in range(len(ids))]
        number = int(block.column("block")[0].as_py())
        return pa.table({
            "__row": pa.array([f"{number}-{i}" for i in range(len(ids))], pa.string()), "doc_id": ids, "n_words": pa.array(n_words, pa.int64()),
            "hits": pa.ListArray.from_arrays(at, hits), "items": pa.array(names, pa.list_(pa.string())), "nameless": pa.array(nameless, pa.list_(pa.int64())),
        })

    # Items without an id are told apart by their text.
    items_of = [xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) >> 1 for _, text in items]
    kind = ids.elementType.simpleString()
    both = postings.unionByName(directory)
    return both.groupBy("block").applyInArrow(look_up, f"__row string, doc_id {kind}, n_words bigint, hits array<struct<first:bigint,last:bigint>>, items array<string>, nameless array<bigint>")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10) -> DataFrame:
    """One row per document: its words, the words inside matches, and the items that match."""
    found = search(store_index(docs, doc_id, text), items, item_id, item_text, width)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"] + 1)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "n_items", "hits")

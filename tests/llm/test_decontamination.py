import hashlib
import random
import re

from flowlake.llm import decontamination
from flowlake.llm.queries import op6_positional_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    out = []
    for doc, text in docs:
        these = plain_words(text)
        hit, found = set(), set()
        for item, phrase in items:
            want = plain_words(phrase)
            for at in range(max(1, len(want) - width + 1) if want else 0):
                part = want[at:at + width]
                for i in range(len(these) - len(part) + 1):
                    if these[i:i + len(part)] == part:
                        hit.update(range(i, i + len(part)))
                        found.add(str(item))
        out.append((doc, len(these), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in frame.collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(6)] + ["Ünï", "the"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 6, 9])))) for i in range(25)] + [(99, None), (3, "W1 w2, w3!")]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "w1 W2 -- w3\nw1"), (502, "w1 W2 -- w3\nw1"), (503, "w1 " * 3000)]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items, 4)
    assert got(decontamination.contamination(*frames, width=4)) == want
    monkeypatch.setattr(decontamination, "WORDS_AT_ONCE", 20)
    assert got(decontamination.contamination(*frames, width=4)) == want


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "gamma x x x beta alpha"), (4, "beta alpha gamma")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id bigint, text string")
    index = decontamination.store_index(docs, "doc_id", "text")
    near = {s: {r["doc_id"] for r in decontamination.search(index, items, "item_id", "text", 3, s).collect() if r["hits"]} for s in (0, 1)}
    assert near == {0: {2}, 1: {1, 2, 4}}


def test_ids_of_any_kind(spark):
    """Items without an id hit and count; ids that are texts stay texts."""
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([("d1", f"x {passage} y"), (None, passage), ("d2", "clean")], "doc_id string, text string")
    items = spark.createDataFrame([(None, passage), (None, passage), (None, passage + " more"), ("b", passage), ("a", "X " + passage), ("b", "clean")], "item_id string, text string")
    rows = {(r["doc_id"], r["n_hit"], tuple(r["items"]), r["n_items"], tuple(map(tuple, r["hits"]))) for r in decontamination.contamination(docs, items).collect()}
    assert rows == {("d1", 12, ("a", "b"), 4, ((0, 11),)), (None, 11, ("a", "b"), 4, ((0, 10),)), ("d2", 1, ("b",), 1, ((0, 0),))}
    only = spark.createDataFrame([(None, passage)], "item_id bigint, text string")
    assert sorted((r["n_hit"], r["n_items"], r["items"]) for r in decontamination.contamination(docs, only).collect()) == [(0, 0, []), (11, 1, []), (11, 1, [])]


def test_equal_items_do_not_multiply(spark):
    """Windows and stretches follow the contents, not the number of items that have them."""
    passage = " ".join(f"p{i}" for i in range(40))
    few, many = ([(i, passage) for i in range(n)] for n in (1, 300))
    one, all_ = decontamination.Windows.of(few, 10), decontamination.Windows.of(many, 10)
    assert len(one.rows) == len(all_.rows) == 31 and len(all_.sets) == 1
    docs = spark.createDataFrame([(i, f"a {passage} b {passage}") for i in range(20)], "doc_id bigint, text string")
    items = spark.createDataFrame(many, "item_id bigint, text string")
    for r in decontamination.contamination(docs, items).collect():
        assert r["n_hit"] == 80 and len(r["hits"]) == 2 and r["n_items"] == 300 == len(r["items"])


def test_empty_tables_and_clashing_names(spark):
    schema = "doc_id int, text string, item_id string, block string, matches int"
    docs = spark.createDataFrame([(1, "a b c", "x", "y", 1), (None, "a b", None, None, None)], schema)
    none = spark.createDataFrame([], "item_id bigint, text string")
    items = spark.createDataFrame([(1, "b")], "item_id bigint, text string")
    assert got(decontamination.contamination(docs, none)) == [(1, 3, 0, []), (None, 2, 0, [])]
    assert got(decontamination.contamination(docs, items)) == [(1, 3, 1, ["1"]), (None, 2, 1, ["1"])]
    assert got(decontamination.contamination(docs.limit(0), items)) == []


def test_query(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(docs, items)}
    rows = op6_positional_index(spark, folder).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows} == want
    assert any(r["contaminated"] for r in rows)

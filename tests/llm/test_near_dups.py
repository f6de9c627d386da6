import random
import re

import pytest

from flowlake.llm import near_dups
from flowlake.llm.queries import op5_bottom_k_sketches


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(docs, size, percent):
    sets = [(d, shingles(t, size)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, other in sets[:i]:
            if one and other and 100 * len(one & other) >= percent * len(one | other):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((d, len(s), root(d), d == root(d)) for d, s in sets)


def got(frame):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect())


def edited(rng, words, share):
    return [w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(11)
    rows, vocabulary = [], [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([4, 8, 40, 150, 400]))]
        for copy in range(rng.choice([1, 4, 12])):
            rows.append(" ".join(edited(rng, words, rng.choice([0, 0.005, 0.02, 0.05]))))
    for _ in range(20):
        rows.append(" ".join([rng.choice(vocabulary) for _ in range(80)] + passage))
    # A chain: each is near the next, the ends are not near each other.
    chain = [f"c{i}" for i in range(120)]
    for step in range(8):
        rows.append(" ".join(chain[step * 4:step * 4 + 80]))
    rows += ["", "Hello", "hello", "HELLO there", "hello there", " \n ", "É é", "é é"]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, docs, size, percent):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = got(near_dups.near_duplicates(frame, size=size, percent=percent))
    assert found == brute(docs, size, percent)
    assert sum(not row[3] for row in found) > 20


def test_sure_runs():
    assert [near_dups.sure_run(p, least) for p, least in ((85, 2), (85, 20), (80, 2), (80, 20))] == [3, 5, 2, 4]
    rng = random.Random(1)
    for percent, least in ((85, 2), (85, 20), (80, 2), (80, 20)):
        for _ in range(4000):
            union = rng.randrange(least, 120)
            gaps = set(rng.sample(range(union), union * (100 - percent) // 100))
            if gaps:
                longest = max(map(len, "".join("x" if i in gaps else "." for i in range(union)).split("x")))
                assert longest >= near_dups.sure_run(percent, least)


def test_heavy_edits_of_one_text(spark):
    rng = random.Random(21)
    base = [f"w{rng.randrange(900)}" for _ in range(160)]
    edits = [(i, " ".join(edited(rng, base, rng.random() * 0.12))) for i in range(150)]
    edits += [(200 + i, edits[100 + i][1] + " tail of its own") for i in range(10)]
    frame = spark.createDataFrame(edits, "doc_id bigint, text string")
    assert got(near_dups.near_duplicates(frame, size=3, percent=85)) == brute(edits, 3, 85)


def test_small_sketch_and_shuffled_texts(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dups, "BROADCAST_IDS", 0)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(near_dups.near_duplicates(frame, size=3, percent=85, k=64)) == brute(docs, 3, 85)


def test_odd_rows(spark):
    schema = "doc_id int, text string, signature string, component string"
    rows = [(1, None, "s", "c"), (2, "", None, None), (3, "a b c d", "s", None), (3, "a b c d", "s", None), (9, "a b c d", "s", None), (None, "a b c d", None, None)]
    frame = spark.createDataFrame(rows, schema)
    found = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in near_dups.near_duplicates(frame, size=3, percent=85).collect()), key=str)
    assert found == [(0, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 2, 3, True), (3, 2, 3, True), (9, 2, 3, False)]
    assert near_dups.near_duplicates(frame.limit(0)).count() == 0


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert got(op5_bottom_k_sketches(spark, folder)) == brute([(r["doc_id"], r["text"]) for r in rows], 3, 85)

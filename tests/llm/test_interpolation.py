import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import interpolation
from flowlake.llm.queries import op7_deleted_interpolation

WEIGHTS = np.tile([0.5, 0.3, 0.2], (64, 1))
WEIGHTS[0] = [0.0, 0.6, 0.4]
WEIGHTS[3] = [0.2, 0.7, 0.1]


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [" end"]


def brute(docs, train, weights):
    one, two = Counter(), Counter()
    for text, learns in zip(docs, train):
        if learns:
            one.update(tokens(text))
            two.update(zip([" end", *tokens(text)], tokens(text)))
    n, v = sum(one.values()), len(one)
    out = []
    for text in docs:
        base = score = 0.0
        known = 0
        for before, word in zip([" end", *tokens(text)], tokens(text)):
            base += math.log10((one[word] + 0.5) / (n + 0.5 * (v + 1)))
            known += one[word] > 0
            c = one[before]
            a, u, z = weights[c.bit_length()]
            score += math.log10(a * two[before, word] / max(c, 1) + u * one[word] / max(n, 1) + z / (v + 1))
        out.append((len(tokens(text)), known, n, base, score))
    return out


def check(frame, docs, want):
    got = {r["doc_id"]: r for r in frame.collect()}
    assert len(got) == len(docs)
    for doc, row in zip(docs, want):
        r = got[doc]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == row[:3]
        assert (r["base_score"], r["score"]) == pytest.approx(row[3:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("block", [200, 10**7])
def test_counts_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(interpolation, "BLOCK", block)
    monkeypatch.setattr(interpolation, "learn_weights", lambda cells, floor: WEIGHTS)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("a B c d éé THE x\x00y".split()) for _ in range(rng.randrange(40))) for _ in range(80)] + ["", None, "new words", "a " * 500]
    train = [i % 5 != 1 for i in range(len(texts))]
    frame = spark.createDataFrame(list(zip(range(len(texts)), texts, train)), "doc_id int, text string, train boolean")
    check(interpolation.score_documents(frame, "doc_id", "text", F.col("train")), range(len(texts)), brute(texts, train, WEIGHTS))


def test_held_out_counts_are_deleted(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(interpolation, "learn_weights", lambda cells, floor: seen.update(cells=cells, floor=floor) or WEIGHTS)
    texts = ["a b a b", "a b c", "b b b"] * 40
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    interpolation.score_documents(frame, "doc_id", "text", F.lit(True), 0.3).count()
    ids = [r["doc_id"] for r in frame.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(10_000)) < 3000).collect()]
    held = [texts[i] for i in ids]
    assert 10 < len(held) < 80
    kept = [t for i, t in enumerate(texts) if i not in ids]
    one, two = Counter(), Counter()
    for t in kept:
        one.update(tokens(t))
        two.update(zip([" end", *tokens(t)], tokens(t)))
    total = sum(one.values())
    want = Counter()
    for t in held:
        for before, word in zip([" end", *tokens(t)], tokens(t)):
            want[one[before].bit_length(), round(two[before, word] / max(one[before], 1), 9), round(one[word] / total, 9)] += 1
    got = {(int(b), round(p, 9), round(q, 9)): n for b, n, p, q in seen["cells"]}
    assert got == want


def test_weights_raise_the_likelihood():
    rng = np.random.default_rng(0)
    cells = np.column_stack([rng.integers(0, 6, 300), rng.integers(1, 50, 300), rng.random(300) * (rng.random(300) < 0.7), rng.random(300) * 0.01])
    cells[cells[:, 0] == 0, 2] = 0
    value = lambda w: sum(n * math.log(w[int(b)] @ [p, q, 1e-4]) for b, n, p, q in cells)
    weights = interpolation.learn_weights(cells, 1e-4)
    assert weights.sum(axis=1) == pytest.approx(np.ones(64)) and (weights[1:] > 0).all()
    assert value(weights) > value(np.full((64, 3), 1 / 3))
    for b in range(1, 6):
        moved = weights.copy()
        moved[b] = 0.9 * moved[b] + 0.1 * np.array([1, 0, 0])
        assert value(weights) > value(moved) - 5


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, "a b", "x"), (1, "a b", None), (None, None, None)], "doc_id int, text string, block string")
    rows = interpolation.score_documents(frame, "doc_id", "text", F.lit(None).cast("boolean")).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows) == [(1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    assert interpolation.score_documents(frame.limit(0), "doc_id", "text", F.lit(True)).count() == 0


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    texts = [r["text"] for r in docs]
    train = [zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1 for r in docs]
    rows = {r["doc_id"]: r for r in op7_deleted_interpolation(spark, folder).collect()}
    for doc, learns, want in zip(docs, train, brute(texts, train, WEIGHTS)):
        row = rows[doc["doc_id"]]
        assert row["held_out"] == (not learns)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == want[:3]
        assert row["base_score"] == pytest.approx(want[3], rel=1e-9)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rows_without_an_id_are_counted(spark):
    """None of them is held out: the same as without any held-out share."""
    rows = [(None, f"a b c{i % 7} d{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [sorted(r["score"] for r in interpolation.score_documents(frame, "doc_id", "text", F.lit(True), share).collect()) for share in (0.5, 0.0)]
    assert got[0] == pytest.approx(got[1])

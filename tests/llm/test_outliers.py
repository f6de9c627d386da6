import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import outliers
from flowlake.llm.queries import op4_robust_outliers


def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


NAMES = [*outliers.BASE, "base_failed"]


def test_statistics(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "b", "c", "d#", "é|é", "\n", "e\x0b f", "x\r\ny"]) for _ in range(rng.randrange(90))) for _ in range(150)]
    texts += [None, "", "   ", "a", "a b", "a b c", "a b c a b c", "a a a a", " lead\n\ntail ", "z " * 5000, "l\nl\nl \nl", "q" * 100_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for places in (1 << 24, 16):
        monkeypatch.setattr(outliers, "PLACES", places)
        got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in outliers.base_statistics(frame).collect()}
        assert got == dict(enumerate(map(statistics, texts)))


def test_constants():
    assert outliers.chi2_quantile(0.05, 4) == pytest.approx(9.4877, abs=1e-4)
    assert outliers.consistency(0.75, 4) == pytest.approx(0.75 / (1 - outliers.chi2_tail(5.3853, 6)), rel=1e-3)


def test_distance_is_mahalanobis(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + [5, 1, 2, 1]
    frame = spark.createDataFrame([("c", *map(float, p)) for p in points], "cell string, x1 double, x2 double, x3 double, x4 double")
    found = outliers.distance(frame.join(outliers.moments(frame, "cell"), "cell")).collect()
    cov = np.cov(points.T, bias=True) + np.diag(np.square(outliers.FLOORS))
    want = {round(p[0], 9): (p - points.mean(axis=0)) @ np.linalg.solve(cov, p - points.mean(axis=0)) for p in points}
    assert {round(r["x1"], 9): pytest.approx(want[round(r["x1"], 9)], rel=1e-6) for r in found} == {round(r["x1"], 9): r["d2"] for r in found}


def test_contaminated_cell(spark):
    rng = np.random.default_rng(7)
    clean = rng.multivariate_normal([5, 1, 3, 1], np.diag([1, 0.3, 1, 0.4]), 800)
    clean[:, 1] += 0.2 * clean[:, 0]
    far = rng.normal(size=(200, 4)) * 0.2 + [14, 7, 12, 7]
    rows = [("c", *map(float, p)) for p in np.vstack([clean, far])]
    frame = spark.createDataFrame(rows, "cell string, x1 double, x2 double, x3 double, x4 double")
    one = outliers.estimate(frame).collect()[0]
    centre = np.array([one[f"m_{i}"] for i in range(4)])
    assert np.abs(centre - clean.mean(axis=0)).max() < 0.35
    scaled = outliers.distance(frame.join(outliers.estimate(frame), "cell")).withColumn("d2", F.col("d2") / outliers.consistency(0.75, 4)).collect()
    cut = outliers.chi2_quantile(1e-6, 4)
    assert all(r["d2"] > cut for r in scaled if r["x1"] > 11)
    assert sum(r["d2"] <= cut for r in scaled if r["x1"] <= 11) > 795


def test_estimates_shrink_smoothly(spark):
    """The parts of a cell's estimate against numpy; one row more or less moves no verdict by a jump."""
    rng = np.random.default_rng(5)
    cells = {("a", "s"): 300, ("a", "t"): 3, ("b", "s"): 1}
    points = {c: rng.normal(size=(n, 4)) + 3 * k for k, (c, n) in enumerate(cells.items())}
    rows = [(*c, *map(float, p)) for c, block in points.items() for p in block]
    vectors = outliers.cell_names(spark.createDataFrame(rows, "lang string, source string, x1 double, x2 double, x3 double, x4 double"), "lang", "source")
    levels = vectors.select(F.explode(F.array("__cell", "__wide", "__all")).alias("cell"), *outliers.DIMENSIONS)
    plain = outliers.moments(levels, "cell")
    found = {r["__cell"]: r for r in outliers.shrunk(vectors, plain, 50).collect()}

    def moments(block):
        return block.mean(axis=0), np.cov(block.T, bias=True).reshape(4, 4) * (len(block) > 1) + np.diag(np.square(outliers.FLOORS))

    def mixed(one, other, n):
        w, off = n / (n + 50), one[0] - other[0]
        return w * one[0] + (1 - w) * other[0], w * one[1] + (1 - w) * other[1] + w * (1 - w) * np.outer(off, off)

    everything = moments(np.vstack(list(points.values())))
    for (lang, source), n in cells.items():
        own = np.vstack([b for (x, _), b in points.items() if x == lang])
        mean, cov = mixed(moments(points[lang, source]) if n > 1 else (points[lang, source][0], np.diag(np.square(outliers.FLOORS))), mixed(moments(own) if len(own) > 1 else (own[0], np.diag(np.square(outliers.FLOORS))), everything, len(own)), n)
        got = found[f'["={lang}","={source}"]']
        factor = np.array([[got[f"l_{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
        assert [got[f"m_{i}"] for i in range(4)] == pytest.approx(mean) and factor @ factor.T == pytest.approx(cov)


def test_odd_rows(spark):
    prose = lambda n, seed: " ".join(random.Random(seed).choices([f"w{'x' * (i % 5)}{i}" for i in range(300)], k=n))
    rows = [(i, prose(80, i), "en", "s") for i in range(40)]
    rows += [(40, None, "en", "s"), (41, "", None, None), (42, prose(80, 42), None, None), (43, "#$%& " * 30 + prose(100, 43), "en", "s"), (44, prose(80, 1), "xx", None), (44, prose(80, 1), "xx", None)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string").withColumns({"cell": F.lit(1), "d2": F.lit("x"), "n_words": F.lit(0)})
    got = sorted((r["doc_id"], r["base_failed"], r["kept"]) for r in outliers.judge(frame).collect())
    want = [(i, False, True) for i in range(40)] + [(40, True, False), (41, True, False), (42, False, True), (43, False, False), (44, False, True), (44, False, True)]
    assert got == want
    assert outliers.judge(frame.limit(0)).count() == 0


def test_query(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op4_robust_outliers(spark, folder).collect()
    assert {r["doc_id"]: tuple(r[n] for n in NAMES) for r in rows} == {d: statistics(t) for d, t in docs.items()}
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert sum(r["kept"] for r in rows) > 0.7 * sum(not r["base_failed"] for r in rows)

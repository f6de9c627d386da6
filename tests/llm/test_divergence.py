import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from flowlake.llm import divergence

SCHEMA = "lang string, source string, text string, n int, term string, rank int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, ranks):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text)]
        groups.add((lang, source))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t in docs[lang] if docs[lang][t] >= min_docs]
        sources = [s for n, s in groups if n == lang]
        columns = {s: [counts[lang, s][t] for t in kept] for s in sources}
        whole = [sum(c) for c in zip(*columns.values())]
        p = lambda c: [1 + 1_000_000_000 * (n + 5) // (sum(c) + 5 * len(kept)) for n in c]
        for s in sources:
            pairs = [(o, sum(abs(a - b) for a, b in zip(p(columns[s]), p(columns[o])))) for o in sources if o != s]
            terms = [(t, a - b) for t, n, a, b in zip(kept, columns[s], p(columns[s]), p(whole)) if n and a > b]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found) if part == "pair" or k < ranks]
    return sorted(out)


def rows(n=160, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i)}" for i in range(26)] + ["Über", "ÄB", "x\u00a0y", "日本", "A1b2", "it's", "\U0001f600"]
    out = []
    for i in range(n):
        picked = rng.choice(words, rng.integers(0, 40), p=np.arange(1, len(words) + 1) / sum(range(1, len(words) + 1)))
        out.append((["en", "de", "", None][rng.integers(0, 4)], [f"s{k}" for k in range(5)][rng.integers(0, 5)] if i % 9 else None, " ".join(picked)))
    return out + [("xx", "only", "rare words"), ("yy", "a", None), ("yy", "b", ""), ("yy", None, "12 34"), ("en", "blank", "\t\n")]


@pytest.mark.parametrize("held, slice_, block", [(200_000, 1 << 20, 32), (7, 11, 2)])
def test_against_brute_force(spark, held, slice_, block, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", block)
    given = rows()
    frame = spark.createDataFrame([(*r, 1, "t", 2) for r in given], SCHEMA).repartition(3)
    if held != divergence.HELD:  # the limits inside tasks are shown on the functions themselves
        monkeypatch.setattr(divergence, "HELD", held)
        monkeypatch.setattr(divergence, "SLICE", slice_)
        batch = pa.RecordBatch.from_pydict({"lang": ["a"] * 9, "source": ["b"] * 9, "text": ["Xx yY zz " * k + "end" for k in range(9)]})
        merged, docs = Counter(), Counter()
        for part in divergence.partial_counts(iter([batch])):
            for r in part.to_pylist():
                merged[r["term"]] += r["n"]
                docs[r["term"]] += r["docs"]
        assert merged == {"xx": 36, "yy": 36, "zz": 36, "end": 9} and docs == {"xx": 8, "yy": 8, "zz": 8, "end": 9}
    got = sorted(map(tuple, divergence.audit(frame, min_docs=12, ranks=4).collect()))
    assert got == brute(given, 12, 4)


def test_runs_and_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        width = int(rng.integers(1, 30))
        dense = [rng.integers(0, 3, width) for _ in range(2)]
        columns = [divergence.runs(np.flatnonzero(d), d[d > 0], width) for d in dense]
        for d, (starts, counts) in zip(dense, columns):
            assert np.array_equal(np.repeat(counts, np.diff(np.append(starts, width))), d)
            assert len(starts) == 1 + np.count_nonzero(np.diff(d))
        assert divergence.overlap(*columns, width) == np.abs(dense[0] - dense[1]).sum()


def test_large_counts_are_exact(spark):
    """Counts of 10**13 leave 64 bits when multiplied by the scale."""
    big = 10**13
    terms = spark.createDataFrame([("en", "a", big + 1, [("s", big), ("t", 1)]), ("en", "b", 3, [("t", 3)])], "lang string, term string, n bigint, entries array<struct<source:string,n:bigint>>")
    docs = spark.createDataFrame([("en", "s"), ("en", "t")], "lang string, source string")
    found = divergence.pair_differences(terms, divergence.group_table(docs, terms)).collect()
    p = lambda n, total: 1 + 10**9 * (n + 5) // (total + 10)
    assert [r["value"] for r in found] == [abs(p(big, big) - p(1, 4)) + abs(p(0, big) - p(3, 4))]


def test_empty_table_and_long_text(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(frame).count() == 0
    given = [("en", s, "Ab c " * 700_000 + "d" * 300_000) for s in ("s", "t")]
    got = divergence.audit(spark.createDataFrame(given, "lang string, source string, text string"), min_docs=2)
    assert sorted(map(tuple, got.collect())) == brute(given, 2, 50)

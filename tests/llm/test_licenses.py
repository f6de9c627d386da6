import random
import re

import pytest

from flowlake.llm import licenses
from flowlake.llm.queries import op9_positional_rare_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    these, starts, labels = words(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        for i in range(len(these)):
            if these[i:i + len(want)] == want:
                starts.append(i)
                labels.add(label)
    return len(these), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels)


def row_base(row):
    return row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]


def brute_places(these, idf, share):
    """Every template at every position, without an index."""
    found = set()
    for label, notice, must in licenses.TEMPLATES:
        want = notice.split()
        total = sum(idf[w] for w in want)
        for at in range(-len(want) + 1, len(these)):
            there = sum(idf[w] for i, w in enumerate(want) if 0 <= at + i < len(these) and these[at + i] == w)
            stretch = " " + " ".join(these[max(at, 0):at + len(want)]) + " "
            if there >= share * total and f" {must} " in stretch:
                found.add((label, max(at, 0), round(min(1.0, there / total), 9)))
    return sorted(found)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    filler = "the of and with this work file public notice copy a be".split()
    out = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(4)):
            parts.append(" ".join(rng.choice(filler) for _ in range(rng.randrange(25))))
            notice = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randrange(2)):
                notice[rng.randrange(len(notice))] = "changed"
            parts.append(rng.choice(["", *[" ".join(notice).upper()] * 4, "CC-BY", "mit License mit license", "gnu general public"]))
        out.append(rng.choice([" ", "\n", ", "]).join(parts))
    return out + ["", None, "...", "MIT LICENSE", "mit licenses", "ÉMIT license", "worK mİt license", "cc by " * 3000]


def test_against_brute_force(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    idf = licenses.inverse_frequencies(frame, "text", licenses.TEMPLATES)
    rows = {r["doc_id"]: r for r in licenses.scan(frame).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert row_base(rows[i]) == base(text), text
        assert [(p["label"], p["first_word"], round(p["share"], 9)) for p in rows[i]["places"]] == brute_places(words(text), idf, 0.7), text
        assert set(rows[i]["labels"]) == set(rows[i]["base_labels"]) | {p["label"] for p in rows[i]["places"]}
        assert 0 <= rows[i]["score"] <= 1
    assert sum(bool(r["places"]) for r in rows.values()) > 40


def test_a_notice_without_its_rarest_words_is_found(spark):
    notice = next(n for label, n, _ in licenses.TEMPLATES if label == "mit" and len(n.split()) > 20)
    altered = notice.replace("sublicense", "x").replace("merge", "x").replace("associated", "x")
    frame = spark.createDataFrame([(altered,), (notice,), (altered,), ("other words",)] + [("and or the to of",)] * 20, "text string")
    assert [r["labels"] for r in licenses.scan(frame).collect()][:4] == [["mit"], ["mit"], ["mit"], []]
    # The same where no document has these words.
    assert [r["labels"] for r in licenses.scan(frame.filter("text not like '%sublicense%'")).collect()][:2] == [["mit"]] * 2


def test_anchors_leave_too_little_for_a_place():
    for notice in (n.split() for _, n, _ in licenses.TEMPLATES):
        found = {w: i % 4 for i, w in enumerate(sorted(set(notice)))}
        idf = licenses.weighed(found, 9)
        anchors = licenses.anchors_of(notice, found, idf, 0.7)
        assert all(found[w] for w in anchors)
        assert sum(idf[w] for w in notice if found[w] and w not in anchors) < 0.7 * sum(idf[w] for w in notice)


def test_an_inserted_or_missing_word_does_not_part_a_notice(spark):
    notice = licenses.TEMPLATES[6][1].split()
    half = len(notice) // 2
    texts = [notice[:half] + ["new"] + notice[half:], notice[:half] + notice[half + 1:], notice[:half]]
    frame = spark.createDataFrame([(" ".join(t),) for t in texts] + [("a b c d",)] * 20, "text string")
    rows = licenses.scan(frame).collect()
    assert [r["labels"] for r in rows[:3]] == [["mit"], ["mit"], []]
    assert [len(r["places"]) for r in rows[:3]] == [1, 1, 0]


def test_odd_rows(spark):
    schema = "doc_id int, text string, labels int, places string, w string"
    frame = spark.createDataFrame([(None, None, 1, "x", "y"), (2, "Licensed under CC BY-NC 4.0.", 1, "x", "y"), (2, "Licensed under CC BY-NC 4.0.", 1, "x", "y")], schema)
    got = sorted((r["n_words"], r["labels"], r["score"]) for r in licenses.scan(frame).collect())
    assert got == [(0, [], 0.0), (7, ["cc-by", "cc-by-nc-4.0"], 1.0), (7, ["cc-by", "cc-by-nc-4.0"], 1.0)]
    assert licenses.scan(frame.limit(0)).count() == 0
    assert [r["labels"] for r in licenses.scan(frame, templates=[], phrases={}).collect()] == [[], [], []]


def test_query(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in op9_positional_rare_words(spark, folder).collect():
        n, places, first, last, labels = base(docs[row["doc_id"]])
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == (n, places, first, last, ",".join(labels))
        assert set(labels) <= set(filter(None, row["labels"].split(",")))


def test_many_equal_notices_in_one_text(spark):
    """Work follows the hits, not their square; every notice is found at its own place."""
    notice = "x y released under the mit license z. "
    rows = spark.createDataFrame([(1, notice * 5000), (2, "released under the mit license")], "doc_id int, text string")
    found = {r["doc_id"]: r for r in licenses.scan(rows).collect()}
    assert found[1]["n_base"] == 5000 and found[1]["labels"] == ["mit"]
    assert [p["first_word"] for p in found[1]["places"] if p["label"] == "mit"][:3] == [2, 10, 18] and len(found[1]["places"]) >= 5000

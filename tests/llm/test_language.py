import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from flowlake.llm import language
from flowlake.llm.queries import PIECES, op3_segmentation_unigrams

TOY = ["a", "b", "ab", "ba", "▁", "▁a", "aba"]


def segmentations(text, known):
    if not text:
        yield []
    for end in range(1, len(text) + 1):
        if text[:end] in known or end == 1:
            for rest in segmentations(text[end:], known):
                yield [text[:end], *rest]


def toy_model():
    model = language.PieceModel.uniform(TOY, ["x", "y"])
    rng = np.random.default_rng(1)
    chance = rng.random(model.chance.shape)
    chance[-1] = 0
    return language.PieceModel(["x", "y"], model.hashes, chance / chance.sum(axis=0), model.longest)


def row(model, piece):
    return next(int(rows[0]) for a, b, rows in model.lattice(language.codes([piece])) if (a, b) == (0, len(piece)))


def chance(model, cut, lang):
    return np.prod([model.chance[row(model, p), lang] for p in cut])


@pytest.mark.parametrize("text", ["▁ab", "▁abab", "▁", "▁azb", "abaab", "zz"])
def test_sum_over_all_segmentations(text):
    model = toy_model()
    got = model.log_chances([text])[0]
    for lang in (0, 1):
        want = sum(chance(model, cut, lang) for cut in segmentations(text, TOY))
        assert got[lang] == pytest.approx(np.log(want), rel=1e-12)


def test_expected_uses():
    model, texts, weights = toy_model(), ["▁abab", "ab", "▁azb"], np.array([3.0, 1.0, 2.0])
    want = np.zeros(len(model.chance))
    for text, weight in zip(texts, weights):
        cuts = list(segmentations(text, TOY))
        total = sum(chance(model, c, 1) for c in cuts)
        for cut in cuts:
            for piece in cut:
                want[row(model, piece)] += weight * chance(model, cut, 1) / total
    assert model.expected(texts, weights, 1) == pytest.approx(want)


def by_hand(model, text, lang):
    """Log-probability by exact fractions, so that nothing underflows."""
    known = {p: Fraction(float(model.chance[row(model, p), lang])) for p in TOY}
    other = Fraction(float(model.chance[len(model.hashes), lang]))
    sums = [Fraction(1)]
    for end in range(1, len(text) + 1):
        ways = [(sums[k], text[k:end]) for k in range(max(0, end - 3), end)]
        sums.append(sum(before * known.get(piece, other if len(piece) == 1 else 0) for before, piece in ways))
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


@pytest.mark.parametrize("at_once", [5, 1 << 14])
def test_long_words_over_all_segmentations(monkeypatch, at_once):
    """Words beyond the block's length, also where a double would underflow and where the cut falls into pieces."""
    monkeypatch.setattr(language, "LETTERS_AT_ONCE", at_once)
    model, rng = toy_model(), np.random.default_rng(2)
    for length in (33, 40, 700):
        text = language.START + "".join(rng.choice(list("abz"), length))
        got = model.log_chances([text, "\u2581ab"])
        assert got[0] == pytest.approx([by_hand(model, text, lang) for lang in (0, 1)], rel=1e-10)
    short = language.START + "abazabab"
    assert next(reversed(list(model.forward(short, model.logs)))) == pytest.approx(model.log_chances([short])[0])
    want = model.expected([short, "zab"], np.array([3.0, 2.0]), 1)
    monkeypatch.setattr(language, "LONGEST", 1)
    assert model.expected([short, "zab"], np.array([3.0, 2.0]), 1) == pytest.approx(want)


def test_forgetting():
    model = toy_model()
    scores = language.WordScores(model.dump())
    scores.most = 300
    for words in ({"ab"}, {"ba", "abab"}, {"a" * 100, "ab"}, {"zz"}, {"ab", "b"}):
        scores.learn(words)
        for word in words:
            assert scores.score(Counter({word: 3})) == pytest.approx(3 * model.log_chances([language.START + word])[0])
        assert len(scores) == len(scores.values) <= 4


def test_held_out_accuracy(spark, folder):
    rows = {r["doc_id"]: r for r in op3_segmentation_unigrams(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert set(rows) == {d["doc_id"] for d in docs}
    held = [d for d in docs if rows[d["doc_id"]]["held_out"]]
    right = sum(rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert len(held) > 40 and right / len(held) > 0.97
    assert all(0.0 <= r["score"] <= 1.0 for r in rows.values())


def test_odd_rows(spark):
    schema = "doc_id int, text string, lang string, score string"
    rows = spark.createDataFrame(
        [(1, "the cat and the dog", "en", "s"), (2, "der hund und die katze", "de", None), (3, None, "en", None), (4, "123 ² !?", None, None),
         (5, "", "de", None), (6, "the dog", None, None), (6, "the dog", None, None), (7, "hund " * 40000, None, None)], schema)
    model = language.fit(rows, "text", "lang", PIECES)
    found = sorted((r["doc_id"], r["lang_pred"]) for r in language.identify(rows, model).collect())
    assert found == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (7, "de")]
    empty = language.fit(rows.limit(0), "text", "lang", PIECES)
    assert {(r["lang_pred"], r["score"]) for r in language.identify(rows, empty).collect()} == {("und", 0.0)}
    assert language.identify(rows.limit(0), model).count() == 0


def test_copies_neither_use_up_nor_break_the_bound(spark):
    texts = {f"l{i}": [f"{w}{w} {w}" for w in (f"w{chr(97 + i)}{chr(97 + j)}" for j in range(1 + 20 * (i % 2)))] for i in range(8)}
    rows = [(t, lang) for lang, some in texts.items() for k, t in enumerate(some) for _ in range(40 if k == 0 else 1)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    counts = {lang: len(some) for lang, some in texts.items()}
    for bound in (10, 100):
        got = [(r["lang"], r["text"]) for r in language.distinct_texts(frame, counts, bound).collect()]
        assert len(got) == len(set(got))
        assert Counter(lang for lang, _ in got) == {lang: min(bound, n) for lang, n in counts.items()}
    model = language.fit(frame, "text", "lang", PIECES, rows_per_language=10)
    assert all(model.chance[:-1, i].max() > 10 * model.chance[:-1, i].min() for i in range(8))

import random
import re

import pytest
from tokenizers import Tokenizer

from flowlake.llm import token_counts
from flowlake.llm.queries import BYTE_BPE, BYTE_RANKS, op1_offset_attribution


@pytest.fixture(scope="module")
def encoder():
    return token_counts.Encoder(open(BYTE_RANKS, encoding="ascii").read())


def brute(encoder, text, border, rule):
    """Character by character: which section holds which part of which token."""
    cuts = [m.end() for m in re.finditer(border, text) if 0 < m.end() < len(text)]
    section_of = [sum(c <= i for c in cuts) for i in range(len(text))]
    tokens, crossing = [0.0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    at = 0
    for token in encoder.encoding.encode_ordinary(text):
        n = len(encoder.encoding.decode_single_token_bytes(token))
        chars = sorted(set(char_of[at:at + n]))
        at += n
        held = [section_of[c] for c in chars]
        places = sorted(set(held))
        if len(places) > 1:
            for p in places:
                crossing[p] += 1
        if rule == "share":
            for p in places:
                tokens[p] += held.count(p) / len(held)
        else:
            tokens[places[0] if rule == "start" else max(places, key=lambda p: (held.count(p), -p))] += 1
    return tokens, crossing


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_against_brute_force(encoder, rule):
    rng = random.Random(8)
    for _ in range(200):
        text = "".join(rng.choice(["a", "the", " ", "\n", "\n\n\n", "é", "🙂", "漢", "word", ".", "-"]) for _ in range(rng.randrange(1, 60)))
        for border in (r"\n", "[aeo]", "🙂"):
            tokens, crossing = token_counts.allocate(*encoder.spans(text), token_counts.intervals(text, re.compile(border)), rule)
            want = brute(encoder, text, border, rule)
            assert tokens.tolist() == pytest.approx(want[0]) and crossing.tolist() == want[1], (text, border)


def test_odd_rows(spark):
    schema = "doc_id int, text string, section string"
    frame = spark.createDataFrame([(1, None, "x"), (None, "", None), (3, "one\ntwo", "x"), (3, "one\ntwo", "x")], schema)
    got = sorted(((r["doc_id"] or 0, r["section"], r["start_char"], r["end_char"], r["n_tokens"]) for r in token_counts.section_counts(frame, BYTE_RANKS).collect()))
    assert got == [(0, 0, 0, 0, 0.0), (1, 0, 0, 0, 0.0), (3, 0, 0, 4, 2.0), (3, 0, 0, 4, 2.0), (3, 1, 4, 7, 1.0), (3, 1, 4, 7, 1.0)]
    assert token_counts.section_counts(frame.limit(0), BYTE_RANKS).count() == 0
    with pytest.raises(ValueError):
        token_counts.section_counts(frame, BYTE_RANKS, rule="other")


def test_query_counts_every_token_once(spark, folder):
    library = Tokenizer.from_file(BYTE_BPE)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op1_offset_attribution(spark, folder).collect()
    total, ends = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["section"])):
        assert r["start_char"] == ends.get(r["doc_id"], 0)
        ends[r["doc_id"]] = r["end_char"]
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    assert ends == {d: len(t) for d, t in docs.items()}
    assert total == {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in docs.items()}

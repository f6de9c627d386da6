import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowlake.llm import bpe
from flowlake.llm.queries import BYTE_BPE, op8_bpe_round_trip


@pytest.fixture(scope="module")
def own():
    return bpe.Vocabulary(open(BYTE_BPE, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def decoder():
    return bpe.Decoder(open(BYTE_BPE, encoding="utf-8").read())


def expected(library, text):
    return library.encode(text, add_special_tokens=False).ids


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("text", [
    "", " ", "a", "aaaaaaaaaaaaaaaaaaaa", "  two  spaces \n\n\t tabs ", "it's we'll they've I'd", "naïve Ünïcödé ß",
    "x<|endoftext|>y <|endoftext|>", "数字 12345 ½ ²", "🙂🙂 emoji‍", "࢏౜ new letters \U00010940", "\x00\x1c\x85\xa0 end ",
    "." * 500, "ababababab" * 50, "1" * 1000, "#" * 333 + "$%&" * 100,
])
def test_same_ids_as_the_library(own, decoder, library, text):
    packed = own.encode(text)
    assert numbers(packed) == expected(library, text)
    assert decoder.decode(packed) == library.decode(numbers(packed), skip_special_tokens=False) == text


def test_random_texts(own, library):
    rng = random.Random(5)
    letters = "abcdefghij  \n\t'éüñ,.!#0123ABCDEaaaeee漢字🙂"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert numbers(own.encode(text)) == expected(library, text), text


def test_long_text_in_parts(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 50)
    text = " ".join(f"word{i} it's  \n\n x" for i in range(400)) + "<|endoftext|>" + "y" * 300
    assert numbers(own.encode(text)) == expected(library, text)
    assert len(list(bpe.parts(text))) > 5 and "".join(bpe.parts(text)) == text


def test_forgetting_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(own.kept, "most", 300)
    monkeypatch.setattr(own.borders, "most", 300)
    text = "some words that do not all fit into the memory of the worker " * 3
    assert numbers(own.encode(text)) == expected(library, text)


def test_query_against_the_library(spark, folder, library):
    rows = op8_bpe_round_trip(spark, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = expected(library, texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_empty_tables_and_clashing_names(spark):
    schema = "doc_id bigint, text string, ids string, decoded int"
    rows = spark.createDataFrame([(1, None, "x", 1), (None, "", None, None), (3, "hi there", "y", 2), (3, "hi there", "y", 2)], schema)
    found = bpe.decode_documents(bpe.encode_documents(rows, BYTE_BPE), BYTE_BPE).collect()
    assert sorted((r["n_tokens"], r["decoded"]) for r in found) == [(0, ""), (0, ""), (2, "hi there"), (2, "hi there")]
    assert bpe.decode_documents(bpe.encode_documents(rows.limit(0), BYTE_BPE), BYTE_BPE).count() == 0

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from flowlake.llm import language
from flowlake.llm.queries import PIECES
from tests.llm import test_decontamination, test_near_dups, test_outliers


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    columns = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = kept.collect()
        found = stage(spark, kept, folder)
        assert found.columns == columns
        ids = {r["doc_id"] for r in found.collect()}
        texts = [(r["doc_id"], r["text"]) for r in rows]
        if name == "language ID":
            assert ids == {d for d, t in texts if any(c.isalpha() for c in t)}
        elif name == "quality rules":
            failed = {d for d, t in texts if test_outliers.statistics(t)[-1]}
            assert not ids & failed and len(ids) > 0.8 * (len(texts) - len(failed))
        elif name == "MinHash near-dedup":
            assert ids == {d for d, _, _, keep in test_near_dups.brute(texts, 3, 85) if keep}
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert ids == {d for d, _, hit, _ in test_decontamination.brute(texts, items) if not hit}
        kept = kept.filter(kept["doc_id"].isin(list(ids)))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    last = {r["doc_id"]: r for r in corpus_pipeline.encode(spark, kept, folder).collect()}
    assert set(last) == set(texts)
    for doc, row in last.items():
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode(texts[doc], add_special_tokens=False).ids


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "doc_id bigint, text string")
    rejected = spark.createDataFrame([(2,), (None,), (2,)], "doc_id bigint")
    for most in (0, 10):
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_IDS", most)
        assert sorted(r["text"] for r in corpus_pipeline.without(docs, rejected, "ids").collect()) == ["a", "b"]


def test_odd_rows(spark, folder):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, None, "en", None, None)], schema)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, folder).count() >= 0
    assert corpus_pipeline.language_id(spark, docs, folder).count() == 0
    model = language.fit(docs, "text", "lang", PIECES)
    assert model.languages == ["en"]


def test_rows_are_judged_one_by_one(spark, folder, tmp_path):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    spark.createDataFrame([(None, passage), (1, "not in any document")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    frame = lambda rows: spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in rows], schema)
    got = lambda found: sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)
    other, copy = "a clean text of its own", "this is a text that stands here more than once"
    # A hit without an id, under a shared id and under none.
    docs = frame([(5, f"x {passage} y"), (5, other), (None, passage), (None, other)])
    assert got(corpus_pipeline.decontaminate(spark, docs, str(tmp_path))) == [(5, other), (None, other)]
    docs = frame([(7, copy), (7, copy), (None, copy), (9, copy), (7, other), (3, ""), (3, ""), (None, ""), (4, "")])
    assert got(corpus_pipeline.near_duplicates(spark, docs, folder)) == sorted([(7, copy), (7, other), (3, ""), (None, ""), (4, "")], key=str)
    bad, good = "!!! ??? ###", "This is a plain sentence of a few common words that nobody would object to, and it goes on for a while. " * 5
    docs = frame([(1, bad), (None, bad), (1, good)])
    assert bad not in {r["text"] for r in corpus_pipeline.quality_rules(spark, docs, folder).collect()}

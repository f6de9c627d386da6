import hashlib

import pytest
from pyspark.sql import functions as F

from flowlake.operators import sampling


def key(i, seed=42):
    return (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i)


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds most rows, one has two, one is null.
    kind = F.expr("CASE WHEN id < 700 THEN 'big' WHEN id < 960 THEN 'mid' WHEN id < 962 THEN 'tiny' END")
    return spark.range(1000).select("id", kind.alias("kind")).repartition(6).cache()


def groups(rows):
    found = {}
    for row in rows.collect():
        found.setdefault(row["kind"], []).append(row["id"])
    return found


def test_split_is_exact_per_class(rows):
    split = sampling.stratified_split(rows, "kind", "id")
    assert split.count() == 1000 and split.select("id").distinct().count() == 1000
    found = {(r["kind"], r["split"]): r["count"] for r in split.groupBy("kind", "split").count().collect()}
    assert found[("big", "train")] == 490 and found[("big", "val")] == 105 and found[("big", "test")] == 105
    assert found[("mid", "train")] == 182 and found[("mid", "val")] == 39 and found[("mid", "test")] == 39
    assert found[(None, "train")] == 27
    expected = {}
    for name, ids in groups(rows).items():
        for place, i in enumerate(sorted(ids, key=key), start=1):
            n = len(ids)
            part = "train" if place <= (n * 70 + 50) // 100 else "val" if place <= (n * 85 + 50) // 100 else "test"
            expected[i] = part
    assert {r["id"]: r["split"] for r in split.collect()} == expected


def test_split_does_not_depend_on_layout(rows):
    one = sampling.stratified_split(rows.coalesce(1), "kind", "id").orderBy("id").collect()
    many = sampling.stratified_split(rows.repartition(13, "kind"), "kind", "id").orderBy("id").collect()
    assert one == many


def test_sample_per_class(rows):
    found = groups(sampling.sample_per_class(rows, "kind", 30, "id"))
    for name, ids in groups(rows).items():
        assert sorted(found[name]) == sorted(sorted(ids, key=key)[:30])


@pytest.mark.parametrize("n", [0, 1, 137, 1000, 5000])
def test_sample_rows_is_exact(rows, n):
    found = [r["id"] for r in sampling.sample_rows(rows, n, "id").collect()]
    assert sorted(found) == sorted(sorted(range(1000), key=key)[:n])


def test_head_is_in_seeded_order(rows):
    assert [r["id"] for r in sampling.shuffled_head(rows, 25, "id").collect()] == sorted(range(1000), key=key)[:25]
    assert [r["id"] for r in sampling.shuffled(rows, "id", 7).limit(5).collect()] == sorted(range(1000), key=lambda i: key(i, 7))[:5]


def test_places(rows):
    found = {r["id"]: r["place"] for r in sampling.seeded_places(rows, "id").collect()}
    assert [i for i, _ in sorted(found.items(), key=lambda x: x[1])] == sorted(range(1000), key=key)
    assert sorted(found.values()) == list(range(1, 1001))


def test_long_key_prefix_buckets_are_ranked(rows, monkeypatch):
    # With one-digit prefixes most rows share a bucket with a cut.
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", 1)
    short = sampling.stratified_split(rows, "kind", "id").orderBy("id").collect()
    monkeypatch.undo()
    assert short == sampling.stratified_split(rows, "kind", "id").orderBy("id").collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, kind string")
    assert sampling.stratified_split(df, "kind", "id").count() == 0
    assert sampling.sample_rows(df, 5, "id").count() == 0


def test_weights(rows):
    found = {r["kind"]: r["weight"] for r in sampling.balanced_weights(rows.filter("kind IS NOT NULL"), "kind").collect()}
    assert found["big"] == pytest.approx(962 / (3 * 700)) and found["tiny"] == pytest.approx(962 / 6)

import hashlib

from pyspark.sql import functions as F

from flowlake.llm import merkle
from flowlake.llm.queries import op13_slot_pivot

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes, fanout=3):
    """The root, and each node's steps: what stands before and behind it, level by level."""
    steps, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            run = at - at % fanout
            steps[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + fanout])))
        nodes = [digest("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
        places = [at // fanout for at in places]
    return nodes[0], steps


def brute(rows, fanout=3):
    import zlib

    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        below[name] = (own, *tree([leaf(r, r["text"]) for r in own], fanout))
    root, upper = tree([below[name][1] for name in names], fanout)
    out = []
    for name, top in zip(names, upper):
        own, subroot, steps = below[name]
        for row, path in zip(own, steps):
            path = path + top
            cut = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0
            at = leaf(row, row["text"].replace("\n", "") if cut and row["text"] is not None else row["text"])
            for before, behind in path:
                at = digest(before + at + behind)
            proof = digest("".join(a + b for a, b in path))
            out.append((row["doc_id"], leaf(row, row["text"]), subroot, root, proof, at, at == root))
    return out


def key(row):
    return tuple(str(v) for v in row)


def test_query_against_brute_force(spark, tmp_path):
    rows = [(i, f"s{i % 5 if i % 2 else 0}", "en", i, f"a{i}\nb" if i % 3 else "x") for i in range(95)]
    rows += [(None, None, None, None, None), (3, "", "de", 1, ""), (3, "", "de", 1, ""), (4, "ü", None, None, "ß\n\n€"), (6, "z", "fr", 2, "\n"), (7, "z", "fr", 2, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op13_slot_pivot(spark, str(tmp_path)).collect()), key=key)
    assert got == sorted(brute([r.asDict() for r in docs.collect()]), key=key)
    assert {r[-1] for r in got} == {True, False}


def test_lone_leaf_and_other_fanout(spark):
    rows = [(i, "a", "en", 1, "t") for i in range(1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    column = merkle.digest(F.col("text"))
    one = merkle.manifest(docs, "source", "doc_id", column, column).collect()
    assert [(r["leaf"], r["root"], r["proof_sha256"], r["verified"]) for r in one] == [(digest("t"), digest("t"), digest(""), True)]
    many = spark.createDataFrame([(i, "ab"[i % 2], "en", 1, f"t{i}") for i in range(23)], SCHEMA)
    got = merkle.manifest(many, "source", "doc_id", column, column, fanout=4).collect()
    root, _ = tree([tree([digest(f"t{i}") for i in range(s, 23, 2)], 4)[0] for s in (0, 1)], 4)
    assert {r["root"] for r in got} == {root} and all(r["verified"] for r in got) and len(got) == 23


def test_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([], SCHEMA + ", tree string, pos int, hash string, n int, proof string")
    assert merkle.manifest(docs, "source", "doc_id", F.sha2("text", 256), F.sha2("text", 256)).count() == 0
    rows = [(i, "a", "en", 1, "t\n" * 200_000, "x", 9, "y", 8, "z") for i in range(4)]
    docs = spark.createDataFrame(rows, SCHEMA + ", tree string, pos int, hash string, n int, proof string")
    got = merkle.manifest(docs, "source", "doc_id", F.sha2("text", 256), F.sha2(F.col("text").substr(1, 3), 256))
    assert [r["verified"] for r in got.collect()] == [False] * 4

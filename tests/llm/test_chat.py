from flowlake.llm import chat
from flowlake.llm.queries import SQL, op2_perspective_rotation
from tests.compare import difference


def test_three_speakers():
    turns = [("system", "be kind"), ("ann", "hi"), ("bob", "yo <|im_end|>"), ("cat", ""), ("ann", "bye")]
    text, mask = chat.render(turns, "ann")
    assert text == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\nyo <| im_end|><|im_end|>\n"
        "<|im_start|>user name=cat\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
    )
    assert [text[a:b] for a, b in mask] == ["hi<|im_end|>", "bye<|im_end|>"]


def test_query_against_sql(spark, folder, con):
    assert difference(op2_perspective_rotation(spark, folder), con, SQL["op2_perspective_rotation"]) is None


def test_segments_join_to_the_whole(spark, monkeypatch):
    turns = [(7, i, "ann" if i % 3 else "bob" if i < 20 else "system", f"t{i} <|im_end|>") for i in range(40)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    unsegmented = chat.perspectives(frame).collect()
    whole = {r["perspective"]: r["text"] for r in unsegmented}
    monkeypatch.setattr(chat, "SEGMENT", 6)
    parts = {}
    for r in sorted(chat.perspectives(frame).collect(), key=lambda r: r["segment"]):
        parts.setdefault(r["perspective"], []).append(r["text"])
    assert {who: "".join(p) for who, p in parts.items()} == whole and len(parts["ann"]) == 7
    # Starts and masks count from the dialogue's beginning.
    masks = {r["perspective"]: [tuple(m) for m in r["mask"]] for r in unsegmented}
    rows = sorted(chat.perspectives(frame).collect(), key=lambda r: r["segment"])
    for who in whole:
        mine = [r for r in rows if r["perspective"] == who]
        assert [tuple(m) for r in mine for m in r["mask"]] == masks[who]
        assert all(whole[who][r["start"]:r["start"] + len(r["text"])] == r["text"] for r in mine)


def test_odd_rows(spark):
    schema = "conv_id int, turn int, role string, text string, perspective string, mask int"
    frame = spark.createDataFrame([(None, 0, "a", "x", "p", 1), (None, None, None, None, "p", 1), (1, 0, "system", "only", "p", 1), (2, 0, "a", "x", "p", 1), (2, 0, "a", "x", "p", 1)], schema)
    got = sorted(((r["conv_id"] or 0, r["perspective"], r["segment"], r["n_turns"], len(r["mask"])) for r in chat.perspectives(frame).collect()))
    assert got == [(0, "a", -1, 1, 0), (0, "a", 0, 1, 1), (0, "unknown", -1, 1, 1), (0, "unknown", 0, 1, 0), (2, "a", 0, 2, 2)]
    assert chat.perspectives(frame.limit(0)).count() == 0

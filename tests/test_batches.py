"""Commits, snapshots and merging: what readers and followers see while the table changes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlake import contract
from flowlake.operators.quality import BETWEEN, IN_SET, NOT_NULL, Expectation, broken_rules
from flowlake.registry.core import add_rule_score
from flowlake.sources import batches, readers
from flowlake.streaming import gold, ingest
from tests.test_streams import event, publish

SCHEMA = contract.silver_schema()


def silver(spark, root):
    return ingest.read_silver(spark, root)


def parts(flows, n):
    return [flows.filter(F.pmod(F.xxhash64("event_id"), F.lit(n)) == k) for k in range(n)]


def test_commit_is_whole_or_not_at_all(spark, tmp_path):
    store = batches.Store(spark, str(tmp_path))
    name = f"{tmp_path}/_manifests/a-0.json"
    assert store.commit(name, {"x": 1}) and not store.commit(name, {"x": 2})
    assert store.read(name) == {"x": 1} and store.names(f"{tmp_path}/_manifests") == ["a-0.json"]
    assert not [p for p in (tmp_path / "_manifests").iterdir() if "a-0" in p.name and p.name not in ("a-0.json", ".a-0.json.crc") and not p.name.endswith(".crc")]


def test_a_manifest_seen_early_is_not_lost(spark, flows, tmp_path, monkeypatch):
    """A follower that looks between the writing of the rows and the commit takes the batch at the next look."""
    root, commit = str(tmp_path), batches.Store.commit
    step = gold.scoring_batch_writer(add_rule_score, f"{root}/predictions", f"{root}/alerts")
    follow = lambda: ingest.finish([gold.start_follower(spark, f"{root}/silver", step, f"{root}/progress")])
    seen = []

    def slow(self, name, content):
        if "/silver/" in name and not seen:
            # The file is there under its hidden name, as while it is being written.
            folder, _, last = name.rpartition("/")
            self.files.create(self.hadoop(f"{folder}/.{last}.half"), True).close()
            seen.append(name)
            follow()
            assert gold.read_predictions(spark, f"{root}/predictions").count() == 0
            assert silver(spark, f"{root}/silver").count() == 0
        return commit(self, name, content)

    monkeypatch.setattr(batches.Store, "commit", slow)
    batches.write_batch(flows, f"{root}/silver", 0, ["attack_type"])
    follow()
    assert gold.read_predictions(spark, f"{root}/predictions").count() == flows.count() == silver(spark, f"{root}/silver").count()


def test_what_a_crash_left_is_not_read(spark, flows, tmp_path):
    root = f"{tmp_path}/t"
    batches.write_batch(flows.limit(30), root, 0, ["attack_type"])
    flows.limit(50).write.partitionBy("attack_type").parquet(batches.batch_folder(root, "batch", 1))
    assert silver(spark, root).count() == 30 and not batches.is_committed(spark, root, "batch", 1)
    batches.write_batch(flows.limit(40), root, 1, ["attack_type"])
    assert silver(spark, root).count() == 70
    with pytest.raises(ValueError, match="not committed"):
        batches.read_batch(spark, root, SCHEMA, "batch", 2)


def test_merged_table_reads_equal(spark, flows, tmp_path):
    root, pieces = f"{tmp_path}/t", parts(flows, 6)
    ids = lambda: sorted(r[0] for r in silver(spark, root).select("event_id").collect())
    for k in range(3):
        batches.write_batch(pieces[k], root, k, ["attack_type"], stream="a")
    early = silver(spark, root)
    before = ids()
    assert batches.merge_batches(spark, root, SCHEMA, ["attack_type"])
    assert ids() == before and early.count() == len(before)
    batches.write_batch(pieces[3], root, 3, ["attack_type"], stream="a")
    batches.write_batch(pieces[4], root, 0, ["attack_type"], stream="b-with-dash")
    batches.write_batch(pieces[0], root, 0, ["attack_type"], stream="a")  # a replay of a merged batch
    assert len(ids()) == sum(p.count() for p in pieces[:5])
    assert batches.merge_batches(spark, root, SCHEMA, ["attack_type"], fold=True)
    assert not batches.merge_batches(spark, root, SCHEMA, ["attack_type"])
    snapshot, rest = batches.live(spark, root)
    assert snapshot.version == 2 and len(snapshot.folders) == 1 and rest == []
    assert snapshot.batches == {"a": [[0, 3]], "b-with-dash": [[0, 0]]}
    assert batches.remove_merged(spark, root, keep=0) > 5
    assert len(ids()) == sum(p.count() for p in pieces[:5]) == len(set(ids()))
    one = batches.read_batch(spark, root, SCHEMA, "b-with-dash", 0)
    assert sorted(r[0] for r in one.select("event_id").collect()) == sorted(r[0] for r in pieces[4].select("event_id").collect())
    plan = silver(spark, root).filter("attack_type = 'UDPFlood'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(attack_type" in plan


def test_merging_beside_a_stream(spark, flows, tmp_path):
    """A follower that starts again finds batches that were merged and removed meanwhile."""
    root, pieces = str(tmp_path), parts(flows, 4)
    step = gold.scoring_batch_writer(add_rule_score, f"{root}/predictions", f"{root}/alerts")
    follow = lambda: ingest.finish([gold.start_follower(spark, f"{root}/silver", step, f"{root}/progress", max_batches=1)])
    for k in (0, 1):
        batches.write_batch(pieces[k], f"{root}/silver", k, ["attack_type"])
    follow()
    for k in (2, 3):
        batches.write_batch(pieces[k], f"{root}/silver", k, ["attack_type"])
    assert batches.merge_batches(spark, f"{root}/silver", SCHEMA, ["attack_type"])
    batches.remove_merged(spark, f"{root}/silver", keep=0)
    follow()
    found = gold.read_predictions(spark, f"{root}/predictions")
    assert found.count() == flows.count() == found.select("event_id").distinct().count()


def test_a_lost_merge_changes_nothing(spark, flows, tmp_path, monkeypatch):
    root, commit = f"{tmp_path}/t", batches.Store.commit
    for k in range(2):
        batches.write_batch(flows.limit(20), root, k, ["attack_type"])

    def beaten(self, name, content):
        if "_snapshots" in name:
            commit(self, name, {"version": 1, "folders": [], "batches": {}})
        return commit(self, name, content)

    monkeypatch.setattr(batches.Store, "commit", beaten)
    assert not batches.merge_batches(spark, root, SCHEMA, ["attack_type"])
    assert silver(spark, root).count() == 40 and batches.Store(spark, root).names(f"{root}/_merged") == []


def test_empty_table(spark, tmp_path):
    assert silver(spark, f"{tmp_path}/none").count() == 0
    assert not batches.merge_batches(spark, f"{tmp_path}/none", SCHEMA) and batches.remove_merged(spark, f"{tmp_path}/none") == 0


def test_quarantine(spark, flows, tmp_path):
    """Each row once, on one side, with the rules it breaks; a replay adds nothing."""
    suite = [Expectation(NOT_NULL, "dTtl"), Expectation(BETWEEN, "Dur", minimum=1), Expectation(IN_SET, "Proto", values=("tcp",)), Expectation(NOT_NULL, "absent")]
    step = ingest.quarantine_batch_writer(str(tmp_path), suite[:3])
    for batch in (0, 1, 0):
        step(flows.filter(F.col("is_tcp") == batch), batch)
    step(flows.limit(0), 2)
    good, bad = ingest.read_valid(spark, str(tmp_path)), ingest.read_quarantine(spark, str(tmp_path))
    assert good.filter("dTtl IS NULL OR Dur < 1 OR Proto <> 'tcp'").count() == 0
    assert good.count() + bad.count() == flows.count() and bad.filter("size(broken_rules) = 0").count() == 0
    row = bad.filter("dTtl IS NULL AND Dur < 1 AND Proto <> 'tcp'").first()
    assert row["broken_rules"] == [f"{e.kind}({e.column})" for e in suite[:3]]
    every = flows.select(broken_rules(suite, flows.columns).alias("b")).filter(F.array_contains("b", f"{NOT_NULL}(absent)"))
    assert every.count() == flows.count() and flows.select(broken_rules([], [])).first()[0] == []


def test_ids_over_batches_and_restarts(spark, tmp_path):
    root = str(tmp_path)
    run = lambda: ingest.finish([ingest.start_id_watch(readers.event_stream(spark, "json", f"{root}/topic", max_files=1), f"{root}/again", f"{root}/progress", None)])
    found = lambda: sorted(r["event_id"] for r in ingest.read_repeated_ids(spark, f"{root}/again").collect())
    publish(spark, f"{root}/topic", [event(0), event(1), event(2), event(2), "junk"])
    run()
    assert found() == ["e2"]
    publish(spark, f"{root}/topic", [event(1), event(3), event(2)])
    run()
    publish(spark, f"{root}/topic", [event(1), event(4)])
    run()
    assert found() == ["e1", "e2"]
    # Days later the first ids are forgotten; what comes again then is new.
    late = "2024-02-05T10:00:00.000+00:00"
    for k in (10, 11, 12):
        publish(spark, f"{root}/topic", [event(k, ingestion_timestamp=late)])
        run()
    publish(spark, f"{root}/topic", [event(3, ingestion_timestamp=late)])
    run()
    assert found() == ["e1", "e2"]


def test_cache_follows_its_input_files(spark, tmp_path):
    capture, root, built = f"{tmp_path}/capture", f"{tmp_path}/cache", []

    def load():
        return readers.load_or_build(spark, root, lambda: built.append(1) or spark.read.csv(capture), inputs=(capture,)).count()

    spark.range(5).write.csv(capture)
    assert (load(), load(), len(built)) == (5, 5, 1)
    spark.range(7).write.mode("overwrite").csv(capture)
    assert (load(), len(built)) == (7, 2)


def test_headers_are_read_without_a_scan(spark, tmp_path):
    for name, text in (("a.csv", "x,y\n1,2\n"), ("b.csv", "y,x\n1,2\n"), ("c.csv", "x,y\n"), ("d.csv", ""), ("_e.csv", "z\n")):
        (tmp_path / name).write_text(text)
    spark.createDataFrame([("x,y\n3,4",)], "t string").coalesce(1).write.option("compression", "gzip").text(f"{tmp_path}/packed")
    groups = readers.capture_groups(spark, str(tmp_path))
    assert sorted(sorted(f.rsplit("/", 1)[1][:1] for f in g) for g in groups) == [["a", "c", "p"], ["b"]]


def test_the_failure_of_one_stream_stops_the_others(spark, tmp_path):
    """Also of the second, while the first would go on for ever."""
    publish(spark, f"{tmp_path}/topic", [event(0)])
    stream = lambda: readers.event_stream(spark, "json", f"{tmp_path}/topic")
    endless = ingest.start_raw_sink(stream(), f"{tmp_path}/raw", f"{tmp_path}/one", "1 second")

    def fail(batch, number):
        raise ValueError("no such luck")

    failing = stream().writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_path}/two").start()
    with pytest.raises(Exception, match="no such luck"):
        ingest.finish([endless, failing], seconds=2)
    assert not endless.isActive


class _State:
    """A group's state between calls, as the stream keeps it."""

    def __init__(self):
        self.value, self.timeout, self.watermark, self.hasTimedOut = None, None, 0, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = self.timeout = None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, at):
        assert at >= self.watermark
        self.timeout = at


def test_a_group_remembers_each_of_its_ids():
    """Ids of one group are reported, kept and forgotten one by one, and times keep their microseconds."""
    rng, state, log, told = np.random.default_rng(0), _State(), {}, []
    ids = [f"e{i}" for i in range(30)]
    for batch in range(60):
        state.watermark = batch * 40
        if batch % 7 == 6:  # a batch without rows of the group
            if state.timeout is not None and state.timeout < state.watermark:
                state.hasTimedOut = True
                assert list(ingest._watch_ids((0,), iter([]), state)) == []
                state.hasTimedOut = False
            log = {i: x for i, x in log.items() if x[2] >= state.watermark}
            assert state.timeout == (min(x[2] for x in log.values()) if log else None)
            continue
        seen = rng.choice(ids, rng.integers(1, 6))
        times = 1_000_001 * (state.watermark + rng.integers(1, 100, len(seen))).astype("int64") // 1000 * 1000
        frame = pd.DataFrame({"event_id": seen, "seen": pd.to_datetime(times)})
        got = [r for out in ingest._watch_ids((0,), iter([frame[:2], frame[2:]]), state) for r in out.itertuples(index=False)]
        want = {}
        for i in set(seen):
            own = times[seen == i]
            first, last, _, logged = log.get(i, (own.min(), own.max(), 0, False))
            again = i in log or len(own) > 1
            if again and not logged:
                want[i] = (first, own.max(), len(own))
            last = max(last, own.max())
            log[i] = (first, last, max(last // 1_000_000, state.watermark) + 1, logged or again)
        log = {i: x for i, x in log.items() if i in seen or x[2] >= state.watermark}
        assert {r.event_id: (r.first_seen.value, r.seen_again.value, r.batch_rows) for r in got} == want
        told += want
    assert len(told) > len(set(told)) > 10  # some were forgotten and reported anew


def test_many_ids_make_few_calls(spark, tmp_path, monkeypatch):
    """A call per id costs milliseconds, so ids are watched in groups."""
    monkeypatch.setattr(ingest, "ID_GROUPS", 4)
    ids = spark.range(5000).select(F.col("id").cast("string").alias("event_id"), F.lit("2024-02-05 10:00:00").cast("timestamp").alias("ingestion_timestamp"))
    ids.union(ids.filter("event_id < '2'")).repartition(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.repeated_ids(spark.readStream.schema(ids.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("few_calls").outputMode("append").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("few_calls").count() == ids.filter("event_id < '2'").count()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) == 4

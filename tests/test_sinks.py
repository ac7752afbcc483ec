"""Tables under one commit, the ordered topic, stream metrics, versions of keyed tables, and retention by folder names."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from editflow.sources import lake
from editflow.sources.versioned import Conflict, VersionedTable
from editflow.streaming import progress, sinks, streams

T0 = datetime(2024, 3, 1)


def test_a_batch_cut_off_midway_is_not_seen_and_its_replay_changes_nothing(spark, tmp_path):
    root, path, checkpoint = (str(tmp_path / x) for x in ("root", "in", "checkpoint"))
    broken = {"on": False}

    def second(batch):
        if broken["on"]:
            raise RuntimeError("cut off")
        return batch.where("id % 2 = 1")

    tables = {"all": lambda b: b, "odd": second}
    schema = spark.range(1).schema
    run = lambda: streams.run_to_end(streams.table_reader(path, schema)(spark), checkpoint, sinks.tables_sink(root, tables))
    seen = lambda name: sorted(r.id for r in sinks.read_committed(spark, root, name, schema).collect())
    spark.range(5).write.mode("append").parquet(path)
    assert seen("all") == []
    run()
    assert seen("all") == [0, 1, 2, 3, 4] and seen("odd") == [1, 3]
    spark.range(5, 8).write.mode("append").parquet(path)
    broken["on"] = True
    with pytest.raises(Exception, match="cut off"):
        run()
    assert seen("all") == [0, 1, 2, 3, 4]  # the first table has it, but nobody reads it
    broken["on"] = False
    run()
    assert seen("all") == list(range(8)) and seen("odd") == [1, 3, 5, 7]
    sinks.tables_sink(root, tables)(spark.range(5, 8), 1)
    assert seen("all") == list(range(8))


def test_a_topic_keeps_the_order_of_keys(spark, tmp_path):
    root = str(tmp_path / "topic")
    write = sinks.topic_sink(root, 3, ("at",))
    batch = lambda rows: spark.createDataFrame(rows, "key string, value string, at int").select(F.encode("key", "UTF-8").alias("key"), "value", "at")
    first = [(f"k{i % 5}", f"v{i}", -i) for i in range(40)]
    write(batch(first), 0)
    write(batch([("k1", "later", 0), ("k9", "new", 0), (None, "no key", 1)]), 1)
    write(batch([("k1", "later", 0), ("k9", "new", 0), (None, "no key", 1)]), 1)  # a replay
    write(batch([]), 2)
    rows = sinks.read_topic(spark, root).collect()
    assert len(rows) == 43
    for p in {r.partition for r in rows}:
        assert sorted(r.offset for r in rows if r.partition == p) == list(range(sum(r.partition == p for r in rows)))
    of = lambda k: [r.value for r in sorted(rows, key=lambda r: r.offset) if r.key == k]
    assert of(b"k1") == [*[f"v{i}" for i in range(36, 0, -5)], "later"] and of(b"k9") == ["new"] and of(None) == ["no key"]
    assert all(len({r.partition for r in rows if r.key == k}) == 1 for k in {r.key for r in rows})


def test_runs_of_a_topic_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "topic")
    write = sinks.topic_sink(root, 2, ("at", "n"), run=8)
    n = 300
    rows = [(f"k{i % 5}", f"v{i:03}", None if i % 50 == 0 else i * 37 % 91, -i) for i in range(n)]
    batch = spark.createDataFrame(rows, "key string, value string, at int, n int").select(F.encode("key", "UTF-8").alias("key"), "value", "at", "n")
    write(batch, 0)
    write(batch, 1)
    got = sorted(((r.batch, r.partition, r.offset, r.value) for r in sinks.read_topic(spark, root).collect()))
    assert len(got) == 2 * n
    value = {v: (at is not None, at or 0, m) for _, v, at, m in rows}
    for p in (0, 1):
        mine = [g for g in got if g[1] == p]
        assert [g[2] for g in mine] == list(range(len(mine)))
        for b in (0, 1):
            found = [g[3] for g in mine if g[0] == b]
            assert found == sorted(found, key=value.get)


def test_metrics_of_a_running_stream(spark, tmp_path):
    path, log = str(tmp_path / "in"), str(tmp_path / "log")
    spark.range(10).write.parquet(path)
    counted = lambda s: progress.observe_counts(s, "ids", even=F.col("id") % 2 == 0, large=F.col("id") > 100)
    with progress.MetricsLog(spark, log, "watched"):
        for n in (0, 4):
            if n:
                spark.range(n).write.mode("append").parquet(path)
            streams.run_to_end(counted(streams.table_reader(path, spark.range(1).schema)(spark)), str(tmp_path / "c"), path=str(tmp_path / "out"), name="watched")
        streams.run_to_end(streams.table_reader(path, spark.range(1).schema)(spark), str(tmp_path / "c2"), path=str(tmp_path / "out2"), name="other")
    rows = spark.read.schema(progress.METRICS).parquet(log).orderBy("batch_id").collect()
    assert [(r.query, r.batch_id, r.rows, r.observed["ids.even"], r.observed["ids.large"]) for r in rows] == [("watched", 0, 10, "5", "0"), ("watched", 1, 4, "2", "0")]
    assert all(r.rows_per_second > 0 and r.duration_ms > 0 for r in rows)


def test_offsets_behind():
    source = lambda end, latest: {"endOffset": end, "latestOffset": latest}
    assert progress.offsets_behind({"sources": [source({"t": {"0": 5, "1": 7}}, {"t": {"0": 9, "1": 7}})]}) == 4
    assert progress.offsets_behind({"sources": [source('{"t":{"0":5}}', '{"t":{"0":6}}'), source({"u": {"0": 1}}, {"u": {"0": 3}})]}) == 3
    assert progress.offsets_behind({"sources": [source({"logOffset": 3}, None)]}) is None
    assert progress.offsets_behind({"sources": []}) is None
    row = progress.metrics_row({"name": "q", "batchId": 3, "timestamp": "t", "durationMs": {"triggerExecution": 500}, "sources": [{"numInputRows": 20}], "stateOperators": [{"numRowsTotal": 4}], "eventTime": {"watermark": "w"}})
    assert row == ("q", 3, "t", 20, 40.0, 500, "w", None, 4, {})


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                full = os.path.join(folder, name)
                out[full] = os.stat(full).st_mtime_ns
    return out


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"), ["page", "at"], F.to_date("at"))


def rows(spark, *some):
    return spark.createDataFrame([(p, T0 + timedelta(days=d), n, note) for p, d, n, note in some], "page string, at timestamp, n long, note string")


def test_a_merge_touches_only_its_parts(spark, table):
    assert table.merge(rows(spark)) == 0
    with pytest.raises(FileNotFoundError):
        table.read()
    table.merge(rows(spark, *[(f"p{i}", d, i, "old") for i in range(20) for d in range(5)]))
    before = files(table.path)
    assert table.merge(rows(spark, ("p3", 2, 100, None), ("new", 2, 7, "x"), ("late", 9, 1, "y")), keep_old=["n"], fill=["note"]) == 2
    after = files(table.path)
    assert all(after[f] == t for f, t in before.items())  # nothing is rewritten in place
    found = {(r.page, r.at.day): (r.n, r.note) for r in table.read().collect()}
    assert len(found) == 102 and found["p3", 3] == (3, "old") and found["new", 3] == (7, "x") and found["late", 10] == (1, "y")
    used = {f.split("/data/")[1].split("/")[0] for f in files(table.path)}
    assert len(used) == 2
    # four of the five days are read from the files of the first merge
    reads = set(table.read().inputFiles())
    assert sum(f.removeprefix("file://") in before for f in reads) == sum("2024-03-03" not in f for f in before)
    table.vacuum(keep=1)
    left = files(table.path)
    assert {f for f in before if "2024-03-03" not in f} <= set(left) and not any("2024-03-03" in f for f in before if f in left)
    assert table.read().count() == 102


def test_versions_stay_and_writers_conflict(spark, table):
    table.merge(rows(spark, ("p", 0, 1, "a")))
    table.merge(rows(spark, ("p", 0, 2, "b")))
    assert table.read(1).first().n == 1 and table.read().first().n == 2
    table.version = lambda: 1  # a writer that began before the second merge
    with pytest.raises(Conflict):
        table.merge(rows(spark, ("p", 0, 3, "c")))
    del table.version
    assert table.read().first().n == 2


def test_too_many_parts_and_keys_without_one(spark, tmp_path):
    small = VersionedTable(spark, str(tmp_path / "t"), ["page", "at"], F.to_date("at"), most_parts=2)
    with pytest.raises(ValueError, match="more than 2"):
        small.merge(rows(spark, *[("p", d, 1, "a") for d in range(3)]))
    with pytest.raises(ValueError, match="no part"):
        small.merge(spark.createDataFrame([("p", None, 1, "a")], "page string, at timestamp, n long, note string"))


@pytest.mark.parametrize("layout", [lake.HOURLY, lake.HIERARCHICAL])
def test_retention_opens_the_cutoffs_folders_alone(spark, tmp_path, layout):
    path = str(tmp_path / "lake")
    table = spark.createDataFrame([(i, T0 + timedelta(minutes=7 * i), f"w {i % 2}:x") for i in range(400)], "event_id long, event_time timestamp, wiki string")
    lake.write_lake(table, path, layout)
    cutoff = T0 + timedelta(minutes=7 * 200 + 3)
    # files of other hours aren't opened: broken ones do no harm
    hour = lake.lake_files(spark, path, layout)
    slots = {r.path.removeprefix("file:"): tuple(r.slot) for r in hour.collect()}
    other = [f for f, slot in slots.items() if slot != lake._slot(cutoff, layout)]
    stamps = {f: os.stat(f).st_mtime_ns for f in other}
    older = [f for f, slot in slots.items() if slot < lake._slot(cutoff, layout)]
    with open(older[0], "wb") as f:
        f.write(b"not a table")
    for f in os.listdir(os.path.dirname(older[0])):
        if f.endswith(".crc"):
            os.remove(os.path.join(os.path.dirname(older[0]), f))
    schema = "event_id long, event_time timestamp, wiki string"
    lake.retain(spark, path, cutoff, layout)
    lake.retain(spark, path, cutoff, layout)
    assert sorted(r.event_id for r in spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(path).collect()) == list(range(201, 400))
    assert not any(os.path.exists(os.path.dirname(f)) for f in older)
    assert all(os.stat(f).st_mtime_ns == stamps[f] for f in other if f not in older)


def test_retention_empties_the_cutoffs_folder(spark, tmp_path):
    path = str(tmp_path / "lake")
    table = spark.createDataFrame([(1, T0, "a"), (2, T0 + timedelta(hours=2), "b"), (3, T0 + timedelta(minutes=50), "b")], "event_id long, event_time timestamp, wiki string")
    lake.write_lake(table, path)
    lake.retain(spark, path, T0 + timedelta(minutes=30))
    assert sorted(r.event_id for r in lake.read_lake(spark, path).collect()) == [2, 3]

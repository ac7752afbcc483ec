"""Streams over several batches: late rows, replays, and queries that go on from a checkpoint."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from editflow.operators.windows import Slide
from editflow.streaming import streams

T0 = datetime(2024, 3, 1)
EDIT = "event_id long, event_time timestamp, wiki string, page_title string, page_id long, user string, is_bot boolean, is_revert boolean, revision_id long, revert_target_revision_id long, byte_length_delta long, provenance_id string"
ONE = Slide(300, 300)


@pytest.fixture
def feed(spark, tmp_path):
    """Sends rows (id, seconds) as a batch of its own through an operator to a sink, and returns the query."""
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def send(rows, operate, write=None, out=None):
        table = spark.createDataFrame([(i, T0 + timedelta(seconds=s), "w", "P", 1, "u", False, False, i, None, 1, f"p{i}") for i, s in rows], EDIT)
        table.coalesce(1).write.mode("append").parquet(path)
        return streams.run_to_end(operate(streams.table_reader(path, table.schema)(spark)), checkpoint, write, out)

    return send


def test_state_is_carried_and_late_rows_are_dropped(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    closed = lambda s: streams.closed_windows(s, ONE, 60)
    feed([(1, 10), (2, 200)], closed, out=out)
    assert spark.read.schema("edit_count long").parquet(out).count() == 0
    feed([(3, 290), (4, 700)], closed, out=out)  # the first window goes on, and closes
    feed([(5, 100), (6, 720), (7, 1300)], closed, out=out)  # 5 is late: its window was closed
    got = {r.window_start: (r.edit_count, r.last_revision_id) for r in spark.read.parquet(out).collect()}
    assert got == {T0: (3, 3), T0 + timedelta(seconds=600): (2, 6)}


def test_replays_change_nothing(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    append = streams.keyed_append(out, ("event_id", "event_time"), "event_time")
    for rows in ([(1, 10), (2, 200)], [(2, 200), (3, 290)], [(1, 10), (3, 290), (3, 290)]):
        feed(rows, lambda s: s, append)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_duplicates_go_within_the_watermark_without_a_keyed_sink(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    for rows in ([(1, 10), (1, 10), (2, 20)], [(2, 20), (3, 30)]):
        feed(rows, lambda s: streams.dedupe(s, 600), out=out)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_triggers(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(5)
    rows.write.parquet(path)
    stream = streams.table_reader(path, rows.schema)(spark)
    query = streams.start(stream, str(tmp_path / "checkpoint"), path=out, processingTime="100 milliseconds")
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(out).agg(F.sum("id")).first()[0] == 10
    finally:
        query.stop()


def test_kafka_reader_sets_its_options():
    """The connector isn't on the class path: a stand-in for the session notes what is asked of it."""
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def option(self, name, value):
            asked[name] = value
            return self

        def options(self, **more):
            asked.update(more)
            return self

        def load(self):
            return self

        def selectExpr(self, *columns):
            asked["columns"] = columns
            return self

    class Session:
        readStream = Reader()

    streams.kafka_reader("h1:9092,h2:9092", "edits", "earliest", maxOffsetsPerTrigger="500")(Session())
    assert asked == {
        "format": "kafka", "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "edits", "startingOffsets": "earliest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "500", "columns": ("CAST(value AS STRING) AS value", "partition", "offset"),
    }

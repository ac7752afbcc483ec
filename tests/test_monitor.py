"""The page monitor over several batches, against the batch operators on the same rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from editflow.operators import conflict, trailing, windows
from editflow.operators.anomaly import Detector, evaluate
from editflow.operators.windows import Slide
from editflow.streaming import monitor, streams

T0 = datetime(2024, 3, 1)
EDIT = "event_id long, event_time timestamp, wiki string, page_title string, page_id long, user string, is_bot boolean, is_revert boolean, revision_id long, revert_target_revision_id long, byte_length_delta long, provenance_id string"
NEVER = Detector(ttl_seconds=None, min_history=2, history=5, fallback_count=3)


def edit(i, seconds, page="P", user="u", target=None, delta=1, revision=None):
    return (i, T0 + timedelta(seconds=seconds), "w", page, None if i % 3 else 7, user, i % 4 == 0, target is not None, i if revision is None else revision, target, delta, f"p{i}")


@pytest.fixture
def sent(spark, tmp_path):
    """Sends batches of rows through an operator, each to a query that goes on from the checkpoint, and returns all output."""
    count = iter(range(100))

    def send(batches, operate):
        n = next(count)
        path, out, checkpoint = (str(tmp_path / f"{x}{n}") for x in ("in", "out", "checkpoint"))
        for rows in batches:
            table = spark.createDataFrame(rows, EDIT)
            table.coalesce(1).write.mode("append").parquet(path)
            stream = operate(streams.table_reader(path, table.schema)(spark))
            streams.run_to_end(stream, checkpoint, path=out)
        return streams.table_or_empty(spark, out, stream.schema), checkpoint

    return send


def rounded(rows):
    return sorted(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)


@pytest.mark.parametrize("seed,slide", [(1, Slide(300, 60)), (2, Slide(120, 120)), (3, Slide(60, 20, 10))])
def test_windows_anomalies_and_wars_are_those_of_the_batch(spark, sent, seed, slide):
    """Rows out of order within the watermark, revisions written twice, blank names, several pages; whatever the batches."""
    r = random.Random(seed)
    rows, at = [], 0
    for i in range(160):
        at += r.choice([0, 1, 2, 5, 10])
        target = r.choice([None, *range(max(0, i - 4), i)])
        rows.append(edit(i, max(0, at - r.choice([0, 0, 20, 50])), r.choice("PPPPPQ"), r.choice(["a", "b", "a", "b", "c", "", None]), target, r.choice([-3, -1, 2, None]), r.choice([None, None, None, i - 2])))
    rows.append(edit(999, at + 10_000, "R"))
    cut = sorted(r.sample(range(1, 160), 3))
    got, _ = sent([rows[a:b] for a, b in zip([0, *cut], [*cut, None])], lambda s: monitor.monitor(s, slide, 60, NEVER))
    assert got.where("kind = 'late'").count() == 0
    table = spark.createDataFrame(rows, EDIT)
    closed = F.col("window_end") <= F.lit(T0 + timedelta(seconds=at + 10_000 - 60))
    activity = windows.page_activity(table, slide).where(closed)
    # a page's id may be any that the window has
    assert rounded(monitor.activity(got).drop("page_id").collect()) == rounded(activity.drop("page_id").collect())
    found = monitor.anomalies(got)
    wanted = evaluate(windows.page_activity(table, slide), NEVER).where(closed & (F.col("anomaly_type") != "none"))
    assert rounded(found.withColumn("anomaly_score", F.round("anomaly_score", 4)).collect()) == rounded(wanted.select(*found.columns).collect())
    wars = monitor.wars(got).drop("page_id")
    assert rounded(wars.collect()) == rounded(conflict.edit_wars(table, slide).where(closed).select(*wars.columns).collect()) and wars.count() > 0


def test_late_rows_are_reported_and_change_nothing(sent):
    batches = [[edit(1, 10, user="a"), edit(2, 20, user="b", target=1)], [edit(3, 700)], [edit(4, 30, user="a", target=2), edit(5, 620), edit(6, 2000)], [edit(7, 1990), edit(8, 650)]]
    got, _ = sent(batches, lambda s: monitor.monitor(s, Slide(300, 300), 60, NEVER))
    assert {r.event_id for r in got.where("kind = 'late'").collect()} == {4, 8}
    counts = {r.window_start: r.edit_count for r in monitor.activity(got).collect()}
    assert counts == {T0: 2, T0 + timedelta(seconds=600): 2}
    assert monitor.wars(got).count() == 0


def test_idle_pages_leave_the_state(spark, sent):
    idle = Detector(ttl_seconds=600, min_history=2, history=5, fallback_count=3)
    slide = Slide(300, 300)
    first = [edit(1, 10, "old"), edit(2, 20, "busy"), edit(3, 900, "busy")]
    got, checkpoint = sent([first], lambda s: monitor.monitor(s, slide, 60, idle))
    assert {r.page_title for r in monitor.pages_in_state(spark, checkpoint).collect()} == {"old", "busy"}
    more = [[edit(4, 1100, "busy")], [edit(5, 1300, "busy")], [edit(6, 1400, "old")], [edit(7, 2000, "busy")]]
    got, checkpoint = sent([first, *more[:2]], lambda s: monitor.monitor(s, slide, 60, idle))
    assert [(r.page_title, r.event_time) for r in got.where("kind = 'evicted'").collect()] == [("old", T0 + timedelta(seconds=10))]
    assert {r.page_title: r.last_edit for r in monitor.pages_in_state(spark, checkpoint).collect()} == {"busy": T0 + timedelta(seconds=1300)}
    # a page that comes back begins anew, as it does in the batch
    got, checkpoint = sent([first, *more], lambda s: monitor.monitor(s, slide, 60, idle))
    assert {r.page_title for r in monitor.pages_in_state(spark, checkpoint).collect()} == {"old", "busy"}
    assert [r.history_size for r in got.where("kind = 'window' AND page_title = 'old'").orderBy("window_start").collect()] == [0, 0]
    table = spark.createDataFrame([r for b in [first, *more] for r in b], EDIT)
    closed = F.col("window_end") <= F.lit(T0 + timedelta(seconds=1940))
    wanted = evaluate(windows.page_activity(table, slide), idle).where(closed).select("page_title", "window_start", "history_size")
    assert sorted(got.where("kind = 'window'").select(*wanted.columns).collect()) == sorted(wanted.collect())


def test_state_is_gone_with_the_windows_where_history_has_no_ttl(spark, sent):
    """Buckets go when no window needs them; what is left of a page is its history."""
    got, checkpoint = sent([[edit(i, 10 * i, user=f"u{i}") for i in range(50)], [edit(99, 5000)]], lambda s: monitor.monitor(s, Slide(300, 60), 60, NEVER))
    buckets = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "buckets").load()
    assert buckets.count() == 1 and monitor.activity(got).count() == 13


def test_bad_parameters(spark, tmp_path):
    spark.createDataFrame([edit(1, 1)], EDIT).write.parquet(str(tmp_path / "in"))
    stream = streams.table_reader(str(tmp_path / "in"), spark.createDataFrame([edit(1, 1)], EDIT).schema)(spark)
    with pytest.raises(ValueError):
        monitor.monitor(stream, Slide(300, 60), 120, Detector(ttl_seconds=419))
    with pytest.raises(ValueError):
        monitor.monitor(stream, Slide(300, 70), 120, NEVER)


def test_rows_behind_their_partitions_watermark(spark, sent):
    rows = [edit(i, s, p) for i, (s, p) in enumerate([(100, "0"), (500, "0"), (430, "0"), (439, "1"), (441, "0"), (900, "1"), (100, "1"), (839, "1"), (840, "1")])]
    mark = lambda s: monitor.mark_late(s.select("event_id", "event_time", F.col("page_title").alias("partition"), F.col("event_id").alias("offset")), 60)
    for batches in ([rows], [rows[:3], rows[3:7], rows[7:]], [[r] for r in rows]):
        got, _ = sent(batches, mark)
        assert {r.event_id: r.late for r in got.collect()} == {0: False, 1: False, 2: True, 3: False, 4: False, 5: False, 6: True, 7: True, 8: False}


@pytest.mark.parametrize("slide", [Slide(300, 30), Slide(120, 40, 7)])
def test_trailing_windows_are_sliding_windows(spark, slide):
    r = random.Random(4)
    rows = [edit(i, 5 * i + r.randint(0, 60), r.choice("PPQ"), r.choice(["a", "b", "a", "b", "", None]), r.choice([None, *range(max(0, i - 4), i)]), r.choice([-3, 2, None]), r.choice([None, None, None, i - 2])) for i in range(200)]
    table = spark.createDataFrame(rows, EDIT)
    got = trailing.trailing_evaluation(table, slide, NEVER)
    plain = evaluate(windows.page_activity(table, slide), NEVER)
    both = ["wiki", "page_title", "window_start", "window_end", "edit_count", "anomaly_type", "anomaly_score", "history_size"]
    assert rounded(got.select(*both).collect()) == rounded(plain.select(*both).collect())
    war = ["wiki", "page_title", "window_start", "window_end", "total_reverts", "edit_burst_count", "mutual_revert_count", "editor_a", "editor_b", "conflict_score", "flag"]
    assert rounded(got.select(*war).collect()) == rounded(conflict.edit_wars(table, slide, keep_all=True).select(*war).collect())
    assert got.where("mutual_revert_count > 0").count() > 5

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from editflow.operators import anomaly, conflict, upsert, windows
from editflow.operators.anomaly import Detector
from editflow.operators.conflict import ConflictRule
from editflow.operators.windows import Slide
from editflow.plans import audit, reports
from editflow.plans.reports import Filters
from editflow.streaming import monitor

T0 = datetime(2024, 1, 1)
EDIT = "event_id long, event_time timestamp, wiki string, page_title string, page_id long, user string, is_bot boolean, is_revert boolean, revision_id long, revert_target_revision_id long, byte_length_delta long, provenance_id string"


def edits(spark, rows):
    """rows: (seconds, user, revision, target, delta)."""
    return spark.createDataFrame([(i, T0 + timedelta(seconds=s), "w", "P", 1, u, False, t is not None, r, t, d, f"p{i}") for i, (s, u, r, t, d) in enumerate(rows)], EDIT)


def counted(spark, counts, gap=60):
    rows = [("w", "P", T0 + timedelta(seconds=gap * i), T0 + timedelta(seconds=gap * i + 300), c) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "wiki string, page_title string, window_start timestamp, window_end timestamp, edit_count long")


def last(spark, counts, **options):
    return anomaly.evaluate(counted(spark, counts), Detector(**options)).orderBy(F.desc("window_start")).first()


def test_sliding_windows(spark):
    rows = windows.page_activity(edits(spark, [(60, "a", 1, None, 5), (120, None, 2, None, None), (180, "a", 3, None, -2)])).orderBy("window_start").collect()
    assert [r.edit_count for r in rows] == [1, 2, 3, 3, 3, 2, 1]
    full = max(rows, key=lambda r: r.edit_count)
    assert (full.unique_editors, full.net_byte_delta, full.edit_velocity, full.last_revision_id) == (1, 3, 0.6, 3)
    assert windows.assign_windows(edits(spark, [(1000, "a", 1, None, 0)]), Slide(300, 60)).count() == 5
    assert windows.page_activity(edits(spark, [(1000, "a", 1, None, 0)]), Slide(60, 60)).count() == 1


@pytest.mark.parametrize(
    "counts, kind, median",
    [([1, 1, 20], "count_fallback", None), ([1, 1, 5], "none", None), ([11, 13, 12, 15, 12, 9, 12, 14, 31], "median_mad", 12.0), ([11, 13, 12, 15, 12, 9, 12, 14, 16], "none", 12.0), ([1] * 8 + [2], "none", 1.0), ([1] * 8 + [10], "median_mad", 1.0), ([8, 2, 7, 7, 900, 9, 7, 3, 10], "none", 7.0)],
)
def test_anomalies(spark, counts, kind, median):
    row = last(spark, counts)
    assert (row.anomaly_type, row.baseline_median) == (kind, median)


def test_mad_floor_and_ttl(spark):
    assert last(spark, [1] * 8 + [10]).anomaly_score == pytest.approx(0.6745 * 9, abs=1e-4)
    assert last(spark, [1] * 8 + [2], mad_floor=1e-6).anomaly_type == "median_mad"
    rows = anomaly.baselines(counted(spark, [1] * 10, gap=7200), Detector(ttl_seconds=7200)).collect()
    assert {r.history_size for r in rows} == {0}
    with pytest.raises(ValueError):
        Detector(history=4)


def test_false_anomalies_collapse_with_the_floor(spark):
    """Sparse pages: with a floor near 0 every second edit is an anomaly, with a floor of 1 none is."""
    rows = counted(spark, ([1] * 9 + [2]) * 6)
    flagged = lambda floor: anomaly.anomalies(rows, Detector(mad_floor=floor)).count()
    assert flagged(1e-6) >= 5 and flagged(1.0) == 0


def test_mutual_reverts(spark):
    one = Slide(300, 300)
    # three editors: mia and leo undo each other, once over an edit of neither, and zoe undoes leo alone
    course = [(3, "leo", 41, None, 12), (20, "kim", 42, None, 3), (31, "mia", 43, 41, -12), (50, "zoe", 44, None, 9), (64, "leo", 45, 43, 12), (71, "zoe", 46, 45, -12), (90, "mia", 47, 45, -1)]
    row = conflict.edit_wars(edits(spark, course), one).collect()
    assert [(r.mutual_revert_count, r.editor_a, r.editor_b, r.total_reverts, r.flag) for r in row] == [(3, "leo", "mia", 4, True)]
    for rows in ([(1, "A", 100, None, 0), (2, "B", 101, 100, 0), (3, "B", 102, 100, 0)], [(1, "A", 100, None, 0), (2, "A", 101, 100, 0)], [(2, "B", 101, 999, 0)]):
        assert conflict.edit_wars(edits(spark, rows), one).count() == 0
    burst = conflict.edit_wars(edits(spark, [(i, f"u{i}", i, None, -1) for i in range(8)]), one, keep_all=True).first()
    assert (burst.conflict_score >= 3, burst.flag) == (True, False)
    both = [(1, "A", 100, None, -5), (2, "B", 101, 100, -5), (3, "A", 102, 101, -5), (4, "A", 103, None, -1)]
    strict = conflict.edit_wars(edits(spark, both), one, ConflictRule(mutual_threshold=3)).first()
    assert (strict.mutual_revert_count, strict.conflict_score, strict.flag) == (2, 6.0, True)


def test_empty_tables(spark):
    none = edits(spark, [])
    assert windows.page_activity(none).count() == conflict.edit_wars(none).count() == anomaly.anomalies(windows.page_activity(none)).count() == 0
    assert reports.bot_vs_human(none).first().bot_percent is None


def test_summary(spark):
    row = audit.summarize(spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "x double"), F.col("x")).first()
    assert (row["count"], row.p50, row["max"], row["mean"]) == (3, 20.0, 30.0, 20.0)
    assert audit.summarize(spark.createDataFrame([], "x double"), F.col("x")).first().p50 is None
    assert audit.summarize(spark.range(1, 101), F.col("id")).first().p95 == 95.05


def test_filters(spark):
    rows = spark.createDataFrame([("w", "50%_off_sale", True), ("w", "50 off sale", False)], "wiki string, page_title string, is_bot boolean")
    assert reports.apply_filters(rows, Filters(page_search="50%_OFF")).count() == 1
    assert reports.apply_filters(rows, Filters(editor_type="bot")).count() == 1
    assert reports.apply_filters(rows.drop("is_bot"), Filters(editor_type="bot")).count() == 2
    with pytest.raises(ValueError):
        Filters(editor_type="cat")


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "p"), (2, "b", None)], "k int, v string, f string")
    new = spark.createDataFrame([(2, "B", "q"), (3, "c", None), (1, "A", None)], "k int, v string, f string")
    merged = upsert.merge_update(old, new, ["k"], keep_old=["v"], fill=["f"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a", "p"), (2, "b", "q"), (3, "c", None)]
    assert [r.k for r in upsert.insert_absent(old, new.unionByName(new), ["k"]).collect()] == [3]


def test_ttl_guard():
    monitor.check_ttl(Slide(300, 60), 120, 420)
    with pytest.raises(ValueError):
        monitor.check_ttl(Slide(300, 60), 120, 419)


def test_half_the_slide_makes_twice_the_windows(spark):
    rows = edits(spark, [(60 * i + 7, "a", i, None, 0) for i in range(50)])
    assert windows.assign_windows(rows, Slide(300, 30)).count() == 2 * windows.assign_windows(rows, Slide(300, 60)).count()

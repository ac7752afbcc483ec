"""The edits that queries and tests are made of."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from editflow.sources import fixtures


def test_reverts_undo_the_edit_before_across_hours(spark, tmp_path):
    rows = [(i, None if i % 50 == 3 else f"2024-01-0{1 + i % 3} 0{i % 4}:00:0{i % 5}", i % 7, ("error", "view", "click")[i % 3], 50.0, None if i % 40 == 7 else f'{{"k": {i % 23}}}') for i in range(400)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    edits = fixtures.edits(spark, str(tmp_path))
    before = F.lag("revision_id").over(Window.partitionBy("wiki", "page_title").orderBy("event_time", "event_id"))
    plain = fixtures.edits(spark, str(tmp_path), targets=False).withColumn("revert_target_revision_id", F.when(F.col("is_revert"), before))
    got = {r.event_id: r.revert_target_revision_id for r in edits.collect()}
    assert len(got) == 400 and got == {r.event_id: r.revert_target_revision_id for r in plain.collect()}


def test_no_window_of_edits_holds_a_whole_page(spark):
    plan = fixtures.edits(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in plan.splitlines() if "Window [" in line]
    assert over and all("event_time" not in line or "__hour" in line for line in over)

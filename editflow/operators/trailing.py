"""Trailing windows: every page each tick over what lies behind it, with both detectors.

A window per tick that is much longer than a tick would copy each event many
times.  Here events are added up by ticks first, and sums are dealt to the
windows; a revert is joined to its author once, whatever the windows, and the
edge knows the windows that hold both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .anomaly import Detector, evaluate
from .conflict import KEY, ConflictRule, mutual_pairs
from .windows import Slide


def _tick(slide: Slide, time: Column) -> Column:
    """The end of the tick that a time in microseconds lies in: the first window end behind it."""
    step, offset = slide.slide * 1_000_000, slide.offset * 1_000_000
    return F.floor((time - offset) / step).cast("long") * step + step + offset


def _ends(slide: Slide, first: Column, last: Column) -> Column:
    """Window ends from first to last, both at ticks."""
    return F.explode(F.when(first <= last, F.sequence(first, last, F.lit(slide.slide * 1_000_000))))


def _windowed(rows: DataFrame, slide: Slide) -> DataFrame:
    end = F.col("end")
    return rows.withColumns({"window_start": F.timestamp_micros(end - slide.size * 1_000_000), "window_end": F.timestamp_micros(end)}).drop("end")


def trailing_activity(events: DataFrame, slide: Slide) -> DataFrame:
    """Counts of every page at each tick with an edit in the window behind it."""
    ticks = events.withColumn("__tick", _tick(slide, F.unix_micros("event_time"))).groupBy("wiki", "page_title", "__tick").agg(
        F.first("page_id", ignorenulls=True).alias("page_id"), F.count(F.lit(1)).alias("edit_count"), F.count_if("is_revert").alias("total_reverts"), F.count_if(F.col("byte_length_delta") < 0).alias("edit_burst_count")
    )
    tick = F.col("__tick")
    dealt = ticks.select("*", _ends(slide, tick, tick + (slide.size - slide.slide) * 1_000_000).alias("end"))
    sums = [F.sum(c).alias(c) for c in ("edit_count", "total_reverts", "edit_burst_count")]
    return _windowed(dealt.groupBy("wiki", "page_title", "end").agg(F.first("page_id", ignorenulls=True).alias("page_id"), *sums), slide).select(*KEY, "page_id", "edit_count", "total_reverts", "edit_burst_count")


def trailing_edges(events: DataFrame, slide: Slide) -> DataFrame:
    """Rows (KEY, src, dst, n): how often src reverted dst in the window behind each tick.

    The author of a revision is the last one the window has, so an author's row
    holds until the revision's next one: up to there windows end with it as last.
    """
    page, us, size = ["wiki", "page_title"], F.unix_micros("event_time"), slide.size * 1_000_000
    of_revision = Window.partitionBy(*page, "revision_id").orderBy("event_time", "event_id")
    authors = events.where(F.col("revision_id").isNotNull()).select(*page, "revision_id", F.col("user").alias("dst"), us.alias("written"), F.lead(us).over(of_revision).alias("rewritten"))
    authors = authors.where(F.nullif("dst", F.lit("")).isNotNull())
    undone = F.col("is_revert") & F.nullif("user", F.lit("")).isNotNull() & F.col("revert_target_revision_id").isNotNull()
    reverts = events.where(undone).select(*page, F.col("user").alias("src"), F.col("revert_target_revision_id").alias("revision_id"), us.alias("reverted"))
    near = (F.col("src") != F.col("dst")) & (F.abs(F.col("reverted") - F.col("written")) < size)
    # a window (end - size, end] of times t has t < end <= t + size
    last = F.least(F.col("written") + size, F.col("reverted") + size, F.col("rewritten"))
    both = reverts.join(authors, [*page, "revision_id"]).where(near)
    # the end of the tick before the last time is the last window end that isn't behind it
    dealt = both.select(*page, "src", "dst", _ends(slide, _tick(slide, F.greatest("written", "reverted")), _tick(slide, last) - slide.slide * 1_000_000).alias("end"))
    return _windowed(dealt.groupBy(*page, "src", "dst", "end").agg(F.count(F.lit(1)).alias("n")), slide).select(*KEY, "src", "dst", "n")


def trailing_evaluation(events: DataFrame, slide: Slide = Slide(300, 30), detector: Detector = Detector(), rule: ConflictRule = ConflictRule()) -> DataFrame:
    """Every page at each tick: its counts, how unusual they are against its ticks before, its strongest pair of mutual reverts, score and flag."""
    rows = evaluate(trailing_activity(events, slide), detector)
    best = F.min(F.struct((-F.col("mutual_reverts")).alias("k"), "editor_a", "editor_b"))
    pairs = mutual_pairs(trailing_edges(events, slide)).groupBy(*KEY).agg(best.alias("p")).select(*KEY, (-F.col("p.k")).alias("mutual_revert_count"), "p.editor_a", "p.editor_b")
    both = rows.join(pairs, KEY, "left").withColumn("mutual_revert_count", F.coalesce("mutual_revert_count", F.lit(0).cast("long")))
    burst = F.when(F.col("edit_burst_count") >= rule.burst_min, F.col("edit_burst_count")).otherwise(0)
    exact = F.col("mutual_revert_count") * rule.mutual_weight + burst * rule.burst_weight
    flag = (F.col("mutual_revert_count") >= rule.mutual_threshold) | ((F.col("mutual_revert_count") > 0) & (exact >= rule.score_threshold))
    return both.withColumns({"conflict_score": F.round(exact, 4), "flag": flag})

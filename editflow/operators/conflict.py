"""Reciprocal reverts between editors of a page within a window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import Slide, assign_windows

KEY = ["wiki", "page_title", "window_start", "window_end"]


@dataclass(frozen=True)
class ConflictRule:
    mutual_threshold: int = 2
    score_threshold: float = 3.0
    mutual_weight: float = 2.0
    burst_weight: float = 0.5
    burst_min: int = 4


def revert_edges(windowed: DataFrame) -> DataFrame:
    """Rows (KEY, src, dst, n): how often src reverted dst.  windowed has one row per event and window.

    The reverted author is the last one the window has for the target revision;
    nobody reverts themselves, and names are needed on both sides.  The join's
    key holds the window, which splits hot pages.
    """
    named = F.nullif("user", F.lit("")).isNotNull()
    authors = windowed.where(F.col("revision_id").isNotNull()).groupBy(*KEY, "revision_id").agg(F.max_by("user", F.struct("event_time", "event_id")).alias("dst"))
    authors = authors.where(F.nullif("dst", F.lit("")).isNotNull())
    reverts = windowed.where(F.col("is_revert") & named & F.col("revert_target_revision_id").isNotNull()).select(*KEY, F.col("user").alias("src"), F.col("revert_target_revision_id").alias("revision_id"))
    return reverts.join(authors, [*KEY, "revision_id"]).where(F.col("src") != F.col("dst")).groupBy(*KEY, "src", "dst").agg(F.count(F.lit(1)).alias("n"))


def mutual_pairs(edges: DataFrame) -> DataFrame:
    """Rows (KEY, editor_a, editor_b, mutual_reverts) for editors who reverted each other; a before b.

    Both directions of a pair meet in one group, so no self-join is needed.
    """
    a, b = F.least("src", "dst"), F.greatest("src", "dst")
    both = edges.groupBy(*KEY, a.alias("editor_a"), b.alias("editor_b")).agg(F.sum("n").alias("mutual_reverts"), F.countDistinct("src").alias("__directions"))
    return both.where(F.col("__directions") == 2).drop("__directions")


def edit_wars(events: DataFrame, slide: Slide = Slide(), rule: ConflictRule = ConflictRule(), keep_all: bool = False) -> DataFrame:
    """Windows with a mutual pair or a flag: totals, the strongest pair, conflict_score and flag."""
    return judge_windows(assign_windows(events, slide), rule, keep_all)


def judge_windows(windowed: DataFrame, rule: ConflictRule = ConflictRule(), keep_all: bool = False) -> DataFrame:
    """edit_wars over events that have their windows already."""
    totals = windowed.groupBy(*KEY).agg(
        F.first("page_id", ignorenulls=True).alias("page_id"), F.count_if("is_revert").alias("total_reverts"), F.count_if(F.col("byte_length_delta") < 0).alias("edit_burst_count")
    )
    # ties go to the smallest names: the least of (-count, a, b)
    pair = F.min(F.struct((-F.col("mutual_reverts")).alias("k"), "editor_a", "editor_b"))
    best = mutual_pairs(revert_edges(windowed)).groupBy(*KEY).agg(pair.alias("p")).select(*KEY, (-F.col("p.k")).alias("mutual_revert_count"), "p.editor_a", "p.editor_b")
    rows = totals.join(best, KEY, "left").withColumn("mutual_revert_count", F.coalesce("mutual_revert_count", F.lit(0).cast("long")))
    burst = F.when(F.col("edit_burst_count") >= rule.burst_min, F.col("edit_burst_count")).otherwise(0)
    exact = F.col("mutual_revert_count") * rule.mutual_weight + burst * rule.burst_weight
    flag = (F.col("mutual_revert_count") >= rule.mutual_threshold) | ((F.col("mutual_revert_count") > 0) & (exact >= rule.score_threshold))
    out = rows.withColumns({"conflict_score": F.round(exact, 4), "flag": flag})
    return out if keep_all else out.where((F.col("mutual_revert_count") > 0) | F.col("flag"))

"""Sliding windows of page and user activity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Slide:
    """Duration and slide of windows, in seconds; equal ones make tumbling windows."""

    size: int = 300
    slide: int = 60
    offset: int = 0

    def __post_init__(self):
        if self.size <= 0 or self.slide <= 0:
            raise ValueError("window and slide must be positive")

    def column(self, time: str = "event_time"):
        return F.window(time, f"{self.size} seconds", f"{self.slide} seconds", f"{self.offset} seconds")


def assign_windows(events: DataFrame, slide: Slide, time: str = "event_time") -> DataFrame:
    """Each event once for every window that covers it."""
    return events.select("*", slide.column(time).alias("window")).withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")


def page_activity(events: DataFrame, slide: Slide = Slide(), time: str = "event_time") -> DataFrame:
    """One row per wiki, page and window with an edit in it.

    Plain aggregates only, so a hot page is combined before the shuffle and no
    window's events are gathered.
    """
    bot = F.coalesce(F.col("is_bot"), F.lit(False))
    editor = F.nullif("user", F.lit(""))
    # streams have no distinct aggregates; a window's set of editors is bounded by its editors
    editors = F.size(F.collect_set(editor)).cast("long") if events.isStreaming else F.countDistinct(editor)
    minutes = slide.size / 60
    last = F.struct(time, "event_id")  # edits at one time have an order too
    grouped = events.groupBy(slide.column(time).alias("window"), "wiki", "page_title").agg(
        F.first("page_id", ignorenulls=True).alias("page_id"),
        F.count(F.lit(1)).alias("edit_count"),
        editors.alias("unique_editors"),
        F.count_if(~bot).alias("human_edits"),
        F.count_if(bot).alias("bot_edits"),
        F.count_if(F.coalesce(F.col("is_revert"), F.lit(False))).alias("revert_count"),
        F.sum(F.coalesce("byte_length_delta", F.lit(0))).alias("net_byte_delta"),
        F.max_by("revision_id", last).alias("last_revision_id"),
        F.max_by("provenance_id", last).alias("provenance_id"),
    )
    velocity = F.round(F.col("edit_count") / minutes, 4) if minutes > 0 else F.lit(0.0)
    return grouped.select("wiki", "page_title", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *grouped.columns[3:], velocity.alias("edit_velocity"))


def user_activity(events: DataFrame, slide: Slide = Slide(), time: str = "event_time") -> DataFrame:
    """One row per wiki, named user and window."""
    named = events.where(F.nullif("user", F.lit("")).isNotNull())
    grouped = named.groupBy(slide.column(time).alias("window"), "wiki", "user", F.coalesce("is_bot", F.lit(False)).alias("is_bot")).agg(
        F.count(F.lit(1)).alias("edit_count"), F.count_if("is_revert").alias("revert_count"), F.countDistinct("page_title").alias("pages_touched")
    )
    return grouped.select("wiki", "user", "is_bot", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "edit_count", "revert_count", "pages_touched")

"""Bounded reports over edits, activity windows, anomalies, conflicts and metrics.

Every look-back ends at ``as_of``, a literal, and every order is total, so that
a report over fixed data is one result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Filters:
    """minutes back from as_of, one wiki, a literal part of the title in any case, and all, human or bot editors."""

    minutes: int | None = None
    wiki: str | None = None
    page_search: str | None = None
    editor_type: str = "all"

    def __post_init__(self):
        if self.editor_type not in ("all", "human", "bot"):
            raise ValueError(f"unknown editor type: {self.editor_type}")
        if self.minutes is not None and self.minutes < 0:
            raise ValueError("minutes must not be negative")


def apply_filters(rows: DataFrame, filters: Filters, as_of: datetime | None = None, time_col: str = "event_time") -> DataFrame:
    """Tables without is_bot aren't filtered by editor type."""
    if filters.minutes is not None and as_of is not None:
        rows = rows.where(F.col(time_col) >= F.lit(as_of - timedelta(minutes=filters.minutes)))
    if filters.wiki:
        rows = rows.where(F.col("wiki") == filters.wiki)
    if filters.page_search:
        rows = rows.where(F.contains(F.lower("page_title"), F.lit(filters.page_search.lower())))
    if filters.editor_type != "all" and "is_bot" in rows.columns:
        rows = rows.where(F.col("is_bot") == (filters.editor_type == "bot"))
    return rows


def newest_time(rows: DataFrame, time_col: str = "event_time") -> datetime:
    """The default as_of: the newest time of the table; one value."""
    return rows.agg(F.max(time_col)).first()[0] or datetime(1970, 1, 1)


def top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def user_type_distribution(edits: DataFrame) -> DataFrame:
    return edits.groupBy(F.coalesce("user_type", F.lit("REGISTERED")).alias("user_type")).agg(F.count(F.lit(1)).alias("edits"), F.countDistinct("user").alias("unique_users"), F.count_if("is_revert").alias("reverts"), F.count_if("is_minor").alias("minor_edits"))


def edits_per(edits: DataFrame, unit: str, pages: bool = False) -> DataFrame:
    """Edits, human and bot, by minute or hour; with distinct pages on demand."""
    extra = [F.countDistinct("wiki", "page_title").alias("pages")] if pages else []
    return edits.groupBy(F.date_trunc(unit, "event_time").alias("bucket")).agg(F.count(F.lit(1)).alias("edits"), F.count_if(~F.col("is_bot")).alias("human_edits"), F.count_if("is_bot").alias("bot_edits"), *extra)


def pages_in_list(edits: DataFrame, titles: Sequence[str]) -> DataFrame:
    return edits.where(F.col("page_title").isin(list(titles))) if titles else edits.where(F.lit(False))


def hourly_edits_for_pages(edits: DataFrame, titles: Sequence[str]) -> DataFrame:
    return pages_in_list(edits, titles).groupBy(F.date_trunc("hour", "event_time").alias("bucket"), "page_title").agg(F.count(F.lit(1)).alias("edits"))


def bot_vs_human(edits: DataFrame) -> DataFrame:
    n, bots = F.count(F.lit(1)), F.count_if("is_bot")
    percent = lambda x: F.round(100.0 * x / F.nullif(n, F.lit(0)), 2)
    return edits.agg(bots.alias("bot_edits"), (n - bots).alias("human_edits"), n.alias("total_edits"), percent(bots).alias("bot_percent"), percent(n - bots).alias("human_percent"))


def anomaly_frequency(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(F.date_trunc("hour", "window_start").alias("bucket"), "anomaly_type").agg(F.count(F.lit(1)).alias("anomalies"))


def edit_war_trend(signals: DataFrame) -> DataFrame:
    return signals.groupBy(F.date_trunc("hour", "window_start").alias("bucket")).agg(F.count_if("flag").alias("flagged"), F.count(F.lit(1)).alias("signals"), F.max("conflict_score").alias("peak_score"))


def most_active_pages(edits: DataFrame, minutes: int, limit: int = 15) -> DataFrame:
    rows = edits.groupBy("wiki", "page_title").agg(F.count(F.lit(1)).alias("edits"), F.countDistinct("user").alias("editors"), F.count_if("is_bot").alias("bot_edits"), F.count_if("is_revert").alias("reverts"), F.max("event_time").alias("last_edit"))
    return top(rows.withColumn("edits_per_minute", F.round(F.col("edits") / minutes, 3)), limit, F.desc("edits"), F.asc("wiki"), F.asc("page_title"))


def most_mutual_reverts(signals: DataFrame, limit: int = 25) -> DataFrame:
    rows = signals.groupBy("wiki", "page_title").agg(F.sum("mutual_revert_count").alias("mutual_reverts"), F.count_if("flag").alias("flagged_windows"), F.max("conflict_score").alias("peak_score"), F.max("window_start").alias("last_window"))
    return top(rows.where(F.col("mutual_reverts") > 0), limit, F.desc("mutual_reverts"), F.asc("wiki"), F.asc("page_title"))


def pages_with_most_anomalies(anomalies: DataFrame, limit: int = 25) -> DataFrame:
    kind = lambda k: F.count_if(F.col("anomaly_type") == k)
    rows = anomalies.groupBy("wiki", "page_title").agg(F.count(F.lit(1)).alias("anomalies"), kind("median_mad").alias("median_mad"), kind("count_fallback").alias("count_fallback"), F.max("anomaly_score").alias("peak_score"), F.max("window_start").alias("last_anomaly"))
    return top(rows, limit, F.desc("anomalies"), F.asc("wiki"), F.asc("page_title"))


def top_editors(aggregates: DataFrame, limit: int = 25) -> DataFrame:
    rows = aggregates.groupBy("wiki", "user", "is_bot").agg(F.sum("edit_count").alias("edits"), F.sum("revert_count").alias("reverts"), F.sum("pages_touched").alias("pages_touched"))
    return top(rows, limit, F.desc("edits"), F.asc("wiki"), F.asc("user"), F.asc("is_bot"))


def average_throughput(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("component").agg(F.round(F.avg("throughput_per_sec"), 6).alias("throughput"), F.count(F.lit(1)).alias("reports"))


def latest(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The newest row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def latest_page_velocity(windows: DataFrame, limit: int = 15, since: datetime | None = None, filter_first: bool = True) -> DataFrame:
    """Pages by the velocity of their newest window; ``since`` bounds the windows before or after the newest is taken."""
    keep = (lambda df: df.where(F.col("window_start") >= F.lit(since))) if since is not None else (lambda df: df)
    newest = latest(keep(windows) if filter_first else windows, ["wiki", "page_title"], F.desc("window_start"))
    return top(newest if filter_first else keep(newest), limit, F.desc("edit_velocity"), F.asc("wiki"), F.asc("page_title"))

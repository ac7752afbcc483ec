"""Unusual activity of a page against its own recent windows, by median and MAD."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Detector:
    """Limits of the anomaly score; the defaults suit five-minute windows."""

    history: int = 48
    min_history: int = 8
    threshold: float = 3.5
    mad_floor: float = 1.0
    fallback_count: int = 15
    ttl_seconds: int | None = 7200

    def __post_init__(self):
        if self.min_history < 1 or self.history < self.min_history:
            raise ValueError("history must hold at least min_history windows")
        if self.mad_floor <= 0 or self.threshold <= 0 or self.fallback_count < 1:
            raise ValueError("floor, threshold and count must be positive")


def _middle(a: Column) -> Column:
    n = F.size(a)
    low, high = F.get(a, F.floor((n - 1) / 2).cast("int")), F.get(a, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def mad(values: Column, center: Column) -> Column:
    """Median of the distances from center; 0 for no values.  The sorted distances are bound once, as the one element of an array."""
    distances = F.sort_array(F.transform(values, lambda x: F.abs(x - center)))
    return F.coalesce(F.get(F.transform(F.array(distances), _middle), F.lit(0)), F.lit(0.0))


def with_epoch(windows: DataFrame, ttl_seconds: int | None) -> DataFrame:
    """Number the stretches of a page's history: a gap of at least ttl between window starts begins a new one."""
    if ttl_seconds is None:
        return windows.withColumn("epoch", F.lit(0).cast("long"))
    by_page = Window.partitionBy("wiki", "page_title").orderBy("window_start")
    gap = F.unix_micros("window_start") - F.unix_micros(F.lag("window_start").over(by_page))
    fresh = F.when(gap >= ttl_seconds * 1_000_000, 1).otherwise(0)
    return windows.withColumn("__fresh", fresh).withColumn("epoch", F.sum("__fresh").over(by_page)).drop("__fresh")


def baselines(windows: DataFrame, detector: Detector = Detector()) -> DataFrame:
    """windows with history_size, baseline_median and baseline_mad of the page's previous windows."""
    frame = Window.partitionBy("wiki", "page_title", "epoch").orderBy("window_start").rowsBetween(-detector.history, -1)
    count = F.col("edit_count").cast("double")
    rows = with_epoch(windows, detector.ttl_seconds).withColumns({"__history": F.collect_list(count).over(frame), "__median": F.percentile(count, F.lit(0.5)).over(frame)})
    median = F.coalesce("__median", F.lit(0.0))
    return rows.withColumns({"history_size": F.size("__history"), "baseline_median": median, "baseline_mad": mad(F.col("__history"), median)}).drop("__history", "__median", "epoch")


def evaluate(windows: DataFrame, detector: Detector = Detector()) -> DataFrame:
    """windows with anomaly_type (median_mad, count_fallback, none), anomaly_score, threshold_used and their baselines."""
    rows = baselines(windows, detector)
    short = F.col("history_size") < detector.min_history
    exact = 0.6745 * (F.col("edit_count") - F.col("baseline_median")) / F.greatest("baseline_mad", F.lit(detector.mad_floor))
    kind = F.when(short & (F.col("edit_count") >= detector.fallback_count), "count_fallback").when(~short & (exact >= detector.threshold), "median_mad").otherwise("none")
    return rows.withColumns({
        "anomaly_type": kind,
        "anomaly_score": F.when(short, F.col("edit_count").cast("double")).otherwise(F.round(exact, 4)),
        "threshold_used": F.when(short, float(detector.fallback_count)).otherwise(detector.threshold),
        "baseline_median": F.when(~short, F.col("baseline_median")),
        "baseline_mad": F.when(~short, F.col("baseline_mad")),
    })


def anomalies(windows: DataFrame, detector: Detector = Detector()) -> DataFrame:
    """The flagged windows only."""
    return evaluate(windows, detector).where(F.col("anomaly_type") != "none")

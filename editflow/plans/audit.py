"""Latency, provenance, counters and health of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X


def latency_waterfall(events: DataFrame) -> DataFrame:
    """events with ingestion, compute and end-to-end latencies in ms."""
    event, ingest, done = F.col("timestamp"), F.col("ingestion_timestamp"), F.col("processing_timestamp")
    return events.withColumns({"ingestion_latency_ms": X.latency_ms(ingest, event), "compute_latency_ms": X.latency_ms(done, ingest), "e2e_latency_ms": X.latency_ms(done, event)})


def fact_edit_events(edits: DataFrame, stored_at: Column) -> DataFrame:
    """The edit facts: ingestion falls back to the event, processing to the time of storage."""
    filled = edits.withColumns({"ingestion_timestamp": F.coalesce("ingestion_timestamp", "timestamp"), "processing_timestamp": F.coalesce("processing_timestamp", stored_at)})
    return latency_waterfall(filled)


def quantiles(rows: DataFrame, value: Column, shares: tuple[float, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """By group: rows, count, exact linear quantiles q0, q1, ... of value, max and mean; null without values.

    No task holds a group's values.  These are counted, dealt to ranges by their
    logarithm (64 to a doubling, so some thousands at most), and ranked within
    their range, behind what the ranges before it hold.
    """
    x, n = F.col("__x"), F.col("__n")
    counted = rows.select(*by, value.cast("double").alias("__x")).groupBy(*by, "__x").agg(F.count("__x").alias("__n"), F.count(F.lit(1)).alias("__rows"), F.sum("__x").alias("__sum"))
    counted = counted.withColumn("__range", F.signum(x) * F.floor(F.log2(F.abs(x) + 1) * 64))
    keys = [*by, "__range"]
    group = Window.partitionBy(*by)
    ranges = counted.groupBy(*keys).agg(F.sum(n).alias("__in_range"))
    before = F.sum("__in_range").over(group.orderBy("__range")) - F.col("__in_range")
    ranges = ranges.select(*[F.col(k).alias("__of_" + k) for k in keys], before.alias("__before"), F.sum("__in_range").over(group).alias("__total"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col("__of_" + k))
    upto = F.col("__before") + F.sum(n).over(Window.partitionBy(*keys).orderBy("__x"))
    ranked = counted.join(ranges, same).withColumn("__upto", upto)
    out = []
    for i, share in enumerate(shares):
        place = share * (F.col("__total") - 1)
        at = lambda rank: F.max(F.when((F.col("__upto") - n <= rank) & (rank < F.col("__upto")), x))  # noqa: E731, B023
        low, high, part = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
        out.append(F.when(low == high, low).otherwise((1 - part) * low + part * high).alias(f"q{i}"))
    return ranked.groupBy(*by).agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum(n), F.lit(0)).alias("count"), *out, F.max(x).alias("max"), (F.sum("__sum") / F.nullif(F.sum(n), F.lit(0))).alias("mean"))


def summarize(rows: DataFrame, value: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """count, p50, p95, p99 (linear), max and mean in three decimals; null without values."""
    found = quantiles(rows, value, (0.5, 0.95, 0.99), by)
    named = {"q0": "p50", "q1": "p95", "q2": "p99", "max": "max", "mean": "mean"}
    return found.select(*by, "count", *[F.round(c, 3).alias(name) for c, name in named.items()])


def latency_summary(facts: DataFrame) -> DataFrame:
    """One row: quantiles and mean of each latency in one decimal, and how many events had one."""
    names = ("ingestion", "compute", "e2e")
    each = facts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("latency"), F.col(f"{n}_latency_ms").cast("double").alias("ms")) for n in names])).alias("x")).select("x.*")
    found = quantiles(each, F.col("ms"), (0.5, 0.95, 0.99), ("latency",))
    of = lambda name, c: F.max(F.when(F.col("latency") == name, F.col(c)))
    out = [F.round(of(n, c), 1).alias(f"{n}_{what}") for n in names for c, what in (("q0", "p50"), ("q1", "p95"), ("q2", "p99"), ("mean", "avg"))]
    return found.agg(*out, F.coalesce(of(names[0], "rows"), F.lit(0)).alias("sampled_events"))


def ingestion_counters(routed: DataFrame) -> DataFrame:
    n = lambda what: F.count_if(F.col("route") == what)
    rate = F.round(n("rejected") / F.nullif(F.count(F.lit(1)), F.lit(0)), 6)
    return routed.agg(F.count(F.lit(1)).alias("received"), n("accepted").alias("parsed"), n("ignored").alias("ignored"), n("rejected").alias("rejected"), n("rejected").alias("dead_lettered"), rate.alias("dead_letter_rate"))


def errors_by_stage(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("stage").isNotNull()).groupBy("stage").agg(F.count(F.lit(1)).alias("errors"))


def error_map(routed: DataFrame) -> DataFrame:
    """One row: a map from stage to count, and the total."""
    return errors_by_stage(routed).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("stage", "errors")))).alias("errors_by_stage"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"))


def duplicate_windows(windows: DataFrame) -> DataFrame:
    """Rows beyond one per window key; must be 0.  Counted by group, not by a distinct of everything in one place."""
    return windows.groupBy("wiki", "page_title", "window_start", "window_end").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def throughput_between_reports(metrics: DataFrame) -> DataFrame:
    """Events parsed per second since the component's previous report.

    Reports are ordered by day; a day's first one follows the last of the
    component's day before, so that a long log is not one task's.
    """
    report = F.struct("recorded_at", "events_parsed")
    dated = metrics.withColumn("__day", F.to_date("recorded_at"))
    days = dated.groupBy("component", "__day").agg(F.max(report).alias("__last"))
    days = days.select(F.col("component").alias("__component"), F.col("__day").alias("__of"), F.lag("__last").over(Window.partitionBy("component").orderBy("__day")).alias("__earlier"))
    both = dated.join(days, F.col("component").eqNullSafe(F.col("__component")) & F.col("__day").eqNullSafe(F.col("__of")))
    inside = F.lag(report).over(Window.partitionBy("component", "__day").orderBy("recorded_at", "events_parsed"))
    both = both.withColumn("__previous", F.coalesce(inside, "__earlier"))
    seconds = (F.unix_micros("recorded_at") - F.unix_micros("__previous.recorded_at")) / 1_000_000
    rate = F.round((F.col("events_parsed") - F.col("__previous.events_parsed")) / F.nullif(seconds, F.lit(0.0)), 6)
    return both.select(*metrics.columns, rate.alias("throughput"))


def provenance_lookup(edits: DataFrame, anomalies: DataFrame, provenance: str) -> DataFrame:
    """The event with this provenance, else an anomaly in an event's shape; nothing for a blank id."""
    wanted = F.lit((provenance or "").strip())
    as_event = lambda df, kind, time, rank: df.where((F.col("provenance_id") == wanted) & (wanted != "")).select("provenance_id", F.lit(kind).alias("kind"), "wiki", "page_title", F.col(time).alias("at"), F.lit(rank).alias("__rank"))
    both = as_event(edits, "edit", "event_time", 0).unionByName(as_event(anomalies, "anomaly", "window_start", 1))
    return both.orderBy("__rank", "at").limit(1).drop("__rank")


def late_events(arrivals: DataFrame, delay_seconds: int, order: str = "offset", by: tuple[str, ...] = ("partition",), run: int = 1 << 16) -> DataFrame:
    """arrivals with `late`: older than the newest event before it, in its partition, less the delay.

    The newest time is found by runs of ``run`` offsets first, then within each
    run, so that a partition's log is not one task's.
    """
    in_runs = arrivals.withColumn("__run", F.floor(F.col(order) / run))
    newest = in_runs.groupBy(*by, "__run").agg(F.max("event_time").alias("__newest"))
    earlier = F.max("__newest").over(Window.partitionBy(*by).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1))
    keys = [*by, "__run"]
    newest = newest.select(*[F.col(k).alias("__of_" + k) for k in keys], earlier.alias("__earlier"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col("__of_" + k))
    inside = F.max("event_time").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    seen = F.unix_micros(F.greatest("__earlier", inside))
    late = F.coalesce(F.unix_micros("event_time") < seen - delay_seconds * 1_000_000, F.lit(False))
    return in_runs.join(newest, same).select(*arrivals.columns, late.alias("late"))


def idle_pages(edits: DataFrame, as_of: Column, ttl_seconds: int) -> DataFrame:
    """Pages with the time of their last edit and whether a sweep at as_of would evict them."""
    last = edits.groupBy("wiki", "page_title").agg(F.max("event_time").alias("last_edit"))
    return last.withColumn("evicted", F.unix_micros(as_of) - F.unix_micros("last_edit") >= ttl_seconds * 1_000_000)

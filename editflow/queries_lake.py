"""Queries that write tables, lakes and streams and read them back."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .operators import normalize, trailing, upsert, windows
from .operators.anomaly import Detector
from .plans import reports
from .queries import _W, _WAR, _WIN, DELAY, DETECTOR, QUERIES, SLIDE, SQL, TRAILING, _anomalies, _edits, _events, _wars, _windows, query
from .schemas import EDIT_KEY, WINDOW_KEY
from .sources import fixtures, lake
from .sources.tables import new_folder, stored
from .sources.versioned import VersionedTable
from .streaming import monitor, progress, sinks, streams

_LAKE_COLS = ["event_id", "event_time", "wiki", "page_title", "is_bot", "byte_length_delta"]


def _lake(spark, d, layout=lake.HOURLY, where=None):
    rows = _edits(spark, d).select(*_LAKE_COLS)
    path = new_folder(spark, "lake")
    lake.write_lake(rows.where(where) if where is not None else rows, path, layout)
    return path


# ---- lake


@query("lake_write_hourly", "SELECT event_id, wiki, strftime(event_time, '%Y-%m-%d') AS date, CAST(hour(event_time) AS BIGINT) AS hour FROM edits")
def _q(spark, d):
    return lake.read_lake(spark, _lake(spark, d), ["event_id", "wiki", "date", "hour"])


@query("lake_write_hierarchical", "SELECT event_id, wiki, CAST(year(event_time) AS BIGINT) AS year, CAST(month(event_time) AS BIGINT) AS month, CAST(day(event_time) AS BIGINT) AS day, CAST(hour(event_time) AS BIGINT) AS hour FROM edits")
def _q(spark, d):
    return lake.read_lake(spark, _lake(spark, d, lake.HIERARCHICAL), ["event_id", "wiki", "year", "month", "day", "hour"])


@query("lake_scan_columns", "SELECT event_id, page_title FROM edits WHERE byte_length_delta > 0")
def _q(spark, d):
    return lake.scan_files(spark, _lake(spark, d), ["event_id", "page_title"], "byte_length_delta > 0")


@query("lake_scan_partitioned", "SELECT event_id, page_title, wiki, CAST(hour(event_time) AS BIGINT) AS hour FROM edits WHERE wiki = 'wiki1' AND hour(event_time) BETWEEN 6 AND 9 AND is_bot")
def _q(spark, d):
    return lake.read_lake(spark, _lake(spark, d), ["event_id", "page_title", "wiki", "hour"], "wiki = 'wiki1' AND hour BETWEEN 6 AND 9 AND is_bot")


@query("lake_daily_counts", "SELECT strftime(event_time, '%Y-%m-%d') AS date, wiki, count(*) AS events FROM edits WHERE event_time >= DATE '2024-01-05' AND event_time < DATE '2024-01-16' GROUP BY 1, 2")
def _q(spark, d):
    return lake.daily_counts(lake.read_lake(spark, _lake(spark, d)), date(2024, 1, 5), date(2024, 1, 15))


@query("lake_write_stats", """SELECT count(*) AS rows, count(*) AS footer_rows, count(DISTINCT (wiki, CAST(event_time AS DATE), hour(event_time))) AS folders, min(event_id) AS least_id, max(event_id) AS greatest_id, min(byte_length_delta) AS least_delta,
  max(byte_length_delta) AS greatest_delta, CAST(0 AS BIGINT) AS nulls, CAST(sum(length(CAST(event_id AS VARCHAR)) + length(wiki) + 24) AS BIGINT) AS json_bytes, true AS sizes_agree FROM edits""")
def _q(spark, d):
    path = _lake(spark, d)
    stats, columns = lake.write_stats(lake.read_lake(spark, path)), lake.column_stats(spark, path)
    columns = columns.withColumnsRenamed({"files": "footer_files", "rows": "footer_rows"})
    folders = lake.lake_files(spark, path).agg(F.countDistinct("folder").alias("folders"))
    of = lambda name, c: F.max(F.when(F.col("column") == name, F.col(c)))
    ranges = lake.column_ranges(spark, path, ["event_id", "byte_length_delta"]).agg(
        of("event_id", "least").alias("least_id"), of("event_id", "greatest").alias("greatest_id"), of("byte_length_delta", "least").alias("least_delta"), of("byte_length_delta", "greatest").alias("greatest_delta"), F.sum("nulls").alias("nulls")
    )
    parts = stats
    for more in (columns, folders, ranges, lake.json_reduction(lake.read_lake(spark, path, ["event_id", "wiki"]))):
        parts = parts.unionByName(more, allowMissingColumns=True)
    both = parts.agg(*[F.max(c).alias(c) for c in parts.columns])  # one row of each
    saved = F.abs(F.col("saved_percent") - 100 * (1 - 1 / F.col("ratio"))) < 0.1
    agree = saved & (F.col("files") == F.col("footer_files")) & (F.col("compressed_bytes") < F.col("bytes")) & (F.col("bytes") == F.col("file_bytes"))
    return both.select("rows", "footer_rows", "folders", "least_id", "greatest_id", "least_delta", "greatest_delta", "nulls", "json_bytes", agree.alias("sizes_agree"))


@query("table_scan_since", "SELECT event_id, wiki FROM recent")
def _q(spark, d):
    rows = _edits(spark, d)
    path = new_folder(spark, "edits")
    rows.write.parquet(path)
    return reports.apply_filters(streams.table_or_empty(spark, path, rows.schema), reports.Filters(minutes=7 * 24 * 60), reports.newest_time(rows)).select("event_id", "wiki")


@query("drain_closed_hours", "SELECT event_id FROM edits, latest WHERE event_time < date_trunc('hour', as_of)")
def _q(spark, d):
    rows = _edits(spark, d)
    as_of = F.lit(reports.newest_time(rows))
    path = _lake(spark, d, lake.HIERARCHICAL, F.col("event_id") % 2 == 0)
    have = lake.read_lake(spark, path, ["event_id", "event_time"]).where(F.col("event_time") < F.date_trunc("hour", as_of))
    todo = lake.drain_closed_hours(rows.select(*_LAKE_COLS), have, as_of)
    lake.write_lake(todo, drained := new_folder(spark, "drain"), lake.HIERARCHICAL)
    return lake.read_lake(spark, drained, ["event_id"]).unionByName(have.select("event_id"))


@query("retention_split", "SELECT event_id, event_time >= as_of - INTERVAL 72 HOUR AS kept FROM edits, latest")
def _q(spark, d):
    rows = _edits(spark, d)
    return lake.retention_split(rows, F.lit(reports.newest_time(rows) - timedelta(hours=72))).select("event_id", "kept")


@query("retention_rewrite", "SELECT event_id, us AS event_time FROM edits, latest WHERE event_time >= as_of - INTERVAL 72 HOUR")
def _q(spark, d):
    path = _lake(spark, d)
    lake.retain(spark, path, reports.newest_time(_edits(spark, d)) - timedelta(hours=72))
    return lake.read_lake(spark, path, ["event_id", "event_time"])


@query("expired_days", "SELECT DISTINCT strftime(event_time, '%Y-%m-%d') AS day FROM edits, latest WHERE date_trunc('day', event_time) + INTERVAL 1 DAY <= as_of - INTERVAL 72 HOUR")
def _q(spark, d):
    rows = _edits(spark, d)
    return lake.expired_days(rows, F.lit(reports.newest_time(rows) - timedelta(hours=72)))


@query("archived_days", "SELECT strftime(event_time, '%Y-%m-%d') AS day, count(*) AS stored, count(*) AS archived FROM edits WHERE day(event_time) % 2 = 0 GROUP BY 1")
def _q(spark, d):
    path = _lake(spark, d, lake.HOURLY, (F.dayofmonth("event_time") % 2 == 0) | (F.col("event_id") % 3 == 0))
    return lake.archived_days(_edits(spark, d), lake.read_lake(spark, path, ["event_time"])).select("day", "stored", "archived")


@query("drain_before_drop", "SELECT event_id FROM edits, latest WHERE date_trunc('day', event_time) + INTERVAL 1 DAY <= as_of - INTERVAL 72 HOUR AND event_id % 2 = 1")
def _q(spark, d):
    rows = _edits(spark, d)
    have = lake.read_lake(spark, _lake(spark, d, lake.HOURLY, F.col("event_id") % 2 == 0), ["event_id"])
    return lake.drain_before_drop(rows, have, F.lit(reports.newest_time(rows) - timedelta(hours=72))).select("event_id")


@query("days_to_cover", "SELECT strftime(unnest(generate_series(date_trunc('day', as_of - INTERVAL 72 HOUR), date_trunc('day', as_of) + INTERVAL 3 DAY, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM latest")
def _q(spark, d):
    newest = _edits(spark, d).agg(F.max("event_time").alias("t"))
    return lake.days_to_cover(spark, F.col("t") - F.expr("INTERVAL 72 HOURS"), F.col("t"), 3, newest)


@query("missing_days", "SELECT strftime(unnest(generate_series(date_trunc('day', as_of) + INTERVAL 1 DAY, date_trunc('day', as_of) + INTERVAL 3 DAY, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM latest")
def _q(spark, d):
    rows = _edits(spark, d)
    newest = rows.agg(F.max("event_time").alias("t"))
    wanted = lake.days_to_cover(spark, F.col("t") - F.expr("INTERVAL 72 HOURS"), F.col("t"), 3, newest)
    return lake.missing_days(wanted, rows)


@query("partition_health", "SELECT count(*) AS overflow_rows, CAST(3 AS BIGINT) AS missing_days, 'CRITICAL' AS status FROM edits, latest WHERE event_time < date_trunc('day', as_of - INTERVAL 72 HOUR)")
def _q(spark, d):
    rows = _edits(spark, d)
    newest = rows.agg(F.max("event_time").alias("t"))
    return lake.partition_health(rows, lake.days_to_cover(spark, F.col("t") - F.expr("INTERVAL 72 HOURS"), F.col("t"), 3, newest))


# ---- keyed writes


def _versioned(spark, name, keys, part):
    return VersionedTable(spark, new_folder(spark, name), keys, part)


def _first_wins(target, rows, keys):
    return target.unionByName(upsert.insert_absent(target, rows, keys))


@query("upsert_edit_events", f"SELECT event_id, us AS event_time, CASE WHEN event_id % 2 = 0 THEN wiki ELSE 'new' END AS wiki FROM edits")
def _q(spark, d):
    rows = _edits(spark, d).select("event_id", "event_time", "wiki")
    new = rows.withColumn("wiki", F.lit("new"))
    return _first_wins(rows.where("event_id % 2 = 0"), new.unionByName(new), EDIT_KEY)


QUERIES["insert_if_absent"], SQL["insert_if_absent"] = QUERIES["upsert_edit_events"], SQL["upsert_edit_events"]


@query("upsert_activity_windows", f"SELECT wiki, page_title, {_W}, page_id, CASE WHEN edit_count % 3 = 0 THEN edit_count ELSE edit_count + 100 END AS edit_count, CASE WHEN edit_count % 3 = 0 OR edit_count % 2 = 0 THEN provenance_id ELSE 'new' END AS provenance_id FROM win WHERE NOT (edit_count % 3 <> 0 AND edit_count % 5 = 0) UNION ALL SELECT wiki, page_title, {_W}, page_id + 1, edit_count + 100, CASE WHEN edit_count % 2 = 1 THEN 'new' END FROM win WHERE edit_count % 3 <> 0 AND edit_count % 5 = 0")
def _q(spark, d):
    cols = [*WINDOW_KEY, "page_id", "edit_count", "provenance_id"]
    rows = _windows(spark, d).select(*cols)
    new = rows.where("edit_count % 3 <> 0").withColumns({"page_id": F.col("page_id") + 1, "provenance_id": F.when(F.col("edit_count") % 2 == 1, "new"), "edit_count": F.col("edit_count") + 100})
    table = _versioned(spark, "windows", WINDOW_KEY, F.to_date("window_start"))
    table.merge(rows.where("edit_count % 3 = 0 OR edit_count % 5 <> 0"))
    table.merge(new, keep_old=["page_id"], fill=["provenance_id"])
    return table.read()


@query("merge_update", "SELECT event_id, us AS event_time, wiki, CASE WHEN event_id % 10 = 0 THEN 'merged' ELSE page_title END AS page_title, event_id % 10 = 0 OR event_id % 3 = 0 AS is_bot FROM edits WHERE event_id % 5 = 0 OR event_id % 3 = 0")
def _q(spark, d):
    """The plain merge over two frames: every fifth edit wins over every third, and keeps what it doesn't know."""
    rows = _edits(spark, d).select("event_id", "event_time", "wiki", "page_title", F.lit(True).alias("is_bot"))
    new = rows.where("event_id % 5 = 0").withColumns({"page_title": F.when(F.col("event_id") % 10 == 0, "merged").otherwise(F.when(F.col("event_id") % 3 != 0, F.col("page_title"))), "is_bot": F.col("event_id") % 10 == 0})
    return upsert.merge_update(rows.where("event_id % 3 = 0"), new, EDIT_KEY, keep_old=["is_bot"], fill=["page_title"])


@query("insert_anomaly_events", f"SELECT wiki, page_title, {_W}, CASE WHEN edit_count % 2 = 0 THEN anomaly_type ELSE 'again' END AS anomaly_type FROM anom")
def _q(spark, d):
    rows = _anomalies(spark, d).select(*WINDOW_KEY, "anomaly_type", "edit_count")
    return _first_wins(rows.where("edit_count % 2 = 0").drop("edit_count"), rows.drop("edit_count").withColumn("anomaly_type", F.lit("again")), WINDOW_KEY)


@query("insert_edit_war_signals", f"SELECT wiki, page_title, {_W}, CASE WHEN total_reverts % 2 = 0 THEN conflict_score ELSE CAST(0 AS DOUBLE) END AS conflict_score FROM wars")
def _q(spark, d):
    rows = _wars(spark, d).select(*WINDOW_KEY, "conflict_score", "total_reverts")
    return _first_wins(rows.where("total_reverts % 2 = 0").drop("total_reverts"), rows.drop("total_reverts").withColumn("conflict_score", F.lit(0.0)), WINDOW_KEY)


@query("upsert_user_aggregates", f'SELECT wiki, "user", is_bot, {_W}, edit_count + CASE WHEN edit_count > 1 THEN 10 ELSE 0 END AS edit_count FROM users')
def _q(spark, d):
    keys = ["wiki", "user", "is_bot", "window_start", "window_end"]
    rows = windows.user_activity(_edits(spark, d), SLIDE).select(*keys, "edit_count")
    table = _versioned(spark, "users", keys, F.to_date("window_start"))
    table.merge(rows)
    table.merge(rows.where("edit_count > 1").withColumn("edit_count", F.col("edit_count") + 10))
    return table.read()


@query("upsert_revision_scores", "SELECT wiki, revision_id, 'risk' AS model_name, CAST(CASE WHEN revision_id % 2 = 0 THEN 0.75 ELSE 0.25 END AS DOUBLE) AS score, us + CASE WHEN revision_id % 2 = 0 THEN 1000000 ELSE 0 END AS fetched_at FROM edits")
def _q(spark, d):
    rows = _edits(spark, d).select("wiki", "revision_id", F.lit("risk").alias("model_name"), F.lit(0.25).alias("score"), F.col("event_time").alias("fetched_at"))
    new = rows.where("revision_id % 2 = 0").withColumns({"score": F.lit(0.75), "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 SECOND")})
    table = _versioned(spark, "scores", ["wiki", "revision_id", "model_name"], F.floor(F.col("revision_id") / 4000))  # revisions' numbers grow with time
    table.merge(rows)
    table.merge(new)
    return table.read()


@query("append_pipeline_metrics", "SELECT component, epoch_us(recorded_at) AS recorded_at, events_received, CASE WHEN event_id % 3 = 0 THEN 'json_decode' WHEN event_id % 3 = 1 THEN 'normalize' ELSE 'publish' END AS stage FROM metrics")
def _q(spark, d):
    path = new_folder(spark, "metrics")
    rows = fixtures.metrics(spark, d)
    rows.where("events_received % 100 = 0").write.mode("append").parquet(path)
    rows.where("events_received % 100 <> 0").write.mode("append").parquet(path)
    return spark.read.parquet(path).select("component", "recorded_at", "events_received", F.get_json_object("details", "$.stage").alias("stage"))


# ---- streams: the same answers as batch queries, for windows that have closed

_CLOSED = "(SELECT max(event_time) FROM edits) - INTERVAL 2 HOUR"
_STREAM_COLS = ["event_id", "event_time", "wiki", "page_title", "page_id", "user", "is_bot", "is_revert", "revision_id", "revert_target_revision_id", "byte_length_delta", "provenance_id"]


#: Rows of a part that a Python state holds at a time; more rows are more parts.
PART_ROWS = 1 << 21


def _in_turn(rows, by, most=None):
    """rows in two parts or, if they are to have some ``most`` rows at most, in more, each before the next by a column; stored, so that parts aren't worked out one by one."""
    rows = stored(rows.repartitionByRange(by), "arriving")
    n = 2 if most is None else max(2, -(-rows.count() // most))
    cuts = [F.lit(c) for c in rows.agg(F.percentile_approx(by, [i / n for i in range(1, n)])).first()[0] or [None]]
    at = F.col(by)
    return [rows.where(at <= cuts[0]), *(rows.where((at > a) & (at <= b)) for a, b in zip(cuts, cuts[1:])), rows.where(at > cuts[-1])]


def _parts(spark, d, most=None):
    """(folder, schema, earlier and later parts of the edits, halves by default): each arrives after those before it have been processed."""
    rows = _edits(spark, d, True).select(*_STREAM_COLS)
    return new_folder(spark, "stream-in"), rows.schema, _in_turn(rows, "event_time", most)


def _state_partitions(spark):
    """Two partitions of Python state a core, if the session's shuffles don't have fewer."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _ended(spark, parts, name, operate=lambda stream: stream, write=None, checkpoint=None, query_name=None, state_partitions=None):
    """What the operator has written once all parts have come, each one to a query that goes on from the checkpoint of the one before."""
    path, schema, batches = parts
    out, checkpoint = new_folder(spark, name), checkpoint or new_folder(spark, "checkpoint")
    for batch in batches:
        batch.write.mode("append").parquet(path)
        stream = operate(streams.table_reader(path, schema)(spark))
        streams.run_to_end(stream, checkpoint, write(out) if write else None, out, query_name, state_partitions)
    try:
        return spark.read.parquet(out) if write else streams.table_or_empty(spark, out, stream.schema)
    except AnalysisException:  # a sink that was given no rows wrote none
        return spark.createDataFrame([], stream.schema)


def _committed(spark, parts, name, operate, tables):
    """The folder of tables that a stream's batches have committed."""
    root = new_folder(spark, name)
    _ended(spark, parts, name, operate, write=lambda _: sinks.tables_sink(root, tables), state_partitions=_state_partitions(spark))
    return root


@query("src_event_stream", 'SELECT event_id, "partition", "offset" FROM edits')
def _q(spark, d):
    rows = _edits(spark, d)
    path = new_folder(spark, "topic")
    rows = rows.select(F.to_json(F.struct("event_id", "page_title")).alias("value"), F.col("partition").cast("int").alias("partition"), "offset")
    got = _ended(spark, (path, rows.schema, [rows.where("partition = 0"), rows.where("partition <> 0")]), "topic-out")
    return got.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), "partition", "offset")


@query("src_raw_lines", "SELECT route, count(*) AS messages FROM routed GROUP BY 1")
def _q(spark, d):
    path = new_folder(spark, "lines")
    fixtures.raw_payloads(spark, d).select("value").write.text(path)
    routed = normalize.route(streams.line_reader(path)(spark)).select("route", "stage", "reason")
    out = new_folder(spark, "lines-out")
    streams.run_to_end(routed, new_folder(spark, "checkpoint"), path=out)
    return streams.table_or_empty(spark, out, routed.schema).groupBy("route").agg(F.count(F.lit(1)).alias("messages"))


@query("stream_activity_windows", f"SELECT {_WIN} FROM win WHERE win.window_end <= {_CLOSED}")
def _q(spark, d):
    return _ended(spark, _parts(spark, d), "windows", lambda s: streams.closed_windows(s, SLIDE, DELAY))


def _monitored(name, of, slide=SLIDE, delay=DELAY):
    """What a page monitor's stream reports of one kind, once all parts have come."""
    return lambda spark, d: _ended(spark, _parts(spark, d, PART_ROWS), name, lambda s: of(monitor.monitor(s, slide, delay, DETECTOR)), state_partitions=_state_partitions(spark))


@query("stream_edit_wars", f"SELECT {_WAR} FROM wars WHERE wars.window_end <= {_CLOSED}")
def _q(spark, d):
    return _monitored("wars", monitor.wars)(spark, d)


@query("stream_anomalies", f"SELECT wiki, page_title, {_W}, edit_count, anomaly_type, anomaly_score, threshold_used FROM anom WHERE anom.window_end <= {_CLOSED}")
def _q(spark, d):
    return _monitored("anomalies", monitor.anomalies)(spark, d).withColumn("anomaly_score", F.round("anomaly_score", 4))


_TRAIL = "judged.wiki, judged.page_title, epoch_us(judged.window_start) AS window_start, epoch_us(judged.window_end) AS window_end, judged.edit_count, history_size, anomaly_type, anomaly_score, coalesce(mutual_revert_count, 0) AS mutual_revert_count, editor_a, editor_b, round(coalesce(mutual_revert_count, 0) * CAST(2 AS DOUBLE) + CASE WHEN bursts >= 4 THEN bursts ELSE 0 END / CAST(2 AS DOUBLE), 4) AS conflict_score"
_TRAIL_FROM = "FROM judged JOIN (SELECT wiki AS w, page_title AS t, window_start AS s, edit_burst_count AS bursts FROM totals) ON w = wiki AND t = page_title AND s = window_start LEFT JOIN (SELECT wiki AS w2, page_title AS t2, window_start AS s2, mutual_revert_count, editor_a, editor_b FROM wars) ON w2 = wiki AND t2 = page_title AND s2 = window_start"
_TRAIL_COLS = [*WINDOW_KEY, "edit_count", "history_size", "anomaly_type", "anomaly_score", "mutual_revert_count", "editor_a", "editor_b", "conflict_score"]


@query("trailing_evaluation", f"SELECT {_TRAIL} {_TRAIL_FROM}", size_minutes=60, slide_minutes=10)
def _q(spark, d):
    return trailing.trailing_evaluation(_edits(spark, d, True), TRAILING, DETECTOR).select(*_TRAIL_COLS)


@query("stream_trailing_evaluation", f"SELECT {_TRAIL} {_TRAIL_FROM} WHERE judged.window_end <= (SELECT max(event_time) FROM edits) - INTERVAL 10 MINUTE", size_minutes=60, slide_minutes=10)
def _q(spark, d):
    """A timer at each tick: every page's last hour, every ten minutes."""
    reports = _monitored("trailing", lambda r: r.where("kind = 'window'").select(*_TRAIL_COLS), TRAILING, 600)(spark, d)
    return reports.withColumn("anomaly_score", F.round("anomaly_score", 4))


@query("stream_late_policy", 'SELECT event_id, us AS event_time, coalesce(us < max(us) OVER (PARTITION BY "partition" ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 7200000000, false) AS late FROM (SELECT *, "offset" + CASE WHEN event_id % 10 = 0 THEN 200 ELSE 0 END AS o FROM edits)')
def _q(spark, d):
    """Every tenth edit comes 200 offsets behind its time, in batches by offset; what is late goes to a table of its own."""
    rows = _edits(spark, d).select("event_id", "event_time", F.col("partition").cast("int").alias("partition"), F.expr("offset + CASE WHEN event_id % 10 = 0 THEN 200 ELSE 0 END").alias("offset"))
    parts = new_folder(spark, "arrivals"), rows.schema, _in_turn(rows, "offset", PART_ROWS)
    tables = {"in_time": lambda b: b.where("NOT late").drop("late"), "late": lambda b: b.where("late").drop("late")}
    root = _committed(spark, parts, "routed", lambda s: monitor.mark_late(s, 7200), tables)
    got = [sinks.read_committed(spark, root, name, rows.schema).withColumn("late", F.lit(name == "late")) for name in tables]
    return got[0].unionByName(got[1]).select("event_id", "event_time", "late")


_IDLE = Detector(ttl_seconds=SLIDE.size + DELAY)


@query("stream_state_ttl", f"""SELECT wiki, page_title, max(us) AS last_edit, time_bucket(INTERVAL 1 HOUR, max(event_time)) + INTERVAL 14 HOUR <= {_CLOSED} AS evicted FROM (SELECT wiki, page_title || ' of ' || strftime(event_time, '%Y-%m-%d') AS page_title, us, event_time FROM edits) GROUP BY 1, 2""")
def _q(spark, d):
    """Pages that live for a day: those that the monitor says it evicted, and those that its checkpoint still has."""
    path, schema, parts = _parts(spark, d, PART_ROWS)
    daily = [p.withColumn("page_title", F.concat("page_title", F.lit(" of "), F.date_format("event_time", "yyyy-MM-dd"))) for p in parts]
    checkpoint = new_folder(spark, "checkpoint")
    gone = _ended(spark, (path, schema, daily), "evicted", lambda s: monitor.monitor(s, SLIDE, DELAY, _IDLE).where("kind = 'evicted'").select("wiki", "page_title", F.col("event_time").alias("last_edit")), checkpoint=checkpoint, state_partitions=_state_partitions(spark))
    kept = monitor.pages_in_state(spark, checkpoint)
    return kept.withColumn("evicted", F.lit(False)).unionByName(gone.withColumn("evicted", F.lit(True)))


@query("dedupe_stream", "SELECT event_id, us AS event_time FROM edits")
def _q(spark, d):
    rows = _edits(spark, d).select("event_id", "event_time")
    path = new_folder(spark, "replayed")
    # every edit twice, and the newest again in a batch of their own; the plain sink keeps what it is given
    newest = rows.agg(F.max("event_time")).first()[0]
    again = rows.where(F.col("event_time") >= F.lit(newest) - F.expr("INTERVAL 30 MINUTES"))
    return _ended(spark, (path, rows.schema, [rows.unionByName(rows), again]), "deduped", lambda s: streams.dedupe(s, DELAY))


@query("stream_resume", "SELECT event_id, us AS event_time FROM edits")
def _q(spark, d):
    """A service with a trigger, stopped and started again: the plain sink has every edit once if the second query goes on from the first one's checkpoint."""
    path, schema, parts = _parts(spark, d)
    out, checkpoint = new_folder(spark, "resumed"), new_folder(spark, "checkpoint")
    for part in parts:
        part.write.mode("append").parquet(path)
        service = streams.start(streams.table_reader(path, schema, max_files=2)(spark), checkpoint, path=out, processingTime="100 milliseconds")
        try:
            service.processAllAvailable()
        finally:
            service.stop()
    return streams.table_or_empty(spark, out, schema).select("event_id", "event_time")


@query("sink_raw_events", "SELECT event_id, us AS event_time, wiki FROM edits")
def _q(spark, d):
    path, schema, parts = _parts(spark, d)
    # the second part is sent twice
    return _ended(spark, (path, schema, [*parts, parts[1]]), "raw", write=lambda out: streams.keyed_append(out, EDIT_KEY, "event_time")).select("event_id", "event_time", "wiki")


_THREE = f"""SELECT 'page_activity_windows' AS target, wiki, page_title, {_W}, provenance_id AS label, CAST(edit_count AS DOUBLE) AS amount, CAST(net_byte_delta AS DOUBLE) AS more FROM win WHERE win.window_end <= {_CLOSED}
  UNION ALL SELECT 'edit_war_signals', wiki, page_title, {_W}, editor_a || '/' || editor_b, conflict_score, CAST(mutual_revert_count AS DOUBLE) FROM wars WHERE wars.window_end <= {_CLOSED}
  UNION ALL SELECT 'anomaly_events', wiki, page_title, {_W}, anomaly_type, anomaly_score, threshold_used FROM anom WHERE anom.window_end <= {_CLOSED}"""


@query("sink_windowed", _THREE)
def _q(spark, d):
    """One stream whose every batch feeds three tables under one commit."""
    tables = {"page_activity_windows": monitor.activity, "edit_war_signals": monitor.wars, "anomaly_events": monitor.anomalies}
    parts = _parts(spark, d, PART_ROWS)
    root = _committed(spark, parts, "windowed", lambda s: monitor.monitor(s, SLIDE, DELAY, DETECTOR), tables)
    empty = monitor.monitor(streams.table_reader(parts[0], parts[1])(spark), SLIDE, DELAY, DETECTOR)
    read = {name: sinks.read_committed(spark, root, name, of(empty).schema) for name, of in tables.items()}
    shaped = lambda name, label, amount, more: read[name].select(F.lit(name).alias("target"), *WINDOW_KEY, label.alias("label"), F.col(amount).cast("double").alias("amount"), F.col(more).cast("double").alias("more"))
    rows = shaped("page_activity_windows", F.col("provenance_id"), "edit_count", "net_byte_delta").unionByName(shaped("edit_war_signals", F.concat("editor_a", F.lit("/"), "editor_b"), "conflict_score", "mutual_revert_count"))
    return rows.unionByName(shaped("anomaly_events", F.col("anomaly_type"), "anomaly_score", "threshold_used").withColumn("amount", F.round("amount", 4)))


@query("sink_event_topic", 'SELECT page_title AS "key", revision_id, event_key AS event_id, row_number() OVER (PARTITION BY page_title ORDER BY revision_id % 2, seconds, revision_id) AS place FROM norm')
def _q(spark, d):
    """Canonical events on an ordered topic: even revisions come in the first batch, odd ones in the second; ``place`` counts a key's messages by offset."""
    events = _events(spark, d)
    wire = normalize.encode(events).select("*", F.get_json_object("value", "$.timestamp").cast("double").alias("at"), F.get_json_object("value", "$.revision_id").cast("long").alias("revision"))
    wire = stored(wire, "wire")
    root = new_folder(spark, "topic")
    _ended(spark, (new_folder(spark, "outgoing"), wire.schema, [wire.where("revision % 2 = 0"), wire.where("revision % 2 = 1")]), "topic", write=lambda _: sinks.topic_sink(root, 6, ("at", "revision")))
    topic = sinks.read_topic(spark, root)
    # a key has one partition, in which offsets count without gaps; its messages are counted by runs of offsets, so that a key is not one task's
    found = topic.select(
        F.decode("key", "UTF-8").alias("key"), F.get_json_object("value", "$.revision_id").cast("long").alias("revision_id"), F.get_json_object("value", "$.event_id").alias("event_id"), "partition", "offset",
        F.floor(F.col("offset") / (1 << 16)).alias("run"),
    )
    runs = topic.groupBy(F.decode("key", "UTF-8").alias("key"), F.floor(F.col("offset") / (1 << 16)).alias("run")).agg(F.count(F.lit(1)).alias("size"))
    runs = runs.select("key", "run", (F.sum("size").over(Window.partitionBy("key").orderBy("run")) - F.col("size")).alias("before"))
    within = F.row_number().over(Window.partitionBy("key", "run").orderBy("offset"))
    found = found.withColumn("within", within).join(runs, ["key", "run"]).withColumn("place", F.col("before") + F.col("within"))
    sound = topic.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last"), F.countDistinct("offset").alias("distinct")).where("n <> last + 1 OR n <> distinct")
    found = found.join(sound, "partition", "left_anti")  # rows of a partition with gaps would be missed
    return found.select("key", "revision_id", "event_id", "place")


@query("stream_metrics", """SELECT event_id % 3 <> 0 AS second_batch, count(*) AS rows, count(*) FILTER (WHERE route = 'accepted') AS accepted, count(*) FILTER (WHERE route = 'ignored') AS ignored, count(*) FILTER (WHERE stage = 'json_decode') AS not_json,
  count(*) FILTER (WHERE stage = 'normalize') AS not_normal, count(*) FILTER (WHERE reason LIKE 'missing%') AS missing_field, count(*) FILTER (WHERE reason LIKE 'invalid timestamp%') AS bad_time, true AS timed, CAST(0 AS BIGINT) AS behind FROM routed GROUP BY 1""")
def _q(spark, d):
    """What a stream of raw messages observed of its batches, as its listener logged it."""
    rows = fixtures.raw_payloads(spark, d)
    counts = {
        "accepted": F.col("route") == "accepted", "ignored": F.col("route") == "ignored", "not_json": F.col("stage") == "json_decode", "not_normal": F.col("stage") == "normalize",
        "missing_field": F.col("reason").startswith("missing"), "bad_time": F.col("reason").startswith("invalid timestamp"),
    }
    path, name = new_folder(spark, "metrics"), f"ingest-{uuid.uuid4().hex}"
    operate = lambda s: progress.observe_counts(normalize.route(s).select("event_id", "route", "stage", "reason"), "ingestion", **counts)
    with progress.MetricsLog(spark, path, name):
        _ended(spark, (new_folder(spark, "messages"), rows.schema, [rows.where("event_id % 3 = 0"), rows.where("event_id % 3 <> 0")]), "routed", operate, query_name=name)
    log = spark.read.schema(progress.METRICS).parquet(path)
    observed = [F.col("observed")[f"ingestion.{c}"].cast("long").alias(c) for c in counts]
    timed = (F.col("rows_per_second") > 0) & (F.col("duration_ms") > 0) & F.col("recorded_at").isNotNull() & (F.col("observed")["ingestion.rows"].cast("long") == F.col("rows"))
    return log.select((F.col("batch_id") > 0).alias("second_batch"), "rows", *observed, timed.alias("timed"), F.coalesce("behind", F.lit(0)).alias("behind"))


@query("ttl_guard", f"SELECT wiki, page_title, CAST(epoch_us(max(gap)) / 1e6 AS BIGINT) AS ttl, epoch_us(max(gap)) >= 28800 * 1e6 AS allowed FROM (SELECT wiki, page_title, window_start - lag(window_start) OVER (PARTITION BY wiki, page_title ORDER BY window_start) + INTERVAL 7 HOUR AS gap FROM win) GROUP BY 1, 2")
def _q(spark, d):
    """For each page the longest pause between its windows, and seven hours, as a proposed ttl: allowed if history then outlives window and watermark."""
    by_page = Window.partitionBy("wiki", "page_title").orderBy("window_start")
    gaps = _windows(spark, d).withColumn("gap", F.unix_seconds("window_start") - F.unix_seconds(F.lag("window_start").over(by_page)))
    proposed = gaps.groupBy("wiki", "page_title").agg((F.max("gap") + 7 * 3600).alias("ttl"))
    return proposed.withColumn("allowed", F.col("ttl") >= monitor.least_ttl(SLIDE, DELAY))

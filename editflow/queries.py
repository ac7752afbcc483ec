"""Every query of the library by name, with SQL that an independent engine can run on the same tables.

Times leave as microseconds since the epoch and days as text, so that results
don't depend on a session's time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import expressions as X
from .operators import anomaly, conflict, normalize, upsert, windows
from .operators.anomaly import Detector
from .operators.windows import Slide
from .plans import audit, reports
from .plans.reports import Filters
from .schemas import WINDOW_KEY
from .sources import fixtures
from .sources.tables import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The fixture has an edit every few minutes, so its windows are longer than the defaults.
SLIDE = Slide(6 * 3600, 3600)
DELAY = 2 * 3600
TRAILING = Slide(3600, 600)
DETECTOR = Detector(ttl_seconds=None)
TTL = Detector(ttl_seconds=7200)
WEEK = 7 * 24 * 60

_CTES = """
WITH edits0 AS (
  SELECT event_id, ts AS event_time, epoch_us(ts) AS us, CAST(json_extract_string(props, '$.k') AS INT) AS k, user_id, event_type, value FROM events),
edits1 AS (
  SELECT event_id, event_time, us, 'wiki' || (k % 2) AS wiki, 'Page ' || (k % 10) AS page_title, CAST(100 + k % 10 AS BIGINT) AS page_id,
    CASE WHEN user_id % 17 <> 0 THEN 'u' || (user_id % 6) END AS "user", user_id, user_id % 5 = 0 AS is_bot, event_id % 7 = 0 AS is_minor,
    event_type IN ('error', 'click') AS is_revert, event_id AS revision_id, CAST(floor(value) AS BIGINT) - 40 AS byte_length_delta, event_type,
    us / 1e6 AS "timestamp", event_id % 3 AS "partition", event_id AS "offset",
    CASE WHEN event_id % 19 <> 0 THEN us / 1e6 + (event_id % 1000) / 1e3 END AS ingestion_timestamp,
    CASE WHEN event_id % 19 <> 0 AND event_id % 23 <> 0 THEN us / 1e6 + (event_id % 1000) / 1e3 + (event_id % 700) / 1e3 END AS processing_timestamp,
    'node-' || (event_id % 2) || ':' || CAST(floor(us / 1e6) AS BIGINT) || ':part-' || (event_id % 3) || ':off-' || event_id AS provenance_id
  FROM edits0),
edits AS (
  SELECT *, CASE WHEN is_revert THEN lag(revision_id) OVER (PARTITION BY wiki, page_title ORDER BY event_time, event_id) END AS revert_target_revision_id FROM edits1),
latest AS (SELECT max(event_time) AS as_of FROM edits),
recent AS (SELECT edits.* FROM edits, latest WHERE event_time >= as_of - INTERVAL 7 DAY),
wx AS (
  SELECT e.*, w AS window_start, w + INTERVAL @SIZE MINUTE AS window_end
  FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL @SLIDE MINUTE, event_time) - INTERVAL @BACK MINUTE, time_bucket(INTERVAL @SLIDE MINUTE, event_time), INTERVAL @SLIDE MINUTE)) AS w FROM edits) e),
win AS (
  SELECT wiki, page_title, window_start, window_end, any_value(page_id) AS page_id, count(*) AS edit_count, count(DISTINCT "user") AS unique_editors,
    count(*) FILTER (WHERE NOT is_bot) AS human_edits, count(*) FILTER (WHERE is_bot) AS bot_edits, count(*) FILTER (WHERE is_revert) AS revert_count,
    CAST(sum(byte_length_delta) AS BIGINT) AS net_byte_delta, arg_max(revision_id, (us, event_id)) AS last_revision_id, arg_max(provenance_id, (us, event_id)) AS provenance_id,
    round(count(*) / @SIZE.0, 4) AS edit_velocity
  FROM wx GROUP BY 1, 2, 3, 4),
gaps AS (
  SELECT *, CASE WHEN epoch_us(window_start) - epoch_us(lag(window_start) OVER (PARTITION BY wiki, page_title ORDER BY window_start)) >= @TTL THEN 1 ELSE 0 END AS fresh FROM win),
stretches AS (SELECT *, sum(fresh) OVER (PARTITION BY wiki, page_title ORDER BY window_start) AS stretch FROM gaps),
hist AS (
  SELECT *, coalesce(list(CAST(edit_count AS DOUBLE)) OVER (PARTITION BY wiki, page_title, stretch ORDER BY window_start ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING), []) AS h FROM stretches),
med AS (SELECT *, len(h) AS history_size, coalesce(list_aggregate(h, 'median'), 0.0) AS m FROM hist),
bl AS (SELECT *, coalesce(list_aggregate(list_transform(h, lambda x: abs(x - m)), 'median'), 0.0) AS d FROM med),
judged AS (
  SELECT *, CASE WHEN history_size >= 8 THEN m END AS baseline_median, CASE WHEN history_size >= 8 THEN d END AS baseline_mad,
    CASE WHEN history_size < 8 THEN CAST(edit_count AS DOUBLE) ELSE round(0.6745 * (edit_count - m) / greatest(d, 1.0), 4) END AS anomaly_score,
    CASE WHEN history_size < 8 AND edit_count >= 15 THEN 'count_fallback' WHEN history_size >= 8 AND 0.6745 * (edit_count - m) / greatest(d, 1.0) >= 3.5 THEN 'median_mad' ELSE 'none' END AS anomaly_type,
    CASE WHEN history_size < 8 THEN 15.0 ELSE 3.5 END AS threshold_used
  FROM bl),
anom AS (SELECT * FROM judged WHERE anomaly_type <> 'none'),
edges AS (
  SELECT r.wiki, r.page_title, r.window_start, r.window_end, r."user" AS src, a."user" AS dst, count(*) AS n
  FROM wx r JOIN wx a ON r.wiki = a.wiki AND r.page_title = a.page_title AND r.window_start = a.window_start AND r.revert_target_revision_id = a.revision_id
  WHERE r.is_revert AND r."user" <> a."user" GROUP BY 1, 2, 3, 4, 5, 6),
pairs AS (
  SELECT x.wiki, x.page_title, x.window_start, x.window_end, x.src AS editor_a, x.dst AS editor_b, x.n + y.n AS mutual_reverts
  FROM edges x JOIN edges y ON x.wiki = y.wiki AND x.page_title = y.page_title AND x.window_start = y.window_start AND x.src = y.dst AND x.dst = y.src WHERE x.src < x.dst),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY wiki, page_title, window_start ORDER BY mutual_reverts DESC, editor_a, editor_b) = 1),
totals AS (
  SELECT wiki, page_title, window_start, window_end, any_value(page_id) AS page_id, count(*) FILTER (WHERE is_revert) AS total_reverts, count(*) FILTER (WHERE byte_length_delta < 0) AS edit_burst_count
  FROM wx GROUP BY 1, 2, 3, 4),
wars AS (
  SELECT t.*, b.mutual_reverts AS mutual_revert_count, editor_a, editor_b,
    round(b.mutual_reverts * CAST(2 AS DOUBLE) + CASE WHEN edit_burst_count >= 4 THEN edit_burst_count ELSE 0 END / CAST(2 AS DOUBLE), 4) AS conflict_score, true AS flag
  FROM totals t JOIN best b USING (wiki, page_title, window_start, window_end)),
users AS (
  SELECT wiki, "user", is_bot, window_start, window_end, count(*) AS edit_count, count(*) FILTER (WHERE is_revert) AS revert_count, count(DISTINCT page_title) AS pages_touched
  FROM wx WHERE "user" IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
raw AS (
  SELECT *, event_id % 40 AS m, CASE WHEN event_id % 40 = 7 THEN wiki || '.example.org' ELSE wiki END AS named,
    CASE WHEN is_revert AND event_id % 2 = 0 THEN 'Reverted: undid revision ' || coalesce(revert_target_revision_id, 0) WHEN event_id % 5 = 0 THEN 'Undid revision 7, reverting' WHEN event_id % 4 = 0 THEN 'edit ' || event_id END AS comment,
    CASE WHEN event_id % 11 = 0 THEN '10.0.0.' || (event_id % 256) WHEN event_id % 13 = 0 THEN '2001:db8::' || (event_id % 10) WHEN event_id % 29 = 0 THEN '  ' ELSE "user" END AS editor,
    1000 + event_id % 50 AS old_length,
    CASE WHEN event_id % 23 <> 0 THEN 1000 + event_id % 50 + byte_length_delta + CASE WHEN event_id % 31 = 0 THEN 200000 ELSE 0 END END AS new_length
  FROM edits),
routed AS (
  SELECT *, CASE WHEN m IN (0, 6) THEN 'rejected' WHEN m IN (4, 5) THEN 'ignored' WHEN m IN (1, 2, 3, 8) THEN 'rejected' ELSE 'accepted' END AS route,
    CASE WHEN m = 0 THEN 'json_decode' WHEN m IN (1, 2, 3, 6, 8) THEN 'normalize' END AS stage,
    CASE m WHEN 0 THEN 'invalid JSON' WHEN 6 THEN 'event is not a JSON object' WHEN 1 THEN 'missing required field: title' WHEN 2 THEN 'invalid timestamp: half past nine' WHEN 3 THEN 'missing required field: wiki' WHEN 8 THEN 'missing required field: type' END AS reason
  FROM raw),
norm AS (
  SELECT CASE event_id % 3 WHEN 0 THEN 'm-' || event_id WHEN 1 THEN CAST(event_id AS VARCHAR) ELSE named || ':' || page_title || ':' || CAST(floor(us / 1e6) AS BIGINT) || '.0' END AS event_key,
    floor(us / 1e6) AS seconds, named AS wiki, page_title, page_id, CASE WHEN m <> 9 THEN CAST(0 AS BIGINT) END AS namespace, revision_id, revert_target_revision_id AS previous_revision_id,
    editor AS "user", nullif(user_id, 0) AS user_id, is_bot, comment, new_length, CAST(old_length AS BIGINT) AS old_length, new_length - old_length AS delta, is_revert,
    CASE WHEN is_revert AND event_id % 2 = 0 THEN coalesce(revert_target_revision_id, 0) WHEN is_revert AND event_id % 5 = 0 THEN 7 END AS target,
    CASE WHEN is_bot THEN 'BOT' WHEN editor IS NULL OR event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 29 = 0 THEN 'ANONYMOUS' ELSE 'REGISTERED' END AS user_type,
    is_minor, length(comment) AS comment_length, coalesce(abs(new_length - old_length) > 100000, false) AS is_large_jump, "partition", "offset"
  FROM routed WHERE route = 'accepted'),
metrics AS (
  SELECT event_time AS recorded_at, ['ingestion', 'spark', 'liftwing'][CAST(event_id % 3 AS INT) + 1] AS component, event_id AS events_received, event_id - event_id % 7 AS events_parsed,
    event_id % 7 AS events_rejected, event_id % 11 AS error_count, CAST(byte_length_delta AS DOUBLE) + 50 AS processing_latency_ms, event_id % 13 + CAST(0.5 AS DOUBLE) AS throughput_per_sec,
    CASE WHEN event_id % 100 = 0 THEN event_id % 17 + CAST(0.25 AS DOUBLE) END AS e2e_p95, event_id
  FROM edits)
"""


def _sql(body: str, ttl_us: int = 1 << 62, size_minutes: int = 360, slide_minutes: int = 60) -> str:
    given = {"@TTL": ttl_us, "@SLIDE": slide_minutes, "@SIZE": size_minutes, "@BACK": size_minutes - slide_minutes}
    out = _CTES
    for name, value in given.items():
        out = out.replace(name, str(value))
    return out + body


def _plain(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, ttl_us: int = 1 << 62, size_minutes: int = 360, slide_minutes: int = 60) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: _plain(f(spark, sf_dir))
        if sql is not None:
            SQL[name] = _sql(sql, ttl_us, size_minutes, slide_minutes)
        return f

    return keep


def _edits(spark, d, targets=False):
    return fixtures.edits(spark, d, targets)


def _recent(spark, d, **more):
    rows = _edits(spark, d)
    return reports.apply_filters(rows, Filters(minutes=WEEK, **more), reports.newest_time(rows))


def _windows(spark, d):
    return windows.page_activity(_edits(spark, d), SLIDE)


def _anomalies(spark, d, detector=DETECTOR):
    return anomaly.anomalies(_windows(spark, d), detector)


def _wars(spark, d):
    return conflict.edit_wars(_edits(spark, d, True), SLIDE)


def _routed(spark, d):
    return normalize.route(fixtures.raw_payloads(spark, d))


def _events(spark, d):
    return normalize.canonical(_routed(spark, d), now=F.lit(1704067200.5))


def _since(rows, time_col, days):
    newest = reports.newest_time(rows, time_col)
    return rows.where(F.col(time_col) >= F.lit(newest - timedelta(days=days)))


_W = "epoch_us(window_start) AS window_start, epoch_us(window_end) AS window_end"
_WIN = f"wiki, page_title, {_W}, page_id, edit_count, unique_editors, human_edits, bot_edits, revert_count, net_byte_delta, last_revision_id, provenance_id, edit_velocity"
_ANOM = f"wiki, page_title, {_W}, edit_count, anomaly_type, anomaly_score, threshold_used, baseline_median, baseline_mad"
_WAR = f"wiki, page_title, {_W}, page_id, total_reverts, edit_burst_count, mutual_revert_count, editor_a, editor_b, conflict_score, flag"
_ANOM_COLS = ["wiki", "page_title", "window_start", "window_end", "edit_count", "anomaly_type", "anomaly_score", "threshold_used", "baseline_median", "baseline_mad"]

# ---- windows, anomalies, conflicts


@query("page_activity_windows", f"SELECT {_WIN} FROM win")
def _q(spark, d):
    return _windows(spark, d)


@query("assign_windows", f"SELECT event_id, {_W} FROM wx")
def _q(spark, d):
    return windows.assign_windows(_edits(spark, d), SLIDE).select("event_id", "window_start", "window_end")


@query("user_aggregates", f'SELECT wiki, "user", is_bot, {_W}, edit_count, revert_count, pages_touched FROM users')
def _q(spark, d):
    return windows.user_activity(_edits(spark, d), SLIDE)


@query("robust_baseline", f"SELECT wiki, page_title, {_W}, history_size, m AS baseline_median, d AS baseline_mad FROM bl")
def _q(spark, d):
    return anomaly.baselines(_windows(spark, d), DETECTOR).select(*WINDOW_KEY, "history_size", "baseline_median", "baseline_mad")


@query("anomaly_events", f"SELECT {_ANOM} FROM anom")
def _q(spark, d):
    return _anomalies(spark, d).select(*_ANOM_COLS)


@query("history_ttl_reset", f"SELECT wiki, page_title, {_W}, history_size, anomaly_type, anomaly_score FROM judged", 7200 * 1_000_000)
def _q(spark, d):
    return anomaly.evaluate(_windows(spark, d), TTL).select(*WINDOW_KEY, "history_size", "anomaly_type", "anomaly_score")


@query("trailing_windows", """SELECT wiki, page_title, epoch_us(w) AS window_start, epoch_us(w + INTERVAL 1 HOUR) AS window_end, count(*) AS edit_count FROM (
  SELECT *, unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, event_time) - INTERVAL 50 MINUTE, time_bucket(INTERVAL 10 MINUTE, event_time), INTERVAL 10 MINUTE)) AS w FROM edits) GROUP BY 1, 2, 3, 4""")
def _q(spark, d):
    return windows.page_activity(_edits(spark, d), Slide(3600, 600)).select(*WINDOW_KEY, "edit_count")


@query("revert_edges", f"SELECT wiki, page_title, {_W}, src, dst, n FROM edges")
def _q(spark, d):
    return conflict.revert_edges(windows.assign_windows(_edits(spark, d, True), SLIDE))


@query("mutual_pairs", f"SELECT wiki, page_title, {_W}, editor_a, editor_b, CAST(mutual_reverts AS BIGINT) AS mutual_reverts FROM pairs")
def _q(spark, d):
    return conflict.mutual_pairs(conflict.revert_edges(windows.assign_windows(_edits(spark, d, True), SLIDE)))


@query("edit_war_signals", f"SELECT {_WAR} FROM wars")
def _q(spark, d):
    return _wars(spark, d)


@query("sample_latest_revision", f"SELECT wiki, page_title, {_W}, last_revision_id AS revision_id FROM win WHERE last_revision_id IS NOT NULL")
def _q(spark, d):
    return _windows(spark, d).where(F.col("last_revision_id").isNotNull()).select(*WINDOW_KEY, F.col("last_revision_id").alias("revision_id"))


@query("duplicate_windows", "SELECT CAST(count(*) FILTER (WHERE edit_count % 3 = 0) AS BIGINT) AS duplicates FROM win")
def _q(spark, d):
    """Every window whose count three divides is there twice."""
    rows = _windows(spark, d)
    rows = rows.unionByName(rows.where("edit_count % 3 = 0"))
    return audit.duplicate_windows(rows)


@query("keep_newest_duplicates", f"SELECT wiki, page_title, {_W}, edit_count + 1 AS edit_count FROM win")
def _q(spark, d):
    rows = _windows(spark, d).select(*WINDOW_KEY, "edit_count")
    twice = rows.withColumn("id", F.lit(1)).unionByName(rows.withColumn("id", F.lit(2)).withColumn("edit_count", F.col("edit_count") + 1))
    return upsert.newest(twice, WINDOW_KEY, F.col("id")).drop("id")


# ---- raw payloads


@query("route_events", "SELECT event_id, route, stage, reason FROM routed")
def _q(spark, d):
    return _routed(spark, d).select("event_id", "route", "stage", "reason")


@query("normalize_events", """SELECT event_key AS event_id, seconds AS "timestamp", wiki, 'edit' AS event_type, page_title, page_id, namespace, revision_id, previous_revision_id, "user", user_id, is_bot, comment,
  new_length AS byte_length_new, old_length AS byte_length_old, delta AS byte_length_delta, is_revert, target AS revert_target_revision_id, CAST(1704067200.5 AS DOUBLE) AS ingestion_timestamp,
  'ingest-node-01:2024-01-01T00:00:00.500Z:part-0:off-0' AS provenance_id, user_type, is_minor, comment_length, is_large_jump FROM norm""")
def _q(spark, d):
    return _events(spark, d).drop("processing_timestamp")


@query("validate_required", "SELECT event_id, reason FROM routed WHERE m NOT IN (0, 4, 5, 6)")
def _q(spark, d):
    rows = normalize.decode(fixtures.raw_payloads(spark, d)).where("is_object").where(~normalize.ignored(F.col("raw")))
    return rows.select("event_id", normalize.invalid_reason(F.col("raw")).alias("reason"))


@query("ignore_filter", "SELECT event_id FROM raw WHERE m NOT IN (0, 6, 3, 4, 5, 7) AND wiki = 'wiki1'")
def _q(spark, d):
    rows = normalize.decode(fixtures.raw_payloads(spark, d)).where("is_object")
    return rows.where(~normalize.ignored(F.col("raw"), ["wiki1"])).select("event_id")


@query("detect_reverts", "SELECT revision_id, is_revert, target AS revert_target_revision_id FROM norm")
def _q(spark, d):
    return _events(spark, d).select("revision_id", "is_revert", "revert_target_revision_id")


@query("classify_user_type", 'SELECT revision_id, "user", user_type FROM norm')
def _q(spark, d):
    return _events(spark, d).select("revision_id", "user", "user_type")


@query("byte_delta", "SELECT revision_id, new_length AS byte_length_new, old_length AS byte_length_old, delta AS byte_length_delta FROM norm")
def _q(spark, d):
    return _events(spark, d).select("revision_id", "byte_length_new", "byte_length_old", "byte_length_delta")


@query("large_jump", "SELECT revision_id, is_large_jump FROM norm")
def _q(spark, d):
    return _events(spark, d).select("revision_id", "is_large_jump")


@query("event_id_fallback", "SELECT revision_id, event_key AS event_id FROM norm")
def _q(spark, d):
    return _events(spark, d).select("revision_id", "event_id")


@query("make_provenance", """SELECT event_id, 'ingest-node-01:' || strftime(make_timestamp(us - us % 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z:part-' || "partition" || ':off-' || "offset" AS provenance_id FROM edits""")
def _q(spark, d):
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return _edits(spark, d).select("event_id", X.make_provenance(F.lit("ingest-node-01"), iso, F.col("partition"), F.col("offset")).alias("provenance_id"))


@query("rewrite_provenance", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'n:1700000000:part-9:off-8' WHEN 1 THEN 'n:1700000000:part-9:off-8' WHEN 2 THEN 'ingest-node-01:2023-11-14T22:13:20.250Z:part-9:off-8' ELSE 'a:b:c' END AS provenance_id FROM edits WHERE event_id % 40 <> 0
  UNION ALL SELECT event_id, 'n:1700000000:part-1:off-2' FROM edits WHERE event_id % 40 = 0""")
def _q(spark, d):
    given = F.expr("CASE event_id % 4 WHEN 0 THEN 'n:1700000000:part-1:off-2' WHEN 1 THEN 'n:1700000000' WHEN 3 THEN 'a:b:c' END")
    part = F.expr("CASE WHEN event_id % 40 <> 0 THEN 9 END")
    return _edits(spark, d).select("event_id", X.rewrite_provenance(given, F.lit("ingest-node-01"), F.lit(1700000000.25), part, F.lit(8)).alias("provenance_id"))


@query("enrich_lineage", """SELECT event_id, 'stream-worker-01:' || CAST(floor(coalesce(ingestion_timestamp, "timestamp")) AS BIGINT) || ':part-' || "partition" || ':off-' || "offset" AS provenance_id, "timestamp" + 1 AS processing_timestamp FROM edits""")
def _q(spark, d):
    return normalize.enrich_lineage(_edits(spark, d), F.col("timestamp") + 1, F.col("partition"), F.col("offset")).select("event_id", "provenance_id", "processing_timestamp")


@query("encode_canonical", 'SELECT page_title AS "key", event_key AS event_id, revision_id, target AS revert_target_revision_id, "user", is_large_jump FROM norm')
def _q(spark, d):
    wire = stored(normalize.encode(_events(spark, d)), "wire")
    return normalize.parse_canonical(wire.select(F.decode("key", "UTF-8").alias("key"), "value")).select("key", "event_id", "revision_id", "revert_target_revision_id", "user", "is_large_jump")


@query("parse_canonical", 'SELECT event_key AS event_id, CAST(seconds * 1000000 AS BIGINT) AS event_time, wiki, page_title, user_type FROM norm')
def _q(spark, d):
    return normalize.parse_canonical(stored(normalize.encode(_events(spark, d)), "wire")).select("event_id", "event_time", "wiki", "page_title", "user_type")


@query("reject_unparsed", "SELECT event_key AS event_id FROM norm WHERE revision_id % 3 <> 0")
def _q(spark, d):
    wire = _events(spark, d).select(F.when(F.col("revision_id") % 3 == 0, "{broken").otherwise(normalize.wire_value()).alias("value"))
    return normalize.keep_required(normalize.parse_canonical(stored(wire, "wire"))).select("event_id")


@query("to_edit_event_row", """SELECT event_key AS event_id, CAST(seconds * 1000000 AS BIGINT) AS event_time, 1704067200500000 AS ingestion_time, 1704067260000000 AS processing_time,
  'ingest-node-01:2024-01-01T00:00:00.500Z:part-' || (revision_id % 3) || ':off-' || revision_id AS provenance_id, is_bot, is_minor, is_revert, coalesce(comment_length, 0) AS comment_length, user_type FROM norm""")
def _q(spark, d):
    placed = _events(spark, d).withColumns({"partition": F.col("revision_id") % 3, "offset": F.col("revision_id"), "user_type": F.lit(None).cast("string"), "comment_length": F.lit(None).cast("long")})
    rows = normalize.edit_rows(placed, now=F.timestamp_seconds(F.lit(1704067260)))
    return rows.select("event_id", "event_time", "ingestion_time", "processing_time", "provenance_id", "is_bot", "is_minor", "is_revert", F.col("comment_length").cast("long").alias("comment_length"), "user_type")


@query("sink_dead_letter", "SELECT CASE event_id % 40 WHEN 0 THEN 'title=half of a pa' WHEN 6 THEN '[1]' END AS payload, CASE WHEN event_id % 40 NOT IN (0, 6) THEN revision_id END AS revision_id, stage, reason, '1704067200' AS failed_at FROM routed WHERE route = 'rejected'")
def _q(spark, d):
    out = normalize.dead_letters(_routed(spark, d), F.lit(1704067200))
    text = lambda i: F.decode(F.col("headers")[i]["value"], "UTF-8")
    revision = F.get_json_object("value", "$.revision.new").cast("long")
    return out.select(F.when(revision.isNull(), F.col("value")).alias("payload"), revision.alias("revision_id"), text(1).alias("stage"), text(0).alias("reason"), text(2).alias("failed_at"))


# ---- audit


@query("ingestion_counters", "SELECT count(*) AS received, count(*) FILTER (WHERE route = 'accepted') AS parsed, count(*) FILTER (WHERE route = 'ignored') AS ignored, count(*) FILTER (WHERE route = 'rejected') AS rejected, count(*) FILTER (WHERE route = 'rejected') AS dead_lettered, round(count(*) FILTER (WHERE route = 'rejected') / nullif(count(*), 0), 6) AS dead_letter_rate FROM routed")
def _q(spark, d):
    return audit.ingestion_counters(_routed(spark, d))


@query("errors_by_stage", "SELECT stage, count(*) AS errors FROM routed WHERE stage IS NOT NULL GROUP BY 1")
def _q(spark, d):
    return audit.error_map(_routed(spark, d)).select(F.explode("errors_by_stage").alias("stage", "errors"))


@query("latency_waterfall_cols", 'SELECT event_id, round((ingestion_timestamp - "timestamp") * 1000, 3) AS ingestion_latency_ms, round((processing_timestamp - ingestion_timestamp) * 1000, 3) AS compute_latency_ms, round((processing_timestamp - "timestamp") * 1000, 3) AS e2e_latency_ms FROM edits')
def _q(spark, d):
    return audit.latency_waterfall(_edits(spark, d)).select("event_id", "ingestion_latency_ms", "compute_latency_ms", "e2e_latency_ms")


_FACTS = """(SELECT *, round((i - "timestamp") * 1000, 3) AS ingestion_latency_ms, round((p - i) * 1000, 3) AS compute_latency_ms, round((p - "timestamp") * 1000, 3) AS e2e_latency_ms
  FROM (SELECT *, coalesce(ingestion_timestamp, "timestamp") AS i, coalesce(processing_timestamp, "timestamp" + 2) AS p FROM edits))"""


@query("fact_edit_events", f"SELECT event_id, ingestion_latency_ms, compute_latency_ms, e2e_latency_ms FROM {_FACTS}")
def _q(spark, d):
    return audit.fact_edit_events(_edits(spark, d), F.col("timestamp") + 2).select("event_id", "ingestion_latency_ms", "compute_latency_ms", "e2e_latency_ms")


@query("fact_anomalies", f"SELECT {_ANOM} FROM anom")
def _q(spark, d):
    _anomalies(spark, d).select(*_ANOM_COLS).createOrReplaceTempView("fact_anomalies")
    return spark.table("fact_anomalies")


_P = "round(quantile_cont({0}, {1}), {2})"


@query("summarize_ms", "SELECT component, count(x) AS count, round(quantile_cont(x, 0.5), 3) AS p50, round(quantile_cont(x, 0.95), 3) AS p95, round(quantile_cont(x, 0.99), 3) AS p99, round(max(x), 3) AS max, round(avg(x), 3) AS mean FROM (SELECT component, processing_latency_ms AS x FROM metrics) GROUP BY 1")
def _q(spark, d):
    return audit.summarize(fixtures.metrics(spark, d), F.col("processing_latency_ms"), ("component",))


@query("latency_waterfall_summary", "SELECT " + ", ".join(f"{_P.format(f'{n}_latency_ms', q, 1)} AS {n}_p{round(q * 100)}" for n in ("ingestion", "compute", "e2e") for q in (0.5, 0.95, 0.99)) + ", " + ", ".join(f"round(avg({n}_latency_ms), 1) AS {n}_avg" for n in ("ingestion", "compute", "e2e")) + f", count(*) AS sampled_events FROM {_FACTS}")
def _q(spark, d):
    return audit.latency_summary(audit.fact_edit_events(_edits(spark, d), F.col("timestamp") + 2))


@query("window_emit_delay", "SELECT count(*) AS count, round(quantile_cont(x, 0.5), 3) AS p50, round(quantile_cont(x, 0.95), 3) AS p95, round(quantile_cont(x, 0.99), 3) AS p99, round(max(x), 3) AS max, round(avg(x), 3) AS mean FROM (SELECT CAST(120000 + edit_count * 10 AS DOUBLE) AS x FROM win)")
def _q(spark, d):
    rows = _windows(spark, d).withColumn("stored_us", F.unix_micros("window_end") + 120_000_000 + F.col("edit_count") * 10_000)
    return audit.summarize(rows, (F.col("stored_us") - F.unix_micros("window_end")) / 1000)


@query("throughput_between_reports", "SELECT component, epoch_us(recorded_at) AS recorded_at, round((events_parsed - lag(events_parsed) OVER w) / nullif((epoch_us(recorded_at) - lag(epoch_us(recorded_at)) OVER w) / 1e6, 0), 6) AS throughput FROM metrics WINDOW w AS (PARTITION BY component ORDER BY recorded_at, events_parsed)")
def _q(spark, d):
    return audit.throughput_between_reports(fixtures.metrics(spark, d)).select("component", "recorded_at", "throughput")


@query("provenance_parts", """SELECT event_id, 'node-' || (event_id % 2) AS node, CAST(CAST(floor(us / 1e6) AS BIGINT) AS VARCHAR) AS epoch, "partition" AS kafka_partition, "offset" AS kafka_offset FROM edits""")
def _q(spark, d):
    return _edits(spark, d).select("event_id", *(c.alias(k) for k, c in X.provenance_parts(F.col("provenance_id")).items()))


@query("provenance_lookup", "SELECT provenance_id, 'edit' AS kind, wiki, page_title, us AS at FROM edits WHERE event_id = (SELECT max(event_id) FROM edits)")
def _q(spark, d):
    rows = _edits(spark, d)
    last = rows.agg(F.max_by("provenance_id", "event_id")).first()[0]
    return audit.provenance_lookup(rows, _anomalies(spark, d), last)


@query("late_events", 'SELECT event_id, coalesce(us < max(us) OVER (PARTITION BY "partition" ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 7200000000, false) AS late FROM (SELECT *, "offset" + CASE WHEN event_id % 10 = 0 THEN 200 ELSE 0 END AS o FROM edits)')
def _q(spark, d):
    arrivals = _edits(spark, d).withColumn("offset", F.expr("offset + CASE WHEN event_id % 10 = 0 THEN 200 ELSE 0 END"))
    return audit.late_events(arrivals, 7200).select("event_id", "late")


@query("state_ttl_pages", "SELECT wiki, page_title, max(us) AS last_edit, (SELECT max(us) FROM edits) - max(us) >= 3600000000 AS evicted FROM edits GROUP BY 1, 2")
def _q(spark, d):
    rows = _edits(spark, d)
    return audit.idle_pages(rows, F.lit(reports.newest_time(rows)), 3600)


@query("component_status", "SELECT component, CASE WHEN (SELECT max(us) FROM edits) / 1e6 - epoch_us(max(recorded_at)) / 1e6 > 14400 THEN 'stale' ELSE 'ok' END AS status FROM metrics GROUP BY 1")
def _q(spark, d):
    now = F.unix_micros(F.lit(reports.newest_time(_edits(spark, d)))) / 1_000_000
    last = fixtures.metrics(spark, d).groupBy("component").agg(F.max("recorded_at").alias("t"))
    return last.select("component", X.component_status(now - F.unix_micros("t") / 1_000_000, 14400).alias("status"))


@query("detail_path", "SELECT event_id, e2e_p95 FROM metrics")
def _q(spark, d):
    return fixtures.metrics(spark, d).select(F.col("events_received").alias("event_id"), X.detail(F.col("details"), "e2e", "p95").alias("e2e_p95"))


@query("extract_probability", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id % 10 / 16 WHEN 1 THEN CAST(0.25 AS DOUBLE) END AS probability FROM edits")
def _q(spark, d):
    response = F.expr("""CASE event_id % 4 WHEN 0 THEN concat('{"output": {"probability": {"false": 0.5, "true": ', event_id % 10 / 16, '}}}')
        WHEN 1 THEN '{"output": {"probability": {"b": 0.75, "a": 0.25}}}' WHEN 2 THEN '{"output": {}}' ELSE 'no json' END""")
    return _edits(spark, d).select("event_id", X.probability(response).alias("probability"))


@query("score_request", "SELECT DISTINCT last_revision_id AS rev_id, replace(wiki, 'wiki', '') AS lang FROM win")
def _q(spark, d):
    return _windows(spark, d).where(F.col("last_revision_id").isNotNull()).select(F.col("last_revision_id").alias("rev_id"), F.replace("wiki", F.lit("wiki"), F.lit("")).alias("lang")).distinct()


@query("enrich_scores", "SELECT DISTINCT wiki, page_title, last_revision_id AS revision_id, last_revision_id % 10 / 10 AS score FROM win WHERE last_revision_id % 10 <> 0")
def _q(spark, d):
    sampled = _windows(spark, d).select("wiki", "page_title", F.col("last_revision_id").alias("revision_id")).distinct()
    scores = _edits(spark, d).select("revision_id", F.expr("CASE WHEN revision_id % 10 <> 0 THEN revision_id % 10 / 10 END").alias("score"))
    return sampled.join(scores, "revision_id").where(F.col("score").isNotNull()).select("wiki", "page_title", "revision_id", "score")


# ---- reports


@query("apply_filters", "SELECT event_id FROM recent WHERE wiki = 'wiki1' AND lower(page_title) LIKE '%page 3%' AND NOT is_bot")
def _q(spark, d):
    return _recent(spark, d, wiki="wiki1", page_search="PAGE 3", editor_type="human").select("event_id")


@query("user_type_distribution", """SELECT coalesce(user_type, 'REGISTERED') AS user_type, count(*) AS edits, count(DISTINCT "user") AS unique_users, count(*) FILTER (WHERE is_revert) AS reverts, count(*) FILTER (WHERE is_minor) AS minor_edits FROM norm GROUP BY 1""")
def _q(spark, d):
    return reports.user_type_distribution(_events(spark, d))


for _unit, _name in (("minute", "edits_per_minute"), ("hour", "hourly_edits")):
    _pages = _unit == "hour"

    @query(_name, f"SELECT epoch_us(date_trunc('{_unit}', event_time)) AS bucket, count(*) AS edits, count(*) FILTER (WHERE NOT is_bot) AS human_edits, count(*) FILTER (WHERE is_bot) AS bot_edits" + (", count(DISTINCT (wiki, page_title)) AS pages" if _pages else "") + " FROM recent GROUP BY 1")
    def _q(spark, d, unit=_unit, pages=_pages):
        return reports.edits_per(_recent(spark, d), unit, pages)


@query("hourly_edits_for_pages", "SELECT epoch_us(date_trunc('hour', event_time)) AS bucket, page_title, count(*) AS edits FROM recent WHERE page_title IN ('Page 1', 'Page 4') GROUP BY 1, 2")
def _q(spark, d):
    return reports.hourly_edits_for_pages(_recent(spark, d), ["Page 1", "Page 4"])


@query("pages_in_list", "SELECT event_id, page_title FROM edits WHERE page_title IN ('Page 1', 'Page 4')")
def _q(spark, d):
    return reports.pages_in_list(_edits(spark, d), ["Page 1", "Page 4"]).select("event_id", "page_title")


@query("bot_vs_human", "SELECT count(*) FILTER (WHERE is_bot) AS bot_edits, count(*) FILTER (WHERE NOT is_bot) AS human_edits, count(*) AS total_edits, round(100.0 * count(*) FILTER (WHERE is_bot) / nullif(count(*), 0), 2) AS bot_percent, round(100.0 * count(*) FILTER (WHERE NOT is_bot) / nullif(count(*), 0), 2) AS human_percent FROM recent")
def _q(spark, d):
    return reports.bot_vs_human(_recent(spark, d))


@query("anomaly_frequency", "SELECT epoch_us(date_trunc('hour', window_start)) AS bucket, anomaly_type, count(*) AS anomalies FROM anom GROUP BY 1, 2")
def _q(spark, d):
    return reports.anomaly_frequency(_anomalies(spark, d))


@query("edit_war_trend", "SELECT epoch_us(date_trunc('hour', window_start)) AS bucket, count(*) FILTER (WHERE flag) AS flagged, count(*) AS signals, max(conflict_score) AS peak_score FROM wars GROUP BY 1")
def _q(spark, d):
    return reports.edit_war_trend(_wars(spark, d))


@query("most_active_pages", 'SELECT wiki, page_title, count(*) AS edits, count(DISTINCT "user") AS editors, count(*) FILTER (WHERE is_bot) AS bot_edits, count(*) FILTER (WHERE is_revert) AS reverts, max(us) AS last_edit, round(count(*) / 10080, 3) AS edits_per_minute FROM recent GROUP BY 1, 2 ORDER BY edits DESC, wiki, page_title LIMIT 15')
def _q(spark, d):
    return reports.most_active_pages(_recent(spark, d), WEEK)


@query("most_mutual_reverts", "SELECT wiki, page_title, CAST(sum(mutual_revert_count) AS BIGINT) AS mutual_reverts, count(*) FILTER (WHERE flag) AS flagged_windows, max(conflict_score) AS peak_score, epoch_us(max(window_start)) AS last_window FROM wars GROUP BY 1, 2 HAVING sum(mutual_revert_count) > 0 ORDER BY mutual_reverts DESC, wiki, page_title LIMIT 25")
def _q(spark, d):
    return reports.most_mutual_reverts(_wars(spark, d))


@query("pages_with_most_anomalies", "SELECT wiki, page_title, count(*) AS anomalies, count(*) FILTER (WHERE anomaly_type = 'median_mad') AS median_mad, count(*) FILTER (WHERE anomaly_type = 'count_fallback') AS count_fallback, max(anomaly_score) AS peak_score, epoch_us(max(window_start)) AS last_anomaly FROM anom GROUP BY 1, 2 ORDER BY anomalies DESC, wiki, page_title LIMIT 25")
def _q(spark, d):
    return reports.pages_with_most_anomalies(_anomalies(spark, d))


@query("top_editors", 'SELECT wiki, "user", is_bot, CAST(sum(edit_count) AS BIGINT) AS edits, CAST(sum(revert_count) AS BIGINT) AS reverts, CAST(sum(pages_touched) AS BIGINT) AS pages_touched FROM users GROUP BY 1, 2, 3 ORDER BY edits DESC, wiki, "user", is_bot LIMIT 25')
def _q(spark, d):
    return reports.top_editors(windows.user_activity(_edits(spark, d), SLIDE))


@query("avg_throughput_15m", "SELECT component, round(avg(throughput_per_sec), 6) AS throughput, count(*) AS reports FROM metrics WHERE recorded_at >= (SELECT max(recorded_at) - INTERVAL 5 DAY FROM metrics) GROUP BY 1")
def _q(spark, d):
    return reports.average_throughput(_since(fixtures.metrics(spark, d), "recorded_at", 5))


@query("wikis_seen", "SELECT DISTINCT wiki FROM edits")
def _q(spark, d):
    return _edits(spark, d).select("wiki").distinct()


@query("latest_page_velocity", f"SELECT wiki, page_title, {_W}, edit_count, edit_velocity FROM win QUALIFY row_number() OVER (PARTITION BY wiki, page_title ORDER BY window_start DESC) = 1 ORDER BY edit_velocity DESC, wiki, page_title LIMIT 15")
def _q(spark, d):
    return reports.latest_page_velocity(_since(_windows(spark, d), "window_start", 7)).select(*WINDOW_KEY, "edit_count", "edit_velocity")


@query("highest_edit_velocity", f"SELECT * EXCLUDE (l) FROM (SELECT wiki, page_title, {_W}, edit_velocity, window_start >= (SELECT max(window_start) FROM win) - INTERVAL 1 HOUR AS l FROM win QUALIFY row_number() OVER (PARTITION BY wiki, page_title ORDER BY win.window_start DESC) = 1) WHERE l ORDER BY edit_velocity DESC, wiki, page_title LIMIT 15".replace("window_start >= (SELECT", "win.window_start >= (SELECT"))
def _q(spark, d):
    rows = _windows(spark, d)
    since = reports.newest_time(rows, "window_start") - timedelta(hours=1)
    return reports.latest_page_velocity(rows, since=since, filter_first=False).select(*WINDOW_KEY, "edit_velocity")


@query("latest_component_metrics", "SELECT component, epoch_us(recorded_at) AS recorded_at, events_received, events_parsed, error_count, throughput_per_sec FROM metrics QUALIFY row_number() OVER (PARTITION BY component ORDER BY metrics.recorded_at DESC, events_received DESC) = 1")
def _q(spark, d):
    return reports.latest(fixtures.metrics(spark, d), ["component"], F.desc("recorded_at"), F.desc("events_received")).select("component", "recorded_at", "events_received", "events_parsed", "error_count", "throughput_per_sec")


@query("recent_anomalies", f"SELECT {_ANOM} FROM anom ORDER BY anom.window_start DESC, wiki, page_title LIMIT 50")
def _q(spark, d):
    return reports.top(_anomalies(spark, d).select(*_ANOM_COLS), 50, F.desc("window_start"), F.asc("wiki"), F.asc("page_title"))


@query("recent_edit_war_signals", f"SELECT {_WAR} FROM wars ORDER BY wars.window_start DESC, conflict_score DESC, wiki, page_title LIMIT 200")
def _q(spark, d):
    return reports.top(_wars(spark, d), 200, F.desc("window_start"), F.desc("conflict_score"), F.asc("wiki"), F.asc("page_title"))


@query("highest_edit_war_signal", f"SELECT {_WAR} FROM wars WHERE wars.window_start >= (SELECT max(window_start) FROM wars) - INTERVAL 1 DAY ORDER BY conflict_score DESC, wars.window_start DESC, wiki, page_title LIMIT 25")
def _q(spark, d):
    return reports.top(_since(_wars(spark, d), "window_start", 1), 25, F.desc("conflict_score"), F.desc("window_start"), F.asc("wiki"), F.asc("page_title"))


@query("conflict_graph_pairs", f"SELECT {_WAR} FROM wars WHERE mutual_revert_count > 0 OR flag ORDER BY conflict_score DESC, wars.window_end DESC, wiki, page_title LIMIT 20")
def _q(spark, d):
    rows = _wars(spark, d).where((F.col("mutual_revert_count") > 0) | F.col("flag"))
    return reports.top(rows, 20, F.desc("conflict_score"), F.desc("window_end"), F.asc("wiki"), F.asc("page_title"))


@query("revert_evidence", "SELECT event_id, us AS event_time, \"user\", revert_target_revision_id FROM edits WHERE is_revert AND wiki = 'wiki1' AND page_title = 'Page 3' ORDER BY us DESC, event_id LIMIT 200")
def _q(spark, d):
    rows = _edits(spark, d, True).where("is_revert AND wiki = 'wiki1' AND page_title = 'Page 3'").select("event_id", "event_time", "user", "revert_target_revision_id")
    return reports.top(rows, 200, F.desc("event_time"), F.asc("event_id"))


@query("top_anomaly_scores", f"SELECT {_ANOM} FROM anom WHERE anomaly_type = 'median_mad' ORDER BY anomaly_score DESC, anom.window_start, wiki, page_title LIMIT 15")
def _q(spark, d):
    rows = _anomalies(spark, d).where("anomaly_type = 'median_mad'").select(*_ANOM_COLS)
    return reports.top(rows, 15, F.desc("anomaly_score"), F.asc("window_start"), F.asc("wiki"), F.asc("page_title"))


@query("metrics_history", "SELECT component, epoch_us(recorded_at) AS recorded_at, throughput_per_sec, processing_latency_ms, e2e_p95 FROM metrics")
def _q(spark, d):
    return fixtures.metrics(spark, d).select("component", "recorded_at", "throughput_per_sec", "processing_latency_ms", X.detail(F.col("details"), "e2e", "p95").alias("e2e_p95")).orderBy("recorded_at", "component")


@query("flagged_windows", "SELECT count(*) FILTER (WHERE flag) AS flagged FROM (SELECT * FROM wars ORDER BY window_start DESC, conflict_score DESC, wiki, page_title LIMIT 200)")
def _q(spark, d):
    return QUERIES["recent_edit_war_signals"](spark, d).agg(F.count_if("flag").alias("flagged"))


@query("contested_pages", "SELECT DISTINCT wiki, page_title FROM wars")
def _q(spark, d):
    return _wars(spark, d).select("wiki", "page_title").distinct()

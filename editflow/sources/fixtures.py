"""Edits, raw payloads and metrics derived from the driver's `events` table, for queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import once


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table; times are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def edits(spark: SparkSession, sf_dir: str, targets: bool = True) -> DataFrame:
    """One edit per event, on ten pages of two wikis by six named users and nobody.  Without ``targets``, what a revert undid is left out."""
    rows = events(spark, sf_dir).selectExpr(
        "event_id", "cast(ts AS timestamp) AS event_time", "cast(get_json_object(props, '$.k') AS int) AS k", "user_id", "event_type", "value"
    ).selectExpr(
        "event_id", "event_time", "concat('wiki', k % 2) AS wiki", "concat('Page ', k % 10) AS page_title", "cast(100 + k % 10 AS bigint) AS page_id",
        "CASE WHEN user_id % 17 <> 0 THEN concat('u', user_id % 6) END AS user", "user_id", "user_id % 5 = 0 AS is_bot", "event_id % 7 = 0 AS is_minor",
        "event_type IN ('error', 'click') AS is_revert", "event_id AS revision_id", "cast(floor(value) AS bigint) - 40 AS byte_length_delta", "event_type",
        "unix_micros(event_time) / 1000000 AS timestamp", "event_id % 3 AS partition", "event_id AS offset",
        "CASE WHEN event_id % 19 <> 0 THEN unix_micros(event_time) / 1000000 + (event_id % 1000) / 1000 END AS ingestion_timestamp",
        "CASE WHEN event_id % 19 <> 0 AND event_id % 23 <> 0 THEN unix_micros(event_time) / 1000000 + (event_id % 1000) / 1000 + (event_id % 700) / 1000 END AS processing_timestamp",
        "concat('node-', event_id % 2, ':', unix_seconds(event_time), ':part-', event_id % 3, ':off-', event_id) AS provenance_id",
    )
    return _with_targets(rows) if targets else rows


def _with_targets(rows: DataFrame) -> DataFrame:
    """A revert undoes the page's edit before it.

    Edits are ordered by hour; an hour's first one follows the last of the page's
    hour before, so that a page is not one task's.
    """
    edit = F.struct("event_time", "event_id", "revision_id")
    # neither is null, so that window and join meet on the same columns
    timed = rows.withColumns({"__page": F.coalesce("page_title", F.lit("")), "__hour": F.coalesce(F.floor(F.unix_micros("event_time") / 3_600_000_000), F.lit(-(1 << 62)))})
    hours = timed.groupBy("__page", "__hour").agg(F.max(edit).alias("__last"))
    hours = hours.select("__page", "__hour", F.lag("__last").over(Window.partitionBy("__page").orderBy("__hour")).alias("__earlier"))
    inside = F.lag(edit).over(Window.partitionBy("__page", "__hour").orderBy("event_time", "event_id"))
    both = timed.withColumn("__inside", inside).join(hours, ["__page", "__hour"])
    target = F.coalesce("__inside", "__earlier")["revision_id"]
    return both.select(*rows.columns, F.when(F.col("is_revert"), target).alias("revert_target_revision_id"))


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (event_id, value, partition, offset): each edit as the JSON of a change feed, every so often broken or to be ignored."""
    m = "event_id % 40"
    rows = edits(spark, sf_dir).selectExpr(
        "event_id", "partition", "offset",
        f"""to_json(named_struct(
            'meta', named_struct('id', CASE WHEN event_id % 3 = 0 THEN concat('m-', event_id) END),
            'id', CASE WHEN event_id % 3 = 1 THEN event_id END,
            'type', CASE WHEN {m} = 4 THEN 'log' WHEN {m} <> 8 THEN 'edit' END,
            'wiki', CASE WHEN {m} NOT IN (3, 7) THEN wiki END,
            'server_name', CASE WHEN {m} = 7 THEN concat(wiki, '.example.org') END,
            'title', CASE WHEN {m} <> 1 THEN page_title END,
            'timestamp', CASE WHEN {m} = 2 THEN 'half past nine' ELSE cast(unix_seconds(event_time) AS string) END,
            'namespace', CASE WHEN {m} = 5 THEN 3 WHEN {m} <> 9 THEN 0 END,
            'user', CASE WHEN event_id % 11 = 0 THEN concat('10.0.0.', event_id % 256) WHEN event_id % 13 = 0 THEN concat('2001:db8::', event_id % 10) WHEN event_id % 29 = 0 THEN '  ' ELSE user END,
            'userid', user_id, 'bot', is_bot, 'minor', is_minor,
            'comment', CASE WHEN is_revert AND event_id % 2 = 0 THEN concat('Reverted: undid revision ', coalesce(revert_target_revision_id, 0)) WHEN event_id % 5 = 0 THEN 'Undid revision 7, reverting' WHEN event_id % 4 = 0 THEN concat('edit ', event_id) END,
            'length', named_struct('old', 1000 + event_id % 50, 'new', CASE WHEN event_id % 23 <> 0 THEN 1000 + event_id % 50 + byte_length_delta + CASE WHEN event_id % 31 = 0 THEN 200000 ELSE 0 END END),
            'revision', named_struct('old', revert_target_revision_id, 'new', revision_id),
            'tags', CASE WHEN is_revert AND event_id % 2 = 1 THEN array('mobile edit', 'mw-rollback') ELSE array() END,
            'page_id', page_id)) AS good""",
    )
    value = F.expr(f"CASE WHEN {m} = 0 THEN 'title=half of a pa' WHEN {m} = 6 THEN '[1]' ELSE good END")
    return rows.select("event_id", once(value).alias("value"), "partition", "offset")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metrics log: every event reports for one of three components."""
    return edits(spark, sf_dir, targets=False).selectExpr(
        "event_time AS recorded_at", "element_at(array('ingestion', 'spark', 'liftwing'), cast(event_id % 3 AS int) + 1) AS component",
        "event_id AS events_received", "event_id - event_id % 7 AS events_parsed", "event_id % 7 AS events_rejected", "event_id % 11 AS error_count",
        "cast(byte_length_delta AS double) + 50 AS processing_latency_ms", "event_id % 13 + 0.5D AS throughput_per_sec",
        "to_json(named_struct('e2e', CASE WHEN event_id % 100 = 0 THEN named_struct('p95', event_id % 17 + 0.25D) END, 'stage', element_at(array('json_decode', 'normalize', 'publish'), cast(event_id % 3 AS int) + 1))) AS details",
    )

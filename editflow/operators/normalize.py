"""Raw change payloads to canonical events: decode, route, validate, normalize, and shape for storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as X
from ..schemas import CANONICAL, RAW, REQUIRED

IGNORED_TYPES = ["log", "categorize"]
_CORRUPT = "__corrupt"


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def decode(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """The rows of messages with `raw`, `is_json` and `is_object`.

    A message that parses as an object of the expected fields is parsed once,
    however many fields are read of it; what is wrong with others is found by
    looking at them again.
    """
    value = F.col(value_col)
    schema = T.StructType([*RAW.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(value, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    sound = F.coalesce(F.col("raw").isNotNull() & F.col(f"raw.{_CORRUPT}").isNull() & F.startswith(F.ltrim(value), F.lit("{")), F.lit(False))
    rows = messages.withColumn("raw", X.once(parsed))
    rows = rows.withColumns({"is_json": sound | F.when(~sound, F.try_parse_json(value).isNotNull()), "is_object": sound | F.when(~sound, F.json_object_keys(value).isNotNull())})
    return rows.withColumn("raw", F.col("raw").dropFields(_CORRUPT))


def ignored(raw: Column, wikis: list[str] | None = None) -> Column:
    """Other wikis than those listed, pages outside the main namespace, and log or category entries."""
    wiki = F.coalesce(_filled(raw["wiki"]), _filled(raw["server_name"]))
    out = F.coalesce(raw["namespace"] != 0, F.lit(False)) | F.coalesce(raw["type"].isin(IGNORED_TYPES), F.lit(False))
    return out | ~F.coalesce(wiki.isin(wikis), F.lit(False)) if wikis else out


def invalid_reason(raw: Column) -> Column:
    """Why a payload can't become an event; null if it can."""
    missing = lambda name: F.lit(f"missing required field: {name}")
    wiki = F.coalesce(_filled(raw["wiki"]), _filled(raw["server_name"]))
    return (
        F.when(raw["type"].isNull(), missing("type"))
        .when(wiki.isNull(), missing("wiki"))
        .when(_filled(raw["title"]).isNull(), missing("title"))
        .when(raw["timestamp"].isNull(), missing("timestamp"))
        .when(raw["timestamp"].try_cast("double").isNull(), F.concat(F.lit("invalid timestamp: "), raw["timestamp"]))
    )


def route(messages: DataFrame, wikis: list[str] | None = None, value_col: str = "value") -> DataFrame:
    """The rows of messages with raw, route (accepted, ignored, rejected), stage and reason.

    Bad JSON is rejected at json_decode; what isn't an object at normalize; the
    test whether to ignore comes before validation.
    """
    rows = decode(messages, value_col)
    raw, reason = F.col("raw"), invalid_reason(F.col("raw"))
    where = F.when(~F.col("is_json"), "rejected").when(~F.col("is_object"), "rejected").when(ignored(raw, wikis), "ignored").when(reason.isNotNull(), "rejected").otherwise("accepted")
    stage = F.when(~F.col("is_json"), "json_decode").when(~F.col("is_object"), "normalize").when((where == "rejected"), "normalize")
    why = F.when(~F.col("is_json"), "invalid JSON").when(~F.col("is_object"), "event is not a JSON object").when(where == "rejected", reason)
    return rows.withColumns({"route": where, "stage": stage, "reason": why}).drop("is_json", "is_object")


def canonical(routed: DataFrame, host: str = "ingest-node-01", now: Column | None = None) -> DataFrame:
    """The accepted rows of routed as canonical events.  ``now`` is the time of ingestion in epoch seconds."""
    raw = F.col("raw")
    now = F.unix_micros(F.current_timestamp()) / 1_000_000 if now is None else now
    wiki = F.coalesce(_filled(raw["wiki"]), _filled(raw["server_name"]))
    stamp = raw["timestamp"].try_cast("double")
    old, new = raw["length"]["old"].cast("long"), raw["length"]["new"].cast("long")
    bot = F.coalesce(raw["bot"], F.lit(False))
    reverts = X.is_revert(raw["tags"], raw["comment"])
    made = X.make_provenance(F.lit(host), X.iso_millis(now), F.coalesce(raw["kafka_partition"], F.lit(0)), F.coalesce(raw["kafka_offset"], F.lit(0)))
    columns = {
        "event_id": F.coalesce(_filled(raw["meta"]["id"]), _filled(raw["id"]), F.concat_ws(":", wiki, raw["title"], X.float_text(stamp))),
        "timestamp": stamp, "wiki": wiki, "event_type": raw["type"], "page_title": raw["title"], "page_id": raw["page_id"], "namespace": raw["namespace"],
        "revision_id": raw["revision"]["new"], "previous_revision_id": raw["revision"]["old"], "user": raw["user"], "user_id": F.coalesce(F.nullif(raw["userid"], F.lit(0)), raw["user_id"]),
        "is_bot": bot, "comment": raw["comment"], "byte_length_new": new, "byte_length_old": old, "byte_length_delta": new - old, "is_revert": reverts,
        "revert_target_revision_id": X.revert_target(reverts, raw["comment"]), "ingestion_timestamp": now.cast("double"), "processing_timestamp": F.lit(None).cast("double"),
        "provenance_id": F.coalesce(_filled(raw["provenance_id"]), made), "user_type": X.user_type(raw["user"], bot),
        "is_minor": F.coalesce(raw["minor"], F.lit(False)) | F.coalesce(raw["is_minor"], F.lit(False)), "comment_length": F.length(raw["comment"]).cast("long"), "is_large_jump": X.large_jump(new - old),
    }
    return routed.where(F.col("route") == "accepted").select(*(columns[f.name].alias(f.name) for f in CANONICAL))


def wire_value() -> Column:
    """A canonical event's JSON, with its null fields."""
    return F.to_json(F.struct(*[f.name for f in CANONICAL]), {"ignoreNullFields": "false"})


def encode(events: DataFrame) -> DataFrame:
    """Rows (key, value): the page title's bytes and the event's JSON, so that a page's events keep their order by key."""
    return events.select(F.encode("page_title", "UTF-8").alias("key"), wire_value().alias("value"))


def parse_canonical(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Canonical JSON to its columns, with event_time and whatever partition and offset messages has."""
    rest = [c for c in messages.columns if c != value_col]
    return messages.select(*rest, X.once(F.from_json(value_col, CANONICAL)).alias("e")).select(*rest, "e.*").withColumn("event_time", F.timestamp_seconds("timestamp"))


def keep_required(events: DataFrame) -> DataFrame:
    return events.dropna(subset=list(REQUIRED))


def dead_letters(routed: DataFrame, failed_at: Column, value_col: str = "value") -> DataFrame:
    """Rejected payloads as (value, headers): reason, stage and failed_at as the headers of a message."""
    header = lambda k, v: F.struct(F.lit(k).alias("key"), F.encode(v, "UTF-8").alias("value"))
    headers = F.array(header("reason", F.col("reason")), header("stage", F.col("stage")), header("failed_at", failed_at.cast("string")))
    return routed.where(F.col("route") == "rejected").select(F.col(value_col).alias("value"), headers.alias("headers"))


def edit_rows(events: DataFrame, host: str = "ingest-node-01", now: Column | None = None) -> DataFrame:
    """Parsed events as rows of edit_events, with defaults for what is missing."""
    col = F.col
    bot = F.coalesce(col("is_bot"), F.lit(False))
    at = lambda name: F.timestamp_micros(F.floor(col(name) * 1_000_000).cast("long"))
    return events.withColumns({
        "event_time": at("timestamp"), "ingestion_time": at("ingestion_timestamp"),
        "processing_time": F.coalesce(at("processing_timestamp"), F.current_timestamp() if now is None else now),
        "provenance_id": X.rewrite_provenance(col("provenance_id"), F.lit(host), col("ingestion_timestamp"), col("partition"), col("offset")),
        "is_bot": bot, "is_minor": F.coalesce(col("is_minor"), F.lit(False)), "is_revert": F.coalesce(col("is_revert"), F.lit(False)),
        "comment_length": F.coalesce(col("comment_length"), F.length("comment"), F.lit(0)),
        "user_type": F.coalesce(F.nullif(col("user_type"), F.lit("")), X.user_type(col("user"), bot)),
    }).drop("timestamp", "ingestion_timestamp", "processing_timestamp")


def enrich_lineage(events: DataFrame, processed: Column, partition: Column, offset: Column, host: str = "stream-worker-01") -> DataFrame:
    """A worker's variant: an integer epoch in the id, of ingestion or else the event, and the time of processing."""
    epoch = F.floor(F.coalesce(F.nullif(F.col("ingestion_timestamp"), F.lit(0.0)), F.col("timestamp"))).cast("long")
    return events.withColumns({"processing_timestamp": processed, "provenance_id": X.make_provenance(F.lit(host), epoch, partition, offset)})

"""Schemas at the boundaries: the raw change payload and the canonical edit event."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: Fields that may hold anything are read as strings and cast where they are used, so that one bad field doesn't null its row.
RAW = _struct(
    meta=_struct(id=_S), id=_S, type=_S, wiki=_S, server_name=_S, title=_S, timestamp=_S, namespace=_L, user=_S, userid=_L, user_id=_L,
    bot=_B, minor=_B, is_minor=_B, comment=_S, length=_struct(old=_D, new=_D), revision=_struct(old=_L, new=_L), tags=T.ArrayType(_S),
    page_id=_L, provenance_id=_S, kafka_partition=_L, kafka_offset=_L,
)

#: The canonical event on the wire; timestamps are epoch seconds.
CANONICAL = _struct(
    event_id=_S, timestamp=_D, wiki=_S, event_type=_S, page_title=_S, page_id=_L, namespace=_L, revision_id=_L, previous_revision_id=_L,
    user=_S, user_id=_L, is_bot=_B, comment=_S, byte_length_new=_L, byte_length_old=_L, byte_length_delta=_L, is_revert=_B,
    revert_target_revision_id=_L, ingestion_timestamp=_D, processing_timestamp=_D, provenance_id=_S, user_type=_S, is_minor=_B,
    comment_length=_L, is_large_jump=_B,
)

REQUIRED = ("event_id", "timestamp", "wiki", "event_type", "page_title")
WINDOW_KEY = ("wiki", "page_title", "window_start", "window_end")
EDIT_KEY = ("event_id", "event_time")

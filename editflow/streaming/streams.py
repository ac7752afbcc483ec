"""The same operators over Structured Streaming: sources, closed windows, duplicates, keyed sinks, and running queries.

Replayed batches do no harm: every sink goes through a keyed insert, or through a folder of its batch (see sinks).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators.upsert import insert_absent
from ..operators.windows import Slide, page_activity
from ..schemas import EDIT_KEY

Reader = Callable[[SparkSession], DataFrame]


def kafka_reader(servers: str, topic: str, starting: str = "latest", **options: str) -> Reader:
    """value, partition and offset of a topic; lost data is tolerated.  The connector's package must be on the class path."""
    def read(spark: SparkSession) -> DataFrame:
        rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false")
        return rows.options(**options).load().selectExpr("CAST(value AS STRING) AS value", "partition", "offset")

    return read


def line_reader(path: str, max_files: int | None = None) -> Reader:
    """Raw messages, one per line of the text files of a folder."""
    def read(spark: SparkSession) -> DataFrame:
        rows = spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)
        return rows.text(path).selectExpr("value", "0 AS partition", "CAST(0 AS BIGINT) AS offset")

    return read


def table_reader(path: str, schema: T.StructType, max_files: int | None = None) -> Reader:
    def read(spark: SparkSession) -> DataFrame:
        rows = spark.readStream.schema(schema)
        return (rows if max_files is None else rows.option("maxFilesPerTrigger", max_files)).parquet(path)

    return read


def closed_windows(events: DataFrame, slide: Slide, watermark_seconds: int) -> DataFrame:
    """Each window once, when the watermark has passed its end (append mode)."""
    return page_activity(events.withWatermark("event_time", f"{watermark_seconds} seconds"), slide)


def dedupe(events: DataFrame, watermark_seconds: int) -> DataFrame:
    """Replayed events go, as far back as the watermark."""
    return events.withWatermark("event_time", f"{watermark_seconds} seconds").dropDuplicatesWithinWatermark(list(EDIT_KEY))


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def keyed_append(path: str, keys: tuple[str, ...], time: str | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends the rows whose keys the table lacks.

    With ``time``, a column of the key, only the part of the table in the
    batch's range of times is read: statistics of its files exclude the rest.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        have = table_or_empty(batch.sparkSession, path, batch.schema)
        if time is None:
            insert_absent(have, batch, keys).write.mode("append").parquet(path)
            return
        batch = batch.persist()
        span = batch.agg(F.min(time), F.max(time)).first()
        if span[0] is not None:
            insert_absent(have.where(F.col(time).between(*span)), batch, keys).write.mode("append").parquet(path)
        batch.unpersist()

    return write


def start(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None] | None = None, path: str | None = None, name: str | None = None, state_partitions: int | None = None, **trigger: Any):
    """The running query, in append mode, through foreachBatch or into Parquet files.

    ``state_partitions`` is how many partitions a new query's state has, the
    session's shuffle partitions by default; each costs a task a batch, with a Python
    worker if the state is Python's, whether it has keys or not.

    ``trigger`` is one of Spark's, such as processingTime="30 seconds" for a
    service (the default) or availableNow=True; offsets and state are in checkpoint,
    from which a query that is started again goes on.
    """
    out = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger or {"processingTime": "30 seconds"})
    out = out.queryName(name) if name else out
    out = out.foreachBatch(write) if write else out.format("parquet").option("path", path)
    if state_partitions is None:
        return out.start()
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return out.start()  # the query has a copy of the session's settings from here on
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def run_to_end(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None] | None = None, path: str | None = None, name: str | None = None, state_partitions: int | None = None):
    """Process what is there and end."""
    query = start(stream, checkpoint, write, path, name, state_partitions, availableNow=True)
    query.awaitTermination()
    return query

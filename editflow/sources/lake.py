"""The Parquet lake: partitioned writes, pruned scans, drains, archive checks and retention."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators.upsert import insert_absent
from .tables import stored

HOURLY = ("wiki", "date", "hour")
HIERARCHICAL = ("wiki", "year", "month", "day", "hour")
_FORMATS = {"date": "%Y-%m-%d", "hour": "%H", "year": "%Y", "month": "%m", "day": "%d"}


def _partitioned(rows: DataFrame, layout: Sequence[str], time_col: str) -> DataFrame:
    form = {"date": "yyyy-MM-dd", "hour": "HH", "year": "yyyy", "month": "MM", "day": "dd"}
    return rows.withColumns({c: F.date_format(F.col(time_col).cast("timestamp"), form[c]) for c in layout if c in form})


def write_lake(rows: DataFrame, path: str, layout: Sequence[str] = HOURLY, time_col: str = "event_time", mode: str = "append") -> None:
    """Write rows under wiki=/date=/hour= (or year=/month=/day=/hour=), Snappy, zero-padded, by UTC.

    Rows are brought together by their folder and spread by a hash of time, so
    that a folder gets few files and a hot wiki more than one task.  No rows,
    no files.  To overwrite replaces the folders that rows have, no others.
    """
    spread = F.pmod(F.hash(time_col), F.lit(8))
    out = _partitioned(rows, layout, time_col).repartition(*layout, spread)
    out.write.mode(mode).partitionBy(*layout).option("compression", "snappy").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_lake(spark: SparkSession, path: str, columns: Sequence[str] = (), where: str | Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A pruned scan of a lake folder with its partition columns; all columns if none are named.

    A missing or empty folder gives no rows with ``schema`` if that is given.
    """
    try:
        rows = spark.read.option("basePath", path).parquet(path)
    except AnalysisException:
        if schema is None:
            raise
        rows = spark.createDataFrame([], schema)
    if where is not None:
        rows = rows.where(where)
    return rows.select(*columns) if columns else rows


def scan_files(spark: SparkSession, path: str, columns: Sequence[str] = (), where: str | None = None) -> DataFrame:
    """A scan of all files below path, without partition columns."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    rows = rows.where(where) if where else rows
    return rows.select(*columns) if columns else rows


def daily_counts(lake: DataFrame, first: date, last: date) -> DataFrame:
    """Events by date and wiki between two days; only partition columns are read."""
    return lake.where(F.col("date").cast("date").between(F.lit(first), F.lit(last))).groupBy(F.col("date").cast("date").alias("date"), "wiki").agg(F.count(F.lit(1)).alias("events"))


def drain_closed_hours(store: DataFrame, lake: DataFrame, as_of: Column, keys: Sequence[str] = ("event_id",), time_col: str = "event_time") -> DataFrame:
    """The rows of whole hours before as_of that the lake doesn't have: to be written once, however often it runs."""
    return insert_absent(lake, store.where(F.col(time_col) < F.date_trunc("hour", as_of)), keys)


def write_stats(lake: DataFrame) -> DataFrame:
    """One row: rows, files and bytes of the files a lake frame reads."""
    per_file = lake.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"), F.first("_metadata.file_size").alias("bytes"))
    return per_file.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def column_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row of all files below path: files, rows, column bytes before and after compression, their ratio, and the share saved in percent.

    Tasks read the footers; a file of the lake is as much as a task takes in at
    once, and holds one folder's rows or a part of them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("content")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, raw, packed = [], [], []
            for content in batch.column("content"):
                meta = pq.read_metadata(pa.BufferReader(content.as_buffer()))
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                chunks = [g.column(j) for g in groups for j in range(g.num_columns)]
                rows.append(meta.num_rows)
                raw.append(sum(c.total_uncompressed_size for c in chunks))
                packed.append(sum(c.total_compressed_size for c in chunks))
            yield pa.RecordBatch.from_pydict({"rows": pa.array(rows, pa.int64()), "raw": pa.array(raw, pa.int64()), "packed": pa.array(packed, pa.int64())})

    each = files.mapInArrow(footers, "rows long, raw long, packed long")
    total = each.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sum("raw").alias("column_bytes"), F.sum("packed").alias("compressed_bytes"))
    share = F.col("compressed_bytes") / F.nullif(F.col("column_bytes"), F.lit(0))
    return total.withColumns({"ratio": F.round(1 / share, 3), "saved_percent": F.round(100 * (1 - share), 2)})


def column_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows (column, least, greatest, nulls) of whole-number columns, from the statistics in the footers of all files below path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("content")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for content in batch.column("content"):
                meta = pq.read_metadata(pa.BufferReader(content.as_buffer()))
                for i in range(meta.num_row_groups):
                    group = meta.row_group(i)
                    for j in range(group.num_columns):
                        chunk = group.column(j)
                        if chunk.path_in_schema in columns and chunk.statistics is not None:
                            s = chunk.statistics
                            found.append((chunk.path_in_schema, s.min if s.has_min_max else None, s.max if s.has_min_max else None, s.null_count))
            names = ("column", "least", "greatest", "nulls")
            yield pa.RecordBatch.from_pydict({n: pa.array([x[i] for x in found], pa.string() if i == 0 else pa.int64()) for i, n in enumerate(names)})

    each = files.mapInArrow(footers, "column string, least long, greatest long, nulls long")
    return each.groupBy("column").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.sum("nulls").alias("nulls"))


def json_reduction(lake: DataFrame) -> DataFrame:
    """One row: bytes of the rows as JSON lines, of the files that hold them, and by how many percent these are fewer."""
    line = F.octet_length(F.to_json(F.struct(*lake.columns))) + 1
    per_file = lake.groupBy("_metadata.file_path").agg(F.sum(line).alias("json"), F.first("_metadata.file_size").alias("bytes"))
    total = per_file.agg(F.sum("json").alias("json_bytes"), F.sum("bytes").alias("file_bytes"))
    return total.withColumn("reduction_percent", F.round(100 * (1 - F.col("file_bytes") / F.nullif(F.col("json_bytes"), F.lit(0))), 2))


def _slot(time: datetime, layout: Sequence[str]) -> tuple:
    """The values of the layout's time columns for a time, as numbers and as an ISO date, in the order of time."""
    parts = {"date": time.strftime("%Y-%m-%d"), "year": time.year, "month": time.month, "day": time.day, "hour": time.hour}
    return tuple(parts[c] for c in layout if c in parts)


def _slot_columns(layout: Sequence[str], value: Callable[[str], Column]) -> Column:
    return F.struct(*[value(c).cast("string" if c == "date" else "int").alias(c) for c in layout if c in ("date", "year", "month", "day", "hour")])


def lake_files(spark: SparkSession, path: str, layout: Sequence[str] = HOURLY) -> DataFrame:
    """Rows (path, folder, slot): the files of a lake with the time columns of their folders, by name; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")
    named = lambda c: F.regexp_extract("path", f"/{c}=([^/]+)/", 1)
    return files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), _slot_columns(layout, named).alias("slot"))


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    local = re.match(r"file:/*(/.*)", path)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(path)


def _delete_folders(rows: Iterator[Row]) -> None:
    for r in rows:
        system, folder = _file_system(r[0])
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


def _delete_files(rows: Iterator[Row]) -> None:
    for r in rows:
        system, file = _file_system(r[0])
        if system.get_file_info(file).type == fs.FileType.File:
            system.delete_file(file)


def retain(spark: SparkSession, path: str, cutoff: datetime, layout: Sequence[str] = HOURLY, time_col: str = "event_time") -> None:
    """Remove what is before the cutoff, exact to the microsecond, from a lake folder.

    Folders of earlier hours are known by their names, and tasks delete them;
    only those of the cutoff's own hour are read, and written anew from a copy of
    the rows they keep.  Run again it finds nothing to do; one cut off midway
    goes on where it stopped.  Tasks reach the store through Arrow's file systems
    (local, HDFS, S3, GCS, Azure).
    """
    at = F.struct(*[F.lit(x) for x in _slot(cutoff, layout)])
    files = stored(lake_files(spark, path, layout).where(F.col("slot") <= at), "files")  # as they are before anything changes
    divided = files.where(F.col("slot") == at).select("path")
    if not divided.isEmpty():
        rows = spark.read.option("basePath", path).parquet(f"{path}/{_slot_glob(cutoff, layout)}")
        if not rows.where(F.col(time_col) < F.lit(cutoff)).isEmpty():
            kept = stored(rows.where(F.col(time_col) >= F.lit(cutoff)), "kept")
            write_lake(kept, path, layout, time_col, mode="overwrite")
            divided.foreachPartition(_delete_files)  # those of folders that keep nothing are still there
    files.where(F.col("slot") < at).select("folder").distinct().foreachPartition(_delete_folders)


def _slot_glob(time: datetime, layout: Sequence[str]) -> str:
    """The folders of a time, as a pattern."""
    return "/".join(f"{c}={time.strftime(_FORMATS[c])}" if c in _FORMATS else f"{c}=*" for c in layout)


def retention_split(rows: DataFrame, cutoff: Column, time_col: str = "event_time") -> DataFrame:
    """The rows with `kept`: false for those before the cutoff, exact to the microsecond."""
    return rows.withColumn("kept", F.col(time_col) >= cutoff)


def expired_days(rows: DataFrame, cutoff: Column, time_col: str = "event_time") -> DataFrame:
    """Days that end at or before the cutoff."""
    days = rows.select(F.to_date(time_col).alias("day")).distinct()
    return days.where(F.date_add("day", 1).cast("timestamp") <= cutoff)


def archived_days(store: DataFrame, lake: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Days of the store of which the lake has as many rows."""
    count = lambda df, name: df.groupBy(F.to_date(time_col).alias("day")).agg(F.count(F.lit(1)).alias(name))
    return count(store, "stored").join(count(lake, "archived"), "day").where(F.col("archived") >= F.col("stored"))


def drain_before_drop(store: DataFrame, lake: DataFrame, cutoff: Column, keys: Sequence[str] = ("event_id",), time_col: str = "event_time") -> DataFrame:
    """Rows of expired days that the lake doesn't have yet: to be archived before the days are dropped."""
    expired = store.where(F.date_add(F.to_date(time_col), 1).cast("timestamp") <= cutoff)
    return insert_absent(lake, expired, keys)


def days_to_cover(spark: SparkSession, cutoff: Column, as_of: Column, horizon: int = 3, source: DataFrame | None = None) -> DataFrame:
    """The days from the cutoff's to horizon days after as_of."""
    one = source if source is not None else spark.range(1)
    return one.select(F.explode(F.sequence(F.to_date(cutoff), F.date_add(F.to_date(as_of), horizon))).alias("day"))


def missing_days(wanted: DataFrame, rows: DataFrame, time_col: str = "event_time") -> DataFrame:
    return wanted.join(rows.select(F.to_date(time_col).alias("day")).distinct(), "day", "left_anti")


def partition_health(rows: DataFrame, wanted: DataFrame, time_col: str = "event_time") -> DataFrame:
    """One row: rows outside the wanted days, missing days, and OK, WARNING (days missing) or CRITICAL (rows outside)."""
    per_day = rows.groupBy(F.to_date(time_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    both = per_day.join(wanted.withColumn("wanted", F.lit(True)), "day", "full_outer")
    sums = both.agg(F.coalesce(F.sum(F.when(F.col("wanted").isNull(), F.col("n"))), F.lit(0)).alias("overflow_rows"), F.count_if(F.col("n").isNull()).alias("missing_days"))
    return sums.withColumn("status", F.when(F.col("overflow_rows") > 0, "CRITICAL").when(F.col("missing_days") > 0, "WARNING").otherwise("OK"))

"""Sinks of several tables at once, and of an ordered topic, under one commit for each batch.

A batch writes each table into a folder of its own, which a replay overwrites,
and then its commit.  Readers see committed batches only, so a table is never
ahead of the others, and a batch that was cut off midway isn't seen at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMITS = "_commits"
#: Runs of a topic partition's batch at most; beyond them runs grow.
MOST_RUNS = 1 << 10


def _folder(root: str, name: str, batch_id: int) -> str:
    return f"{root}/{name}/batch={batch_id}"


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _commit(spark: SparkSession, root: str, batch_id: int) -> None:
    """Note that a batch is whole.  Batches come one after the other, so the newest note stands for all before it."""
    system, where = _file_system(spark, f"{root}/{_COMMITS}/{batch_id}")
    system.create(where, True).close()
    for status in system.listStatus(where.getParent()):
        if status.getPath().getName().isdigit() and int(status.getPath().getName()) < batch_id:
            system.delete(status.getPath(), False)


def last_committed(spark: SparkSession, root: str) -> int | None:
    """The newest batch that is whole, or None before the first."""
    system, where = _file_system(spark, f"{root}/{_COMMITS}")
    names = [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []
    return max((int(n) for n in names if n.isdigit()), default=None)


def tables_sink(root: str, tables: dict[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each of the tables made of a batch, and then commits the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, of in tables.items():
                of(batch).write.mode("overwrite").parquet(_folder(root, name, batch_id))
            _commit(batch.sparkSession, root, batch_id)
        finally:
            batch.unpersist()

    return write


def read_committed(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """A table's rows of committed batches, with their batch; without any, no rows."""
    last = last_committed(spark, root)
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if last is None:
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).option("basePath", f"{root}/{name}").parquet(f"{root}/{name}/batch=*")
    return rows.where(F.col("batch") <= last)  # folders of other batches aren't read


def topic_sink(root: str, partitions: int, order: tuple[str, ...], run: int = 1 << 17) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends rows (key, value, ...) to an ordered topic.

    A key's hash names its partition, so a key's messages are all in one; within
    a batch they lie in the order of ``order``, which decides ties by value, and
    offsets count on from batch to batch without gaps.  A replayed batch takes
    the offsets that it had.  Runs of some ``run`` messages, cut by the first
    column of the order (a number or a time), are put in order by a task each;
    how many messages there are before a run is known from counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partition = F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
        ends = _ends_before(spark, root, batch_id)
        first = F.col(order[0])
        pieces = min(MOST_RUNS, -(-batch.count() // (run * partitions)))
        cuts = batch.agg(F.percentile_approx(first, [i / pieces for i in range(1, pieces)])).first()[0] if pieces > 1 else None
        # how many cuts are below a message: none, if it lacks the column, as nulls come first
        of_run = F.size(F.filter(F.lit(cuts), lambda cut: cut < first)) if cuts else F.lit(0)
        parted = batch.withColumns({"partition": partition, "__run": of_run})
        counts = parted.groupBy("partition", "__run").agg(F.count(F.lit(1)).alias("__size"))
        until = F.sum("__size").over(Window.partitionBy("partition").orderBy("__run")) - F.col("__size")
        begins = counts.join(F.broadcast(ends.limit(partitions)), "partition", "left").select("partition", "__run", (F.coalesce("end", F.lit(0)) + until).alias("__begin"))
        in_order = Window.partitionBy("partition", "__run").orderBy(*order, "value")
        placed = parted.withColumn("__n", F.row_number().over(in_order))
        rows = placed.join(begins, ["partition", "__run"]).withColumn("offset", F.col("__begin") + F.col("__n") - 1)
        rows.select("partition", F.col("offset").cast("long").alias("offset"), "key", "value").sortWithinPartitions("partition", "offset").write.mode("overwrite").partitionBy("partition").parquet(_folder(root, "topic", batch_id))
        new = spark.read.schema("partition int, offset long").parquet(_folder(root, "topic", batch_id)).select("partition", (F.col("offset") + 1).alias("end"))
        new.unionByName(ends).groupBy("partition").agg(F.max("end").alias("end")).coalesce(1).write.mode("overwrite").parquet(_folder(root, "_ends", batch_id))
        _commit(spark, root, batch_id)

    return write


def _ends_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """Rows (partition, end): the offset that each partition's next message takes, as the batch before has left it; a row a partition."""
    system, where = _file_system(spark, f"{root}/_ends")
    have = [int(s.getPath().getName().removeprefix("batch=")) for s in system.listStatus(where)] if system.exists(where) else []
    last = last_committed(spark, root)
    before = max((b for b in have if b < batch_id and last is not None and b <= last), default=None)
    if before is None:
        return spark.createDataFrame([], "partition int, end long")
    for old in sorted(have):
        if old < before - 1:  # a replay needs those of the batch before its own
            system.delete(_file_system(spark, _folder(root, "_ends", old))[1], True)
    return spark.read.schema("partition int, end long").parquet(_folder(root, "_ends", before))


def read_topic(spark: SparkSession, root: str) -> DataFrame:
    """The committed messages of a topic: partition, offset, key, value and their batch."""
    fields = [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("value", T.StringType())]
    return read_committed(spark, root, "topic", T.StructType(fields))

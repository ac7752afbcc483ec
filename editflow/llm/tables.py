"""Tables that more than one job reads, written once to the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where that is unset (tests), a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it none of df's columns, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and return a reader of it.

    This cuts the lineage: later jobs, and tasks that are run again after an
    executor was lost, read the table.  The files go when `forget` is called,
    or else when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = _hadoop_path(spark, path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    table = spark.read.schema(df.schema).parquet(path)
    table._settled_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete settled tables that no DataFrame still to be computed reads."""
    for table in tables:
        spark = table.sparkSession
        where = _hadoop_path(spark, table._settled_at)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

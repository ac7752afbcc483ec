"""Keyed writes over Parquet tables: first write wins, last write wins, and the newest of duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def newest(rows: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key: the one that comes last by order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order.desc()))
    return rows.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def insert_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """The rows to append: one per key, of those the target has none of.

    Of rows with one key the first by order is taken; without an order, the one
    whose columns have the smallest hash, so that a run again takes the same.
    """
    first = F.xxhash64(*rows.columns) if order is None else order
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(first))
    fresh = rows.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")
    return fresh.join(target.select(*keys), list(keys), "left_anti")


def merge_update(target: DataFrame, rows: DataFrame, keys: Sequence[str], keep_old: Sequence[str] = (), fill: Sequence[str] = ()) -> DataFrame:
    """The table after an upsert in which rows win.

    Columns in keep_old aren't updated; those in fill are, unless the new value
    is null.  rows has one row per key.
    """
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*rest).alias("__old"))
    new = rows.select(*keys, F.struct(*rest).alias("__new"))
    both = old.join(new, list(keys), "full_outer")
    was, has = F.col("__old").isNotNull(), F.col("__new").isNotNull()

    def value(c: str) -> Column:
        before, after = F.col(f"__old.{c}"), F.col(f"__new.{c}")
        if c in keep_old:
            return F.when(was, before).otherwise(after)
        if c in fill:
            return F.coalesce(after, before)
        return F.when(has, after).otherwise(before)

    return both.select(*keys, *(value(c).alias(c) for c in rest)).select(*target.columns)

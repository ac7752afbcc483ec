"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups, keep the smallest id.

DataFrame functions only.  The aggregation is keyed by the hash and the text
itself, so that Spark's hash table compares the bytes of rows whose hashes
agree, and collisions become groups of their own.  A hot group is collapsed to
one row per map task before the shuffle.  Only groups of several rows are handed
back to their rows, in a join whose key is salted, so that a hot group's rows are
spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .tables import free_names

#: Tasks that the rows of one group are spread over at least.
SALTS = 16
#: White space as the contract defines it.
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def content_hash(text: Column) -> Column:
    """The 128-bit content hash, 16 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """One row per group of equal texts: hash, text_sha256, keep_id, group_size.

    keep_id is the smallest id (null only if all ids of the group are).  Rows
    are counted as they stand, so repeated rows count each time.  Were two
    different texts of one hash to share their SHA-256 as well, the job would
    stop with an error instead of merging them.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    by_bytes = rows.groupBy(hash_of(F.col("norm")).alias("hash"), "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = by_bytes.select("hash", F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"), "keep_id", "group_size")
    addressed = groups.groupBy("hash", "text_sha256").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    sole = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share both of their hashes")).cast("long"))
    return addressed.select("hash", "text_sha256", "keep_id", sole.alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """For every row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal to each other.  A row is kept if its id is
    its group's smallest; of repeated rows with one id each is marked kept.  A
    null id is kept only where its whole group has none.  Extra columns of docs
    are not read.  An empty table gives no rows.
    """
    norm = normalised(F.col(text_col))
    salt = F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), hash_of(norm).alias("hash"), F.sha2(F.encode(norm, "UTF-8"), 256).alias("text_sha256"), salt.alias("salt"))
    several = exact_groups(docs, id_col, text_col, hash_of).where(F.col("group_size") > 1).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = rows.join(several, ["hash", "text_sha256", "salt"], "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return found.select(F.col("id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; one row per group of equal texts.

    Rows and groups meet by content hash, text hash and id together.  Of rows
    repeated with one id and text the one with the smallest hash of its columns
    stays; each task leaves one of them before the shuffle.
    """
    norm = normalised(F.col(text_col))
    hashed = [f.name for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    digest, sha256, own, order, copy = free_names(docs, "__hash", "__sha256", "__id", "__order", "__copy")
    added = {digest: content_hash(norm), sha256: F.sha2(F.encode(norm, "UTF-8"), 256), own: F.struct(F.col(id_col).alias("id")), order: F.xxhash64(*hashed)}
    rows = docs.withColumns(added)
    once = rows.withColumn(copy, F.row_number().over(Window.partitionBy(digest, sha256, own).orderBy(order))).where(F.col(copy) == 1)
    # a struct, since a null id inside it equals another
    kept = exact_groups(docs, id_col, text_col).select(F.col("hash").alias(digest), F.col("text_sha256").alias(sha256), F.struct(F.col("keep_id").alias("id")).alias(own))
    return once.join(kept.hint("shuffle_hash"), [digest, sha256, own], "left_semi").select(*docs.columns)

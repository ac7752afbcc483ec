"""From raw documents to packed training sequences, stage by stage.

Each stage takes all its predecessor kept.  All but the last return the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from editflow.llm.exact_dedup import drop_exact_copies
from editflow.llm.ngram_join import drop_near_copies
from editflow.llm.packing import best_fit_packing
from editflow.llm.quality_pu import fit_quality, keep_quality
from editflow.llm.secret_scan import redact, scan_secrets
from editflow.llm.tables import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score below 0.7 go, null and empty ones by the score of an empty text.  Each row is judged by its own text, whatever its id; repeated rows alike."""
    return keep_quality(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), threshold=0.7)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, null and empty ones among them, the one with the smallest id stays; of rows that agree in both, one."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at a similarity of 0.8, the one with the smallest id stays; rows that share an id, or have none, are judged each by its text."""
    return drop_near_copies(docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts they were found in; every row stays.  Findings are known by id and text together, so that rows that share an id keep apart."""
    return redact(docs, scan_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, each with its sequence and its place there; rows are packed each, whatever their ids, null and empty texts as their end token."""
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: Models are trained and sequences packed; SQL can't express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the documents of sf_dir; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

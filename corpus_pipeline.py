"""A corpus pipeline: select by quality, remove exact and near copies, remove benchmark passages, pack into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's documents. All stages but the
last return the columns of ``documents``. Nulls, empty texts, repeated rows and empty tables are treated as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aqspark.llm import contamination, exact, packing, quality, simhash
from aqspark.llm.common import stage_compact, table
from aqspark.llm.queries import TOKENIZER, importable


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a sound grade is at least one half."""
    return quality.select(docs, quality.grades(table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = packing.pack(docs, TOKENIZER)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality", select_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
#: Classifier, fingerprints and tokenizer can't be expressed in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage_compact(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

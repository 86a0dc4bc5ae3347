"""Corpus preparation end to end: filter, deduplicate, redact, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes every stage's result
as Parquet below the cluster's checkpoint folder and reads it back for the
next one, so a lost executor never re-runs an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlens.llm import mixing, packing, pii, quality, simhash
from textlens.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality rules let pass.  Null and empty texts
    fall; repeated rows are judged alike.  An empty table gives no rows."""
    return quality.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest
    id.  Blank texts are copies of each other; rows without an id stay.  An empty table gives no rows."""
    return simhash.drop_near_duplicates(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts.  Every row stays, null and empty texts
    and repeated rows as they are.  An empty table gives no rows."""
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and cut the sources' documents to their weights.  Null texts have
    no words; a null source is a source of its own; equal rows are
    interchangeable.  An empty table gives no rows."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into token sequences, one row per piece.  A null or
    empty text is a document of the end mark alone.  An empty table gives no rows."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: EM, XXH64 fingerprints and tokenizers are beyond SQL; the stages are tested
#: against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; the last one's rows.  An
    empty table gives none.  Very long texts stay rows like any other."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs

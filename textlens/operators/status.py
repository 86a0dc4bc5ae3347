"""Status rows: service health and corpus readiness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_CORPUS_BYTES = 1000


def health(index_docs: DataFrame | None, dictionary: DataFrame | None) -> DataFrame:
    """One row: status, documents_loaded, index_ready, spell_checker_ready,
    vocabulary_size.  Counts are scalar subqueries (no join)."""
    base = (index_docs if index_docs is not None else dictionary).sparkSession.range(1)
    n_docs = index_docs.select(F.count(F.lit(1))).scalar() if index_docs is not None else F.lit(0)
    n_words = dictionary.select(F.count(F.lit(1))).scalar() if dictionary is not None else F.lit(0)
    return base.select(
        F.lit("healthy").alias("status"),
        n_docs.cast("bigint").alias("documents_loaded"),
        F.lit(index_docs is not None).alias("index_ready"),
        F.lit(dictionary is not None).alias("spell_checker_ready"),
        n_words.cast("bigint").alias("vocabulary_size"),
    )


def corpus_ready(records: DataFrame, text_col: str = "text", min_bytes: int = MIN_CORPUS_BYTES) -> DataFrame:
    """One row: corpus_bytes (as a blank-line separated UTF-8 file),
    ready, reason."""
    agg = records.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.col(text_col)) + 2), F.lit(0)).cast("bigint").alias("corpus_bytes"))
    reason = (
        F.when(F.col("n") == 0, F.lit("corpus not found"))
        .when(F.col("corpus_bytes") < min_bytes, F.lit("corpus too small"))
        .otherwise(F.lit("ok"))
    )
    return agg.select("corpus_bytes", (F.col("corpus_bytes") >= min_bytes).alias("ready"), reason.alias("reason"))

"""Corpus sources and sinks (blank-line separated text, or a table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.functions.text import collapse_ws, strip

# A record is kept when its stripped text is longer than this.
MIN_RECORD_CHARS = 50


def read_corpus_text(spark: SparkSession, path: str, crlf: bool = False,
                     min_chars: int = MIN_RECORD_CHARS) -> DataFrame:
    """Read a corpus file of ``title\\ncontent`` records separated by a blank
    line.  Records are stripped and kept when longer than ``min_chars``.

    Windows files (``crlf=True``) are split on ``\\r\\n\\r\\n`` and their line
    ends normalised to ``\\n``.  A record's id is the hash of its text and of
    its number among equal texts, so it depends on neither file splits nor
    the order of reading.
    """
    sep = "\r\n\r\n" if crlf else "\n\n"
    raw = spark.read.option("lineSep", sep).text(path)
    text = F.col("value")
    if crlf:
        text = F.regexp_replace(text, "\r\n", "\n")
    out = raw.select(strip(text).alias("text")).where(F.length("text") > min_chars)
    # equal records are interchangeable: count them, then number the copies
    copies = out.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    numbered = copies.select("text", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    return numbered.select(F.xxhash64("text", "copy").alias("doc_id"), "text")


def corpus_from_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = MIN_RECORD_CHARS) -> DataFrame:
    """The searchable corpus of a documents table: stripped text, records of
    more than ``min_chars`` characters.  Filter and projection reach the
    Parquet scan (only the two columns are read)."""
    return (
        docs.select(F.col(id_col).alias("doc_id"), strip(F.col(text_col)).alias("text"))
        .where(F.length("text") > min_chars)
    )


def write_corpus_text(items: DataFrame, path: str, mode: str = "append") -> None:
    """Append extracted pages as ``title\\ncontent`` records separated by a
    blank line.  Whitespace inside the title is collapsed so a title can never
    split a record on re-read."""
    (
        items.select(F.concat(collapse_ws("title"), F.lit("\n"), F.col("content")).alias("value"))
        .write.mode(mode)
        .option("lineSep", "\n\n")
        .text(path)
    )

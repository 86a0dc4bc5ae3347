"""An index that grows with a stream of documents.

Every micro-batch writes a segment: its documents, their term statistics
(term, df, cf; the null term counts the documents) and their postings.  A
segment's folder is named by its batch and overwritten when the batch is
replayed, so nothing counts twice.  Statistics of the whole index are the
segments' sums; weights follow from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.functions.words import ENGLISH_STOP_WORDS
from textlens.operators.common import write_table
from textlens.operators.postings import build_postings
from textlens.operators.tfidf import TfidfIndex, choose_vocabulary, text_statistics, weigh_documents
from textlens.sources.corpus import corpus_from_table

PARTS = ("documents", "terms", "postings")


def write_segment(docs: DataFrame, out: str, segment: str, stop_words=ENGLISH_STOP_WORDS, bigrams: bool = True) -> None:
    """One segment of (doc_id, text) documents, replacing an earlier one of
    the same name."""
    place = {p: f"{out}/{p}/segment={segment}" for p in PARTS}
    # a batch may be one file: its texts are dealt to all cores first
    cores = docs.sparkSession.sparkContext.defaultParallelism
    docs.select("doc_id", "text").repartition(cores).write.mode("overwrite").parquet(place["documents"])
    held = docs.sparkSession.read.schema(docs.select("doc_id", "text").schema).parquet(place["documents"])
    text_statistics(held, "text", stop_words, bigrams).write.mode("overwrite").parquet(place["terms"])
    build_postings(held).write.mode("overwrite").parquet(place["postings"])


def start_index_stream(spark: SparkSession, source: str, out: str, checkpoint: str, schema: str, fmt: str = "parquet",
                       glob: str | None = None, max_files: int | None = None, stop_words=ENGLISH_STOP_WORDS,
                       bigrams: bool = True):
    """Index the documents that arrive as files of (doc_id, text, ...)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)

    def add(batch: DataFrame, batch_id: int) -> None:
        write_segment(corpus_from_table(batch), out, f"{batch_id:09d}", stop_words, bigrams)

    return reader.load(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def merged_statistics(spark: SparkSession, out: str) -> DataFrame:
    """(term, df, cf) over all segments."""
    return spark.read.parquet(f"{out}/terms").groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def merge_segments(spark: SparkSession, out: str) -> DataFrame:
    """The segments' statistics as a single one, to be summed on later."""
    return write_table(merged_statistics(spark, out), "index-merged")


def index_of_segments(spark: SparkSession, out: str, max_features: int | None = 5000, min_df=1, max_df=0.8,
                      stop_words=ENGLISH_STOP_WORDS, bigrams: bool = True) -> TfidfIndex:
    """The index that a fit on all segments' documents would give; the
    vocabulary comes from the segments' statistics, so only the weights read
    the texts."""
    stats = merge_segments(spark, out)
    total = stats.where("term IS NULL").first()
    if total is None:
        raise ValueError("No documents to index")
    vocab = write_table(choose_vocabulary(stats, total["df"], max_features, min_df, max_df), "tfidf-vocabulary")
    docs = spark.read.parquet(f"{out}/documents").select("doc_id", "text")
    n_terms = vocab.count()
    vectors = weigh_documents(docs, vocab, n_terms, stop_words, bigrams)
    return TfidfIndex(docs=docs, vocab=vocab, vectors=write_table(vectors, "tfidf-vectors"),
                      n_docs=total["df"], stop_words=tuple(stop_words), bigrams=bigrams, max_features=max_features,
                      n_terms=n_terms)

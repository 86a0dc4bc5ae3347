"""Query stream: requests arrive as files, each micro-batch is answered
against the static index and appended to the logs.

Sinks are written with ``foreachBatch`` into one folder per batch id
(overwrite), so a batch replayed after a failure replaces its own output
and never duplicates log rows; the checkpoint records finished batches.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from textlens.operators.search import search
from textlens.operators.tfidf import TfidfIndex
from textlens.plans.search_service import search_with_spelling
from textlens.sources.logs import CSV, query_log, result_log


def start_query_stream(spark: SparkSession, source: str, schema: str, index: TfidfIndex, out: str,
                       checkpoint: str, k: int = 5, dictionary: DataFrame | None = None,
                       fmt: str = "parquet", available_now: bool = True,
                       glob: str | None = None, rename: dict | None = None,
                       max_files: int | None = None, dict_keys: DataFrame | None = None):
    """Start the stream.  ``source`` rows need (query_id, query_text[, top_k,
    auto_correct]) (``rename`` maps source columns).  With a dictionary the full request path (validation, spell
    check) runs; without, plain top-k search.

    Output folders, ``R`` standing for the checkpoint: ``out/results/run=R/
    batch=N`` (Parquet) and the CSV logs with header ``out/queries/run=R/
    batch=N`` and ``out/result_log/run=R/batch=N``, which hold accepted
    requests only.  A stream that starts over with a new checkpoint writes
    beside the old logs, not over them."""
    stream = _reader(spark, schema, fmt, glob, max_files).load(source)
    for old, new in (rename or {}).items():
        stream = stream.withColumnRenamed(old, new)
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def answer(batch: DataFrame, batch_id: int) -> None:
        place = f"run={run}/batch={batch_id}"
        batch = batch.persist()  # read several times; its source files once
        try:
            accepted = batch
            if dictionary is not None:
                res = search_with_spelling(index, dictionary, batch, preview=False, dict_keys=dict_keys)
                hits = res.results
                accepted = res.requests.where("status = 'success'").withColumnRenamed("query", "query_text")
            else:
                hits = search(index, batch, k)
            hits.select("query_id", "rank", "doc_id", "score").write.mode("overwrite").parquet(
                f"{out}/results/{place}")
            query_log(accepted).write.mode("overwrite").options(**CSV).csv(f"{out}/queries/{place}")
            result_log(spark.read.parquet(f"{out}/results/{place}")).write.mode("overwrite").options(**CSV).csv(
                f"{out}/result_log/{place}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def _reader(spark: SparkSession, schema: str, fmt: str, glob: str | None, max_files: int | None):
    """File stream reader over a folder; ``glob`` keeps matching file names,
    ``max_files`` bounds the files of one batch."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.option("pathGlobFilter", glob) if glob else r

"""Page stream: fetched pages arrive as files, are extracted (stateless)
and appended to a Parquet corpus sink; the checkpoint makes the append
exactly-once across restarts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from textlens.operators.pages import extract_documents, walk

PAGE_SCHEMA = "page_id long, url string, html string"


def start_page_stream(spark: SparkSession, source: str, out: str, checkpoint: str, fmt: str = "parquet",
                      available_now: bool = True, only_ok: bool = False, glob: str | None = None):
    pages = _reader(spark, PAGE_SCHEMA, fmt, glob).load(source)
    docs = extract_documents(walk(pages))
    if only_ok:
        docs = docs.where("ok")
    writer = (
        docs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def _reader(spark: SparkSession, schema: str, fmt: str, glob: str | None):
    """File stream reader over a folder; ``glob`` keeps matching file names."""
    r = spark.readStream.schema(schema).format(fmt)
    return r.option("pathGlobFilter", glob) if glob else r

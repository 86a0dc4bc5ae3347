"""The operators' registered queries and, where SQL can express them, their
DuckDB SQL.  Every query reads the whole of its table."""

from __future__ import annotations

import corpus_pipeline
from textlens.llm import (alignment, hamming, langid, mixing, packing, pii, quality, repeats, revisits, simhash, toxicity,
                          urlfilter, variants)
from textlens.llm.common import table


def _over(name, run):
    return lambda spark, sf_dir: run(table(spark, sf_dir, name))


def _documents(run):
    return _over("documents", run)


QUERIES = {
    "op1_pii_spans": _documents(pii.pii_query),
    "op2_repeated_strings": _documents(repeats.repeats_query),
    "op3_simhash_near_dedup": _documents(simhash.simhash_query),
    "op4_quality_rules": _documents(quality.quality_query),
    "op5_url_filter": _over("pages", urlfilter.url_query),
    "op6_warc_revisits": _over("pages", revisits.revisits_query),
    "op7_hamming_top_k": _over("embeddings", hamming.hamming_query),
    "op8_language_id": _documents(langid.langid_query),
    "op9_retrieval_packing": _documents(packing.pack_query),
    "op10_mix_sources": _documents(mixing.mix_query),
    "op11_toxic_segments": lambda spark, sf_dir: toxicity.toxicity_query(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op12_token_alignment": _documents(alignment.alignment_query),
    "op13_spelling_variants": _documents(variants.variants_query),
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op6_warc_revisits": revisits.SQL,
    "op7_hamming_top_k": hamming.SQL,
    "op10_mix_sources": mixing.SQL,
}

"""Retrieval of the packing operator."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlens.llm import packing


def test_tokens_of_a_third_of_the_documents_are_indexed(spark):
    rng = np.random.default_rng(3)
    # three groups in turn, all tokens of a group in each of its documents
    rows = [(i, bytearray(rng.permutation(np.arange(200 * (i % 3) + 2, 200 * (i % 3) + 202)).astype("<u4").tobytes()))
            for i in range(60)]
    tokens = spark.createDataFrame(rows, "doc_id long, ids binary").coalesce(1)
    out = packing.pack_tokens(tokens, window=1000).groupBy("sequence_id").agg(
        F.sum("length").alias("n"), F.count_distinct(F.col("doc_id") % 3).alias("groups")).collect()
    full = [r["groups"] for r in out if r["n"] == 1000]
    assert len(full) == 12 and sum(g == 1 for g in full) >= 10


def test_scores_count_all_tokens_of_the_seed():
    rng = np.random.default_rng(5)
    rests = [rng.integers(0, 300, size=n).astype(np.uint32) for n in rng.integers(50, 400, size=40)]
    idf, mean = rng.uniform(0.01, 3, size=300), 200.0
    index = packing.Shard(rests, idf, mean)

    def bm25(seed, other):
        tf = {t: int((other == t).sum()) for t in np.unique(seed)}
        norm = 1.2 * (1 - 0.75 + 0.75 * len(other) / mean)
        return sum(idf[t] * f * 2.2 / (f + norm) for t, f in tf.items())

    for seed in (0, 11):
        assert index.scores(seed) == pytest.approx([bm25(rests[seed], r) for r in rests])
    free = np.arange(40) % 3 > 0
    index.drop(free)
    want = [bm25(rests[4], r) * f for r, f in zip(rests, free)]
    assert index.scores(4) == pytest.approx(want)


def test_frequencies_counted_while_tokenizing(spark):
    docs = spark.createDataFrame([(i if i % 3 else None, t) for i, t in enumerate(
        ["the cat", None, "", "the the dog", "<|endoftext|> cat", "long " * 3000] * 40)], "doc_id long, text string")
    tokens = packing.tokenize(docs.repartition(3), counts=True).persist()
    try:
        plain = packing.tokenize(docs)
        assert packing.token_statistics(tokens) == packing.token_statistics(plain)
        rows = tokens.where("ids IS NOT NULL").select("doc_id", "ids")
        assert rows.exceptAll(plain).count() == 0 == plain.exceptAll(rows).count()
        ids = [np.frombuffer(r["ids"], "<u4") for r in plain.collect()]
        found, n, mean = packing.token_statistics(tokens)
        assert n == 240 and mean == pytest.approx(np.mean([len(x) % packing.WINDOW for x in ids]))
        assert found == {t: sum(t in x for x in ids) for t in set(np.concatenate(ids).tolist())}
    finally:
        tokens.unpersist()
    assert packing.token_statistics(packing.tokenize(docs.limit(0), counts=True)) == ({}, 0, 0.0)

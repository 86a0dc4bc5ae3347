"""TF-IDF fit and ranked search against a pure-Python brute force."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import docs_df
from textlens.functions.words import ENGLISH_STOP_WORDS
from textlens.operators.search import search
from textlens.operators.tfidf import fit_tfidf

STOP = set(ENGLISH_STOP_WORDS)


def brute_terms(text):
    toks = [t for t in re.findall(r"(?u)\b\w\w+\b", text.lower()) if t not in STOP]
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]


def brute_fit(texts, max_features=5000, max_df=0.8):
    n = len(texts)
    tfs = [Counter(brute_terms(t)) for t in texts]
    df = Counter(t for tf in tfs for t in tf)
    cf = Counter()
    for tf in tfs:
        cf.update(tf)
    kept = [t for t in df if 1 <= df[t] <= max_df * n]
    kept.sort(key=lambda t: (-cf[t], t))
    vocab = kept[:max_features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    weights = []
    for tf in tfs:
        w = {t: c * idf[t] for t, c in tf.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        weights.append({t: v / norm for t, v in w.items()} if norm else {})
    return vocab, idf, weights


def brute_search(texts, queries, k, **kw):
    vocab, idf, weights = brute_fit(texts, **kw)
    out = {}
    for qi, q in enumerate(queries):
        tf = Counter(brute_terms(q))
        w = {t: c * idf[t] for t, c in tf.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        w = {t: v / norm for t, v in w.items()} if norm else {}
        scores = [(round(sum(w.get(t, 0) * dw.get(t, 0) for t in w), 6), d) for d, dw in enumerate(weights)]
        scores.sort(key=lambda x: (-x[0], x[1]))
        out[qi] = scores[:k]
    return out


HAND = [
    "Search engines rank every document; search engines use term weights.",
    "Every document about ranking mentions term weights and search engines twice.",
    "The of and to a in is it",  # stop words only: counts in N, no weights
]


def test_hand_corpus_matches_brute_force(spark):
    idx = fit_tfidf(docs_df(spark, HAND))
    vocab, idf, weights = brute_fit(HAND)
    got = {r["term"]: r["idf"] for r in idx.vocab.collect()}
    assert set(got) == set(vocab)
    for t in vocab:
        assert got[t] == pytest.approx(idf[t])
    assert idx.n_docs == 3
    w = {(r["doc_id"], r["term"]): r["w"] for r in idx.weights.collect()}
    for d, dw in enumerate(weights):
        for t, v in dw.items():
            assert w[(d, t)] == pytest.approx(v)
    assert not any(d == 2 for d, _ in w)  # stop-word-only document has no weights
    assert "search engines" in got  # repeated bigram


def test_term_in_all_documents_dropped(spark):
    texts = ["common apple", "common banana", "common cherry"]
    idx = fit_tfidf(docs_df(spark, texts))
    terms = {r["term"] for r in idx.vocab.collect()}
    assert "common" not in terms  # df 3 > 0.8 * 3
    assert {"apple", "banana", "cherry", "common apple"} <= terms


def test_search_matches_brute_force_and_zero_fill(spark):
    idx = fit_tfidf(docs_df(spark, HAND))
    queries = ["search engines weights", "zzz qqq unknown-words"]
    q = spark.createDataFrame([(i, t) for i, t in enumerate(queries)], "query_id long, query_text string")
    res = search(idx, q, 3).orderBy("query_id", "rank").collect()
    exp = brute_search(HAND, queries, 3)
    for qi in range(2):
        rows = [(r["score"], r["doc_id"]) for r in res if r["query_id"] == qi]
        assert rows == [(s, d) for s, d in exp[qi]]
    # all-unknown query: still k rows, all scores 0, lowest ids first
    assert [(r["doc_id"], r["score"]) for r in res if r["query_id"] == 1] == [(0, 0.0), (1, 0.0), (2, 0.0)]


def test_per_query_k_and_k_above_corpus(spark):
    idx = fit_tfidf(docs_df(spark, HAND))
    q = spark.createDataFrame([(0, "search", 1), (1, "search", 100)], "query_id long, query_text string, k int")
    res = search(idx, q, "k").collect()
    assert sum(1 for r in res if r["query_id"] == 0) == 1
    assert sum(1 for r in res if r["query_id"] == 1) == 3  # min(k, N)


def test_duplicate_documents_tie_by_id(spark):
    texts = ["alpha beta gamma delta epsilon", "zeta eta theta iota kappa", "alpha beta gamma delta epsilon",
             "lambda omicron sigma upsilon"]
    idx = fit_tfidf(docs_df(spark, texts, start=10))
    q = spark.createDataFrame([(0, "alpha gamma")], "query_id long, query_text string")
    res = search(idx, q, 2).orderBy("rank").collect()
    assert [r["doc_id"] for r in res] == [10, 12]
    assert res[0]["score"] == res[1]["score"] > 0


def test_vocabulary_cut_ties_by_term(spark):
    texts = ["gamma beta alpha", "delta", "epsilon"]
    idx = fit_tfidf(docs_df(spark, texts), max_features=2, max_df=1.0)
    # unigrams alpha/beta/gamma/delta/epsilon and the two bigrams all have cf 1
    assert sorted(r["term"] for r in idx.vocab.collect()) == ["alpha", "beta"]


@pytest.mark.parametrize("texts,msg", [
    ([], "No documents"),
    (["   ", ""], "No documents"),
    (["only one document here"], "max_df corresponds"),
    (["the and of", "it is a"], "empty vocabulary"),
])
def test_fit_errors(spark, texts, msg):
    with pytest.raises(ValueError, match=msg):
        fit_tfidf(docs_df(spark, texts) if texts else spark.createDataFrame([], "doc_id long, text string"))


def test_sample_of_real_documents_matches_brute_force(spark):
    from conftest import SF_SMALL
    from textlens.sources.corpus import corpus_from_table

    docs = corpus_from_table(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rows = docs.orderBy("doc_id").collect()
    texts = [r["text"] for r in rows]
    idx = fit_tfidf(docs_df(spark, texts))
    vocab, idf, _ = brute_fit(texts)
    got = {r["term"]: r["idf"] for r in idx.vocab.collect()}
    assert set(got) == set(vocab)


def exchanges(df):
    """Exchange lines of the executed plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_fit_and_search_exchange_no_text_and_no_products(spark):
    from conftest import SF_SMALL
    from textlens.operators.tfidf import query_vectors, term_column, term_statistics

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    found = exchanges(term_statistics(term_column(docs, "text").select("doc_id", "terms")))
    assert len(found) == 1 and "hashpartitioning(term" in found[0]
    idx = fit_tfidf(docs)
    assert not exchanges(idx.weights)
    q = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    assert not exchanges(query_vectors(idx, q))
    once = search(idx, q, 7)
    # the k best of each query and partition are all that is shuffled, plus the few lowest ids
    assert all("hashpartitioning(query_id" in e or "SinglePartition" in e for e in exchanges(once))
    cut = search(idx, q, 7, slice_bytes=3000)
    assert "Union" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert all("hashpartitioning(query_id" in e or "SinglePartition" in e for e in exchanges(cut))
    assert sorted(cut.collect()) == sorted(once.collect())


def test_large_vocabulary_is_joined(spark, monkeypatch):
    """Above VOCABULARY_IN_TASKS the same weights come from a join."""
    from conftest import SF_SMALL
    from textlens.operators import tfidf

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    q = spark.createDataFrame([(1, "the of in and"), (2, None), (3, docs.first()["text"])], "query_id int, query_text string")
    small = fit_tfidf(docs, max_features=None)
    want = {(r["doc_id"], r["term"]): r["w"] for r in small.weights.collect()}
    hits = sorted(search(small, q, 4).collect())
    monkeypatch.setattr(tfidf, "VOCABULARY_IN_TASKS", 10)
    big = fit_tfidf(docs, max_features=None)
    got = {(r["doc_id"], r["term"]): r["w"] for r in big.weights.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(w) for k, w in want.items())
    assert big.vectors.count() == small.vectors.count() == small.n_docs
    assert sorted(search(big, q, 4).collect()) == hits


def test_running_best_hits_by_brute_force(monkeypatch):
    import numpy as np

    from textlens.operators import search as S

    rng = np.random.default_rng(4)
    scores = np.where(rng.random((300, 5)) < 0.4, rng.integers(0, 30, (300, 5)) / 30, 0)
    k = np.array([1, 3, 10, 100, 2])
    for ids in (np.arange(300)[::-1].copy(), np.array([f"d{i}" for i in range(300)], object)):
        monkeypatch.setattr(S, "CELLS", 64)
        best = S.BestHits(k)
        for i in range(0, 300, 7):
            best.add(scores[i:i + 7], ids[i:i + 7])
        best.settle()
        for q in range(5):
            want = sorted((-round(s, 6), d) for s, d in zip(scores[:, q], ids) if s > 0)[:k[q]]
            mine = best.query == q
            assert sorted(zip(-best.score[mine], best.doc[mine])) == want


def test_text_ids_and_repeated_ids(spark):
    docs = spark.createDataFrame([("b", "alpha beta"), ("a", "alpha beta"), ("c", "gamma delta")], "doc_id string, text string")
    idx = fit_tfidf(docs)
    q = spark.createDataFrame([(1, "alpha"), (2, "")], "query_id int, query_text string")
    rows = [(r["query_id"], r["rank"], r["doc_id"]) for r in search(idx, q, 2).orderBy("query_id", "rank").collect()]
    assert rows == [(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 2, "b")]


def test_helper_counts_and_weighs_as_spark_does(spark, monkeypatch):
    """Terms, their counts and a document's weights, to the last bit."""
    import pyarrow as pa

    from textlens.operators import tfidf

    odd = ["Äpfel  äpfel and_pears x y2 a1 I\u0130stanbul", "", None, "  ", "the of and", "a b c", "tab\tnew\nline\x85next\u2028end",
           "\u0967\u0968\u0969 \U0001d400\U0001d401 \U0001d402 ab\u0301cd \x00nul\x00byte", "same same same same", "one two one two one",
           "\u4f60\u597d\u4e16\u754c \u00bd\u00bd mid\u00b7dot don't e-mail", " ".join(f"w{i % 37}" for i in range(900))]
    docs = spark.createDataFrame(list(enumerate(odd * 3)), "doc_id long, text string").repartition(3)
    for bigrams, stops in ((True, tfidf.ENGLISH_STOP_WORDS), (False, ()), (True, ("same",))):
        terms = tfidf.term_column(docs.na.fill(""), "text", stops, bigrams).select("doc_id", "terms")
        want = sorted(tfidf.term_statistics(terms).collect(), key=str)
        vocab = tfidf.choose_vocabulary(tfidf.term_statistics(terms), docs.count(), 60).persist()
        n = vocab.count()
        weights = sorted(tfidf.weigh(terms, vocab, n).collect())
        assert sum(len(r["ids"]) for r in weights) > 20
        assert sorted(tfidf.text_statistics(docs, "text", stops, bigrams).collect(), key=str) == want
        assert sorted(tfidf.weigh_documents(docs, vocab, n, stops, bigrams).collect()) == weights
    batch = pa.record_batch([pa.array(odd)], names=["text"])
    monkeypatch.setattr(tfidf, "BLOCK_BYTES", 20)
    cut = list(tfidf._blocks([batch]))
    assert 5 < len(cut) < len(odd) and pa.Table.from_batches(cut)["text"].to_pylist() == odd

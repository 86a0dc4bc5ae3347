"""Corpus files, status rows, result formats, streams."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL, docs_df
from textlens.operators.search import search
from textlens.operators.status import corpus_ready, health
from textlens.operators.tfidf import fit_tfidf
from textlens.sources.corpus import read_corpus_text, write_corpus_text
from textlens.sources.logs import results_csv
from textlens.streaming.queries import start_query_stream


def test_corpus_file_rules(spark):
    d = tempfile.mkdtemp(prefix="corpus-")
    rec50 = "t" * 50
    rec51 = "u" * 51
    with open(os.path.join(d, "unix.txt"), "w") as f:
        f.write(f"{rec50}\n\n{rec51}\n\n\n  {rec51}  \n\n")
    got = sorted(r["text"] for r in read_corpus_text(spark, os.path.join(d, "unix.txt")).collect())
    assert got == [rec51, rec51]  # record of exactly 50 dropped; three newlines keep a record
    with open(os.path.join(d, "win.txt"), "w", newline="") as f:
        f.write(f"Title\r\n{rec51}\r\n\r\n{rec50}\r\n\r\n")
    got = [r["text"] for r in read_corpus_text(spark, os.path.join(d, "win.txt"), crlf=True).collect()]
    assert got == [f"Title\n{rec51}"]


def test_corpus_sink_round_trip(spark):
    d = tempfile.mkdtemp(prefix="sink-")
    items = spark.createDataFrame([("A  title\n\nsplit", "c" * 60), ("B", "d" * 70)], "title string, content string")
    write_corpus_text(items, f"{d}/out")
    got = sorted(r["text"] for r in read_corpus_text(spark, f"{d}/out").collect())
    assert got == ["A title split\n" + "c" * 60, "B\n" + "d" * 70]


def test_status_rows(spark):
    docs = docs_df(spark, ["x" * 600, "y" * 600])
    r = corpus_ready(docs).first()
    assert (r["corpus_bytes"], r["ready"], r["reason"]) == (1204, True, "ok")
    small = corpus_ready(docs_df(spark, ["tiny"])).first()
    assert (small["ready"], small["reason"]) == (False, "corpus too small")
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    h = health(docs, words).first()
    assert (h["documents_loaded"], h["vocabulary_size"], h["index_ready"]) == (2, 2, True)


def test_score_format_like_python(spark):
    df = spark.createDataFrame([(1, 1, 7, 0.85325), (1, 2, 8, 0.12345)], "query_id long, rank int, doc_id long, score double")
    got = [r["similarity_score"] for r in results_csv(df).orderBy("rank").collect()]
    assert got == [f"{0.85325:.4f}", f"{0.12345:.4f}"] == ["0.8532", "0.1235"]


def test_stream_equals_batch_and_restart_is_idempotent(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    idx = fit_tfidf(docs)
    src = tempfile.mkdtemp(prefix="qsrc-")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    bench.where("query_id < 20").write.mode("append").parquet(src)
    base = tempfile.mkdtemp(prefix="qout-")
    run = lambda: start_query_stream(spark, src, "query_id long, query_text string", idx,
                                     f"{base}/out", f"{base}/ckpt", k=5).awaitTermination()
    run()
    bench.where("query_id >= 20").write.mode("append").parquet(src)
    run()
    run()  # restart with nothing new: no duplicate rows
    streamed = spark.read.parquet(f"{base}/out/results").select("query_id", "rank", "doc_id", "score")
    batch = search(idx, bench, 5)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    logged = spark.read.option("header", True).option("multiLine", True).option("escape", "\"").csv(f"{base}/out/queries")
    assert logged.count() == bench.count()


def test_semantic_model_round_trip(spark):
    from textlens.operators.semantic import fit_word_vectors, mean_vectors, tokenize, word_vectors
    from textlens.sources.model_io import SemanticModel, load_semantic_model, save_semantic_model

    toks = tokenize(docs_df(spark, ["alpha beta gamma alpha", "beta delta epsilon"]), "doc_id")
    model = fit_word_vectors(toks, vector_size=8, max_iter=1)
    dv = mean_vectors(toks, word_vectors(model), 8)
    d = tempfile.mkdtemp(prefix="sem-")
    save_semantic_model(SemanticModel(model, dv), d)
    back = load_semantic_model(spark, d)
    assert back.vector_size == 8
    assert back.doc_vectors.count() == 2
    assert {r["word"] for r in back.model.getVectors().collect()} == {"alpha", "beta", "gamma", "delta", "epsilon"}


def test_not_ready_index(spark):
    from textlens.plans.search_service import search_with_spelling
    from textlens.operators.spelling import fallback_dictionary

    req = spark.createDataFrame([(1, "machine learning"), (2, "")], "query_id long, query_text string")
    res = search_with_spelling(None, fallback_dictionary(spark), req)
    got = {r["query_id"]: (r["status"], r["error"]) for r in res.requests.collect()}
    assert got[1] == ("index_not_ready", "Index not loaded. Please rebuild the index first.")
    assert got[2] == ("invalid", "Query is empty")
    assert res.results.count() == 0


def test_size_check_keeps_shared_cache(spark):
    from textlens.operators.common import broadcast_if_small

    shared = spark.range(100).persist()
    shared.count()
    broadcast_if_small(shared, max_rows=10)  # too big: must not drop the caller's cache
    assert shared.is_cached
    small = spark.range(5)
    broadcast_if_small(small, max_rows=10)
    assert shared.is_cached


def test_size_check_keeps_cache_behind_projection(spark):
    from textlens.operators.common import broadcast_if_small

    base = spark.range(100).select(F.col("id").alias("word"), (F.col("id") * 2).alias("vector")).repartition(2).persist()
    base.count()
    rdds = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    broadcast_if_small(base.select("word", "vector"), max_rows=10)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == rdds


def test_saved_index_answers_as_before(spark):
    from textlens.sources.index_io import load_tfidf, read_documents, save_tfidf, write_documents

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    queries = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    fitted = fit_tfidf(docs, max_features=None, stop_words=("the", "of"), bigrams=False)
    want = sorted(search(fitted, queries, 4).collect())
    d = tempfile.mkdtemp(prefix="index-")
    save_tfidf(fitted, d)
    back = load_tfidf(spark, d)
    assert (back.stop_words, back.bigrams, back.max_features, back.n_docs) == (("the", "of"), False, None, fitted.n_docs)
    found = search(back, queries, 4)
    assert sorted(found.collect()) == want
    # (query, document) products reach their partial top k without an exchange
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [term" not in plan
    write_documents(docs, f"{d}/map")
    assert read_documents(spark, f"{d}/map").exceptAll(docs).count() == 0


def test_text_ids_through_the_index_files(spark):
    import json

    from textlens.sources.index_io import read_legacy_index, read_postings_json, write_postings_json

    d = tempfile.mkdtemp(prefix="legacy-")
    with open(f"{d}/index.json", "w") as f:
        json.dump({"index": {"deep": [["id-1", [0, 4]], ["id-2", [3]]], "data": [["id-2", [1]]]}}, f)
    flat = read_legacy_index(spark, f"{d}/index.json")
    write_postings_json(flat, f"{d}/out")
    back = read_postings_json(spark, f"{d}/out", "string")
    assert sorted(back.collect()) == sorted(flat.collect())


def test_corpus_ids_do_not_depend_on_the_file(spark):
    d = tempfile.mkdtemp(prefix="ids-")
    a, b = "a" * 60, "b" * 60
    with open(f"{d}/one.txt", "w") as f:
        f.write(f"{a}\n\n{b}\n\n{a}")
    with open(f"{d}/two.txt", "w") as f:
        f.write(f"{b}\n\n{a}\n\n{a}")
    one, two = (sorted(read_corpus_text(spark, f"{d}/{n}.txt").collect()) for n in ("one", "two"))
    assert one == two and len({r["doc_id"] for r in one}) == 3


def test_request_stream_logs_accepted_requests_and_leaves_no_cache(spark):
    from textlens.operators.spelling import fallback_dictionary

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    idx = fit_tfidf(docs)
    d = tempfile.mkdtemp(prefix="requests-")
    rows = [(1, "machne lerning", "3", True), (2, "x", "3", True), (3, "data", "9" * 45, True), (4, "deep", "x", True),
            (5, "the of machine", "2", False), (6, None, None, None)]
    schema = "query_id long, query_text string, top_k string, auto_correct boolean"
    for i in range(3):
        spark.createDataFrame(rows[2 * i:2 * i + 2], schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    words = fallback_dictionary(spark)
    for checkpoint in ("c1", "c2"):  # a second run beside the first, not over it
        start_query_stream(spark, f"{d}/in", schema, idx, f"{d}/out", f"{d}/{checkpoint}", dictionary=words,
                           max_files=1).awaitTermination()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == cached
    logged = spark.read.option("header", True).csv(f"{d}/out/queries")
    assert sorted(r["query_text"] for r in logged.collect()) == ["machne lerning", "machne lerning"] + ["the of machine"] * 2
    hits = spark.read.option("header", True).csv(f"{d}/out/result_log")
    assert hits.columns[:3] == ["query_id", "rank", "document_id"] and hits.count() == 2 * (3 + 2)


def test_k_out_of_range_is_never_cut(spark):
    import pytest

    idx = fit_tfidf(docs_df(spark, ["alpha beta gamma", "beta delta", "gamma epsilon alpha"]))
    q = spark.createDataFrame([(1, "alpha", 101)], "query_id long, query_text string, k int")
    with pytest.raises(Exception, match="between 1 and 100"):
        search(idx, q, k="k").collect()


def test_top_k_of_any_type(spark):
    from textlens.operators.validate import validate_queries

    floats = spark.createDataFrame([("ab", x) for x in (5.0, 5.7, 0.5, 101.0, float("nan"), None)],
                                   "query_text string, top_k double")
    got = [(r["top_k"], r["error"]) for r in validate_queries(floats).collect()]
    bad = "top_k must be between 1 and 100"
    assert got == [(5, None), (5, None), (None, bad), (None, bad), (None, "top_k must be an integer"), (5, None)]
    texts = spark.createDataFrame([("ab", x) for x in ("9" * 45, "-" + "9" * 45, "5.0", " 7 ")],
                                  "query_text string, top_k string")
    got = [(r["top_k"], r["error"]) for r in validate_queries(texts).collect()]
    assert got == [(None, bad), (None, bad), (None, "top_k must be an integer"), (7, None)]

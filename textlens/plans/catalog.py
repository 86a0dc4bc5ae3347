"""Named queries: each takes (spark, sf_dir) and returns a DataFrame whose
columns match the DuckDB SQL of the same name in ``textlens.plans.oracle``.
Every query reads the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.operators.postings import (approximate_terms, build_postings, document_postings, index_stats,
                                         nest_postings, postings_text, term_sketches)
from textlens.operators.common import write_table
from textlens.operators.search import search, with_preview
from textlens.operators.status import corpus_ready, health
from textlens.sources.logs import read_query_log, read_result_log, results_csv, results_json, write_logs
from textlens.session import checkpoint_dir
from textlens.streaming.pages import start_page_stream
from textlens.streaming.queries import start_query_stream
from textlens.operators.semantic import (approximate_knn, centroids, fit_word_vectors, knn, mean_vectors, semantic_search,
                                         similar_words, tokenize, word_similarity, word_vectors)
from textlens.operators.pages import (crawl_items, crawl_stats, extract_documents, extract_links, resolve,
                                      traverse, url_host, walk)
from textlens.operators.spelling import (check_queries, correct_queries, dictionary_keys, extend_dictionary,
                                         fallback_dictionary, load_dictionary, suggest)
from textlens.functions.text import query_word, split_ws
from textlens.operators.validate import validate_queries
from textlens.plans.search_service import search_with_spelling
from textlens.operators.tfidf import TfidfIndex, fit_tfidf
from textlens.sources.corpus import corpus_from_table, read_corpus_text, write_corpus_text
from textlens.operators.word_factors import factorise_words
from textlens.sources.index_io import (load_tfidf, read_bucketed, read_legacy_index, save_tfidf, term_lookup,
                                       write_bucketed)
from textlens.sources.index_json import write_index_objects
from textlens.streaming.index import index_of_segments, start_index_stream


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_source(sf_dir: str, name: str) -> str:
    """Path of a table for a file stream: a pattern that only the table
    matches, whether it is one file or a folder of parts.  (A stream reads no
    plain file, and a filter on file names does not see folders.)"""
    return f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"


_INDEX_CACHE: dict[tuple, TfidfIndex] = {}


def tfidf_index(spark: SparkSession, sf_dir: str) -> TfidfIndex:
    """Fitted index of the documents table (one fit per session and folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEX_CACHE:
        _INDEX_CACHE[key] = fit_tfidf(corpus_from_table(table(spark, sf_dir, "documents")))
    return _INDEX_CACHE[key]


def bench_queries(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def user_queries(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "conversations").where(F.col("role") == "user")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("query_text"))
    )


def q_corpus_filter(spark, sf_dir):
    c = corpus_from_table(table(spark, sf_dir, "documents"))
    return c.select("doc_id", "text", F.length("text").cast("bigint").alias("n_chars"))


def q_vocab_df_cf(spark, sf_dir):
    v = tfidf_index(spark, sf_dir).vocab
    return v.select("term", "df", "cf", F.round("idf", 9).alias("idf"))


def q_doc_weights(spark, sf_dir):
    w = tfidf_index(spark, sf_dir).weights
    return w.select("doc_id", "term", F.round("w", 9).alias("w"))


def q_tfidf_search_topk(spark, sf_dir):
    return search(tfidf_index(spark, sf_dir), bench_queries(spark, sf_dir), 5)


def q_search_zero_fill(spark, sf_dir):
    return search(tfidf_index(spark, sf_dir), user_queries(spark, sf_dir), 10)


_POSTINGS_CACHE: dict[tuple, DataFrame] = {}


def postings_table(spark, sf_dir, stored: bool = False) -> DataFrame:
    """Postings of the documents table.  They are several times the texts, so
    they are made where they are read; a query that reads them more than once
    has them ``stored``, once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _POSTINGS_CACHE:
        made = build_postings(tfidf_index(spark, sf_dir).docs)
        if not stored:
            return made
        _POSTINGS_CACHE[key] = write_table(made, "postings")
    return _POSTINGS_CACHE[key]


def q_postings(spark, sf_dir):
    p = postings_table(spark, sf_dir)
    return p.select("term", "doc_id", F.array_join("positions", ",").alias("positions"))


def q_postings_nested(spark, sf_dir):
    return postings_text(nest_postings(postings_table(spark, sf_dir)))


def q_index_stats(spark, sf_dir):
    idx = tfidf_index(spark, sf_dir)
    return index_stats(postings_table(spark, sf_dir), idx.vectors, idx.vocab)


_DICT_CACHE: dict[tuple, DataFrame] = {}


def spell_dictionary(spark, sf_dir) -> DataFrame:
    """Fallback word list plus the corpus vocabulary (bigrams included);
    built once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DICT_CACHE:
        d = extend_dictionary(fallback_dictionary(spark), tfidf_index(spark, sf_dir).vocab)
        _DICT_CACHE[key] = d.persist()
    return _DICT_CACHE[key]


_KEYS_CACHE: dict[tuple, DataFrame] = {}


def spell_keys(spark, sf_dir) -> DataFrame:
    """Segment keys of the dictionary, built once and reused
    by every spelling query (persisted)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _KEYS_CACHE:
        _KEYS_CACHE[key] = dictionary_keys(spell_dictionary(spark, sf_dir)).persist()
    return _KEYS_CACHE[key]


def misspelled_queries(spark, sf_dir) -> DataFrame:
    """Benchmark passages with the second letter of every 6+ letter word
    dropped (typing errors on real query text)."""
    b = table(spark, sf_dir, "benchmark")
    text = F.regexp_replace("text", r"(^|\s)(\p{L})\p{L}(\p{L}{4,})", "$1$2$3")
    return b.select(F.col("item_id").alias("query_id"), text.alias("query_text"))


def q_validate_queries(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    req = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
                   F.col("text").alias("query_text"), F.col("turn").cast("string").alias("top_k"))
    return validate_queries(req).select("query_id", "valid", "error", "top_k")


def _query_words(queries: DataFrame) -> DataFrame:
    toks = queries.select(F.explode(split_ws(F.lower("query_text"))).alias("token"))
    return toks.select(query_word(F.col("token")).alias("word")).where(F.col("word") != "")


def q_spell_unknown(spark, sf_dir):
    words = _query_words(user_queries(spark, sf_dir)).distinct()
    return words.join(spell_dictionary(spark, sf_dir), "word", "left_anti")


def q_spell_suggest(spark, sf_dir):
    return suggest(_query_words(misspelled_queries(spark, sf_dir)), spell_dictionary(spark, sf_dir),
                   dict_keys=spell_keys(spark, sf_dir))


def q_check_queries(spark, sf_dir):
    r = check_queries(misspelled_queries(spark, sf_dir), spell_dictionary(spark, sf_dir),
                      dict_keys=spell_keys(spark, sf_dir))
    sugg = F.array_join(F.transform(F.array_sort(F.map_entries("suggestions")),
                                    lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "|"))), ";")
    return r.select("query_id", "original", "corrected", "has_errors",
                    F.array_join("misspelled_words", ",").alias("misspelled_words"), sugg.alias("suggestions"))


def q_search_with_spelling(spark, sf_dir):
    req = misspelled_queries(spark, sf_dir).withColumn("top_k", F.lit(5)).withColumn("auto_correct", F.lit(True))
    res = search_with_spelling(tfidf_index(spark, sf_dir), spell_dictionary(spark, sf_dir), req, preview=False,
                               dict_keys=spell_keys(spark, sf_dir))
    return res.results


_WALK_CACHE: dict[tuple, DataFrame] = {}


def walked_pages(spark, sf_dir) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WALK_CACHE:
        _WALK_CACHE[key] = walk(table(spark, sf_dir, "pages")).persist()
    return _WALK_CACHE[key]


def q_page_titles(spark, sf_dir):
    return extract_documents(walked_pages(spark, sf_dir)).select("page_id", "title")


def q_page_documents(spark, sf_dir):
    return extract_documents(walked_pages(spark, sf_dir)).select("page_id", "content", "n_chars", "ok")


def q_page_links(spark, sf_dir):
    return extract_links(walked_pages(spark, sf_dir)).select("page_id", "link")


def q_link_domains(spark, sf_dir):
    links = extract_links(walked_pages(spark, sf_dir))
    return links.groupBy(url_host(F.col("link")).alias("host")).agg(
        F.count(F.lit(1)).alias("n_links"), F.count_distinct("page_id").alias("n_pages"))


def traversal_fixture(spark, sf_dir):
    """Seeds and edges derived from the pages table: each host's first page
    is a seed; edges are the pages' own links plus host root <-> page,
    page -> 2*page / 2*page+1 and page -> itself."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ph = pages.withColumn("host", url_host(F.col("url")))
    roots = ph.groupBy("host").agg(F.min("page_id").alias("root"))
    ids = ph.join(roots, "host")
    root_url = pages.select(F.col("page_id").alias("root"), F.col("url").alias("root_url"))
    child = lambda off: ids.join(
        pages.select((F.col("page_id") - off).alias("half"), F.col("url").alias("dst")),
        F.col("half") == 2 * F.col("page_id")).select(F.col("url").alias("src"), "dst")
    links = extract_links(walked_pages(spark, sf_dir)).join(pages, "page_id").select(
        F.col("url").alias("src"), F.col("link").alias("dst"))
    star = ids.join(root_url, "root")
    edges = (
        links.unionByName(star.select(F.col("url").alias("src"), F.col("root_url").alias("dst")))
        .unionByName(star.select(F.col("root_url").alias("src"), F.col("url").alias("dst")))
        .unionByName(child(0)).unionByName(child(1))
        .unionByName(pages.select(F.col("url").alias("src"), F.col("url").alias("dst")))
    )
    seeds = roots.join(pages, F.col("root") == F.col("page_id")).select(
        F.col("page_id").alias("crawl_id"), F.col("url").alias("seed_url"))
    return seeds, edges, pages


def q_traverse(spark, sf_dir):
    seeds, edges, pages = traversal_fixture(spark, sf_dir)
    return traverse(seeds, edges, pages)


def q_crawl_stats(spark, sf_dir):
    seeds, edges, pages = traversal_fixture(spark, sf_dir)
    visits = traverse(seeds, edges, pages)
    stats = crawl_stats(visits, extract_documents(walked_pages(spark, sf_dir)), seeds=seeds)
    return stats.select("crawl_id", "total_pages", "successful_pages", "failed_pages", "success_rate",
                        "close_reason")


def embedding_vectors(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").alias("vec"), "label")


def q_knn_l2(spark, sf_dir):
    """Top-10 nearest vectors (squared L2) to each label's centroid."""
    vec = embedding_vectors(spark, sf_dir)
    q = centroids(vec.select("label", "vec"), "label").select(F.col("label").cast("long").alias("query_id"), "vec")
    return knn(q, vec.select("vec_id", "vec"), 10, key="vec_id")


def q_approximate_knn(spark, sf_dir):
    """The same neighbours by random projections (recall is tested against
    ``knn_l2``)."""
    vec = embedding_vectors(spark, sf_dir)
    q = centroids(vec.select("label", "vec"), "label").select(F.col("label").cast("long").alias("query_id"), "vec")
    return approximate_knn(q, vec.select("vec_id", "vec"), 2.0, 10, key="vec_id")


def rule_vectors(words: DataFrame) -> DataFrame:
    """Deterministic 3-d word vectors from the word's length and first and
    last code points: a checkable stand-in for trained vectors."""
    w = F.col("word")
    return words.select("word", F.array(
        F.sqrt(F.length(w).cast("double")), F.log(F.ascii(w).cast("double")),
        F.sqrt(F.ascii(F.substring(w, F.length(w), 1)).cast("double"))).alias("vector"))


def q_word_mean_vectors(spark, sf_dir):
    words = tokenize(table(spark, sf_dir, "benchmark"), "item_id").select(
        F.explode("tokens").alias("word")).distinct()
    mv = mean_vectors(doc_tokens(spark, sf_dir), rule_vectors(words), 3, "doc_id")
    return mv.select("doc_id", *[F.round(F.col("vector")[i], 6).alias(f"v{i}") for i in range(3)])


_W2V_CACHE: dict[tuple, object] = {}
_TOKENS_CACHE: dict[tuple, DataFrame] = {}
_DV_CACHE: dict[tuple, DataFrame] = {}


def doc_tokens(spark, sf_dir, stored: bool = False) -> DataFrame:
    """(doc_id, tokens) of the documents table, semantic tokeniser.  Made
    where they are read; a query that reads them more than once has them
    ``stored`` (persisted), once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TOKENS_CACHE:
        made = tokenize(table(spark, sf_dir, "documents"), "doc_id")
        if not stored:
            return made
        _TOKENS_CACHE[key] = made.persist()
    return _TOKENS_CACHE[key]


def w2v_model(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _W2V_CACHE:
        _W2V_CACHE[key] = fit_word_vectors(doc_tokens(spark, sf_dir, stored=True),
                                           num_partitions=spark.sparkContext.defaultParallelism)
    return _W2V_CACHE[key]


_WV_CACHE: dict[tuple, DataFrame] = {}


def trained_vectors(spark, sf_dir) -> DataFrame:
    """(word, vector) of the trained model as a distributed, persisted table
    (the model's vector list is a driver-side local relation; converting it
    once avoids shipping it with every task that reads it)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WV_CACHE:
        v = word_vectors(w2v_model(spark, sf_dir))
        _WV_CACHE[key] = v.repartition(spark.sparkContext.defaultParallelism).persist()
    return _WV_CACHE[key]


def doc_vectors(spark, sf_dir) -> DataFrame:
    """(doc_id, vector): mean trained word vectors of each document."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DV_CACHE:
        model = w2v_model(spark, sf_dir)
        _DV_CACHE[key] = mean_vectors(doc_tokens(spark, sf_dir), trained_vectors(spark, sf_dir),
                                      model.getVectorSize(), "doc_id").persist()
    return _DV_CACHE[key]


def q_semantic_search(spark, sf_dir):
    model = w2v_model(spark, sf_dir)
    return semantic_search(model, doc_vectors(spark, sf_dir), bench_queries(spark, sf_dir), 5,
                           vectors=trained_vectors(spark, sf_dir))


def _bench_tokens(spark, sf_dir):
    return tokenize(table(spark, sf_dir, "benchmark"), "item_id")


def q_similar_words(spark, sf_dir):
    words = _bench_tokens(spark, sf_dir).select(F.explode("tokens").alias("word")).distinct()
    return similar_words(words, trained_vectors(spark, sf_dir), 5)


def q_word_similarity(spark, sf_dir):
    return word_similarity(_bench_pairs(spark, sf_dir), trained_vectors(spark, sf_dir))


def q_results_csv(spark, sf_dir):
    return results_csv(q_tfidf_search_topk(spark, sf_dir))


def q_results_json(spark, sf_dir):
    req = misspelled_queries(spark, sf_dir).withColumn("top_k", F.lit(5)).withColumn("auto_correct", F.lit(True))
    res = search_with_spelling(tfidf_index(spark, sf_dir), spell_dictionary(spark, sf_dir), req,
                               dict_keys=spell_keys(spark, sf_dir))
    return results_json(res.requests, res.results)


def q_health(spark, sf_dir):
    return health(tfidf_index(spark, sf_dir).vectors, spell_dictionary(spark, sf_dir))


def q_corpus_ready(spark, sf_dir):
    return corpus_ready(table(spark, sf_dir, "documents"))


def _stream_dir(spark, name: str) -> str:
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def q_stream_queries(spark, sf_dir):
    """Benchmark passages streamed as query files, answered per
    micro-batch; equals the batch top-5 search."""
    base = _stream_dir(spark, "queries")
    q = start_query_stream(spark, table_source(sf_dir, "benchmark"), "item_id long, text string",
                           tfidf_index(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", k=5,
                           rename={"item_id": "query_id", "text": "query_text"})
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out/results").select("query_id", "rank", "doc_id", "score")


def q_stream_pages(spark, sf_dir):
    """Pages streamed as files and extracted per micro-batch; equals the
    batch page extraction."""
    base = _stream_dir(spark, "pages")
    q = start_page_stream(spark, table_source(sf_dir, "pages"), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("page_id", "content", "n_chars", "ok")


# References of RFC 3986 section 5.4 that name a path, resolved
# against <base>/b/c/d;p?q, and paths that climb more levels than there are.
REFERENCES = ("g", "./g", "g/", "/g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s", "", ".", "./", "..",
              "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g",
              "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y", "g?y/./x", "g?y/../x",
              "g#s/./x", "g#s/../x", "a/b/c/d/../../../../../../e")


def q_link_resolution(spark, sf_dir):
    """Every page's host with a path of RFC 3986 as the base, against every
    reference of its section 5.4."""
    base = F.concat(F.lit("http://"), url_host(F.col("url")), F.lit("/b/c/d;p?q"))
    r = table(spark, sf_dir, "pages").select(
        "page_id", base.alias("base"), F.explode(F.array(*(F.lit(x) for x in REFERENCES))).alias("href"))
    return r.select("page_id", "href", resolve(F.col("base"), F.col("href")).alias("link"))


SAVED_STOP_WORDS = ("the", "of", "and", "de", "der")


def q_saved_index_search(spark, sf_dir):
    """An index fitted with settings of its own, saved, loaded and searched."""
    path = _stream_dir(spark, "saved-index")
    fitted = fit_tfidf(corpus_from_table(table(spark, sf_dir, "documents")), max_features=2000,
                       stop_words=SAVED_STOP_WORDS, bigrams=False)
    save_tfidf(fitted, path)
    return search(load_tfidf(spark, path), bench_queries(spark, sf_dir), 5)


def q_corpus_file(spark, sf_dir):
    """Page items written as a corpus file and read back; ids leave out where
    a record lies, so the texts with their number of copies are compared."""
    path = _stream_dir(spark, "corpus-file")
    write_corpus_text(crawl_items(extract_documents(walked_pages(spark, sf_dir))), path, "overwrite")
    back = read_corpus_text(spark, path)
    return back.groupBy("text").agg(F.count_distinct("doc_id").alias("n"))


def request_table(spark, sf_dir) -> DataFrame:
    """Requests of all kinds: whole conversation turns as queries (every 17th
    too short, every 23rd said forty times over; turns above the longest query
    are rejected as too long), k from
    the turn number, some out of range or no number, correction on and off."""
    c = table(spark, sf_dir, "conversations")
    n = F.col("conv_id") * 1000 + F.col("turn")
    k = (F.when(n % 11 == 0, F.lit("x")).when(n % 13 == 0, F.repeat(F.lit("9"), F.lit(45)))
         .otherwise((n % 7).cast("string")))
    text = F.when(n % 23 == 0, F.repeat(F.concat("text", F.lit(" ")), 40)).otherwise(F.col("text"))
    text = F.regexp_replace(text, r"(^|\s)(\p{L})\p{L}(\p{L}{4,})", "$1$2$3")
    return c.where("role = 'user'").select(
        n.alias("query_id"), F.when(n % 17 == 0, F.substring(text, 1, 1)).otherwise(text).alias("query_text"),
        k.alias("top_k"), (n % 2 == 0).alias("auto_correct"))


def q_search_requests(spark, sf_dir):
    """Hits of the whole request path."""
    return search_with_spelling(tfidf_index(spark, sf_dir), spell_dictionary(spark, sf_dir),
                                request_table(spark, sf_dir), preview=False,
                                dict_keys=spell_keys(spark, sf_dir)).results


def q_request_answers(spark, sf_dir):
    """One row per request: what was answered, error and correction."""
    r = search_with_spelling(tfidf_index(spark, sf_dir), spell_dictionary(spark, sf_dir),
                             request_table(spark, sf_dir), preview=False,
                             dict_keys=spell_keys(spark, sf_dir)).requests
    return r.select("query_id", "status", "error", "top_k", "search_query",
                    F.col("spell_check.corrected_query").alias("corrected"))


# Type of a JSON answer as far as it is read back.
ANSWER = ("query_id long, results_count int, status string, error string, spell_check struct<corrected_query:string>, "
          "results array<struct<rank:int,document_id:long,similarity_score:double,content_preview:string>>")


def q_json_answers(spark, sf_dir):
    """JSON answers to requests of all kinds, written as lines and read back:
    a row per hit, or one with nulls for an answer without hits."""
    path = _stream_dir(spark, "answers")
    res = search_with_spelling(tfidf_index(spark, sf_dir), spell_dictionary(spark, sf_dir),
                               request_table(spark, sf_dir), dict_keys=spell_keys(spark, sf_dir))
    results_json(res.requests, res.results).select("json").write.text(path)
    back = spark.read.schema(ANSWER).json(path)
    return back.select("query_id", "status", "error", F.col("spell_check.corrected_query").alias("corrected"),
                       "results_count", F.explode_outer("results").alias("r")).select(
        "query_id", "status", "error", "corrected", "results_count", "r.rank", "r.document_id", "r.similarity_score",
        "r.content_preview")


def q_stream_search_requests(spark, sf_dir):
    """The same requests as a stream of files through validation, spell check
    and search."""
    base = _run_request_stream(spark, sf_dir)
    return spark.read.parquet(f"{base}/out/results").select("query_id", "rank", "doc_id", "score")


def _run_request_stream(spark, sf_dir) -> str:
    base = _stream_dir(spark, "requests")
    req = request_table(spark, sf_dir)
    req.write.parquet(f"{base}/in")
    q = start_query_stream(spark, f"{base}/in", "query_id long, query_text string, top_k string, auto_correct boolean",
                           tfidf_index(spark, sf_dir), f"{base}/out", f"{base}/checkpoint",
                           dictionary=spell_dictionary(spark, sf_dir), dict_keys=spell_keys(spark, sf_dir))
    q.awaitTermination()
    return base


def q_stream_request_log(spark, sf_dir):
    """The stream's CSV logs read back: accepted requests with their original
    text, and their hits."""
    base = _run_request_stream(spark, sf_dir)
    hits = read_result_log(spark, f"{base}/out/result_log")
    return read_query_log(spark, f"{base}/out/queries").join(hits, "query_id")


def q_corrected_text(spark, sf_dir):
    """Corrected queries against a dictionary read from a word file."""
    path = _stream_dir(spark, "dictionary")
    spell_dictionary(spark, sf_dir).write.text(path)
    return correct_queries(misspelled_queries(spark, sf_dir), load_dictionary(spark, path))


def q_result_log(spark, sf_dir):
    """Query and result logs written as CSV with a header and read back."""
    path = _stream_dir(spark, "logs")
    requests = bench_queries(spark, sf_dir)
    write_logs(requests, search(tfidf_index(spark, sf_dir), requests, 5), path)
    return read_result_log(spark, f"{path}/results").join(read_query_log(spark, f"{path}/queries"), "query_id")


def q_postings_ascii(spark, sf_dir):
    """Postings of the text without its non-ASCII characters."""
    p = build_postings(tfidf_index(spark, sf_dir).docs, ascii_fallback=True)
    return p.select("term", "doc_id", F.array_join("positions", ",").alias("positions"))


def q_postings_lookup(spark, sf_dir):
    """Documents and positions of the words of the benchmark passages, from
    postings stored in buckets by term."""
    path = _stream_dir(spark, "bucketed")
    write_bucketed(postings_table(spark, sf_dir), path, "term", 16, ["doc_id"])
    words = F.explode(document_postings(F.col("text"))).alias("p")
    asked = table(spark, sf_dir, "benchmark").select(words).select("p.term")
    return term_lookup(asked, read_bucketed(spark, path))


def q_index_objects(spark, sf_dir):
    """Postings written as one-object JSON files and read back by byte
    ranges."""
    path = _stream_dir(spark, "index-objects")
    write_index_objects(postings_table(spark, sf_dir, stored=True), path, 4)
    back = read_legacy_index(spark, path, split_bytes=1 << 18)
    return back.select("term", F.col("doc_id").cast("long").alias("doc_id"),
                       F.array_join("positions", ",").alias("positions"))


def q_term_totals(spark, sf_dir):
    """Different terms of the postings: exact, and whether the estimate from
    merged sketches of 16 parts of the documents has them between its bounds."""
    p = postings_table(spark, sf_dir, stored=True)
    sketches = term_sketches(p, F.pmod(F.col("doc_id"), F.lit(16)))
    exact = p.agg(F.count_distinct("term").alias("total_terms"))
    return exact.join(F.broadcast(approximate_terms(sketches))).select(
        "total_terms", F.col("total_terms").between(F.col("low"), F.col("high")).alias("within_bounds"))


def q_stream_index(spark, sf_dir):
    """Vocabulary of an index fed by a stream of the documents in several
    batches."""
    base = _stream_dir(spark, "index")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.repartition(3, "doc_id").write.parquet(f"{base}/in")
    start_index_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", "doc_id long, text string",
                       max_files=1).awaitTermination()
    v = index_of_segments(spark, f"{base}/out").vocab
    return v.select("term", "df", "cf", F.round("idf", 9).alias("idf"))


def q_similar_words_factors(spark, sf_dir):
    """Most similar words by vectors of the factorised co-occurrences."""
    words = _bench_tokens(spark, sf_dir).select(F.explode("tokens").alias("word")).distinct()
    return similar_words(words, factorise_words(doc_tokens(spark, sf_dir), 24, window=3, max_iter=3), 5)


def rule_word_table(spark, sf_dir) -> DataFrame:
    return rule_vectors(_bench_tokens(spark, sf_dir).select(F.explode("tokens").alias("word")).distinct())


def _bench_pairs(spark, sf_dir) -> DataFrame:
    t = _bench_tokens(spark, sf_dir)
    return t.select(F.explode(F.arrays_zip(F.col("tokens"), F.slice("tokens", 2, 1 << 30))).alias("p")).select(
        F.col("p")["tokens"].alias("word1"), F.col("p")["1"].alias("word2")).where(
        F.col("word2").isNotNull()).distinct()


def q_word_similarity_rule(spark, sf_dir):
    """Cosine similarity of neighbouring words over the rule-based vectors."""
    r = word_similarity(_bench_pairs(spark, sf_dir), rule_word_table(spark, sf_dir))
    return r.select("word1", "word2", F.round("similarity", 6).alias("similarity"))


def q_similar_words_rule(spark, sf_dir):
    """Most similar words by cosine over the rule-based vectors; which of
    several equally similar ones comes first is decided by the word."""
    v = rule_word_table(spark, sf_dir)
    return similar_words(v.select("word"), v, 3).select("word", "rank", "similarity")


def q_result_previews(spark, sf_dir):
    """Hits of the benchmark passages with their previews."""
    idx = tfidf_index(spark, sf_dir)
    return with_preview(search(idx, bench_queries(spark, sf_dir), 5), idx.docs)


def q_semantic_search_rule(spark, sf_dir):
    """Query vectors against document vectors, both means of the rule-based
    word vectors."""
    v = rule_word_table(spark, sf_dir)
    docs = mean_vectors(doc_tokens(spark, sf_dir), v, 3, "doc_id").select("doc_id", F.col("vector").alias("vec"))
    qs = mean_vectors(_bench_tokens(spark, sf_dir), v, 3, "item_id").select(
        F.col("item_id").alias("query_id"), F.col("vector").alias("vec"))
    r = knn(qs, docs, 5)
    return r.select("query_id", "rank", "distance")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "corpus_filter": q_corpus_filter,
    "vocab_df_cf": q_vocab_df_cf,
    "doc_weights": q_doc_weights,
    "tfidf_search_topk": q_tfidf_search_topk,
    "search_zero_fill": q_search_zero_fill,
    "postings": q_postings,
    "postings_nested": q_postings_nested,
    "index_stats": q_index_stats,
    "validate_queries": q_validate_queries,
    "spell_unknown": q_spell_unknown,
    "spell_suggest": q_spell_suggest,
    "check_queries": q_check_queries,
    "search_with_spelling": q_search_with_spelling,
    "page_titles": q_page_titles,
    "page_documents": q_page_documents,
    "page_links": q_page_links,
    "link_domains": q_link_domains,
    "traverse": q_traverse,
    "crawl_stats": q_crawl_stats,
    "knn_l2": q_knn_l2,
    "approximate_knn": q_approximate_knn,
    "word_mean_vectors": q_word_mean_vectors,
    "semantic_search": q_semantic_search,
    "similar_words": q_similar_words,
    "word_similarity": q_word_similarity,
    "results_csv": q_results_csv,
    "results_json": q_results_json,
    "health": q_health,
    "corpus_ready": q_corpus_ready,
    "stream_queries": q_stream_queries,
    "stream_pages": q_stream_pages,
    "link_resolution": q_link_resolution,
    "saved_index_search": q_saved_index_search,
    "corpus_file": q_corpus_file,
    "search_requests": q_search_requests,
    "request_answers": q_request_answers,
    "json_answers": q_json_answers,
    "stream_search_requests": q_stream_search_requests,
    "stream_request_log": q_stream_request_log,
    "corrected_text": q_corrected_text,
    "result_log": q_result_log,
    "postings_ascii": q_postings_ascii,
    "result_previews": q_result_previews,
    "similar_words_rule": q_similar_words_rule,
    "word_similarity_rule": q_word_similarity_rule,
    "semantic_search_rule": q_semantic_search_rule,
    "postings_lookup": q_postings_lookup,
    "index_objects": q_index_objects,
    "term_totals": q_term_totals,
    "stream_index": q_stream_index,
    "similar_words_factors": q_similar_words_factors,
}

"""TF-IDF fit: vocabulary, document frequencies and L2-normalised weights.

Semantics (smoothed idf, raw term counts, L2 norm):

* terms     = word runs of >= 2 chars, lower-cased, English stop words
              removed, then unigrams + bigrams of the remaining words
* df, cf    = documents containing the term, total occurrences
* vocabulary= terms with min_df <= df <= max_df*N, then the max_features
              terms of highest cf (ties: term ascending, binary order)
* idf       = ln((1 + N) / (1 + df)) + 1
* weight    = tf * idf / ||tf * idf||_2 over the document's vocabulary terms

Plan shape: a document's terms are counted, weighted and normalised inside its
row.  What shuffles is (term, partial df, partial cf); the corpus' text never
does, and no copy of it is kept.  The result is one row per document with
ascending term numbers and their weights, written once.  Spark lower-cases the
documents and blanks what is no word character; an Arrow helper cuts them into
terms and counts these.  Queries take Spark's own way, with equal terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from numbers import Integral

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.functions.arrays import counted, let
from textlens.functions.text import blank_non_terms, strip, tfidf_tokens
from textlens.functions.words import ENGLISH_STOP_WORDS
from textlens.operators.common import bounded_broadcast, broadcast_if_small, write_table
from textlens.session import ship_package

#: Vocabularies up to this many terms are sent to the tasks, which then weigh
#: a document without a join; larger ones are joined by term.
VOCABULARY_IN_TASKS = 50_000
#: Bytes and number of texts that a task cuts into terms at a time, one text at
#: least, and the rows that it passes on at a time.
BLOCK_BYTES, BLOCK_TEXTS, ROWS = 16 << 20, 1 << 14, 1 << 16


@dataclass
class TfidfIndex:
    """A fitted index.  ``docs`` (doc_id, text) is the corpus as given, not a
    copy; ``vocab`` is (term_id, term, df, cf, idf); ``vectors`` is (doc_id,
    ids ascending, w), one row per document, also for documents without a
    term of the vocabulary."""

    docs: DataFrame
    vocab: DataFrame
    vectors: DataFrame
    n_docs: int
    stop_words: tuple = ENGLISH_STOP_WORDS
    bigrams: bool = True
    max_features: int | None = 5000
    n_terms: int = 0

    @property
    def weights(self) -> DataFrame:
        """(doc_id, term, w), one row per document and term."""
        long_ = self.vectors.select("doc_id", F.explode(F.arrays_zip("ids", "w")).alias("e"))
        names = self.vocab.select("term_id", "term")
        names = bounded_broadcast(names) if self.max_features is not None else broadcast_if_small(names)
        return long_.select("doc_id", F.col("e.ids").alias("term_id"), F.col("e.w").alias("w")).join(
            names, "term_id").select("doc_id", "term", "w")


def term_column(df: DataFrame, text_col: str, stop_words=ENGLISH_STOP_WORDS,
                bigrams: bool = True, out: str = "terms") -> DataFrame:
    """Add an array column of unigram (+ bigram) terms.  Bigrams bridge the
    removed stop words because they are formed after removal."""
    toks = "__toks"
    kept = "__kept"
    df = df.withColumn(toks, tfidf_tokens(text_col))
    df = StopWordsRemover(inputCol=toks, outputCol=kept, stopWords=list(stop_words),
                          caseSensitive=True).transform(df)
    if bigrams:
        bi = "__bi"
        df = NGram(n=2, inputCol=kept, outputCol=bi).transform(df)
        df = df.withColumn(out, F.concat(F.col(kept), F.col(bi))).drop(bi)
    else:
        df = df.withColumn(out, F.col(kept))
    return df.drop(toks, kept)


def _limits(n_docs: int, min_df, max_df) -> tuple[float, float]:
    hi = max_df if isinstance(max_df, Integral) else max_df * n_docs
    lo = min_df if isinstance(min_df, Integral) else min_df * n_docs
    if hi < lo:
        raise ValueError("max_df corresponds to < documents than min_df")
    return lo, hi


def term_statistics(terms: DataFrame) -> DataFrame:
    """(term, df, cf) of ``terms(terms ARRAY<STRING>)``.  The row of the null
    term has the number of documents as its df.  Rows are counted in their
    document first and in their task before the shuffle."""
    per = F.concat(F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("tf"))),
                   F.coalesce(counted(F.col("terms")), F.array().cast("array<struct<term:string,tf:bigint>>")))
    return terms.select(F.explode(per).alias("e")).select("e.term", "e.tf").groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in blocks of bounded bytes of their last column."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(), dtype=np.int64)
        i = 0
        while i < len(batch):
            j = int(np.searchsorted(size, (size[i - 1] if i else 0) + BLOCK_BYTES, "right"))
            j = min(max(j, i + 1), i + BLOCK_TEXTS, len(batch))
            yield batch.slice(i, j - i)
            i = j


def _kept_words(texts: pa.Array, stops: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, number of the word, row): the words of texts of
    ``blank_non_terms`` without single characters and stop words, in order."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    coded = pc.list_flatten(lists).dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy()
    known = pc.and_(pc.greater(pc.utf8_length(words), 1), pc.invert(pc.is_in(words, stops)))
    keep = known.to_numpy(zero_copy_only=False)[code]
    return words, code[keep].astype(np.int64), pc.list_parent_indices(lists).to_numpy()[keep]


def _tally(key: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, df, cf) of the different keys."""
    both = np.sort(key * rows + row)
    key = both // rows
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    first = np.r_[True, both[1:] != both[:-1]][:len(both)].astype(np.int64)
    return key[begin], np.add.reduceat(first, begin) if len(key) else first, np.diff(np.r_[begin, len(key)])


def text_statistics(docs: DataFrame, text_col: str = "text", stop_words=ENGLISH_STOP_WORDS,
                    bigrams: bool = True) -> DataFrame:
    """``term_statistics`` of the terms of texts, counted in the helper and in
    the task before the shuffle."""
    ship_package(docs.sparkSession)
    stops = pa.array(list(stop_words), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            words, code, row = _kept_words(block.column(0), stops)
            n = len(block)
            key, df, cf = _tally(code, row, n)
            found = [(pa.array([None], pa.string()), np.array([n]), np.array([0])), (words.take(pa.array(key)), df, cf)]
            if bigrams:
                pair = np.flatnonzero(row[1:] == row[:-1])
                key, df, cf = _tally(code[pair] * len(words) + code[pair + 1], row[pair], n)
                two = [words.take(pa.array(x)) for x in (key // max(len(words), 1), key % max(len(words), 1))]
                found.append((pc.binary_join_element_wise(*two, " "), df, cf))
            for columns in found:
                yield from pa.table([pa.array(c) for c in columns], names=["term", "df", "cf"]).to_batches(ROWS)

    held = docs.select(blank_non_terms(text_col).alias("text")).mapInArrow(run, "term string, df long, cf long")
    return held.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def choose_vocabulary(stats: DataFrame, n_docs: int, max_features: int | None, min_df=1, max_df=0.8) -> DataFrame:
    """(term_id, term, df, cf, idf) of the terms within the df bounds, the
    ``max_features`` of highest cf, numbered from 0 in that order; a larger
    vocabulary than VOCABULARY_IN_TASKS without such a bound in any order."""
    lo, hi = _limits(n_docs, min_df, max_df)
    kept = stats.where(F.col("term").isNotNull() & (F.col("df") >= lo) & (F.col("df") <= hi))
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    if max_features is None:
        max_features = kept.count()
        if max_features > VOCABULARY_IN_TASKS:  # no order over all terms is needed
            return kept.select(F.monotonically_increasing_id().alias("term_id"), "term", "df", "cf", idf.alias("idf"))
    order = [F.col("cf").desc(), F.col("term").asc()]
    kept = kept.orderBy(*order).limit(max(max_features, 1))
    rank = F.row_number().over(Window.orderBy(*order)) - 1  # at most max_features rows
    return kept.select(rank.cast("long").alias("term_id"), "term", "df", "cf", idf.alias("idf"))


def fit_tfidf(corpus: DataFrame, max_features: int | None = 5000, min_df=1, max_df=0.8,
              stop_words=ENGLISH_STOP_WORDS, bigrams: bool = True) -> TfidfIndex:
    """Fit TF-IDF on a (doc_id, text) corpus (already normalised, see
    ``corpus_from_table``).  Raises ``ValueError`` like the reference: empty
    corpus, df bounds that leave nothing (one-document corpus), stop-word-only
    corpus.  The corpus is read twice: for the vocabulary and for the weights."""
    docs = corpus.select("doc_id", strip(F.col("text")).alias("text")).where(F.col("text") != "")
    stats = write_table(text_statistics(docs, "text", stop_words, bigrams), "tfidf-terms")
    all_docs = stats.where("term IS NULL").first()
    if all_docs is None:
        raise ValueError("No documents to index")
    n_docs = all_docs["df"]
    vocab = write_table(choose_vocabulary(stats, n_docs, max_features, min_df, max_df), "tfidf-vocabulary")
    n_terms = vocab.count()
    if n_terms == 0:
        if stats.where("term IS NOT NULL").limit(1).count() == 0:
            raise ValueError("empty vocabulary; perhaps the documents only contain stop words")
        raise ValueError("After pruning, no terms remain. Try a lower min_df or a higher max_df.")
    vectors = write_table(weigh_documents(docs, vocab, n_terms, stop_words, bigrams), "tfidf-vectors")
    return TfidfIndex(docs=docs, vocab=vocab, vectors=vectors, n_docs=n_docs, stop_words=tuple(stop_words),
                      bigrams=bigrams, max_features=max_features, n_terms=n_terms)


def weigh_documents(docs: DataFrame, vocab: DataFrame, n_terms: int, stop_words=ENGLISH_STOP_WORDS,
                    bigrams: bool = True) -> DataFrame:
    """``weigh`` of the terms of ``docs(doc_id, text)``: a vocabulary small
    enough goes to the tasks, which count and weigh a text in one go."""
    if n_terms > VOCABULARY_IN_TASKS:
        return weigh(term_column(docs, "text", stop_words, bigrams).select("doc_id", "terms"), vocab, n_terms)
    ship_package(docs.sparkSession)
    stops = pa.array(list(stop_words), pa.string())
    names = vocab.select("term", "idf").orderBy("term_id").collect()  # bounded
    shared = docs.sparkSession.sparkContext.broadcast(([r["term"] for r in names], np.array([r["idf"] for r in names])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        parts = [t.split(" ") for t in terms]
        number = {w: i for i, w in enumerate(sorted({w for p in parts for w in p}))}
        known = pa.array(list(number), pa.string())
        single = np.full(len(number) + 1, -1)  # the last for words that are in no term
        single[[number[p[0]] for p in parts if len(p) == 1]] = [i for i, p in enumerate(parts) if len(p) == 1]
        pairs = np.array([number[p[0]] * len(number) + number[p[1]] for p in parts if len(p) == 2], np.int64)
        order = np.argsort(pairs)
        pair_id = np.array([i for i, p in enumerate(parts) if len(p) == 2], np.int64)[order]
        pairs = pairs[order]
        for block in _blocks(batches):
            words, code, row = _kept_words(block.column(1), stops)
            at = pc.fill_null(pc.index_in(words, known), len(number)).to_numpy(zero_copy_only=False).astype(np.int64)[code]
            rows, ids = [row], [single[at]]
            if bigrams and len(pairs):
                two = np.flatnonzero((row[1:] == row[:-1]) & (at[1:] < len(number)) & (at[:-1] < len(number)))
                want = at[two] * len(number) + at[two + 1]
                place = np.minimum(np.searchsorted(pairs, want), len(pairs) - 1)
                rows.append(row[two])
                ids.append(np.where(pairs[place] == want, pair_id[place], -1))
            row, term = np.concatenate(rows), np.concatenate(ids)
            key, tf = np.unique(row[term >= 0] * len(terms) + term[term >= 0], return_counts=True)
            row, term = key // len(terms), key % len(terms)
            raw = tf * idf[term]
            start = np.searchsorted(row, np.arange(len(block) + 1))
            norm, size, j = np.zeros(len(block)), np.diff(start), 0
            held = np.flatnonzero(size)
            while len(held):  # one after another, as Spark's Normalizer sums
                norm[held] += raw[start[held] + j] ** 2
                j += 1
                held = held[size[held] > j]
            offsets = pa.array(start, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(offsets, pa.array(term, pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(raw / np.sqrt(norm)[row]))], names=["doc_id", "ids", "w"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", blank_non_terms("text").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, ids array<long>, w array<double>")


def weigh(terms: DataFrame, vocab: DataFrame, n_terms: int) -> DataFrame:
    """``terms(key, terms)`` -> ``key, ids ARRAY<LONG> ascending, w
    ARRAY<DOUBLE>``, of length 1 each vector that is not empty.  Terms outside
    the vocabulary are left out; one row per row, keys need not be unique
    unless the vocabulary is too large for the tasks."""
    key = terms.columns[0]
    if n_terms <= VOCABULARY_IN_TASKS:
        names = vocab.select("term_id", "term", "idf").orderBy("term_id").collect()  # bounded
        counts = CountVectorizerModel.from_vocabulary([r["term"] for r in names], inputCol="terms", outputCol="__tf")
        scaled = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in names]), inputCol="__tf",
                                    outputCol="__raw")
        unit = Normalizer(p=2.0, inputCol="__raw", outputCol="__w")
        v = F.unwrap_udt("__w")
        return unit.transform(scaled.transform(counts.transform(terms))).select(
            key, v["indices"].cast("array<long>").alias("ids"), v["values"].alias("w"))
    per = terms.select(key, F.explode_outer(counted(F.col("terms"))).alias("e")).select(key, "e.term", "e.tf")
    known = per.join(vocab.select("term", "term_id", "idf"), "term", "left")
    pair = F.when(F.col("term_id").isNotNull(), F.struct("term_id", (F.col("tf") * F.col("idf")).alias("w")))
    rows = known.groupBy(key).agg(F.sort_array(F.collect_list(pair)).alias("p"))
    return rows.select(key, F.transform("p", lambda x: x["term_id"]).alias("ids"),
                       _unit(F.transform("p", lambda x: x["w"])).alias("w"))


def _unit(w: Column) -> Column:
    norm = lambda a: F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
    return let(w, lambda a: let(norm(a), lambda n: F.transform(a, lambda x: x / n)))


def query_vectors(index: TfidfIndex, queries: DataFrame, key: str = "query_id",
                  text_col: str = "query_text") -> DataFrame:
    """``key, ids, w``: query vectors in the fitted space.  Terms outside the
    vocabulary are dropped and the rest L2-normalised; an all-unknown query
    has an empty vector."""
    t = term_column(queries.select(key, F.coalesce(text_col, F.lit("")).alias(text_col)), text_col,
                    index.stop_words, index.bigrams)
    return weigh(t.select(key, "terms"), index.vocab, index.n_terms)

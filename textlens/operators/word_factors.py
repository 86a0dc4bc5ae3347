"""Word vectors by factorising a co-occurrence table, with no model on the
driver and no bound on the vocabulary.

1. Words are numbered and the texts' words replaced by their numbers, each
   with the sum of its counts, which its places in the texts tell.
2. Pairs of words at most ``window`` apart are counted, each weighted by the
   inverse of its distance; the sums are made in the tasks before the shuffle.
   This shuffle of numbers is the only one that pairs pass: a pair brings what
   its association needs, so it is joined to nothing.
3. A pair's association is its positive pointwise mutual information, the
   contexts' shares smoothed by the power 0.75.
4. The table of associations is factorised by alternating least squares
   (``pyspark.ml.recommendation.ALS``), words and contexts in blocks; a word's
   vector is its factor.

Shuffle files and texts are removed as soon as what was made of them is written.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Event, Thread

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.operators.common import broadcast_if_small, drop_table, write_table
from textlens.session import checkpoint_dir, ship_package

SMOOTHING = 0.75
#: Runtime setting that removes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Seconds between two collections of what a fit no longer refers to.
COLLECT_SECONDS = 10.0
#: Associations of a block of words or contexts, about; a task of the
#: factorisation holds one block, several times over while it is built.
BLOCK_RATINGS = 4_000_000
#: Blocks for each core up to which the table is kept in memory.
BLOCKS_KEPT = 2
#: Tokens whose pairs a task holds at a time, one text at least.
BLOCK_TOKENS = 1 << 18


def number_rows(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add numbers from 0 without gaps, in the order of ``column``: rows are
    dealt by ranges, numbered in each and shifted by the ranges before."""
    dealt = write_table(df.repartitionByRange(column).withColumn("__part", F.spark_partition_id()), "numbered")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row a partition
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    row = F.row_number().over(Window.partitionBy("__part").orderBy(column))
    return dealt.withColumn("__row", row).join(F.broadcast(before), "__part").withColumn(
        out, F.col("__before") + F.col("__row") - 1).drop("__part", "__row", "__before")


@contextmanager
def released_files(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when they are no longer needed: those of a
    query at its end, those of a fit's earlier rounds when the driver collects
    its garbage, which is asked for every COLLECT_SECONDS."""
    held, done = spark.conf.get(CLEANUP, None), Event()

    def collect() -> None:
        while not done.wait(COLLECT_SECONDS):
            spark.sparkContext._jvm.System.gc()

    asking = Thread(target=collect, daemon=True)
    spark.conf.set(CLEANUP, "true")
    asking.start()
    try:
        yield
    finally:
        done.set()
        asking.join()
        spark.conf.unset(CLEANUP) if held is None else spark.conf.set(CLEANUP, held)


# --------------------------------------------------------------- numbers
def word_totals(tokens: DataFrame, window: int) -> DataFrame:
    """(word, total) of ``tokens(tokens ARRAY<STRING>)``: the sum of a word's
    counts with all contexts, told by its places; words that stand alone in
    all their texts are left out."""
    reach = F.array(*(F.lit(sum(1.0 / d for d in range(1, n + 1))) for n in range(window + 1)))

    def side(others: Column) -> Column:
        return F.get(reach, F.least(others, F.lit(window)))

    weighed = F.transform("tokens", lambda t, i: F.struct(
        t.alias("word"), (side(i) + side(F.size("tokens") - 1 - i)).alias("n")))
    made = tokens.select(F.explode(weighed).alias("p")).where("p.word IS NOT NULL")
    return made.groupBy("p.word").agg(F.sum("p.n").alias("total")).where("total > 0")


def numbered_words(tokens: DataFrame, window: int, min_count: float = 0.0) -> DataFrame:
    """(word, total, id) of the words whose counts sum to ``min_count`` at
    least, numbered from 0 in their order."""
    totals = word_totals(tokens, window).where(F.col("total") >= min_count)
    return write_table(number_rows(totals, "word", "id").select("word", "total", F.col("id").cast("int").alias("id")),
                       "word-numbers")


def number_tokens(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(places, ids, totals), arrays of one text each: its words by ``words(word, id,
    total)`` and their places in it; words that are not there are left out.
    ``tokens`` is a stored table, as its texts are told apart by where they lie."""
    texts = tokens.select(F.monotonically_increasing_id().alias("text"), "tokens")
    each = texts.select("text", F.posexplode("tokens").alias("place", "word"))
    known = each.join(broadcast_if_small(words), "word").select("text", F.struct("place", "id", "total").alias("w"))
    found = known.groupBy("text").agg(F.sort_array(F.collect_list("w")).alias("w"))
    return found.select(F.col("w.place").alias("places"), F.col("w.id").alias("ids"), F.col("w.total").alias("totals"))


def _block_pairs(text, place, ids, totals, window: int) -> pa.RecordBatch:
    """Summed pairs of whole texts, the smaller number first."""
    found = []
    for step in range(1, min(window, len(ids) - 1) + 1):
        # words that are not numbered leave gaps, so a step reaches this far or farther
        gap = place[step:] - place[:-step]
        a = np.flatnonzero((text[step:] == text[:-step]) & (gap <= window))
        found.append((a, a + step, 1.0 / gap[a]))
    a, b, n = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    swap = ids[a] > ids[b]
    low, high = np.where(swap, b, a), np.where(swap, a, b)
    _, first, group = np.unique(ids[low].astype(np.int64) << 32 | ids[high], return_index=True, return_inverse=True)
    low, high = low[first], high[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (ids[low], ids[high], np.bincount(group, n, len(first)), totals[low], totals[high])],
        names=["low", "high", "n", "low_total", "high_total"])


def count_pairs(numbered: DataFrame, window: int) -> DataFrame:
    """(low, high, n, low_total, high_total) of numbered texts: the sum of
    1 / distance over all places at most ``window`` apart, each pair once."""
    ship_package(numbered.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column(0).offsets.to_numpy().astype(np.int64)
            starts = starts - starts[0]
            place, ids, totals = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
            i = 0
            while i < len(batch):
                j = max(int(np.searchsorted(starts, starts[i] + BLOCK_TOKENS, "right")) - 1, i + 1)
                text = np.repeat(np.arange(i, j), np.diff(starts[i:j + 1]))
                at = slice(starts[i], starts[j])
                yield _block_pairs(text, place[at], ids[at], totals[at], window)
                i = j

    made = numbered.mapInArrow(run, "low int, high int, n double, low_total double, high_total double")
    # a word has one total; as keys they need no second column of sums
    return made.groupBy("low", "high", "low_total", "high_total").agg(F.sum("n").alias("n"))


def cooccurrences(tokens: DataFrame, window: int = 5) -> DataFrame:
    """(word, context, n) of ``tokens(tokens ARRAY<STRING>)``, both ways:
    the sum of 1 / distance over all places at most ``window`` apart."""
    stored = write_table(tokens.select("tokens"), "word-tokens")
    words = numbered_words(stored, window)
    pairs = both_ways(count_pairs(number_tokens(stored, words), window))
    word = broadcast_if_small(words.select("id", "word"))
    context = broadcast_if_small(words.select(F.col("id").alias("context_id"), F.col("word").alias("context")))
    return pairs.join(word, "id").join(context, "context_id").select("word", "context", "n")


def both_ways(half: DataFrame) -> DataFrame:
    """(id, context_id, n, wn, cn) of ``count_pairs``: each pair and its
    mirror, a word with itself once and counted from both sides."""
    def one(a: str, b: str, n: Column) -> Column:
        return F.struct(F.col(a).alias("id"), F.col(b).alias("context_id"), n.alias("n"),
                        F.col(f"{a}_total").alias("wn"), F.col(f"{b}_total").alias("cn"))

    n = F.col("n")
    both = F.when(F.col("low") == F.col("high"), F.array(one("low", "low", n * 2))).otherwise(
        F.array(one("low", "high", n), one("high", "low", n)))
    return half.select(F.explode(both).alias("p")).select("p.*")


# ---------------------------------------------------------- associations
def _association(smoothed: float) -> Column:
    return F.log(F.col("n") / F.col("wn")) - F.log(F.pow("cn", F.lit(SMOOTHING)) / smoothed)


def _smoothed(totals: DataFrame) -> float:
    return totals.agg(F.sum(F.pow("total", F.lit(SMOOTHING))).alias("s")).first()["s"] or 1.0


def associations(pairs: DataFrame, min_count: float = 0.0) -> DataFrame:
    """(word, context, association above 0) of counted pairs; words whose
    counts sum to less than ``min_count`` are left out."""
    totals = write_table(pairs.groupBy("word").agg(F.sum("n").alias("total")).where(F.col("total") >= min_count),
                         "word-totals")
    word = totals.select("word", F.col("total").alias("wn"))
    context = totals.select(F.col("word").alias("context"), F.col("total").alias("cn"))
    joined = pairs.join(broadcast_if_small(word), "word").join(broadcast_if_small(context), "context")
    return joined.select("word", "context", _association(_smoothed(totals)).alias("association")).where(
        F.col("association") > 0)


def numbered_associations(tokens: DataFrame, window: int, min_count: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """``associations`` of ``cooccurrences``, by numbers: (id, context_id,
    association FLOAT) and (word, id), the words that have an association, from 0
    without gaps in their order.  ``tokens`` is a stored table."""
    words = numbered_words(tokens, window, min_count)
    texts = write_table(number_tokens(tokens, words), "word-texts")
    pairs = both_ways(count_pairs(texts, window)).select(
        "id", "context_id", _association(_smoothed(words)).alias("association")).where(F.col("association") > 0)
    rated = write_table(pairs.select("id", "context_id", F.col("association").cast("float").alias("association")),
                        "word-ratings")
    drop_table(texts)
    used = rated.select("id").distinct()
    if used.count() == words.count():
        return rated, words.select("word", "id")
    # rare: a word whose contexts are spread just as all words are has none
    kept = write_table(number_rows(words.select("word", F.col("id").alias("was")).join(used.withColumnRenamed(
        "id", "was"), "was"), "word", "id").select("word", "was", F.col("id").cast("int").alias("id")), "word-numbers")
    word = kept.select("was", F.col("id").alias("now"))
    context = kept.select(F.col("was").alias("context_id"), F.col("id").alias("context"))
    rated = rated.withColumnRenamed("id", "was").join(broadcast_if_small(word), "was").join(
        broadcast_if_small(context), "context_id")
    return write_table(rated.select(F.col("now").alias("id"), F.col("context").alias("context_id"), "association"),
                       "word-ratings"), kept.select("word", "id")


def factorise_words(tokens: DataFrame, vector_size: int = 64, window: int = 5, min_count: float = 0.0,
                    max_iter: int = 8, regularisation: float = 0.05, seed: int = 42,
                    blocks: int | None = None) -> DataFrame:
    """(word, vector ARRAY<DOUBLE>) of a (…, tokens) table.  A word without a
    positive association to any other has no vector.  Word numbers are 32-bit,
    the bound of ALS: 2^31 different words."""
    spark = tokens.sparkSession
    checkpoint_dir(spark)  # ALS cuts its lineage there
    with released_files(spark):
        stored = write_table(tokens.select("tokens"), "word-tokens")
        rated, words = numbered_associations(stored, window, min_count)
        drop_table(stored)
        ratings = rated.count()
        if ratings == 0:
            return spark.createDataFrame([], "word string, vector array<double>")
        # as many blocks as there are cores would grow with the table; a table of
        # more is not kept in memory, which the tasks need for their blocks
        cores, needed = spark.sparkContext.defaultParallelism, -(-ratings // BLOCK_RATINGS)
        blocks = blocks or max(cores, needed)
        kept = "DISK_ONLY" if needed > BLOCKS_KEPT * cores else "MEMORY_AND_DISK"
        # each round's shuffles are let go by a checkpoint of that round
        als = ALS(rank=vector_size, maxIter=max_iter, regParam=regularisation, implicitPrefs=True, alpha=1.0, seed=seed,
                  userCol="id", itemCol="context_id", ratingCol="association", checkpointInterval=1,
                  numUserBlocks=blocks, numItemBlocks=blocks,
                  intermediateStorageLevel=kept, finalStorageLevel=kept)
        factors = als.fit(rated).userFactors
        found = write_table(factors.join(words, "id").select("word", F.col("features").alias("vector")), "word-factors")
    return found.select("word", F.col("vector").cast("array<double>").alias("vector"))

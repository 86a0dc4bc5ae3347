"""Word vectors by factorisation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textlens.operators.semantic import similar_words
from textlens.operators.word_factors import associations, cooccurrences, factorise_words, number_rows


def tokens_df(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, tokens array<string>")


def brute_pairs(rows, window):
    out = {}
    for t in rows:
        for i, a in enumerate(t or []):
            for d in range(1, window + 1):
                if i + d < len(t):
                    for p in ((a, t[i + d]), (t[i + d], a)):
                        out[p] = out.get(p, 0) + 1 / d
    return out


def test_pairs_and_associations_by_brute_force(spark):
    rnd = random.Random(2)
    rows = [[rnd.choice("abcdefgh") * 2 for _ in range(rnd.randint(0, 14))] for _ in range(40)] + [None, ["aa", "aa", "aa"]]
    want = brute_pairs(rows, 3)
    pairs = cooccurrences(tokens_df(spark, rows), 3)
    got = {(r["word"], r["context"]): r["n"] for r in pairs.collect()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(n) for p, n in want.items())
    total = {}
    for (w, _), n in want.items():
        total[w] = total.get(w, 0) + n
    smooth = sum(n ** 0.75 for n in total.values())
    pmi = {(w, c): math.log(n / total[w]) - math.log(total[c] ** 0.75 / smooth) for (w, c), n in want.items()}
    mine = {(r["word"], r["context"]): r["association"] for r in associations(pairs).collect()}
    assert mine.keys() == {p for p, x in pmi.items() if x > 0}
    assert all(x == pytest.approx(pmi[p]) for p, x in mine.items())


def test_planted_synonyms_are_nearest(spark):
    """Words of one topic are used in the same contexts, never side by side."""
    rnd = random.Random(5)
    topics = {f"t{i}": ([f"x{i}", f"y{i}"], [f"c{i}{j}" for j in range(6)]) for i in range(8)}
    rows = []
    for _ in range(1500):
        pair, contexts = topics[rnd.choice(sorted(topics))]
        rows.append([rnd.choice(contexts), rnd.choice(pair), rnd.choice(contexts), rnd.choice(["the", "of", "and"])])
    vectors = factorise_words(tokens_df(spark, rows), vector_size=12, window=2)
    assert {len(r["vector"]) for r in vectors.collect()} == {12}
    asked = spark.createDataFrame([(w,) for i in range(8) for w in (f"x{i}", f"y{i}")] + [("unknown",)], "word string")
    best = {}
    for r in similar_words(asked, vectors, 9).collect():
        best.setdefault(r["word"], []).append((r["rank"], r["similar"]))
    hits = 0
    for i in range(8):
        for w, other in ((f"x{i}", f"y{i}"), (f"y{i}", f"x{i}")):
            mine = [s for _, s in sorted(best[w]) if s[0] in "xy"]
            hits += mine[:1] == [other]
    assert hits >= 15 and "unknown" not in best


def test_no_pairs_no_vectors(spark):
    assert factorise_words(tokens_df(spark, [["alone"], [], None])).collect() == []


def test_numbers_without_gaps(spark):
    df = spark.range(1000).select(F.concat(F.lit("w"), F.col("id") % 600).alias("word")).distinct()
    got = {r["word"]: r["n"] for r in number_rows(df, "word", "n").collect()}
    assert got == {w: i for i, w in enumerate(sorted(got))} and len(got) == 600


def test_blocks_of_the_factorisation_do_not_grow_with_the_table(spark, monkeypatch):
    from textlens.operators import word_factors

    asked = []
    made = word_factors.ALS

    def als(**settings):
        asked.append((settings["numUserBlocks"], settings["numItemBlocks"], settings["intermediateStorageLevel"]))
        return made(**settings)

    monkeypatch.setattr(word_factors, "ALS", als)
    monkeypatch.setattr(word_factors, "BLOCK_RATINGS", 5, raising=False)
    rnd = random.Random(3)
    rows = [[rnd.choice("abcdefghijklmnop") * 2 for _ in range(8)] for _ in range(60)]
    vectors = factorise_words(tokens_df(spark, rows), vector_size=2, window=2, max_iter=1).collect()
    n = associations(cooccurrences(tokens_df(spark, rows), 2)).count()
    assert n > 10 * spark.sparkContext.defaultParallelism and len(vectors) == 16
    assert asked == [(-(-n // 5), -(-n // 5), "DISK_ONLY")]

"""Word factors at size: what is stored and shuffled."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from textlens.operators import word_factors
from textlens.operators.common import write_table
from textlens.operators.word_factors import (associations, cooccurrences, factorise_words, numbered_associations,
                                             number_tokens, numbered_words, word_totals)
from textlens.session import checkpoint_dir


def texts(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, tokens array<string>").repartition(3)


def random_rows(n, words, longest, seed=3):
    rnd = random.Random(seed)
    return [[f"w{min(int(rnd.paretovariate(0.6)), words)}" for _ in range(rnd.randint(0, longest))] for _ in range(n)]


def stored_bytes(spark):
    top = checkpoint_dir(spark).removeprefix("file:")
    return {f: os.path.getsize(f) for f in glob.glob(f"{top}/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("min_count", [0.0, 4.0])
def test_associations_by_numbers_are_those_by_words(spark, min_count):
    rows = random_rows(120, 60, 12) + [None, [], ["alone"], ["aa", "aa", "aa"], ["bb", "cc"]]
    tokens = texts(spark, rows)
    want = {(r["word"], r["context"]): r["association"]
            for r in associations(cooccurrences(tokens, 3), min_count).collect()}
    has = {w for w, _ in want}
    want = {p: x for p, x in want.items() if p[1] in has}
    rated, words = numbered_associations(write_table(tokens.select("tokens"), "tokens"), 3, min_count)
    names = {r["id"]: r["word"] for r in words.collect()}
    got = {(names[r["id"]], names[r["context_id"]]): r["association"] for r in rated.collect()}
    assert [names[i] for i in range(len(names))] == sorted(has)
    assert got.keys() == want.keys() and all(x == pytest.approx(want[p], rel=1e-6) for p, x in got.items())


def test_words_without_an_association_leave_no_gap(spark):
    """All words are spread alike but two, whose contexts are then the only ones."""
    rows = [["b", "b", "b"], ["a", "z"], ["a", "z"]]
    rated, words = numbered_associations(write_table(texts(spark, rows).select("tokens"), "tokens"), 1, 5.0)
    assert rated.count() == 0 and words.count() == 0
    rated, words = numbered_associations(write_table(texts(spark, rows).select("tokens"), "tokens"), 1)
    assert {(r["word"], r["id"]) for r in words.collect()} == {("a", 0), ("b", 1), ("z", 2)}


def test_totals_by_places_are_the_sums_of_pairs(spark):
    tokens = texts(spark, random_rows(80, 40, 9) + [["aa"], None, ["aa", "aa"]])
    want = {r["word"]: r["n"] for r in cooccurrences(tokens, 4).groupBy("word").agg(F.sum("n").alias("n")).collect()}
    got = {r["word"]: r["total"] for r in word_totals(tokens, 4).collect()}
    assert got.keys() == want.keys() and all(got[w] == pytest.approx(n) for w, n in want.items())


def test_texts_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(word_factors, "BLOCK_TOKENS", 8)
    rows = random_rows(30, 20, 40)
    stored = write_table(texts(spark, rows).select("tokens"), "tokens")
    want = {}
    for t in rows:
        for i in range(len(t)):
            for d in range(1, 4):
                if i + d < len(t):
                    p = tuple(sorted((t[i], t[i + d])))
                    want[p] = want.get(p, 0) + 1 / d
    words = numbered_words(stored, 3)
    names = {r["id"]: r["word"] for r in words.collect()}
    batches = number_tokens(stored, words).toArrow().to_batches()
    got = {}
    for b in batches:
        for places, ids, totals in zip(*(c.to_pylist() for c in b.columns)):
            for r in word_factors._block_pairs(*(word_factors.np.array(x) for x in (
                    [0] * len(ids), places, ids, totals)), 3).to_pylist():
                p = tuple(sorted((names[r["low"]], names[r["high"]])))
                got[p] = got.get(p, 0) + r["n"]
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(n) for p, n in want.items())


def test_pairs_are_stored_once_and_as_numbers(spark):
    rows = [[f"word{random.Random(i * 500 + j).randrange(4000)}" for j in range(100)] for i in range(300)]
    tokens = texts(spark, rows)
    pairs = cooccurrences(tokens, 3).count()
    before = stored_bytes(spark)
    assert factorise_words(tokens, vector_size=2, window=3, max_iter=1).count() > 3900
    new = sum(n for f, n in stored_bytes(spark).items() if f not in before)
    assert new < 16 * pairs  # a rating has 12; before, the words of each pair were stored twice besides


def test_shuffle_files_go_and_the_setting_is_put_back(spark):
    # this session's folders only: others may run beside it
    own = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {f for d in own for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    root = files()
    held = spark.conf.get(word_factors.CLEANUP, None)
    stored = write_table(texts(spark, random_rows(200, 500, 60)).select("tokens"), "tokens")
    with word_factors.released_files(spark):
        numbered_associations(stored, 3)
        left = files() - root
    assert len(left) <= 8  # those of counts that are collected, not written
    assert spark.conf.get(word_factors.CLEANUP, None) == held

"""Toxicity: segments by brute force, scores by plain counts, held-out accuracy."""

import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_CHECK
from textlens.llm import toxicity


def brute_segments(scores):
    """Maximal segments by definition: of the best segments first, those that
    are disjoint from all better ones, recursively to their left and right."""
    n = len(scores)
    best = None
    for i in range(n):
        total = 0
        for j in range(i, n):
            total += scores[j]
            key = (total, -(j - i), -i)
            if total > 0 and (best is None or key > best[0]):
                best = (key, i, j + 1, total)
    if best is None:
        return []
    _, i, j, total = best
    left = brute_segments(scores[:i])
    right = [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]
    return left + [(i, j, total)] + right


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-6, 6), max_size=24))
def test_segments_by_brute_force(scores):
    got = toxicity.maximal_segments(np.array(scores, float))
    want = brute_segments(scores)
    assert [s for *_, s in got] == [s for *_, s in want]
    for a, b, s in got:
        assert sum(scores[a:b]) == s > 0
    for (_, b, _), (a, _, _) in zip(got, got[1:]):
        assert b <= a


def test_segments_of_a_long_text_in_linear_time():
    r = np.random.default_rng(1)
    for scores in (r.normal(-0.1, 1, 1_000_000), np.tile([1.0, -2.0], 500_000), np.tile([2.0, -1.0], 500_000),
                   np.repeat([1.0, -1.0], 500_000)):
        found = toxicity.maximal_segments(scores)
        assert found and all(s > 0 for *_, s in found)


def test_log_odds_by_plain_counts(spark):
    texts = [(i, t, y) for i, (t, y) in enumerate(
        [("you awful clown go away", 1), ("awful awful clowns", 1), ("the garden is green", 0),
         ("the day was fine today", 0), ("clown shows for children today", 0), (None, 1), ("", 0)] * 4)]
    df = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    old, toxicity.HELD_BACK = toxicity.HELD_BACK, 10 ** 9  # count every document of the sample
    try:
        chosen, counts = toxicity.sample_labels(df)
        assert counts == {0: 16, 1: 12}
        assert not any(r["back"] for r in chosen.collect())
        model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    finally:
        toxicity.HELD_BACK = old
    pairs, tokens = set(), {}
    for _, t, y in texts:
        before = ""
        for w in (t or "").split():
            pairs.add((y, before, w))
            tokens[w] = tokens.get(w, 0) + 1
            before = w
    tox, other = ({w: sum(p[0] == y and p[2] == w for p in pairs) for w in tokens} for y in (1, 0))
    nt, no = sum(tox.values()), sum(other.values())
    scale = (nt + no) / sum(tokens.values())
    for w in ("clown", "awful", "the", "clowns", "today", "unseen"):
        stem = w[:toxicity.STEM]
        st_, so = (sum(n for v, n in side.items() if v[:toxicity.STEM] == stem) for side in (tox, other))
        share = (st_ + nt / (nt + no)) / (st_ + so + 1)
        k = 1 + 0.05 * scale * tokens.get(w, 0)
        want = math.log((tox.get(w, 0) + k * share) / nt) - math.log((other.get(w, 0) + k * (1 - share)) / no)
        assert model.lexicon.log_odds([w])[0] == pytest.approx(want, abs=1e-4)


def test_a_word_said_again_adds_nothing():
    s = toxicity.Scores(lambda ws: np.array([{"bad": 3.0, "very": 0.5}[w] for w in ws]))
    assert s.of("very bad bad BAD very bad").tolist() == [0.0, 2.5, -0.5, -0.5, 0.0, 2.5]
    assert len(s.of("")) == 0
    long_ = s.of("very bad " * 100_000)
    assert len(long_) == 200_000 and long_.sum() == 250_000


def test_buckets_of_one_and_of_many():
    found = ["a", "été", "straße", "x" * 200, "日本"]
    assert toxicity.buckets(found).tolist() == [toxicity.word_buckets(w) for w in found]
    assert toxicity.buckets([]).shape == (0, toxicity.ROWS + 1)


def test_extreme_value_law():
    r = np.random.default_rng(7)
    size = r.integers(20, 2000, 20_000)
    best = (np.log(0.05 * size) - np.log(-np.log(r.random(20_000)))) / 0.8
    rate, scale = toxicity.fit_extreme_values(best, size)
    assert rate == pytest.approx(0.8, rel=0.03) and scale == pytest.approx(0.05, rel=0.1)


def test_sums_of_segments():
    order, evidence = toxicity.least_likely_sum(np.array([1.0, 6.0, 5.0, -3.0]))
    by_r = {}
    for r, x in ((1, 6.0), (2, 11.0), (3, 12.0), (4, 9.0)):
        p = math.exp(-x) * x ** (r - 1) / (math.factorial(r) * math.factorial(r - 1)) * 2 ** r
        by_r[r] = -math.log(p)
    assert evidence == pytest.approx(max(by_r.values())) and len(order) == max(by_r, key=by_r.get)
    assert order.tolist() == [1, 2, 0][:len(order)]
    assert toxicity.least_likely_sum(np.zeros(0))[1] == 0 == toxicity.least_likely_sum(np.array([-4.0]))[1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    out = toxicity.toxicity_query(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert [zlib.crc32(str(d).encode()) % 3 == 1 for d in out["doc_id"]] == out["held_out"].tolist()
    test = out[out["held_out"]]
    caught = (test["predicted"][test["toxic"] == 1] == 1).mean()
    clean = (test["predicted"][test["toxic"] == 0] == 0).mean()
    assert caught >= 0.6 and clean >= 0.98  # 33 toxic documents to learn from; 0.99 and 0.995 on check_s
    t, c = (test["score"][test["toxic"] == y].to_numpy() for y in (1, 0))
    assert (t[:, None] > c[None, :]).mean() + 0.5 * (t[:, None] == c[None, :]).mean() >= 0.95
    assert ((out["score"] >= 0) & (out["score"] <= 1)).all()
    assert ((out["score"] >= 0.7) == (out["predicted"] == 1)).all()


def test_passages_and_edge_cases(spark):
    mean = "stupid worthless idiot moron"
    # İ becomes two characters when lower-cased: places are those of the text as it is
    texts = [(i, f"the garden is green and day {i} was fine today in the house", 0) for i in range(60)]
    texts += [(100 + i, f"the garden is green {mean} and day was fine in the house", 1) for i in range(30)]
    texts += [(200, None, None), (201, "", None), (None, "İİ the garden " + mean + " is", None),
              (202, "green house " * 50_000, None), (202, mean, None), (202, mean, None)]
    df = spark.createDataFrame([(d, t, 0.5, 1) for d, t, _ in texts], "doc_id long, text string, score double, y int")
    labels = spark.createDataFrame([(d, y) for d, _, y in texts] + [(100, 0), (5, None)], "doc_id long, toxic int")
    rows = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert [p["start"] for p in by[None][0]["passages"]][0] == len("İİ the garden ")
    (p, *more) = by[None][0]["passages"]
    assert ("İİ the garden " + mean + " is")[p["start"]:(more or [p])[-1]["end"]] == mean
    assert not by[200][0]["passages"] and not by[201][0]["passages"]
    assert by[200][0]["score"] == by[201][0]["score"] < 0.5
    assert {len(r["passages"]) > 0 for r in by[202]} == {False, True} and len(by[202]) == 3
    q = toxicity.toxicity_query(df, labels)
    assert q.columns == ["doc_id", "held_out", "score", "predicted", "n_passages"] and q.count() == len(texts)
    assert toxicity.toxicity_query(df.limit(0), labels).collect() == []
    none = toxicity.toxicity_query(df, labels.limit(0)).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in none] == [(0.0, 0)]

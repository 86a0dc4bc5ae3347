"""SimHash, repeated strings, Hamming search, connected components."""

import hashlib
import random

import brute
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from textlens.llm import hamming, repeats, simhash
from textlens.llm.common import connected_components, global_rank

DOCS = "doc_id long, text string"


def test_components_equal_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)] + [(5, 5), (None, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_global_rank(spark):
    rows = [(None,), ("b",), ("a",), ("é",), ("Z",)] + [(f"k{i:04d}",) for i in range(500)]
    got = {r["s"]: r["rank"] for r in global_rank(spark.createDataFrame(rows, "s string"), ["s"], "rank", "t").collect()}
    order = sorted((r[0] for r in rows if r[0] is not None), key=lambda s: s.encode()) + [None]
    assert got == {s: i for i, s in enumerate(order)}


def near_texts():
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(words) for _ in range(rnd.choice([3, 20, 120, 400]))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for _ in range(160):
        b = list(rnd.choice(base))
        b[rnd.randrange(len(b))] = rnd.choice(words)
        texts.append(" ".join(b))
    return texts + [None, "", " \n", "One", "ONE", "one two", "A b C", "a B c", texts[0], texts[0], "É x y z", "é x y z",
                    "word " * 60_000]


def test_simhash_equals_brute_force(spark):
    texts = near_texts()
    ids = [5 * i + 3 for i in range(len(texts))]
    rows = list(zip(ids, texts)) + [(ids[3], texts[3]), (None, texts[1])]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("clash")).repartition(5)
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in simhash.simhash_query(docs).collect())
    fps = [(d, brute.simhash(t)) for d, t in rows]
    want = sorted((d or -1, f"{fp:016x}", c) for (d, fp), c in zip(fps, brute.simhash_components(fps)))
    assert got == want


@pytest.mark.parametrize("chunk", [2, 64, 4096])
def test_links_of_dense_buckets(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rnd = random.Random(11)
    fps = {0, 1, (1 << 64) - 1}
    for center in (rnd.getrandbits(64) for _ in range(6)):
        for _ in range(80):
            fps.add(center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = connected_components(simhash.links(table)).collect()
    root = {r["node"]: r["root"] for r in got}
    want = brute.simhash_components(list(zip(range(len(fps)), fps)))
    parts = {}
    for s, c in zip(signed, want):
        parts.setdefault(c, set()).add(root.get(s, s))
    assert all(len(v) == 1 for v in parts.values())
    assert len({next(iter(v)) for v in parts.values()}) == len(parts)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_links(radius):
    rnd = random.Random(radius)
    center = rnd.getrandbits(64)
    fps = np.array([center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(300)],
                   dtype=np.uint64)
    group = np.sort(np.array([rnd.randrange(5) for _ in range(300)]))
    label = np.arange(300)
    a, b = simhash.link_groups(fps, group, radius)
    label[a] = b
    want = np.arange(300)
    for _ in range(300):
        before = want.copy()
        for i in range(300):
            near = [j for j in range(300) if group[j] == group[i] and bin(int(fps[i] ^ fps[j])).count("1") <= radius]
            want[i] = min(want[near])
        if (want == before).all():
            break
    assert (label == want).all()


def test_one_of_each_group_stays(spark):
    texts = near_texts()
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)] + [(3, texts[3], "s0"), (None, texts[5], None)]
    docs = spark.createDataFrame(rows, DOCS + ", source string")
    fps = [(i, brute.simhash(t)) for i, t in enumerate(texts)]
    want = {i for (i, _), c in zip(fps, brute.simhash_components(fps)) if i == c}
    out = simhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.where("doc_id IS NOT NULL").collect()) == sorted(want)
    assert simhash.simhash_query(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        simhash.links(docs, 4)


# --- repeated strings
def test_matching_lengths_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(10):
        src = bytes(rnd.choice(b"ab\x00") for _ in range(200))
        texts = list({src[(i := rnd.randint(0, 150)):i + rnd.randint(1, 90)] + bytes(
            rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(6)})
        sym = [x for t in texts for x in [*(c + 1 for c in t), 0]]
        got = repeats.matching_lengths(texts)
        for i in range(len(sym)):
            best = 0
            for j in range(len(sym)):
                n = 0
                while i != j and max(i, j) + n < len(sym) and sym[i + n] == sym[j + n]:
                    n += 1
                best = max(best, n)
            assert got[i] == best


def repeat_texts():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(60) for _ in range(4)]
    base = [text(rnd.randint(1, 200)) for _ in range(30)]
    texts = list(base)
    for _ in range(40):
        t = rnd.choice(base).split(" ")
        for _ in range(rnd.randint(0, 4)):
            t[rnd.randrange(len(t))] = word()
        texts.append(" ".join(t))
    texts += [text(rnd.randint(0, 30)) + " " + rnd.choice(passages) + " " + text(rnd.randint(0, 30)) for _ in range(30)]
    return texts + [None, "", "x" * 1000, "x" * 199, "ab" * 300, "x" * 300, base[0], base[0]]


@pytest.mark.parametrize("hot,tile", [(2000, 1 << 20), (3, 1 << 20), (2000, 1 << 12)])
def test_repeats_equal_brute_force(spark, monkeypatch, hot, tile):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = repeat_texts()
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, texts[2])]
    docs = spark.createDataFrame(rows, DOCS).withColumn("k", F.lit("clash")).repartition(3)
    want = sorted((d if d is not None else -1, n, m, s, hashlib.sha256(k).hexdigest())
                  for (d, _), (n, m, s, k) in zip(rows, brute.repeats([t for _, t in rows])))
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in repeats.repeats_query(docs).collect())
    assert got == want
    if tile != 1 << 20:  # cut documents: the same windows, each in one tile
        monkeypatch.setattr(repeats, "TILE", tile)
        seen = {}
        for t in repeats._tiles(np.array([10_000, 150, 5_000, 200]), 200):
            assert sum(e - s for _, s, e in t) <= tile
            for d, s, e in t:
                for w in range(s, e - 199):
                    assert (d, w) not in seen
                    seen[d, w] = 1
        assert len(seen) == 9801 + 4801 + 1


def test_repeats_of_an_empty_table(spark):
    assert repeats.repeats_query(spark.createDataFrame([], DOCS)).count() == 0


# --- Hamming search
def test_top_k_equals_brute_force(spark):
    rnd = random.Random(9)
    center = rnd.getrandbits(64)
    codes = [rnd.getrandbits(64) for _ in range(150)]
    codes += [center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 9))) for _ in range(100)] + [center] * 30
    sign = lambda c: c - (1 << 64) if c >> 63 else c
    rows = spark.createDataFrame([(i, sign(c)) for i, c in enumerate(codes)] + [(None, 1), (900, None)],
                                 "id long, code long").withColumn("q", F.lit(0))
    asked = [(i, codes[i]) for i in range(0, 280, 14)] + [(1, center), (1, center)]
    queries = spark.createDataFrame([(i, sign(c)) for i, c in asked] + [(None, 5), (4, None)], "query_id long, code long")
    got = {}
    for r in hamming.top_k(queries, rows, 7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["id"]))
    for q, c in dict(asked).items():
        best = sorted((bin(c ^ x).count("1"), i) for i, x in enumerate(codes))[:7]
        assert sorted(got[q]) == [(k + 1, d, i) for k, (d, i) in enumerate(best)]
    few = hamming.top_k(queries, rows.where("id < 3"), 7).groupBy("query_id").count().collect()
    assert {r["count"] for r in few} == {3}
    assert hamming.top_k(queries, rows.limit(0), 7).count() == 0
    assert hamming.top_k(queries.limit(0), rows, 7).count() == 0


def test_sign_code(spark):
    vec = [1.0 if i in (0, 5, 63) else -1.0 for i in range(64)]
    t = spark.createDataFrame([(vec,), (None,), ([1.0, None, 0.0],)], "v array<double>")
    got = [r[0] for r in t.select(hamming.sign_code(F.col("v"))).collect()]
    assert got == [1 + 32 - (1 << 63), None, 1]


def test_queries_read_small_tables(spark):
    from textlens.llm.queries import QUERIES

    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op2_repeated_strings", "op3_simhash_near_dedup"):
        assert QUERIES[name](spark, SF_SMALL).count() == n

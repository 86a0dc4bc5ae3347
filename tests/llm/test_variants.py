"""Spelling variants against a comparison of all pairs of words."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_CHECK, SF_SMALL
from textlens.llm import variants

LETTERS = "A-Za-z" + chr(0xC0) + "-" + chr(0xFF)


def brute_words(docs, least=3):
    n = Counter()
    for d, text in docs:
        for run in re.findall(f"[{LETTERS}]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= least}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    return a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def brute(docs, near=None, least=3):
    n = brute_words(docs, least)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


TEXTS = [None, "", "house house house house hause hause hause hous hous hous houses houses houses", "é" * 3,
         "hausés " * 8 + "HOUSES houseS " * 4, "aabbb aabbb aabbb aabb aabbbb " * 4, "x" * 3000 + " " + "x" * 2999 + " ",
         ("y" * 70 + " " + "y" * 69 + "z " + "y" * 134 + " ") * 3, "one-two×three÷four " * 3]


def test_small_table_by_brute_force(spark):
    docs = [(i if i != 2 else None, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (6, TEXTS[6]), (16, TEXTS[6])]
    df = spark.createDataFrame([(d, t, "w", 3) for d, t in docs], "doc_id long, text string, word string, n int")
    assert rows(variants.variants_query(df)) == brute(docs)
    assert variants.variants_query(df.limit(0)).collect() == []
    assert variants.variants_query(df.where("text = ''")).collect() == []


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_whole_table_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given_ = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    if sf == SF_SMALL:
        assert rows(variants.variants_query(docs)) == brute(given_)
    else:
        n = brute_words(given_)
        assert {r["word"]: r["n"] for r in variants.vocabulary(docs).collect()} == n


def test_several_rounds_of_filters(spark, monkeypatch):
    """A vocabulary above the filters' bound: same pairs, in several rounds."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = variants.vocabulary(docs, 1).limit(3000).persist()
    try:
        once = rows(variants.near_pairs(words))
        monkeypatch.setattr(variants, "FILTER_BYTES", 2500)
        assert rows(variants.near_pairs(words)) == once
        held = [r["word"] for r in words.collect()]
    finally:
        words.unpersist()
    got = {(a, b) for a, _, b, _ in once}
    lengths = {}
    for w in held:
        lengths.setdefault(len(w), []).append(w)
    assert got == {(a, b) for a in held for k in (-1, 0, 1) for b in lengths.get(len(a) + k, ()) if one_edit(a, b)}
    assert len(got) == len(once)


def test_filters_keep_few_false_positives(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = spark.createDataFrame([(r["word"], 1) for r in variants.vocabulary(docs, 1).collect()], "word string, n long")
    held = [r["word"] for r in words.collect()]
    lengths = Counter(variants.shard(len(w)) for w in held)
    sizes = {s: -(-n * variants.BITS // 512) for s, n in lengths.items()}
    filters = variants.build_filters(words, sizes, 1, 0)
    have = set(held)
    probes = list(variants.edits(held[:500], filters, 1, 0))
    wrong = sum(w not in have for _, w in probes)
    tried = sum(len(w) * (1 + sum(int(x) > ord(c) for c in w for x in variants.LETTERS) / len(w)) for w in held[:500])
    assert wrong < 0.01 * tried


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcéÿ", min_size=1, max_size=7), min_size=2, max_size=12, unique=True))
def test_edits_find_every_near_word(words):
    """Filters that hold everything: all deletions and later replacements."""
    full = {variants.shard(k): variants.np.full((1, 8), 2**64 - 1, variants.np.uint64) for k in range(0, 9)}
    made = Counter(variants.edits(words, full, 1, 0))
    assert max(made.values()) == 1
    for i, a in enumerate(words):
        for b in words:
            if one_edit(a, b) and (len(b) < len(a) or len(a) == len(b) and b > a):
                assert (i, b) in made


def test_chain_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(20)] + [("v", "w19")], "word string, form string")
    assert set(rows(variants.roots(forms))) == {(f"w{i}", "w20") for i in range(20)} | {("v", "w20")}

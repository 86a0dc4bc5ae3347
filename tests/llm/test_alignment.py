"""Cross-tokenizer alignment against the tokenizers themselves and a plain merge of ends."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from textlens.llm import alignment

ODD = [None, "", " ", "   ", "a", "don't  stop", "x\n\n y \t", "Grüße aus München", "a▁b", "日本語のテキスト と 한국어", "é́ \x00z",
       "<|endoftext|> is text, <s> too", "a　 b\x85 c\x1c d", "﻿bom", "1234567890 " * 30, "😀😃 smile", "no space" * 40]


@pytest.fixture(scope="module")
def plain():
    """text -> (A ids, B ids, A bytes, B bytes) by the files' own libraries."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    # byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)}
    names = {i: bytes(back[c] for c in w) for w, i in t.get_vocab(with_added_tokens=False).items() if all(c in back for c in w)}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def encode(text):
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        piece = lambda i: (bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                           else sp.id_to_piece(i).replace("▁", " ").encode())
        return a, b, [names[i] for i in a], [piece(i) for i in b]

    return encode


def brute(encode, docs):
    """Rows of the query by a walk over both token lists."""
    made, count = [], Counter()
    for d, text in docs:
        a, b, ta, tb = encode(text) if text else ([], [], [], [])
        if not text or b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            a = b = ta = tb = []
        ea, eb = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
        groups, links, i, j = [([], [])], [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ea[i], eb[j]
            if x <= y:
                groups[-1][0].append(a[i])
                i += 1
            if y <= x:
                groups[-1][1].append(b[j])
                j += 1
            if x == y:
                groups.append(([], []))
        groups.pop()
        made.append((d, a, b, groups, links))
        count.update(set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for d, a, b, groups, links in made:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_small_table_by_brute_force(spark, plain, monkeypatch):
    docs = [(i if i != 3 else None, t) for i, t in enumerate(ODD)] + [(5, ODD[5]), (5, ODD[5])]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n_a int, block string")
    assert rows(alignment.alignment_query(df)) == sorted(brute(plain, docs), key=str)
    assert alignment.alignment_query(df.limit(0)).collect() == []


def test_whole_table_by_brute_force(spark, plain):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute(plain, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows(alignment.alignment_query(docs)) == sorted(want, key=str)


def test_pieces_and_blocks_do_not_matter(plain):
    """A text cut into pieces, and documents in several blocks."""
    enc = alignment.Encoder(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    text = " ".join(t for t in ODD if t and "▁" not in t) * 5
    a, b, *_ = plain(text)
    segments = alignment.SEGMENT.findall(" " + text)
    assert "".join(segments) == " " + text
    whole = alignment.Piece(enc, [segments])
    cut = alignment.Piece(enc, [segments[:7], [], segments[7:]])
    for p in (whole, cut):
        assert p.ids[0].tolist() == a and p.ids[1].tolist() == b
        assert [x.tolist() for x in p.cuts] == [x.tolist() for x in whole.cuts]
    strings = alignment._strings(enc)
    assert b"".join(cut.text(enc, strings)) == whole.text(enc, strings)[0]
    assert cut.groups.sum() == whole.groups[0]


def test_long_text_as_several_parts(spark, plain, monkeypatch):
    text = " ".join(t for t in ODD if t and "▁" not in t) * 400
    docs = [(1, text), (2, "short"), (3, text + " a▁b")]
    assert len(text) > 200_000
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(brute(plain, docs), key=str)
    assert rows(alignment.alignment_query(df.coalesce(1))) == want
    parts = alignment.align_documents(df.where("doc_id < 3")).orderBy("doc_id", "part").collect()
    assert sum(([*r["a_ids"]] for r in parts if r["doc_id"] == 1), []) == plain(text)[0]


def test_aligned_arrays(spark, plain):
    r = alignment.align_documents(spark.createDataFrame([(1, "don't  stop")], "doc_id int, text string")).first()
    a, b, ta, tb = plain("don't  stop")
    assert (r["a_ids"], r["b_ids"], r["part"]) == (a, b, 0)
    ea, eb = np.cumsum([0] + [len(x) for x in ta]), np.cumsum([0] + [len(x) for x in tb])
    shared = sorted(set(ea.tolist()) & set(eb.tolist()) - {0})
    assert [int(ea[i]) for i in r["a_cuts"]] == shared == [int(eb[i]) for i in r["b_cuts"]]


def test_pair_table(spark, plain):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b a"), (3, None)], "doc_id long, text string")
    got = {(r["a_id"], r["b_id"]): (r["n"], r["best"]) for r in
           alignment.pair_counts(alignment.block_pairs(alignment.link_blocks(docs))).collect()}
    a, b, *_ = plain("a b")
    assert got[a[0], b[0]] == (2, True) and all(n == 2 for n, _ in got.values())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", " ", "  ", "a", "b", "the", "'s", "\n", "\t", "é", "日本", "\xa0", "\x1c", "1", "😀", "-", "　",
                                 "​", "Ä", "<s>", "\x85", "ing", "́", "\r\n"]), max_size=30))
def test_segments_encode_like_the_whole(plain, parts):
    text = "".join(parts)
    if not text:
        return
    enc = alignment.encoder(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    p = alignment.Piece(enc, [alignment.SEGMENT.findall(" " + text)])
    a, b, *_ = plain(text)
    if p.good[0]:
        assert p.ids[0].tolist() == a and p.ids[1].tolist() == b


def brute_cuts(ends_a, ends_b):
    return sorted(set(ends_a) & set(ends_b))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(0, 2**30)), min_size=1, max_size=5),
       st.integers(1, 16))
def test_cuts_by_brute_force(documents, probes):
    import random

    ends_a, ends_b, ba, bb, at = [], [], [0], [0], 0
    for sizes, seed in documents:
        total = sum(sizes)
        r = random.Random(seed)
        inner = sorted(r.sample(range(1, total), r.randrange(0, total))) if total > 1 else []
        ends_a += [at + x for x in np.cumsum(sizes).tolist()]
        ends_b += [at + x for x in inner + [total]]
        at += total
        ba.append(len(ends_a))
        bb.append(len(ends_b))
    before, alignment.PROBES = alignment.PROBES, probes
    try:
        ca, cb = alignment.shared_cuts(np.array(ends_a), np.array(ends_b), np.array(ba), np.array(bb))
    finally:
        alignment.PROBES = before
    assert [ends_a[i - 1] for i in ca] == brute_cuts(ends_a, ends_b) == [ends_b[i - 1] for i in cb]

"""Mixing, packing, revisits, the pipeline and the SQL of the queries."""

import importlib.util
import os
import sys
import zlib

import brute
import numpy as np
import pytest
from conftest import ROOT, SF_SMALL
from pyspark.sql import functions as F

from textlens.llm import mixing, packing, quality, revisits, simhash
from textlens.llm.queries import QUERIES, SQL

sys.path.insert(0, os.path.join(ROOT, "tools"))
spec = importlib.util.spec_from_file_location("check_oracle_llm", os.path.join(ROOT, "tools", "check_oracle.py"))
C = importlib.util.module_from_spec(spec)
spec.loader.exec_module(C)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF_SMALL)
    rel = C.duck(SF_SMALL).sql(SQL[name])
    assert C.compare(name, got.toPandas(), rel.df()) == "OK"
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert not C.type_mismatches(types, dict(zip(rel.columns, map(str, rel.types))))


# --- mixing
def targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in held]
        left = total - sum(3 * sizes[s] for s in held)
        share = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in held else weight[s] * share for s in order}
        held |= over


def mix_rows():
    rows = [(i, "w " * (1 + i % 9), f"s{i % 4}") for i in range(300)]
    rows += [(1000 + i, "tiny", "a-small") for i in range(3)] + [(2000, None, None), (2001, "x y\tz", None)]
    return rows + [(3000, "", "empty"), (3001, None, "empty"), (5, rows[5][1], "s1"), (5, rows[5][1], "s1"),
                   (None, "no id here", "s2"), (4000, "long " * 5000, "é")]


def test_mix_meets_its_targets(spark):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    out = mixing.plan_mix(docs).collect()
    again = mixing.plan_mix(docs.repartition(7)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(out, key=key) == sorted(again, key=key)
    sizes, taken = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.WORDS.findall(t or ""))
    want = targets(sizes)
    assert len(out) == len(rows)
    for r in out:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(taken[s] == int(want[s] + 1e-6) for s in want)


def test_mixed_documents_hold_the_taken_words(spark):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn(
        "n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    plan = {}
    for r in mixing.plan_mix(docs).collect():
        plan[r["source"]] = plan.get(r["source"], 0) + r["taken"]
    out = mixing.mix_documents(docs)
    assert out.dtypes == docs.dtypes
    got = {}
    for r in out.collect():
        n = len(brute.WORDS.findall(r["text"] or ""))
        got[r["source"]] = got.get(r["source"], 0) + n
        assert r["n_chars"] == len(r["text"] or "")
    assert {s: n for s, n in got.items() if n} == {s: n for s, n in plan.items() if n}
    assert mixing.mix_documents(docs.limit(0)).count() == 0 and mixing.plan_mix(docs.limit(0)).count() == 0


# --- packing
def check_pieces(rows, texts):
    from tokenizers import Tokenizer
    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = {d: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in texts.items()}
    per_doc, per_seq = {}, {}
    for r in rows:
        per_doc.setdefault(r["doc_id"], []).append(r)
        per_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(per_doc) == set(ids)
    for d, pieces in per_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[d]) and r["length"] > 0
            assert zlib.crc32(ids[d][at:at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids[d])
    padding = 0
    for pieces in per_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_packing_is_an_exact_cover(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    texts |= {9001: None, 9002: "", 9003: "a <|endoftext|> b", 9004: "long words " * 9000, 9005: " " * 5000, 9006: "é😀\x00"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    check_pieces(packing.pack_query(docs.repartition(3)).collect(), texts)
    assert packing.pack_query(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "same row")] * 3, "doc_id long, text string")
    assert sum(r["length"] for r in packing.pack_query(twice).collect()) == 3 * len(packing.encoder()("same row")) + 3


def test_both_tokenizer_libraries_agree():
    from tokenizers import Tokenizer
    import public_tokenizers

    slow, quick = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), packing.encoder()
    points = [c for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(points), 256):
        text = "".join(f"a{chr(c)}1 {chr(c)}b  {chr(c)}. " for c in points[i:i + 256])
        assert slow.encode(text, add_special_tokens=False).ids == quick(text).tolist()


def test_neighbours_by_bm25():
    rng = np.random.default_rng(1)
    topics = [rng.integers(100 * t, 100 * t + 60, size=(30, 200)) for t in range(6)]
    rests = [r.astype(np.uint32) for t in topics for r in t]
    order = rng.permutation(len(rests))
    rests = [rests[i] for i in order]
    topic = order // 30
    idf = np.ones(700)
    rows = packing.pack_shard([200] * len(rests), rests, idf, 200.0, window=1000)
    same = [len({topic[d] for d, _, _ in row}) for row in rows if sum(k for _, _, k in row) == 1000]
    assert np.mean(same) < 1.3
    cover = sorted((d, s + i) for row in rows for d, s, k in row for i in range(k))
    assert cover == [(d, i) for d in range(len(rests)) for i in range(200)]
    # scores equal the formula
    index = packing.Shard(rests, idf, 200.0)
    terms, tf = np.unique(rests[0], return_counts=True)
    weight = tf * 2.2 / (tf + 1.2)
    top = terms[np.lexsort((terms, -weight))][:16]
    other = rests[7]
    want = sum(f * 2.2 / (f + 1.2) for t in top if (f := int((other == t).sum())))
    assert index.scores(0)[7] == pytest.approx(want)


# --- revisits
REC = "record_id long, url string, captured_at long, status int, headers map<string,string>, payload_digest string"


def test_revisits(spark):
    etag = lambda x, **more: {"ETag": x, "Content-Type": "text/html", **more}
    rows = [
        (1, "http://www.A.org/x/", 10, 200, etag('"1"', **{"Cache-Control": "old"}), "d1"),
        (2, "https://a.org:443/x?utm_source=f", 20, 304, {"etag": 'W/"1"', "cache-control": "new", "content-type": "no"}, None),
        (3, "a.org/x#f", 30, 200, etag('"2"'), "d3"),
        (4, "http://a.org/x", 30, 304, {"etag": '"1"'}, None),        # same time as 3: 3 is not earlier
        (5, "http://a.org/x", 31, 304, {"etag": '"1"'}, None),
        (6, "http://a.org/y", 40, 304, {"etag": '"1"'}, None),
        (7, "http://a.org/x", 41, 304, None, "own"),
        (8, None, 50, 304, {}, None), (9, "http://a.org/x", None, 304, {"etag": '"2"'}, None),
        (10, "http://a.org/x", 60, 404, {}, "e"), (11, "http://a.org/x", None, None, None, None),
        (12, "http://a.org/x", 70, 304, {"etag": '"2"'}, None), (12, "http://a.org/x", 70, 304, {"etag": '"2"'}, None),
    ]
    out = revisits.resolve_revisits(spark.createDataFrame(rows, REC).withColumn("near", F.lit(1))).collect()
    assert len(out) == len(rows)
    got = {r["record_id"]: (r["outcome"], r["source_id"], r["payload_digest"]) for r in out}
    assert got == {1: ("full", 1, "d1"), 2: ("resolved", 1, "d1"), 3: ("full", 3, "d3"), 4: ("resolved", 1, "d1"),
                   5: ("changed", None, None), 6: ("missing", None, None), 7: ("unchecked", None, "own"),
                   8: ("missing", None, None), 9: ("missing", None, None), 10: ("other", None, "e"),
                   11: ("other", None, None), 12: ("resolved", 3, "d3")}
    merged = next(r["headers"] for r in out if r["record_id"] == 2)
    assert merged == {"etag": 'W/"1"', "content-type": "text/html", "cache-control": "new"}
    assert revisits.resolve_revisits(spark.createDataFrame([], REC)).count() == 0


def test_revisits_of_one_hot_url(spark):
    rows = [(i, "http://hot.org/", i // 2, 200 if i % 7 == 0 else 304, {"etag": '"e"'}, f"d{i}") for i in range(3000)]
    out = {r["record_id"]: r["source_id"] for r in
           revisits.resolve_revisits(spark.createDataFrame(rows, REC).repartition(9)).collect()}
    for i, _, at, status, _, _ in rows:
        full = [j for j in range(0, 3000, 7) if j // 2 < at]
        assert out[i] == (i if status == 200 else (full[-1] if full else None))


# --- pipeline
def test_pipeline_equals_its_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "redact_pii", "mix_sources", "pack"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    kept = {r["doc_id"] for r in quality.quality_query(docs).where("kept").collect()}
    fps = [(r["doc_id"], brute.simhash(r["text"])) for r in rows if r["doc_id"] in kept]
    single = {d for (d, _), c in zip(fps, brute.simhash_components(fps)) if d == c}
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SF_SMALL)
        assert step.columns == docs.columns
        ids = {r["doc_id"] for r in step.select("doc_id").collect()}
        if name == "quality_rules":
            assert ids == kept
        elif name in ("simhash_dedup", "redact_pii"):
            assert ids == single
        if name == "redact_pii":
            for r in step.collect():
                assert not any(brute.pii(r["text"])[0])
    total = sum(len(packing.encoder()(r["text"] or "")) + 1 for r in step.collect())
    out = corpus_pipeline.run(spark, SF_SMALL).agg(F.sum("length")).first()[0]
    assert out == total


def test_stages_take_an_empty_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_stages_take_extra_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs
    for c in ("size", "target", "taken", "fp", "component_id", "kept", "spans", "root", "k", "n"):
        extra = extra.withColumn(c, F.lit(c))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        extra = stage(spark, extra, SF_SMALL)
        assert {"size", "target", "taken", "fp", "component_id", "kept", "spans", "root", "k", "n"} <= set(extra.columns)
        assert extra.where("size <> 'size' OR taken <> 'taken' OR fp <> 'fp'").count() == 0


def test_simhash_default_matches_the_contract():
    assert (simhash.SHINGLE, simhash.RADIUS) == (3, 3)

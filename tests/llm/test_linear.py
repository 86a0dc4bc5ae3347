"""Work that grows with the input and no faster: redaction and one evaluation of the statistics."""

import random
import time

from pyspark.sql import functions as F

from textlens.llm import pii, quality


def test_running_sums_of_any_length(spark):
    for n in (0, 1, 2, 127, 128, 129, 1000, 20_000):
        values = [random.Random(n).randint(0, 9) for _ in range(n)]
        row = spark.createDataFrame([(values,)], "v array<int>").select(
            pii.running(F.col("v"), F.lit(0), lambda a, x: a + x).alias("sums"),
            pii.running(F.col("v"), F.lit(0), lambda a, x: F.greatest(a, x)).alias("tops")).first()
        sums, tops, total, top = [], [], 0, 0
        for v in values:
            sums.append(total)
            tops.append(top)
            total, top = total + v, max(top, v)
        assert row["sums"] == sums and row["tops"] == tops


def brute_redact(text, spans):
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{pii.KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 5)
    rnd = random.Random(9)
    rows = []
    for i in range(60):
        text = "".join(rnd.choice("ab \né\U0001f600") for _ in range(rnd.randint(0, 40)))
        spans = sorted((a, rnd.randint(0, 3), a + rnd.randint(1, 9)) for a in rnd.sample(range(len(text) + 1), min(len(text), 6)))
        spans = [(a, k, min(b, len(text))) for a, k, b in spans if a < len(text)]
        if spans:
            rows.append((i, text, spans))
    df = spark.createDataFrame(rows, "i int, text string, spans array<struct<start:int,kind:int,end:int>>")
    got = {r["i"]: r["new"] for r in df.select("i", pii.redact(F.col("text"), F.col("spans")).alias("new")).collect()}
    for i, text, spans in rows:
        assert got[i] == brute_redact(text, spans)


def test_32000_matches_in_one_text(spark):
    def seconds(n):
        text = " and ".join(f"write to user{i}@mail{i % 7}.com" for i in range(n))
        docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string").coalesce(1)
        t = time.time()
        out = {r["doc_id"]: r["text"] for r in pii.redact_documents(docs).collect()}
        assert out[1] == " and ".join(["write to [EMAIL]"] * n) and out[2] is None and out[3] == ""
        return time.time() - t

    seconds(100)
    few, many = seconds(8_000), seconds(32_000)
    assert many < 60 and many < 8 * few + 10  # four times the text


def test_statistics_occur_once_per_pass(spark, monkeypatch):
    """Neither pass of the quality stage computes the statistics twice: the
    plans name their symbol pattern once."""
    plans = []
    keep = quality.materialise

    def seen(df, tag):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, tag)

    monkeypatch.setattr(quality, "materialise", seen)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = quality.keep_good(docs)
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2
    for p in plans:
        assert p.count("split(cast") + p.count(quality.SYMBOLS) >= 1
        assert p.count(quality.SYMBOLS) == 1, p

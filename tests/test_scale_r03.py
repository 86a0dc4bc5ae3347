"""Findings of round 3: the queries on tables laid out or grown as at scale."""

import io
import json

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL, docs_df
from textlens.functions.html import walk_pages
from textlens.operators.postings import build_postings, document_postings
from textlens.operators.spelling import suggest
from textlens.plans.catalog import QUERIES, postings_table
from textlens.sources import index_json
from textlens.sources.index_io import write_bucketed
from textlens.sources.index_json import BLOCK, postings_in
from textlens.streaming.index import write_segment


def test_streams_read_tables_of_many_files(spark, tmp_path):
    """a table may be one file or a folder of parts."""
    for name in ("pages", "benchmark", "documents"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_pages", "stream_queries"):
        parts, one = (QUERIES[name](spark, d) for d in (str(tmp_path), SF_SMALL))
        assert one.count() > 0
        assert parts.exceptAll(one).count() == 0 and one.exceptAll(parts).count() == 0


def test_key_search_ends_with_its_range():
    """a range inside a long entry does not read on to the entry's end."""
    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            self.taken += len(got)
            return got

    pairs = [[i, [i, i + 1]] for i in range(400_000)]
    data = json.dumps({"index": {"long": pairs, "next": [["a]]]", [1]], ["b", []]]}}).encode()
    middle = Counting(data)
    assert list(postings_in(middle, len(data) // 2, len(data) // 2 + 1000)) == []
    assert middle.taken <= 2 * BLOCK < len(data) // 3
    cut = len(data) // 3
    got = [x for a in range(0, len(data), cut) for x in postings_in(io.BytesIO(data), a, min(a + cut, len(data)))]
    assert got == [("long", str(d), at) for d, at in pairs] + [("next", "a]]]", [1]), ("next", "b", [])]


def test_index_objects_grow_in_number(spark, tmp_path, monkeypatch):
    """more files for more postings; small ranges are merged."""
    monkeypatch.setattr(index_json, "FILE_ROWS", 10)
    p = spark.range(100).select(F.concat(F.lit("t"), F.col("id") % 7).alias("term"), F.col("id").alias("doc_id"),
                                F.array(F.lit(1), F.lit(5)).alias("positions"))
    out = str(tmp_path / "objects")
    index_json.write_index_objects(p, out, 2)
    assert len(list((tmp_path / "objects").glob("part-*"))) > 5
    monkeypatch.setattr(index_json, "RANGES", 4)
    assert len(index_json.IndexJsonReader({"path": out, "splitbytes": "10"}).partitions()) < 40
    back = index_json.read_index_objects(spark, out)
    assert sorted((r[0], int(r[1]), r[2]) for r in back.collect()) == sorted(map(tuple, p.collect()))


def test_segment_of_one_file_is_dealt_to_all_cores(spark, tmp_path):
    """a batch that is one file is worked on by all cores."""
    docs = docs_df(spark, [f"alpha beta number{i}" for i in range(500)]).coalesce(1)
    write_segment(docs, str(tmp_path), "000000000")
    parts = spark.read.parquet(f"{tmp_path}/documents/segment=000000000").inputFiles()
    assert len(parts) == spark.sparkContext.defaultParallelism


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path):
    """a bucket is no task's work alone."""
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(conf, "20k")
    try:
        t = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 2 == 0, "the").otherwise("of").alias("term"),
                                               F.col("id").alias("doc_id"))
        back = write_bucketed(t, str(tmp_path / "t"), "term", 2, ["doc_id"])
        assert len(back.inputFiles()) > 2
        assert back.count() == 40_000 and back.exceptAll(t).count() == 0
    finally:
        spark.conf.unset(conf)


ODD_TEXTS = ["Foo, -- foo's  bar BAR \x1c--- x", None, "", "  ...  ", "-- --abc-- ___ a_b_c \r\n 中文字 字",
             "naïve café ΣΑΣ İstanbul \U00010400abc \x00\x00 a\x00bcd ٣٤٥ ①②③ été"]


def test_postings_by_helper_equal_the_expression(spark):
    docs = docs_df(spark, ODD_TEXTS)
    for ascii_only in (False, True):
        e = docs.select("doc_id", F.explode(document_postings(F.col("text"), ascii_only)).alias("p"))
        want = e.select("p.term", "doc_id", "p.positions")
        got = build_postings(docs, ascii_only)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_postings_are_not_held_in_memory(spark):
    """No cached copy, which one task would read by whole
    blocks; what is read twice is stored in files."""
    made = postings_table(spark, SF_SMALL)
    assert not made.is_cached
    stored = postings_table(spark, SF_SMALL, stored=True)
    assert not stored.is_cached and stored.inputFiles() and stored.exceptAll(made).count() == 0


def test_unknown_words_are_compared_by_all_cores(spark):
    """few bytes, so they would be merged into one task."""
    words = spark.range(2000).select(F.concat(F.lit("word"), F.col("id") * 7919).alias("word"))
    known = words.select(F.concat("word", F.lit("x")).alias("word"))
    found = suggest(words, known)
    assert found.count() >= 2000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression [word" in plan
    distinct = plan.index("Aggregate [word")
    assert distinct < plan.index("levenshtein(")  # compared below the exchange of the pairs


def test_walked_pages_are_passed_on_in_small_parts():
    """a task holds few pages' results, however long its batches."""
    pages = pd.DataFrame({"page_id": range(1000), "url": "u", "html": "<h1>a</h1>"})
    parts = list(walk_pages([pages]))
    assert max(map(len, parts)) < 1000 and list(pd.concat(parts)["page_id"]) == list(range(1000))

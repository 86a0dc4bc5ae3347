"""Quality rules, PII, URL filter, language identification."""

import random
import zlib

import brute
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from textlens.llm import langid, pii, quality, urlfilter, votes

DOCS = "doc_id long, text string"


def frame(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], DOCS)


# --- weak supervision
def test_em_finds_the_bad_labeler(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(2000):
        y = rnd.random() < 0.6
        vote = lambda right: int(y) if rnd.random() < right else int(not y)
        rows.append((vote(0.95), vote(0.9), vote(0.55), vote(0.85) if rnd.random() < 0.5 else None))
    t = spark.createDataFrame(rows, "a int, b int, c int, d int").groupBy("a", "b", "c", "d").agg(
        F.count(F.lit(1)).alias("n"))
    m = votes.fit_votes(t, ["a", "b", "c", "d"])
    assert abs(m.prior - 0.6) < 0.06
    assert m.hit["a"] > 0.9 and m.miss["a"] < 0.12
    assert m.hit["c"] < 0.65


def test_em_of_an_empty_table_is_its_start(spark):
    t = spark.createDataFrame([], "a int, n long")
    m = votes.fit_votes(t, ["a"], prior=0.7)
    assert (m.prior, m.hit["a"], m.miss["a"]) == (0.7, 0.85, 0.15)


def test_logistic_recovers_a_threshold(spark):
    rows = spark.createDataFrame([(float(x), 10, 1.0 if x > 2 else 0.0) for x in range(-5, 10)],
                                 "x double, n long, y double")
    bias, slope = votes.fit_logistic(rows, ["x"], "n", "y")
    assert slope > 0 and 1.5 < -bias / slope < 3.5
    assert votes.fit_logistic(rows.limit(0), ["x"], "n", "y") == [0.0, 0.0]


# --- quality
EDGE = [None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e", "a b c d e a b c d e", "x " * 40, "é ü  ö",
        "l1 x\nl2 y\nl1 x\n\n\nl1 x", "# * $ % & | < > ok", "a b c d e f a b c d e g a b c d e"]


def test_quality_statistics_equal_brute_force(spark):
    rnd = random.Random(2)
    texts = EDGE + ["".join(rnd.choice(["a", "bb", "é", " ", " ", "\n", "\t", "#", "|", "b c d e f "])
                            for _ in range(rnd.randint(0, 150))) for _ in range(300)]
    texts += ["".join(rnd.choice("ab ") for _ in range(60_000))]
    docs = frame(spark, texts).withColumn("kept", F.lit("clash")).withColumn("__q", F.lit(1))
    for r in quality.quality_query(docs).collect():
        want = brute.quality(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want, texts[r["doc_id"]][:80]
        assert not (r["kept"] and r["base_failed"])


def test_quality_keeps_clean_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic = 0")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    good = quality.quality_query(docs).join(labels, "doc_id")
    n = {(r["quality"], r["kept"]): r["count"] for r in good.groupBy("quality", "kept").count().collect()}
    assert n[1, True] > 0.95 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] > 0.7 * (n[0, False] + n.get((0, True), 0))
    want = {r["doc_id"] for r in quality.quality_query(docs).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_quality_of_an_empty_table(spark):
    assert quality.quality_query(frame(spark, [])).count() == 0
    assert quality.keep_good(frame(spark, [])).count() == 0


# --- PII
PARTS = ["a@b.com", "x.y+z@q-r.co.uk", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
         "4111-1111-1111-1112", "+1 (724) 555-7058", "+49 30 1234567890", "12", "é", "\U0001f600", "@", ".", "..", "-",
         " ", "\n", "+", "(", "a", "_c@d.org", "%", "contact me at", "(212) 555-1212", "joe (at) example (dot) com",
         "0000255.1.1.1", "9" * 30, "+1" * 9, "tel ", "a@b.c@d.e", "99999999999.1.1.1"]


def pii_texts():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PARTS) + rnd.choice(["", " ", "", ","]) for _ in range(rnd.randint(0, 14)))
             for _ in range(400)]
    return texts + [None, "", "4 " * 30_000, "a." * 30_000 + "@", "+" + "1 " * 20_000, "a" * 100_000,
                    "a@b" + ".c" * 20_000, "1." * 2_000]


def test_pii_base_spans_equal_brute_force(spark):
    texts = pii_texts()
    docs = frame(spark, texts).repartition(4).withColumn("spans", F.lit(1)).withColumn("base", F.lit(2))
    for r in pii.pii_query(docs).collect():
        counts, digest, listed = brute.pii(texts[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == digest
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_pii_is_redacted_and_the_rest_stays(spark):
    texts = ["write to a@b.com or call +1 (724) 555-7058 now", "nothing here", None, "", "ip 1.2.3.4", "ip 1.2.3.4"]
    docs = frame(spark, texts).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    out = pii.redact_documents(docs)
    assert out.dtypes == docs.dtypes
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got[0] == ("write to [EMAIL] or call [PHONE] now", 36)
    assert got[1] == ("nothing here", 12) and got[2] == (None, 0) and got[3] == ("", 0)
    assert got[4] == got[5] == ("ip [IP]", 7)
    assert pii.redact_documents(docs.limit(0)).count() == 0
    assert pii.pii_query(frame(spark, [])).count() == 0


# --- URLs
def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def url_rule(host, path):
    best = None
    for verdict, h, p in urlfilter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[1]):
                best = (verdict, h + p)
    return best


URLS = ["http://a.net/x", "http://net/", "http://net", "http://planet/", "http://x.example.net/en/1?q#f",
        "https://EXAMPLE.com/de/9", "ftp://q.org/fr/", "http://q.org/fr", "nothing", "", None, "://a.net/",
        "http://a://b.net/", "http://h.org?x=/fr/", "http://h.org#/fr/", "http://ÄB.Org/fr/x", "http://a.net/x",
        "http://two\nlines.net/a\nb", "http://" + "a" * 30_000 + ".org/fr/"]


def test_url_rules_equal_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("x"))
    out = {r["page_id"]: r for r in urlfilter.url_query(pages).collect()}
    assert len(out) == len(URLS)
    for i, u in enumerate(URLS):
        assert (out[i]["host"], out[i]["path"]) == url_parts(u)
        rule = url_rule(*url_parts(u))
        assert out[i]["rule"] == (rule[1] if rule else None)
        assert out[i]["verdict"] == rule[0] if rule else out[i]["verdict"] in ("allow", "block")
    assert urlfilter.url_query(pages.limit(0)).count() == 0


def test_url_model_equals_plain_counts(spark):
    import math
    from collections import Counter, defaultdict

    rows = [("aab", 2, 0), ("abb", 1, 0), ("cab", 0, 1), ("ccc", 0, 3), ("abc", 0, 0)]
    got = {r["url"]: r["score"] for r in urlfilter.log_ratios(
        spark.createDataFrame(rows, "url string, good long, bad long"), 2).collect()}
    letters = {c for u, _, _ in rows for c in u} | {"\x03"}
    model = {}
    for side in (1, 2):
        seen = defaultdict(Counter)
        for row in rows:
            s = "\x02\x02" + row[0] + "\x03"
            for i in range(2, len(s)):
                for k in range(3):
                    if row[side]:
                        seen[s[i - k:i]][s[i]] += row[side]
        model[side] = seen
    for u, _, _ in rows:
        s, total = "\x02\x02" + u + "\x03", 0.0
        for i in range(2, len(s)):
            p = {}
            for side in (1, 2):
                q = 1 / len(letters)
                for k in range(3):
                    c = model[side].get(s[i - k:i])
                    if c:
                        q = (c[s[i]] + len(c) * q) / (sum(c.values()) + len(c))
                p[side] = q
            total += math.log(p[1]) - math.log(p[2])
        assert got[u] == pytest.approx(total / (len(u) + 1))


def test_url_grams_are_not_sent_through_the_driver(spark):
    """A stored table of URLs is small, its n-grams are many times its size."""
    urls = spark.range(300).selectExpr("concat('http://a', id, '.org/fr/', id) AS url", "id % 3 AS good", "1L AS bad")
    scores = urlfilter.log_ratios(urlfilter.materialise(urls, "test-urls"))
    assert len(scores.collect()) == 300
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    judged = urlfilter.filter_urls(pages)
    assert len(judged.collect()) == len(URLS)
    for df in (scores, judged):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_url_model_generalises(spark):
    good = [f"http://site{i}.library.example/books/{i}" for i in range(200)]
    bad = [f"http://casino{i}.spam.example/win-{i}-now" for i in range(200)]
    rules = [("allow", f"site{i}.library.example", "/") for i in range(0, 200, 2)]
    rules += [("block", f"casino{i}.spam.example", "/") for i in range(0, 200, 2)]
    pages = spark.createDataFrame(list(enumerate(good + bad)), "page_id long, url string")
    out = urlfilter.filter_urls(pages, rules).where("rule IS NULL").collect()
    assert len(out) == 200
    assert sum((r["verdict"] == "allow") == (r["page_id"] < 200) for r in out) >= 196


# --- language
def test_language_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.langid_query(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_edges(spark):
    train = [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 40)]
    odd = [(100, None, "en"), (101, "", None), (102, "12 !? 34", "de"), (103, "the dog", None), (103, "the dog", None),
           (104, "und " * 100_000, None), (None, "die katze", None)]
    docs = spark.createDataFrame(train + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    out = langid.langid_query(docs).collect()
    assert len(out) == 87
    got = {r["doc_id"]: r["lang_pred"] for r in out}
    assert [got[k] for k in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "en", "de", "de"]
    none = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in langid.langid_query(none).collect()] == [("und", 0.0)]
    assert langid.langid_query(none.limit(0)).count() == 0


def test_gram_pieces_do_not_depend_on_the_chunk(monkeypatch):
    import numpy as np

    text = "Some Text, with ünïcode and spaces " * 7
    whole = np.sort(np.concatenate(list(langid._grams(text))))
    monkeypatch.setattr(langid, "CHUNK", 10)
    assert np.array_equal(np.sort(np.concatenate(list(langid._grams(text)))), whole)


def test_queries_read_small_tables(spark):
    from textlens.llm.queries import QUERIES

    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op1_pii_spans", "op4_quality_rules", "op8_language_id"):
        assert QUERIES[name](spark, SF_SMALL).count() == n

"""URL filter: host rules first, else the ratio of two character models.

Rules accept or reject hosts and paths; the longest fitting rule decides.  The
URLs that a rule decides also train two variable-order Markov models over
characters, one of accepted and one of rejected URLs, smoothed by interpolating
every order with the next shorter one (Witten-Bell).  The difference of their
log-likelihoods per character is calibrated on URLs held back from training
and decides on the rest.  DataFrame functions only: n-gram counts are
aggregations, scoring is two equi-joins on n-grams.  All joins are sort-merge
joins by hint: Spark takes the n-grams of a table for no larger than the
table's files, and would send them through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import let, materialise
from textlens.llm.votes import fit_logistic

#: Fixed by the contract: verdict, host and path of each rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Longest context of the models, in characters.
ORDER = 4
#: Every so-maniest trained URL calibrates instead of training.
HELD_BACK = 5
#: Scores are counted in steps of this size for the calibration.
BIN = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\x02", "\x03"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)\z", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*+", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*+([^?#]*+)", 1)
    return host, path


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits the host or a
    domain above it and whose path starts the URL's; null if none fits."""
    table = F.array(*(F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(v).alias("verdict"),
                               F.lit(h + p).alias("rule"), F.lit("." + h).alias("host"), F.lit(p).alias("path"))
                      for v, h, p in rules))
    dotted = F.concat(F.lit("."), host)
    fits = F.filter(table, lambda r: dotted.endswith(r["host"]) & path.startswith(r["path"]))
    return let(F.array_max(fits), lambda r: F.when(r.isNotNull(), F.struct(
        r["verdict"].alias("verdict"), r["rule"].alias("rule"))))


def _grams(url: Column, order: int = ORDER) -> Column:
    """All (order + 1)-grams of the marked URL, one per character and end."""
    marked = F.concat(F.lit(_START * order), url, F.lit(_END))
    return let(marked, lambda m: F.transform(
        F.sequence(F.lit(1), F.length(m) - order), lambda i: F.substring(m, i, F.lit(order + 1))))


def log_ratios(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``urls(url, good, bad)``, different URLs with how many accepted and
    rejected rows each stands for in training (both 0: only scored) ->
    ``url, score``: log P(accepted) - log P(rejected) per character."""
    grams = urls.select("url", "good", "bad", F.explode(_grams(F.col("url"), order)).alias("gram"))
    full = materialise(grams.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "url-grams")
    # each gram stands for its suffixes: one row per order, context and letter
    parts = full.select("gram", "good", "bad", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k"))
    parts = parts.withColumn("seen", F.right("gram", F.col("k") + 1)).withColumn(
        "context", F.expr("substring(seen, 1, k)"))
    seen = parts.groupBy("k", "context", "seen").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    seen = materialise(seen, "url-seen")
    contexts = seen.groupBy("context", "k").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
        F.count(F.when(F.col("good") > 0, 1)).alias("t_good"), F.count(F.when(F.col("bad") > 0, 1)).alias("t_bad"))
    # written, so that the join reads plain exchanges and short contexts, which
    # are hot, are split
    contexts = materialise(contexts, "url-contexts")
    rated = (parts.select("gram", "k", "seen", "context").join(seen.drop("context").hint("merge"), ["k", "seen"])
             .join(contexts.hint("merge"), ["k", "context"]))
    letters = F.lit(float(max(seen.where("k = 0").count(), 1)))  # letters of an alphabet
    steps = F.sort_array(F.collect_list(F.struct(
        "k", "good", "bad", "n_good", "n_bad", "t_good", "t_bad")))

    def chain(rows: Column, c: str) -> Column:
        return F.aggregate(rows, 1.0 / letters, lambda p, r: F.when(
            r["n_" + c] > 0, (r[c] + r["t_" + c] * p) / (r["n_" + c] + r["t_" + c])).otherwise(p))

    scored = rated.groupBy("gram").agg(steps.alias("steps")).select(
        "gram", (F.log(chain(F.col("steps"), "good")) - F.log(chain(F.col("steps"), "bad"))).alias("d"))
    return grams.select("url", "gram").join(scored.hint("merge"), "gram").groupBy("url").agg(
        (F.sum("d") / F.count(F.lit(1))).alias("score"))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages(page_id, url)`` -> page_id, host, path, rule, score, p_allow,
    verdict, one row per row.

    A null url is an empty one without host and path; no rule with a host fits
    it, so the model judges it.  If only one verdict occurs in training, or
    none, the model allows.  An empty table gives no rows."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host, path = split_url(F.col("u"))
    judged = (pages.select("page_id", url.alias("u")).withColumn("host", host).withColumn("path", path)
              .withColumn("r", longest_rule(F.col("host"), F.col("path"), rules)))
    back = F.pmod(F.xxhash64("url"), F.lit(HELD_BACK)) == 0
    counts = judged.groupBy(F.col("u").alias("url")).agg(
        F.count(F.when(F.col("r.verdict") == "allow", 1)).alias("allow"),
        F.count(F.when(F.col("r.verdict") == "block", 1)).alias("block"))
    counts = materialise(counts.withColumn("back", back & (F.col("allow") + F.col("block") > 0)), "url-counts")
    ratios = materialise(log_ratios(counts.select(
        "url", F.when(~F.col("back"), F.col("allow")).otherwise(0).alias("good"),
        F.when(~F.col("back"), F.col("block")).otherwise(0).alias("bad"))), "url-scores")
    total = counts.agg(*(F.sum(F.when(F.col("back") == b, F.col(c))).alias(f"{c}_{b}") for b in (True, False)
                         for c in ("allow", "block"))).first()
    both = all(total[f"{c}_False"] for c in ("allow", "block"))
    slope, bias = 1.0, 0.0
    if both and all(total[f"{c}_True"] for c in ("allow", "block")):
        # at most one row per step and verdict
        held = counts.where("back").join(ratios.hint("merge"), "url").select(
            (F.round(F.greatest(F.least("score", F.lit(20.0)), F.lit(-20.0)) / BIN) * BIN).alias("x"), "allow", "block")
        bins = held.groupBy("x").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        # both verdicts weigh the same, however many URLs each has
        even = (total["allow_True"] + total["block_True"]) / 2.0
        w = (F.col("allow") / total["allow_True"] + F.col("block") / total["block_True"]) * even
        rows = materialise(bins.select(
            "x", w.alias("w"), (F.col("allow") / total["allow_True"] * even / w).alias("p")), "url-bins")
        bias, slope = fit_logistic(rows, ["x"], "w", "p")
    allowed = 1 / (1 + F.exp(-(F.col("score") * slope + bias))) if both else F.lit(1.0)
    scored = judged.join(ratios.hint("merge"), F.col("u") == F.col("url"), "left").withColumn("p_allow", allowed)
    return scored.select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), "score", "p_allow",
        F.coalesce("r.verdict", F.when(F.col("p_allow") >= 0.5, "allow").otherwise("block")).alias("verdict"))


def url_query(pages: DataFrame) -> DataFrame:
    """Verdicts of ``filter_urls``, one row per row of ``pages``; see there for
    null URLs, repeated rows and empty tables."""
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")

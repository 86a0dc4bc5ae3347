"""Quality rules as weak supervision.

Each rule votes good (1), bad (0) or abstains; expectation-maximisation over
the counts of vote patterns estimates the rules' accuracies, and a document is
kept if its posterior probability of being good reaches the threshold.  Only
DataFrame functions: a text's statistics are computed inside its row, nothing
but pattern counts is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import WORD, let, materialise, words
from textlens.llm.votes import LabelModel, fit_votes

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
THRESHOLD = 0.5
#: Prior probability that a document is good; the corpus moves it.
PRIOR = 0.9
#: First guess of P(vote good | good) and P(vote good | bad): a bad text mostly
#: offends one rule and passes the others.
START, MOST_MISS = (0.95, 0.5), 0.97
#: Rules: feature, low, high, which side is bad.  A value beyond ``bad`` votes
#: bad, one within ``good`` votes good, between them the rule abstains.
RULES: dict[str, tuple[str, float, float, str]] = {
    "length": ("n_words", 15, 40, "low"),
    "short_words": ("mean_word", 2.5, 3.5, "low"),
    "long_words": ("mean_word", 9.0, 15.0, "high"),
    "symbols": ("symbol_share", 0.02, 0.1, "high"),
    "letters": ("letter_share", 0.75, 0.88, "low"),
    "dup_lines": ("dup_line_share", 0.1, 0.3, "high"),
    "repeats": ("repeat_share", 0.05, 0.2, "high"),
    "variety": ("distinct_share", 0.2, 0.4, "low"),
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_other",
         "n_lines", "n_distinct", "n_chars")


def _pieces(text: Column, pattern: str) -> Column:
    """Number of matches of a one-character pattern."""
    return (F.size(F.split(text, pattern)) - 1).cast("long")


def repeated_words(ws: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found twice or more in the same text.

    Windows are compared by 64-bit hash.  Texts whose windows are all
    different (most) are done after the hashes' distinct count; else windows
    are sorted by (hash, position), those with an equal neighbour keep their
    position, and each position in order covers what the next leaves."""

    def of(hashes: Column) -> Column:
        def covered(s: Column) -> Column:
            at = F.array_sort(F.transform(F.filter(
                F.transform(s, lambda x, i: F.struct(
                    ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])
                     | (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))).alias("twice"), x["i"].alias("i"))),
                lambda x: x["twice"]), lambda x: x["i"]))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(
                    F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window)))),
                F.lit(0).cast("long"), lambda acc, x: acc + x))

        twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(twice, let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(
            h.alias("h"), i.alias("i")))), covered)).otherwise(F.lit(0).cast("long"))

    def windows(w: Column) -> Column:
        hashed = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, window))))
        return F.when(F.size(w) > window, F.slice(hashed, F.lit(1), F.size(w) - (window - 1))).otherwise(
            F.array().cast("array<bigint>"))

    return let(ws, lambda w: let(windows(w), of))


def statistics(text: Column) -> Column:
    """Struct of a text's statistics, computed once per row."""
    t = F.coalesce(text.cast("string"), F.lit(""))

    def stats(ws: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        return let(lines, lambda ls: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            _pieces(t, SYMBOLS).alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(ws).alias("n_repeat_words"),
            _pieces(t, r"[^\p{L}\x20\x09-\x0D]").alias("n_other"),
            F.size(ls).cast("long").alias("n_lines"),
            F.size(F.array_distinct(ws)).cast("long").alias("n_distinct"),
            F.length(t).cast("long").alias("n_chars")))

    return let(words(text.cast("string")), stats)


def votes(q: Column) -> dict[str, Column]:
    """The rules' votes on a statistics struct."""
    n = F.greatest(q["n_words"], F.lit(1)).cast("double")
    value = {
        "n_words": q["n_words"].cast("double"), "mean_word": q["word_chars"] / n, "symbol_share": q["n_symbols"] / n,
        "letter_share": 1 - q["n_other"] / F.greatest(q["word_chars"], F.lit(1)),
        "dup_line_share": q["n_dup_lines"] / F.greatest(q["n_lines"], F.lit(1)),
        "repeat_share": q["n_repeat_words"] / n, "distinct_share": q["n_distinct"] / n}
    out = {}
    for name, (feature, low, high, bad) in RULES.items():
        v = value[feature]
        yes, no = (v >= high, v < low) if bad == "low" else (v <= low, v > high)
        out[name] = F.when(yes, 1).when(no, 0).cast("int")
    # a long text has a smaller share of different words in any language
    out["variety"] = F.when((q["n_words"] > 400) & (out["variety"] == 0), F.lit(None)).otherwise(out["variety"])
    return out


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])


def fit_quality(patterns: DataFrame) -> LabelModel:
    """Label model of a table with one row's votes in the struct ``__v``
    (null for rows that the base rules reject, which say nothing about it)."""
    counted = patterns.where("__v IS NOT NULL").groupBy(*(F.col("__v")[k].alias(k) for k in RULES)).agg(F.count(F.lit(1)).alias("n"))
    return fit_votes(materialise(counted, "quality-patterns"), list(RULES), prior=PRIOR, start=START,
                     most_miss=MOST_MISS)


def _vote_struct(q: Column) -> Column:
    return F.when(~base_failed(q), F.struct(*(v.alias(k) for k, v in votes(q).items())))


def quality_rules(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, the statistics, base_failed, p_good,
    kept.  Null text: no words, hence base_failed.  Repeated rows are judged
    each; an empty table gives no rows."""
    stats = materialise(docs.select("doc_id", statistics(F.col("text")).alias("__q")), "quality-stats")
    q = F.col("__q")
    model = fit_quality(stats.select(_vote_struct(q).alias("__v")))
    return (stats.withColumn("base_failed", base_failed(q)).withColumn("p_good", model.posterior(votes(q)))
            .select("doc_id", *(q[c].alias(c) for c in STATS), "base_failed", "p_good",
                    (~F.col("base_failed") & (F.col("p_good") >= threshold)).alias("kept")))


def _vote_code(q: Column) -> Column:
    """The votes as one number, a digit 0, 1 or 2 (abstains) per rule; -1 for
    texts that the base rules reject."""
    code = sum((F.coalesce(v, F.lit(2)) * 3 ** i for i, v in enumerate(votes(q).values())), F.lit(0))
    return F.when(base_failed(q), -1).otherwise(code)


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are; rows
    with a null or empty text fall, repeated rows are judged alike, an empty
    table gives no rows.

    Texts are read twice (model, filter) rather than shuffled or stored.  The
    first pass has no filter, which would be evaluated below the statistics
    and compute them again: rejected texts get a code of their own."""
    of = statistics(F.col("text"))
    counted = docs.select(let(of, _vote_code).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    counted = materialise(counted, "quality-codes").where("code >= 0")
    digits = {k: F.floor(F.col("code") / 3 ** i) % 3 for i, k in enumerate(RULES)}
    patterns = counted.select("n", *(F.when(d < 2, d).cast("int").alias(k) for k, d in digits.items()))
    model = fit_votes(patterns, list(RULES), prior=PRIOR, start=START, most_miss=MOST_MISS)
    return docs.where(let(of, lambda q: ~base_failed(q) & (model.posterior(votes(q)) >= threshold)))


def quality_query(docs: DataFrame) -> DataFrame:
    """Statistics and verdicts of ``quality_rules``, one row per row of ``docs``."""
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

"""Mixing sources to target weights.

Every document gets a hash-random key; documents are ordered by that key
within their source by splitting the key space into equal ranges (the keys are
uniform, so ranges are even without sampling), running sums within a range and
prefix sums of the ranges' totals before it.  A source's budget is cut exactly:
whole epochs first, then the documents whose running sum fits, then a part of
the one document at the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlens.llm.common import WORD, global_rank, materialise, word_count

#: Fixed by the operator's contract: source weights repeat 1, 2, 3 in code
#: point order of the names; no target is above three times its source.
CYCLE = 3
MOST_EPOCHS = 3
#: Key ranges a source is split into; a range of the largest source is what
#: one task sorts at least.
RANGES = 4096
SEED = "mix-1"


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes(source, source_size)`` -> the same with ``weight`` and
    ``target``.

    The budget is the sum of all sizes.  Targets share it by weight; one above
    MOST_EPOCHS times its source's size stops there and the excess is shared
    again, until none is above (at most one round per source that is stopped,
    each an aggregation of a few numbers)."""
    ranked = materialise(
        global_rank(sizes, ["source"], "rank", "mix-sources")
        .withColumn("weight", (F.col("rank") % CYCLE + 1).cast("double"))
        .withColumn("cap", F.col("source_size") * float(MOST_EPOCHS)).drop("rank"), "mix-weights")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    share, stopped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(share) > F.col("cap")
        s = ranked.agg(F.sum(F.when(over, F.col("cap"))).alias("held"),
                       F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free"),
                       F.count(F.when(over, 1)).alias("n")).first()
        if s["n"] == stopped or not s["free"]:
            break
        stopped = s["n"]
        share = (total - (s["held"] or 0.0)) / s["free"]
    return ranked.withColumn("target", F.least("cap", F.col("weight") * F.lit(share))).drop("cap")


def plan_mix(docs: DataFrame, seed: str = SEED, size: Column | None = None,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """``docs(doc_id, text, source)`` -> one row per document: ``doc_id, size,
    source, source_size, target, taken`` and the columns named in ``carry``.

    ``size`` defaults to the number of words of the text (null text: 0).
    ``taken`` counts the words that the mix takes from the document, repeats
    included.  A null source is a source of its own, last in order.  Rows
    with the same doc_id are documents of their own; equal ones are
    interchangeable.  An empty table gives no rows."""
    size = word_count(F.col("text")) if size is None else size
    d = docs.select("doc_id", "source", size.alias("size"), *carry)
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    width = 2 ** 32 // RANGES
    d = (d.withColumn("__src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))  # null: a key of its own
         .withColumn("__key", key)
         .withColumn("__range", F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") / width).cast("int")))
    if not carry:
        d = materialise(d, "mix-docs")  # small rows; with texts along, sizes are counted again instead

    ranges = d.groupBy("__src", "source", "__range").agg(F.sum("size").alias("__sum"))
    ranges = materialise(ranges, "mix-ranges")
    sums = ranges.groupBy("__src", "source").agg(F.sum("__sum").alias("source_size"))
    targets = source_targets(sums).select("__src", "source_size", "target")
    before = Window.partitionBy("__src").orderBy("__range")
    starts = (ranges.withColumn("__before", F.sum("__sum").over(before) - F.col("__sum"))
              .select("__src", "__range", "__before").join(targets, "__src"))
    run = (Window.partitionBy("__src", "__range").orderBy("__key", "doc_id", "size")
           .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__here", F.coalesce(F.sum("size").over(run), F.lit(0)))
    d = d.join(starts, ["__src", "__range"])

    budget = F.floor(F.col("target") + F.lit(1e-6)).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("long")).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("__before") + F.col("__here"))))
    return d.select("doc_id", "size", "source", "source_size", "target",
                    (whole * F.col("size") + part).cast("long").alias("taken"), *carry)


def mix_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each document as often
    as the mix repeats it, the one at a source's cut shortened to the words
    taken (``n_chars``, where there is one, follows the text).  A document of
    no words is kept once if its source has no words at all, else dropped."""
    names = docs.columns
    columns = [c for c in names if c not in ("doc_id", "source")]
    d = docs.select(*names, F.struct(*columns).alias("__rest")) if columns else docs
    plan = plan_mix(d, seed, carry=("__rest",))
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(
        F.when(F.col("source_size") == 0, 1).otherwise(0)).cast("int")
    out = plan.withColumn("__copies", copies).where("__copies > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    left = F.least(F.col("size"), F.col("taken") - (F.col("__copy") - 1) * F.col("size"))
    text = F.col("__rest.text")
    # the first words, with what stands before each; possessive, so that the
    # engine keeps no state per word
    first = F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){0,"), left.cast("string"), F.lit("}+"))
    cut = F.coalesce(F.regexp_substr(text, first), F.lit(""))
    out = out.withColumn("__text", F.when(left < F.col("size"), cut).otherwise(text))

    def column(c: str) -> Column:
        if c in ("doc_id", "source"):
            return F.col(c)
        if c == "text":
            return F.col("__text").alias("text")
        if c == "n_chars":
            return F.when(left < F.col("size"), F.length("__text")).otherwise(
                F.col("__rest.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
        return F.col("__rest")[c].alias(c)

    return out.select(*[column(c) for c in names])


def mix_query(docs: DataFrame) -> DataFrame:
    """The plan of ``plan_mix``, one row per row of ``docs``; see there for
    nulls, ties and empty tables."""
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CAST(3 * source_size AS DOUBLE) AS cap, (SELECT sum(source_size) FROM s) AS total,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s),
o AS (SELECT *, cap / weight AS ratio,
             total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
      FROM w),
x AS (SELECT coalesce(min_by(room / free, ratio) FILTER (WHERE room / free <= ratio), 0) AS share FROM o),
t AS (SELECT source, source_size, least(cap, weight * (SELECT share FROM x)) AS target FROM w),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CAST(floor(t.target + 1e-6) AS BIGINT) AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) END AS BIGINT) AS taken
FROM r
"""

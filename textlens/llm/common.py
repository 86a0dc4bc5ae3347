"""Helpers shared by the corpus-preparation operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlens.session import checkpoint_dir

#: A word is a longest run of characters that are none of space, tab, line
#: feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def materialise(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below the cluster's checkpoint folder and read
    it back.  Cuts the lineage in storage that all executors share, so a lost
    executor costs a re-read and never a re-computation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    ``body`` uses it (also inside the lambdas of higher-order functions)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def word_count(text: Column) -> Column:
    """Number of words, without building them where a piece count will do."""
    t = F.coalesce(text, F.lit(""))
    edge = (F.when(t.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
            + F.when(t.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0))
    blank = F.length(F.regexp_replace(t, r"^[\x20\x09-\x0D]+", "")) == 0
    return F.when(blank, F.lit(0)).otherwise(F.size(F.split(t, BLANKS)) - edge).cast("long")


def global_rank(df: DataFrame, keys: Sequence[str], out: str, tag: str) -> DataFrame:
    """Add the 0-based rank of each row in the order of ``keys`` (nulls last,
    strings by code point) without sorting all rows in one task: rows are
    range-partitioned, ranked within their partition, and shifted by the
    counts of the partitions before (one row per partition)."""
    order = [F.col(k).asc_nulls_last() for k in keys]
    dealt = materialise(
        df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), tag)
    before = (
        dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before")))
    within = Window.partitionBy("__part").orderBy(*order)
    return (
        dealt.withColumn("__row", F.row_number().over(within))
        .join(F.broadcast(before), "__part")  # one row per shuffle partition
        .withColumn(out, F.col("__before") + F.col("__row") - 1)
        .drop("__part", "__row", "__before"))


def connected_components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """Components of an undirected graph: ``edges(src, dst)`` -> one row
    ``(node, root)`` per node that has an edge to another node; ``root`` is
    the smallest node of its component.

    Alternates the large-star and small-star steps, each an aggregation (with
    map-side combine) and an equi-join whose hot keys AQE splits.  Every round
    is written to the checkpoint folder; the loop ends when a round changes
    nothing, so no case is cut off.  Self-loops and rows with a null end are
    ignored.
    """
    a, b = F.col("src"), F.col("dst")
    e = (edges.where((a != b) & a.isNotNull() & b.isNotNull())
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = materialise(e, tag)
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (state["n"], state["h"]) == seen or state["n"] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = (state["n"], state["h"])
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = (both.join(low, "u").where(F.col("v") > F.col("u"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        hung = star.join(low, "u")
        star = (hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(star, tag)

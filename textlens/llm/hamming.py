"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code is cut into m segments, and every different code is entered under
each of its segment values.  A query probes the values within a segment radius
that grows by one per round.  After radius r, a code that no segment met is at
least r + 1 away in all of them, hence m (r + 1) in all; a query is done once
it has k verified codes within m (r + 1) - 1.  From the first k codes on, the
k-th distance bounds what a probe may return.  Rows with equal codes are one
entry, of which the k smallest ids can matter.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlens.llm.common import materialise

BITS = 64
K = 10
#: Bounds of a segment's width in bits.
NARROW, WIDE = 8, 20


def cuts(codes: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments: about log2(codes) - 4 bits each, so
    that a bucket holds some tens of codes however many there are."""
    width = min(max(round(math.log2(max(codes, 2))) - 4, NARROW), WIDE)
    m = -(-BITS // width)
    size = [BITS // m + (i < BITS % m) for i in range(m)]
    return [(sum(size[:i]), size[i]) for i in range(m)]


def sign_code(vector: Column) -> Column:
    """64 bits, bit i set if component i is above zero; null for a null
    vector.  Missing components count as not above zero."""
    code = F.lit(0).cast("long")
    for i in range(BITS):
        bit = 1 << i
        code = code.bitwiseOR(F.when(F.get(vector, F.lit(i)) > 0, F.lit(bit - (1 << 64) if i == 63 else bit))
                              .otherwise(F.lit(0)).cast("long"))
    return F.when(vector.isNotNull(), code)


def segment(code: Column, cut: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(code, cut[0]).bitwiseAND(F.lit((1 << cut[1]) - 1)).cast("int")


def _masks(width: int, radius: int) -> Column:
    """All values of ``width`` bits with ``radius`` bits set."""
    if math.comb(width, radius) <= 1000:
        return F.array(*(F.lit(sum(1 << b for b in bits)) for bits in combinations(range(width), radius)))
    return F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda x: F.bit_count(x) == radius)


def top_k(queries: DataFrame, rows: DataFrame, k: int = K) -> DataFrame:
    """``queries(query_id, code)``, ``rows(id, code)`` -> ``query_id, rank,
    id, distance``: per query the k nearest rows by Hamming distance, ties by
    id; all rows if there are fewer.

    Rows without a code or id are no answers, queries without a code have
    none.  Queries that repeat an id are answered once per different code;
    repeated rows are answers each.  Empty tables give no rows."""
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = rows.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code")
    # of equal codes only the k smallest ids can be among the k nearest
    best = Window.partitionBy("code").orderBy("id")
    members = materialise(rows.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k), "mih-members")
    codes = materialise(members.groupBy("code").agg(F.count(F.lit(1)).alias("n")), "mih-codes")
    size = codes.agg(F.count(F.lit(1)).alias("codes"), F.sum("n").alias("rows")).first()
    enough = min(k, size["rows"] or 0)
    parts = cuts(size["codes"])
    m = len(parts)
    index = materialise(codes.select("code", "n", F.explode(F.array(*(
        F.struct(F.lit(s).alias("s"), segment(F.col("code"), cut).alias("v")) for s, cut in enumerate(parts))))
        .alias("e")).select("code", "n", "e.s", "e.v"), "mih-index")
    asked = materialise(queries.where("query_id IS NOT NULL AND code IS NOT NULL")
                        .select("query_id", F.col("code").alias("q")).distinct(), "mih-queries")
    # equal query codes share one search
    open_ = asked.select("q", F.lit(BITS).alias("bound")).distinct()
    found = answers = None
    for radius in range(max(w for _, w in parts) + 1):
        probes = open_.select("q", "bound", F.explode(F.array(*(F.struct(
            F.lit(s).alias("s"), segment(F.col("q"), cut).alias("qv"),
            _masks(cut[1], radius).alias("masks")) for s, cut in enumerate(parts) if radius <= cut[1]))).alias("p"))
        probes = probes.select("q", "bound", "p.s", "p.qv", F.explode("p.masks").alias("mask")).select(
            "q", "bound", "s", F.col("qv").bitwiseXOR(F.col("mask")).alias("v"))
        both = F.col("q").bitwiseXOR(F.col("code"))
        away = [F.bit_count(segment(both, cut)) for cut in parts]
        # a pair is taken once: in the round of its nearest segment, by the first of those
        first = F.coalesce(*(F.when(a == radius, F.lit(s)) for s, a in enumerate(away)))
        i = index.withColumnsRenamed({"s": "s2", "v": "v2"})
        # how many rows probes make is not known to the planner: never broadcast them
        met = probes.hint("merge").join(i, (F.col("s") == F.col("s2")) & (F.col("v") == F.col("v2"))
                                        & (F.bit_count(both) <= F.col("bound")) & (F.least(*away) == radius)
                                        & (first == F.col("s")))
        new = met.select("q", "code", "n", F.bit_count(both).alias("distance"))
        pool = new if found is None else found.join(open_.select("q"), "q", "left_semi").unionByName(new)
        # codes that k rows at smaller distances already precede are of no use
        run = Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
        found = materialise(pool.withColumn("ahead", F.coalesce(F.sum("n").over(run), F.lit(0)))
                            .where(F.col("ahead") < k).drop("ahead"), "mih-found")
        sure = m * (radius + 1) - 1
        state = found.groupBy("q").agg(
            F.sum("n").alias("have"), F.max("distance").alias("far"),
            F.coalesce(F.sum(F.when(F.col("distance") <= sure, F.col("n"))), F.lit(0)).alias("verified"))
        state = open_.select("q").join(state, "q", "left")
        still = materialise(state.where(F.coalesce("verified", F.lit(0)) < enough).select(
            "q", F.when(F.col("have") >= k, F.col("far")).otherwise(F.lit(BITS)).alias("bound")), "mih-open")
        closed = found.join(still, "q", "left_anti")
        answers = closed if answers is None else answers.unionByName(closed)
        open_ = still
        if still.isEmpty():
            break
    near = answers.join(members.drop("r"), "code")
    out = near.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", "id")))
    return asked.join(out.where(F.col("rank") <= k), "q").select("query_id", "rank", "id", "distance")


def hamming_query(embeddings: DataFrame) -> DataFrame:
    """Queries are the rows whose id is divisible by 100, against all rows."""
    coded = materialise(embeddings.select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code")),
                        "mih-codes")
    queries = coded.where(F.col("id") % 100 == 0).select(F.col("id").alias("query_id"), "code")
    return top_k(queries, coded).select(
        "query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("vec_id"),
        F.col("distance").cast("long").alias("distance"))


_BIT = ", ".join(f"CASE WHEN embedding[{i + 1}] > 0 THEN 1::UBIGINT << {i} ELSE 0::UBIGINT END"
                 for i in range(BITS))
SQL = f"""
WITH c AS (SELECT vec_id, list_sum([{_BIT}])::UBIGINT AS code FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(bit_count(xor(q.code, r.code)::UBIGINT::BIT) AS BIGINT) AS distance
      FROM c q, c r WHERE q.vec_id % 100 = 0),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS BIGINT) AS rank FROM p)
SELECT query_id, rank, vec_id, distance FROM n WHERE rank <= {K}
"""

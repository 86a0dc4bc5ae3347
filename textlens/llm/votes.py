"""Weak supervision over vote patterns: expectation-maximisation and logistic
regression as SQL expressions.

Every labeler votes 1, 0 or abstains (null).  Rows are first counted by vote
pattern, so at most 3^k rows remain for k labelers, however large the corpus
is.  These few rows form one array, over which all iterations run as nested
folds inside a single expression: one job, one row back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import let


@dataclass(frozen=True)
class LabelModel:
    """Prior of class 1, and for each labeler P(vote 1 | class 1) and
    P(vote 1 | class 0), given that it votes."""

    prior: float
    hit: dict[str, float]
    miss: dict[str, float]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """P(class 1 | votes).  Abstentions say nothing; with no vote at all
        the result is the prior."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, vote in votes.items():
            yes = math.log(self.hit[name] / self.miss[name])
            no = math.log((1 - self.hit[name]) / (1 - self.miss[name]))
            odds = odds + F.when(vote == 1, yes).when(vote == 0, no).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit_votes(patterns: DataFrame, names: list[str], count: str = "n", prior: float = 0.5,
              rounds: int = 15, strength: float = 4.0, start: tuple[float, float] = (0.85, 0.15),
              most_miss: float = 0.5) -> LabelModel:
    """EM over ``patterns`` (one column per labeler and a count).

    Estimates are smoothed towards ``start`` with ``strength`` pseudo votes
    and bounded (``hit`` from 0.5, ``miss`` up to ``most_miss``), so that class
    1 stays the class that votes of 1 speak for.  ``most_miss`` near 1 suits
    labelers of which a row of class 0 usually offends only one.  An empty
    table gives the starting model.
    """
    k = len(names)
    hit0, miss0 = start
    step = F.sequence(F.lit(0), F.lit(k - 1))

    def round_(params: Column) -> Column:
        """Next parameters: prior, then hit and miss of every labeler."""
        weights = F.transform(step, lambda j: F.array(
            F.log((1 - F.get(params, j + 1)) / (1 - F.get(params, j + 1 + k))),
            F.log(F.get(params, j + 1) / F.get(params, j + 1 + k))))
        base = F.log(F.get(params, F.lit(0)) / (1 - F.get(params, F.lit(0))))

        def sums(w: Column) -> Column:
            def add(acc: Column, p: Column) -> Column:
                odds = F.aggregate(F.zip_with(p["v"], w, lambda v, x: F.coalesce(F.get(x, v), F.lit(0.0))), base,
                                   lambda t, x: t + x)
                return let(F.array(p["n"] / (1 + F.exp(-odds)), p["n"] / (1 + F.exp(odds))), lambda q: F.zip_with(
                    acc, F.concat(q, F.flatten(F.transform(p["v"], lambda v: F.when(
                        v == 1, F.array(F.get(q, F.lit(0)), F.get(q, F.lit(0)), F.get(q, F.lit(1)), F.get(q, F.lit(1))))
                        .when(v == 0, F.array(F.get(q, F.lit(0)), F.lit(0.0), F.get(q, F.lit(1)), F.lit(0.0)))
                        .otherwise(F.array(*[F.lit(0.0)] * 4))))), lambda x, y: x + y))

            return F.aggregate(F.col("ps"), F.array_repeat(F.lit(0.0), 2 + 4 * k), add)

        def update(t: Column) -> Column:
            def rate(i: int, guess: float) -> Column:
                return F.transform(step, lambda j: (F.get(t, j * 4 + (3 + i)) + strength * guess)
                                   / (F.get(t, j * 4 + (2 + i)) + strength))

            pos, neg = F.get(t, F.lit(0)), F.get(t, F.lit(1))
            share = (pos + strength * prior) / (pos + neg + strength)
            return F.concat(
                F.array(F.least(F.greatest(share, F.lit(0.01)), F.lit(0.99))),
                F.transform(rate(0, hit0), lambda x: F.least(F.greatest(x, F.lit(0.5)), F.lit(0.999))),
                F.transform(rate(2, miss0), lambda x: F.greatest(F.least(x, F.lit(most_miss)), F.lit(0.001))))

        return let(let(weights, sums), update)

    first = F.array(F.lit(prior), *[F.lit(hit0)] * k, *[F.lit(miss0)] * k).cast("array<double>")
    votes = F.array(*(F.col(c).cast("int") for c in names))
    pattern = F.struct(votes.alias("v"), F.col(count).cast("double").alias("n"))
    one = patterns.agg(F.collect_list(pattern).alias("ps"))  # at most 3^k rows
    found = one.select(F.when(F.size("ps") > 0, F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), first, lambda params, _: round_(params))).alias("p")).first()["p"]
    if found is None:
        return LabelModel(prior, {c: hit0 for c in names}, {c: miss0 for c in names})
    return LabelModel(found[0], dict(zip(names, found[1:k + 1])), dict(zip(names, found[k + 1:])))


def fit_logistic(rows: DataFrame, names: list[str], weight: str, target: str,
                 rounds: int = 300, ridge: float = 1e-4) -> list[float]:
    """Weighted logistic regression on few rows (at most some thousands, the
    caller's bound); ``target`` may be any probability.  Each step moves every
    coefficient by its own Newton step, divided by the number of features so
    that no step overshoots.  Returns the bias and one coefficient per
    feature.  An empty table gives zeros."""
    k = len(names) + 1

    def step(w: Column) -> Column:
        def add(acc: Column, r: Column) -> Column:
            z = F.aggregate(F.zip_with(r["x"], w, lambda x, c: x * c), F.lit(0.0), lambda t, x: t + x)
            return let(1 / (1 + F.exp(-z)), lambda p: F.zip_with(acc, F.concat(
                F.transform(r["x"], lambda x: r["n"] * (r["y"] - p) * x),
                F.transform(r["x"], lambda x: r["n"] * p * (1 - p) * x * x)), lambda a, b: a + b))

        total = F.aggregate(F.col("rs"), F.array_repeat(F.lit(0.0), 2 * k), add)
        small = ridge * F.col("total")
        return let(total, lambda t: F.transform(w, lambda c, i: c + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (
            F.get(t, i) - F.when(i > 0, small * c).otherwise(0.0)) / ((F.get(t, i + k) + small) * k)))))

    x = F.array(F.lit(1.0), *(F.col(c).cast("double") for c in names))
    row = F.struct(x.alias("x"), F.col(weight).cast("double").alias("n"), F.col(target).cast("double").alias("y"))
    one = rows.agg(F.collect_list(row).alias("rs"), F.coalesce(F.sum(weight), F.lit(0)).cast("double").alias("total"))
    return list(one.select(F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), F.array_repeat(F.lit(0.0), k),
        lambda w, _: F.when(F.col("total") > 0, step(w)).otherwise(w)).alias("w")).first()["w"])

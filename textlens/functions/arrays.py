"""Grouping inside one row's arrays, so that nothing has to be shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def runs(items: Column, key: Callable[[Column], Column],
         out: Callable[[Column, Column, Column], Column]) -> Column:
    """Array of ``out(items, start, length)``, one for each run of neighbours
    with equal ``key`` (``start`` counts from 1).  Linear in the items."""
    def grouped(s: Column) -> Column:
        n = F.size(s)
        first = F.filter(F.sequence(F.lit(1), n),
                         lambda i: (i == 1) | (key(F.get(s, i - 1)) != key(F.get(s, i - 2))))
        return let(first, lambda at: F.transform(at, lambda i, j: out(s, i, F.coalesce(F.get(at, j + 1), n + 1) - i)))

    return let(items, lambda s: F.when(F.size(s) > 0, grouped(s)))


def counted(items: Column) -> Column:
    """Array of (term, tf): the different strings of an array and how often
    each occurs, in order; null for an empty array."""
    return runs(F.sort_array(items), lambda x: x,
                lambda s, i, n: F.struct(F.get(s, i - 1).alias("term"), n.cast("long").alias("tf")))

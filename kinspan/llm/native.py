"""Column expressions over whole texts: words, shingles and windows without Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinspan.llm.common import WS


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row, however often body uses it, also within lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS), "")


def runs(ws: Column, k: int, of: Callable[[list[Column]], Column]) -> Column:
    """of(words i to i+k-1) for every place i; an empty array for fewer words."""
    n = F.size(ws)
    at = F.when(n >= k, F.sequence(F.lit(0), n - F.lit(k))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: of([F.get(ws, i + F.lit(j)) if j else F.get(ws, i) for j in range(k)]))

